"""Word lists and constants used by the text operators.

All of these are defaults: every operator that uses one takes it as a
parameter, so a deployment can pass its own (larger) lists instead.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Contractions and their expansions, applied in this order as literal replaces.
CONTRACTIONS = [
    ("n't", " not"),
    ("'re", " are"),
    ("'s", " is"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'ve", " have"),
    ("'m", " am"),
]

# Words that are never treated as stop words by the annotator.
KEEP_WORDS = (
    "no not nor none never neither who what where when why how "
    "says said reports announces claims"
).split()

# Category merge map (one pass, not transitive; other categories pass through).
CATEGORY_MERGES = {
    "PARENTING": "PARENTS",
    "HEALTHY LIVING": "WELLNESS",
    "THE WORLDPOST": "WORLD NEWS",
    "WORLDPOST": "WORLD NEWS",
    "U.S. NEWS": "WORLD NEWS",
    "ARTS": "CULTURE & ARTS",
    "TASTE": "FOOD & DRINK",
    "COLLEGE": "EDUCATION",
    "MONEY": "BUSINESS",
    "STYLE": "STYLE & BEAUTY",
    "GREEN": "ENVIRONMENT",
    "BLACK VOICES": "DIVERSITY VOICES",
    "LATINO VOICES": "DIVERSITY VOICES",
    "QUEER VOICES": "DIVERSITY VOICES",
    "WEIRD NEWS": "VARIETY",
    "GOOD NEWS": "VARIETY",
    "FIFTY": "VARIETY",
}

# Text markers read as null by the marker-aware CSV scan.
NULL_MARKERS = ["", "NA", "null", "NULL", "NaN"]

# The six pattern lists and six part-of-speech counts of an annotated article.
PATTERN_KEYS = [
    "named_entities",
    "action_phrases",
    "descriptive_phrases",
    "quotes",
    "temporal_expressions",
    "location_expressions",
]
POS_KEYS = [
    "adj_count",
    "verb_count",
    "noun_count",
    "proper_noun_count",
    "adv_count",
    "quote_count",
]

# Common English stop words.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma "
    "mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren "
    "weren't won won't wouldn wouldn't"
).split()

# Starter tag lexicon: tag, then word or word>lemma entries (Penn tag names).
_TAGGED = {
    "DT": "the a an this that these those every some any no each",
    "IN": "of in on at by for with from about after before against between into through during "
    "over under while because if as until",
    "CC": "and or but nor",
    "TO": "to",
    "PRP": "i you he she it we they me him them us",
    "PRP$": "my your his her its our their",
    "WP": "who whom what",
    "WRB": "where when why how",
    "WDT": "which",
    "MD": "will would can could may might must shall should",
    "RB": "not never very too also now here there just again soon well",
    "VBZ": "is>be has>have does>do says>say reports>report announces>announce claims>claim",
    "VBP": "are>be am>be have do",
    "VBD": "was>be were>be had>have did>do said>say went>go made>make took>take found>find "
    "won>win got>get gave>give told>tell left>leave",
    "VB": "be go make take find win get give tell say see know think want help",
    "VBN": "been>be seen>see known>know given>give taken>take",
    "JJ": "new good bad big great old high major first last long little own other public right",
    "JJR": "better>good worse>bad bigger>big",
    "JJS": "best>good worst>bad biggest>big",
    "NNS": "men>man women>woman children>child people news",
    "NNP": "monday tuesday wednesday thursday friday saturday sunday january february april june "
    "july august september october november december york trump obama america",
}

# Intensity words of the sentiment rules and the scalar each one adds.
BOOST = 0.293
_BOOST_UP = (
    "absolutely amazingly awfully completely considerably decidedly deeply enormously entirely "
    "especially exceptionally extremely fabulously fully greatly highly hugely incredibly "
    "intensely majorly more most particularly purely quite really remarkably so substantially "
    "thoroughly totally tremendously uber unbelievably unusually utterly very"
).split()
_BOOST_DOWN = (
    "almost barely hardly kinda less little marginally occasionally partly scarcely slightly "
    "somewhat sorta"
).split()
BOOSTERS = {**{w: BOOST for w in _BOOST_UP}, **{w: -BOOST for w in _BOOST_DOWN}}

BOOSTER_PHRASES = {"kind of": -BOOST, "sort of": -BOOST, "just enough": -BOOST}

# Phrases whose valence replaces that of the words in them.
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "bus stop": 0.0, "yeah right": -2.0,
    "kiss of death": -1.5, "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}

# Negating words of the sentiment rules (any word holding "n't" negates too).
NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt "
    "mustnt neither never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt "
    "werent without wont wouldnt rarely seldom despite"
).split()

# Starter sentiment lexicon: word and mean valence.
_VALENCES = """
good 1.9 great 3.1 excellent 2.7 best 3.2 better 1.9 nice 1.8 love 3.2 loved 2.9 like 1.5 happy 2.7
win 2.8 winning 2.4 won 2.7 success 2.7 successful 2.8 hope 1.9 hopeful 2.3 joy 2.8 fun 2.3
amazing 2.8 awesome 3.1 beautiful 2.9 brilliant 2.8 perfect 2.7 wonderful 2.7 positive 2.6
support 1.7 safe 1.9 strong 2.3 help 1.7 helpful 1.8 free 2.3 peace 2.5 smart 1.7 proud 2.1
celebrate 2.7 kind 2.4 clean 1.7 calm 1.3 gain 2.4 growth 1.6 healthy 1.7 honest 2.3 improve 1.9
inspire 2.7 trust 2.3 welcome 2.0 favorite 2.0 funny 1.9 friendly 2.2 rich 2.6 thank 1.5
bad -2.5 worse -2.1 worst -3.1 terrible -2.1 awful -2.0 horrible -2.5 hate -2.7 sad -2.1
angry -2.3 fear -2.2 war -2.9 kill -3.7 killed -3.5 dead -3.3 death -2.9 die -2.9 attack -2.1
crisis -3.1 crime -2.5 criminal -2.4 disaster -3.1 lost -1.3 lose -1.7 loss -1.3 pain -2.3
problem -1.7 fail -2.5 failed -2.3 failure -2.3 guilty -1.8 wrong -2.1 weak -1.9 poor -2.1
pathetic -2.7 worthless -1.9 stupid -2.4 ugly -2.3 evil -3.4 danger -2.4 dangerous -2.1
threat -2.4 violence -3.1 violent -2.9 victim -1.1 abuse -3.2 shooting -1.3 murder -3.7
scandal -1.9 fraud -2.8 sick -2.3 sorry -0.3 stress -1.8 suffer -2.5 terror -2.4 toxic -2.1
tragedy -3.4 trouble -1.7 worry -1.9 negative -2.7 no -1.2 idiot -2.3 disgusting -2.4 trash -2.0
"""

# Answers to requests that cannot be scored.
NOT_TEXT = "Headline and short_description must be strings"
BLANK = "Headline and short_description cannot be empty"
NOTHING_LEFT = "Text processing failed to produce valid output"

# Compound scores from which a text counts as positive or negative.
POSITIVE_FROM, NEGATIVE_FROM = 0.05, -0.05

# Special tokens of the fixed-length encoding: padding, unknown, start, end.
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 100, 101, 102
# --- end of fixed values ----------------------------------------------------


def tag_lexicon() -> dict[str, tuple[str, str]]:
    """word -> (tag, lemma) for the starter lexicon."""
    lexicon = {}
    for tag, entries in _TAGGED.items():
        for entry in entries.split():
            word, _, lemma = entry.partition(">")
            lexicon[word] = (tag, lemma or word)
    return lexicon


def sentiment_lexicon() -> dict[str, float]:
    """word -> valence for the starter lexicon."""
    fields = _VALENCES.split()
    return {w: float(v) for w, v in zip(fields[::2], fields[1::2])}


def annotator_stop_words() -> list[str]:
    """Stop words minus the keep words."""
    return sorted(set(STOP_WORDS) - set(KEEP_WORDS))
