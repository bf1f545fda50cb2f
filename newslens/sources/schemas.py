"""Explicit schemas; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampType,
)

from newslens.functions.wordlists import PATTERN_KEYS, POS_KEYS


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


ARTICLE = _struct(
    headline=StringType(), short_description=StringType(), category=StringType(), date=DateType()
)
ARTICLE_WITH_ID = StructType([StructField("doc_id", LongType()), *ARTICLE.fields])
NEWS_INPUT = _struct(headline=StringType(), short_description=StringType(), date=StringType())
POS_FEATURES = _struct(**{k: IntegerType() for k in POS_KEYS})
NEWS_PATTERNS = _struct(**{k: ArrayType(StringType()) for k in PATTERN_KEYS})
PROCESSED = _struct(
    category=StringType(), date=DateType(), processed_text=StringType(),
    sentiment_text=StringType(), pos_features=POS_FEATURES, news_patterns=NEWS_PATTERNS,
)
SCORES = _struct(
    compound=DoubleType(), positive=DoubleType(), neutral=DoubleType(), negative=DoubleType()
)
RESPONSE = _struct(
    success=BooleanType(),
    category=_struct(predicted=StringType(), confidence=DoubleType()),
    sentiment=_struct(label=StringType(), scores=SCORES),
    processed_data=_struct(
        date=StringType(), processed_text=StringType(), pos_features=POS_FEATURES,
        news_patterns=NEWS_PATTERNS,
    ),
    error=StringType(),
)
RUN_LOG = _struct(
    run_id=StringType(), experiment=StringType(), ts=TimestampType(), kind=StringType(),
    key=StringType(), value=StringType(),
)
PREDICTION = _struct(
    doc_id=LongType(), y=IntegerType(), pred=IntegerType(), confidence=DoubleType()
)
