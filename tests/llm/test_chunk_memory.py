"""What a worker remembers of words: few bytes each besides their ids, and the same ids after it forgets."""

import numpy as np
import pytest

from newslens.llm import chunk_bpe

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_words_are_remembered_in_arrays(monkeypatch):
    words = chunk_bpe.Words(public_tokenizers.path("word_bpe_49k.json"))
    text = " ".join(f"word{i % 3000} été{i % 7} x" for i in range(9000))
    data = np.frombuffer(text.encode(), np.uint8)
    ids, _ = words.encode(data, np.array([0]), np.array([len(data)]))
    assert ids.tolist() == words.encode_one(text)
    assert not any(isinstance(x, dict) and x and all(isinstance(k, int) for k in x) for x in vars(words).values())
    assert len(words.hashes) == 3008 and words.hashes.nbytes + words.numbers.nbytes == 12 * 3008
    assert (np.diff(words.hashes.astype(object)) > 0).all()
    monkeypatch.setattr(chunk_bpe, "REMEMBERED", 100)
    monkeypatch.setattr(chunk_bpe, "PIECE", 500)
    again, _ = words.encode(data, np.array([0, 0, 5]), np.array([len(data), 5, 0]))
    assert again.tolist()[: len(ids)] == ids.tolist()
