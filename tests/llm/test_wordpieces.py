"""SentencePiece ids and texts against the library itself."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from tracelake.llm import wordpieces

PATH = wordpieces.model_path(wordpieces.MODEL)
BITS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "é", "漢", "字", "😀", "́", "<s>", "<0x0A>", "0", "\x00", "ﬁ", "     ",
        "aaaa", "==", "--", "한", "�", "▁", "▁▁x", "​", "and", "ther"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return wordpieces.Model(PATH)


def _texts():
    rng = random.Random(5)
    texts = ["".join(rng.choices(BITS, k=rng.randrange(0, 50))) for _ in range(3000)]
    pieces = [p for p in wordpieces.Model(PATH).symbols]
    texts += ["".join(rng.choices(pieces, k=rng.randrange(0, 20))) for _ in range(3000)]
    texts += [" " * n for n in range(70)] + ["a" * n for n in range(70)]
    return texts + ["", "ab" * 4000, " " * 9000 + "x", "漢" * 5000, "the and " * 20000]


def test_ids_and_texts_equal_the_library(model, library, monkeypatch):
    monkeypatch.setattr(wordpieces, "CHUNK", 5000)  # texts over several chunks, too
    texts = _texts()
    ids, counts = model.encode(texts)
    ends = np.cumsum(counts)
    own = [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)]
    assert own == library.encode(texts)
    assert model.decode(ids, counts) == [library.decode(i) for i in own]


def test_any_ids_decode_as_the_library_does(model, library):
    rng = random.Random(6)
    some = [[rng.randrange(32000) if rng.random() < 0.4 else rng.randrange(262) for _ in range(rng.randrange(12))] for _ in range(5000)]
    some += [[], [1], [2, 1], [1, 28705], [28705, 28705], [0], [229, 2, 133, 175], [229, 133, 175]]
    flat = np.array([i for ids in some for i in ids], np.int64)
    assert model.decode(flat, [len(ids) for ids in some]) == [library.decode(ids) for ids in some]


def test_documents(spark, library):
    texts = [*_texts()[::40], None, None, "x y"]
    rows = [(i if i % 7 else None, t, "clash", 3) for i, t in enumerate(texts)] + [(5, "x y", "clash", 3)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = wordpieces.digest(wordpieces.decode(wordpieces.encode(docs))).collect()

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for doc, text, *_ in rows:
        ids = library.encode(text or "")
        want.append((doc, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert wordpieces.digest(wordpieces.decode(wordpieces.encode(docs.limit(0)))).count() == 0
