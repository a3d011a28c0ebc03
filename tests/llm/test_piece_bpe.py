import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from rillcast.llm import piece_bpe
from rillcast.llm.piece_bpe import PieceEncoder, decode, decode_ids, piece_digests, piece_ids

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(PATH)


def lists(encoder, texts):
    ids, n = encoder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(n)
    return [ids[e - k : e].tolist() for e, k in zip(ends, n)]


@pytest.mark.parametrize("letters", ["aA.,'<|>!  \n\t́é1²▁et", "ab c=-", "  \n=", "thnige r", "日本語  x\U0001f600"])
def test_random_texts_encode_and_decode_like_the_library(library, encoder, letters):
    rng = random.Random(3)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]
    got = lists(encoder, texts)
    assert got == library.encode(texts)
    flat, n = encoder.encode(pa.array(texts))
    assert decode(encoder.model, flat, n) == [library.decode(g) for g in got]


def test_words_merged_one_by_one_agree(library, encoder, monkeypatch):
    """Runs of equal scores must leave the rounds; long ones must not take a step per symbol and round."""
    seen = []
    plain = piece_bpe.one_by_one
    monkeypatch.setattr(piece_bpe, "one_by_one", lambda m, s: seen.append(len(s)) or plain(m, s))
    texts = [" " * 41 + "x", " " * 20_000, "a" * 5000, "=-" * 3000, " \n" * 500, "a  b" * 300]
    assert lists(PieceEncoder(PATH), texts) == library.encode(texts)
    assert seen


def test_any_ids_decode_like_the_library(library, encoder):
    rng = np.random.default_rng(5)
    for _ in range(500):
        ids = rng.integers(0, 32_000, 8)
        ids = np.where(rng.random(8) < 0.5, rng.integers(1, 259, 8), ids)
        assert decode(encoder.model, ids, np.array([8])) == [library.decode(ids.tolist())]


def test_tables(spark, odd_docs, odd_texts, library):
    want = [library.encode(t or "") for t in odd_texts]
    coded = piece_ids(odd_docs, PATH, batch_bytes=300)
    assert {r.doc_id: r.ids for r in coded.collect()} == dict(enumerate(want))
    assert {r.doc_id: r.text for r in decode_ids(coded, PATH).collect()} == {i: library.decode(w) for i, w in enumerate(want)}
    got = {r.doc_id: tuple(r)[1:] for r in piece_digests(odd_docs, PATH).collect()}
    for i, ids in enumerate(want):
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids)))
        assert got[i] == (len(ids), *digests)


def test_empty_table_repeats_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (2, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_tokens) for r in piece_digests(docs, PATH).collect()) == [("1", 1), ("1", 1), ("2", 0), ("None", 1)]
    assert piece_digests(docs.limit(0), PATH).count() == 0
    assert decode_ids(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first().text == ""
