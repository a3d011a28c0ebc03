import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rillcast.llm.token_counts import pieces, token_counts

JSON = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def whole(path, texts):
    if path == JSON:
        library = Tokenizer.from_file(path)
        return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [len(model.encode(t or "")) for t in texts]


@pytest.mark.parametrize("path", [JSON, MODEL])
@pytest.mark.parametrize("sizes", [{}, {"batch_bytes": 50, "long_bytes": 40}])
def test_counts_are_those_of_whole_texts(odd_docs, odd_texts, path, sizes):
    got = {r.doc_id: r for r in token_counts(odd_docs, path, limit=20, **sizes).collect()}
    want = whole(path, odd_texts)
    assert [got[i].n_tokens for i in range(len(odd_texts))] == want
    assert [got[i].over_limit for i in range(len(odd_texts))] == [n > 20 for n in want]
    assert [got[i].n_bytes for i in range(len(odd_texts))] == [len((t or "").encode()) for t in odd_texts]


def test_pieces_lose_nothing():
    text = "ab  cd\nefghijklmnop qr"
    for size in range(1, 30):
        cut = list(pieces(text, size))
        assert "".join(cut) == text
        assert all(p[0] in " \n" for p in cut[1:])


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in token_counts(docs, JSON).collect()] == [(None, 3, 2, False)]
    assert token_counts(docs.limit(0), JSON).count() == 0
