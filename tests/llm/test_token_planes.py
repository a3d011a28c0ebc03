import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rillcast.llm.token_planes import PlaneFile, PlaneWriter, from_planes, read_planes, to_planes, write_planes

JSON = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(1).integers(0, 2**32, n, dtype=np.uint32)
    planes = to_planes(ids, kind)
    assert planes.shape == ((4, n) if kind == "byte" else (32, -(-n // 8)))
    assert (from_planes(planes, n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_any_range_reads_back(kind):
    out = io.BytesIO()
    ids = np.random.default_rng(2).integers(0, 50_000, 1000, dtype=np.uint32)
    writer = PlaneWriter(out, kind, block=64)
    for part in np.array_split(ids, 7):
        writer.ids(part)
    writer.documents(np.array([3, 9]), np.array([1, 0], "u1"), np.array([400, 600]))
    assert writer.close() == 2
    planes = PlaneFile(pa.BufferReader(out.getvalue()))
    assert planes.doc_ids.tolist() == [3, 9] and planes.lengths.tolist() == [400, 600]
    for a, n in ((0, 1000), (63, 2), (64, 64), (999, 1), (10, 0)):
        assert (planes.read(a, n) == ids[a : a + n]).all()


def expected(rows):
    library = Tokenizer.from_file(JSON)
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_documents_read_back_in_order(spark, odd_docs, odd_texts, kind):
    files = write_planes(odd_docs, JSON, kind=kind, block=100)
    got = sorted(tuple(r) for r in read_planes(files).collect())
    assert got == expected(enumerate(odd_texts))


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(5, "b c"), (None, "a"), (5, "b c")], "doc_id long, text string")
    got = sorted((tuple(r) for r in read_planes(write_planes(docs, JSON)).collect()), key=lambda r: r[1])
    assert got == expected([(None, "a"), (5, "b c"), (5, "b c")])
    assert read_planes(write_planes(docs.limit(0), JSON)).count() == 0


def test_long_text_in_pieces(spark, monkeypatch):
    import rillcast.llm.token_planes as module

    monkeypatch.setattr(module, "LONG_BYTES", 10)
    monkeypatch.setattr(module, "BATCH_BYTES", 12)
    text = "some longer words to be cut apart " * 5
    docs = spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")
    assert sorted(tuple(r) for r in read_planes(write_planes(docs, JSON)).collect()) == expected([(1, text), (2, "x")])
