"""Registered queries without a SQL twin, over the whole smallest tables, against libraries and plain loops."""

import hashlib
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from test_line_dedup import plain as plain_lines
from test_simhash import plain_fingerprint, plain_groups
from test_url_templates import plain as plain_url
from tokenizers import Tokenizer

import __spark_entry__ as entry
from rillcast.llm.pseudonyms import found_in, replaced
from rillcast.llm.queries import SAMPLE_KEY

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not there")


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, SF).collect()]


def test_pseudonyms(spark, documents):
    got = {r["doc_id"]: r for r in rows(spark, "op1_pseudonyms")}
    for d, t in documents:
        found = found_in(t or "", SAMPLE_KEY)
        assert got[d]["n_found"] == len(found)
        assert replaced(got[d]["text"] or "", found_in(got[d]["text"] or "", SAMPLE_KEY, back=True)) == (t or "")
        assert not any((t or "")[f.start : f.end] in got[d]["text"] for f in found if f.end - f.start > 6)


def test_tokens_and_planes(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    planes = {r["doc_id"]: r for r in rows(spark, "op2_token_planes")}
    counts = {r["doc_id"]: r for r in rows(spark, "op5_token_counts")}
    start = 0
    for d, t in documents:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert counts[d] == {"doc_id": d, "n_bytes": len((t or "").encode()), "n_tokens": len(ids), "over_limit": len(ids) > 2048}
        crc = zlib.crc32(np.array([*ids, 2], "<u4").tobytes())
        assert planes[d] == {"doc_id": d, "start": start, "n_tokens": len(ids) + 1, "ids_crc32": crc}
        start += len(ids) + 1


def test_pieces(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in rows(spark, "op4_piece_bpe")}
    for d, t in documents:
        ids = library.encode(t or "")
        want = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        assert got[d] == {"doc_id": d, "n_tokens": len(ids), "ids_sha256": want[0], "decoded_sha256": want[1]}


def test_fingerprints_and_groups(spark, documents):
    got = {r["doc_id"]: r for r in rows(spark, "op6_simhash")}
    prints = {d: plain_fingerprint(t) for d, t in documents}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    groups = plain_groups(prints, pairs)
    assert got == {d: {"doc_id": d, "fingerprint": f"{prints[d]:016x}", "component_id": groups[d]} for d in prints}


def test_urls(spark):
    urls = duckdb.sql(f"SELECT page_id, url FROM '{SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in rows(spark, "op8_url_templates")}
    assert len(got) == len(urls)
    for page, url in urls:
        host, path, rule = plain_url(url)
        assert (got[page]["host"], got[page]["path"], got[page]["rule"]) == (host, path, rule and rule.name)
        assert got[page]["verdict"] == rule.verdict if rule else got[page]["verdict"] in ("allow", "block")


def test_lines(spark, documents):
    got = {r["doc_id"]: r for r in rows(spark, "op10_line_dedup")}
    for (d, _), (text, lines, dropped, links, first) in zip(documents, plain_lines(documents, 2, 32)):
        digest = None if text is None else hashlib.sha256(text.encode()).hexdigest()
        assert got[d] == {"doc_id": d, "n_lines": lines, "n_dropped": dropped, "n_links": links, "class_id": first, "text_sha256": digest}
