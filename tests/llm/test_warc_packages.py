import base64
import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from rillcast.llm.warc_packages import read_packages, records, spans, write_packages
from rillcast.llm.zip_members import at, data_offset, members


def expected(rows):
    payloads = [(h or "").encode() for _, _, h in rows]
    out = []
    for (page_id, url, _), payload in zip(rows, payloads):
        ids = [r[0] for r, p in zip(rows, payloads) if p == payload and r[0] is not None]
        keep = max(ids, default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = keep is not None and page_id != keep
        out.append((page_id, url, len(payload), digest, "revisit" if revisit else "response", keep if revisit else None, None if revisit else payload))
    return out


def in_order(rows):
    return sorted(map(repr, rows))


ROWS = [
    (1, "https://a.example/x?y=1", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "bad\r\nurl: 5%41 x", ""), (4, "u", None), (7, "u", "<p>é</p>"),
    (8, "w", "x\r\n\r\ny" * 1000), (None, "n", "<p>é</p>"), (None, "n", "alone"), (9, "t", "twin"), (9, "t", "twin"), (5, "", "a" * 300_000),
]


def test_pages_come_back_with_their_roles(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumnRenamed("x", "x").selectExpr("*", "1 AS keep", "'z' AS sha1")
    got = [(*r[:-1], bytes(r[-1]) if r[-1] is not None else None) for r in read_packages(write_packages(pages)).collect()]
    assert in_order(got) == in_order(expected(ROWS))


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy")], "page_id long, url string, html string")
    kinds = {r.record_type for r in read_packages(write_packages(pages, least_bytes=3), payloads=False).collect()}
    assert kinds == {"response"}


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_packages(write_packages(pages)).count() == 0


def test_zip64_directory_comment_and_packed_members(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("first", b"PK\x05\x06" * 20)
        z.writestr("é/second", b"stored bytes")
        z.writestr("packed", b"a" * 500, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 in it"
    assert b"PK\x06\x06" in out.getvalue()
    stream = pa.BufferReader(out.getvalue())
    found = {m.name: m for m in members(stream)}
    assert list(found) == ["first", "é/second", "packed"]
    assert at(stream, data_offset(stream, found["é/second"]), found["é/second"].size) == b"stored bytes"
    with pytest.raises(ValueError, match="packed"):
        data_offset(stream, found["packed"])


@pytest.mark.parametrize("broken", [b"", b"no package", b"PK\x05\x06" + b"\xff" * 18])
def test_broken_packages_are_refused(broken):
    with pytest.raises((ValueError, OSError)):
        list(records(pa.BufferReader(broken)))


def test_spans_cover_every_record_once():
    lines = [f'k {{"offset": {o}, "length": {n}}}' for o, n in ((0, 5), (5, 5), (12, 3), (15, 100), (115, 1))]
    runs = list(spans(lines, 10))
    assert [p for r in runs for p in r] == [(0, 5), (5, 5), (12, 3), (15, 100), (115, 1)]
    assert [len(r) for r in runs] == [2, 1, 1, 1]
