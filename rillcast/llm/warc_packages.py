"""Web archives in ZIP packages (operator 7).

A package holds, stored and not packed a second time, ``archive/data.warc.gz``
(one gzip member per record) and ``indexes/index.cdxj`` (one line per record
with its offset and length). The reader takes the central directory, the index
and then ranges of the archive member; nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillcast.llm.storage import new_folder, open_input, open_output
from rillcast.llm.zip_members import at, data_offset, members
from rillcast.sources.staged import stage

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
CAPTURED = "2024-01-01T00:00:00Z"
SPAN = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    digits = (name or "")[len("<urn:page:") : -1]
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, captured: str) -> bytes:
    """One record: the HTTP head with the payload, or with none for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_name(page_id)), ("WARC-Date", captured)]
    if url is not None:
        # Line breaks would end the header; percent signs keep the escape reversible.
        head.append(("WARC-Target-URI", re.sub(r"[%\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_name(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode() + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:] if line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parsed(data: bytes) -> tuple:
    """One record's row. Digest and size of a response are taken from its bytes, of a revisit from its heads."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = fields(head)
    block = rest[: int(warc["content-length"])]
    if len(block) != int(warc["content-length"]):
        raise ValueError("a record ends too early")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha1:")
    url = warc.get("warc-target-uri")
    if url is not None:
        url = re.sub(r"%([0-7][0-9A-F])", lambda m: chr(int(m[1], 16)), url)
    if kind == "revisit":
        return page_of(warc["warc-record-id"]), url, int(fields(http)["content-length"]), digest, kind, page_of(warc["warc-refers-to"]), None
    if base32_sha1(payload) != digest:
        raise ValueError("a payload doesn't match its digest")
    return page_of(warc["warc-record-id"]), url, len(payload), digest, kind, None, payload


def with_roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages as page_id, url, html, sha1 and, for revisits, refers_to; null html is the empty payload.

    Among equal payloads of ``least_bytes`` or more the largest page_id keeps
    the payload. Only digests and ids are aggregated; of these only payloads
    that occur more than once are written and joined back, so their checked
    size decides between broadcast and a join that AQE splits by skew.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("html"),
    ).withColumns({"sha1": F.sha1("html"), "size": F.length("html")})
    again = rows.where(F.col("size") >= least_bytes).groupBy("sha1", "size").agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
    keep = stage(again.where("n > 1").select("sha1", "size", "keep"))
    return rows.join(keep, ["sha1", "size"], "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep"))
    ).select("page_id", "url", "html", "sha1", "refers_to")


def write_packages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, captured: str = CAPTURED) -> DataFrame:
    """Write one package per task; returns the table of packages (file, n_records).

    A task streams its records through; only the index lines are held. Every
    attempt writes a name of its own and only returned names count. Rows that
    share the largest page_id of a payload are all responses; null ids are
    kept; extra columns are ignored; an empty table gives no packages.
    """
    folder = folder or new_folder(pages.sparkSession, "packages")

    def write(batches) -> Iterator[pa.RecordBatch]:
        name, index, stream, package, member, place = f"{folder}/{uuid.uuid4().hex}.wacz", [], None, None, None, 0
        for batch in batches:
            for page_id, url, html, sha1, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "sha1", "refers_to"))):
                if member is None:
                    stream = open_output(name)
                    package = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
                    member = package.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                data = record(page_id, url, html, digest, refers_to, refers_to is not None, captured)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = packer.compress(data) + packer.flush()
                member.write(data)
                index.append(f"{record_name(page_id)} {json.dumps({'offset': place, 'length': len(data), 'digest': digest})}\n")
                place += len(data)
        if member is not None:
            member.close()
            package.writestr(zipfile.ZipInfo(INDEX), "".join(index))
            package.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([len(index)], pa.int64())})

    return stage(with_roles(pages, least_bytes).mapInArrow(write, "file string, n_records long"))


def spans(lines: list[str], longest: int) -> Iterator[list[tuple[int, int]]]:
    """Index lines as runs of neighbouring records of up to ``longest`` bytes; a longer record comes alone."""
    run: list[tuple[int, int]] = []
    places = sorted((d["offset"], d["length"]) for d in (json.loads(line.partition(" ")[2]) for line in lines))
    for offset, length in places:
        if run and (offset != sum(run[-1]) or offset + length - run[0][0] > longest):
            yield run
            run = []
        run.append((offset, length))
    if run:
        yield run


def records(stream, span: int = SPAN) -> Iterator[tuple]:
    """Rows of all records that a package's indexes list, read by range."""
    by_name = {m.name: m for m in members(stream)}
    index, archive = by_name[INDEX], by_name[ARCHIVE]
    lines = at(stream, data_offset(stream, index), index.size).decode().splitlines()
    first = data_offset(stream, archive)
    for run in spans(lines, span):
        data = at(stream, first + run[0][0], sum(run[-1]) - run[0][0])
        for offset, length in run:
            a = offset - run[0][0]
            yield parsed(zlib.decompress(data[a : a + length], 31))


def read_packages(packages: DataFrame, payloads: bool = True, span: int = SPAN) -> DataFrame:
    """Records of packages (a table with a ``file`` column): RECORDS_SCHEMA, payload null for revisits or if not asked for."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        )
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with open_input(name) as stream:
                    rows, size = [], 0
                    for row in records(stream, span):
                        rows.append(row if payloads else (*row[:-1], None))
                        size += len(row[-1] or b"") if payloads else 0
                        if len(rows) == 4096 or size > span:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = packages.select("file")
    return files.repartitionByRange(max(1, files.count()), "file").mapInArrow(read, RECORDS_SCHEMA)
