"""Passages that an earlier document holds too (operator 12).

Every window of words goes to the bucket of its minimiser, packed with its
neighbours of the same minimiser; equal windows meet there and are told apart
by sorting. First only minimisers and places are sorted, so that the words of
minimisers in one document never travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillcast.llm.line_dedup import counted
from rillcast.llm.super_kmers import BLANK, later_windows, packed, split_words, super_kmers
from rillcast.llm.words import spread
from rillcast.sources.staged import stage

WINDOW = 13
# A minimiser of more runs than this (some 4 MB) is hot: its windows go to buckets of their own, merged before the shuffle.
HOT_RUNS = 1 << 15
# One text in SAMPLE is looked at for minimisers that OFTEN of those texts have; so many at most are known as hot.
SAMPLE, OFTEN, KNOWN = 64, HOT_RUNS // 64, 1_000_000
BATCH_BYTES = 2 << 20
BATCH_RUNS = 1 << 15
# Merged spans of up to this many (24 MB) are broadcast to the texts; more are joined by shuffle.
BROADCAST_SPANS = 1_000_000


def parts(batches, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BATCH_BYTES`` of text; a longer text comes alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            n = max(1, int(np.searchsorted(ends, before + BATCH_BYTES, side="right")) - at)
            yield batch.slice(at, n)
            at += n


def text_rows(docs: DataFrame) -> DataFrame:
    """doc_id, two digests of the text (seeded apart, they name it) and text, of documents that have both."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), "text").alias("d2"), "text")


def repeated_texts(rows: DataFrame) -> DataFrame:
    """d1, d2 and first (the smallest doc_id) of texts in several documents."""
    groups = rows.groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return stage(groups.where("first < last").drop("last"))


def minimisers(rows: DataFrame, size: int, known: np.ndarray | None = None) -> DataFrame:
    """doc_id, d1, start (word) and minimiser of every run whose minimiser isn't known already."""
    known = rows.sparkSession.sparkContext.broadcast(np.empty(0, np.int64) if known is None else known)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text"):
            text, start, _, mini = super_kmers(*split_words(batch.column("text")), size)
            new = np.flatnonzero(~member(mini, known.value))
            own = [batch.column(c).take(pa.array(text[new])) for c in ("doc_id", "d1")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(start[new], pa.int32()), pa.array(mini[new])], names=["doc_id", "d1", "start", "mini"])

    return rows.select("doc_id", "d1", "text").mapInArrow(run, "doc_id long, d1 long, start int, mini long")


def member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values a sorted array holds."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def hot_minimisers(rows: DataFrame, size: int) -> np.ndarray:
    """Minimisers that a sample finds in several texts of it, sorted: those of very common passages.

    They needn't be counted to be known as repeated. Which ones are known here
    decides the work, not the result.
    """
    some = minimisers(rows.where(F.pmod(F.col("d1"), F.lit(SAMPLE)) == 0), size)
    counts = some.groupBy("mini").agg(F.count_distinct("doc_id").alias("n")).where(F.col("n") >= OFTEN)
    found = counts.orderBy(F.desc("n"), "mini").limit(KNOWN).select("mini").toArrow()
    return np.sort(found.column("mini").to_numpy())


def repeated_runs(runs: DataFrame) -> DataFrame:
    """doc_id, d1, start and hot (more than ``HOT_RUNS`` runs) of the runs whose minimiser several documents have.

    Runs come sorted by minimiser and doc_id; of a minimiser no more than
    ``HOT_RUNS`` runs, or those of its first document, are held.
    """

    def told(table: pa.Table, rows: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
        taken = table.select(["doc_id", "d1", "start"]).take(pa.array(rows)).combine_chunks()
        return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in taken.columns), pa.array(hot)], names=["doc_id", "d1", "start", "hot"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        hot_now = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            if not len(table):
                continue
            mini, doc = table.column("mini").to_numpy(), table.column("doc_id").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], mini[1:] != mini[:-1]]))
            end = np.append(first[1:], len(mini))
            several, hot = doc[first] != doc[end - 1], end - first > HOT_RUNS
            if hot_now is not None and mini[0] == hot_now:
                several[0] = hot[0] = True
            whole = np.ones(len(first), bool)
            whole[-1] = several[-1] and hot[-1]
            hot_now = mini[-1] if whole[-1] else None
            sizes = end - first
            keep = np.flatnonzero(np.repeat(several & whole, sizes))
            if len(keep):
                yield told(table, keep, np.repeat(hot, sizes)[keep])
            held = None if whole[-1] else table.slice(int(first[-1]))
        if held is not None and held.column("doc_id")[0] != held.column("doc_id")[-1]:
            yield told(held, np.arange(len(held)), np.zeros(len(held), bool))

    dealt = runs.repartition("mini").sortWithinPartitions("mini", "doc_id")
    return dealt.mapInArrow(run, "doc_id long, d1 long, start int, hot boolean")


def packed_runs(rows: DataFrame, size: int, known: np.ndarray) -> DataFrame:
    """doc_id, d1, start (word), mini, hot and run (its words) of the runs that ``rows`` lists (starts, hots) and those of known minimisers."""
    known = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text"):
            split = split_words(batch.column("text"))
            text, start, windows, mini = super_kmers(*split, size)
            starts = batch.column("starts")
            owner = np.repeat(np.arange(len(starts)), pc.fill_null(pc.list_value_length(starts), 0).to_numpy(zero_copy_only=False))
            listed = (owner << 32) + starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(listed)
            listed, hots = listed[order], batch.column("hots").flatten().to_numpy(zero_copy_only=False)[order]
            own = (text << 32) + start
            often = member(mini, known.value)
            keep = np.flatnonzero(often | member(own, listed))
            hot = often[keep]
            if len(listed):
                at = np.minimum(np.searchsorted(listed, own[keep]), len(listed) - 1)
                hot = hot | (hots[at].astype(bool) & (listed[at] == own[keep]))
            for at in range(0, len(keep), BATCH_RUNS):
                i, h = keep[at : at + BATCH_RUNS], hot[at : at + BATCH_RUNS]
                named = [batch.column(c).take(pa.array(text[i])) for c in ("doc_id", "d1")]
                words = packed(*split, text[i], start[i], windows[i], size).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*named, pa.array(start[i], pa.int32()), pa.array(mini[i]), pa.array(h), words], names=["doc_id", "d1", "start", "mini", "hot", "run"])

    return rows.select("doc_id", "d1", "text", "starts", "hots").mapInArrow(run, "doc_id long, d1 long, start int, mini long, hot boolean, run string")


def bucket_spans(runs: DataFrame, size: int) -> DataFrame:
    """doc_id, d1 and spans (first word and the one behind the last) of windows that an earlier document holds.

    A bucket's runs stand together, sorted by minimiser; whole minimisers are
    taken from the stream, of which none has more than ``HOT_RUNS`` runs.
    """

    def spans(table: pa.Table) -> pa.RecordBatch:
        run, place = later_windows(table.column("run").combine_chunks(), table.column("doc_id").to_numpy(), size)
        new = np.ones(len(run), bool)
        new[1:] = (run[1:] != run[:-1]) | (place[1:] != place[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first, len(run))[1:] - 1
        start = table.column("start").to_numpy()[run[first]]
        own = [table.column(c).take(pa.array(run[first])).combine_chunks() for c in ("doc_id", "d1")]
        return pa.RecordBatch.from_arrays(
            [*own, pa.array(start + place[first], pa.int32()), pa.array(start + place[last] + size, pa.int32())], names=["doc_id", "d1", "a", "b"]
        )

    both = F.array(F.struct("a", "b")).alias("spans")

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in parts(batches, "run"):
            mini = batch.column("mini").to_numpy()
            if held and held[-1].column("mini")[-1].as_py() != mini[0]:
                yield spans(pa.Table.from_batches(held))
                held = []
            cut = int(np.flatnonzero(mini == mini[-1])[0])
            if cut:
                yield spans(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield spans(pa.Table.from_batches(held))

    return runs.repartition("mini").sortWithinPartitions("mini").mapInArrow(run, "doc_id long, d1 long, a int, b int").select("doc_id", "d1", both)


def hot_spans(runs: DataFrame, size: int) -> DataFrame:
    """The same for runs of hot minimisers: equal runs, then equal windows are merged before they are shuffled."""
    name = [F.xxhash64("run").alias("r1"), F.xxhash64(F.lit(1), "run").alias("r2")]
    merged = runs.groupBy("run").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    words = merged.select(*name, "first", "last", F.split("run", " ").alias("w"))
    window = F.transform(F.sequence(F.lit(0), F.size("w") - size), lambda i: F.array_join(F.slice("w", i + 1, size), " "))
    windows = words.select("r1", "r2", "first", "last", F.posexplode(window).alias("place", "window"))
    several = windows.groupBy("window").agg(F.min("first").alias("origin"), F.max("last").alias("last")).where("origin < last")
    found = windows.select("r1", "r2", "place", "window").join(several.select("window", "origin"), "window")
    by_run = found.groupBy("r1", "r2").agg(F.collect_list(F.struct("place", "origin")).alias("found"))
    held = runs.select("doc_id", "d1", "start", *name).join(by_run, ["r1", "r2"])
    late = F.filter("found", lambda x: x["origin"] < F.col("doc_id"))
    spans = F.transform(late, lambda x: F.struct((F.col("start") + x["place"]).alias("a"), (F.col("start") + x["place"] + size).alias("b")))
    return held.select("doc_id", "d1", spans.alias("spans")).where(F.size("spans") > 0)


def merged_spans(spans: DataFrame) -> DataFrame:
    """doc_id, d1 and spans of every text, those that touch made one."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("spans")
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False)) << 32
            first, end = (lists.flatten().field(c).to_numpy(zero_copy_only=False) + owner for c in ("a", "b"))
            order = np.argsort(first, kind="stable")
            first, reach = first[order], np.maximum.accumulate(end[order])
            new = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]])) if len(first) else np.empty(0, np.int64)
            place, last = first[new], reach[np.append(new[1:], len(first)) - 1] if len(first) else reach
            fields = pa.StructArray.from_arrays([pa.array(x & 0xFFFFFFFF, pa.int32()) for x in (place, last)], names=["a", "b"])
            offsets = pa.array(np.searchsorted(place >> 32, np.arange(len(lists) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("d1"), pa.ListArray.from_arrays(offsets, fields)], names=["doc_id", "d1", "spans"])

    by_doc = spans.groupBy("doc_id", "d1").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return by_doc.mapInArrow(run, "doc_id long, d1 long, spans array<struct<a:int,b:int>>")


def repeated_spans(rows: DataFrame, size: int) -> DataFrame:
    """doc_id, d1 and spans (of words) of the windows that start in an earlier document, of distinct texts."""
    known = hot_minimisers(rows, size)
    named = repeated_runs(minimisers(rows, size, known)).groupBy("doc_id", "d1")
    lists = stage(named.agg(F.collect_list("start").alias("starts"), F.collect_list("hot").alias("hots")))
    runs = stage(packed_runs(rows.join(lists, ["doc_id", "d1"], "left"), size, known))
    spans = bucket_spans(runs.where("NOT hot"), size).unionByName(hot_spans(runs.where("hot"), size))
    return merged_spans(spans)


def without_spans(texts: pa.Array, spans: list[list[tuple[int, int]]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts without the words of their spans, numbers of words and of words taken out; a text that loses none stays as it is."""
    bounds, codes, words = split_words(texts)
    n = np.diff(bounds)
    edges = np.zeros(len(codes) + 1, np.int64)
    flat = np.array([(base + a, base + min(b, m)) for own, base, m in zip(spans, bounds.tolist(), n.tolist()) for a, b in own], np.int64).reshape(-1, 2)
    np.add.at(edges, flat[:, 0], 1)
    np.add.at(edges, flat[:, 1], -1)
    kept = np.cumsum(edges)[:-1] == 0
    left = np.concatenate([[0], np.cumsum(kept)])[bounds]
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.take(pa.array(codes[kept]))), BLANK)
    removed = n - np.diff(left)
    return pc.if_else(pa.array(removed > 0), joined.cast(pa.string()), texts.cast(pa.string())), n, removed


def dedup_passages(docs: DataFrame, size: int = WINDOW, name: str = "passages") -> DataFrame:
    """Documents without the words of windows that also start in a document of smaller doc_id.

    Words are those between ASCII white space, unchanged. All windows are
    judged on the texts as they come. ``text`` becomes the words left, joined
    by a blank, if any goes, and stays as it is otherwise; a struct ``name``
    holds n_words and n_removed. Null texts stay null and have no words; a
    document without doc_id keeps its words and takes none from others; rows
    of equal doc_id take none from each other. Columns of any name are kept,
    only one called ``name`` is replaced.

    Documents whose whole text an earlier one has are settled by a digest of
    the text; all others by their windows.
    """
    rows = text_rows(docs)
    copies = repeated_texts(rows)
    firsts = rows.join(counted(copies), ["d1", "d2"], "left").where("first IS NULL OR doc_id = first").select("doc_id", "d1", "text")
    by_doc = stage(repeated_spans(firsts, size))
    if (by_doc.agg(F.sum(F.size("spans"))).first()[0] or 0) <= BROADCAST_SPANS:
        by_doc = F.broadcast(by_doc)

    @F.arrow_udf("struct<text:string,n_words:bigint,n_removed:bigint>")
    def cut(texts: pa.Array, spans: pa.Array, copied: pa.Array) -> pa.Array:
        out = []
        batch = pa.RecordBatch.from_arrays([texts, spans, copied], names=["text", "spans", "copied"])
        for part in parts([batch], "text"):
            own = [[(0, 1 << 31)] if c else [(x["a"], x["b"]) for x in s or ()] for s, c in zip(part.column("spans").to_pylist(), part.column("copied").to_pylist())]
            new, n, removed = without_spans(part.column("text"), own)
            fields = [new, pa.array(n, pa.int64()), pa.array(removed, pa.int64())]
            out.append(pa.StructArray.from_arrays(fields, names=["text", "n_words", "n_removed"]))
        return pa.concat_arrays(out) if out else pa.array([], pa.struct([("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())]))

    whole_rows = docs.select(F.struct("*").alias("row")).select("row", F.col("row.doc_id").cast("long").alias("id"), F.col("row.text").cast("string").alias("text"))
    named = whole_rows.withColumns({"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(1), "text")})
    marked = named.join(counted(copies), ["d1", "d2"], "left").join(by_doc.select(F.col("doc_id").alias("id"), "d1", "spans"), ["id", "d1"], "left")
    long_enough = F.size(F.regexp_extract_all("text", F.lit(r"[^ \t-\r]+"), F.lit(0))) >= size
    copied = F.when(F.col("first") < F.col("id"), long_enough).otherwise(F.lit(False))
    done = marked.select("row", cut("text", "spans", F.coalesce(copied, F.lit(False))).alias("cut"))
    changed = F.col("row").withField("text", F.col("cut.text"))
    if name in docs.columns:
        changed = changed.dropFields(name)
    return done.select(changed.alias("row"), F.struct("cut.n_words", "cut.n_removed").alias("counts")).select("row.*", F.col("counts").alias(name))
