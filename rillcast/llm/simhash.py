"""SimHash fingerprints and their groups, linked by pivot distance tables (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillcast.llm.components import components
from rillcast.llm.text_columns import bound, small_letters, spaced_words
from rillcast.sources.staged import stage

BITS = 64
PIVOTS = 16
BLOCK_ROWS = 8192
PAIR_ROWS = 12
SHINGLE_ROWS = 1 << 19


def shingle_hashes(text: Column, size: int) -> Column:
    """XXH64 (seed 42) of every run of ``size`` words (A-Z lower-cased), joined by blanks; of all words if there are fewer."""

    def of(w: Column) -> Column:
        run = lambda i: F.xxhash64(F.concat_ws(" ", *(F.get(w, i + k) for k in range(size))))
        short = F.array(F.xxhash64(F.array_join(w, " ")))
        return (
            F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
            .when(F.size(w) <= size, short)
            .otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - size), run))
        )

    return bound(spaced_words(small_letters(text)), of)


def majority(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Fingerprint of every list of hashes: bits set in over half of them; zero for an empty list."""
    counts = np.zeros((len(lengths), BITS), np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    for a in range(0, len(hashes), SHINGLE_ROWS):
        part = hashes[a : a + SHINGLE_ROWS]
        own = owner[a : a + SHINGLE_ROWS]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    over = 2 * counts > lengths[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, digest (of the text) and fp (the fingerprint's bits as a long) of every whole text.

    Hashes are made by Spark's own functions; only they go to the Arrow
    function that counts bits, in pieces of bounded size. Null and blank texts
    have fingerprint zero. Other columns are ignored.
    """

    def count(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("h")
            hashes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            found = majority(hashes, lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            columns = [batch.column("doc_id"), batch.column("digest"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "fp"])

    text = F.col("text").cast("string")
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), shingle_hashes(text, size).alias("h"))
    return hashed.mapInArrow(count, "doc_id long, digest long, fp long")


def band_masks(most: int, bands: int) -> list[int]:
    """Masks of all unions of ``bands - most`` bands: fingerprints with up to ``most`` different bits agree on one."""
    from itertools import combinations

    edges = [BITS * k // bands for k in range(bands + 1)]
    single = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(single, bands - most)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def pivot_table(fps: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances of fingerprints to reference fingerprints drawn by a fixed rule."""
    chosen = np.random.default_rng(BITS).integers(0, 2**BITS, pivots, dtype=np.uint64)
    return np.bitwise_count(fps[:, None] ^ chosen[None, :]).astype(np.int8)


def survivors(table: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Places of pairs (a[i], b[i]) whose coordinates differ by ``most`` at most, one pivot after another."""
    left = np.arange(len(a))
    for k in range(table.shape[1]):
        left = left[np.abs(table[a[left], k] - table[b[left], k]) <= most]
    return left


def small_links(fps: np.ndarray, table: np.ndarray, group: np.ndarray, largest: int, most: int):
    """All links within groups of up to ``largest`` neighbouring rows."""
    for step in range(1, largest):
        a = np.flatnonzero(group[:-step] == group[step:]) if step < len(group) else np.empty(0, np.int64)
        if not len(a):
            return
        a = a[survivors(table, a, a + step, most)]
        a = a[np.bitwise_count(fps[a] ^ fps[a + step]) <= most]
        yield fps[a], fps[a + step]


def large_links(fps: np.ndarray, table: np.ndarray, most: int):
    """Links that connect one large group as all its links do, found from each reached row to those not yet reached.

    Rows are ordered by their first coordinate, so those a row may link to
    stand in one slice; the other coordinates thin the slice before distances
    are verified. A row that was reached is compared no more.
    """
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    free = np.ones(len(fps), bool)
    edges = np.searchsorted(table[:, 0], np.arange(-most, BITS + 2 * most + 1))
    for seed in range(len(fps)):
        if not free[seed]:
            continue
        free[seed] = False
        front = [seed]
        while front:
            at = front.pop()
            d = int(table[at, 0])
            slice_ = slice(edges[d], edges[d + 2 * most + 1])
            near = np.flatnonzero(free[slice_]) + slice_.start
            for k in range(1, table.shape[1]):
                if len(near) < 64:
                    break
                near = near[np.abs(table[near, k] - table[at, k]) <= most]
            near = near[np.bitwise_count(fps[near] ^ fps[at]) <= most]
            free[near] = False
            front.extend(near.tolist())
            if len(near):
                yield np.full(len(near), fps[at]), fps[near]


def unit_links(batches, most: int) -> Iterator[pa.RecordBatch]:
    """Links of rows (band, key, i, j, fp) sorted by unit; a unit cut by a batch's end is carried over."""
    kept: pa.Table | None = None

    def links(rows: pa.Table) -> pa.RecordBatch:
        unit = [rows.column(c).to_numpy() for c in ("band", "key", "i", "j")]
        fps = rows.column("fp").to_numpy().view(np.uint64)
        new = np.zeros(len(fps), bool)
        new[0] = True
        for c in unit:
            new[1:] |= c[1:] != c[:-1]
        table, group = pivot_table(fps), np.cumsum(new)
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(fps)))
        small = np.repeat(sizes <= PAIR_ROWS, sizes)
        found = list(small_links(fps[small], table[small], group[small], PAIR_ROWS, most))
        for a, n in zip(first[sizes > PAIR_ROWS], sizes[sizes > PAIR_ROWS]):
            found.extend(large_links(fps[a : a + n], table[a : a + n], most))
        a, b = (np.concatenate([np.empty(0, np.uint64), *(f[k] for f in found)]).view(np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if kept is not None:
            rows = pa.concat_tables([kept, rows]).combine_chunks()
        if not len(rows):
            continue
        last = np.ones(len(rows), bool)
        for c in ("band", "key", "i", "j"):
            column = rows.column(c).to_numpy()
            last &= column == column[-1]
        cut = len(rows) - int(last.sum())
        if cut:
            yield links(rows.slice(0, cut))
        kept = rows.slice(cut)
    if kept is not None and len(kept):
        yield links(kept)


def fingerprint_links(fps: DataFrame, most: int = 3, bands: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints (column fp) as all pairs within ``most`` bits do.

    Distances to pivots crowd around half the bits, so they can't serve as join
    keys; what is compared at all is decided by bands: within ``most`` bits two
    fingerprints agree on ``bands - most`` bands. Rows that share such a key
    form a bucket. A large bucket is cut into blocks by a digest, and every two
    blocks are a unit of work of at most about ``2 * block_rows`` rows, so no
    bucket is held by one task, and none is left out. Within a unit the pivot
    table discards pairs and survivors are verified; dense units give their
    spanning links, not all pairs.
    """
    masks = band_masks(most, bands)
    keyed = fps.select(
        "fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks))).alias("band", "key")
    )
    shared = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    rows = keyed.join(shared, ["band", "key"]).withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int"))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda t: t != F.col("block"))
    units = rows.withColumn("block", block).withColumn(
        "other", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(other))
    ).select("band", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "fp")
    dealt = units.repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j")
    return dealt.mapInArrow(lambda batches: unit_links(batches, most), "a long, b long").distinct()


def simhash_groups(docs: DataFrame, size: int = 3, most: int = 3, bands: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, digest, fp, root (the group's name) and component_id: the smallest doc_id that links of up to ``most`` bits reach.

    Equal fingerprints are one before anything is compared, so copies cost
    nothing and a hot group of them is only a count. Null doc_ids get their
    fingerprint's component and are never its name (null if all are); repeated
    rows are kept; an empty table gives none.
    """
    found = stage(fingerprints(docs, size))
    distinct = stage(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = stage(fingerprint_links(distinct.select("fp"), most, bands, block_rows))
    roots = components(links)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = stage(rooted.join(least, "root").select("fp", "root", "component_id"))
    return found.join(names, "fp").select("doc_id", "digest", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """One document of every group, with its columns: the smallest doc_id (null last), of equal ids the smallest digest.

    Rows equal in doc_id and text are one document; they stay or go together.
    """
    groups = simhash_groups(docs, **settings)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    first = stage(groups.groupBy("root").agg(F.min(order).alias("first")).select("first.doc_id", "first.digest"))
    same = (F.xxhash64(F.col("row.text").cast("string")) == F.col("digest")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id"))
    return docs.select(F.struct("*").alias("row")).join(first, same, "left_semi").select("row.*")


def fingerprint_text(fp: Column) -> Column:
    """Sixteen lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
