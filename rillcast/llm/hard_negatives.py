"""Hard negatives of anchors by segment summaries (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillcast.llm.segment_bounds import EDGE, FINEST, SLACK, as_rows, candidates, exact_scores, kth_largest, levels, summaries
from rillcast.sources.staged import stage

# Vectors and anchors of one unit of work, about.
UNIT_VECTORS, UNIT_ANCHORS = 8192, 4096
# Anchors whose pairs with all vectors of a unit are bounded together.
ANCHORS = 64
NAMED = "vec_id long, label long, q array<double>, means array<double>, deviations array<double>"


def usable(vectors: DataFrame, scale: float) -> DataFrame:
    """vec_id, label and q (components times ``scale``, rounded down) of rows that take part, each once."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    # A long holds what floor() gives; beyond it components end at its ends, and zero has one sign.
    most = float(2**62)
    whole = F.transform("x", lambda v: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), v * F.lit(float(scale))))).cast("double"))))
    return rows.select("vec_id", "label", whole.alias("q")).dropDuplicates()


def summarised(rows: DataFrame) -> DataFrame:
    """The rows with mean and deviation of every finest segment."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("q").value_lengths().to_numpy(zero_copy_only=False)
            for n in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == n))
                found = summaries(as_rows(part.column("q"), n))
                columns = [*part.columns, *(pa.FixedSizeListArray.from_arrays(pa.array(f.ravel()), FINEST).cast(pa.list_(pa.float64())) for f in found)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "q", "means", "deviations"])

    return rows.mapInArrow(run, NAMED)


def column(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks()


class Block:
    """Vectors of a unit with their levels; zeros fill up short vectors."""

    def __init__(self, table: pa.Table, width: int):
        self.ids, self.labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
        self.lengths = column(table, "q").value_lengths().to_numpy(zero_copy_only=False)
        self.x = as_rows(column(table, "q"), width)
        if (self.lengths == width).all():
            means, deviations = (column(table, c).flatten().to_numpy(zero_copy_only=False).reshape(-1, FINEST) for c in ("means", "deviations"))
        else:
            # Segments of a shorter vector end elsewhere: summarise it as it stands here.
            means, deviations = summaries(self.x)
        self.levels = levels(means, deviations, self.x.shape[1] // FINEST)

    def some(self, a: int, b: int) -> list:
        return [(w, m[a:b], d[a:b]) for w, m, d in self.levels]


def widest(*tables: pa.Table) -> int:
    return max(pc.max(pc.list_value_length(t.column("q"))).as_py() or 0 for t in tables)


def first_rows(row: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of every row number (they come sorted), by falling score, then id."""
    near = np.flatnonzero(score >= kth_largest(row, score, n, int(row[-1]) + 1)[row]) if len(row) else np.empty(0, np.int64)
    row, score, ids = row[near], score[near], ids[near]
    order = np.lexsort((ids, -score, row))
    own = row[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.empty(0, np.int64)
    place = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    return near[order[place < n]]


def unit_positives(anchors: pa.Table, vectors: pa.Table, n: int) -> Iterator[tuple]:
    """(anchor row, vector row, score) of the best ``n`` same-label vectors of a unit, for every anchor."""
    width = widest(anchors, vectors)
    left, right = Block(anchors, width), Block(vectors, width)
    for at in range(0, len(left.ids), ANCHORS):
        end = min(at + ANCHORS, len(left.ids))
        allowed = left.labels[at:end, None] == right.labels[None, :]
        for i, j in zip(*np.nonzero(allowed & (left.ids[at:end, None] == right.ids[None, :]))):
            if left.lengths[at + i] == right.lengths[j] and np.array_equal(left.x[at + i], right.x[j]):
                allowed[i, j] = False

        def keep(a, b, low, high, rows=end - at):
            return high >= kth_largest(a, low, n, rows)[a]

        a, b = candidates(left.some(at, end), right.levels, allowed, keep)
        score = exact_scores(left.x[at:end], right.x, a, b)
        best = first_rows(a, score, right.ids[b], n)
        yield a[best] + at, b[best], score[best]


def score_range(score: int, low: tuple[int, int], high: tuple[int, int]) -> tuple[int, int]:
    """Least and largest whole number between two fractions of a score."""
    return -(-low[0] * score // low[1]), high[0] * score // high[1]


def unit_negatives(anchors: pa.Table, vectors: pa.Table, n: int, low: tuple[int, int], high: tuple[int, int]) -> Iterator[tuple]:
    """(anchor row, vector row, score, positive's score) of the best ``n`` vectors of other labels in the range of every positive.

    Positives of one score have one range; only distinct scores (column ``scores``) are looked for.
    """
    width = widest(anchors, vectors)
    left, right = Block(anchors, width), Block(vectors, width)
    scores = anchors.column("scores").to_pylist()
    for at in range(0, len(left.ids), ANCHORS):
        end = min(at + ANCHORS, len(left.ids))
        turns = []
        for turn in range(max(map(len, scores[at:end]))):
            own = [s[turn] if turn < len(s) else None for s in scores[at:end]]
            ranges = np.array([(1, 0) if s is None else score_range(s, low, high) for s in own], object)
            turns.append((np.array([s or 0 for s in own], np.int64), *np.clip(ranges, -EDGE, EDGE - 1).astype(np.int64).T))
        wide = []
        for _, least, most in turns:
            # Beyond 2**53 a range is rounded as a double: what may lie inside and what does differ by this.
            room = SLACK * (np.abs(least.astype(float)) + np.abs(most.astype(float))) + SLACK
            wide.append((least - room, least + room, most - room, most + room, least <= most))

        def keep(a, b, lower, upper, rows=end - at, wide=wide):
            left = np.zeros(len(a), bool)
            for least, surely_least, surely_most, most, some in wide:
                inside = (lower >= surely_least[a]) & (upper <= surely_most[a])
                best = kth_largest(a[inside], lower[inside], n, rows)
                left |= (upper >= np.maximum(least, best)[a]) & (lower <= most[a]) & some[a]
            return left

        a, b = candidates(left.some(at, end), right.levels, left.labels[at:end, None] != right.labels[None, :], keep)
        score = exact_scores(left.x[at:end], right.x, a, b)
        for own, least, most in turns:
            fits = np.flatnonzero((score >= least[a]) & (score <= most[a]))
            best = fits[first_rows(a[fits], score[fits], right.ids[b[fits]], n)]
            yield a[best] + at, b[best], score[best], own[a[best]]


def dealt(rows: DataFrame, parts: int, name: str) -> DataFrame:
    return rows.withColumn(name, F.pmod(F.xxhash64("vec_id", "q"), F.lit(parts)).cast("int"))


def units(anchors: DataFrame, vectors: DataFrame, n_anchors: int, n_vectors: int):
    """Anchors and vectors grouped so that every block of anchors meets every block of vectors in one unit."""
    c, g = max(1, -(-n_anchors // UNIT_ANCHORS)), max(1, -(-n_vectors // UNIT_VECTORS))
    left = dealt(anchors, c, "c").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(g - 1))))
    right = dealt(vectors, g, "g").withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(c - 1))))
    return left.groupBy("c", "g").cogroup(right.groupBy("c", "g"))


def told(anchors: pa.Table, others: pa.Table, found: Iterator[tuple], names: list[str]) -> pa.Table:
    """The rows of a unit by the anchor's name and the other's vec_id."""
    parts = list(found)
    a, b, *numbers = (np.concatenate(c) if parts else np.empty(0, np.int64) for c in (zip(*parts) if parts else [()] * len(names)))
    return pa.table([column(anchors, "anchor").take(pa.array(a)), column(others, "vec_id").take(pa.array(b)), *map(pa.array, numbers)], names=names)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
    low: tuple[int, int] = (80, 100), high: tuple[int, int] = (100, 100), scale: float = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, label and embedding; ``is_anchor`` is a condition
    on them. Components become whole numbers (times ``scale``, rounded down);
    a score is their inner product. An anchor's positives are its best
    ``positives`` other rows of its label; a positive's negatives the best
    ``negatives`` rows of other labels whose score lies between ``low`` and
    ``high`` (fractions) of the positive's. Ties go to the smaller vec_id.

    Every block of anchors meets every block of vectors once per pass; in it
    segment summaries, finer and finer, rule pairs out before exact scoring.
    Per anchor (or anchor and positive) a unit hands on its best few only.

    Rows with a null vec_id, label, vector or component or a component that
    isn't finite take no part. Rows equal in all three are one row; other
    rows of one vec_id are rows of their own. Shorter vectors are filled up
    with zeros; an empty vector scores zero with all. Scores beyond a long end
    at its ends, components at 2**62. Other columns are ignored.
    """
    store = stage(summarised(usable(vectors, scale)))
    chosen = stage(summarised(usable(vectors.where(is_anchor), scale)).withColumn("anchor", F.xxhash64("vec_id", "label", "q")))
    n_vectors, n_anchors = store.count(), chosen.count()
    names = ["anchor", "id", "score", "positive_score"]

    def best_same(anchors: pa.Table, others: pa.Table) -> pa.Table:
        return told(anchors, others, unit_positives(anchors, others, positives), names[:3])

    def best_other(anchors: pa.Table, others: pa.Table) -> pa.Table:
        return told(anchors, others, unit_negatives(anchors, others, negatives, low, high), names)

    met = units(chosen, store, n_anchors, n_vectors).applyInArrow(best_same, "anchor long, id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    best = stage(met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives))
    asking = stage(chosen.join(best.groupBy("anchor").agg(F.sort_array(F.collect_set("score")).alias("scores")), "anchor"))
    other = units(asking, store, n_anchors, n_vectors).applyInArrow(best_other, "anchor long, id long, score long, positive_score long")
    order = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), "id")
    ranked = other.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    pairs = best.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = pairs.join(ranked, ["anchor", "positive_score"]).join(chosen.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
