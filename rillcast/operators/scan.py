"""Ordered scans over long series, cut into blocks.

A window partitioned by series alone puts a whole series into one task. Here a
series is cut into blocks of ticks; what has to cross a block border (the next
point, a running count) is computed on one summary row per block and carried
over. Results equal the uncut window, for any block size.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillcast.functions.timeaxis import floor_div
from rillcast.sources.staged import per_key


def next_point(
    points: DataFrame,
    keys: Sequence[str],
    block: int | None,
    span: bool = False,
) -> DataFrame:
    """Add ``next_tick`` and ``next_value``: the following point of the series.

    Ticks are unique per series. ``span`` also adds ``lo`` and ``hi``, the
    first and last tick of the series. ``block`` None is for series whose
    length is bounded by construction (one event's history).
    """
    if block is None:
        if span:
            raise ValueError("span needs a block size")
        w = Window.partitionBy(*keys).orderBy("tick")
        return points.withColumns(
            {"next_tick": F.lead("tick").over(w), "next_value": F.lead("value").over(w)}
        )
    pts = points.withColumn("_block", floor_div(F.col("tick"), block))
    heads = pts.groupBy(*keys, "_block").agg(
        F.min("tick").alias("_first"),
        F.max("tick").alias("_last"),
        F.min_by("value", "tick").alias("_value"),
    )
    # One row per block, holding the first point of the block after it.
    over_blocks = Window.partitionBy(*keys).orderBy("_block")
    whole = Window.partitionBy(*keys)
    handed = heads.select(
        *keys,
        "_block",
        F.lead("_first").over(over_blocks).alias("tick"),
        F.lead("_value").over(over_blocks).alias("value"),
        F.lit(True).alias("_handed"),
        *(
            [F.min("_first").over(whole).alias("lo"), F.max("_last").over(whole).alias("hi")]
            if span
            else []
        ),
    )
    if not span:
        handed = handed.where(F.col("tick").isNotNull())
    w = Window.partitionBy(*keys, "_block").orderBy("tick")
    linked = (
        pts.withColumn("_handed", F.lit(False))
        .unionByName(handed, allowMissingColumns=True)
        .withColumns({"next_tick": F.lead("tick").over(w), "next_value": F.lead("value").over(w)})
    )
    if span:
        all_of = Window.partitionBy(*keys, "_block")
        linked = linked.withColumns({c: F.max(c).over(all_of) for c in ("lo", "hi")})
    return linked.where(~F.col("_handed")).drop("_block", "_handed")


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    block: Column,
    name: str = "rank",
) -> DataFrame:
    """Exact 1-based row number per key, plus ``<name>_total``, without a window over a key.

    ``block`` must rise with the order (rows of a lower block come first).
    """
    cut = df.withColumn("_block", block)
    over_blocks = Window.partitionBy(*keys).orderBy("_block") if keys else Window.orderBy("_block")
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    sizes = (
        cut.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(over_blocks.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn(f"{name}_total", F.sum("_n").over(whole))
        .select(*keys, "_block", F.coalesce("_before", F.lit(0)).alias("_before"), f"{name}_total")
    )
    w = Window.partitionBy(*keys, "_block").orderBy(*order)
    return (
        cut.join(sizes, [*keys, "_block"])
        .withColumn(name, F.row_number().over(w) + F.col("_before"))
        .drop("_block", "_before")
    )


def digest(cols: Sequence[str]) -> Column:
    """md5 of the text of the columns; nulls have their own mark."""
    return F.md5(
        F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in cols])
    )


def literal_rows(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A small settings table as a local relation (no Python worker, known size)."""
    names = [field.split()[0] for field in schema.split(",")]
    types = [" ".join(field.split()[1:]) for field in schema.split(",")]

    def cell(v, t):
        if v is None:
            return f"cast(null as {t})"
        if isinstance(v, str):
            text = v.replace("\\", "\\\\").replace("'", "\\'")
            return f"cast('{text}' as {t})"
        return f"cast({str(v).lower() if isinstance(v, bool) else v} as {t})"

    if not rows:
        return spark.createDataFrame([], schema)
    body = ", ".join("(" + ", ".join(cell(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


# A settings table up to this many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 100_000


def sized(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a table known to have at most ``rows`` rows, when that is small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def dense_ids(
    df: DataFrame, natural: Sequence[str], name: str, start: Column | int = 0
) -> DataFrame:
    """Dense ids ``start+1, start+2, …`` in the order of the natural key's digest.

    The digest spreads evenly, so its leading digits cut the rows into even
    blocks and no task sorts the whole table. The order is a function of the
    data: a rerun gives the same ids.
    """
    marked = df.withColumn("_digest", digest(natural))
    numbered = ranked(
        marked,
        [],
        ["_digest", *natural],
        F.conv(F.substring("_digest", 1, 3), 16, 10).cast("int"),
        name="_rank",
    )
    return numbered.select(
        (F.col("_rank") + (F.lit(start) if isinstance(start, int) else start)).cast("long").alias(name),
        *[c for c in df.columns],
    )


def halo(df: DataFrame, tick: str, block: int, before: int, after: int) -> DataFrame:
    """Copy rows near a block border into the neighbour blocks.

    Adds ``block`` and ``core``. Frames reaching at most ``before`` ticks back
    and ``after`` ticks ahead then give exact results on the core rows.
    """
    t = F.col(tick)
    return df.withColumn(
        "block",
        F.explode(
            F.sequence(floor_div(t - F.lit(after), block), floor_div(t + F.lit(before), block))
        ),
    ).withColumn("core", floor_div(t, block) == F.col("block"))


def largest_before(
    df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, known: DataFrame | None = None, block: int = 4096
) -> DataFrame:
    """Add ``name``: the largest ``value`` of the rows of the series before each row, null if there is none.

    Rows are ordered by ``order`` (a whole number, null first; of equal ones
    the smaller value first) and cut into blocks of it. ``known`` holds
    ``keys`` and ``value`` of what came before all rows. Only one row per
    block crosses a border.
    """
    first = -(2**62)
    rows = df.withColumn("_order", F.coalesce(F.col(order).cast("long"), F.lit(first))).withColumn("_block", floor_div(F.col("_order"), block))
    heads = rows.groupBy(*keys, "_block").agg(F.max(value).alias(value))
    if known is not None:
        heads = heads.unionByName(known.select(*keys, F.lit(first).cast("long").alias("_block"), value))
    so_far = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    handed = heads.withColumn(value, F.max(value).over(so_far)).where(F.col(value).isNotNull())
    both = rows.withColumn("_handed", F.lit(False)).unionByName(handed.withColumn("_handed", F.lit(True)), allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_block").orderBy(F.desc("_handed"), "_order", value).rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn(name, F.max(value).over(inside)).where("NOT _handed").drop("_handed", "_order", "_block")


WIDE = "decimal(38,0)"


def packed(high: Column, low: Column) -> Column:
    """Two whole numbers, the first from 0 to 2**61, as one that orders by the first, then the second."""
    return high.cast(WIDE) * F.lit(Decimal(1 << 64)).cast(WIDE) + low.cast(WIDE) + F.lit(Decimal(1 << 63)).cast(WIDE)


def best_rows(df: DataFrame, keys: Sequence[str], number: Column) -> DataFrame:
    """The row of the largest ``number`` (a decimal of 38 digits) of every key, whole rows moved once.

    A hash aggregate of keys, numbers and a digest of the row finds which row
    is best; only that row is then picked. Of rows that tie one stays. Columns
    of maps don't count in the digest.
    """
    content = [c for c, kind in df.dtypes if "map<" not in kind]
    named = df.withColumns({"_key": F.xxhash64(F.lit(1), *keys), "_digest": F.xxhash64(*content), "_number": number.cast(WIDE)})
    best = named.groupBy(*keys).agg(F.max_by("_digest", "_number").alias("_digest")).select(F.xxhash64(F.lit(1), *keys).alias("_key"), "_digest")
    picked = named.drop("_number").join(best, ["_key", "_digest"], "left_semi")
    # Rows equal in all columns become one; they lie together already.
    return (picked.distinct() if len(content) == len(df.columns) else picked.dropDuplicates(["_key", "_digest"])).drop("_key", "_digest")


def ordered_numbers(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """The distinct values of some columns with a number that rises in their order, null last; written once.

    Rows are dealt by ranges and sorted there: no task holds them all.
    """
    by = [c for n in order for c in (F.col(n).isNull(), F.col(n))]
    values = df.select(*order).distinct()
    return per_key(values.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id()))


def latest_rows(df: DataFrame, keys: Sequence[str], time: str, tie: str) -> DataFrame:
    """Per key the row with the latest time, the larger ``tie`` deciding.

    Two hash aggregates with map-side combine: a hot key costs no more than
    any other rows.
    """
    latest = per_key(df.groupBy(*keys).agg(F.max(time).alias("_latest")))
    rest = [c for c in df.columns if c not in keys]
    return (
        df.join(latest, list(keys))
        .where(F.col(time) == F.col("_latest"))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(tie)).alias("_row"))
        .select(*keys, "_row.*")
    )


def top_times(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Per key the latest time, how many rows share it, and the runner-up time."""
    latest = per_key(df.groupBy(*keys).agg(F.max(time).alias("latest")))
    return (
        df.select(*keys, time)
        .join(latest, list(keys))
        .groupBy(*keys)
        .agg(
            F.max("latest").alias("latest"),
            F.count_if(F.col(time) == F.col("latest")).alias("n_latest"),
            F.max(F.when(F.col(time) < F.col("latest"), F.col(time))).alias("runner_up"),
        )
    )
