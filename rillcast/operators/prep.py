"""Training-side preparation of samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillcast.config import Grid
from rillcast.functions.timeaxis import season_name, season_name_of_code, shift
from rillcast.functions.vectors import SEASON_FLAGS, deltas, finite, time_feature_steps
from rillcast.operators.scan import best_rows, ordered_numbers, packed
from rillcast.sources.staged import per_key

# Sample time columns and the version columns, best first.
TIME_COLUMNS = ("history_end_time", "forecast_start_time", "forecast_end_time")
VERSION_COLUMNS = ("source_version", "dataset_version", "data_version", "version")

# How many groups an error message names besides their number.
NAMED_GROUPS = 20


def time_problems(df: DataFrame) -> DataFrame:
    """One row: how many rows have an unusable value in each time column."""
    lost = [c for c in TIME_COLUMNS if c not in df.columns]
    if lost:
        raise ValueError(f"missing time columns: {', '.join(lost)}")
    return df.agg(
        *[
            F.count_if(F.try_to_timestamp(F.col(c).cast("string")).isNull()).alias(c)
            for c in TIME_COLUMNS
        ]
    )


def parse_times(df: DataFrame) -> DataFrame:
    """Timestamps from text; fails naming the columns and counts of bad rows."""
    counts = time_problems(df).first().asDict()
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise ValueError(f"invalid timestamps: {bad}")
    return df.withColumns(
        {c: F.try_to_timestamp(F.col(c).cast("string")).cast("timestamp_ntz") for c in TIME_COLUMNS}
    )


def ranking_columns(df: DataFrame) -> list[str]:
    """The first version column holding any value, then ``source_mtime`` if it holds any."""
    candidates = [c for c in (*VERSION_COLUMNS, "source_mtime") if c in df.columns]
    if not candidates:
        return []
    used = df.agg(*[F.count(c).alias(c) for c in candidates]).first().asDict()
    versions = [c for c in VERSION_COLUMNS if used.get(c)][:1]
    return versions + (["source_mtime"] if used.get("source_mtime") else [])


def newest_wins(
    df: DataFrame,
    keys: Sequence[str] = ("site_id", "forecast_start_time"),
    ranking: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: highest version, then file time, then path. A missing version ranks highest.

    Without a ranking column every row stays. Versions, times and paths (as
    many as there are files) are numbered in their order; a key's best number
    is found on narrow rows, and only its row is then taken. Rows that tie in
    all of these are told apart by a digest of the row.
    """
    ranking = ranking_columns(df) if ranking is None else list(ranking)
    if not ranking:
        return df
    by = ranking + (["source_path"] if "source_path" in df.columns else [])
    numbers = ordered_numbers(df, by, "_rank")
    numbered = df.join(numbers, [df[c].eqNullSafe(numbers[c]) for c in by]).select(*(df[c] for c in df.columns), "_rank")
    content = [c for c, kind in df.dtypes if "map<" not in kind]
    return best_rows(numbered, keys, packed(F.col("_rank"), F.xxhash64(*content))).drop("_rank")


def season_flag_columns(code: Column | str) -> dict[str, Column]:
    c = F.col(code) if isinstance(code, str) else code
    return {f: F.coalesce((c == i).cast("int"), F.lit(0)) for i, f in enumerate(SEASON_FLAGS)}


def with_season_name(df: DataFrame, code: str = "season", start: str = "forecast_start_time") -> DataFrame:
    """Season name from the code; one unknown code makes all rows use the month."""
    by_month = season_name(F.month(start))
    if code not in df.columns:
        return df.withColumn("season_name", by_month)
    known = season_name_of_code(code)
    unknown = df.agg((F.count_if(known.isNull()) > 0).alias("u")).scalar()
    return df.withColumn("season_name", F.when(unknown, by_month).otherwise(known))


def with_time_features(
    df: DataFrame, lags: int, grid: Grid = Grid(), season_flags: bool = True
) -> DataFrame:
    return df.withColumn("time_steps", time_feature_steps(lags, grid, season_flags=season_flags))


def split_bounds(df: DataFrame, grid: Grid = Grid(), keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """Per site: validation starts one year before the last forecast end, plus one step."""
    return (
        df.groupBy(*keys)
        .agg(F.max("forecast_end_time").alias("validation_end"))
        .withColumn(
            "validation_start",
            shift(F.col("validation_end") - F.expr("interval 1 year"), 1, grid),
        )
    )


def trailing_year_split(
    df: DataFrame, grid: Grid = Grid(), keys: Sequence[str] = ("site_id",)
) -> DataFrame:
    """Tag samples ``train`` or ``validation``; samples across the border are left out."""
    part = F.when(F.col("forecast_end_time") < F.col("validation_start"), F.lit("train")).when(
        F.col("forecast_start_time") >= F.col("validation_start"), F.lit("validation")
    )
    return (
        df.join(per_key(split_bounds(df, grid, keys)), list(keys))
        .withColumn("part", part)
        .where(F.col("part").isNotNull())
    )


def require_both_parts(split: DataFrame, keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """Fail when a site lacks training or validation samples (one small aggregate)."""
    lacking = (
        split.groupBy(*keys)
        .agg(
            F.count_if(F.col("part") == "train").alias("n_train"),
            F.count_if(F.col("part") == "validation").alias("n_validation"),
        )
        .where((F.col("n_train") == 0) | (F.col("n_validation") == 0))
    )
    total, named = lacking.count(), lacking.limit(NAMED_GROUPS).collect()
    if total:
        shown = [r.asDict() for r in named]
        raise ValueError(f"empty train or validation part in {total} groups, of which the first {len(shown)}: {shown}")
    return split


def season_subsets(split: DataFrame, keys: Sequence[str] = ("site_id", "season_name")) -> DataFrame:
    """Row counts per group and whether it can be trained (both parts present)."""
    return (
        split.groupBy(*keys)
        .agg(
            F.count_if(F.col("part") == "train").alias("train_rows"),
            F.count_if(F.col("part") == "validation").alias("validation_rows"),
        )
        .withColumn("usable", (F.col("train_rows") > 0) & (F.col("validation_rows") > 0))
    )


def usable_subsets(split: DataFrame, keys: Sequence[str] = ("site_id", "season_name")) -> DataFrame:
    good = per_key(season_subsets(split, keys).where("usable").select(*keys))
    return split.join(good, list(keys), "left_semi")


def exact_medians(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], accuracy: int = 10_000, bins: int = 1024
) -> DataFrame:
    """Exact median of each column per key, as ``keys, name, median``.

    Approximate quantiles just below and above the middle (their rank error is
    at most n / accuracy) bound where the median lies, whatever the outliers.
    Values between them are counted per distinct value and per equal-width bin;
    only the bins holding the middle ranks are ordered. No task sees all values
    of a key.
    """
    by = [*keys, "name"]
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns]
    long = (
        df.select(*keys, F.explode(F.array(*pairs)).alias("e"))
        .select(*keys, "e.name", "e.v")
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
    )
    slack = 3.0 / accuracy
    near = F.percentile_approx("v", [0.5 - slack, 0.5 + slack], accuracy)
    limits = per_key(
        long.groupBy(*by)
        .agg(near.alias("q"), F.count(F.lit(1)).alias("total"))
        .select(*by, "total", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))
    )
    width = F.col("high") - F.col("low")
    at = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("low")) / width * bins), F.lit(bins - 1)))
    # Bin -1 counts what lies below; what lies above is not needed.
    held = long.join(limits, by).where(F.col("v") <= F.col("high"))
    held = held.withColumn(
        "bin", F.when(F.col("v") < F.col("low"), F.lit(-1)).otherwise(F.coalesce(at, F.lit(0))).cast("int")
    ).withColumn("v", F.when(F.col("bin") >= 0, F.col("v")))
    counts = held.groupBy(*by, "total", "bin", "v").agg(F.count(F.lit(1)).alias("n"))
    over_bins = Window.partitionBy(*by).orderBy("bin")
    # Middle ranks, 1-based: the same one twice when the count is odd.
    lower = F.call_function("div", F.col("total") + 1, F.lit(2))
    upper = F.call_function("div", F.col("total") + 2, F.lit(2))
    middle = (
        counts.groupBy(*by, "total", "bin")
        .agg(F.sum("n").alias("in_bin"))
        .withColumn("upto", F.sum("in_bin").over(over_bins))
        .withColumn("before", F.col("upto") - F.col("in_bin"))
        .where((F.col("before") < upper) & (F.col("upto") >= lower))
        .select(*by, "bin", "before")
    )
    over_values = Window.partitionBy(*by, "bin").orderBy("v")
    ranks = (
        counts.join(middle, [*by, "bin"])
        .withColumn("upto", F.col("before") + F.sum("n").over(over_values))
        .withColumn("after", F.col("upto") - F.col("n"))
    )

    def value_at(rank):
        return F.max(F.when((F.col("after") < rank) & (F.col("upto") >= rank), F.col("v")))

    return ranks.groupBy(*by).agg(((value_at(lower) + value_at(upper)) / 2).alias("median"))


def impute_static(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("site_id",)
) -> DataFrame:
    """Numeric statics; missing ones take the training median of their site, else 0."""
    numeric = df.withColumns({c: F.col(c).try_cast("double") for c in columns})
    medians = exact_medians(numeric.where(F.col("part") == "train"), keys, columns)
    wide = medians.groupBy(*keys).pivot("name", list(columns)).agg(F.first("median"))
    wide = wide.select(*keys, *[F.col(c).alias(f"_median_{c}") for c in columns])
    return (
        numeric.join(per_key(wide), list(keys), "left")
        .withColumns(
            {c: F.coalesce(F.nanvl(F.col(c), F.lit(None)), f"_median_{c}", F.lit(0.0)) for c in columns}
        )
        .drop(*[f"_median_{c}" for c in columns])
    )


def fit_scalers(
    train: DataFrame, statics: Sequence[str] = (), keys: Sequence[str] = ("site_id",)
) -> DataFrame:
    """Per group one mean and population deviation for all lags, one for all deltas, one per static.

    The arrays are exploded inside the map side of a hash aggregate, so only
    one row per group and task is shuffled.
    """
    # Same name, same length: both arrays become (block, value) rows of one pass.
    pairs = F.concat(
        F.transform("lags", lambda x: F.struct(F.lit("lag").alias("block"), x.alias("x"))),
        F.transform(deltas(), lambda x: F.struct(F.lit("delta").alias("block"), x.alias("x"))),
        *(
            [F.array(*[F.struct(F.lit(c).alias("block"), F.col(c).cast("double").alias("x")) for c in statics])]
            if statics
            else []
        ),
    )
    return (
        train.select(*keys, F.explode(pairs).alias("p"))
        .select(*keys, "p.block", "p.x")
        .groupBy(*keys, "block")
        .agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("deviation"))
    )


def scaler_columns(
    scalers: DataFrame, statics: Sequence[str] = (), keys: Sequence[str] = ("site_id",)
) -> DataFrame:
    """One row per group with ``<block>_mean`` and ``<block>_scale`` (a zero scale is 1)."""
    blocks = ["lag", "delta", *statics]
    wide = scalers.groupBy(*keys).pivot("block", blocks).agg(
        F.first("mean").alias("mean"), F.first("deviation").alias("scale")
    )
    return wide.select(
        *keys,
        *[F.col(f"{b}_mean") for b in blocks],
        *[
            F.when(F.col(f"{b}_scale") == 0, F.lit(1.0)).otherwise(F.col(f"{b}_scale")).alias(f"{b}_scale")
            for b in blocks
        ],
    )


def scale(
    df: DataFrame,
    scalers: DataFrame,
    statics: Sequence[str] = (),
    keys: Sequence[str] = ("site_id",),
) -> DataFrame:
    """Add scaled lags, deltas and statics; values that cannot be scaled become 0.

    A static unknown to the data counts as 0 before scaling.
    """
    out = df.join(per_key(scaler_columns(scalers, statics, keys)), list(keys))
    for c in statics:
        if c not in df.columns:
            out = out.withColumn(c, F.lit(0.0))

    def std(x, block):
        return finite((x - F.col(f"{block}_mean")) / F.col(f"{block}_scale"))

    return out.withColumns(
        {
            "scaled_lags": F.transform("lags", lambda x: std(x, "lag")),
            "scaled_deltas": F.transform(deltas(), lambda x: std(x, "delta")),
            "scaled_statics": F.array(
                *[std(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), c) for c in statics]
            ).cast("array<double>"),
        }
    )


def unscaled(scaled: Column, mean: Column, scale_: Column) -> Column:
    return F.transform(scaled, lambda x: x * scale_ + mean)


def design_vector(df: DataFrame, name: str = "features") -> DataFrame:
    """Flat features: scaled lags, time features step by step, scaled statics."""
    return df.withColumn(
        name, F.concat("scaled_lags", F.flatten("time_steps"), "scaled_statics")
    )


def sequence_matrix(df: DataFrame, name: str = "sequence") -> DataFrame:
    """Per step: scaled lag, time features, scaled statics."""
    return df.withColumn(
        name,
        F.zip_with(
            "scaled_lags", "time_steps", lambda x, t: F.concat(F.array(x), t, F.col("scaled_statics"))
        ),
    )


