"""Ridge forecasters of all groups by mergeable normal equations.

What a least-squares fit needs of its samples is a sum over them: products of
every two features and of every feature with every target. Tasks add these up
for the groups they see, one aggregate adds the tasks' sums, and one small
system a group is solved; no sample is moved.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from rillcast.config import Clip
from rillcast.functions.vectors import CYCLIC
from rillcast.operators.models import GROUP, with_forecasts
from rillcast.sources.staged import per_key

# Groups whose sums a task holds before it hands them on.
HELD_GROUPS = 64
WAVES = len(CYCLIC) - 1


def forecast_features(df: DataFrame, name: str = "features") -> DataFrame:
    """The design of a forecaster: scaled lags, the six time waves of the newest step, scaled statics."""
    waves = F.slice(F.element_at("time_steps", -1), 1, WAVES)
    return df.withColumn(name, F.concat("scaled_lags", waves, "scaled_statics"))


def complete(values: str) -> Column:
    """Whether an array is there and has a finite value everywhere."""
    return F.col(values).isNotNull() & ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def moments(train: DataFrame, keys: Sequence[str], features: str, label: str) -> DataFrame:
    """keys, n, wide (features and the constant), deep (targets), and per place of the packed sums its value.

    Packed are the upper triangle of the features' products row by row, the
    constant first, then their products with the targets.
    """
    named = [train.schema[k] for k in keys]
    schema = StructType([*named, StructField("wide", IntegerType()), StructField("deep", IntegerType()), StructField("n", LongType()), StructField("sums", ArrayType(DoubleType()))])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def told() -> pa.RecordBatch:
            groups = pa.Table.from_pylist([dict(zip(keys, k[: len(keys)])) for k in held], pa.schema([(k, kinds[k]) for k in keys]))
            rest = [
                pa.array([k[-2] for k in held], pa.int32()), pa.array([k[-1] for k in held], pa.int32()), pa.array([n for n, _ in held.values()], pa.int64()),
                pa.array([s for _, s in held.values()], pa.list_(pa.float64())),
            ]
            return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in groups.columns), *rest], names=[*keys, "wide", "deep", "n", "sums"])

        kinds = {}
        for batch in batches:
            kinds = {k: batch.schema.field(k).type for k in keys}
            rows = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            codes = {g: i for i, g in enumerate(dict.fromkeys(rows))}
            code = np.array([codes[r] for r in rows], np.int64)
            xs, ys = batch.column(features), batch.column(label)
            wide, deep = (c.value_lengths().to_numpy(zero_copy_only=False) for c in (xs, ys))
            for group, i in codes.items():
                for p, h in {(p, h) for p, h in zip(wide[code == i].tolist(), deep[code == i].tolist())}:
                    at = pa.array(np.flatnonzero((code == i) & (wide == p) & (deep == h)))
                    x = xs.take(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
                    y = ys.take(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, h)
                    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
                    sums = np.concatenate([(x.T @ x)[np.triu_indices(p + 1)], (x.T @ y).ravel()])
                    n, before = held.get((*group, p + 1, h), (0, 0.0))
                    held[(*group, p + 1, h)] = [n + len(x), before + sums]
            if len(held) > HELD_GROUPS:
                yield told()
                held.clear()
        if held:
            yield told()

    rows = train.where(complete(features) & complete(label)).select(*keys, F.col(features).cast("array<double>").alias(features), F.col(label).cast("array<double>").alias(label))
    parts = rows.mapInArrow(run, schema).select(*keys, "wide", "deep", "n", F.posexplode("sums").alias("place", "value"))
    return parts.groupBy(*keys, "wide", "deep", "place").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))


def solved(packed: np.ndarray, wide: int, deep: int, alpha: float) -> np.ndarray:
    """Coefficients (targets by features, the constant first); the constant isn't shrunk."""
    triangle = wide * (wide + 1) // 2
    a = np.zeros((wide, wide))
    a[np.triu_indices(wide)] = packed[:triangle]
    a = np.triu(a) + np.triu(a, 1).T
    b = packed[triangle:].reshape(wide, deep)
    a[np.arange(1, wide), np.arange(1, wide)] += alpha
    try:
        low = np.linalg.cholesky(a)
        return np.linalg.solve(low.T, np.linalg.solve(low, b)).T
    except np.linalg.LinAlgError:
        # Features that depend on each other, with nothing to shrink them: the shortest solution.
        return np.linalg.lstsq(a, b, rcond=None)[0].T


def fit_ridge(train: DataFrame, keys: Sequence[str] = GROUP, features: str = "features", label: str = "scaled_deltas", alpha: float = 1.0) -> DataFrame:
    """keys, n and coefficients (per horizon: constant, then one a feature) of every group.

    Minimises the squares plus ``alpha`` times the squared coefficients, all
    horizons at once. Samples with a missing or infinite feature or target are
    left out; a group whose samples differ in length is refused.
    """
    named = [train.schema[k] for k in keys]
    schema = StructType([*named, StructField("n", LongType()), StructField("coefficients", ArrayType(ArrayType(DoubleType())))])
    sums = moments(train, keys, features, label)
    # As many values a group as its design has pairs, however many samples there are.
    packed = sums.groupBy(*keys).agg(
        F.max("n").alias("n"), F.max("wide").alias("wide"), F.max("deep").alias("deep"),
        F.count_distinct("wide", "deep").alias("shapes"), F.sort_array(F.collect_list(F.struct("place", "value"))).alias("cells"),
    ).select(*keys, "n", "wide", "deep", "shapes", F.col("cells.value").alias("packed"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if any(s > 1 for s in batch.column("shapes").to_pylist()):
                raise ValueError("samples of one group differ in length")
            shapes = zip(batch.column("packed"), batch.column("wide").to_pylist(), batch.column("deep").to_pylist())
            found = [solved(p.values.to_numpy(zero_copy_only=False), w, d, alpha).tolist() for p, w, d in shapes]
            columns = [*(batch.column(k) for k in keys), batch.column("n"), pa.array(found, pa.list_(pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "n", "coefficients"])

    return packed.mapInArrow(run, schema)


def ridge_deltas(features: str = "features") -> Column:
    """Predicted deltas of a row that has its group's coefficients."""

    def dot(c: Column) -> Column:
        terms = F.zip_with(F.slice(c, F.lit(2), F.size(c) - 1), F.col(features), lambda a, x: a * x)
        return F.aggregate(terms, F.element_at(c, 1), lambda s, t: s + t)

    return F.transform("coefficients", dot)


def score_ridge(
    df: DataFrame, registry: DataFrame, horizons: int, clip: Clip = Clip(), keys: Sequence[str] = GROUP, features: str = "features", scaled: bool = True
) -> DataFrame:
    """Forecasts of every sample that has a model; ``scaled`` models predict scaled deltas."""
    joined = df.join(per_key(registry.drop("n")), list(keys))
    found = ridge_deltas(features)
    if scaled:
        found = F.transform(found, lambda d: d * F.col("delta_scale") + F.col("delta_mean"))
    return with_forecasts(joined, found, clip, horizons).drop("coefficients")
