"""Tables on shared storage: scans, training files, metrics, registry, stream output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillcast.config import Target
from rillcast.operators.live import CSV_COLUMNS, PREDICTION_KEY
from rillcast.operators.samples import from_columns, to_columns
from rillcast.sources.staged import stage

METRIC_SCHEMA = (
    "site_id int, season string, rmse double, mae double, persistence_rmse double, "
    "persistence_mae double, rmse_skill_vs_persistence double, mae_skill_vs_persistence double"
)


def scan(
    spark: SparkSession, path: str, columns: Sequence[str] = ("*",), where: str | None = None
) -> DataFrame:
    """Parquet scan; the projection and the filter reach the reader."""
    df = spark.read.parquet(path)
    return (df.where(where) if where else df).select(*columns)


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str] = ("*",),
    where: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Relational scan; ``split`` = (column, lower, upper, partitions) reads in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if split:
        column, lower, upper, n = split
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(n))
        )
    df = reader.load()
    return (df.where(where) if where else df).select(*columns)


def append_staging(rows: DataFrame, path: str) -> None:
    """Append one load to the staging table, by site and sorted by variable and time.

    Site filters prune folders, variable and time filters row groups. The
    rebalance splits a hot site and joins small ones.
    """
    (
        rows.withColumn("loaded_at", F.localtimestamp())
        .hint("rebalance", F.col("site_code"))
        .sortWithinPartitions("site_code", "variable_code", "datetime_utc")
        .write.mode("append")
        .partitionBy("site_code")
        .parquet(path)
    )


def write_facts(facts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Fact table by site and year, sorted by series and time inside a file.

    Site and time filters prune folders and row groups. The rebalance lets the
    shuffle split a hot site and join small ones, so files have an even size.
    """
    (
        facts.withColumn("year", F.year("datetime_utc"))
        .hint("rebalance", F.col("site_id"), F.col("year"))
        .sortWithinPartitions("site_id", "year", "variable_id", "datetime_utc")
        .write.mode(mode)
        .partitionBy("site_id", "year")
        .parquet(path)
    )


def write_training(
    samples: DataFrame, target: Target, path: str, lags: int, horizons: int, mode: str = "overwrite"
) -> None:
    """Training files with named lag and target columns, one folder per site.

    The samples are staged and checked first: an empty build fails and leaves
    the files of the last one as they are.
    """
    wide = stage(to_columns(samples, target.main.name, lags, horizons))
    if wide.isEmpty():
        raise ValueError(f"no {target.name} samples to write to {path}")
    # The rebalance splits a large site over several tasks and files.
    (
        wide.hint("rebalance", F.col("site_id"))
        .write.mode(mode)
        .partitionBy("site_id")
        .parquet(path)
    )


def audit(df: DataFrame, keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """Rows per site and the number of columns of a written data set."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len([c for c in df.columns if c not in ("source_path", "source_mtime")]))
    )


def load_training(spark: SparkSession, pattern: str) -> DataFrame:
    """All files of a path pattern, columns matched by name, tagged with path and file time."""
    try:
        df = spark.read.option("mergeSchema", "true").parquet(pattern)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no parquet files match {pattern}") from e
        raise
    return df.withColumns(
        {
            "source_path": F.col("_metadata.file_path"),
            "source_mtime": F.unix_micros("_metadata.file_modification_time") / 1e6,
        }
    )


def load_samples(spark: SparkSession, pattern: str, prefix: str, lags: int, horizons: int) -> DataFrame:
    return from_columns(load_training(spark, pattern), prefix, lags, horizons)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def read_metrics(spark: SparkSession, path: str, schema: str = METRIC_SCHEMA) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)


def append_predictions_csv(rows: DataFrame, path: str) -> None:
    """Append the CSV copy of predictions; every part file has the header line."""
    rows.select(*CSV_COLUMNS).write.mode("append").option("header", "true").csv(path)


def write_predictions_csv(rows: DataFrame, path: str) -> None:
    """The CSV copy of one batch, replacing what an earlier attempt left."""
    rows.select(*CSV_COLUMNS).write.mode("overwrite").option("header", "true").csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").partitionBy(*partition_by).json(path)


# Fields of a model document.
MODEL_SCHEMA = (
    "target_variable string, target_units string, site_id int, season string, "
    "best_model_path string, validation_start string, validation_end string, train_rows long, "
    "validation_rows long, lag_cols array<string>, target_cols array<string>, "
    "target_transform string, residual_base_col string, variation_clip_enabled boolean, "
    "variation_clip_pct double, variation_clip_history_multiplier double, "
    "variation_clip_absolute_floor double, static_feature_cols array<string>, "
    "temporal_sequence_feature_names array<string>, lag_scaler_mean array<double>, "
    "lag_scaler_scale array<double>, static_scaler_mean array<double>, "
    "static_scaler_scale array<double>, target_scaler_mean array<double>, "
    "target_scaler_scale array<double>, slopes array<double>, intercepts array<double>"
)


def registry(
    spark: SparkSession, pattern: str, schema: str = MODEL_SCHEMA, one_per_file: bool = True
) -> DataFrame:
    """All model documents under a path pattern as one table; fails when there is none.

    Also reads plain metadata documents without coefficients (those stay null).
    ``one_per_file`` off reads one document per line.
    """
    try:
        df = spark.read.schema(schema).option("multiLine", str(one_per_file).lower()).json(pattern)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no model documents match {pattern}") from e
        raise
    out = df.withColumns(
        {
            "document": F.col("_metadata.file_path"),
            "model_path": F.coalesce("best_model_path", F.col("_metadata.file_path")),
        }
    )
    if out.isEmpty():
        raise FileNotFoundError(f"no model documents match {pattern}")
    return out


def append_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Store one stream batch under its id. A replayed batch replaces itself."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the stored batches that were written to their end, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    folders = [s.getPath() for s in system.listStatus(place) if s.getPath().getName().startswith("batch_id=")]
    whole = [f for f in folders if system.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(int(f.getName().removeprefix("batch_id=")) for f in whole)


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch_id={batch_id}")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def current_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The latest stored prediction per key: later batches win, then the larger source id."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in (*PREDICTION_KEY, "batch_id")]
    return (
        df.groupBy(*PREDICTION_KEY)
        .agg(F.max_by(F.struct(*rest), F.struct("batch_id", "source_datastream_id")).alias("_row"))
        .select(*PREDICTION_KEY, "_row.*")
    )


def save_state(spark: SparkSession, path: str, key: str, value: str) -> None:
    """Append a key/value progress record; the newest one counts."""
    row = spark.range(1).select(
        F.lit(key).alias("state_key"), F.lit(value).alias("state_value"), F.localtimestamp().alias("updated_at")
    )
    row.coalesce(1).write.mode("append").parquet(path)


def load_state(spark: SparkSession, path: str, key: str) -> str | None:
    try:
        df = spark.read.schema("state_key string, state_value string, updated_at timestamp_ntz").parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    row = df.where(F.col("state_key") == key).agg(F.max_by("state_value", "updated_at")).first()
    return row[0]
