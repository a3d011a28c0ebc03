"""Live forecasting on Structured Streaming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from rillcast.config import Clip, Grid
from rillcast.functions.timeaxis import floor_div, on_grid, shift, tick_of
from rillcast.operators import live
from rillcast.operators.scan import largest_before
from rillcast.sources.snapshots import upsert_predictions
from rillcast.sources.staged import job, stage
from rillcast.sources.tables import append_batch, batches, drop_batch, write_predictions_csv

SERIES = ("site_id", "variable_id")
# Stored observations: buckets of series, ticks of a span, and places that are named in a filter at most.
BUCKETS, SPAN, MOST_PLACES = 64, 2048, 4096

EVENT_SCHEMA = StructType(
    [
        StructField("datastream_id", LongType()),
        StructField("site_id", IntegerType()),
        StructField("variable_id", IntegerType()),
        StructField("variable_code", StringType()),
        StructField("datetime_utc", TimestampNTZType()),
        StructField("value", DoubleType()),
    ]
)
JUDGED_SCHEMA = StructType([*EVENT_SCHEMA.fields, StructField("is_newest", BooleanType())])
LATEST_SCHEMA = "site_id int, variable_id int, latest timestamp_ntz"


class NewestGuard:
    """Flags the rows of a batch that come after every earlier row of their series.

    What is known of a series is its latest time. It is kept as a table of one
    row per series below ``path``, a snapshot per batch id: batch n starts from
    the newest snapshot before n, so a replayed batch is judged as it was. The
    first batch starts from ``history``, the observations stored before.
    Rows are judged in id order, the order of arrival, by running maxima over
    blocks of ids: a series may have any number of rows in a batch.
    """

    def __init__(self, path: str, history: DataFrame | None = None, block: int = 4096):
        self.path, self.history, self.block = path.rstrip("/"), history, block

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Latest times (column ``latest``) before a batch."""
        older = [n for n in batches(spark, self.path) if n < batch_id]
        if older:
            return spark.read.schema(LATEST_SCHEMA).parquet(f"{self.path}/batch_id={older[-1]}")
        if self.history is None:
            return None
        # Kept as the snapshot before all batches: the history may hold the batch's own rows when it is replayed.
        append_batch(self.history.groupBy(*SERIES).agg(F.max("datetime_utc").alias("latest")), self.path, -1)
        return spark.read.schema(LATEST_SCHEMA).parquet(f"{self.path}/batch_id=-1")

    def judge(self, batch: DataFrame, known: DataFrame | None) -> DataFrame:
        """The rows with ``is_newest``; rows without a time never are and move nothing."""
        times = None if known is None else known.withColumnRenamed("latest", "datetime_utc")
        found = largest_before(batch, SERIES, "datastream_id", "datetime_utc", "_before", times, self.block)
        newest = F.col("datetime_utc").isNotNull() & (F.col("_before").isNull() | (F.col("datetime_utc") > F.col("_before")))
        return found.withColumn("is_newest", newest).select(*(f.name for f in JUDGED_SCHEMA.fields))

    def advance(self, judged: DataFrame, known: DataFrame | None, batch_id: int) -> None:
        """Store the latest times after a batch and drop snapshots older than the one it started from."""
        times = judged.select(*SERIES, F.col("datetime_utc").alias("latest"))
        both = times if known is None else times.unionByName(known)
        append_batch(both.groupBy(*SERIES).agg(F.max("latest").alias("latest")), self.path, batch_id)
        for old in [n for n in batches(judged.sparkSession, self.path) if n < batch_id][:-1]:
            drop_batch(judged.sparkSession, self.path, old)


def judge_into(path: str, history: DataFrame | None = None):
    """Handler that stores every batch of events with the guard's verdict."""
    guard = NewestGuard(f"{path}/latest", history)

    def handle(batch: DataFrame, batch_id: int) -> None:
        known = guard.before(batch.sparkSession, batch_id)
        append_batch(guard.judge(batch, known), f"{path}/judged", batch_id)
        guard.advance(batch.sparkSession.read.parquet(f"{path}/judged/batch_id={batch_id}"), known, batch_id)

    return handle


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 250) -> DataFrame:
    """New observation files as a stream, oldest first."""
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("maxFilesPerTrigger", str(files_per_trigger))
        .parquet(path)
    )


def with_reason(judged: DataFrame, registry: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Stream twin of the batch gate: the verdict comes from the state."""
    routed = live.route(live.with_target(live.forecast_season(judged, grid)), registry)
    return routed.withColumn(
        "reason",
        F.when(F.col("datetime_utc").isNull(), F.lit("no_time"))
        .when(~on_grid("datetime_utc", grid), F.lit("not_exact_hour"))
        .when(F.col("target_variable").isNull(), F.lit("no_target"))
        .when(~F.col("is_newest"), F.lit("not_newer"))
        .when(F.col("model_path").isNull(), F.lit("no_model"))
        .otherwise(F.lit("accepted")),
    )


def observations_near(
    table: DataFrame, accepted: DataFrame, lags: int, grid: Grid, contexts: Mapping[str, Sequence[live.Context]] = live.CONTEXTS
) -> DataFrame | None:
    """The part of the observation table a batch can need, None if it needs none.

    Of a table stored by :func:`write_observations` only the spans of the
    series that are asked for are read: a late event of one series doesn't
    make the others' history be read. Any other table gets one time range for
    all series, reaching back over the lags or the longest context window.
    """
    if {"bucket", "span"} <= set(table.columns):
        asked = live.requests(accepted, lags, grid, contexts)
        place = asked.select(
            series_bucket().alias("bucket"), F.explode(F.sequence(floor_div(F.col("lo"), SPAN), floor_div(F.col("hi"), SPAN))).alias("span")
        ).distinct()
        places = place.limit(MOST_PLACES + 1).collect()
        if not places:
            return None
        if len(places) > MOST_PLACES:
            return table.join(place, ["bucket", "span"], "left_semi")
        wanted: dict[int, list[int]] = {}
        for r in places:
            wanted.setdefault(r.bucket, []).append(r.span)
        kept = F.lit(False)
        for bucket, spans in sorted(wanted.items()):
            kept = kept | ((F.col("bucket") == bucket) & F.col("span").isin(sorted(spans)))
        return table.where(kept)
    lags = max([lags, *(c.window for cs in contexts.values() for c in cs)])
    ends = accepted.agg(F.min("datetime_utc").alias("a"), F.max("datetime_utc").alias("b")).select(
        shift("a", -lags, grid).alias("a"), "b"
    ).first()
    if ends.a is None:
        return None
    return table.where(
        (F.col("datetime_utc") > F.lit(ends.a)) & (F.col("datetime_utc") <= F.lit(ends.b))
    )


def series_bucket():
    return F.pmod(F.xxhash64("site_id", "variable_code"), F.lit(BUCKETS)).cast("int")


def write_observations(rows: DataFrame, path: str, grid: Grid = Grid(), batch_id: int = -1) -> None:
    """Store observations by bucket of series and span of ticks; a batch written again replaces itself.

    Rows without a time can't be looked up and aren't stored.
    """
    exact = grid if grid.label == "end" else Grid(grid.step, "end", grid.block)
    placed = rows.where("datetime_utc IS NOT NULL").withColumns({"bucket": series_bucket(), "span": floor_div(tick_of("datetime_utc", exact), SPAN)})
    placed.repartition("bucket", "span").write.mode("overwrite").partitionBy("bucket", "span").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


class Forecaster:
    """What happens to one batch of events: judged, forecast, stored.

    The judged batch is written first and read back, so the forecast work
    starts from a table; writes carry the batch id, so a replayed batch
    replaces itself, and the prediction store takes a batch once. Events that
    cannot be forecast go to the rejects with their reason. With
    ``store_events`` a batch's own events join the observations (a table of
    :func:`write_observations`) before it is forecast.
    """

    def __init__(
        self,
        observations: str,
        registry: DataFrame,
        out: str,
        lags: int = 168,
        horizons: int = 24,
        max_gap: int = 10,
        clip: Clip = Clip(),
        grid: Grid = Grid(),
        csv: str | None = None,
        history: DataFrame | None = None,
        store_events: bool = False,
    ):
        self.observations, self.registry, self.out = observations, registry, out.rstrip("/")
        self.lags, self.horizons, self.max_gap = lags, horizons, max_gap
        self.clip, self.grid, self.csv, self.store_events = clip, grid, csv, store_events
        self.guard = NewestGuard(f"{self.out}/latest", history)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with job(batch.sparkSession, self.out):
            self.forecast(self.judged(batch, batch_id), batch_id)

    def judged(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        known = self.guard.before(spark, batch_id)
        append_batch(with_reason(self.guard.judge(batch, known), self.registry, self.grid), f"{self.out}/judged", batch_id)
        judged = spark.read.parquet(f"{self.out}/judged/batch_id={batch_id}")
        self.guard.advance(judged, known, batch_id)
        if self.store_events:
            # An event with several models is one observation.
            write_observations(judged.select(*live.EVENT_COLUMNS).distinct(), self.observations, self.grid, batch_id)
        return judged

    def forecast(self, judged: DataFrame, batch_id: int) -> None:
        spark = judged.sparkSession
        rejects = judged.where("reason <> 'accepted'").select(*live.EVENT_COLUMNS, "target_variable", "reason")
        accepted = judged.where("reason = 'accepted'")
        near = observations_near(spark.read.parquet(self.observations), accepted, self.lags, self.grid)
        if near is None:
            append_batch(rejects, f"{self.out}/rejects", batch_id)
            return
        features = live.event_features(accepted, near, self.lags, self.max_gap, self.grid)
        append_batch(features, f"{self.out}/features", batch_id)
        features = spark.read.parquet(f"{self.out}/features/batch_id={batch_id}")
        failed = features.where("failure IS NOT NULL").select(
            *live.EVENT_COLUMNS, "target_variable", F.col("failure").alias("reason")
        )
        append_batch(rejects.unionByName(failed), f"{self.out}/rejects", batch_id)
        # The whole feature row is stored: own columns of the event and routing are not part of it.
        apart = {*live.EVENT_COLUMNS, "is_newest", "target_variable", "model_path", "reason", "failure", "longest_gap"}
        columns = ["site_id", *(c for c in features.columns if c not in apart)]
        rows = live.forecast_rows(
            features, self.registry, self.horizons, self.clip, self.grid, json_columns=columns
        ).withColumn("created_at", F.localtimestamp())
        if self.csv:
            rows = stage(rows)
            # Below the batch id, so a replayed batch replaces its rows here too.
            write_predictions_csv(rows, f"{self.csv}/batch_id={batch_id}")
        upsert_predictions(rows, f"{self.out}/predictions", batch_id)


def start(events: DataFrame, handler, checkpoint: str, once: bool = False, every: str = "5 seconds"):
    """Start the query; ``once`` processes what is there and ends."""
    writer = events.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()
