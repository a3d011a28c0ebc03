"""Checks: the stream over the same events, file by file."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.inputs import LIVE_HORIZONS, OBS, live_registry
from checks.live_queries import FORECAST, LIVE_CLIP, ON_HOUR, PRED_COLUMNS, events
from checks.registry import check, r, rsql

from rillcast.session import checkpoint_dir
from rillcast.sources.snapshots import stored_predictions
from rillcast.streaming import live as stream

# Files at least, and rows of a file at most (about).
PARTS, FILE_ROWS = 4, 1 << 21


def _arrivals(spark, sf_dir):
    """All events written as several files in id order, as they would arrive.

    A file holds a range of ids. The stream takes the oldest files first, and
    tasks end in any order: the files are dated by their ranges.
    """
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    e = events(spark, sf_dir)
    parts = max(PARTS, -(-e.count() // FILE_ROWS))
    e.repartitionByRange(parts, "datastream_id").sortWithinPartitions("datastream_id").write.parquet(f"{base}/events")
    _date_by_name(spark, f"{base}/events")
    return base


def _date_by_name(spark, path):
    """Date the files of a folder a second apart in the order of their names, which is that of their partitions."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((s for s in system.listStatus(place) if s.getPath().getName().startswith("part-")), key=lambda s: s.getPath().getName())
    newest = max((s.getModificationTime() for s in files), default=0)
    for k, file in enumerate(files):
        system.setTimes(file.getPath(), newest - 1000 * (len(files) - 1 - k), -1)


ARRIVAL = f"""{OBS},
arrived AS (SELECT *, coalesce(datetime_utc > max(datetime_utc) OVER (PARTITION BY site_id, variable_id ORDER BY datastream_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS is_newest FROM obs)"""


@check("stream_gate", f"WITH {ARRIVAL} SELECT datastream_id, site_id, variable_id, datetime_utc, is_newest FROM arrived")
def _(spark, sf_dir):
    base = _arrivals(spark, sf_dir)
    arriving = stream.read_events(spark, f"{base}/events", 1)
    stream.start(arriving, stream.judge_into(base), f"{base}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{base}/judged").select(
        "datastream_id", "site_id", "variable_id", "datetime_utc", "is_newest"
    )


ARRIVED_FORECAST = FORECAST + f""",
arrived AS (SELECT *, coalesce(datetime_utc > max(datetime_utc) OVER (PARTITION BY site_id, variable_id ORDER BY datastream_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS is_newest FROM obs)
SELECT {PRED_COLUMNS}, {rsql("prediction", "prediction")} FROM pred
SEMI JOIN (SELECT datastream_id AS source_datastream_id FROM arrived WHERE is_newest AND {ON_HOUR}) USING (source_datastream_id)"""


@check("stream_forecast", f"WITH {ARRIVED_FORECAST}")
def _(spark, sf_dir):
    base = _arrivals(spark, sf_dir)
    stream.write_observations(events(spark, sf_dir), f"{base}/observations")
    handler = stream.Forecaster(
        f"{base}/observations", live_registry(spark), f"{base}/out", horizons=LIVE_HORIZONS, clip=LIVE_CLIP
    )
    stream.start(stream.read_events(spark, f"{base}/events", 2), handler, f"{base}/checkpoint", once=True).awaitTermination()
    rows = stored_predictions(spark, f"{base}/out/predictions")
    return rows.select(*PRED_COLUMNS.split(", "), r("prediction").alias("prediction"))




# Half of the events are stored before the stream starts: their times hold events of the other half back.
HISTORY_FORECAST = FORECAST + f""",
cut AS (SELECT (max(datastream_id) + 1) // 2 AS half FROM obs),
arrived AS (
  SELECT o.datastream_id AS source_datastream_id, o.datetime_utc > coalesce(greatest(
      (SELECT max(h.datetime_utc) FROM obs h, cut WHERE h.datastream_id < half AND h.site_id = o.site_id AND h.variable_id = o.variable_id),
      max(o.datetime_utc) OVER (PARTITION BY o.site_id, o.variable_id ORDER BY o.datastream_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    TIMESTAMP '0001-01-01') AS is_newest, o.datetime_utc
  FROM obs o, cut WHERE o.datastream_id >= half)
SELECT {PRED_COLUMNS}, {rsql("prediction", "prediction")} FROM pred
SEMI JOIN (SELECT source_datastream_id FROM arrived WHERE is_newest AND {ON_HOUR}) USING (source_datastream_id)"""


@check("stream_on_history", f"WITH {HISTORY_FORECAST}")
def _(spark, sf_dir):
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    e = events(spark, sf_dir)
    at = (e.agg(F.max("datastream_id")).first()[0] + 1) // 2
    # The first half is stored; the stream stores the second as it arrives.
    stream.write_observations(e.where(F.col("datastream_id") < at), f"{base}/observations")
    e.where(F.col("datastream_id") >= at).write.parquet(f"{base}/events")
    handler = stream.Forecaster(
        f"{base}/observations", live_registry(spark), f"{base}/out", horizons=LIVE_HORIZONS, clip=LIVE_CLIP,
        history=spark.read.parquet(f"{base}/observations"), store_events=True,
    )
    stream.start(stream.read_events(spark, f"{base}/events", 250), handler, f"{base}/checkpoint", once=True).awaitTermination()
    rows = stored_predictions(spark, f"{base}/out/predictions")
    return rows.select(*PRED_COLUMNS.split(", "), r("prediction").alias("prediction"))
