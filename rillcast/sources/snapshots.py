"""Stored predictions by day, replaced by whole snapshots.

A write puts the merged rows of the days it touches into a folder of its own
and then names, in one small table, the folder of every day. That table comes
into place by one rename: until then readers see the snapshot before, and what
a failed write left behind is named nowhere. A day is one folder at any time,
so nothing has to be compacted.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillcast.operators.live import upsert
from rillcast.sources.staged import stage

DAYS = "day date, write string"
# A write touches so many days at most; their names pass the driver.
MOST_DAYS = 11_000


def _place(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    place, system = _place(spark, path)
    return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the snapshots there are, in order."""
    return sorted(int(n) for n in _names(spark, f"{path}/snapshots") if n.isdigit())


def snapshot_days(spark: SparkSession, path: str, number: int | None) -> DataFrame:
    """The days of a snapshot and the write that holds each; none for None."""
    if number is None:
        return spark.createDataFrame([], DAYS)
    return spark.read.schema(DAYS).parquet(f"{path}/snapshots/{number}")


def _rows(spark: SparkSession, path: str, days: DataFrame) -> DataFrame | None:
    folders = [f"{path}/data/write={r.write}/day={r.day}" for r in days.collect()]
    return spark.read.option("basePath", f"{path}/data").parquet(*folders).drop("write", "day") if folders else None


def stored_predictions(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None, snapshot: int | None = None
) -> DataFrame:
    """The predictions of the newest (or a given) snapshot; ``first`` and ``last`` name the days to read.

    Other days' files aren't opened. A store without a snapshot is an error,
    as a missing table is; days without predictions have no rows.
    """
    path = path.rstrip("/")
    there = snapshots(spark, path)
    if not there or (snapshot is not None and snapshot not in there):
        raise FileNotFoundError(f"no such snapshot of {path}")
    days = snapshot_days(spark, path, there[-1] if snapshot is None else snapshot)
    if first is not None:
        days = days.where(F.col("day") >= F.lit(first))
    if last is not None:
        days = days.where(F.col("day") <= F.lit(last))
    rows = _rows(spark, path, days)
    return spark.read.parquet(f"{path}/columns") if rows is None else rows


def upsert_predictions(incoming: DataFrame, path: str, number: int | None = None) -> int:
    """Merge predictions into the store as snapshot ``number`` (the next one if not given); the latest write per key wins.

    Only days (of the history's end) that the rows touch are read and written
    anew. A number that is there already is left alone, so a replayed stream
    batch changes nothing. One writer at a time. Returns the number.
    """
    spark, path = incoming.sparkSession, path.rstrip("/")
    there = snapshots(spark, path)
    if number is None:
        number = there[-1] + 1 if there else 0
    if number in there:
        return number
    before = max((n for n in there if n < number), default=None)
    fresh = stage(incoming.withColumn("day", F.to_date("history_end_time")))
    touched = [r.day for r in fresh.select("day").distinct().limit(MOST_DAYS + 1).collect()]
    if len(touched) > MOST_DAYS:
        raise ValueError(f"a write touches more than {MOST_DAYS} days")
    known = snapshot_days(spark, path, before)
    stored = _rows(spark, path, known.where(F.col("day").isin(touched)))
    rows = fresh.drop("day")
    rows.limit(0).write.mode("ignore").parquet(f"{path}/columns")
    merged = upsert(rows.limit(0) if stored is None else stored.select(*rows.columns), rows)
    name = uuid.uuid4().hex
    by_day = merged.withColumn("day", F.to_date("history_end_time")).hint("rebalance", F.col("day"))
    by_day.write.partitionBy("day").parquet(f"{path}/data/write={name}")
    now = known.where(~F.col("day").isin(touched)).unionByName(spark.createDataFrame([(d, name) for d in touched], DAYS))
    commit(now, path, number)
    return number


def commit(days: DataFrame, path: str, number: int) -> None:
    """Bring a snapshot into place by one rename."""
    spark = days.sparkSession
    days.coalesce(1).write.parquet(f"{path}/coming/{number}-{(name := uuid.uuid4().hex)}")
    coming, system = _place(spark, f"{path}/coming/{number}-{name}")
    place, _ = _place(spark, f"{path}/snapshots/{number}")
    system.mkdirs(place.getParent())
    if system.exists(place) or not system.rename(coming, place):
        raise RuntimeError(f"snapshot {number} of {path} is there already")


def drop_unused(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest snapshots and the writes that none of those names; returns the writes removed.

    Not while a write or a reader of an older snapshot is at work.
    """
    path = path.rstrip("/")
    there = snapshots(spark, path)
    used: set[str] = set()
    for number in there[-keep:]:
        used |= {r.write for r in snapshot_days(spark, path, number).select("write").distinct().collect()}
    unused = [n for n in _names(spark, f"{path}/data") if n.startswith("write=") and n.removeprefix("write=") not in used]
    for old in [f"snapshots/{n}" for n in there[:-keep]] + [f"data/{n}" for n in unused] + ["coming"]:
        place, system = _place(spark, f"{path}/{old}")
        system.delete(place, True)
    return unused

