"""Intermediate results written once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rillcast.session import checkpoint_dir


# Folders of the jobs that run now, the innermost last.
_folders: list[str] = []


@contextmanager
def job(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """A job whose staged tables lie in one folder, removed when the job ends.

    What the job returns must be written or collected inside. One job of a
    driver runs at a time; jobs may be nested.
    """
    path = f"{(folder or checkpoint_dir(spark)).rstrip('/')}/job-{uuid.uuid4().hex}"
    _folders.append(path)
    try:
        yield path
    finally:
        _folders.remove(path)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write an intermediate result once and go on from the written table.

    For results used more than once. The files lie in the shared checkpoint
    folder, so lost executors cost a task, not the lineage behind it; their
    size also tells the planner which joins may broadcast. Inside :func:`job`
    they go when the job ends.
    """
    spark = df.sparkSession
    folder = _folders[-1] if _folders else checkpoint_dir(spark).rstrip("/")
    path = f"{folder}/stage-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_key(df: DataFrame) -> DataFrame:
    """Stage a table with one row per series before it is joined to the series' rows.

    Unwritten, its size is unknown when the join is planned and the large side
    would be shuffled by series, a hot one into few tasks. Written, a table
    below the broadcast threshold is broadcast and the large side stays where
    it is; above it the join falls back to a shuffle with skew splitting.
    """
    return stage(df)
