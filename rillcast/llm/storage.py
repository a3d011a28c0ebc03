"""Files that tasks write themselves, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from rillcast.session import checkpoint_dir


def new_folder(spark: SparkSession, prefix: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def filesystem(uri: str):
    """Arrow file system and path of a URI; a bare path is a local one."""
    from pyarrow import fs

    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def open_output(uri: str):
    """Open a file for writing, its folder included. Callers give each attempt a name of its own."""
    system, path = filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


def open_input(uri: str):
    system, path = filesystem(uri)
    return system.open_input_file(path)
