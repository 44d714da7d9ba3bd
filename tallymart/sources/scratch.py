"""Intermediate tables in the folder that all executors share.

Some steps read an aggregated result several times (total, cut points, main
pass). Writing it once as Parquet cuts the lineage, survives the loss of an
executor, and lets the later reads prune columns and see true sizes.
"""

from __future__ import annotations

import contextlib
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local folder would be invisible to other executors.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallymart-")


def new_path(spark: SparkSession) -> str:
    """A place in the shared folder that nothing else uses; ``released`` deletes what is written there."""
    path = f"{scratch_root(spark).rstrip('/')}/tallymart/{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader over the files."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


@contextlib.contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables that are written inside the block, at its end.

    Frames that read them cannot be used afterwards. Only folders that this
    process made itself under names of its own are deleted.
    """
    kept = len(_written)
    try:
        yield
    finally:
        jvm = spark._jvm
        for path in _written[kept:]:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
        del _written[kept:]
