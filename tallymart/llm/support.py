"""What the operators share: reading tables, shipping code, shared files, ragged arrays."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.sources import scratch
from tallymart.sources.scratch import new_path as scratch_path
from tallymart.sources.scratch import scratch_root

__all__ = [
    "binary_values",
    "columns",
    "filesystem",
    "frugal",
    "kept",
    "materialise",
    "ragged",
    "scratch_path",
    "scratch_root",
    "ship",
    "slices",
    "table",
    "text_or_empty",
]


# Bytes of text that a task works on at a time.
SLICE_BYTES = 4 << 20


def materialise(df: DataFrame) -> DataFrame:
    """A stored copy in the shared folder; Zstandard keeps it small."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    try:
        return scratch.materialise(df)
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", before)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Without it Python workers find the package only if they happen to start in
    its folder.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tallymart-code-")) / "tallymart_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """The named columns at fixed types; whatever else ``df`` carries is left behind."""
    return df.select(*[df[name].cast(kind).alias(name) for name, kind in wanted.items()])


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


@cache
def _trim() -> Callable[[int], object]:
    """What gives freed memory back; where the C library can, freed blocks of a megabyte go back at once."""
    try:
        library = ctypes.CDLL(None)
        library.mallopt(-3, 1 << 20)
        return library.malloc_trim
    except (AttributeError, OSError):
        return lambda _: None


def _release() -> None:
    pa.default_memory_pool().release_unused()
    _trim()(0)


_kept: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps from one task to the next: one thing, dropped before another is made."""
    if key not in _kept:
        _kept.clear()
        _release()
        _kept[key] = make()
    return _kept[key]


def frugal(work: Work, keeps: bool = False) -> Work:
    """``work``, in Python workers that keep no freed memory from one batch, or one task, to the next.

    Unless ``work`` itself ``keeps`` something, it starts without what tasks of other operators have kept.
    """

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            _release()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            _kept.clear()
        _trim()
        yield from work(released(batches))
        _release()

    return run


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch's rows in order, some at a time: about ``size`` bytes of a column, or one longer value."""
    lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(lengths, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(batch)]
    for begin, end in zip(cuts, cuts[1:]):
        yield batch.slice(begin, end - begin)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The shared file system of a folder, and the folder's path there."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "", 1))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i], starts[i]+1, ...`` (``lengths[i]`` of them) for all i in order."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def binary_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array without nulls, and its offsets from 0."""
    kind = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if kind else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    values = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values[offsets[0] : offsets[-1]] if len(column) else values[:0], offsets - offsets[0]
