"""Helpers shared by the text operators: narrow inputs, Arrow batches, shared storage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark alone (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **named: str) -> DataFrame:
    """Only the named columns, under fixed names, so that extra columns can't clash."""
    return df.select(*[df[c].alias(n) for n, c in named.items()])


def integers(df: DataFrame, col: str):
    """An id column as 64-bit integers; other kinds of ids are refused, as casting them would lose them."""
    kind = df.schema[col].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{col} must hold integers, not {kind}")
    return df[col].cast("long")


_held: dict[str, dict] = {}


def holds(owner: str) -> dict:
    """An empty table in which tasks of this owner may keep things; tasks of others that run in the same worker empty it."""
    return _held.setdefault(owner, {})


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str = "") -> Callable:
    """run, which gives the memory of its task back to the system when it ends (workers are used for many tasks)."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _only(owner)
        try:
            yield from run(batches)
        finally:
            _release()

    return whole


def _only(owner: str) -> None:
    for other, kept in _held.items():
        if other != owner:
            kept.clear()


def _release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def parts(batch: pa.RecordBatch, text: int, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with some size bytes of text (column number text) each, one row at least."""
    lens = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total, at = lens.cumsum(), 0
    while at < batch.num_rows:
        end = max(at + 1, int(total.searchsorted((total[at - 1] if at else 0) + size, side="right")))
        yield batch.slice(at, end - at)
        at = end


def arrow_map(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str, arrow: pa.Schema, owner: str = "") -> DataFrame:
    """Apply fn (columns as lists in, columns as lists out) to slices of every Arrow batch, cut by the bytes of column 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in parts(whole, 1) if pa.types.is_string(whole.schema.types[1]) else [whole]:
                out = fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(tidy(run, owner), schema)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session. Only a local master may go without: its one machine has its own folder."""
    sc = spark.sparkContext
    where = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not where:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="ledgerloom-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder and forget how it was made."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def collect(spark: SparkSession) -> None:
    """Have the driver find what nothing refers to any more, so that Spark removes the shuffle files of steps that cut() has ended."""
    gc.collect()
    spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark reaches."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def hold_out(id_col):
    """crc32(id as text) mod 3 = 1."""
    return F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 3 == 1
