"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.session import scratch_path

#: A side is broadcast only if its measured size stays below this.
BROADCAST_BYTES = 32 << 20
#: Keys of one prefix-sum block (see ``prefix_sums``).
PREFIX_BLOCK = 1024
#: Texts are handled in slices of this size, so a task's memory does not follow its batches.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts the
    lineage, survives lost executors, and several consumers share one run.
    The schema is passed on, so an empty result stays readable."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def col(df: DataFrame, name: str) -> Column:
    """The column of that literal name, whatever characters it holds."""
    return df["`" + name.replace("`", "``") + "`"]


def small_enough(df: DataFrame, row_bytes: int) -> bool:
    """Whether ``df`` (a materialised table) may be broadcast."""
    return df.count() * row_bytes <= BROADCAST_BYTES


def maybe_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if small_enough(df, row_bytes) else df


def prefix_sums(sums: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all smaller ``key`` (a unique,
    non-negative integer such as a partition or file number).

    In two levels, so that no task sees all keys: running sums inside blocks of
    1024 keys, plus the running sum of the block totals."""
    blocks = sums.withColumn("_block", F.floor(F.col(key) / PREFIX_BLOCK))
    totals = blocks.groupBy("_block").agg(F.sum(value).alias("_total"))
    before = totals.select("_block", (F.sum("_total").over(Window.orderBy("_block")) - F.col("_total")).alias("_base"))
    inside = F.sum(value).over(Window.partitionBy("_block").orderBy(key)) - F.col(value)
    return (blocks.withColumn("_inside", inside).join(before, "_block")
            .withColumn(out, F.col("_base") + F.col("_inside")).drop("_block", "_inside", "_base"))


def release() -> None:
    """Hand freed memory back to the machine: workers live on and share an
    executor's memory with the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text each (one row at least)."""
    begin, held = 0, 0
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for i, size in enumerate(sizes):
        if i > begin and held + size > most:
            yield begin, i
            begin, held = i, 0
        held += int(size)
    if len(texts) > begin:
        yield begin, len(texts)
    release()


def by_file(index: DataFrame, most_tasks: int = 20_000) -> DataFrame:
    """Deal index rows (file, byte_offset, ...) to tasks by file, each file's in
    order. One task per file, as index rows are far smaller than what they point
    to: their own size must not decide how many tasks read the files."""
    n = min(most_tasks, max(1, index.select("file").distinct().count()))
    return index.repartition(n, "file").sortWithinPartitions("file", "byte_offset")


def filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The store behind a path of the shared folder (file:, hdfs:, s3: ...)."""
    if "://" in uri or uri.startswith("file:"):
        return pa.fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[len("file:"):])
    return pa.fs.LocalFileSystem(), uri
