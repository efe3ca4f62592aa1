"""Raw export scans (S1, S2), in either of two layouts.

* "partition": one directory of parquet per day, ``<root>/event_date=yyyyMMdd``.
  A shard range becomes a partition filter on the string column, so only the
  chosen days are listed and read (``PartitionFilters`` in the plan).
* "suffix": one directory per table, ``<root>/events_yyyyMMdd``, as the export
  names its tables; ``events_intraday_yyyyMMdd`` stands beside them. A range
  compares the suffix as a string, so that the unfinished intraday tables fall
  outside any range of days. The driver lists the names and reads the chosen
  folders only; each row's suffix comes from its file's path (``SUFFIX``).

Event-name predicates become parquet ``PushedFilters``; nested column pruning
reads only the struct leaves a query touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schema import RAW_EVENT_SCHEMA
from touchline.sources.files import folder_state, list_names, move_folder

PARTITION_COLUMN = "event_date"
# The suffix layout's pseudo-column and the prefix of its folders (fixed: the export's names).
SUFFIX = "_table_suffix"
SUFFIX_PREFIX = "events_"


def read_raw(spark: SparkSession, path: str, schema=RAW_EVENT_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def layout_of(spark: SparkSession, path: str) -> str:
    named = any(n.startswith(SUFFIX_PREFIX) for n in list_names(spark, path))
    return "suffix" if named else "partition"


def shard_folders(spark: SparkSession, path: str, start: str, end: str) -> list[str]:
    """Folders of the suffix layout whose suffix lies in [start, end]."""
    return [f"{path.rstrip('/')}/{n}" for n in list_names(spark, path)
            if n.startswith(SUFFIX_PREFIX) and start <= n.removeprefix(SUFFIX_PREFIX) <= end]


def scan_suffix_range(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """S1 of the suffix layout: rows with their table's suffix, ``SUFFIX``."""
    folders = shard_folders(spark, path, start, end)
    if not folders:
        return spark.createDataFrame([], T.StructType([*RAW_EVENT_SCHEMA, T.StructField(SUFFIX, T.StringType())]))
    suffix = F.regexp_extract(F.col("_metadata.file_path"), f"/{SUFFIX_PREFIX}([^/]+)/[^/]+$", 1)
    return spark.read.schema(RAW_EVENT_SCHEMA).parquet(*folders).withColumn(SUFFIX, suffix)


def scan_shard_range(spark: SparkSession, path: str, start: str, end: str, layout: str = "partition") -> DataFrame:
    """Shards with suffix in [start, end] (string comparison, inclusive).
    ``layout`` "auto" looks at the names under ``path``."""
    if (layout_of(spark, path) if layout == "auto" else layout) == "suffix":
        return scan_suffix_range(spark, path, start, end)
    return read_raw(spark, path).where(F.col(PARTITION_COLUMN).between(F.lit(start), F.lit(end)))


def scan_shard(spark: SparkSession, path: str, day: str, layout: str = "partition") -> DataFrame:
    """One shard."""
    if (layout_of(spark, path) if layout == "auto" else layout) == "suffix":
        return scan_suffix_range(spark, path, day, day)
    return read_raw(spark, path).where(F.col(PARTITION_COLUMN) == F.lit(day))


def shard_states(spark: SparkSession, path: str, start: str, end: str) -> list:
    """What the shards of a range hold now: (folder, files, bytes, last change)."""
    names = [n for prefix in (f"{PARTITION_COLUMN}=", SUFFIX_PREFIX) for n in list_names(spark, path)
             if n.startswith(prefix) and start <= n.removeprefix(prefix) <= end]
    return [[n, *folder_state(spark, f"{path.rstrip('/')}/{n}")] for n in names]


def write_shards(raw: DataFrame, path: str, max_records_per_file: int = 5_000_000,
                 partition_col: str = PARTITION_COLUMN, dealt: bool = False) -> str:
    """Store a raw-shaped DataFrame as day shards (replaces ``path``).

    A REBALANCE hint on the day clusters rows by day and lets AQE split a large
    day over several advisory-sized tasks, so each task writes a few files of
    one day (not one small file per task and day, nor a whole day in one
    task); files are capped at ``max_records_per_file`` rows. ``dealt``: the rows
    already lie so, and aren't moved again."""
    ((raw if dealt else raw.hint("rebalance", partition_col))
     .write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(partition_col).parquet(path))
    return path


def write_suffix_shards(raw: DataFrame, path: str, suffix: str = PARTITION_COLUMN, dealt: bool = False) -> str:
    """Store a raw-shaped DataFrame in the suffix layout, in tables by the
    column ``suffix``, and ``event_date`` as a column of the files. ``dealt``: as
    for ``write_shards``."""
    spark, day = raw.sparkSession, "_suffix"
    write_shards(raw.withColumn(day, F.col(suffix)).select(*RAW_EVENT_SCHEMA.names, day), path, partition_col=day,
                 dealt=dealt)
    for name in list_names(spark, path):
        if name.startswith(f"{day}="):
            move_folder(spark, f"{path}/{name}", f"{path}/{SUFFIX_PREFIX}{name.removeprefix(f'{day}=')}")
    return path
