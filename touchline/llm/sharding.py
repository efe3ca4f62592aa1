"""Sharding: k-d tree partitioning of documents by metadata into shards of near
equal bytes.

Method: all documents form one node. A node is split along its widest metadata
dimension (log2 of the size, place of the language, place of the source, place
of the id; each scaled to its spread over all documents) at the weighted median:
the value at which the bytes of its lower side come nearest their share. Splitting
stops when a node has reached the target, one shard's bytes.

The median is exact and distributed: a row's position along the dimension is
made a 48-bit number (20 bits of the value, 28 bits of a hash of the row, so
that ties split too), and three aggregations of 16 bits each narrow the split
down by bytes per bin. No node's rows are gathered, only sums travel.

Names of languages and sources have the place of their hash, ids theirs by size.

Nulls and ties: a null text has no bytes (each document counts its bytes plus
one); null metadata has place 0; equal and repeated rows are split by the row
hash; an empty table gives no rows. ``write_shards`` keeps all columns.

Ids must be numbers (or cast to double); texts of any length are processed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import col, fresh_name, stored

DIGIT = 16
DIGITS = 3
TIE_BITS = 28
VALUE_BITS = DIGIT * DIGITS - TIE_BITS


def _place(value: Column) -> Column:
    """A name's place in 0..1, by hash."""
    return F.coalesce(F.pmod(F.xxhash64(value), F.lit(1 << 20)) / float(1 << 20), F.lit(0.0))


def metadata(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """One narrow row per document, stored. _row numbers the rows in reading
    order (``row_col``: numbers given already by monotonically_increasing_id);
    its upper bits are the partition, _pid."""
    row = col(docs, row_col) if row_col else F.monotonically_increasing_id()
    text = F.coalesce(col(docs, text_col).cast("string"), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    return stored(docs.select(
        col(docs, id_col).alias("doc_id"), size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        row.alias("_row"), F.shiftright(row, 33).alias("_pid"),
        F.array(F.log2(size.cast("double")), _place(col(docs, lang_col).cast("string")),
                _place(col(docs, source_col).cast("string")),
                F.coalesce(col(docs, id_col).cast("double"), F.lit(0.0))).alias("_dims")), "metadata")


def assign(rows: DataFrame, n_shards: int, dims: int = 4) -> DataFrame:
    """Add ``shard``. Nodes are (lo, k): the first shard of a node and how many
    shards it still holds."""
    low = [F.min(F.col("_dims")[d]).alias(f"lo{d}") for d in range(dims)]
    high = [F.max(F.col("_dims")[d]).alias(f"hi{d}") for d in range(dims)]
    spread = rows.agg(*low, *high).first()
    base = [spread[f"lo{d}"] or 0.0 for d in range(dims)]
    width = [((spread[f"hi{d}"] or 0.0) - base[d]) or 1.0 for d in range(dims)]
    scaled = F.array(*((F.col("_dims")[d] - base[d]) / width[d] for d in range(dims)))
    rows = rows.withColumn("_at", scaled).drop("_dims").withColumns({"lo": F.lit(0), "k": F.lit(n_shards)})
    depth = (n_shards - 1).bit_length()
    for _ in range(depth):
        rows = _split(rows, n_shards, dims)
    return rows.withColumnRenamed("lo", "shard").drop("k", "_at")


def _split(rows: DataFrame, n_shards: int, dims: int) -> DataFrame:
    nodes = rows.where("k > 1").groupBy("lo", "k").agg(
        F.sum("size").alias("_bytes"),
        F.array(*((F.max(F.col("_at")[d]) - F.min(F.col("_at")[d])) for d in range(dims))).alias("_widths"))
    nodes = stored(nodes.select("lo", "k", F.col("_bytes").cast("double").alias("_bytes"),
                                (F.array_position("_widths", F.array_max("_widths")) - 1).cast("int").alias("_dim")),
                   "nodes")
    value = F.least(F.floor(F.get(F.col("_at"), F.col("_dim")) * (1 << VALUE_BITS)), F.lit((1 << VALUE_BITS) - 1))
    tie = F.pmod(F.xxhash64("_row"), F.lit(1 << TIE_BITS))
    # at most one row per node, of which there are fewer than shards
    keyed = (rows.join(F.broadcast(nodes.select("lo", "_dim")), "lo", "left")
             .withColumn("_key", value * (1 << TIE_BITS) + tie))
    target = F.col("_bytes") * F.floor(F.col("k") / 2) / F.col("k")
    found = nodes.select("lo", target.alias("_target"), F.lit(0).cast("long").alias("_prefix"))
    for step in range(DIGITS):
        shift = DIGIT * (DIGITS - 1 - step)
        inside = keyed.join(F.broadcast(found.select("lo", "_prefix")), "lo").where(
            F.shiftright("_key", shift + DIGIT) == F.col("_prefix"))
        bins = inside.groupBy("lo", F.shiftright("_key", shift).alias("_bin")).agg(F.sum("size").alias("_in"))
        over = Window.partitionBy("lo").orderBy("_bin")  # at most 2**16 bins per node
        ranked = bins.join(F.broadcast(found.select("lo", "_target")), "lo").withColumn(
            "_upto", F.sum("_in").over(over))
        # the bin in which the target is reached; what lies below it is settled
        hit = (ranked.where(F.col("_upto") >= F.col("_target")).groupBy("lo")
               .agg(F.min(F.struct("_bin", "_in", "_upto", "_target")).alias("h")))
        found = stored(hit.select("lo", (F.col("h._target") - F.col("h._upto") + F.col("h._in")).alias("_target"),
                                  F.col("h._in").alias("_in"), F.col("h._bin").alias("_prefix")), "median")
    # the last bin goes to the side that it leaves nearer to its share; _target is what is still wanted of it
    upper = F.col("_target") * 2 < F.col("_in")
    split = F.broadcast(found.select("lo", (F.col("_prefix") - F.when(upper, 1).otherwise(0)).alias("_median")))
    right = F.coalesce(F.col("_key") > F.col("_median"), F.lit(False))
    half = F.floor(F.col("k") / 2).cast("int")
    moved = keyed.join(split, "lo", "left").withColumn("_right", right)
    new_k = F.when(F.col("k") <= 1, F.col("k")).when(F.col("_right"), F.col("k") - half).otherwise(half)
    new_lo = F.when((F.col("k") > 1) & F.col("_right"), F.col("lo") + half).otherwise(F.col("lo"))
    return stored(moved.withColumns({"lo": new_lo, "k": new_k}).drop("_dim", "_key", "_median", "_right"), "split")


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard, in reading order. Numbers run
    inside each (input partition, shard); partition counts are summed before."""
    counts = rows.groupBy("shard", "_pid").agg(F.count(F.lit(1)).alias("_n"))
    over = Window.partitionBy("shard").orderBy("_pid")
    before = counts.select("shard", "_pid", (F.sum("_n").over(over) - F.col("_n")).alias("_base"))
    inside = Window.partitionBy("shard", "_pid").orderBy("_row")
    return (rows.withColumn("_no", F.row_number().over(inside) - 1).join(before, ["shard", "_pid"])
            .withColumn("slot", F.col("_base") + F.col("_no")).drop("_no", "_base"))


def shard(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, **columns: str) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot. Either the
    number of shards or the bytes that a shard should hold is given."""
    rows = metadata(docs, **columns)
    if n_shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        n_shards = max(1, -(-total // target_bytes))
    return with_slots(assign(rows, n_shards)).select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, n_shards: int, **columns: str) -> None:
    """The documents themselves, with all columns, as Parquet in ``shard=`` folders."""
    row, name = fresh_name(docs, "row"), fresh_name(docs, "shard")
    held = stored(docs.withColumn(row, F.monotonically_increasing_id()), "sharded")
    placed = assign(metadata(held, row_col=row, **columns), n_shards)
    held.join(placed.select(F.col("_row").alias(row), F.col("shard").alias(name)), row).drop(row).hint(
        "rebalance", name).write.partitionBy(name).parquet(path)
