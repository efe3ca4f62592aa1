"""Prefix trie of conversations, with its subtree totals by the Euler-tour technique.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that begin with it. A node's name is the smallest member's id
together with the depth.

Method: every node has an enter and an exit arc. The tour goes from an enter arc
to the first child's, or to the own exit where there is none; from an exit arc to
the next sibling's enter arc, or to the parent's exit. This linked list of all
arcs is ranked distributedly by random mate: in each round an arc whose coin shows
heads swallows its successor if that shows tails, which removes about a quarter of
the list, until at most ``most`` arcs are left; one task walks those, and the
swallowed arcs get their places back round by round, from their swallower's place
plus an offset. With the places known, prefix sums along the tour give the leaves
and savings of a subtree as a difference between its exit and its enter arc.

Plan: texts never move; a turn becomes two numbers of its SHA-256 and its length
while it is read. A prefix is named by the XOR of its turns' hashes, each mixed
with its depth (two of 64 bits), so that prefix names are running XORs, which a
conversation of any length computes in blocks. Turn numbers come from a range
partitioning's sizes, so a conversation with a third of all turns is spread over
tasks, as is a node with a third of all members (partial aggregation) or of all
children (children are numbered by range, and parents joined by their unique
name). Only the hash over a node's member ids is a chain by its nature: ids are
joined to pieces in parallel, and one task hashes one node's pieces as a stream.

Nulls, ties and so on: a null role or text is empty; a null turn number comes
first; rows without a conversation id belong to none and are left out; turns of
one number are ordered by the SHA-256 of their contents; each repeated row is a
turn of its own; texts of any length are hashed whole; an empty table gives no
rows; other columns, whatever their names, are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import col, prefix_sums, stored

#: Arcs that one task may walk.
MOST_ARCS = 1 << 16
#: Turns of a block of running XORs, places of a block of prefix sums, bytes of a piece of joined ids.
XOR_BLOCK, SUM_BLOCK, PIECE_BYTES = 1 << 10, 1 << 16, 1 << 16
#: Conversations of a group share their first turns in ``with_shared_turns``: ids per group, most turns.
GROUP, MOST_SHARED = 100, 5


def _dense(df: DataFrame, order: list, name: str, out: str) -> DataFrame:
    """``df`` sorted by ``order`` and numbered from 0 without gaps in ``out``."""
    ranged = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = prefix_sums(sizes, "_part", "_n", "_before").select("_part", "_before")
    return (ranged.withColumn("_part", part).join(F.broadcast(before), "_part")  # one row per partition
            .withColumn(out, F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1))
            .drop("_place", "_part", "_before"))


def _digest(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)


def numbered_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv, position from 0, a, b, chars) and conversations (conv, n)."""
    blank = lambda c: F.coalesce(col(turns, c).cast("string"), F.lit(""))
    digest = _digest(blank(role_col), blank(text_col))
    number = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    rows = turns.where(col(turns, id_col).isNotNull()).select(
        col(turns, id_col).cast("long").alias("conv"), col(turns, turn_col).alias("turn"), number(1).alias("a"),
        number(16).alias("b"), F.char_length(blank(text_col)).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"))  # splits copies of one turn
    placed = stored(_dense(rows, ["conv", "turn", "a", "b", "row"], "turn-ranges", "place").drop("turn", "row"), "turns")
    convs = stored(placed.groupBy("conv").agg(F.min("place").alias("begin"), F.count("*").alias("n")), "conversations")
    positions = placed.join(convs.select("conv", "begin"), "conv").withColumn("position", F.col("place") - F.col("begin"))
    return positions.drop("place", "begin"), convs.select("conv", "n")


def sequences(positions: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, depth from 1, a, b, chars) and conversations (conv, depth),
    each conversation as it is."""
    return (positions.select("conv", (F.col("position") + 1).alias("depth"), "a", "b", "chars"),
            convs.select("conv", F.col("n").alias("depth")))


def with_shared_turns(positions: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``sequences``, with the first h = crc32(id) % 6 turns of each
    conversation replaced by those of its group's first (id - id % 100)."""
    own = convs.withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_SHARED + 1)).withColumn(
        "base", F.col("conv") - F.col("conv") % GROUP)
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = stored(own.join(bases, "base", "left").withColumn(
        "shared", F.least("h", F.coalesce("base_n", F.lit(0)))).select("conv", "base", "h", "shared", "n"), "rebuilt")
    turns = stored(positions, "turn-positions")
    kept = turns.join(plan.select("conv", "h", "shared"), "conv").where("position >= h").select(
        "conv", (F.col("shared") + F.col("position") - F.col("h") + 1).alias("depth"), "a", "b", "chars")
    first = turns.where((F.col("position") < MOST_SHARED) & (F.col("conv") % GROUP == 0)).withColumnRenamed("conv", "base")
    lent = plan.select("conv", "base", "shared").join(first, "base").where("position < shared").select(
        "conv", (F.col("position") + 1).alias("depth"), "a", "b", "chars")
    return kept.unionAll(lent), plan.select(
        "conv", (F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depth"))


def named_prefixes(turns: DataFrame) -> DataFrame:
    """Add each turn's prefix name (x, y) and that of the prefix before (px, py)."""
    one, two = (F.xxhash64(F.lit(i), "depth", "a", "b") for i in (1, 2))
    mixed = turns.select("conv", "depth", "chars", one.alias("one"), two.alias("two"),
                         F.floor((F.col("depth") - 1) / XOR_BLOCK).alias("block"))
    inside = Window.partitionBy("conv", "block").orderBy("depth")
    running = stored(mixed.withColumn("x", F.bit_xor("one").over(inside)).withColumn("y", F.bit_xor("two").over(inside)),
                     "prefixes")
    long = running.where("block > 0").select("conv").distinct()
    totals = running.join(long, "conv", "left_semi").groupBy("conv", "block").agg(
        F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"))
    order = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("conv", "block", F.bit_xor("one").over(order).alias("bx"), F.bit_xor("two").over(order).alias("by"))
    xor = lambda p, q: F.col(p).bitwiseXOR(F.coalesce(q, F.lit(0).cast("long")) if isinstance(q, str) else q)
    whole = running.join(before, ["conv", "block"], "left").withColumn("x", xor("x", "bx")).withColumn("y", xor("y", "by"))
    return whole.select("conv", "depth", "chars", "x", "y", xor("x", F.col("one")).alias("px"),
                        xor("y", F.col("two")).alias("py"))


def _coin(arc: str, turn: int) -> Column:
    return F.xxhash64(F.lit(turn), arc).bitwiseAND(1) == 1


def list_rank(arcs: DataFrame, name: str = "id", following: str = "next", most: int = MOST_ARCS) -> DataFrame:
    """(id, place) of every element of a linked list, from 0; ``following`` is
    null at its end."""
    left = arcs.select(F.col(name).alias("id"), F.col(following).alias("next"), F.lit(1).cast("long").alias("length"))
    size, turn, swallowed = left.count(), 0, []
    while size > most:
        heads, to_tails = _coin("id", turn), F.coalesce(~_coin("next", turn) & F.col("next").isNotNull(), F.lit(False))
        mates = left.where(heads & to_tails).select(F.col("id").alias("head"), F.col("next").alias("id"),
                                                    F.col("length").alias("ahead"))
        tails = left.where(~heads).join(mates, "id", "left")
        grown = F.struct(F.col("head").alias("id"), "next", (F.col("ahead") + F.col("length")).alias("length"),
                         F.lit(None).cast("long").alias("owner"), F.lit(False).alias("gone"))
        gone = F.struct("id", F.lit(None).cast("long").alias("next"), F.col("ahead").alias("length"),
                        F.col("head").alias("owner"), F.lit(True).alias("gone"))
        same = F.struct("id", "next", "length", F.lit(None).cast("long").alias("owner"), F.lit(False).alias("gone"))
        made = tails.select(F.explode(F.when(F.col("head").isNotNull(), F.array(grown, gone)).otherwise(F.array(same))).alias("s"))
        rest = left.where(heads & ~to_tails).select(same.alias("s"))
        both = stored(made.select("s.*").unionAll(rest.select("s.*")), f"arcs-{turn}", partition_by="gone")
        left = both.where("NOT gone").select("id", "next", "length")
        swallowed.append(both.where("gone").select("id", "owner", F.col("length").alias("offset")))
        size, turn = left.count(), turn + 1

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)  # at most ``most`` rows
        ids, following, length = (np.concatenate([b.column(i).fill_null(-1).to_numpy() for b in parts] or [np.zeros(0, np.int64)])
                                  for i in range(3))
        if not len(ids):
            return
        order = np.argsort(ids)
        at = order[np.searchsorted(ids, following, sorter=order).clip(0, len(ids) - 1)]
        at = np.where(following < 0, -1, at).tolist()
        head = (set(range(len(ids))) - set(at)).pop()
        place, sizes, upto = np.zeros(len(ids), np.int64), length.tolist(), 0
        while head >= 0:
            place[head], upto, head = upto, upto + sizes[head], at[head]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(place)], names=["id", "place"])

    found = [stored(left.repartition(1).mapInArrow(walk, "id long, place long"), "places")]
    for k, arcs_of_turn in reversed(list(enumerate(swallowed))):
        known = reduce(DataFrame.unionAll, found).withColumnRenamed("id", "owner")
        found.append(stored(arcs_of_turn.join(known, "owner").select("id", (F.col("place") + F.col("offset")).alias("place")),
                            f"places-{k}"))
    return reduce(DataFrame.unionAll, found)


def euler_tour(tree: DataFrame) -> DataFrame:
    """(id, next) of the arcs: 2 * node enters, 2 * node + 1 leaves. ``tree``
    has node and, of its children, first and last (null without)."""
    enter = tree.select((F.col("node") * 2).alias("id"),
                        F.coalesce(F.col("first") * 2, F.col("node") * 2 + 1).alias("next"))
    ends = tree.where("last IS NOT NULL").select(F.col("last").alias("node"), (F.col("node") * 2 + 1).alias("up"))
    leave = tree.select("node").join(ends, "node", "left").select(
        (F.col("node") * 2 + 1).alias("id"),
        F.when(F.col("node") > 0, F.coalesce("up", F.col("node") * 2 + 2)).alias("next"))  # the root is node 0
    return enter.unionAll(leave)


def subtree_sums(tree: DataFrame, places: DataFrame, values: list[str]) -> DataFrame:
    """node and, per value, its sum over the node's subtree: running sums along
    the tour, at the exit less those before the enter arc."""
    weights = tree.select((F.col("node") * 2).alias("id"), *values)
    arcs = places.join(weights, "id", "left").select(
        "id", "place", F.floor(F.col("place") / SUM_BLOCK).alias("block"),
        *(F.coalesce(v, F.lit(0)).cast("long").alias(v) for v in values))
    inside = Window.partitionBy("block").orderBy("place")
    running = stored(arcs.select("id", "block", *values, *(F.sum(v).over(inside).alias("upto_" + v) for v in values)),
                     "tour-sums")
    order = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    blocks = running.groupBy("block").agg(*(F.sum(v).alias(v) for v in values))
    before = blocks.select("block", *(F.coalesce(F.sum(v).over(order), F.lit(0)).alias("before_" + v) for v in values))
    upto = lambda v: F.col("upto_" + v) + F.col("before_" + v)
    exits = F.col("id") % 2 == 1
    return running.join(before, "block").groupBy(F.floor(F.col("id") / 2).alias("node")).agg(
        *(F.sum(F.when(exits, upto(v)).otherwise(F.col(v) - upto(v))).alias(v) for v in values))


def joined_id_hashes(ends: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """SHA-256 of the ids (conv) per (depth, x, y), ascending, comma-joined."""
    keys = ["depth", "x", "y"]

    def batch(rows: list[tuple], last: pa.DataType, names: list[str]) -> pa.RecordBatch:
        kinds = [pa.int64()] * (len(names) - 1) + [last]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, held, size, out = None, None, [], 0, []
        names = [*keys, "first", "ids"]
        for rows in batches:
            for *own, conv in zip(*(c.to_pylist() for c in rows.columns)):
                if own != key or size >= piece_bytes:
                    if held:
                        out.append((*key, first, ",".join(held)))
                    key, first, held, size = own, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            yield batch(out, pa.string(), names)
            out = []
        if held:
            yield batch([(*key, first, ",".join(held))], pa.string(), names)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []
        names = [*keys, "ends_sha256"]
        for rows in batches:
            for *own, ids in zip(*(rows.column(c).to_pylist() for c in (*keys, "ids"))):
                if own != key:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield batch(out, pa.string(), names)
            out = []
        if key:
            yield batch([(*key, digest.hexdigest())], pa.string(), names)

    order = [*keys, "conv"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        join, "depth long, x long, y long, first long, ids string")
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(
        chain, "depth long, x long, y long, ends_sha256 string")


def build(turns: DataFrame, convs: DataFrame, most_arcs: int = MOST_ARCS) -> DataFrame:
    """Nodes of the trie of the conversations (conv, depth: number of turns)
    with these turns (conv, depth, a, b, chars): conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    prefixes = stored(named_prefixes(turns), "named")
    nodes = prefixes.groupBy("depth", "x", "y").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("px").alias("px"), F.min("py").alias("py"),
        F.min("chars").alias("chars"))
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv", "n_convs", null.alias("px"), null.alias("py"),
        zero.alias("chars"))
    nodes = stored(nodes.unionAll(root), "nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"),
                           F.col("conv").alias("parent"))
    named = nodes.join(parents, ["depth", "px", "py"], "left").drop("px", "py")
    placed = stored(_dense(named, ["depth", "parent", "conv"], "node-ranges", "node"), "placed")
    kids = placed.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("conv")).agg(
        F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("n_children"))
    tree = stored(placed.join(kids, ["depth", "conv"], "left").withColumn("n_children", F.coalesce("n_children", zero))
                  .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
                  .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("chars")), "tree")
    places = list_rank(stored(euler_tour(tree), "arcs"), most=most_arcs)
    sums = subtree_sums(tree, places, ["n_leaves", "saved_tokens"])
    last = prefixes.join(convs, ["conv", "depth"], "left_semi").select("depth", "x", "y", "conv")
    none = convs.where("depth = 0").select("depth", zero.alias("x"), zero.alias("y"), "conv")
    hashes = joined_id_hashes(last.unionAll(none))
    return (tree.drop("n_leaves", "saved_tokens").join(sums, "node").join(hashes, ["depth", "x", "y"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
                    "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def prefix_trie(turns: DataFrame, shared_turns: bool = False, most_arcs: int = MOST_ARCS, **columns: str) -> DataFrame:
    """The trie of the conversations of ``turns``. A node's text is the turn
    number ``depth`` of conversation ``conv_id``; with ``shared_turns`` the
    conversations are first rebuilt by ``with_shared_turns``."""
    positions, convs = numbered_turns(turns, **columns)
    return build(*(with_shared_turns if shared_turns else sequences)(positions, convs), most_arcs=most_arcs)
