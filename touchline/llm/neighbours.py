"""Nearest neighbours by inner product, as a block matrix join.

Method: rows are dealt evenly to bands, and each band to blocks. A block holds
its vectors three ways: as they are, as int8 codes with one scale per vector, and
as the norms of the decoded vector and of what the code leaves out. A tile is one
band of queries against one band of rows. Inside a tile the product of two code
blocks gives every inner product up to

    |q.c - dq.dc| <= |eq| |c| + |dq| |ec|      (d decoded, e left out, by Cauchy-Schwarz)

so a pair whose upper bound is below the least that a query's list can end up
with is ruled out for good. That least is the greater of the list's own last exact
score and the k-th highest lower bound of the block. All other pairs are computed
again in double precision from the vectors themselves, and a heap per query keeps
the best. The tiles' lists are merged by a heap per query as well. Nothing is
left out on a guess: the result is the exact one.

Products of codes are summed in float32, which is exact up to 1,040 components;
longer vectors are multiplied in pieces.

Plan: bands are of a fixed number of rows, so a tile's memory does not follow the
table, and a tile is a key of its own, so no task gets more than whole tiles.
Queries (a stated part of the rows) meet rows block by block; what a tile emits
is k rows per query. Copies of one vector are dealt over all bands.

Nulls, ties and so on: a vector that is null, empty, all zero, or holds a null, a
NaN or an infinity takes no part, neither does a row with a null id; vectors meet
only vectors of their own length, of any length; equal scores go to the smaller
id; each repeated row is a row of its own, so a query with a repeated id has a
list per row and may find its twin, but not itself; with fewer than ``k`` other
rows all are returned; an empty table gives no rows; other columns, whatever their
names, are not read."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from touchline.llm.common import col, stored

#: Rows of a band (bounds a tile), of a block, and queries of a band.
BAND_ROWS, BLOCK_ROWS, BAND_QUERIES = 1 << 14, 1 << 10, 1 << 9
#: Components whose int8 products have an exact float32 sum (127 * 127 * 1040 < 2 ** 24).
EXACT_SUM = 1040
#: Pairs that are computed again at once.
PAIRS = 1 << 15
#: Relative room for the rounding of bounds and products, per component.
ROUNDING = 4 * np.finfo(np.float64).eps

_BLOCK = ("band long, dim int, n int, ids binary, keys binary, vectors binary, codes binary, scales binary, "
          "norms binary, decoded binary, lost binary")


class Block:
    """Vectors of one length with their codes, scales and norms."""

    def __init__(self, ids, keys, vectors, codes, scales, norms, decoded, lost):
        self.ids, self.keys, self.vectors, self.codes, self.scales = ids, keys, vectors, codes, scales
        self.norms, self.decoded, self.lost = norms, decoded, lost

    @classmethod
    def of(cls, ids: np.ndarray, keys: np.ndarray, vectors: np.ndarray) -> Block:
        exact = vectors.astype(np.float64)
        scales = np.abs(exact).max(axis=1) / 127
        with np.errstate(all="ignore"):
            codes = np.rint(exact / scales[:, None])
            fits = np.isfinite(codes).all(axis=1) & (np.abs(codes).max(axis=1) <= 127)
            codes = np.where(fits[:, None], codes, 0).astype(np.int8)  # else nothing is decoded and all is left out
            decoded = scales[:, None] * codes
            norm = lambda x: np.sqrt((x * x).sum(axis=1)) * (1 + ROUNDING * x.shape[1])
            return cls(ids, keys, vectors, codes, scales, norm(exact), norm(decoded), norm(exact - decoded))

    def parts(self) -> tuple[np.ndarray, ...]:
        return (self.ids, self.keys, self.vectors, self.codes, self.scales, self.norms, self.decoded, self.lost)

    def take(self, at: np.ndarray) -> Block:
        return Block(*(x[at] for x in self.parts()))

    @classmethod
    def joined(cls, own: list[Block]) -> Block:
        return cls(*(np.concatenate(x) for x in zip(*(b.parts() for b in own))))

    def row(self) -> tuple:
        return (len(self.ids), *(np.ascontiguousarray(x).tobytes() for x in self.parts()))

    @classmethod
    def read(cls, row: dict, kind: str) -> Block:
        n, dim = row["n"], row["dim"]
        get = lambda name, kind: np.frombuffer(row[name], kind)
        return cls(get("ids", np.int64), get("keys", np.int64), get("vectors", kind).reshape(n, dim),
                   get("codes", np.int8).reshape(n, dim), *(get(x, np.float64) for x in
                                                           ("scales", "norms", "decoded", "lost")))


def bounds(queries: Block, rows: Block) -> tuple[np.ndarray, np.ndarray]:
    """Estimate of every inner product, and how far off it may be."""
    dim = queries.codes.shape[1]
    product = np.zeros((len(queries.ids), len(rows.ids)))
    for a in range(0, dim, EXACT_SUM):
        product += queries.codes[:, a:a + EXACT_SUM].astype(np.float32) @ rows.codes[:, a:a + EXACT_SUM].astype(np.float32).T
    with np.errstate(all="ignore"):
        product *= queries.scales[:, None]
        product *= rows.scales
        room = np.outer(queries.lost, rows.norms) + np.outer(queries.decoded, rows.lost)
        room += np.outer(queries.norms, rows.norms) * (ROUNDING * (dim + 8))
        return product, room + np.finfo(np.float64).tiny * (dim + 8)


def exact_scores(queries: np.ndarray, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (i, j) in double precision, added from the
    first component to the last, so that equal vectors get equal scores. A sum
    of both infinities (products that overflow) ranks last."""
    total = np.zeros(len(i))
    with np.errstate(all="ignore"):
        for q, c in zip(queries.T.astype(np.float64), rows.T.astype(np.float64)):
            total += q[i] * c[j]
    return np.where(np.isnan(total), -np.inf, total)


class Lists:
    """The best ``k`` rows of each query of a block, in heaps whose first entry
    is the worst: (score, -id, -key)."""

    def __init__(self, queries: Block, k: int):
        self.queries, self.k = queries, k
        self.heaps: list[list] = [[] for _ in queries.ids]
        self.least = np.full(len(queries.ids), -np.inf)  # worst score and its id, once a list is full
        self.last = np.full(len(queries.ids), np.iinfo(np.int64).max)

    def add(self, rows: Block) -> None:
        q, k = self.queries, self.k
        estimate, room = bounds(q, rows)
        with np.errstate(all="ignore"):
            own = np.flatnonzero(np.isin(q.keys, rows.keys))
            lower = estimate - room
            if len(own):  # a query is no neighbour of itself
                place = {key: j for j, key in enumerate(rows.keys.tolist())}
                mine = np.array([place[key] for key in q.keys[own].tolist()])
                lower[own, mine] = -np.inf
            least = self.least
            if lower.shape[1] >= k:
                lower[np.isnan(lower)] = -np.inf
                least = np.maximum(least, np.partition(lower, -k, axis=1)[:, -k])
            estimate += room
            left = ~(estimate < least[:, None])  # not a number: stays
        if len(own):
            left[own, mine] = False
        i, j = np.nonzero(left)
        for a in range(0, len(i), PAIRS):
            at, to = i[a:a + PAIRS], j[a:a + PAIRS]
            scores = exact_scores(q.vectors, rows.vectors, at, to)
            good = (scores > self.least[at]) | (scores == self.least[at]) & (rows.ids[to] <= self.last[at])
            for x, score, vec, key in zip(at[good].tolist(), scores[good].tolist(), rows.ids[to[good]].tolist(),
                                          rows.keys[to[good]].tolist()):
                push(self.heaps[x], (score, -vec, -key), k)
        for x in np.unique(i).tolist():
            if len(self.heaps[x]) == k:
                self.least[x], self.last[x] = self.heaps[x][0][0], -self.heaps[x][0][1]


def push(heap: list, entry: tuple, k: int) -> None:
    if len(heap) < k:
        heapq.heappush(heap, entry)
    elif entry > heap[0]:
        heapq.heapreplace(heap, entry)


def blocks(rows: DataFrame, vec_id: Column, vector: Column, kind: str, block_rows: int, band_rows: int) -> DataFrame:
    """Rows that take part, dealt to bands and written as blocks."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    sound = (vec_id.isNotNull() & vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))
             & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False)))
    part = rows.where(sound).select(vec_id.cast("long").alias("vec_id"), vector.alias("vector"))
    bands = max(1, -(-part.count() // band_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _BLOCK.split(", ")]
        held: dict[int, list[tuple]] = {}

        def out(dim: int, ready: list[tuple]) -> pa.RecordBatch:
            ids, keys, vectors = (np.concatenate(x) for x in zip(*ready))
            n, *parts = Block.of(ids, keys, vectors).row()
            columns = [pa.array([band], pa.int64()), pa.array([dim], pa.int32()), pa.array([n], pa.int32()),
                       *(pa.array([p], pa.binary()) for p in parts)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        band = 0
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy() for i in (0, 1))
            vectors, band = batch.column(2), batch.column(3)[0].as_py() if len(batch) else band
            starts = np.concatenate(([0], np.cumsum(vectors.value_lengths().to_numpy())))
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)
            dims = np.diff(starts)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                own = flat[starts[at][:, None] + np.arange(dim)]
                for a in range(0, len(at), block_rows):
                    held.setdefault(dim, []).append((ids[at[a:a + block_rows]], keys[at[a:a + block_rows]],
                                                     own[a:a + block_rows]))
                    if sum(len(x[0]) for x in held[dim]) >= block_rows:
                        yield out(dim, held.pop(dim))
        for dim, ready in held.items():
            yield out(dim, ready)

    dealt = part.repartition(bands).select("vec_id", F.monotonically_increasing_id().alias("key"), "vector",
                                           F.spark_partition_id().cast("long").alias("band"))
    return stored(dealt.mapInArrow(run, _BLOCK), "vector-blocks")


def neighbours(rows: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
               band_rows: int = BAND_ROWS, block_rows: int = BLOCK_ROWS,
               band_queries: int = BAND_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` rows with the
    largest inner product with each row whose id is divisible by ``every``."""
    spark, vector = rows.sparkSession, col(rows, vector_col)
    element = rows.schema[vector_col].dataType
    kind = "<f4" if isinstance(element, ArrayType) and element.elementType.simpleString() == "float" else "<f8"
    made = blocks(rows, col(rows, id_col), vector.cast(f"array<{'float' if kind == '<f4' else 'double'}>"), kind,
                  block_rows, band_rows)
    bands = (made.agg(F.max("band")).first()[0] or 0) + 1

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(row, kind)
                at = np.flatnonzero(block.ids % every == 0)
                if len(at):
                    n, *parts = block.take(at).row()
                    columns = [pa.array([row["band"]], pa.int64()), pa.array([row["dim"]], pa.int32()),
                               pa.array([n], pa.int32()), *(pa.array([p], pa.binary()) for p in parts)]
                    yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    asked = stored(made.mapInArrow(pick, _BLOCK), "query-blocks")
    total = asked.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // band_queries))
    # queries of a block stay together: a block is small against a band, and bands are dealt by its number
    asked = asked.withColumn("group", F.pmod(F.xxhash64("band", "keys"), F.lit(groups)))
    tile = lambda group, band: group * F.lit(bands).cast("long") + band
    left = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(bands - 1)).cast("array<long>")).alias("to")).withColumn(
        "tile", tile(F.col("group"), F.col("to"))).drop("group", "to")
    right = made.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")).alias("group")).withColumn(
        "tile", tile(F.col("group"), F.col("band"))).drop("group")

    def run(queries: pa.Table, block_rows: pa.Table) -> pa.Table:
        asked: dict[int, list[Block]] = {}
        for row in queries.to_pylist():
            asked.setdefault(row["dim"], []).append(Block.read(row, kind))
        lists = {dim: Lists(Block.joined(own), k) for dim, own in asked.items()}
        for batch in block_rows.to_batches(max_chunksize=1):
            for row in batch.to_pylist():
                if row["dim"] in lists:
                    lists[row["dim"]].add(Block.read(row, kind))
        out = [(int(q), int(key), score, -vec, -other) for one in lists.values()
               for q, key, heap in zip(one.queries.ids, one.queries.keys, one.heaps) for score, vec, other in heap]
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                        names=["query_id", "query_key", "score", "vec_id", "key"])

    found = left.groupBy("tile").cogroup(right.groupBy("tile")).applyInArrow(
        run, "query_id long, query_key long, score double, vec_id long, key long")
    return merged(found, k)


def merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query's lists, by one heap at a time over a
    sorted stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap, out = None, [], []

        def close() -> None:
            for rank, (score, vec, _) in enumerate(sorted(heap, reverse=True), 1):
                out.append((query[0], rank, -vec, score))

        def emit() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                              names=["query_id", "rank", "vec_id", "score"])
            out.clear()
            return made

        for batch in batches:
            for q, key, score, vec, other in zip(*(c.to_pylist() for c in batch.columns)):
                if (q, key) != query:
                    close()
                    query, heap = (q, key), []
                push(heap, (score, -vec, -other), k)
            yield emit()
        close()
        yield emit()

    ordered = found.repartition("query_id", "query_key").sortWithinPartitions("query_id", "query_key")
    return ordered.mapInArrow(run, "query_id long, rank int, vec_id long, score double")
