"""Packing: documents into fixed-length token sequences.

Method: bounded-space online packing. Each input partition is read as a stream
with at most ``open_windows`` open windows. A piece goes to the open window it
fits best (least room left); when none fits and no further window may be
opened, the fullest one is emitted. Emitted windows are final and hold no more
state, so a task's memory does not grow with its input. What is still open at a
partition's end (at most ``open_windows`` windows) is merged over partitions in
rounds of ``fan_in`` partitions per group, each group bounded by ``fan_in *
open_windows`` windows; the last group is cut to exact window lengths, so at
most one sequence of the whole result stays short.

Nulls and ties: a null text is an empty document (its end id alone); a null id
stays null; repeated rows are documents of their own; an empty table gives no
pieces. Other columns are not read, so their names cannot clash."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from touchline.llm.common import col, slices, stored
from touchline.llm.tokens import encoder

WINDOW = 4096
OPEN_WINDOWS = 64
FAN_IN = 32
#: Pieces are handed on once they hold this many bytes of ids.
EMIT_BYTES = 4 << 20
#: Encoding takes nearly all the time: larger slices and memo than the default, as far as memory allows.
SLICE_BYTES, MEMO = 4 << 20, 600_000


class Windows:
    """The open windows of one stream. Rows are (doc, start, ids, doc_tokens)."""

    def __init__(self, size: int, most: int, first_id: int):
        self.size, self.most, self.next_id = size, most, first_id
        self.room: list[tuple[int, int]] = []  # (room left, window), ascending
        self.rows: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []
        self.done_bytes = 0

    def put(self, row: tuple) -> None:
        need = len(row[2])
        at = bisect_left(self.room, (need, -1))
        if at < len(self.room):
            left, window = self.room.pop(at)
        else:
            if len(self.room) >= self.most:
                self._emit(self.room.pop(0)[1])
            left, window = self.size, self.next_id
            self.next_id += 1
            self.rows[window] = []
        self.rows[window].append((*row, window, self.size - left))
        if left == need:
            self._emit(window)
        else:
            insort(self.room, (left - need, window))

    def _emit(self, window: int) -> None:
        self.done += self.rows.pop(window)
        self.done_bytes += 4 * self.size

    def take(self) -> list[tuple]:
        out, self.done, self.done_bytes = self.done, [], 0
        return out

    def leftovers(self) -> list[tuple]:
        return [row for _, window in sorted(self.room, key=lambda x: x[1]) for row in self.rows[window]]


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
                         T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
                         T.StructField("ids", T.BinaryType()), T.StructField("sequence_id", T.LongType()),
                         T.StructField("offset", T.LongType()), T.StructField("is_open", T.BooleanType())])


def _batch(rows: list[tuple], is_open: bool, id_type: pa.DataType) -> pa.RecordBatch:
    doc, start, ids, tokens, window, offset = zip(*rows) if rows else ((),) * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, id_type), pa.array(start, pa.int64()), pa.array(map(len, ids), pa.int64()),
         pa.array(tokens, pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()),
         pa.array(window, pa.int64()), pa.array(offset, pa.int64()), pa.array([is_open] * len(rows), pa.bool_())],
        names=["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset", "is_open"])


def _window_id(stream: int, level: int) -> int:
    """Ids of 2**32 windows for each of 2**24 streams and 2**6 rounds."""
    return level << 56 | stream << 32


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
         window: int = WINDOW, open_windows: int = OPEN_WINDOWS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per piece: doc_id, start and length in its document's ids (with
    the end id), doc_tokens, ids (little-endian unsigned 32-bit), sequence_id
    and offset in that sequence. Documents longer than a window are cut at
    multiples of it; only the last merge cuts others."""
    schema = _schema(docs.schema[id_col].dataType)
    id_type = to_arrow_type(schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, MEMO)
        open_ = Windows(window, open_windows, _window_id(TaskContext.get().partitionId(), 0))
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                ids, ends = enc.encode(batch.column(1).slice(a, b - a))
                for i, doc in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                    own = np.append(ids[ends[i]:ends[i + 1]], np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(own), window):
                        open_.put((doc, start, own[start:start + window], len(own)))
                    if open_.done_bytes >= EMIT_BYTES:
                        yield _batch(open_.take(), False, id_type)
        yield _batch(open_.take(), False, id_type)
        yield _batch(open_.leftovers(), True, id_type)

    pieces = stored(docs.select(col(docs, id_col).alias("doc_id"), col(docs, text_col).cast("string").alias("text"))
                    .mapInArrow(run, schema), "packed", "is_open")
    whole, rest, level, span = pieces.where(~F.col("is_open")), pieces.where("is_open"), 0, 1
    while True:
        level, span = level + 1, span * fan_in
        stream = F.shiftright("sequence_id", 32).bitwiseAND(F.lit((1 << 24) - 1))
        streams = rest.agg(F.max(stream)).first()[0]
        last = streams is None or streams < span
        merged = rest.groupBy(F.floor(stream / span).alias("_group")).applyInArrow(
            _merger(window, open_windows, level, span, last, id_type), schema)
        merged = stored(merged, "packed", "is_open")
        whole = whole.unionByName(merged.where(~F.col("is_open")))
        rest = merged.where("is_open")
        if last:
            return whole.drop("is_open")


def _merger(window: int, open_windows: int, level: int, span: int, last: bool, id_type: pa.DataType):
    """Packs the leftovers of one group of streams anew; the last group of all
    fills sequences to the brim, cutting pieces where they meet the end."""

    def merge(leftovers: pa.Table) -> pa.Table:
        rows = leftovers.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist()
        own = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]) for r in rows]
        first = min(r["sequence_id"] >> 32 & (1 << 24) - 1 for r in rows) // span * span
        next_id = _window_id(first, level)
        if not last:
            open_ = Windows(window, open_windows, next_id)
            for row in sorted(own, key=lambda r: -len(r[2])):
                open_.put(row)
            return pa.Table.from_batches([_batch(open_.take(), False, id_type),
                                          _batch(open_.leftovers(), True, id_type)])
        done, fill = [], 0
        for doc, start, ids, tokens in own:
            while len(ids):
                part = ids[:window - fill]
                done.append((doc, start, part, tokens, next_id, fill))
                start, ids, fill = start + len(part), ids[len(part):], fill + len(part)
                if fill == window:
                    next_id, fill = next_id + 1, 0
        return pa.Table.from_batches([_batch(done, False, id_type)])

    return merge


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The training sequences themselves: per sequence_id its ids padded to
    ``window``, and the documents in it by (offset, length). A group holds at
    most ``window`` ids."""
    part = F.struct("offset", "length", "doc_id", "ids")
    out = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    ids = F.expr("aggregate(parts, cast('' as binary), (a, p) -> a || p.ids)")
    fill = F.lit(int(pad_id).to_bytes(4, "little"))
    short = F.lit(window) - F.expr("aggregate(parts, 0L, (a, p) -> a + p.length)")
    padded = F.concat(ids, F.unhex(F.repeat(F.hex(fill), short.cast("int"))))
    return out.select("sequence_id", padded.alias("ids"), short.alias("padding"),
                      F.expr("transform(parts, p -> struct(p.doc_id, p.offset, p.length))").alias("documents"))
