"""Importance resampling towards a target distribution.

Method: a document is described by how often its word runs fall in each of a
fixed number of hash buckets. From the bucket counts of all documents and of all
target texts every bucket gets a gain (a smoothed log ratio); a document's weight
is the mean gain of its features, and the sample is drawn without replacement by
adding Gumbel noise (from a hash of the id, so repeatable) and taking the highest
scores.

The hash is CRC-32, which is linear up to a constant of the length: the checksum
of a span is the XOR of one table entry per byte, found by the byte's value and
its distance from the span's end, and of the length's constant. ``PositionCrc``
looks all bytes of many spans up at once and folds them with
``bitwise_xor.reduceat``. Spans longer than the table are cut into blocks from
their end, which are folded pairwise: the left block is moved by the right one's
length with a table of that shift.

Plan: pass 1 counts buckets inside each task (an array of ``buckets`` numbers, no
matter how many rows) and adds the tasks' arrays up; the gains, ``buckets``
numbers, go to all tasks; pass 2 weighs every document. Only narrow rows are
sorted for the draw; ranks come from the range partitions' sizes, so no task sees
more than its range.

Nulls, ties and so on: a null or empty text has no features, weight 0, and takes
no part in the draw; a null id counts as an empty string in its noise and ranks
before other ids of its score; equal scores go to the smaller id; each repeated
row is a document of its own and copies of one id get successive ranks; a text of
any length is processed whole, its spans in blocks of bounded size; an empty
table gives no rows, and an empty target only smooths; other columns, whatever
their names, are not read."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import col, prefix_sums, slices, stored

#: Longest span that the position table covers at once.
SPAN = 64
#: Blocks of at most ``SPAN`` bytes that are looked up at once, and bytes of text in a slice.
AT_ONCE, TEXT_BYTES = 1 << 13, 1 << 19
POLYNOMIAL = 0xEDB88320

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes of words: digits, lower-case letters and all bytes of other characters than ASCII.
_WORD = (((_BYTES >= ord("0")) & (_BYTES <= ord("9"))) | ((_BYTES >= ord("a")) & (_BYTES <= ord("z"))) | (_BYTES >= 128))


class PositionCrc:
    """CRC-32 of many spans of one byte array."""

    def __init__(self, span: int = SPAN):
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1)
        table = [step]
        while len(table) < span:
            table.append((table[-1] >> 8) ^ step[table[-1] & 255])
        self.span, self.table = span, np.concatenate(table)
        moved = np.concatenate([np.arange(256, dtype=np.uint32) << (8 * i) for i in range(4)])
        for _ in range(span):
            moved = (moved >> 8) ^ step[moved & 255]
        self.moves = [moved]
        self.constants = np.array([zlib.crc32(bytes(n)) for n in range(span + 1)], np.uint32)

    def move(self, values: np.ndarray, level: int) -> np.ndarray:
        """``values`` as they are before ``span << level`` further bytes."""
        while len(self.moves) <= level:
            self.moves.append(self.move(self.moves[-1], len(self.moves) - 1))
        table = self.moves[level]
        return (table[values & 255] ^ table[256 + (values >> 8 & 255)] ^ table[512 + (values >> 16 & 255)]
                ^ table[768 + (values >> 24)])

    def _blocks(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.zeros(len(begins), np.uint32)
        for a in range(0, len(begins), AT_ONCE):
            length, base = lengths[a:a + AT_ONCE], begins[a:a + AT_ONCE].min()
            ends = np.cumsum(length, dtype=np.int32)
            place = np.arange(ends[-1], dtype=np.int32)
            offset = begins[a:a + AT_ONCE] - base - (ends - length)
            byte = data[base:][place + np.repeat(offset, length)]
            distance = np.repeat(ends - 1, length) - place
            out[a:a + AT_ONCE] = np.bitwise_xor.reduceat(self.table[(distance << 8) + byte], ends - length)
        return out

    def crc32(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of each span ``data[begin:begin + length]``; no length is zero."""
        if not len(begins):
            return np.zeros(0, np.uint32)
        longer = np.flatnonzero(lengths > self.span)
        if not len(longer):
            return self._blocks(data, begins, lengths) ^ self.constants[lengths]
        out = np.zeros(len(begins), np.uint32)
        short = np.flatnonzero(lengths <= self.span)
        out[short] = self.crc32(data, begins[short], lengths[short])
        begin, length = begins[longer], lengths[longer]
        count = -(-length // self.span)
        first = np.cumsum(count) - count
        owner = np.repeat(np.arange(len(longer)), count)
        right = np.repeat(first + count - 1, count) - np.arange(count.sum())  # blocks to the right in the span
        stop = (begin + length)[owner] - right * self.span
        start = np.maximum(begin[owner], stop - self.span)
        values, level = self._blocks(data, start, stop - start), 0
        while len(values) > len(longer):
            values = np.where(right & 1, self.move(values, level), values)
            right >>= 1
            heads = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (right[1:] != right[:-1]))))
            values, owner, right, level = np.bitwise_xor.reduceat(values, heads), owner[heads], right[heads], level + 1
        out[longer] = values ^ np.array([zlib.crc32(bytes(n)) for n in length.tolist()], np.uint32)
        return out


@lru_cache(maxsize=1)
def position_crc() -> PositionCrc:
    """One per worker process."""
    return PositionCrc()


class Features:
    """Buckets of the word runs of a slice of texts: per run length the bucket
    of the run that begins at each word (-1 where the text ends before it does)."""

    def __init__(self, texts: pa.Array, buckets: int, longest: int):
        joined = pc.binary_join_element_wise(texts, "", " ")  # no word reaches into the next text
        offsets = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset:joined.offset + len(joined) + 1]
        data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        lowered = _LOWER[data]
        inside = _WORD[lowered]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        lengths = ends - starts
        self.word_at = np.searchsorted(starts, offsets.astype(np.int64) - offsets[0])
        kept = inside.copy()
        kept[ends] = True
        lowered[~inside] = ord(" ")
        plain = lowered[kept]  # the words, one space after each
        begins = np.cumsum(lengths + 1) - (lengths + 1)
        counts = np.diff(self.word_at)
        left = np.repeat(self.word_at[1:], counts) - np.arange(len(starts))  # words from here to the text's end
        self.runs = []
        for k in range(1, longest + 1):
            first = np.flatnonzero(left >= k)
            last = first + k - 1
            bucket = np.full(len(starts), -1, np.int64)
            bucket[first] = position_crc().crc32(plain, begins[first], begins[last] + lengths[last] - begins[first]) % buckets
            self.runs.append(bucket)


def bucket_counts(texts: DataFrame, text: Column, buckets: int, longest: int) -> DataFrame:
    """(bucket, n) over all features of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0), TEXT_BYTES):
                for bucket in Features(batch.column(0).slice(a, b - a), buckets, longest).runs:
                    total += np.bincount(bucket[bucket >= 0], minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    counted = texts.select(F.coalesce(text.cast("string"), F.lit("")).alias("text")).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, doc_text: Column, target: DataFrame, target_text: Column, buckets: int,
          longest: int) -> np.ndarray:
    """Gain of every bucket, in thousandths; ``buckets`` numbers, whatever the
    size of the tables."""
    own = bucket_counts(docs, doc_text, buckets, longest).select("bucket", F.col("n").alias("s"), F.lit(0).alias("t"))
    aim = bucket_counts(target, target_text, buckets, longest).select("bucket", F.lit(0).alias("s"), F.col("n").alias("t"))
    zero = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t"))
    both = stored(own.unionAll(aim).unionAll(zero).groupBy("bucket").agg(
        F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t")), "bucket-counts")
    all_s, all_t = both.agg(F.sum("s"), F.sum("t")).first()
    ratio = ((F.col("t") + 1) * F.lit(all_s + buckets)) / ((F.col("s") + 1) * F.lit(all_t + buckets))
    rows = both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).collect()
    return np.array([gain for _, gain in sorted(rows)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for a, b in slices(batch.column(1), TEXT_BYTES):
                found = Features(batch.column(1).slice(a, b - a), len(gain), longest)
                n_features = np.zeros(b - a, np.int64)
                total = np.zeros(b - a, np.int64)
                for bucket in found.runs:
                    real = bucket >= 0
                    for out, value in ((n_features, real), (total, np.where(real, gain[bucket], 0))):
                        upto = np.concatenate(([0], np.cumsum(value, dtype=np.int64)))
                        out += np.diff(upto[found.word_at])
                weight = total // np.maximum(n_features, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(found.word_at)), pa.array(n_features),
                     pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(col(docs, id_col).alias("doc_id"),
                       F.coalesce(col(docs, text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, "
                                "n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, buckets: int = 10_000, longest: int = 2,
             min_words: int = 20, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_features, weight, score and, for
    the ``percent`` percent of the rows with ``min_words`` words that are drawn,
    rank (1 is the highest score)."""
    gain = gains(docs, col(docs, text_col), target, col(target, target_text_col), buckets, longest)
    weighed = weights(docs, gain, longest, id_col, text_col).withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("_row", F.monotonically_increasing_id())
    scored = stored(weighed, "scored")
    enough = F.col("n_words") >= min_words
    # the row number splits a hot id's copies, too
    order = [F.desc("score"), F.asc("doc_id"), F.asc("_row")]
    ranged = stored(scored.where(enough).repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_place", F.monotonically_increasing_id()), "scored-ranges")
    part, at = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = prefix_sums(sizes, "_part", "_n", "_before").select("_part", "_before")
    drawn = percent * ranged.count() // 100
    ranked = ranged.withColumn("_part", part).join(before, "_part").withColumn("rank", F.col("_before") + at + 1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, "rank").unionAll(
        scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **parameters) -> DataFrame:
    """The rows of ``docs``, all columns, of whose id a row is drawn."""
    drawn = resample(docs, target, id_col=id_col, **parameters).where("rank IS NOT NULL").select(
        F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(drawn, col(docs, id_col).eqNullSafe(drawn["_drawn"]), "left_semi")
