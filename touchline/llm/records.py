"""Token-id output: length-delimited binary records with an offset index.

File format (all integers little-endian). A file is a run of records:

    uint64  payload length n
    uint32  masked checksum of the 8 length bytes
    n bytes payload
    uint32  masked checksum of the payload

payload: int64 document id, uint8 flags (1: the id is null), uint8 bytes per
token id (2 if the vocabulary fits, else 4), uint32 token count, then the ids.
The checksum is CRC-32; masked means rotated right by 15 bits plus 0xa282ead8
modulo 2**32, so that data holding checksums does not check itself.

Writers stream their range of documents in id order, so the order of files and
of records in them is the order of ids. Each task attempt writes files of its
own name; the offset index, a Parquet table committed by Spark, names only the
files of attempts that succeeded. A lost executor or a second attempt therefore
leaves at worst an unreferenced file. The index (file, byte offset, length,
token count, ids before) is apart from the data, so a shuffled or sampled
reading order is a matter of ordering index rows.

Nulls and ties: a null text is an empty document; null ids sort first; rows with
equal ids are ordered by text; repeated rows are written repeatedly; an empty
table gives an empty index.

Ids must be whole numbers (the format holds 64 bits); texts of any length are
processed whole.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import by_file, col, filesystem, prefix_sums, slices, stored
from touchline.llm.tokens import encoder
from touchline.session import scratch_path

FILE_BYTES = 256 << 20
FLUSH_BYTES = 4 << 20
#: The writer is bound by encoding: it takes larger slices and remembers more chunks than the default.
SLICE_BYTES, MEMO = 6 << 20, 800_000
MASK_DELTA = 0xA282EAD8
LENGTH, SUM, HEAD = "<Q", "<I", "<qBBI"
INDEX = ("doc_id long, part int, file_no int, file string, byte_offset long, byte_length long, n_tokens long, "
         "start_in_file long")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(LENGTH, len(payload))
    return b"".join((length, struct.pack(SUM, masked(length)), payload, struct.pack(SUM, masked(payload))))


def unframe(data: bytes) -> bytes:
    """The payload of one framed record; ValueError if a checksum is wrong."""
    length, payload = data[:8], data[12:-4]
    if (len(data) < 16 or struct.pack(SUM, masked(length)) != data[8:12]
            or struct.unpack(LENGTH, length)[0] != len(payload) or struct.pack(SUM, masked(payload)) != data[-4:]):
        raise ValueError("damaged record")
    return payload


def serialize(doc: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack(HEAD, doc or 0, doc is None, width, len(ids)) + ids.astype(f"<u{width}").tobytes()


def deserialize(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc, null, width, n = struct.unpack_from(HEAD, payload)
    return None if null else doc, np.frombuffer(payload, f"<u{width}", n, struct.calcsize(HEAD))


def write_records(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  end_id: int = 2, out_dir: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode every document, write the files below ``out_dir`` (default: a
    fresh folder of the shared one) and return the committed offset index with
    ``start``, the ids of all documents before."""
    spark = docs.sparkSession
    out = (out_dir or scratch_path(spark, "records")).rstrip("/")
    store, root = filesystem(out)
    store.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer_path, MEMO), TaskContext.get().partitionId()
        width = 2 if enc.vocabulary <= 1 << 16 and end_id < 1 << 16 else 4
        fs, base = filesystem(out)
        stream, file_no, name, at, before, held = None, -1, "", 0, 0, bytearray()
        try:
            for batch in batches:
                for a, b in slices(batch.column(1), SLICE_BYTES):
                    ids, ends = enc.encode(batch.column(1).slice(a, b - a))
                    rows = []
                    for i, doc in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                        if stream is None or at >= file_bytes:
                            if stream is not None:
                                stream.write(bytes(held))
                                stream.close()
                            file_no, at, before, held = file_no + 1, 0, 0, bytearray()
                            name = f"part-{part:07d}-{file_no:04d}-{uuid.uuid4().hex}.rec"
                            stream = fs.open_output_stream(f"{base}/{name}")
                        own = np.append(ids[ends[i]:ends[i + 1]], np.uint32(end_id))
                        record = frame(serialize(doc, own, width))
                        held += record
                        rows.append((doc, part, file_no, f"{out}/{name}", at, len(record), len(own), before))
                        at, before = at + len(record), before + len(own)
                        if len(held) >= FLUSH_BYTES:
                            stream.write(bytes(held))
                            held = bytearray()
                    columns = zip(*rows)
                    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4)
                    names = ["doc_id", "part", "file_no", "file", "byte_offset", "byte_length", "n_tokens",
                             "start_in_file"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        finally:
            if stream is not None:
                stream.write(bytes(held))
                stream.close()

    source = docs.select(col(docs, id_col).cast("long").alias("doc_id"),
                         F.coalesce(col(docs, text_col).cast("string"), F.lit("")).alias("text"))
    salt = F.xxhash64("text")  # rows of one hot id spread over ranges, copies stay in order
    ordered = source.repartitionByRange("doc_id", salt).sortWithinPartitions("doc_id", salt, "text")
    index = stored(ordered.mapInArrow(run, INDEX), "record-index")
    files = index.groupBy("part", "file_no", "file").agg(F.sum("n_tokens").alias("_tokens"))
    files = files.withColumn("_key", F.col("part") * F.lit(10000).cast("long") + F.col("file_no"))
    starts = prefix_sums(files.select("file", "_key", "_tokens"), "_key", "_tokens", "_before")
    return (index.join(starts.select("file", "_before"), "file")
            .withColumn("start", F.col("_before") + F.col("start_in_file")).drop("_before"))


def read_records(index: DataFrame) -> DataFrame:
    """Read back the records that ``index`` names (all, a sample, or any
    order): checks both checksums and returns doc_id, start, n_tokens and ids
    (little-endian unsigned 32-bit), all but start from the files. Index rows
    go to tasks by file, and each task reads its files forward."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, stream = None, None
        for batch in batches:
            docs, starts, counts, held, out = [], [], [], 0, []
            for file, offset, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    if stream is not None:
                        stream.close()
                    fs, path = filesystem(file)
                    name, stream = file, fs.open_input_file(path)
                doc, ids = deserialize(unframe(stream.read_at(length, offset)))
                docs.append(doc)
                starts.append(start)
                counts.append(len(ids))
                out.append(ids.astype("<u4").tobytes())
                held += len(out[-1])
                if held >= FLUSH_BYTES:
                    yield _read_batch(docs, starts, counts, out)
                    docs, starts, counts, held, out = [], [], [], 0, []
            yield _read_batch(docs, starts, counts, out)
        if stream is not None:
            stream.close()

    rows = by_file(index.select("file", "byte_offset", "byte_length", "start"))
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _read_batch(docs, starts, counts, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()),
                                       pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                                      names=["doc_id", "start", "n_tokens", "ids"])
