"""WARC archives with a merged capture index.

Writing: each task streams its captures into archive files (one gzip member per
record), a record of an equal payload as a revisit of the one with the smallest
id. Each file's index entries, ordered by (URL key, timestamp, id), are one
sorted run.

Method: external index merge. The runs are range-partitioned by (URL key,
timestamp, id, run and place in it); in each range the pieces of the runs, still
sorted, meet in a k-way loser-tree merge. Ranges follow one another, so the
stored index is globally ordered and lists each URL's captures in time order; a
URL with a third of all captures is split over ranges by time, and captures that
share time and id too by their runs. Ranges number one for each ``RANGE_ENTRIES``
entries at least, so a task's memory does not grow with the index; payloads are
not in it.

Archive files have names of their own per task attempt; only files named by the
committed index count, so lost executors leave at worst unreferenced files.

Record ids are UUIDs that hold the capture's id, so a revisit's
WARC-Refers-To names its response's id.

Nulls and ties: a null payload is empty; null ids sort last and count as no id
(all copies of a payload without any id are responses); rows that share id and
payload are alike; a null url is the empty URL; an empty table gives an empty
index. Other columns are not read.

Payloads of any length are processed whole.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import by_file, col, filesystem, maybe_broadcast, stored
from touchline.session import scratch_path

FILE_BYTES = 256 << 20
FLUSH_BYTES = 2 << 20
LEVEL = 6
#: Index entries of one range, about.
RANGE_ENTRIES = 250_000
ENTRY = ("url_key string, ts string, id long, record_type string, payload_digest string, run string, run_pos long, "
         "file string, byte_offset long, byte_length long")
NO_ID = "ffffffff-ffff-ffff-ffff-ffffffffffff"


def url_key(url: Column) -> Column:
    """Sort-friendly form: scheme dropped, host parts reversed, lower-cased."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), "^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), F.lit(")"), path)


def _uuid(page: int | None) -> str:
    return NO_ID if page is None else str(uuid.UUID(int=page & (1 << 64) - 1))


def _from_uuid(text: str) -> int | None:
    if text == NO_ID:
        return None
    value = uuid.UUID(text).int
    return value - (1 << 64) if value >> 63 else value


def record(page: int | None, url: str, ts: str, payload: bytes, refers_to: int | None, revisit: bool,
           digest: str) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit keeps the HTTP header
    (with the payload's length) and leaves out the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            .encode())
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:uuid:{_uuid(page)}>", f"WARC-Date: {ts}",
             f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:uuid:{_uuid(refers_to)}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + pack.flush()


def parse(member: bytes) -> dict:
    """Header fields, HTTP header fields and payload of one gzip member."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields | {"http": dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), "payload": payload}


def write_archives(captures: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   ts_col: str = "ts", out_dir: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all captures below ``out_dir`` (default: a fresh folder of the
    shared one); returns the runs, one row per record."""
    spark = captures.sparkSession
    out = (out_dir or scratch_path(spark, "warc")).rstrip("/")
    store, root = filesystem(out)
    store.create_dir(root, recursive=True)
    payload = F.encode(F.coalesce(col(captures, payload_col).cast("string"), F.lit("")), "UTF-8")
    source = captures.select(
        col(captures, id_col).cast("long").alias("id"),
        # a line break in a url would end its header line
        F.regexp_replace(F.coalesce(col(captures, url_col).cast("string"), F.lit("")), "[\r\n]", "").alias("url"),
        F.coalesce(F.date_format(col(captures, ts_col), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("1970-01-01T00:00:00Z"))
        .alias("ts"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    # only payloads that occur more than once; their table is broadcast while small
    copies = stored(source.groupBy("sha1").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
                    .where("n > 1 and first is not null").select("sha1", "first"), "copies")
    dealt = (source.join(maybe_broadcast(copies, 96), "sha1", "left")
             .select("id", url_key(F.col("url")).alias("url_key"), "url", "ts", "payload", "first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(out)
        part, file_no = TaskContext.get().partitionId(), 0
        stream, name, at, held, entries = None, "", 0, bytearray(), []

        def close() -> pa.RecordBatch:
            stream.write(bytes(held))
            stream.close()
            ordered = sorted(entries, key=lambda e: (e[0], e[1], e[2] is None, e[2] or 0))
            ordered = [(*e[:5], name, k, f"{out}/{name}", *e[5:]) for k, e in enumerate(ordered)]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(),
                     pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ordered), kinds)],
                                              names=[f.split()[0] for f in ENTRY.split(", ")])

        for batch in batches:
            columns = [batch.column(c) for c in ("id", "url_key", "url", "ts", "payload", "first")]
            for i in range(batch.num_rows):
                page, key, url, ts, body, first = (c[i].as_py() for c in columns)
                if stream is None:
                    name = f"warc-{part:07d}-{file_no:04d}-{uuid.uuid4().hex}.warc.gz"
                    stream, at, held, entries, file_no = fs.open_output_stream(f"{base}/{name}", compression=None), \
                        0, bytearray(), [], file_no + 1
                revisit = first is not None and page != first
                digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
                member = record(page, url, ts, body, first, revisit, digest)
                entries.append((key, ts, page, "revisit" if revisit else "response", digest, at, len(member)))
                held += member
                at += len(member)
                if len(held) >= FLUSH_BYTES:
                    stream.write(bytes(held))
                    held.clear()
                if at >= file_bytes:
                    yield close()
                    stream = None
        if stream is not None:
            yield close()

    return stored(dealt.mapInArrow(run, ENTRY), "runs")


class LoserTree:
    """Smallest head of k sorted lists; each step replays one path of log2(k)
    matches, in which the loser stays and the winner goes up."""

    def __init__(self, lists: list[list]):
        self.lists, self.at, self.k = lists, [0] * len(lists), len(lists)
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i, fresh=True)

    def _head(self, i: int):
        return self.lists[i][self.at[i]] if self.at[i] < len(self.lists[i]) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, winner: int, fresh: bool = False) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if fresh and other < 0:
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.k and self._head(self.losers[0]) is not None:
            i = self.losers[0]
            yield self._head(i)
            self.at[i] += 1
            self._play(i)


def merge_runs(runs: DataFrame, range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """The globally ordered index: all entries plus (part, pos), whose order is
    that of (URL key, timestamp, id), stored in that order. ``runs`` is a stored
    table, as ``write_archives`` returns it."""
    names = [f.split()[0] for f in ENTRY.split(", ")]
    key = [F.col("url_key"), F.col("ts"), F.col("id").asc_nulls_last(), F.col("run"), F.col("run_pos")]
    ranges = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                 -(-runs.count() // range_entries))
    ranged = runs.repartitionByRange(ranges, *key).sortWithinPartitions("run", "run_pos").select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        held = pa.Table.from_batches(rows).combine_chunks()
        keys = list(zip(held["url_key"].to_pylist(), held["ts"].to_pylist(),
                        [(x is None, x or 0) for x in held["id"].to_pylist()], range(held.num_rows)))
        files = held["run"].to_pylist()
        cuts = [0, *(i for i in range(1, len(files)) if files[i] != files[i - 1]), len(files)]
        order = [k[3] for k in LoserTree([keys[a:b] for a, b in zip(cuts, cuts[1:])])]
        merged = held.take(pa.array(order, pa.int64()))
        merged = merged.append_column("part", pa.array([part] * len(order), pa.int32()))
        yield from merged.append_column("pos", pa.array(range(len(order)), pa.int64())).combine_chunks().to_batches()

    return stored(ranged.mapInArrow(run, ENTRY + ", part int, pos long"), "cdx")


def histories(index: DataFrame) -> DataFrame:
    """Each URL's captures numbered in time order, with the digest before.
    (part, pos) is the order already, so a window per URL key and part is joined
    by counts of the parts before; a URL split over parts is never gathered."""
    inside = Window.partitionBy("url_key", "part").orderBy("pos")
    counts = index.groupBy("url_key", "part").agg(F.count(F.lit(1)).alias("_n"),
                                                  F.max_by("payload_digest", "pos").alias("_last"))
    over = Window.partitionBy("url_key").orderBy("part")
    before = counts.select("url_key", "part", (F.sum("_n").over(over) - F.col("_n")).alias("_base"),
                           F.lag("_last").over(over).alias("_carried"))
    return (index.withColumn("_no", F.row_number().over(inside))
            .withColumn("_prev", F.lag("payload_digest").over(inside)).join(before, ["url_key", "part"])
            .withColumn("capture_no", F.col("_base") + F.col("_no"))
            .withColumn("previous_digest", F.coalesce("_prev", "_carried"))
            .drop("_no", "_base", "_prev", "_carried"))


def read_archives(index: DataFrame) -> DataFrame:
    """Read back the records that ``index`` names: page_id, url, ts,
    record_type, refers_to, payload_bytes, payload_digest (as recorded; checked
    against the payload where there is one), payload (null for revisits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, stream = None, None
        for batch in batches:
            out, held = [], 0
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "byte_offset",
                                                                                    "byte_length"))):
                if file != name:
                    if stream is not None:
                        stream.close()
                    fs, path = filesystem(file)
                    name, stream = file, fs.open_input_file(path)
                r = parse(stream.read_at(length, offset))
                digest, revisit = r["WARC-Payload-Digest"].removeprefix("sha1:"), r["WARC-Type"] == "revisit"
                if not revisit and base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode() != digest:
                    raise ValueError(f"damaged record in {file} at {offset}")
                ident = lambda f: _from_uuid(r[f][10:-1]) if f in r else None  # noqa: B023, E731
                out.append((ident("WARC-Record-ID"), r["WARC-Target-URI"], r["WARC-Date"], r["WARC-Type"],
                            ident("WARC-Refers-To"), int(r["http"]["Content-Length"]), digest,
                            None if revisit else r["payload"]))
                held += len(r["payload"])
                if held >= FLUSH_BYTES:
                    yield _read_batch(out)
                    out, held = [], 0
            if out:
                yield _read_batch(out)
        if stream is not None:
            stream.close()

    rows = by_file(index.select("file", "byte_offset", "byte_length"))
    return rows.mapInArrow(run, READ)


READ = ("page_id long, url string, ts string, record_type string, refers_to long, payload_bytes long, "
        "payload_digest string, payload binary")


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=[f.split()[0] for f in READ.split(", ")])
