"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprint: 64 bits; bit i is 1 if it is set in over half of the XXH64 hashes
(seed 42) of the text's 3-word shingles, repeats included. A-Z are lower-cased,
words are runs of other characters than the six ASCII blanks; a text of fewer
words is one shingle; a text of none has fingerprint zero.

Links: fingerprints that differ in at most ``max_bits`` bits. Equal fingerprints
are first folded to one. By the pigeonhole principle two fingerprints that
differ in at most 3 bits agree in one of 4 groups of 16 bits, so each one is
routed to 4 buckets of an equal bit group. A bucket that is larger than
``bucket_rows`` is split further, exactly: its remaining bits are cut into 4
groups again, and pairs in it must agree on one of those; nothing is capped.

Within a bucket the fingerprints are sorted by Gray rank, so that neighbours
differ in few bits. Runs of 16 form the leaves of a hierarchical index, runs of
16 leaves the next level, and so on. A node holds the masked bit pattern that
all fingerprints below it share. A search runs down from the root and adds, node
by node, the bits in which the query differs from what that node's pattern adds
to its parent's; as soon as the sum exceeds ``max_bits`` the whole group is
pruned. All queries of a bucket go down level by level in numpy arrays.

Links are reduced to one star per connected part of a bucket before they leave
the task, so a group of thousands of near copies yields rows in proportion to
its members. Components over all buckets come from alternating large-star and
small-star rounds on DataFrames, each stored in the shared folder.

Nulls and ties: a null text counts as empty; null ids are never smallest unless
all are null; repeated rows are documents of their own, of which
``dedup`` keeps one; an empty table gives no rows. Other columns of ``dedup``'s
input pass through unread.

Texts of any length are processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import col, fresh_name, maybe_broadcast, slices, stored

BITS = 64
SHINGLE = 3
MAX_BITS = 3
SEED = 42
FANOUT = 16
BUCKET_ROWS = 4096
#: Entries of a search front handled at once.
FRONT = 1 << 20
#: Shingles hashed at once of one text.
SHINGLES_AT_ONCE = 1 << 18
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    begin = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    end = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        h = np.fromiter((digest(joined[b:e], SEED) for b, e in zip(begin[at:at + SHINGLES_AT_ONCE],
                                                                   end[at:at + SHINGLES_AT_ONCE])), "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                      out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` (default: all) plus the fingerprint as a long."""
    keep = docs.columns if keep is None else keep
    text = fresh_name(docs, "t")
    source = docs.select(*(col(docs, c) for c in keep),
                         F.coalesce(col(docs, text_col).cast("string"), F.lit("")).alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            prints = [fingerprint(x, shingle) for a, b in slices(texts) for x in texts.slice(a, b - a).to_pylist()]
            prints = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], prints], names=[*batch.schema.names[:-1], out])

    return source.mapInArrow(run, source.drop(text).withColumn(out, F.lit(0).cast("long")).schema)


def gray_rank(bits: Column) -> Column:
    """Position of a 64-bit pattern in the reflected Gray code, made sortable as
    a signed long."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits.bitwiseXOR(F.lit(-(1 << 63)))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bit_groups(fixed: int, max_bits: int) -> list[int]:
    """Cut the bits outside ``fixed`` into max_bits + 1 groups: two patterns
    that differ in at most max_bits of them agree in one group."""
    free = [i for i in range(BITS) if not fixed >> i & 1]
    k = max_bits + 1
    return [fixed | sum(1 << i for i in free[j * len(free) // k:(j + 1) * len(free) // k]) for j in range(k)]


def links(prints: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Stars (a, b), b the smallest of a's part of a bucket, that connect
    exactly what links of at most ``max_bits`` bits connect. ``prints`` has the
    distinct fingerprints in column ``fingerprint``."""
    fixed, found = [0], None
    routed = prints.select("fingerprint", F.lit(0).cast("long").alias("mask"))
    while True:
        groups = {mask: bit_groups(mask, max_bits) for mask in fixed}
        child = F.create_map(*(x for mask, to in groups.items() for x in (
            F.lit(_signed(mask)), F.array(*(F.lit(_signed(t)) for t in to)))))
        routed = (routed.select("fingerprint", F.explode(child[F.col("mask")]).alias("mask"))
                  .withColumn("pattern", F.col("fingerprint").bitwiseAND(F.col("mask"))))
        crowded = routed.groupBy("mask", "pattern").count().where(F.col("count") > bucket_rows)
        crowded = stored(crowded.select("mask", "pattern"), "crowded")
        # masks of crowded buckets: at most (max_bits + 1) ** depth numbers, whatever the input
        fixed = sorted(r.mask & (1 << BITS) - 1 for r in crowded.select("mask").distinct().collect())
        deeper = any(mask != (1 << BITS) - 1 for mask in fixed)
        small = routed.join(crowded, ["mask", "pattern"], "left_anti") if deeper else routed
        stars = _bucket_stars(small, max_bits)
        found = stars if found is None else found.unionByName(stars)
        if not deeper:
            return found
        routed = stored(routed.join(crowded, ["mask", "pattern"], "left_semi").select("fingerprint", "mask"), "routed")


def _bucket_stars(routed: DataFrame, max_bits: int) -> DataFrame:
    rank = gray_rank(F.col("fingerprint").bitwiseAND(F.bitwise_not("mask")))
    dealt = (routed.repartition("mask", "pattern").withColumn("_rank", rank)
             .sortWithinPartitions("mask", "pattern", "_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mask, pattern, codes in _whole_buckets(batches):
            a, b = search(mask, pattern, codes, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                             names=["a", "b"])

    return dealt.select("mask", "pattern", "fingerprint").mapInArrow(run, "a long, b long")


def _whole_buckets(batches: Iterator[pa.RecordBatch]):
    """Regroup sorted batches so that no bucket is cut in two."""
    rest = None
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now)]
        n = len(now[0])
        if not n:
            continue
        new = np.flatnonzero((now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1]))
        cut = int(new[-1]) + 1 if len(new) else 0
        if cut:
            yield now[0][:cut], now[1][:cut], now[2][:cut].view(np.uint64)
        rest = [x[cut:] for x in now]
    if rest is not None and len(rest[0]):
        yield rest[0], rest[1], rest[2].view(np.uint64)


def search(mask: np.ndarray, pattern: np.ndarray, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of the linked parts of each bucket in a run of whole buckets, each
    sorted by Gray rank."""
    n = len(codes)
    new = np.concatenate(([True], (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])))
    # level 0: the codes; level k: nodes over up to FANOUT nodes of level k - 1, never across buckets.
    # (shared bits, their values, one past the last code below, first node below)
    levels = [(np.full(n, ~np.uint64(0)), codes, np.arange(n) + 1, np.arange(n))]
    lows = highs = codes
    bucket, starts = np.cumsum(new) - 1, np.flatnonzero(new)
    while True:
        below = len(bucket)
        inside = np.arange(below) - starts[bucket]
        begin = np.flatnonzero(inside % FANOUT == 0)
        lows, highs = np.bitwise_and.reduceat(lows, begin), np.bitwise_or.reduceat(highs, begin)
        ones = ~(lows ^ highs)
        last = levels[-1][2][np.concatenate((begin[1:], [below])) - 1]
        levels.append((ones, lows & ones, last, begin))
        bucket = bucket[begin]
        starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        if len(starts) == len(bucket):  # one root for each bucket
            break
    sizes = np.diff(last, prepend=0)
    root = np.repeat(np.arange(len(sizes)), sizes)
    label = np.arange(n)
    query = 0
    reach = np.cumsum(sizes[root])  # the front can't exceed this many entries
    while query < n:
        until = max(query + 1, int(np.searchsorted(reach, (reach[query - 1] if query else 0) + FRONT)))
        i, j = _descend(np.arange(query, until), root[query:until], levels, codes, max_bits)
        _unite(label, i, j)
        query = until
    label = _roots(label)
    linked = np.flatnonzero(label != np.arange(n))
    return codes[linked], codes[label[linked]]


def _descend(query, node, levels, codes, max_bits):
    """All pairs query < code within reach, from the roots down."""
    ones, value = levels[-1][:2]
    spent = np.bitwise_count((codes[query] ^ value[node]) & ones[node]).astype(np.int64)
    alive = spent <= max_bits
    query, node, spent = query[alive], node[alive], spent[alive]
    for upper in range(len(levels) - 1, 0, -1):
        ones, begin = levels[upper][0], levels[upper][3]
        below_ones, below_value, below_last = levels[upper - 1][:3]
        count = np.concatenate((begin[1:], [len(below_ones)]))[node] - begin[node]
        child = np.repeat(begin[node] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        query, spent, known = np.repeat(query, count), np.repeat(spent, count), np.repeat(ones[node], count)
        later = below_last[child] > query + 1
        query, spent, known, child = query[later], spent[later], known[later], child[later]
        spent = spent + np.bitwise_count((codes[query] ^ below_value[child]) & below_ones[child] & ~known)
        alive = spent <= max_bits
        query, node, spent = query[alive], child[alive], spent[alive]
    return query, node


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label
        label = up


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the parts of linked positions, in place; the smallest is the root."""
    while len(i):
        label[:] = _roots(label)
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a, b): root is the smallest node
    reachable. Large-star and small-star rounds; every round is an aggregation
    and a join, so a hub's neighbours never gather in one task."""
    now = stored(_proper(edges), "edges")
    state = None
    while True:
        now = stored(_small_star(_large_star(now)), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = seen


def _proper(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, once each."""
    return (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _proper(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    rest = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _proper(own.unionByName(rest))


def groups(printed: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(fingerprint, root): the component of each fingerprint that has links."""
    distinct = stored(printed.select("fingerprint").distinct(), "prints")
    return components(links(distinct, max_bits, bucket_rows)).withColumnRenamed("node", "fingerprint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id (the
    smallest doc_id reachable over links, its own included)."""
    narrow = docs.select(col(docs, id_col).alias("doc_id"), col(docs, text_col).alias("text"))
    printed = stored(with_fingerprints(narrow, keep=["doc_id"], shingle=shingle), "fingerprints")
    least = printed.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    named = least.join(groups(printed, max_bits), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint"))
    component = named.groupBy("root").agg(F.min("least").alias("component_id"))
    final = named.join(component, "root").select("fingerprint", "component_id")
    return printed.join(final, "fingerprint").select("doc_id", "fingerprint", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
          max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component stays, the one with the smallest id (the
    first of equal ones), with all columns."""
    mark, row = fresh_name(docs, "fingerprint"), fresh_name(docs, "row")
    printed = with_fingerprints(docs, text_col, out=mark, shingle=shingle)
    held = stored(printed.withColumn(row, F.monotonically_increasing_id()), "fingerprinted")
    order = F.struct(col(held, id_col).isNull().alias("n"), col(held, id_col).alias("i"), F.col(row).alias("r"))
    least = held.groupBy(F.col(mark).alias("fingerprint")).agg(F.min(order).alias("least"))
    linked = groups(held.select(F.col(mark).alias("fingerprint")), max_bits)
    named = least.join(linked, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    first = named.groupBy("root").agg(F.min("least").alias("first"))
    stays = named.join(first, "root").select(F.col("fingerprint").alias(mark), F.col("first.r").alias("_stays"))
    # rows that go, from narrow columns; the texts are shuffled only if these rows are too many to broadcast
    gone = stored(held.select(mark, row).join(stays, mark).where(F.col(row) != F.col("_stays")).select(row), "gone")
    return held.join(maybe_broadcast(gone, 32), row, "left_anti").select(*(col(held, c) for c in docs.columns))
