"""Importance resampling against a plain version."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from touchline.llm import resampling
from touchline.llm.resampling import PositionCrc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, longest=2):
    w = WORD.findall((text or "").translate(brute.LOWER))
    return w, [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, percent=25, buckets=10_000, least=20, longest=2):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (collections.Counter(bucket(f) for _, x in rows for f in runs(x, longest)[1]) for rows in (docs, target))
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for doc, text in docs:
        words, features = runs(text, longest)
        weight = sum(gain(bucket(f)) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(words), len(features), weight, score, None])
    some = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(some[:percent * len(some) // 100], 1):
        r[5] = rank
    return sorted(map(tuple, out), key=str)


def test_matches_plain(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdÉß7") for _ in range(rng.choice([1, 2, 3])))
    text = lambda n: "".join(word() + rng.choice([" ", "\n", "-", ", ", "\x00", " "]) for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(150)] + [(i % 3, "same words here " * 9) for i in range(40)]
    docs += [(500, None), (501, ""), (None, text(30)), (None, None), (502, "A" * 70_000 + " b" + "é" * 5000), (503, ".,;"),
             (504, " ".join(f"w{i % 91}" for i in range(80_000)))]
    target = [(1, text(300)), (2, None), (3, "same words")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for c in ("score", "rank", "bucket", "_row", "a.b"):
        df = df.withColumn(c, F.lit("keep"))
    aim = spark.createDataFrame(target, "item_id long, text string")
    key = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert key(resampling.resample(df, aim).collect()) == plain(docs, target)
    got = resampling.resample(df, aim, percent=60, buckets=97, longest=3, min_words=5)
    assert key(got.collect()) == plain(docs, target, 60, 97, 5, 3)
    drawn = resampling.draw(df, aim)
    assert drawn.columns == df.columns
    assert {r.doc_id for r in drawn.collect()} == {r[0] for r in plain(docs, target) if r[5]}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(i, "one two three " * 10) for i in range(8)], "doc_id long, text string")
    none = docs.where("false")
    assert resampling.resample(none, docs).count() == 0
    rows = resampling.resample(docs, none).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2]


def test_text_ids(spark):
    docs = spark.createDataFrame([(f"id-{i}", "one two three " * 10) for i in range(8)], "doc_id string, text string")
    assert {r.doc_id for r in resampling.resample(docs, docs).collect()} == {f"id-{i}" for i in range(8)}


@settings(max_examples=60, deadline=None)
@given(data=st.binary(min_size=1, max_size=700), span=st.sampled_from([1, 3, 8, 64]), seed=st.integers(0, 999))
def test_position_table_equals_zlib(data, span, seed):
    rng = random.Random(seed)
    begins = [rng.randrange(len(data)) for _ in range(20)]
    lengths = [rng.randrange(1, len(data) - b + 1) for b in begins]
    got = PositionCrc(span).crc32(np.frombuffer(data, np.uint8), np.array(begins), np.array(lengths))
    assert got.tolist() == [zlib.crc32(data[b:b + n]) for b, n in zip(begins, lengths)]


@pytest.mark.parametrize("n", [64 * 1000, 64 * 1000 + 1, 64 * 1023 + 63])
def test_very_long_span(n):
    data = bytes(i * 7 % 251 for i in range(n))
    assert PositionCrc().crc32(np.frombuffer(data, np.uint8), np.array([0]), np.array([n])).tolist() == [zlib.crc32(data)]
