"""Conversation prefix trie against a plain version."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, shared):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in turns.items()}
    seqs = own
    if shared:
        h = lambda c: zlib.crc32(str(c).encode()) % 6
        seqs = {c: own.get(c - c % 100, [])[:h(c)] + s[h(c):] for c, s in own.items()}
    members, children = collections.defaultdict(list), collections.Counter()
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for n in members:
        if n:
            children[n[:-1]] += 1
    leaves, saved = collections.Counter(), collections.Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += children[n] == 0
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
    return {(min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(n)).encode()).hexdigest())
            for n, m in members.items()}


def check(spark, rows, shared, **parameters):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("a", F.lit("keep")).withColumn("x.y", F.lit(1)).repartition(3)
    got = [tuple(r) for r in trie.prefix_trie(df, shared, **parameters).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, shared)


@pytest.mark.parametrize("shared", [False, True])
def test_random_conversations(spark, shared):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["yes", "no", "ü"])) for c in range(0, 320, 2)
            for t in range(rng.randrange(1, 9))]
    check(spark, rows, shared, most_arcs=40)  # many rounds of the list ranking


def test_edges(spark):
    long = "word " * 50_000
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "a"), (1, None, None, None),
            (2, None, "", ""), (2, 5, "user", long), (7, 1, "user", long), (None, 0, "user", "a"), (9, 3, None, None),
            (3, 0, "a\n", "b"), (4, 0, "a", "\nb"), (5, 0, "1:a", "b"), (100, 0, "u", "x"), (105, 0, "u", "y"),
            (199, 0, "u", "only"), (-3, 0, "u", "below zero")]
    for shared in (False, True):
        check(spark, [r for r in rows if not shared or (r[0] or 0) >= 0], shared, most_arcs=3)
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA), True).count() == 0
    check(spark, [(5, 0, None, None)], True)  # no first conversation of its group: its turns after the first h


def test_one_conversation_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "XOR_BLOCK", 4)
    monkeypatch.setattr(trie, "SUM_BLOCK", 8)
    rows = [(c, t, "user", str(t % 3 if t < 40 else t + c)) for c in (1, 2, 3) for t in range(50)] + [(4, 0, "user", "0")]
    check(spark, rows, False, most_arcs=16)


def test_ids_joined_in_pieces(spark):
    rows = [(d, 1, 2, c) for d, n in ((1, 500), (2, 1)) for c in range(n)]
    ends = spark.createDataFrame(rows, "depth long, x long, y long, conv long").repartition(5)
    got = {r.depth: r.ends_sha256 for r in trie.joined_id_hashes(ends, piece_bytes=30).collect()}
    assert got == {d: hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest() for d, n in ((1, 500), (2, 1))}


@pytest.mark.parametrize("n", [0, 1, 2, 777])
def test_list_rank(spark, n):
    order = random.Random(n).sample(range(10 * n), n)
    links = spark.createDataFrame(list(zip(order, [*order[1:], None])), "id long, next long")
    assert {r.id: r.place for r in trie.list_rank(links, most=20).collect()} == {x: i for i, x in enumerate(order)}
