"""Nearest neighbours against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import neighbours as nn

SMALL = {"band_rows": 40, "block_rows": 16, "band_queries": 8}


def plain(rows, k=20, every=20):
    sound = [(i, v) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = []
    for a, (q, v) in enumerate(sound):
        if q % every == 0:
            scores = []
            for b, (c, w) in enumerate(sound):
                if a != b and len(v) == len(w):
                    total = 0.0
                    for x, y in zip(v, w):
                        total += x * y
                    scores.append((-total, c))
            out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def floats(x):
    return [float(y) for y in np.asarray(x, np.float32)]


def check(spark, rows, kind="float", **parameters):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("band", F.lit(1)).withColumn(
        "a.b", F.lit(2)).repartition(3)
    got = nn.neighbours(df, **{**SMALL, **parameters}).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain(rows, parameters.get("k", 20))


def test_random_vectors_with_groups_of_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, floats(rng.normal(size=12))) for i in range(150)]
    copy = floats(rng.normal(size=12))
    rows += [(i, copy) for i in range(200, 280)] + [(300 + i, floats(np.array(copy) * 2)) for i in range(3)]
    check(spark, rows)
    check(spark, rows, k=3)


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.5, None]), (40, None), (60, []), (80, [0.0, 0.0]),
            (100, [float("nan"), 1.0]), (120, [float("inf"), 1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [-1.0, 3.0]),
            (140, [1.0, 2.0, 3.0]), (3, [1.0, 1.0, 1.0]), (160, [7.0]), (-20, [2.0, 2.0])]
    check(spark, rows)
    check(spark, rows[6:7])
    check(spark, [])


def test_extreme_magnitudes(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=5) * 10.0 ** rng.integers(-300, 140)]) for i in range(60)]
    rows += [(100, [1e-320, 0.0, 1e-310, 0.0, 0.0]), (101, [5e-324] * 5), (120, [1e150, -1e-150, 0.0, 1.0, 2.0])]
    check(spark, rows, kind="double")


@pytest.mark.parametrize("dim", [1, 64, 2500])
def test_bounds_hold(dim):
    rng = np.random.default_rng(dim)
    made = [nn.Block.of(np.arange(30), np.arange(30), (rng.normal(size=(30, dim)) * rng.choice([1e-3, 1, 50], (30, 1))).astype(
        np.float32)) for _ in range(2)]
    estimate, room = nn.bounds(*made)
    exact = made[0].vectors.astype(float) @ made[1].vectors.astype(float).T
    assert (np.abs(estimate - exact) <= room).all()
    assert (room <= 0.05 * np.outer(made[0].norms, made[1].norms) + 1e-9).all()


def test_few_pairs_are_computed_again(monkeypatch):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(2000, 64)).astype(np.float32)
    done = []
    monkeypatch.setattr(nn, "exact_scores", lambda *a, f=nn.exact_scores: done.append(len(a[2])) or f(*a))
    lists = nn.Lists(nn.Block.of(np.arange(50), np.arange(50), vectors[:50]), 20)
    for a in range(0, 2000, 500):
        lists.add(nn.Block.of(np.arange(a, a + 500), np.arange(a, a + 500), vectors[a:a + 500]))
    assert sum(done) < 0.1 * 50 * 2000
