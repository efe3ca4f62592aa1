"""Partial, edited and stretched copies of items against the overlap rule itself."""

import math
import random

import pyarrow as pa

from touchline.llm import decontam


def _grams(words, n=5):
    return [tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []


def _overlaps(docs, items, least=0.5):
    """(doc, item) that reach the overlap near some passage: every passage tried."""
    found = set()
    for d, text in enumerate(docs):
        words = text.split()
        for i, question, answer in items:
            n = len(question) + len(answer)
            for first in range(0, len(words), decontam.STRIDE):
                near = words[max(0, first - n):first + decontam.WINDOW + n]
                there = {k: {tuple(near[j:j + k]) for j in range(len(near) - k + 1)} for k in range(1, 6)}
                if all(sum(g in there[len(g)] for g in side) / max(1, len(side)) >= (least if side else 0)
                       for side in map(_grams, (question, answer))):
                    found.add((d, i))
    return found


def _case(seed=7):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weight = [1 / (i + 1) for i in range(400)]
    some = lambda n: rng.choices(words, weight, k=n)
    items = []
    for i, n in enumerate((3, 8, 9, 12, 20, 33, 41, 48, 55, 59, 64, 65, 90, 130, 200) * 2):
        w = some(n)
        items.append((i, w[:math.ceil(n / 2)], w[math.ceil(n / 2):]))
    docs = []
    for _, question, answer in items:
        w, n = question + answer, len(question) + len(answer)
        docs.append(w[n // 4 - min(2, n // 4):n - n // 4 + 2])  # a middle of a little over half
        docs.append(w[n // 4:n - n // 4])
        docs.append([x if k % 12 else "edited" for k, x in enumerate(w, 1)])
        docs.append([x if k % 7 else "edited" for k, x in enumerate(w, 1)])
        docs.append(question + some(80) + answer)
        docs.append(question[:len(question) // 2 + 3] + some(n) + answer[:len(answer) // 2 + 3])
    return [" ".join(some(rng.randrange(150)) + d + some(90)) for d in docs] + [" ".join(some(2000))], items


def test_every_passage_that_reaches_the_overlap_is_found():
    docs, items = _case()
    got = {(d, i) for d, i, *_ in decontam.ItemIndex(items).matches(pa.array(docs, pa.string()))}
    want = _overlaps(docs, items)
    assert len(want) > len(items) and got == want


def test_the_search_decides(monkeypatch):
    """What it doesn't retrieve is no match, and every item's threshold is above zero."""
    docs, items = _case(8)
    index = decontam.ItemIndex(items)
    assert all(0 < x < math.inf for x in index.least)
    texts, retrieved, search = pa.array(docs, pa.string()), [], decontam.ItemIndex.search
    monkeypatch.setattr(decontam.ItemIndex, "search", lambda self, terms: retrieved.append(1) or search(self, terms))
    whole = sum(-(-len(d.split()) // decontam.STRIDE) for d in docs)
    assert list(index.matches(texts)) and len(retrieved) < whole  # the bounds drop passages
    monkeypatch.setattr(decontam.ItemIndex, "search", lambda self, terms: [])
    assert not list(index.matches(texts))


def test_thresholds_are_safe_at_every_overlap():
    """At any overlap asked for nothing is lost."""
    docs, items = _case(11)
    for overlap in (0.2, 0.5, 0.8, 1.0):
        index = decontam.ItemIndex(items, overlap=overlap)
        got = {(d, i) for d, i, *_ in index.matches(pa.array(docs, pa.string()))}
        want = {(d, i) for d, i in _overlaps(docs, items, overlap)}
        assert got == want and got


def test_scores_do_not_depend_on_the_item_groups(spark):
    docs, items = _case(9)
    items += [(100 + i, q, a[::-1]) for i, q, a in items]  # questions that other groups hold too
    table = spark.createDataFrame([(i, " ".join(q + a)) for i, q, a in items] + [(99, None)],
                                  "item_id long, text string").coalesce(1)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    assert len(list(decontam.item_groups(table, "item_id", "text", None, group_bytes=2000))) > 3
    one, many = (sorted((r.doc_id, r.item_id, round(r.score, 9), r.first_word)
                        for r in decontam.find_matches(df, table, group_bytes=n).collect())
                 for n in (decontam.GROUP_BYTES, 2000))
    assert one == many and one
    alone = decontam.ItemIndex(items[:5])  # a group's own statistics give other scores
    got = {(d, i): round(s, 9) for d, i, s, *_ in alone.matches(pa.array(docs, pa.string()))}
    assert any((d, i) in got and got[d, i] != s for d, i, s, _ in many)


def test_many_item_groups_share_one_python_stage(spark, monkeypatch):
    docs, items = _case(10)
    table = spark.createDataFrame([(i, " ".join(q + a)) for i, q, a in items], "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    assert len(list(decontam.item_groups(table, "item_id", "text", None, group_bytes=800))) >= 10
    plan = lambda out: out._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    dirty = {d for d, *_ in decontam.ItemIndex(items).matches(pa.array(docs, pa.string()))}
    for most in (decontam.STAGE_BYTES, 3200):  # 3200: four groups a stage, written in between
        monkeypatch.setattr(decontam, "STAGE_BYTES", most)
        kept = decontam.decontaminate(df, table, group_bytes=800)
        assert plan(kept) == 1
        assert {r.doc_id for r in kept.collect()} == set(range(len(docs))) - dirty
    monkeypatch.undo()
    assert plan(decontam.find_matches(df, table, group_bytes=800)) == 1
