"""Every registered query of the subpackage against brute force or its SQL."""

import collections
import os
import zlib

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.llm import brute
from tools.oracle_check import TABLES, digest
from touchline.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := os.path.join(sf_small, f"{t}.parquet")):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_mod.queries())
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_small, con, name):
    df = QUERIES[name](spark, sf_small)
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    got = digest(df.columns, [tuple(r) for r in df.collect()])[1]
    assert got == digest(columns, want.fetchall())[1]


def test_packing(spark, sf_small, docs):
    rows = QUERIES["op1_packing"](spark, sf_small).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for (doc, _), ids in zip(docs, brute.token_ids("word_bpe_49k.json", [t for _, t in docs])):
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(brute.u32(ids[at:at + r.length]))
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    held = sum(r.length for rows in sequences.values() for r in rows)
    assert held > 0.97 * 4096 * (len(sequences) - 1)


def test_decontamination(spark, sf_small, con, docs):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontamination"](spark, sf_small).collect()}
    assert got == brute.leaks(docs, items) and got


def test_simhash(spark, sf_small, docs):
    got = {r.doc_id: r for r in QUERIES["op8_simhash"](spark, sf_small).collect()}
    prints = [brute.fingerprint(t) for _, t in docs]
    roots = brute.linked(prints)
    for (doc, _), p, root in zip(docs, prints, roots):
        assert (got[doc].fingerprint, got[doc].component_id) == (f"{p:016x}", docs[root][0])


def test_sharding(spark, sf_small, docs):
    rows = QUERIES["op9_sharding"](spark, sf_small).collect()
    texts = {d: (t or "").encode() for d, t in docs}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_records(spark, sf_small, docs):
    got = {r.doc_id: r for r in QUERIES["op10_records"](spark, sf_small).collect()}
    at = 0
    for (doc, _), ids in zip(docs, brute.token_ids("byte_bpe_50k.json", [t for _, t in docs])):
        r = got[doc]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(brute.u32(ids)))
        at += len(ids)


def test_url_filter(spark, sf_small, con):
    got = {r.page_id: r for r in QUERIES["op4_url_filter"](spark, sf_small).collect()}
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/")]
    for page, url in con.execute("SELECT page_id, url FROM pages").fetchall():
        rest = url.partition("://")[2]
        cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail.split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for v, h, p in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        r = got[page]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.verdict == max(fits)[2] if fits else r.verdict in ("block", "allow")
