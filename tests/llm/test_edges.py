"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
extra columns, for every operator."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from tests.llm import brute
from touchline.llm import chat, decontam, packing, quality, records, secrets, sharding, simhash, urls, warc
from touchline.llm.tokens import encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 977} q{i % 31}" for i in range(60_000)) + "\n" + "x" * 300_000
ROWS = [(1, "one two three four", "en", "a"), (1, "one two three four", "en", "a"), (2, None, None, None),
        (None, "  \n\t ", "en", None), (3, "", "de", "a"), (4, LONG, "en", "b"), (5, "Ünï cödé \U0001f600 <|im_end|> in<|endoftext|>side <|startoftext|>", "fr", "a"),
        (None, None, None, None)]
#: Extra columns whose names operators use inside.
CLASH = ["m", "t", "key", "rules", "spans", "fingerprint", "row", "kept", "_row", "shard", "n_words", "a b"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").withColumn(
        "n_chars", F.char_length("text").cast("long"))
    for c in CLASH:
        df = df.withColumn(c, F.lit("keep"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def none(rows):
    return rows.where("doc_id > 100")


SPECIAL = ["<|endoftext|>", "<|startoftext|>"]


@pytest.mark.parametrize("path", [WORDS, BYTES])
@settings(max_examples=80, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from([*SPECIAL, *SPECIAL, "a", "Zé", " ", "  ", "\n", ".", "a.", ",", "~", "|>", "<|", "\n~\n"]),
                               max_size=9).map("".join), max_size=5))
def test_special_strings_are_the_library_s_tokens(path, texts):
    from tokenizers import Tokenizer

    for as_text in (False, True):
        bare = Tokenizer.from_file(path)
        if as_text:
            bare.encode_special_tokens = True
        ids, ends = encoder(path, special_as_text=as_text).encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [
            bare.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [WORDS, BYTES])
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("aZé\u0301ñ '.,~1_ \n\t\r\x1c\x1f\x85\xa0\u200b\u180e\u2028\u3000<|>Σ"),
                              max_size=30), max_size=6))
def test_encoder_equals_the_library(path, texts):
    enc = encoder(path)
    ids, ends = enc.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [enc._ids(t) for t in texts]


def test_packing(rows, none):
    got = packing.pack(rows, WORDS, window=64, open_windows=2, fan_in=2).collect()
    want = {}
    for doc, text, *_ in ROWS:
        ids = brute.token_ids("word_bpe_49k.json", [text])[0]
        want[doc, brute.u32(ids)] = want.get((doc, brute.u32(ids)), 0) + 1
    assert sum(r.length for r in got) == sum(len(k[1]) // 4 * n for k, n in want.items())
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 64
    assert sum(1 for p in filled.values() if sum(n for _, n in p) < 64) <= 1 + sum(len(p) > 0 for p in filled.values()) // 4
    whole = packing.sequences(packing.pack(rows, WORDS, window=64), 64).collect()
    assert all(len(r.ids) == 256 for r in whole)
    assert packing.pack(none, WORDS).count() == 0


def test_chat(spark):
    texts = ["<|im_end|>", "<\\|x", "a\\n<|", None, "", "<\\\\||>", LONG[:50_000], "tail \n"]
    turns = [(7, i, role, t) for i, t in enumerate(texts) for role in ("user", "assistant", None, "we\\ird\nro<|le")]
    turns += [(7, 0, "user", "<|im_end|>"), (None, None, "assistant", "x"), (8, 0, "assistant", None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    formatted = chat.format_chat(df, BYTES).cache()
    read = chat.read_chat(formatted, BYTES).orderBy("part", "position").collect()
    plain = lambda r: (r["conv_id"], r["turn"], r["role"] or "", r["text"] or "")
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(plain, read), key=key) == sorted((map(plain, df.collect())), key=key)
    assert all(r.loss_text == (r.text if r.role == "assistant" else "") for r in read)
    place = {}
    for r in formatted.orderBy("part", "position").collect():
        assert r.token_start == place.get(r.conv_id, 0)
        assert r.token_start <= r.loss_start <= r.loss_end <= r.token_start + r.n_ids
        place[r.conv_id] = r.token_start + r.n_ids
    assert chat.format_chat(df.where("turn > 99"), BYTES).count() == 0


def test_decontamination(spark, rows, none):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((8, 20, 40, 64, 65, 130, 300))]
    noise = lambda n: " ".join(word() for _ in range(n))
    docs = [(i, noise(200) + " " + t.upper().replace(" ", ", ") + ". " + noise(150)) for i, t in items]
    docs += [(100 + i, t) for i, t in items] + [(200, noise(3000)), (201, None), (202, ""), (None, items[2][1])]
    docs += [(300 + i, noise(40) + " " + " ".join(t.split()[:len(t.split()) // 2])) for i, t in items]  # halves are clean
    changed = items[3][1].split()
    changed[30] = "other"
    docs += [(400, noise(50) + " " + " ".join(changed)), (401, items[1][1] + " " + items[2][1])]
    table = spark.createDataFrame([*items, (50, None), (51, ""), (50, None)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("t", F.lit("keep"))
    got = {(r.doc_id, r.item_id) for r in decontam.find_matches(df, table).collect()}
    assert got == {(i, i) for i, _ in items} | {(100 + i, i) for i, _ in items} | {
        (None, 2), (400, 3), (401, 1), (401, 2)}
    kept = decontam.decontaminate(df.withColumn("a.b", F.lit(1)).withColumn("c0", F.lit(2)), table)
    assert kept.columns == [*df.columns, "a.b", "c0"]
    assert {r.doc_id for r in kept.collect()} == {200, 201, 202} | {300 + i for i, _ in items}
    assert decontam.find_matches(rows, table.where("false")).count() == 0
    assert decontam.decontaminate(none, table).count() == 0
    assert decontam.decontaminate(rows, table).count() == len(ROWS)


def test_item_groups_are_bounded_though_one_item_repeats(spark):
    rows = [(1, "same words in every copy")] * 40 + [(i, f"item number {i} " * (i % 5)) for i in range(2, 30)]
    rows += [(99, "long " * 300), (100, None), (None, "no id")]
    table = spark.createDataFrame(rows, "item_id long, text string").repartition(4)
    groups = list(decontam.item_groups(table, "item_id", "text", None, group_bytes=1000))
    cost = lambda g: sum(decontam.ITEM_BYTES + len(" ".join(q + a)) for _, q, a in g)
    assert len(groups) > 4 and all(cost(g[1:]) <= 1000 or cost(g) <= 2600 for g in groups)
    got = [(i, " ".join(q + a)) for g in groups for i, q, a in g]
    assert sorted(got, key=str) == sorted(((i, " ".join(t.split())) for i, t in rows if t and t.split()), key=str)
    assert list(decontam.item_groups(table.where("false"), "item_id", "text", None)) == [[]]


def test_wand_returns_all_above_threshold():
    rng = random.Random(3)
    import numpy as np
    words = ["a", "b", "c"]  # so few that items share shingles
    items = [(i, [rng.choice(words) for _ in range(rng.randrange(1, 90))], [rng.choice(words) for _ in range(30)])
             for i in range(50)]
    index = decontam.ItemIndex(items)
    assert len(index.post_part) > 2 * len(index.code) > 100 and len(index.part_item) > 60
    dropped = 0
    for n in range(1, 41):
        query = np.array(sorted(rng.sample(range(len(index.code)), n)))
        score = [0.0] * len(index.part_item)
        for p, t, x in zip(index.of_part, index.held, index.impact):
            score[p] += x / index.least[index.part_item[p]] * (t in query)
        want = {p: round(s, 9) for p, s in enumerate(score) if s >= 1 - 1e-9}
        dropped += sum(0 < s < 1 - 1e-9 for s in score)
        assert {p: round(s, 9) for p, s in index.search(query)} == want
    assert dropped > 100


def test_urls(spark):
    model = urls.train(urls.labelled_urls(spark))
    given_ = [(1, "HTTP://A.NET/x"), (1, "HTTP://A.NET/x"), (2, None), (3, "no scheme"), (4, "://"), (5, "a://b://c/d"),
              (6, "http://example.net/en/?q=/en/"), (7, "http://evil-example.net/en/1"), (8, "http://x.org/fr"),
              (9, "http://org/fr/#a"), (10, "http://net"), (None, "http://ä.example.com/de/" + "z" * 50_000)]
    df = spark.createDataFrame(given_, "page_id long, url string").withColumn("host", F.lit("keep"))
    got = [(r.page_id, r.host, r.path[:9], r.rule, r.verdict) for r in urls.judge(df, model).collect()]
    assert len(got) == len(given_)
    by = {g[0]: g[1:] for g in got}
    assert by[1] == ("a.net", "/x", "net/", "block") and by[2][:3] == ("", "", None) and by[3][:3] == ("", "", None)
    assert by[4][:3] == ("", "", None) and by[5][:3] == ("b:", "//c/d", None)
    assert by[6] == ("example.net", "/en/", "example.net/en/", "allow")
    assert by[7] == ("evil-example.net", "/en/1", "net/", "block") and by[8][2] is None
    assert by[9] == ("org", "/fr/", "org/fr/", "allow") and by[10][:3] == ("net", "", None)
    assert by[None] == ("ä.example.com", "/de/zzzzz", "example.com/de/", "block")
    assert urls.judge(df.where("false"), model).count() == 0


def test_url_model_on_held_out_hosts(spark):
    held = urls.labelled_urls(spark).withColumn("out", F.pmod(F.xxhash64("url"), F.lit(4)) == 0)
    model = urls.train(held.where("not out"))
    test = held.where("out").select(F.monotonically_increasing_id().alias("page_id"), "url", "label").cache()
    got = urls.judge(test, model, rules=(("allow", "none.invalid/"),)).join(test, "page_id")
    right = got.where((F.col("verdict") == "block") == (F.col("label") == 1)).count()
    assert right >= 0.95 * test.count()


def test_url_model_on_held_out_words(spark):
    """Words that no labelled URL has, in four folds: each is judged by a model
    that has not seen it. Bounds a little under what was measured."""
    caught = called = bad = 0
    for fold in range(4):
        out = {w for words in (urls.BLOCK_WORDS, urls.ALLOW_WORDS) for w in words[fold::4]}
        unseen = [(i, f"https://{w}.example.org/en/12", int(w in urls.BLOCK_WORDS)) for i, w in enumerate(sorted(out))]
        held = F.regexp_extract("url", r"//(?:www\.|m\.|blog\.)?([^.]*)", 1)
        model = urls.train(urls.labelled_urls(spark).where(~held.isin(*out)))
        got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(unseen, "page_id long, url string, label int"),
                                                        model, rules=(("allow", "none.invalid/"),)).collect()}
        for i, _, label in unseen:
            caught += label and got[i] == "block"
            called += got[i] == "block"
            bad += label
    print("recall", caught / bad, "precision", caught / called)
    assert caught >= 0.6 * bad and caught >= 0.8 * called


def _murmur3(data, seed=42):
    rot = lambda x, r: (x << r | x >> (32 - r)) & 0xFFFFFFFF
    mix = lambda k: rot(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
    h, whole = seed, len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = (rot(h ^ mix(int.from_bytes(data[i:i + 4], "little")), 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    if data[whole:]:
        h ^= mix(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def test_url_scores_equal_a_plain_logistic_score(spark, sf_small):
    model = urls.train(urls.labelled_urls(spark))
    weight, constant = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    extra = [(-1, "http://a/"), (-2, None), (-3, "x://é.org/ü"), (-4, "x://casino.example.org"), (-5, "x://" + "ab" * 9000)]
    df = spark.read.parquet(f"{sf_small}/pages.parquet").select("page_id", "url").union(
        spark.createDataFrame(extra, "page_id long, url string"))
    seen = set()
    for r in urls.judge(df, model).collect():
        found = set()
        for prefix, text in (("h", f"^{r.host}$"), ("p", f"^{r.path}$")):
            for n in (3, 4, 5):
                found |= {prefix + text[i:i + n] for i in range(len(text) - n + 1)}
        score = constant + sum(weight[k] for k in {_murmur3(g.encode()) % urls.FEATURES for g in found})
        p = 1 / (1 + math.exp(-score))
        assert abs(p - r.block_probability) < 1e-9
        if r.rule is None:
            assert r.verdict == ("block" if p >= 0.5 else "allow")
            seen.add(r.verdict)
    assert seen == {"block", "allow"}


def test_trigram_queries():
    clauses = secrets.trigram_query(secrets.RULES[0].pattern)
    assert {"tok", "oke", "ken"} in [set(s) for s in clauses[0]] and len(clauses[0]) == 6
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [{frozenset({"aki", "kia"})}]
    assert secrets.trigram_query("[0-9a-f]+") == [] and secrets.trigram_query("a?b") == []
    assert secrets.trigram_query("(abc)+x") == [{frozenset({"abc"})}]
    assert secrets.trigram_query("(abc|x)def") == [{frozenset({"abc", "bcd", "cde", "def"}), frozenset({"xde", "def"})}]


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(
    ["token", "PassWord", "api_key", " ", "=", ":", "'", '"', "abcdef0123456789ab", "AKIA", "ABCDEFGHIJ0123", "é", "\n",
     "xy", "ghp_", "a" * 36, "xoxb-", "-----BEGIN RSA PRIVATE KEY-----", "😀"]), max_size=25).map("".join), min_size=1, max_size=12))
def test_secrets_equal_brute_force(spark, texts):
    texts = [*texts, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans] for r in secrets.scan(df).collect()}
    for i, t in enumerate(texts):
        want = sorted((m.start(), k, m.end()) for k, r in enumerate(secrets.RULES)
                      for m in re.finditer(r.pattern, t or "") if len(m[r.group]) >= r.least)
        assert got[i] == want


def test_secrets_edges(rows, none):
    many = " ".join(f"{i:016x}" for i in range(5000))
    df = rows.withColumn("text", F.when(F.col("doc_id") == 3, F.lit(f"a token: {'z' * 12}é{many}")).otherwise(F.col("text")))
    clean = secrets.redact(df)
    assert clean.columns == df.columns
    got = sorted((r.text or "" for r in clean.collect()), key=len)
    assert sorted(t or "" for _, t, *_ in ROWS if t) == sorted(t for t in got if t and "[hex]" not in t)
    redacted = next(t for t in got if "[hex]" in t)
    assert redacted == "a [assign]é" + " ".join(["[hex]"] * 5000)
    assert secrets.scan(none).count() == 0 and secrets.scan(rows).count() == len(ROWS)


def test_quality(rows, none, spark):
    got = quality.judged(rows).collect()
    assert len(got) == len(ROWS)
    want = sorted(brute.measures(t) for _, t, *_ in ROWS)
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    kept = quality.filter_quality(rows.withColumn("a.b", F.lit(1)).withColumn("_q_lang", F.lit(2)).withColumn("_q_most", F.lit(3)))
    assert kept.columns == [*rows.columns, "a.b", "_q_lang", "_q_most"]
    kept = quality.filter_quality(rows)
    assert kept.columns == rows.columns and all(not r.base_failed for r in got if r.kept)
    assert quality.judged(none).count() == 0 and quality.filter_quality(none).count() == 0
    good = [(i, " ".join(f"word{i * j % 89}x{j}" for j in range(60)), "en", "s") for i in range(300)]
    bad = [(1000 + i, " ".join(f"#{i * j % 97}** $q{j}" for j in range(60)), "en", "s") for i in range(10)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in quality.filter_quality(df).collect()} == set(range(300))


def _limits(spark, groups, **parameters):
    """Limits of groups (lang, source): word lengths."""
    rows = [(lang, source, math.ceil(math.log(v) / math.log(1.01 / 0.99))) for (lang, source), vs in groups.items() for v in vs]
    sketch = spark.createDataFrame(rows, "lang string, source string, bucket long").groupBy("lang", "source", "bucket").agg(
        F.count("*").alias("n")).withColumn("ratio", F.lit("word_length"))
    got = quality.thresholds(sketch, fence=3, **parameters).collect()
    return {(r.lang, r.source): r.most_word_length for r in got}


def _plain_limits(groups, parent_rows):
    """The same from lists of weighted values."""
    value = lambda v: 2 * (1.01 / 0.99) ** math.ceil(math.log(v) / math.log(1.01 / 0.99)) / (1.01 / 0.99 + 1)
    scaled = lambda some, n: [(v, w * n / sum(w for _, w in some)) for v, w in some]
    every = scaled([(v, 1) for vs in groups.values() for v in vs], parent_rows)
    langs = {lang: [(v, 1) for (x, _), vs in groups.items() if x == lang for v in vs] + every for lang, _ in groups}

    def at(some, q):
        upto, total = 0, sum(w for _, w in some)
        for v, w in sorted(some):
            upto += w
            if upto >= q * total - 1e-6:
                return value(v)

    out = {}
    for (lang, source), vs in groups.items():
        some = [(v, 1) for v in vs] + scaled(langs[lang], parent_rows)
        out[lang, source] = at(some, 0.75) + 3 * (at(some, 0.75) - at(some, 0.25))
    return out


def test_quality_limits_lean_on_parents_at_every_size(spark):
    rng = random.Random(8)
    lengths = lambda n, a, b: [round(rng.uniform(a, b), 3) for _ in range(n)]
    groups = {("en", "a"): lengths(2000, 4, 5), ("en", "b"): lengths(99, 6, 9), ("en", None): lengths(3, 20, 30),
              (None, "a"): lengths(50, 3, 4), ("de", "c"): lengths(1, 8, 9)}
    for parent_rows in (100, 7):
        got, want = _limits(spark, groups, parent_rows=parent_rows), _plain_limits(groups, parent_rows)
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) <= 0.05 * want[k] for k in got), (got, want)
    before = _limits(spark, groups)
    for more in range(1, 4):  # 100 rows and more: no jump
        after = _limits(spark, {**groups, ("en", "b"): groups["en", "b"] + [7.5] * more})
        assert all(abs(after[k] - before[k]) <= 0.1 * before[k] for k in before)


def test_quality_limits_come_from_the_groups_own_quantiles(spark):
    """Also where nearly all documents score zero: the group's median size decides."""
    def docs(source, words, n=200):
        return [(f"{source}{i}", " ".join(f"w{i * 7 + j}x{j}" for j in range(words)), "en", source) for i in range(n)]

    rows = docs("short", 80) + docs("long", 800)
    marked = lambda words, n: " ".join([f"v{j}q{j}" for j in range(words - n)] + [f"c#{j}" for j in range(n)])
    rows += [("s", marked(80, 20), "en", "short"), ("l", marked(800, 200), "en", "long")]  # a quarter of the words each
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    m = quality.measures(df)
    limits = {r.source: r for r in quality.thresholds(quality.sketches(m, F.col("m"), F.col("lang"), F.col("source"))).collect()}
    assert limits["short"].most_symbol_ratio > 4 * limits["long"].most_symbol_ratio
    for source, words in (("short", 80), ("long", 800)):
        for ratio, n in (("symbol_ratio", 40), ("repeat_ratio", 100)):
            assert abs(limits[source]["most_" + ratio] - n / words) <= 0.03 * n / words
    kept = {r.doc_id for r in quality.judged(df).where("kept").collect()}
    assert "s" in kept and "l" not in kept and len(kept) == 401


def test_quality_long_text_counts_alike(monkeypatch):
    text = " ".join(str(i % 7 * (i % 11)) for i in range(500))
    plain = quality.measure(text)
    monkeypatch.setattr(quality, "LONG_TEXT", 10)
    assert quality.measure(text) == plain


def test_warc(spark):
    pages = [(3, "http://b.com/x", "<p>"), (1, "http://b.com/x", "<p>"), (2, None, None), (5, "http://a.com/\r\nX: y", ""),
             (None, "http://b.com/x", "<p>"), (7, "http://b.com/x", LONG), (8, "HTTP://c.b.com/?q#f", "é" * 10), (1, "http://b.com/x", "<p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("first", F.lit("keep")).withColumn(
        "ts", F.timestamp_seconds(F.lit(1_700_000_000) - F.col("page_id"))).repartition(3)
    index = warc.merge_runs(warc.write_archives(df, file_bytes=1 << 10))
    order = [(r.url_key, r.ts, r.id is None, r.id or 0) for r in index.orderBy("part", "pos").collect()]
    assert order == sorted(order) and len(order) == len(pages)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in
                  warc.read_archives(index).collect()), key=str)
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {"<p>": 1, None: 2, "": 2}
    want = []
    for page, _, html in pages:
        to = first.get(html, page)
        revisit = to != page
        want.append((page, "revisit" if revisit else "response", to if revisit else None, len((html or "").encode()), digest(html)))
    assert got == sorted(want, key=str)
    history = warc.histories(index).where("url_key = 'com,b)/x'").orderBy("capture_no").collect()
    assert [r.capture_no for r in history] == [1, 2, 3, 4, 5]
    assert [r.previous_digest for r in history] == [None, *[r.payload_digest for r in history][:-1]]
    assert warc.merge_runs(warc.write_archives(df.where("false"))).count() == 0


def test_warc_ranges_split_captures_that_share_their_key(spark):
    df = spark.range(200).select((F.col("id") % 2).alias("page_id"), F.lit("http://b.com/").alias("url"),
                                 F.lit("same").alias("html"), F.timestamp_seconds(F.lit(1)).alias("ts")).repartition(20)
    index = warc.merge_runs(warc.write_archives(df), range_entries=10)
    assert index.groupBy("part").count().agg(F.max("count")).first()[0] < 100
    assert [r.id for r in index.orderBy("part", "pos").collect()] == [0] * 100 + [1] * 100


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16, 33):
        lists = [sorted(rng.randrange(50) for _ in range(rng.randrange(12))) for _ in range(k)]
        assert list(warc.LoserTree(lists)) == sorted(x for one in lists for x in one)


def test_simhash_edges(rows, none):
    got = simhash.near_duplicates(rows).collect()
    assert len(got) == len(ROWS)
    assert sorted(r.fingerprint & (1 << 64) - 1 for r in got) == sorted(brute.fingerprint(t) for _, t, *_ in ROWS)
    assert {r.component_id for r in got if r.fingerprint == 0} == {2}
    kept = simhash.dedup(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5]
    assert simhash.near_duplicates(none).count() == 0 and simhash.dedup(none).count() == 0


@pytest.mark.parametrize("bucket_rows", [4096, 16])
def test_simhash_links(spark, bucket_rows):
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    prints = set(centres)
    for c in centres[:12]:
        for _ in range(40):
            x = c
            for bit in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.groups(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), bucket_rows=bucket_rows)
    root = {r.fingerprint: r.root for r in found.collect()}
    want = brute.linked(prints)
    classes = {}
    for i, p in enumerate(signed):
        classes.setdefault(want[i], set()).add(root.get(p, p))
    assert all(len(c) == 1 for c in classes.values()) and len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_sharding_edges(rows, none, tmp_path):
    got = sharding.shard(rows, 3).collect()
    assert len(got) == len(ROWS) and {r.shard for r in got} <= {0, 1, 2}
    assert sharding.shard(none, 4).count() == 0 and sharding.shard(rows, target_bytes=1 << 30).first().shard == 0
    sharding.write_shards(rows.withColumnRenamed("a b", "ab"), str(tmp_path / "out"), 2)
    back = rows.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(ROWS) and set(back.columns) == {*rows.columns, "ab", "_shard"} - {"a b"}


def _plain_tree(rows, n_shards):
    """Shard per row by plain recursion. ``rows``: (row, size, place per dimension, tie)."""
    low = [min(r[2][d] for r in rows) for d in range(4)]
    width = [max(r[2][d] for r in rows) - low[d] or 1.0 for d in range(4)]
    nodes, out = [(0, n_shards, [(r, s, [(x - a) / w for x, a, w in zip(at, low, width)], t) for r, s, at, t in rows])], {}
    while nodes:
        first, k, held = nodes.pop()
        if k == 1 or not held:
            out.update({r: first for r, *_ in held})
            continue
        spread = [max(at[d] for _, _, at, _ in held) - min(at[d] for _, _, at, _ in held) for d in range(4)]
        d = spread.index(max(spread))
        key = lambda x: (min(math.floor(x[2][d] * 2 ** 20), 2 ** 20 - 1), x[3])  # noqa: E731, B023
        total, want, left = sum(x[1] for x in held), k // 2, []
        goal, below = total * want / k, 0
        for _, group in itertools.groupby(sorted(held, key=key), key):
            group = list(group)
            more = sum(x[1] for x in group)
            if below + more >= goal:
                if (goal - below) * 2 >= more:
                    left += group
                break
            left, below = left + group, below + more
        gone = {x[0] for x in left}
        nodes += [(first, want, left), (first + want, k - want, [x for x in held if x[0] not in gone])]
    return out


def test_sharding_equals_a_plain_tree(spark, sf_small):
    small = spark.read.parquet(f"{sf_small}/documents.parquet")
    alike = spark.createDataFrame([(i % 9, "same text " * (i % 3), "en" if i % 4 else None, None) for i in range(150)],
                                  "doc_id long, text string, lang string, source string")
    for docs, n in ((small, 16), (small, 5), (alike, 7)):
        rows = sharding.metadata(docs)
        plain = [(r._row, r.size, r._dims, r.tie) for r in rows.withColumn(
            "tie", F.pmod(F.xxhash64("_row"), F.lit(1 << sharding.TIE_BITS))).collect()]
        got = {r._row: r.shard for r in sharding.assign(rows, n).collect()}
        assert got == _plain_tree(plain, n) and set(got.values()) == set(range(n))


def test_sharding_splits_a_hot_group(spark):
    df = spark.createDataFrame([(i, "same text" if i % 3 else f"text {i}" * (i % 9), "en", "hot") for i in range(3000)],
                               "doc_id long, text string, lang string, source string")
    sizes = [r["n"] for r in sharding.shard(df, 16).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) <= 1.03 * min(sizes)


def test_records_edges(rows, none, tmp_path):
    index = records.write_records(rows, BYTES, out_dir=str(tmp_path / "rec"), file_bytes=1 << 12).cache()
    got = records.read_records(index).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, None, 1, 1, 2, 3, 4, 5]
    want = sorted(zlib.crc32(brute.u32(x)) for x in brute.token_ids("byte_bpe_50k.json", [t for _, t, *_ in ROWS]))
    assert sorted(zlib.crc32(r.ids) for r in got) == want
    assert records.read_records(index.where("doc_id = 4")).first().n_tokens > 60_000  # a sample, by the index alone
    assert records.write_records(none, BYTES).count() == 0
    framed = bytearray(records.frame(b"payload"))
    assert records.unframe(bytes(framed)) == b"payload"
    for i in range(len(framed)):
        framed[i] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(framed))
        framed[i] ^= 1


def test_pipeline(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    tokens = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_small)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.schema.names == docs.columns
            before, after = docs.toPandas().set_index("doc_id"), out.toPandas().set_index("doc_id")
            gone = set(before.index) - set(after.index)
            if name == "quality rules":
                judged = quality.judged(docs).toPandas().set_index("doc_id")
                assert gone == set(judged.index[~judged.kept])
            elif name == "simhash near-dedup":
                ids = sorted(before.index)
                roots = brute.linked([brute.fingerprint(before.text[i]) for i in ids])
                assert set(after.index) == {ids[r] for r in roots}
            elif name == "benchmark decontamination":
                items = spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()
                assert gone == {d for d, _ in brute.leaks(list(before.text.items()), [tuple(i) for i in items])}
            else:
                assert not gone
                changed = {i for i in before.index if before.text[i] != after.text[i]}
                spans = {r.doc_id for r in secrets.scan(docs).where(F.size("spans") > 0).collect()}
                assert changed == spans and (after.n_chars == after.text.str.len()).all()
        else:
            for r in docs.select("doc_id", "text").collect():
                tokens[r.doc_id] = len(brute.token_ids("word_bpe_49k.json", [r.text])[0])
            assert {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == tokens
        docs = spark.createDataFrame(out.collect(), out.schema)
