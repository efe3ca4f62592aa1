"""Secret scans with a trigram index, in DataFrame functions only.

Method: from each rule's regular expression a Boolean query over trigrams is
derived (what any match must contain, lower-cased): alternatives become OR,
consecutive literals AND. The inverted index holds, for each trigram that some
query names, the texts that contain it (by 64-bit hash of the text). Postings
are intersected by counting a text's trigrams as bits; texts that satisfy a
rule's query are its candidates, and only those are verified with the regular
expression. A rule without mandatory trigrams scans all texts. Two texts with
one hash merely share their candidates, as verification is exact.

Candidates are broadcast while their table is small, else joined by hash; the
join splits a text that many documents share (adaptive skew join).

Spans count code points, end exclusive; matches of one rule are leftmost and
non-overlapping; a match whose value is shorter than the rule's least length is
dropped after matching.

Nulls and ties: a null text counts as empty and has no spans; repeated rows get
the same spans each; ids may be null or repeated; an empty table gives no rows.
``redact`` keeps all columns.

Texts of any length are processed whole.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import col, fresh_name, maybe_broadcast, stored


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0  # least length of the value
    group: int = 0  # group that holds the value


#: The first three are fixed values of the task; their order is the order of kinds.
RULES = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 12, 2),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]+", 16),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("key_block", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
)
BASE_KINDS = 3
#: Alternatives of one stretch that are still listed one by one.
MOST_STRINGS = 64
MOST_CLASS = 8
#: Spans appended one by one within a stretch, so that long lists cost linear time.
STRETCH = 100


def trigram_query(pattern: str) -> list[set[frozenset[str]]]:
    """AND of ORs of ANDs: every match contains, for each element of the list,
    all trigrams of at least one of its sets. An empty list: no condition."""
    clauses: list[set[frozenset[str]]] = []
    _flush(_walk(sre_parser.parse(pattern), {""}, clauses), clauses)
    return clauses


def _flush(strings: set[str], clauses: list) -> set[str]:
    """Turn the strings read so far into a clause; start anew."""
    if all(len(s) >= 3 for s in strings):
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        clauses.append({a for a in sets if not any(b < a for b in sets)})
    return {""}


def _walk(items, strings: set[str], clauses: list) -> set[str]:
    """Follow a parsed expression: ``strings`` are the possible exact texts since
    the last flush."""
    for kind, arg in items:
        options: set[str] | None = None
        if kind is sre.LITERAL:
            options = {chr(arg).lower()}
        elif kind is sre.IN:
            options = _members(arg)
        elif kind is sre.SUBPATTERN:
            strings = _walk(arg[3], strings, clauses)
            continue
        elif kind is sre.BRANCH:
            options = set()
            for branch in arg[1]:
                inner: list = []
                got = _walk(branch, {""}, inner)
                if inner:  # not a plain list of strings
                    options = None
                    break
                options |= got
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, body = arg
            inner = []
            got = _walk(body, {""}, inner)
            if not inner and (most == 1 or least == most == 1):
                options = got | ({""} if least == 0 else set())
            elif least:
                _flush({a + b for a, b in product(strings, got)} if not inner else strings, clauses)
                strings = {""}
                continue
        if options is None or len(strings) * len(options) > MOST_STRINGS:
            strings = _flush(strings, clauses)
            if options is not None:
                strings = options
        else:
            strings = {a + b for a, b in product(strings, options)}
    return strings


def _members(parts) -> set[str] | None:
    out: set[str] = set()
    for kind, arg in parts:
        if kind is sre.LITERAL:
            out.add(chr(arg).lower())
        elif kind is sre.RANGE and arg[1] - arg[0] < MOST_CLASS:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= MOST_CLASS else None


def postings(docs: DataFrame, text: Column, grams: list[str]) -> DataFrame:
    """(gram, key): the inverted index over ``grams`` (by number)."""
    low = fresh_name(docs, "low")
    seen = docs.select(F.xxhash64(text).alias("key"), F.lower(text).alias(low))
    present = F.array(*(F.when(F.contains(F.col(low), F.lit(g)), F.lit(i)) for i, g in enumerate(grams)))
    return seen.select(F.explode(F.array_compact(present)).alias("gram"), "key")


def candidates(index: DataFrame, grams: list[str], queries: dict[int, list[set[frozenset[str]]]]) -> DataFrame:
    """(key, rules): bit r of ``rules`` is set if the text satisfies query r."""
    number = {g: i for i, g in enumerate(grams)}
    bits = [F.bit_or(F.when(F.floor(F.col("gram") / 60) == w, F.expr(f"shiftleft(1L, gram - {60 * w})"))
                     .otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(1 + max(0, len(grams) - 1) // 60)]
    texts = index.groupBy("key").agg(*bits)

    def holds(one: frozenset[str]) -> Column:
        out = F.lit(True)
        for w in range(len(bits)):
            need = sum(1 << number[g] % 60 for g in one if number[g] // 60 == w)
            if need:
                out &= F.col(f"w{w}").bitwiseAND(F.lit(need)) == need
        return out

    rules = F.lit(0).cast("long")
    for r, clauses in queries.items():
        every = F.lit(True)
        for clause in clauses:
            some = F.lit(False)
            for one in sorted(clause, key=sorted):
                some |= holds(one)
            every &= some
        rules = rules.bitwiseOR(F.when(every, F.lit(1 << r).cast("long")).otherwise(F.lit(0).cast("long")))
    return texts.select("key", rules.alias("rules")).where("rules <> 0")


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, kind number, end) of one rule. Between two matches lie
    the parts that ``split`` returns, so starts are running sums of lengths."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    parts = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("hit"), values.alias("value"))
    parts = F.filter(parts, lambda x: x["hit"].isNotNull())
    kind = "array<struct<start:long,kind:int,end:long>>"

    def one(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        span = F.array(F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end")))
        keep = F.when(F.char_length(x["value"]) >= rule.least, span).otherwise(F.array().cast(kind))
        return F.struct(end.alias("at"), F.concat(state["out"], keep).alias("out"))

    def of(bound: Column) -> Column:
        def stretch(state: Column, i: Column) -> Column:
            zero = F.struct(state["at"].alias("at"), F.array().cast(kind).alias("out"))
            inner = F.transform(F.array(F.aggregate(F.slice(bound, i, F.lit(STRETCH)), zero, one)), lambda s: F.struct(
                s["at"].alias("at"), F.concat(state["out"], F.array(s["out"])).alias("out")))
            return F.get(inner, F.lit(0))

        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(bound), F.lit(1)), F.lit(STRETCH))
        return F.flatten(F.aggregate(firsts, zero, stretch, lambda s: s["out"]))

    return F.flatten(F.transform(F.array(parts), of))  # the matches are bound once, as an array's only element


def with_spans(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
               out: str = "spans") -> DataFrame:
    """All columns plus ``out``: array of (start, kind number, end), by start,
    then kind."""
    queries = {r: q for r, rule in enumerate(rules) if (q := trigram_query(rule.pattern))}
    grams = sorted({g for q in queries.values() for clause in q for one in clause for g in one})
    text = F.coalesce(col(docs, text_col).cast("string"), F.lit(""))
    index = stored(postings(docs, text, grams), "trigrams")
    found = stored(candidates(index, grams, queries), "candidates")
    key, bits = fresh_name(docs, "key"), fresh_name(docs, "rules")
    found = maybe_broadcast(found.select(F.col("key").alias(key), F.col("rules").alias(bits)), 64)
    joined = docs.withColumn(key, F.xxhash64(text)).join(found, key, "left")
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    lists = []
    for r, rule in enumerate(rules):
        if r in queries:
            chosen = F.coalesce(F.col(bits).bitwiseAND(F.lit(1 << r)) != 0, F.lit(False))
        else:
            chosen = F.regexp_like(text, F.lit(_scan_pattern(rule)))
        lists.append(F.when(chosen, _spans(text, rule, r)).otherwise(none))
    spans = F.array_sort(F.concat(*lists))
    return joined.withColumn(out, spans).drop(key, bits)


def _scan_pattern(rule: Rule) -> str:
    """What a full scan looks for first: the pattern itself, or, if it is one
    repeated class without group, a run of the least length."""
    if not rule.group and rule.pattern.endswith("]+") and rule.pattern.startswith("[") and rule.least:
        return f"{rule.pattern[:-1]}{{{rule.least}}}"
    return rule.pattern


def joined_spans(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id and its spans."""
    narrow = docs.select(col(docs, id_col).alias("doc_id"), col(docs, text_col).alias("text"))
    return with_spans(narrow, "text", rules).select("doc_id", "spans")


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All documents with all columns; each stretch of overlapping spans in the
    text is replaced by ``[kind]`` of the span that begins it. Texts without
    spans stay as they are."""
    name = fresh_name(docs, "spans")
    marked = with_spans(docs, text_col, rules, name)
    text, names = col(marked, text_col), F.array(*(F.lit(f"[{r.kind}]") for r in rules))

    def cut(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        before = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(state["out"], F.array(before, F.element_at(names, s["kind"] + 1))))
                        .otherwise(state["out"]).alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate(F.col(name), zero, cut, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(text, (s["at"] + 1).cast("int"), F.char_length(text))))
    new = F.when(F.size(F.col(name)) > 0, clean).otherwise(text)
    return marked.select(*((new if c == text_col else col(marked, c)).alias(c) for c in docs.columns))
