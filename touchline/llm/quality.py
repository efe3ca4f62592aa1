"""Quality rules with adaptive thresholds.

Method: per document a few ratios are measured; per (language, source) their
distribution is kept in a mergeable quantile sketch, and a document is judged by
the quantiles of its own group instead of fixed cutoffs.

The sketch is a relational DDSketch: a value falls in the bucket
``ceil(log_g(value))`` with ``g = (1 + a) / (1 - a)``, so a bucket's middle is
within the relative error ``a`` of all its values. Sketches merge by adding
bucket counts; counting is an ordinary aggregation with map-side combine, so a
source with a third of all rows never meets in one task. A group's sketch is
merged with its language's, and that with the one of all documents, at the fixed
weight of ``parent_rows`` rows whatever the group's size: a small group leans on
its parents, a large one hardly, and no size switches between them.

A ratio fails where it exceeds ``q3 + max(fence * (q3 - q1), spare / size)``: the
far outliers of its group. ``q3 - q1`` counts as 2 * a * q3 at least, since the
sketch knows its quartiles no closer. ``size`` is the group's median number of words or lines,
from its sketch too, and ``spare`` the occurrences that a document of that size may
have beyond q3, so that a group in which nearly all documents score zero doesn't
reject the first one that doesn't. Word length has no ``spare``. No limit is a
constant: each comes from quantiles of its group.

Base rules (fixed values of the task): fewer than 50 words, or more than half of
the words in repeated 3-word windows.

Nulls and ties: a null text has no words and fails the base rules; null language
or source form a group of their own; repeated rows are judged alike; an empty
table gives no rows; a text of any length is measured whole. Other columns, with
any name, pass through ``filter_quality`` unread."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import col, fresh_name, maybe_broadcast, slices, stored

MIN_WORDS = 50
MOST_REPEATED = 50  # percent of the words
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
ACCURACY = 0.01
FENCE = 6.0
#: Rows that the parents' merged sketch counts in a group's, and units of a row's count.
PARENT_ROWS, UNIT = 100, 10_000_000
#: ratio: occurrences to spare in a document of its group's median size, and the measure of size
SPARE = {"symbol_ratio": (40, "n_words"), "dup_line_ratio": (4, "n_lines"), "repeat_ratio": (100, "n_words")}
RATIOS = (*SPARE, "word_length")
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
#: Texts with more words are counted with arrays instead of Python objects.
LONG_TEXT = 200_000


def _repeated(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more, the first included."""
    n = len(words) - 2
    if n < 2:
        return 0
    if len(words) <= LONG_TEXT:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == n:
            return 0
        again = pd.Series(windows).duplicated(keep=False).to_numpy()
    else:
        code, _ = pd.factorize(np.array(words, dtype=object))
        pair = np.unique(code[:-1].astype(np.int64) * (code.max() + 1) + code[1:], return_inverse=True)[1]
        again = pd.Series(pair[:-1].astype(np.int64) * (code.max() + 1) + code[2:]).duplicated(keep=False).to_numpy()
    hit = np.zeros(len(words), bool)
    hit[:-2] |= again
    hit[1:-1] |= again
    hit[2:] |= again
    return int(hit.sum())


def measure(text: str) -> tuple[int, ...]:
    words = text.encode().split()  # bytes split at exactly these six blanks
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), _repeated(words))


def measures(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) plus one struct column ``m`` (renamed
    if taken) of MEASURES."""
    keep = docs.columns if keep is None else keep
    name, text = fresh_name(docs, "m"), "text"
    # by position: mapInArrow can't take a column with a dot in its name
    source = docs.select(*(col(docs, c).alias(f"c{i}") for i, c in enumerate(keep)),
                         F.coalesce(col(docs, text_col).cast("string"), F.lit("")).alias(text))
    fields = [f.split()[0] for f in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(x) for a, b in slices(batch.column(text)) for x in batch.column(text).slice(a, b - a)
                    .to_pylist()]
            rows = zip(*rows) if rows else [()] * len(fields)
            m = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in rows], names=fields)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], m], names=[*batch.schema.names[:-1], name])

    schema = source.drop(text).withColumn(name, F.lit(None).cast(f"struct<{MEASURES.replace(' ', ':')
                                                                           .replace(',:', ',')}>")).schema
    return source.mapInArrow(run, schema).toDF(*keep, name)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def ratios(m: Column) -> dict[str, Column]:
    words, lines = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["n_lines"], F.lit(1))
    return {"symbol_ratio": m["n_symbols"] / words, "dup_line_ratio": m["n_dup_lines"] / lines,
            "repeat_ratio": m["n_repeat_words"] / words, "word_length": m["word_chars"] / words}


def sketches(measured: DataFrame, m: Column, lang: Column, source: Column, accuracy: float = ACCURACY) -> DataFrame:
    """One row per (lang, source, ratio, bucket) with its count; bucket null
    holds the zeros. The two sizes are sketched like the ratios. Documents that
    fail the base rules are left out."""
    base = math.log((1 + accuracy) / (1 - accuracy))
    bucket = lambda v: F.when(v > 0, F.ceil(F.log(v) / base))
    values = {**ratios(m), **{k: m[k].cast("double") for k in sorted({size for _, size in SPARE.values()})}}
    cells = F.array(*(F.struct(F.lit(k).alias("ratio"), bucket(v).alias("bucket")) for k, v in values.items()))
    return (measured.where(~base_failed(m)).select(lang.alias("lang"), source.alias("source"), F.inline(cells))
            .groupBy("lang", "source", "ratio", "bucket").agg(F.count(F.lit(1)).alias("n")))


def quantiles(sketch: DataFrame, keys: list[str], out: dict[str, float], accuracy: float = ACCURACY) -> DataFrame:
    """Quantiles (name: q) of each group of a sketch: the middle of the bucket that
    holds the row of rank ceil(q * n)."""
    g = (1 + accuracy) / (1 - accuracy)
    over = Window.partitionBy(*keys).orderBy(F.col("bucket").asc_nulls_first())
    ranked = sketch.withColumn("_upto", F.sum("n").over(over)).withColumn("_all", F.sum("n").over(
        Window.partitionBy(*keys)))
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(2 * F.pow(F.lit(g), F.col("bucket")) / (g + 1))
    return ranked.groupBy(*keys).agg(*(F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * q), value)).alias(name)
                                       for name, q in out.items()))


def with_parents(sketch: DataFrame, parent_rows: int = PARENT_ROWS) -> DataFrame:
    """Each (lang, source) sketch merged with its parents': the language's
    buckets, which hold those of all documents in turn, count as ``parent_rows``
    rows more. A group of any size is judged by such a sketch, so one row more or
    less moves its limits a little. Counts are in units of 1 / UNIT rows."""
    def shares(merged: DataFrame, keys: list[str]) -> DataFrame:
        total = F.sum("n").over(Window.partitionBy(*keys, "ratio"))
        return merged.withColumn("n", F.floor(F.lit(float(UNIT * parent_rows)) * F.col("n") / total).cast("long"))

    def merged(own: DataFrame, keys: list[str], parent: DataFrame, by: list[str]) -> DataFrame:
        groups, parent = own.select(*keys, "ratio").distinct(), parent.withColumnsRenamed({k: "_" + k for k in (*by, "ratio")})
        same = [groups[k].eqNullSafe(parent["_" + k]) for k in (*by, "ratio")]
        lent = groups.join(parent, same).select(*keys, "ratio", "bucket", "n")
        return own.withColumn("n", F.col("n") * UNIT).unionByName(lent).groupBy(*keys, "ratio", "bucket").agg(
            F.sum("n").alias("n"))

    everything = shares(sketch.groupBy("ratio", "bucket").agg(F.sum("n").alias("n")), [])
    of_lang = sketch.groupBy("lang", "ratio", "bucket").agg(F.sum("n").alias("n"))
    of_lang = shares(merged(of_lang, ["lang"], everything, []), ["lang"])
    return merged(sketch.select("lang", "source", "ratio", "bucket", "n"), ["lang", "source"], of_lang, ["lang"])


def thresholds(sketch: DataFrame, fence: float = FENCE, parent_rows: int = PARENT_ROWS,
               spare: dict[str, tuple[float, str]] | None = None, accuracy: float = ACCURACY) -> DataFrame:
    """Per (lang, source) one column of upper limits per ratio, from the group's
    sketch merged with its parents'."""
    spare = SPARE if spare is None else spare
    found = quantiles(with_parents(sketch, parent_rows), ["lang", "source", "ratio"], {"q1": 0.25, "q2": 0.5, "q3": 0.75},
                      accuracy)
    of = lambda ratio, q: F.max(F.when(F.col("ratio") == ratio, F.col(q)))

    def limit(r: str) -> Column:
        far = fence * F.greatest(of(r, "q3") - of(r, "q1"), 2 * accuracy * of(r, "q3"))
        return of(r, "q3") + (F.greatest(far, spare[r][0] / of(spare[r][1], "q2")) if r in spare else far)

    return found.groupBy("lang", "source").agg(*(limit(r).alias("most_" + r) for r in RATIOS))


def judge(measured: DataFrame, m: str, limits: DataFrame, lang: Column, source: Column, out: str) -> DataFrame:
    """Join each document to its group's limits and add ``out``, the verdict.
    Limits have one row per group; they are broadcast while that is small."""
    of_lang, of_source, most = (fresh_name(measured, x) for x in ("_q_lang", "_q_source", "_q_most"))
    named = limits.select(F.col("lang").alias(of_lang), F.col("source").alias(of_source),
                          F.struct(*(c for c in limits.columns if c.startswith("most_"))).alias(most))
    same = lang.eqNullSafe(named[of_lang]) & source.eqNullSafe(named[of_source])
    fits = F.lit(True)
    for r, v in ratios(F.col(m)).items():
        fits &= F.coalesce(v <= named[most]["most_" + r], F.lit(True))
    return (measured.join(maybe_broadcast(named, 120), same, "left")
            .withColumn(out, ~base_failed(F.col(m)) & fits).drop(of_lang, of_source, most))


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
           id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, kept. The
    measures are stored once (without the texts) and serve sketch and verdict."""
    narrow = docs.select(col(docs, id_col).alias("doc_id"), col(docs, lang_col).alias("lang"),
                         col(docs, source_col).alias("source"), col(docs, text_col).alias("text"))
    measured = stored(measures(narrow, keep=["doc_id", "lang", "source"]), "quality")
    lang, source, m = F.col("lang"), F.col("source"), F.col("m")
    limits = stored(thresholds(stored(sketches(measured, m, lang, source), "sketch")), "limits")
    return (judge(measured, "m", limits, lang, source, "kept")
            .select("doc_id", "m.*", base_failed(m).alias("base_failed"), "kept"))


def filter_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source") -> DataFrame:
    """The documents that are kept, with all their columns. Texts are measured
    twice, for the sketch and for the filter, which costs less than storing
    another copy of them."""
    narrow = docs.select(col(docs, lang_col).alias("lang"), col(docs, source_col).alias("source"),
                         col(docs, text_col).alias("text"))
    first = measures(narrow, keep=["lang", "source"])
    sketch = stored(sketches(first, F.col("m"), F.col("lang"), F.col("source")), "sketch")
    limits = stored(thresholds(sketch), "limits")
    measured, m, out = measures(docs, text_col), fresh_name(docs, "m"), fresh_name(docs, "kept")
    verdict = judge(measured, m, limits, col(measured, lang_col), col(measured, source_col), out)
    return verdict.where(F.col(out)).select(*(col(verdict, c) for c in docs.columns))
