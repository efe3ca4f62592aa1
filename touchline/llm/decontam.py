"""Benchmark decontamination: documents that hold items of a benchmark.

Method: a BM25 inverted index of the test items, searched with block-max WAND.
An item is a question and an answer; without an answer column the first half of its
words is the question and the rest the answer. A document matches an item if, near
one of its passages (the passage and as many words on both sides as the item has),
at least ``overlap`` of the five-word shingles of the question and of the answer
occur. Passages are windows of WINDOW words, every STRIDE words.

The terms of the index are those shingles (a side of fewer words is one term), its
documents are parts of items of at most PART shingles. Each item has a threshold of
its own that no match can miss: a match holds, of each side, at least the needed
number of shingles; so the heaviest of those is no lighter than the side's
needed-lightest shingle, and it lies whole in a passage, which scores that much for
the part that holds it. The larger of the two sides' values is the item's threshold.
It is never zero. (With words as terms the same bound is nearly zero, as common words
can make up half of an item; every passage would be retrieved.) Impacts are divided
by it, so one threshold of 1 fits long and short items:

* the passages with a term of the index are the queries; per block of consecutive
  parts an upper bound is summed from the blocks' largest impacts, for all passages
  of a slice at once; passages that reach 1 in no block are dropped;
* the rest run document-at-a-time block-max WAND: cursors in order of their
  current part, the pivot by global maxima, a second test by block maxima that
  skips whole blocks, exact scores only then.

Only what the search retrieves is verified: the overlaps of question and answer are
taken near the passages around each hit, and of those that count the one with the
highest score (part of the score of the item's own part) is reported. An overlap of 0
still needs one shared shingle.

The items are the stated query set. They are indexed in groups of at most
GROUP_BYTES (or one larger item), cut from the running sum of their sizes, and
every group meets all documents; the documents are never shuffled or gathered. One
Python stage splits a text into words once and searches the groups of up to
STAGE_BYTES; a worker builds their indexes once. A larger benchmark takes more
stages, so a worker's memory does not follow it. Part count, mean length and shingle
frequencies are those of the whole benchmark, so scores and thresholds don't depend
on which items share a group.

Nulls and ties: null or wordless texts and items match nothing; null ids stay
null; repeated documents are reported repeatedly, repeated items each; of passages
with one score the first is reported; empty tables give no matches.
``decontaminate`` keeps all columns of the documents, whatever their names. Texts
of any length are processed whole.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from touchline.llm.common import col, prefix_sums, slices, stored

K1, B = 1.2, 0.75
STRIDE = 32
WINDOW = 3 * STRIDE
OVERLAP = 0.5
SHINGLE = 5
#: Shingles of a part at most.
PART = 60
BLOCK = 4
GROUP_BYTES = 8 << 20
STAGE_BYTES = 16 << 20
#: What an item counts beside its text.
ITEM_BYTES = 64


def words_of(texts: pa.Array) -> pa.ListArray:
    """Lower-case runs of letters and digits; an empty text has one empty word,
    which no item has."""
    clean = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL\pN]+", " ")
    return pc.ascii_split_whitespace(pc.utf8_trim(clean, " "))


def _shingles(words: list) -> list[tuple]:
    return [tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))] if words else []


def _split(texts: pa.Array, answers: pa.Array) -> list[tuple[list[str], list[str]]]:
    """Question and answer words of items."""
    out = []
    for question, answer, given in zip(words_of(texts).to_pylist(), words_of(answers).to_pylist(),
                                       answers.is_valid().to_pylist()):
        question, answer = [w for w in question if w], [w for w in answer if w]
        half = math.ceil(len(question) / 2)
        out.append((question, answer) if given else (question[:half], question[half:]))
    return out


def _parts(n: int | np.ndarray) -> int | np.ndarray:
    """Parts of an item of n shingles; shingle i is in part i * parts // n."""
    return -(-n // PART)


def _codes(words: list[np.ndarray]) -> np.ndarray:
    """A number per row of the columns ``words``: equal rows of one width have
    equal ones. Unequal rows with equal numbers would be verified in vain."""
    out = np.full(len(words[0]), len(words), np.uint64)
    for w in words:
        out = out * np.uint64(0x9E3779B97F4A7C15) + w.astype(np.uint64) + np.uint64(1)
        out ^= out >> np.uint64(29)
    return out


def _begins(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def _entries(begins: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of these lists (lists lie end to end), and their numbers."""
    count = begins[lists + 1] - begins[lists]
    return np.repeat(begins[lists] - (np.cumsum(count) - count), count) + np.arange(int(count.sum())), count


def tokenised(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts, and where each text's begin."""
    lists = words_of(texts)
    ends = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().dictionary_encode(), ends - ends[0]


class ItemIndex:
    """Block-max inverted index over the parts of a bounded group of items, in flat
    arrays. ``items``: (item_id, question words, answer words). ``statistics``:
    number of parts, their mean length and, of shingles that other groups hold too,
    the parts that hold them (default: these items are all)."""

    def __init__(self, items: list[tuple[object, list[str], list[str]]], overlap: float = OVERLAP,
                 statistics: tuple[int, float, dict[str, int]] | None = None):
        self.overlap, self.ids = overlap, [i for i, _, _ in items]
        numbers: dict[str, int] = {}
        sides = [side for _, *both in items for side in both]
        self.word = np.fromiter((numbers.setdefault(w, len(numbers)) for side in sides for w in side), np.int32)
        self.vocabulary = pa.array(list(numbers), pa.string())
        words = np.array([len(side) for side in sides], np.int64)
        self.side = _begins(words)
        self.n_words = words.reshape(-1, 2).sum(axis=1)
        # one row per shingle, in order of item, side, place
        width = np.minimum(words, SHINGLE)
        count = np.where(words > 0, words - width + 1, 0)
        first = _begins(count)
        side = np.repeat(np.arange(len(sides)), count)
        at = np.arange(first[-1]) - first[side] + self.side[side]
        code = np.zeros(len(at), np.uint64)
        self.widths = sorted(set(width[words > 0].tolist()))
        for k in self.widths:
            own = np.flatnonzero(width[side] == k)
            code[own] = _codes([self.word[at[own] + j] for j in range(k)])
        self.code, term = np.unique(code, return_inverse=True)
        shingles = count.reshape(-1, 2).sum(axis=1)
        parts = _parts(shingles)
        self.item_parts = _begins(parts)
        item = side // 2
        inside = np.arange(len(at)) - first[2 * item]
        part = self.item_parts[item] + inside * parts[item] // np.maximum(shingles[item], 1)
        self.part_item = np.repeat(np.arange(len(items)), parts)
        self._weigh(term, part, numbers, statistics)
        self._thresholds(term, part, item, side, first, count)
        self._post()

    def _weigh(self, term: np.ndarray, part: np.ndarray, numbers: dict[str, int], statistics: tuple | None) -> None:
        """BM25 impacts, part by part: ``held`` (terms), ``impact``, ``whole``."""
        n_parts, terms = len(self.part_item), max(1, len(self.code))
        pair, times = np.unique(part * terms + term, return_counts=True)
        self.of_part, self.held = np.divmod(pair, terms)
        self.part_begins = _begins(np.bincount(self.of_part, minlength=n_parts))
        frequency = np.bincount(self.held, minlength=terms).astype(float)
        length = np.bincount(part, minlength=n_parts).astype(float)
        total, mean, known = statistics or (n_parts, length.mean() if n_parts else 1.0, {})
        for shingle, n in known.items():
            code = _codes([np.array([numbers[w]]) for w in shingle.split(" ")])
            frequency[np.searchsorted(self.code, code)] = n
        idf = np.log(1 + (total - frequency + 0.5) / (frequency + 0.5))
        self.impact = idf[self.held] * times * (K1 + 1) / (times + K1 * (1 - B + B * length[self.of_part] / mean))
        self.whole = np.bincount(self.of_part, self.impact, n_parts)

    def _thresholds(self, term: np.ndarray, part: np.ndarray, item: np.ndarray, side: np.ndarray, first: np.ndarray,
                    count: np.ndarray) -> None:
        """``least``: per item the score that some passage of any match reaches."""
        terms = max(1, len(self.code))
        key, place = np.unique(self.part_item[self.of_part] * terms + self.held, return_inverse=True)
        best = np.zeros(len(key))
        np.maximum.at(best, place, self.impact)
        value = best[np.searchsorted(key, item * terms + term)]
        by_value = value[np.lexsort((value, side))]  # sides stay where they are
        size = np.maximum(count, 1)
        need = np.floor(self.overlap * size).astype(np.int64)
        need += need / size < self.overlap
        need -= (need > 0) & ((need - 1) / size >= self.overlap)
        lightest = np.full(len(self.ids), np.inf)
        np.minimum.at(lightest, item, value)
        asked = np.zeros(len(self.ids))
        given = np.flatnonzero((count > 0) & (need > 0))
        reachable = given[need[given] <= count[given]]
        np.maximum.at(asked, reachable // 2, by_value[first[reachable] + need[reachable] - 1])
        asked[given[need[given] > count[given]] // 2] = np.inf
        self.least = np.where(asked > 0, asked, lightest)

    def _post(self) -> None:
        """Lists of all terms end to end: parts, impacts, and block maxima."""
        order = np.lexsort((self.of_part, self.held))
        self.post_part = self.of_part[order].astype(np.int32)
        self.post_impact = (self.impact / self.least[self.part_item[self.of_part]])[order]
        term = self.held[order]
        self.post = _begins(np.bincount(term, minlength=len(self.code)))
        self.most = np.maximum.reduceat(self.post_impact, self.post[:-1]) if len(term) else np.zeros(0)
        self.blocks = -(-len(self.part_item) // BLOCK)
        new = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(self.post_part // BLOCK, prepend=-1))
        self.block = (self.post_part[new] // BLOCK).astype(np.int32)
        self.block_most = np.maximum.reduceat(self.post_impact, new) if len(new) else np.zeros(0)
        self.block_post = _begins(np.bincount(term[new], minlength=len(self.code)))

    def hits(self, word: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, place, width, term) of all terms of the index in the texts.
        ``word``: numbers of all words (-1: in no item)."""
        known, out = word >= 0, []
        begins = np.flatnonzero(known)
        for width in range(1, SHINGLE + 1):
            if width > 1:
                begins = begins[begins + width <= len(word)]
                begins = begins[known[begins + width - 1]]
            if width not in self.widths:
                continue
            code = _codes([word[begins + j] for j in range(width)]) if len(begins) else np.zeros(0, np.uint64)
            term = np.searchsorted(self.code, code)
            found = np.flatnonzero(self.code[np.minimum(term, len(self.code) - 1)] == code)
            at, term = begins[found], term[found]
            text = np.searchsorted(ends, at, "right") - 1
            whole = at + width <= ends[text + 1]
            out.append((text[whole], (at - ends[text])[whole], np.full(int(whole.sum()), width), term[whole]))
        text, at, width, term = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((at, text))
        return text[order], at[order], width[order], term[order]

    def passages(self, text: np.ndarray, at: np.ndarray, width: np.ndarray, term: np.ndarray) -> Iterator[
            tuple[int, int, np.ndarray]]:
        """(text, first word, terms) of the passages whose bound reaches 1 in
        some block."""
        last = at // STRIDE
        least = np.maximum(0, -(-(at + width - WINDOW) // STRIDE))
        n = last - least + 1
        row = np.repeat(np.arange(len(at)), n)
        step = least[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        steps = int(last.max()) + 1 if len(last) else 1
        owner, number = np.unique(text[row] * steps + step, return_inverse=True)
        pair = np.unique(number * max(1, len(self.code)) + term[row])  # each term once per passage
        number, term = np.divmod(pair, max(1, len(self.code)))
        ends = _begins(np.bincount(number, minlength=len(owner)))
        entry, count = _entries(self.block_post, term)
        cell, place = np.unique(np.repeat(number, count) * max(1, self.blocks) + self.block[entry], return_inverse=True)
        bound = np.bincount(place, self.block_most[entry], len(cell))
        for k in np.unique(cell[bound >= 1 - 1e-9] // max(1, self.blocks)).tolist():
            yield int(owner[k] // steps), int(owner[k] % steps) * STRIDE, term[ends[k]:ends[k + 1]]

    def search(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """All (part, score) of at least 1, the item's threshold: block-max WAND."""
        found, theta = [], 1 - 1e-9
        cursors = [[int(self.post_part[self.post[t]]), int(self.post[t]), t] for t in terms.tolist()]
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, (part, _, t) in enumerate(cursors):
                bound += self.most[t]
                if bound >= theta:
                    pivot = part
                    break
            if pivot is None:
                return found
            while k + 1 < len(cursors) and cursors[k + 1][0] == pivot:
                k += 1
            block, in_block = pivot // BLOCK, 0.0
            for _, _, t in cursors[:k + 1]:
                low, high = self.block_post[t], self.block_post[t + 1]
                i = low + np.searchsorted(self.block[low:high], block)
                in_block += self.block_most[i] if i < high and self.block[i] == block else 0.0
            if in_block < theta:  # nothing before the next block, or the next cursor, can do
                target = (block + 1) * BLOCK
                if k + 1 < len(cursors):
                    target = min(target, cursors[k + 1][0])
                target = max(target, pivot + 1)
            elif cursors[0][0] == pivot:
                score = float(sum(self.post_impact[i] for part, i, _ in cursors[:k + 1] if part == pivot))
                if score >= theta:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            moved = []
            for _, i, t in cursors[:k + 1]:
                i += int(np.searchsorted(self.post_part[i:self.post[t + 1]], target))
                if i < self.post[t + 1]:
                    moved.append([int(self.post_part[i]), i, t])
            cursors = moved + cursors[k + 1:]
        return found

    def _shares(self, item: int, near: list[int]) -> tuple[float, ...]:
        """Overlaps of the item's question and answer with these words."""
        a, b, c = self.side[2 * item:2 * item + 3].tolist()
        question, answer = _shingles(self.word[a:b].tolist()), _shingles(self.word[b:c].tolist())
        there = set(_shingles(near)) | {tuple(near[i:i + len(s)]) for s in (*question[:1], *answer[:1])
                                        if len(s) < SHINGLE for i in range(len(near))}
        return tuple(sum(s in there for s in x) / len(x) if x else 1.0 for x in (question, answer))

    def _score(self, item: int, terms: np.ndarray) -> float:
        """Highest share of the item's parts that a passage's terms score."""
        a, b = self.item_parts[item:item + 2]
        own = slice(self.part_begins[a], self.part_begins[b])
        score = np.bincount(self.of_part[own] - a, self.impact[own] * np.isin(self.held[own], terms), b - a)
        return float((score / self.whole[a:b]).max())

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, float, float, float, int]]:
        """(text, item, score, question overlap, answer overlap, first word of
        the best passage), once per text and item."""
        return self.matches_of(*tokenised(texts))

    def matches_of(self, coded: pa.DictionaryArray, ends: np.ndarray) -> Iterator[
            tuple[int, int, float, float, float, int]]:
        if not len(self.code) or not len(coded):
            return
        number = pc.fill_null(pc.index_in(coded.dictionary, self.vocabulary), -1).to_numpy().astype(np.int64)
        word = number[coded.indices.to_numpy()]
        text, at, width, term = self.hits(word, ends)
        near: dict[tuple[int, int], set[int]] = defaultdict(set)  # passages around what was retrieved
        for owner, first, terms in self.passages(text, at, width, term):
            size = int(ends[owner + 1] - ends[owner])
            for item in {int(self.part_item[part]) for part, _ in self.search(terms)}:
                n = int(self.n_words[item])
                begin = max(0, -(-(first - WINDOW - n + 1) // STRIDE)) * STRIDE
                near[owner, item].update(range(begin, min(first + WINDOW + n, size), STRIDE))
        for (owner, item), firsts in sorted(near.items()):
            own, n = word[ends[owner]:ends[owner + 1]], int(self.n_words[item])
            around = lambda a, b: own[max(0, a - n):b + WINDOW + n].tolist()  # noqa: E731,B023
            runs = np.array(sorted(firsts))
            passed = []
            for run in np.split(runs, np.flatnonzero(np.diff(runs) > STRIDE) + 1):
                if min(self._shares(item, around(int(run[0]), int(run[-1])))) >= self.overlap:  # else none of them does
                    passed += run.tolist()
            a, b = np.searchsorted(text, (owner, owner + 1))

            def score(f: int) -> float:
                low, high = a + np.searchsorted(at[a:b], (f, f + WINDOW))  # noqa: B023
                inside = slice(low, high)
                return self._score(item, term[inside][at[inside] + width[inside] <= f + WINDOW])  # noqa: B023

            for negative, f in sorted((-score(f), f) for f in passed):
                share = self._shares(item, around(f, f))
                if min(share) >= self.overlap:
                    yield owner, item, -negative, *share, f
                    break


def _grouped(items: DataFrame, id_col: str, text_col: str, answer_col: str | None,
             group_bytes: int) -> tuple[DataFrame, int]:
    """item_id, text, answer and ``_group`` of the items; the number of groups."""
    answer = col(items, answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    rows = items.select(col(items, id_col).alias("item_id"), col(items, text_col).cast("string").alias("text"),
                        answer.alias("answer"))
    size = ITEM_BYTES + sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in ("text", "answer"))
    rows = stored(rows.withColumns({"_row": F.monotonically_increasing_id(), "_size": size.cast("long")}), "items")
    rows = rows.withColumn("_pid", F.shiftright("_row", 33))
    before = prefix_sums(rows.groupBy("_pid").agg(F.sum("_size").alias("_sum")), "_pid", "_sum", "_before")
    upto = F.sum("_size").over(Window.partitionBy("_pid").orderBy("_row"))
    # by where an item ends: the sizes of a group's items sum to at most group_bytes, apart from its first
    place = F.floor((F.col("_before") + upto - 1) / group_bytes).alias("_group")
    rows = stored(rows.join(before.select("_pid", "_before"), "_pid").select("item_id", "text", "answer", place),
                  "item-groups", "_group")
    last = rows.agg(F.max("_group")).first()[0]
    return rows, 1 if last is None else last + 1


def _collected(rows: DataFrame, groups: int) -> Iterator[tuple[int, list[tuple]]]:
    for k in range(groups):
        held = rows.where(F.col("_group") == k).orderBy("item_id", "text").collect()  # bounded by group_bytes
        words = _split(pa.array([r[1] for r in held], pa.string()), pa.array([r[2] for r in held], pa.string()))
        group = [(r[0], *x) for r, x in zip(held, words) if any(x)]
        if group or not k:
            yield k, group


def item_groups(items: DataFrame, id_col: str, text_col: str, answer_col: str | None,
                group_bytes: int = GROUP_BYTES) -> Iterator[list[tuple]]:
    """The items in groups of at most ``group_bytes``, one at a time on the
    driver. Repeated items count each, so many copies of one make no large group."""
    for _, group in _collected(*_grouped(items, id_col, text_col, answer_col, group_bytes)):
        yield group


def _counts(rows: DataFrame) -> DataFrame:
    """(group, term, n): the parts of each group that hold a shingle; in the row
    without a term, all parts and their shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text")):
                rows = batch.slice(a, b - a)
                count: Counter = Counter()
                held: Counter = Counter()
                for group, sides in zip(rows.column("_group").to_pylist(), _split(rows.column("text"),
                                                                                  rows.column("answer"))):
                    own = [" ".join(s) for side in sides for s in _shingles(side)]
                    n = len(own)
                    held[group] += n
                    count[group, None] += _parts(n)
                    count.update((group, s) for s, _ in {(s, i * _parts(n) // n) for i, s in enumerate(own)})
                if count:
                    yield pa.RecordBatch.from_pydict({
                        "group": pa.array([g for g, _ in count], pa.int64()),
                        "term": pa.array([w for _, w in count], pa.string()),
                        "n": pa.array(list(count.values()), pa.int64()),
                        "held": pa.array([0 if w is not None else held[g] for g, w in count], pa.int64())})

    source = rows.select("text", "answer", F.col("_group").cast("long").alias("_group"))
    return (source.mapInArrow(run, "group long, term string, n long, held long").groupBy("group", "term")
            .agg(F.sum("n").alias("n"), F.sum("held").alias("held")))


def groups_with_statistics(items: DataFrame, id_col: str, text_col: str, answer_col: str | None,
                           group_bytes: int = GROUP_BYTES) -> Iterator[tuple[list[tuple], tuple | None]]:
    """``item_groups``, each with the statistics over all items (None where one
    group holds all items)."""
    rows, groups = _grouped(items, id_col, text_col, answer_col, group_bytes)
    if groups > 1:
        counts = stored(_counts(rows), "item-counts")
        parts, held = counts.where("term IS NULL").agg(F.sum("n"), F.sum("held")).first()
        counts = counts.where("term IS NOT NULL")
        every = counts.groupBy("term").agg(F.sum("n").alias("every"))
        known = stored(counts.select("group", "term", "n").join(every, "term").where("every > n"), "item-terms", "group")
    for k, group in _collected(rows, groups):
        if groups == 1 or not group:
            yield group, None
        else:  # no more terms than the group's items have
            own = {r.term: r.every for r in known.where(F.col("group") == k).select("term", "every").collect()}
            yield group, (parts, held / parts, own)


def _stages(items: DataFrame, docs: DataFrame, overlap: float, group_bytes: int, *columns: str | None) -> Iterator[
        tuple[str, list[Broadcast]]]:
    """The groups of each Python stage, broadcast, under a name of the stage."""
    most, held = max(1, STAGE_BYTES // group_bytes), []
    for group, known in groups_with_statistics(items, *columns, group_bytes):
        if len(held) == most:
            yield uuid.uuid4().hex, held
            held = []
        held.append(docs.sparkSession.sparkContext.broadcast((group, overlap, known)))
    yield uuid.uuid4().hex, held


#: The indexes of the stage that this worker ran last.
_BUILT: dict[str, list[ItemIndex]] = {}


def _indexes(stage: str, held: list[Broadcast]) -> list[ItemIndex]:
    """Built once per worker, not once per task."""
    if stage not in _BUILT:
        _BUILT.clear()
        _BUILT[stage] = [ItemIndex(*one.value) for one in held]
    return _BUILT[stage]


def find_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None,
                 overlap: float = OVERLAP, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, score (part
    of the item's own), question_overlap, answer_overlap, first_word."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType),
                           T.StructField("item_id", items.schema[item_col].dataType),
                           *(T.StructField(c, T.DoubleType()) for c in ("score", "question_overlap",
                                                                        "answer_overlap")),
                           T.StructField("first_word", T.LongType())])
    kinds = [to_arrow_type(f.dataType) for f in schema]
    source = docs.select(col(docs, id_col).alias("doc_id"), col(docs, text_col).cast("string").alias("text"))
    out = None
    for stage, held in _stages(items, docs, overlap, group_bytes, item_col, item_text_col, answer_col):
        def run(batches: Iterator[pa.RecordBatch], stage=stage, held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b in slices(batch.column(1)):
                    docs_, coded = batch.column(0).slice(a, b - a).to_pylist(), tokenised(batch.column(1).slice(a, b - a))
                    rows = [(docs_[text], index.ids[item], *hit) for index in _indexes(stage, held)
                            for text, item, *hit in index.matches_of(*coded)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)],
                                                         names=schema.names)

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", answer_col: str | None = None, overlap: float = OVERLAP,
                  group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The documents without a match, with all their columns."""
    names, last = docs.columns, None
    # by position: mapInArrow can't take a column with a dot in its name
    rows = docs.toDF(*(f"c{i}" for i in range(len(names))))
    rows = rows.withColumn("text", F.col(f"c{names.index(text_col)}").cast("string"))
    for stage, held in _stages(items, docs, overlap, group_bytes, item_col, item_text_col, answer_col):
        if last:  # no stage holds the indexes of another
            rows = stored(rows, "decontaminated")
            for one in last:
                one.unpersist()

        def run(batches: Iterator[pa.RecordBatch], stage=stage, held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for a, b in slices(batch.column(batch.num_columns - 1)):
                    coded = tokenised(batch.column(batch.num_columns - 1).slice(a, b - a))
                    for index in _indexes(stage, held):
                        for hit in index.matches_of(*coded):
                            clean[a + hit[0]] = False
                yield batch.filter(pa.array(clean))

        rows, last = rows.mapInArrow(run, rows.schema), held
    return rows.drop("text").toDF(*names)
