"""Vectorised encoding with a tokenizer file of the ``tokenizers`` library.

The pre-tokenizers of the supported files never join text across the start of a
run of white space, nor a letter with a full stop or comma after it, so
``ids(text)`` is the concatenation of the ids of the chunks that begin there.
Each slice of texts is cut, its distinct chunks are encoded once (or taken from a
bounded memo of the worker process), and the ids are gathered back with numpy.
The result equals ``encode(text, add_special_tokens=False)`` (tested against it).

A special token's string inside a text is that token, as in the bare library call,
or ordinary text with ``special_as_text``. Such strings hold no white space and no
letter before a full stop or comma at their end, so no cut divides them."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space of the pre-tokenizers (fixed value: the Unicode White_Space property), for RE2.
SPACE = r"\t-\r \x{85}\pZ"
#: Unlikely characters of which one that a slice lacks marks the cuts.
MARKS = "\x1f\x1e\x1d\x1c\x01\x02\x03"
JOINED = 2000
#: Joined texts encoded at once.
AT_ONCE = 10
#: Chunks whose ids a worker process remembers (about 200 bytes each).
MEMO = 300_000


def _pieces(chunks: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pieces of distinct chunks: a full stop or comma after a last
    letter is a piece of its own. Per chunk the first and second piece (or -1)."""
    ended = pc.match_substring_regex(chunks, r"\pL[.,]$")
    tail = chunks.filter(ended)
    parts = pa.concat_arrays([pc.if_else(ended, pc.utf8_slice_codeunits(chunks, 0, -1), chunks),
                              pc.utf8_slice_codeunits(tail, -1)]).dictionary_encode()
    at = parts.indices.to_numpy()
    second = np.full(len(chunks), -1, np.int32)
    second[ended.to_numpy(zero_copy_only=False)] = at[len(chunks):]
    return parts.dictionary, at[:len(chunks)], second


class Encoder:
    def __init__(self, path: str, memo: int = MEMO, special_as_text: bool = False):
        self.memo = memo
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.separator, self.separator_id = "", -1
        for text in ("\n", "\n~\n"):
            one, two = self._ids(" a"), self._ids(" a" + text + " a")
            if len(two) == 2 * len(one) + 1 and two[: len(one)] == one == two[len(one) + 1:]:
                self.separator, self.separator_id = text, two[len(one)]
                break
        barred = SPACE + "".join(c for c in self.separator if not c.isspace())
        self.joinable = f"^ ?[^{barred}]+$"
        self.known: dict[str, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.begins = self.lengths = np.zeros(0, np.int32)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _batches(self, texts: list[str], most: int = AT_ONCE) -> Iterator[np.ndarray]:
        for i in range(0, len(texts), most):
            for e in self.tokenizer.encode_batch_fast(texts[i:i + most], add_special_tokens=False):
                yield np.asarray(e.ids, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` (null: empty) and the offsets of each text in them."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        mark = next((m for m in MARKS if not pc.any(pc.match_substring(texts, m)).as_py()), None)
        if mark is None or len(texts) == 0:
            lists = [np.asarray(self._ids(x), np.uint32) for x in texts.to_pylist()]
            return np.concatenate([np.zeros(0, np.uint32), *lists]), np.cumsum([0, *map(len, lists)])
        cut = pc.split_pattern(pc.replace_substring_regex(texts, f"([{SPACE}]+)", mark + r"\1"), mark)
        words = cut.flatten().dictionary_encode()
        pieces, first, second = _pieces(words.dictionary)
        ids, begins, lengths = self._recall(pieces)
        at = words.indices.to_numpy()
        n_pieces = 1 + (second >= 0).astype(np.int32)[at]
        upto = np.cumsum(n_pieces, dtype=np.int32)
        piece = np.repeat(first[at], n_pieces)
        two = np.flatnonzero(n_pieces == 2)
        piece[upto[two] - 1] = second[at[two]]
        length = lengths[piece]
        ends = np.cumsum(length, dtype=np.int32)
        position = np.repeat(begins[piece] - (ends - length), length)
        position += np.arange(len(position), dtype=np.int32)
        bounds = np.concatenate(([0], upto))[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        return ids[position], np.concatenate(([0], ends)).astype(np.int64)[bounds]

    def _recall(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_chunks``, by way of the memo. A full memo stays as it is: what
        came first is mostly what is frequent."""
        texts = chunks.to_pylist()
        at = np.fromiter(map(self.known.get, texts, repeat(-1)), np.int32, len(texts))
        new = np.flatnonzero(at < 0)
        ids, begins, lengths = self._chunks(chunks.take(pa.array(new)))
        pool = np.concatenate([self.pool, ids])
        own_begins, own_lengths = np.zeros(len(texts), np.int32), np.zeros(len(texts), np.int32)
        own_begins[new], own_lengths[new] = begins + len(self.pool), lengths
        old = np.flatnonzero(at >= 0)
        own_begins[old], own_lengths[old] = self.begins[at[old]], self.lengths[at[old]]
        room = new[:self.memo - len(self.known)]
        if len(room):
            self.known.update(zip(map(texts.__getitem__, room.tolist()), count(len(self.begins))))
            self.begins = np.concatenate([self.begins, own_begins[room]])
            self.lengths = np.concatenate([self.lengths, own_lengths[room]])
            self.pool = pool
        return pool, own_begins, own_lengths

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct chunks; where each begins, and how many it has."""
        lengths = np.zeros(len(chunks), np.int32)
        begins = np.zeros(len(chunks), np.int32)
        parts: list[np.ndarray] = []
        used = 0
        plain = pc.match_substring_regex(chunks, self.joinable).to_numpy(zero_copy_only=False)
        plain &= bool(self.separator)
        where, alone = np.flatnonzero(plain), np.flatnonzero(~plain)
        blocks = [where[i:i + JOINED] for i in range(0, len(where), JOINED)]
        joined = [self.separator.join(chunks.take(pa.array(b)).to_pylist()) for b in blocks]
        for block, ids in zip(blocks, self._batches(joined)):
            cuts = np.flatnonzero(ids == self.separator_id)
            if len(cuts) != len(block) - 1:  # the separator's id came from a chunk, too
                alone = np.concatenate([alone, block])
                continue
            length = np.diff(np.concatenate(([-1], cuts, [len(ids)]))) - 1
            lengths[block], begins[block] = length, used + np.cumsum(length) - length
            parts.append(np.delete(ids, cuts))
            used += len(parts[-1])
        for i, ids in zip(alone, self._batches(chunks.take(pa.array(alone, pa.int64())).to_pylist(), JOINED)):
            parts.append(ids)
            lengths[i], begins[i] = len(parts[-1]), used
            used += len(parts[-1])
        return np.concatenate([np.zeros(0, np.uint32), *parts]), begins, lengths


@lru_cache(maxsize=4)
def encoder(path: str, memo: int = MEMO, special_as_text: bool = False) -> Encoder:
    """One per worker process, file, size of the memo and way with special strings."""
    return Encoder(path, memo, special_as_text)
