"""Plain single-process versions of the operators, for comparison."""

from __future__ import annotations

import collections
import re

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def token_ids(file: str, texts: list[str]) -> list[list[int]]:
    t = Tokenizer.from_file(public_tokenizers.path(file))
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def u32(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def fingerprint(text: str | None) -> int:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints: list[int], most: int = 3) -> list[int]:
    """For each position the smallest position reachable over links."""
    root = list(range(len(prints)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    codes = np.array(prints, np.uint64)
    for i in range(len(codes)):
        for j in (np.flatnonzero(np.bitwise_count(codes[i + 1:] ^ codes[i]) <= most) + i + 1).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def measures(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    count = collections.Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit)


def leaks(docs: list[tuple], items: list[tuple]) -> set[tuple]:
    """(doc, item) where the item's words occur in the document in a row."""
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    wanted = [(i, plain(t)) for i, t in items if plain(t).strip()]
    return {(d, i) for d, t in docs for i, w in wanted if w in plain(t)}
