"""Periodic runs of words: a suffix automaton whose link tree is read through link-cut access.

Words are runs of characters other than space and the controls 9 to 13. A run is a stretch with smallest period q and a
length of at least max(``LEAST``, ``TIMES`` * q) that no neighbouring word extends.

After each word the path from its state to the root of the link tree takes the word's number as colour, so the path
falls into segments of suffixes that last ended at the same place, one splay tree for each. A segment whose last end
lies d words back and whose suffixes are between ``low`` < d and ``high`` >= d words long shows a square of period d
that ends here; as no suffix of d words ended later, d is the smallest period. The square is extended to both sides and its
run noted; until that run ends, its period is not extended again. Accesses cost O(log n) splay steps on average, so
a text of n words takes O(n log n) time and some 500 bytes a word of it that may lie in a run.

Before that, texts are cut where no run can be: a run of this length repeats each of its ``GRAM`` successive words
inside itself, at a distance of at most a quarter of its length. Words outside such repeats are in no run, and each rest is
looked at again by itself. Equal hashes only keep more. The cut is exact, and plain prose never reaches the automaton.

Defined cases: null and empty texts have no words and no runs; very long texts are read whole, in one task each; among
runs of equal exponent the first comes first, then the shorter period; repeated rows get equal results; a null id is
kept; empty tables give empty tables; extra columns pass through ``collapse``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicemill.llm.common import map_batches, slices

LEAST, TIMES = 6, 4
GRAM = 5    # the most words of which every run of LEAST words and TIMES periods has all repeated
LEVELS = 6  # of cutting; more would change no result


def candidates(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Half-open stretches outside of which there is no run; ``codes`` are hashes of the words."""
    left = [(0, len(codes), 0)]
    while left:
        a, b, level = left.pop()
        n = b - a
        if n < LEAST:
            continue
        if level == LEVELS:
            yield a, b
            continue
        grams = codes[a:b - GRAM + 1].copy()
        for i in range(1, GRAM):
            grams *= np.uint64(0x9E3779B97F4A7C15)
            grams += codes[a + i:b - GRAM + 1 + i]
        order = np.argsort(grams, kind="stable")
        ordered = grams[order]
        near = np.flatnonzero((ordered[1:] == ordered[:-1]) & (TIMES * np.diff(order) <= n))
        if not len(near):
            continue
        steps = np.zeros(n + 1, np.int64)
        starts = np.unique(np.concatenate([order[near], order[near + 1]]))
        steps[starts] += 1
        steps[starts + GRAM] -= 1
        inside = np.concatenate([[False], np.cumsum(steps)[:-1] > 0, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        if len(edges) == 2 and edges[1] - edges[0] == n:
            yield a, b
        else:
            left += [(a + int(s), a + int(e), level + 1) for s, e in zip(edges[::2], edges[1::2])]


class SuffixAutomaton:
    """States of a word sequence. State 0 is none, 1 the empty suffix; ``ends`` are the states of the prefixes."""

    def __init__(self, word: Sequence[int]):
        self.link, self.length, step = [0, 0], [0, 0], [{}, {}]
        link, length = self.link, self.length
        self.ends = []
        last = 1
        for c in word:
            now = len(link)
            length.append(length[last] + 1)
            link.append(1)
            step.append({})
            p = last
            while p and c not in step[p]:
                step[p][c] = now
                p = link[p]
            if p:
                q = step[p][c]
                if length[p] + 1 == length[q]:
                    link[now] = q
                else:
                    clone = len(link)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    step.append(step[q].copy())
                    while p and step[p].get(c) == q:
                        step[p][c] = clone
                        p = link[p]
                    link[q] = link[now] = clone
            last = now
            self.ends.append(now)


def squares(word: Sequence[int]) -> Iterator[tuple[int, int]]:
    """(last word, period) of squares; every run of two periods and more shows one at each word from its second period's end on."""
    automaton = SuffixAutomaton(word)
    length = automaton.length
    up = [0 if p == 1 else p for p in automaton.link]  # the root is no node
    left, right = [0] * len(up), [0] * len(up)
    colour = [-1] * len(up)                # right at the root of each splay tree

    def splay(x: int) -> int:
        """Brings ``x`` to the top of its splay tree; returns the colour of that tree."""
        y = up[x]
        if not y or (left[y] != x and right[y] != x):
            return colour[x]
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                return shade
            z = up[y]
            if not z or (left[z] != y and right[z] != y):
                shade = colour[y]
            else:
                shade = colour[z]  # of the top in the last turn
                turn(y if (left[y] == x) == (left[z] == y) else x)
            turn(x)

    def turn(x: int) -> None:
        y = up[x]
        z = up[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b:
            up[b] = y
        up[y] = x
        up[x] = z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    for i, x in enumerate(automaton.ends):
        below = 0
        while x:
            shade = splay(x)
            cut = right[x]
            if cut:
                colour[cut] = shade
            right[x] = below
            below, above = x, up[x]
            if shade >= 0 and length[above] < i - shade <= length[x]:
                yield i, i - shade
            x = above
        colour[below] = i


def runs_of(words: Sequence[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, sorted by start, then period."""
    if len(words) < least:
        return []
    found = []
    for a, b in candidates(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)):
        names: dict[bytes, int] = {}
        word = [names.setdefault(w, len(names)) for w in words[a:b]]
        reach: dict[int, int] = {}
        for i, q in squares(word):
            if i < reach.get(q, 0):
                continue
            start, end = i - 2 * q + 1, i + 1
            while start and word[start - 1] == word[start - 1 + q]:
                start -= 1
            while end < b - a and word[end] == word[end - q]:
                end += 1
            reach[q] = end
            if end - start >= max(least, times * q):
                found.append((a + start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """Words outside of all runs or in the first period of every run that holds them."""
    if not runs:
        return list(words)
    drop = bytearray(len(words))
    for start, length, q in runs:
        drop[start + q:start + length] = b"\1" * (length - q)
    return [w for w, gone in zip(words, drop) if not gone]


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by its id, with all words from some place on in a period."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a:a + p]
    return words[:a] + (block * (-(-(n - a) // p)))[:n - a]


def report(docs: DataFrame, alter: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, the number of runs, the run of the greatest exponent, and digests of all runs and of the words that are kept.

    ``alter`` changes the words of a document before they are looked at.
    """
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

    def start():
        def run(batch: pa.RecordBatch) -> dict[str, list]:
            out = {f.split()[0]: [] for f in schema.split(", ")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = text.split() if text else []
                if alter:
                    words = alter(doc_id, words)
                runs = runs_of(words)
                best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None, None, None)
                for name, value in zip(("start", "length", "period"), best):
                    out[name].append(value)
                out["doc_id"].append(doc_id)
                out["n_runs"].append(len(runs))
                out["exponent_milli"].append(1000 * best[1] // best[2] if runs else None)
                out["runs_sha256"].append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest())
                out["collapsed_sha256"].append(hashlib.sha256(b" ".join(kept_words(words, runs))).hexdigest())
            return out
        return run

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")), start, schema)


def collapse(docs: DataFrame) -> DataFrame:
    """``docs`` with every run cut to its first period; texts without runs stay as they are."""
    def collapsed(text: str | None) -> str | None:
        words = text.encode().split() if text else []
        runs = runs_of(words)
        return b" ".join(kept_words(words, runs)).decode() if runs else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                at = some.schema.get_field_index("text")
                field = some.schema.field(at)
                yield some.set_column(at, field, pa.array([collapsed(t) for t in some.column(at).to_pylist()], field.type))

    return docs.mapInArrow(run, docs.schema)
