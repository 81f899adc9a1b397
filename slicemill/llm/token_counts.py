"""Token counts by byte-pair merging on a heap and a linked list, without ids.

Text is prepared as the vocabulary file says: special strings are cut out and count one each, the rest is composed
(NFC), white space parts words, letters are lowered, and words are split into runs of letters, single digits and
runs of other marks. The bytes of a run are its first symbols, the last one marked as the end of a word. The adjacent pair of
the lowest rank is popped from a heap and merged in the list until no ranked pair is left; a run counts its first symbols
less its merges. Workers remember the counts of at most ``KEPT`` words.

Defined cases: null is the empty text, which has no tokens; bytes that the vocabulary lacks count nothing, as the
library drops them; very long texts are read whole, word by word; pairs of equal rank are merged from the left; repeated rows count
alike; null ids stay null; empty tables give empty tables; extra columns are not used.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicemill.llm.common import map_batches

LIMIT = 2048
KEPT = 400_000
# fixed values of the vocabulary file: white space and the parts of a word
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space to Python alone


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where it is printable, else the next free one above 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(free)) for b in range(256)}


class Counter:
    """Counts tokens of texts for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.end = spec["model"]["end_of_word_suffix"] or ""
        self.vocab, self.letters = vocab, byte_letters()
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a], vocab[b]] = (rank, vocab[a + b])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words: dict[str, int] = {}
        self.runs: dict[str, int] = {}

    def merged(self, run: str) -> int:
        """Tokens of one run: symbols less merges."""
        letters = [self.letters[b] for b in run.encode("utf-8", "surrogatepass")]
        letters[-1] += self.end
        ids = [i for i in map(self.vocab.get, letters) if i is not None]
        n, ranks = len(ids), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i) for i in range(n - 1) if (found := ranks.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            found = ranks.get((ids[i], ids[j]))
            if not found or found[0] != rank:  # one of the two was merged meanwhile
                continue
            merges += 1
            ids[i], ids[j] = found[1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := ranks.get((ids[i], ids[k])):
                    heapq.heappush(heap, (found[0], i))
            if (h := before[i]) >= 0 and (found := ranks.get((ids[h], ids[i]))):
                heapq.heappush(heap, (found[0], h))
        return n - merges

    def word(self, word: str) -> int:
        """Tokens of a stretch without white space."""
        if not word.isascii():
            word = "".join([c.lower() for c in unicodedata.normalize("NFC", word)])
        else:
            word = word.lower()
        total = 0
        for run in PARTS.findall(word):
            count = self.runs.get(run)
            if count is None:
                if len(self.runs) >= KEPT:
                    self.runs.clear()
                count = self.runs[run] = self.merged(run)
            total += count
        return total

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if "<|" in text and self.special:
            parts = self.special.split(text)
            return len(parts) - 1 + sum(self.stretch(p) for p in parts)
        return self.stretch(text)

    def stretch(self, text: str) -> int:
        found = SPACE.split(text) if ODD_SPACE.search(text) else text.split()
        try:
            return sum(map(self.words.__getitem__, found))
        except KeyError:
            pass
        words, total = self.words, 0
        for w in found:
            count = words.get(w)
            if count is None:
                if len(words) >= KEPT:
                    words.clear()
                count = words[w] = self.word(w) if w else 0
            total += count
        return total


_counters: dict[str, Counter] = {}


def counter(path: str | None = None) -> Counter:
    """The worker's counter for a vocabulary file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of every document."""
    def start():
        count = counter(vocabulary)

        def run(batch: pa.RecordBatch) -> dict[str, list]:
            text = batch.column("text")
            n = [count(t) for t in text.to_pylist()]
            return {"doc_id": batch.column("doc_id"), "n_bytes": pc.fill_null(pc.binary_length(text), 0).cast(pa.int64()), "n_tokens": n, "over_limit": [k > limit for k in n]}
        return run

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), start, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
