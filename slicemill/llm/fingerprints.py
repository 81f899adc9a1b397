"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed from left to right into the shortest phrases that were not met before (LZ78); the dictionary starts
over after ``DICTIONARY`` phrases, which bounds memory for texts of any length. The set of phrases is what a compressor
would have learnt of the text. Its hashes are dealt to ``BINS`` bins by their upper bits, and the smallest hash of each
bin, cut to 16 bits, is the signature; a bin without phrases is marked as empty. The likeness of two signatures is the share of
equal bins among those that are not empty in both, an estimate of the Jaccard similarity of the phrase sets.

``compare_with_next`` also fingerprints each text with its last third replaced from the next document in descending
order of doc_id (the first follows the last). Documents are dealt to ranges of ids, the rows of a hot id or of none to ranges of
their texts' hashes as well; the first document of each range is
also sent to the range before, so that the texts are shuffled once. A parse stops at the place of the edit, finishes the
text, takes back what it learnt there and finishes the edited text, so a common part is parsed once.

Defined cases: null is the empty text; its fingerprint is all empty bins, which is like itself (1) and unlike any other
(0); a trailing phrase that is known already adds nothing; null ids come last in the order, rows with equal ids are ordered by the
hash of their texts; very long texts are parsed whole, in one task each; a single document follows itself; empty tables give no rows; extra columns are not used.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicemill.llm.common import keyed, map_batches, shuffle_partitions, slices

BINS = 128
DICTIONARY = 1 << 16
EMPTY = 0xFFFF
RANGES = 4  # for each partition
FACTOR = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the factor and of its inverse modulo 2^64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, 2 * len(self.up), 1 << 14)
            steps = np.ones(n, np.uint64)
            steps[1:] = FACTOR
            self.up = np.multiply.accumulate(steps)
            steps[1:] = pow(FACTOR, -1, 1 << 64)
            self.down = np.multiply.accumulate(steps)
        return self.up, self.down


POWERS = Powers()


class Parse:
    """A parse that has read ``text[:edit]`` and can be finished with different endings."""

    def __init__(self, text: str, edit: int):
        self.head, self.root, self.node, self.learnt, self.ends = text[:edit], {}, None, 0, []
        self.node = self.root
        self.read(self.head, 0, self.ends, None)
        self.sums = self.summed(self.head, 0, np.zeros(1, np.uint64))

    def read(self, text: str, offset: int, ends: list[int], journal: list | None) -> None:
        root, node, learnt = self.root, self.node, self.learnt
        for at, c in enumerate(text, offset + 1):
            known = node.get(c)
            if known is not None:
                node = known
                continue
            node[c] = {}
            if journal is not None:
                journal.append((node, c))
            ends.append(at)
            learnt += 1
            if learnt == DICTIONARY:
                root, learnt = {}, 0
            node = root
        self.root, self.node, self.learnt = root, node, learnt

    @staticmethod
    def summed(text: str, offset: int, before: np.ndarray) -> np.ndarray:
        """Prefix sums of character times power of its place."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        up, _ = POWERS.get(offset + len(codes) + 1)
        return np.concatenate([before, before[-1] + np.cumsum(codes * up[offset:offset + len(codes)])])

    def signature(self, ending: str) -> np.ndarray:
        """Of head and ending; leaves the parse as it was."""
        state = self.root, self.node, self.learnt
        ends, journal, n = [], [], len(self.head)
        self.read(ending, n, ends, journal)
        for node, c in reversed(journal):
            del node[c]
        self.root, self.node, self.learnt = state
        sums = self.summed(ending, n, self.sums) if ending else self.sums
        ends = np.array(self.ends + ends, np.int64)
        starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]]) if len(ends) else ends
        _, down = POWERS.get(n + len(ending) + 1)
        return binned((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def binned(phrases: np.ndarray) -> np.ndarray:
    hashes = np.sort(mixed(phrases))
    out = np.full(BINS, EMPTY, np.uint16)
    bins = (hashes >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([np.ones(1, bool), bins[1:] != bins[:-1]])) if len(bins) else bins
    out[bins[first]] = (hashes[first] & np.uint64(0xFFFF)) % EMPTY
    return out


def fingerprint(text: str | None) -> str:
    text = text or ""
    return Parse(text, len(text)).signature("").astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    there = (a != EMPTY) | (b != EMPTY)
    n = int(there.sum())
    return float(((a == b) & there).sum() / n) if n else 1.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document."""
    def start():
        return lambda batch: {"doc_id": batch.column("doc_id"), "fingerprint": [fingerprint(t) for t in batch.column("text").to_pylist()]}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), start, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """range, guest, doc_id, th, text: ranges of (id, hash) in descending order, each closed by the first row of the next one.

    The driver sees a few ids for each partition: the bounds of the ranges and their first rows.
    """
    spark = docs.sparkSession
    rows = keyed(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    n = RANGES * shuffle_partitions(spark)
    found = rows.select(F.percentile_approx("doc_id", [i / n for i in range(1, max(2, n))], 20 * n), F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    bounds = found[0] or []
    # an id that is a bound more than once holds more than one range's share of the rows; such rows, and those without an id, are
    # split further by the hash of their text
    hot = sorted(b for b, times in Counter(bounds).items() if times > 1)
    parts = max([1, *(times for times in Counter(bounds).values()), -(-n * found[2] // max(1, found[1]))])
    bounds = sorted({*bounds, *hot, *(h - 1 for h in hot)})
    at = F.size(F.filter(F.lit(bounds), lambda b: b < F.col("doc_id"))) if bounds else F.lit(0)
    at = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(at)
    part = F.least(F.lit(parts - 1), F.floor((F.col("th") / 2.0 ** 63 + 1) / 2 * parts)).cast("int")
    split = F.col("doc_id").isNull() | F.col("doc_id").isin(hot) if hot else F.col("doc_id").isNull()
    rows = rows.withColumn("range", at * parts + F.when(split, part).otherwise(0))
    first = rows.groupBy("range").agg(F.max(F.struct("doc_id", "th")).alias("top")).collect()
    first = sorted(((r.range, r.top.doc_id, r.top.th) for r in first), reverse=True)
    hosts = [(first[i - 1][0], *first[i]) for i in range(len(first))]  # the first range's first row goes to the last one
    hosts = spark.createDataFrame(hosts, "host int, top_range int, top_id long, top_th long")
    mine = (F.col("range") == F.col("top_range")) & F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("th") == F.col("top_th"))
    rows = rows.join(F.broadcast(hosts), mine, "left")
    places = F.when(F.col("host").isNull(), F.array(F.struct(F.col("range"), F.lit(0).alias("guest")))).otherwise(
        F.array(F.struct(F.col("range"), F.lit(0).alias("guest")), F.struct(F.col("host").alias("range"), F.lit(1).alias("guest"))))
    rows = rows.select("doc_id", "th", "text", F.explode(places).alias("p")).select("p.range", "p.guest", "doc_id", "th", "text")
    rows = rows.repartition(shuffle_partitions(spark), "range")
    return rows.sortWithinPartitions(F.desc("range"), "guest", F.desc_nulls_last("doc_id"), F.desc("th"))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def text_of(signature: np.ndarray) -> str:
        return signature.astype(">u2").tobytes().hex()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for some in slices(batch):
                out = []
                for place, guest, doc_id, text in zip(*(some.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text"))):
                    text = text or ""
                    cut = len(text) // 3
                    parse = Parse(text, len(text) - cut)
                    own = parse.signature(text[len(text) - cut:])
                    if held and held[0] == place:
                        _, before_id, before, before_parse, before_own = held
                        new = text[:len(before) // 3]
                        edited = before_parse.signature(new)
                        whole = before[:len(before) - len(before) // 3] + new
                        out.append((before_id, len(before), hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest(), text_of(before_own), text_of(edited),
                                    likeness(before_own, edited), likeness(before_own, own)))
                    held = None if guest else (place, doc_id, text, parse, own)
                columns = list(zip(*out)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return with_next(docs).mapInArrow(run, schema)
