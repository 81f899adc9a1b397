"""Target-distribution importance resampling: hashed features, array-scored weights, exact selection by medians.

Words are runs of digits, a-z and all characters above ASCII, after A-Z became a-z. Features are all runs of 1 to
``max_n`` words; the bucket of one is its crc32 modulo ``buckets``. Texts are split once: the first pass stores the
buckets of every document as an array of small numbers, two bytes a feature. Counting the buckets and summing the
gains of a document are then array operations on what was stored. The gains are one array of ``buckets`` numbers.

The cutoff among the scores is found by weighted medians of medians: every task returns the count and the median of
the keys it has left on each side of the last pivot, the driver takes the median of these medians weighted by their
counts, and the side that cannot hold the cutoff, at least a quarter of what was left, is discarded. The last
``FINISH`` keys at most are sorted as they are. Only the winners are sorted, by ranges, and numbered by the sizes of the
ranges. What the driver gets is two rows for each task and round, ``buckets`` counts and ``FINISH`` keys.

Defined cases: null and empty texts have no features and the weight 0; a null id takes part under the name ``null`` and
comes last among equal scores; rows that tie in score and id are ordered by the hash of their text, equal rows in
any order, each with a rank of its own; very long texts are split whole, in one piece; an empty target gives gains
from the counts of the documents alone; empty tables give empty tables; extra columns are not used.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicemill.llm.common import packed, same_document, slices, written

MAX_N, BUCKETS, PERCENT, MIN_WORDS, SEED = 1, 10000, 10, 20, 2024
FINISH = 50_000          # keys that the driver may sort
MEMORY = 32 << 20        # bytes of words whose bucket a task remembers; forgetting changes no result
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
KEY = ("low", "no_id", "id", "th", "row")  # ascending: the best first
IN_TURN = 1 << 33        # numbers that Spark gives to the rows of one task


class Buckets(dict):
    """Bucket of each word, remembered up to MEMORY bytes of words."""

    def __init__(self, buckets: int):
        self.buckets, self.held = buckets, 0

    def __missing__(self, word: bytes) -> int:
        if self.held > MEMORY:
            self.clear()
            self.held = 0
        self.held += len(word) + 60
        found = self[word] = zlib.crc32(word) % self.buckets
        return found


def features(text: bytes | None, bucket: Buckets, max_n: int) -> tuple[int, list[int]]:
    """The number of words and the buckets of all features."""
    words = text.translate(WORDS).split() if text else []
    found = list(map(bucket.__getitem__, words))
    for n in range(2, max_n + 1):
        found += [zlib.crc32(b" ".join(words[i:i + n])) % bucket.buckets for i in range(len(words) - n + 1)]
    return len(words), found


def width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def arrays(batch: pa.RecordBatch, buckets: int) -> list[np.ndarray]:
    return [np.frombuffer(b, width(buckets)) for b in batch.column("features").to_pylist()]


def hashed(texts: DataFrame, max_n: int, buckets: int, *kept: str) -> DataFrame:
    """``kept`` columns, n_words, n_features and the buckets of every text."""
    fields = [texts.schema[c] for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets(buckets)
        for batch in batches:
            for some in slices(batch):
                made = [features(t, bucket, max_n) for t in some.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c) for c in kept), pa.array([n for n, _ in made], pa.int64()), pa.array([len(f) for _, f in made], pa.int64()),
                     pa.array([np.array(f, width(buckets)).tobytes() for _, f in made], pa.binary())], [*kept, "n_words", "n_features", "features"])

    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in fields) + "n_words long, n_features long, features binary"
    return texts.select(*kept, F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def bucket_counts(stored: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows: one array for each task, added up by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for some in slices(batch):
                if some.num_rows:
                    total += np.bincount(np.concatenate(arrays(some, buckets)), minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in stored.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def luck(h: int) -> int:
    """The draw of a document: a Gumbel value from 32 bits."""
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(stored: DataFrame, gain: np.ndarray) -> DataFrame:
    kept = ("doc_id", "th", "n_words", "n_features")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                weight = np.array([int(gain[a].sum()) for a in arrays(some, len(gain))], np.int64)
                score = weight + np.array([luck(h) for h in some.column("h").to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in kept), pa.array(weight), pa.array(score)], [*kept, "weight", "score"])

    return stored.mapInArrow(run, "doc_id long, th long, n_words long, n_features long, weight long, score long")


def key_of(rows: DataFrame) -> DataFrame:
    """Rows with the parts of their key, which is different for all rows."""
    return rows.select("*", (-F.col("score")).alias("low"), F.col("doc_id").isNull().cast("long").alias("no_id"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"))


def before(key: tuple, strictly: bool = True) -> Column:
    """Whether a row's key is less than ``key`` (or equal to it)."""
    own, other = F.struct(*KEY), F.struct(*[F.lit(k).cast("long").alias(n) for k, n in zip(key, KEY)])
    return own < other if strictly else own <= other


def medians(keys: DataFrame, pivot: tuple | None) -> list:
    """For each task and side of the pivot (0: before it, 1: behind it) the count and the median of its keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([np.asarray(b.column(c)) for c in KEY]) for b in batches if b.num_rows]
        if parts:
            own = np.concatenate(parts, axis=1)
            own = own[:, np.lexsort(own[::-1])]
            cut = cut_behind = 0
            if pivot is not None:
                less, equal = np.zeros(own.shape[1], bool), np.ones(own.shape[1], bool)
                for values, p in zip(own, pivot):
                    less |= equal & (values < p)
                    equal &= values == p
                cut, cut_behind = int(less.sum()), int((less | equal).sum())
            for side, a, b in ((0, 0, cut), (1, cut_behind, own.shape[1])):
                if b > a:
                    middle = own[:, (a + b - 1) // 2]
                    yield pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in (side, b - a, *middle)], ["side", "n", *KEY])

    return keys.select(*KEY).mapInArrow(run, "side long, n long, " + ", ".join(f"{c} long" for c in KEY)).collect()


def nth_key(rows: DataFrame, nth: int) -> tuple:
    """The key of place ``nth`` (from 1) among ``rows``, which are stored and have the columns KEY."""
    keys, stored, low, high, pivot = rows.select(*KEY), None, None, None, None

    def left() -> DataFrame:
        found = keys if low is None else keys.where(~before(low, strictly=False))
        return found if high is None else found.where(before(high))

    while True:
        found = medians(left(), pivot)
        sides = [[(tuple(r[c] for c in KEY), r.n) for r in found if r.side == s] for s in (0, 1)]
        side = 1
        if pivot is not None:
            ahead = sum(n for _, n in sides[0])
            if nth == ahead + 1:
                return pivot
            side = 0 if nth <= ahead else 1
            if side:
                low, nth = pivot, nth - ahead - 1
            else:
                high = pivot
        size = sum(n for _, n in sides[side])
        if size <= FINISH:
            return sorted(tuple(r) for r in left().collect())[nth - 1]
        if stored is None or 8 * size < stored:  # later rounds read what is left
            keys, stored = (keys, size) if stored is None else (written(left(), "candidates"), size)
        passed = 0
        for pivot, n in sorted(sides[side]):
            passed += n
            if 2 * passed >= size:
                break


def ranked(winners: DataFrame) -> DataFrame:
    """Winners with their rank: sorted in ranges, numbered by the sizes of the ranges before."""
    numbered = F.monotonically_increasing_id()
    ranges = written(winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY).select("*", numbered.alias("at")), "winners")
    part = F.floor(F.col("at") / IN_TURN)
    sizes = sorted((r.part, r.n) for r in ranges.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    base, starts = 0, []
    for number, n in sizes:
        starts.append((number, base))
        base += n
    start = ranges.sparkSession.createDataFrame(starts, "part long, base long")
    found = ranges.withColumn("part", part).join(F.broadcast(start), "part")
    return found.withColumn("rank", F.col("base") + F.col("at") % IN_TURN + 1)


def resample(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank and th of every document; the rank is null where it was not drawn.

    ``floor(percent * N / 100)`` of the N documents of at least ``min_words`` words are drawn.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), h.alias("h"), "text")
    stored = written(hashed(rows, max_n, buckets, "doc_id", "th", "h"), "features")
    aim = bucket_counts(hashed(target, max_n, buckets), buckets)
    rows = scored(stored, gains(bucket_counts(stored, buckets), aim))
    rows = written(rows.select("*", F.monotonically_increasing_id().alias("row")), "scores")
    every = key_of(rows)
    enough = F.col("n_words") >= min_words
    nth = percent * rows.where(enough).count() // 100
    out = ["doc_id", "n_features", "weight", "score", "rank", "th"]
    if not nth:
        return rows.withColumn("rank", F.lit(None).cast("long")).select(*out)
    cut = nth_key(every.where(enough), nth)
    drawn = enough & before(cut, strictly=False)
    rest = every.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked(every.where(drawn)).select(*out).unionByName(rest.select(*out))


def drawn(docs: DataFrame, target: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that were drawn; rows equal in id and text come together if one of them was drawn."""
    keys = resample(docs, target, **params).where("rank is not null").select("doc_id", "th").distinct()
    p = packed(docs)
    return p.join(keys, same_document(p, keys), "left_semi").select("row.*")
