"""Best-fit packing by patterns: few-document length patterns fitted to the length histogram by non-negative least squares.

A document is its token ids and an end id. Only documents longer than ``CAPACITY`` are cut, so that all pieces but
the first are full. The histogram of piece lengths (at most ``CAPACITY`` numbers, the only thing the driver sees) is
approximated by repeat counts of patterns of up to three lengths that fill a sequence exactly: projected gradient
steps with momentum on the least-squares error, never below zero. Counts are rounded, what they leave of the histogram
is fitted again while that takes a good part of it, and the last rest is packed best-fit, longest first, also on the histogram. Of the plans after
each of these rounds, best fit for all of it among them, the one of the fewest sequences is taken. A plan is a list of
(pattern, repeats); its size depends on the capacity, not on the data. At most ``PATTERNS`` patterns are tried, with
their shortest lengths evenly thinned out beyond. Pieces take their place by their rank among the pieces of equal length,
which each task counts for itself and shifts by what earlier tasks have counted; no group of equal lengths, however
hot, meets in one task.

Defined cases: null and empty texts are one piece of the end id; repeated rows are packed as often as they come; null
ids stay null; very long texts are encoded whole, in one task each; pieces of equal length are alike to the plan, so ties
between them are broken by the order in which tasks read them; empty tables give no pieces; extra columns are not used.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slicemill.llm.bytepairs import encoder
from slicemill.llm.common import slices, written

CAPACITY, END = 1024, 2
STEPS, ROUNDS = 400, 2
PATTERNS = 500_000
Plan = list[tuple[tuple[int, ...], int]]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; the first takes what is over."""
    first = (length - 1) % capacity + 1
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, with the task and the rank among its pieces of equal length."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long" + (", ids binary" if with_ids else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, last = encoder(vocabulary), array("I", [end]).tobytes()
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for some in slices(batch):
                rows = []
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    ids = code(text) + last
                    for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        own = ids[4 * start:4 * (start + length)]
                        rows.append((doc_id, k, start, length, zlib.crc32(own), part, seen[length]) + ((own,) if with_ids else ()))
                        seen[length] += 1
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def exact_patterns(histogram: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of three lengths that occur and fill a sequence, shortest first; a pair has the length 0, for nothing, in front."""
    have = np.flatnonzero(histogram[:capacity])
    there = histogram > 0
    there[capacity] = False
    two = have[(2 * have <= capacity) & there[capacity - have]]
    rows = [np.c_[np.zeros(len(two), int), two, capacity - two]]
    # lengths from the shortest one up to half of what it leaves can be the second
    first, last = np.searchsorted(have, have), np.searchsorted(have, (capacity - have) // 2, side="right")
    every = np.maximum(0, last - first)
    step = max(1, -(-int(every.sum()) // PATTERNS))
    for i in np.flatnonzero(every)[::step].tolist():
        second = have[first[i]:last[i]]
        second = second[there[capacity - have[i] - second]]
        rows.append(np.c_[np.full(len(second), have[i]), second, capacity - have[i] - second])
    return np.concatenate(rows)


def fitted(histogram: np.ndarray, capacity: int) -> Plan:
    """Repeat counts of exact patterns of up to three lengths. ``histogram``: count by length, from 0 to the capacity."""
    parts = exact_patterns(histogram, capacity)
    plan: Plan = [((capacity,), int(histogram[capacity]))] if histogram[capacity] else []
    if not len(parts):
        return plan
    # what is left of long lengths is hard to pack, so their errors count more
    weight = (np.arange(capacity + 1) / capacity) ** 2
    target = histogram.astype(float)
    target[capacity] = 0

    def held(x):
        return np.bincount(parts.ravel(), np.repeat(x, 3), capacity + 1)

    def gradient(error):
        return (weight * error)[parts].sum(axis=1)

    x = np.ones(len(parts))
    for _ in range(20):  # the largest curvature, for the step
        g = gradient(held(x))
        size = np.sqrt((g * g).sum())
        x = g / size
    x = np.zeros(len(parts))
    y, momentum = x, 1.0
    for _ in range(STEPS):
        new = np.maximum(0, y - gradient(held(y) - target) / size)
        after = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        y, x, momentum = new + (momentum - 1) / after * (new - x), new, after
    # neighbouring patterns share what rounding takes from each
    order = np.lexsort((parts[:, 1], parts[:, 2]))
    times = np.diff(np.floor(np.cumsum(x[order]) + 0.5), prepend=0).astype(int)
    left = histogram.astype(np.int64).copy()
    for i, most in zip(order[::-1].tolist(), times[::-1].tolist()):
        if most:
            pattern = tuple(int(p) for p in parts[i] if p)
            most = min([most] + [int(left[p]) // pattern.count(p) for p in set(pattern)])
        if most:
            plan.append((pattern, most))
            for p in pattern:
                left[p] -= most
    return plan


def best_fit(histogram: np.ndarray, capacity: int) -> Plan:
    """Longest first into the fullest sequence that has room; sequences of equal content are handled together."""
    room: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(pattern, count):
        left = capacity - sum(pattern)
        if left not in room:
            room[left] = []
            bisect.insort(rooms, left)
        room[left].append([pattern, count])

    for length in range(capacity, 0, -1):
        count = int(histogram[length])
        while count:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                if count >= each:
                    put((length,) * each, count // each)
                if count % each:
                    put((length,) * (count % each), 1)
                break
            left = rooms[at]
            pattern, have = room[left].pop()
            if not room[left]:
                del room[left], rooms[at]
            each = min(left // length, count)
            used = min(have, count // each)
            if have > used:
                put(pattern, have - used)
            put(pattern + (length,) * each, used)
            count -= used * each
    return [(p, c) for left in rooms for p, c in room[left]]


def sequences_of(plan: Plan) -> int:
    return sum(times for _, times in plan)


def plan_for(histogram: np.ndarray, capacity: int) -> Plan:
    """The plan of the fewest sequences among those after each round of fitting, none included."""
    plan, left = [], histogram.astype(np.int64).copy()
    best = best_fit(left, capacity)
    for _ in range(ROUNDS):
        more = fitted(left, capacity)
        if not more:
            break
        before = int(left.sum())
        plan = plan + more
        for pattern, times in more:
            for p in pattern:
                left[p] -= times
        found = plan + best_fit(left, capacity)
        if sequences_of(found) <= sequences_of(best):
            best = found
        if 20 * (before - int(left.sum())) < before:  # little is taken any more
            break
    return best


def places(plan: Plan) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: equal pieces fill the places of a pattern in turn."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for pattern, times in plan:
        for length, offset in zip(pattern, itertools.accumulate(pattern, initial=0)):
            rows.append((length, used.get(length, 0), base, offset))
            used[length] = used.get(length, 0) + times
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    every = written(pieces(docs, capacity, end, vocabulary, with_ids), "pieces")
    counts = written(every.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row for each length
        histogram[r.length] = r.n
    table = places(plan_for(histogram, capacity))
    keys = table[:, 0] * (1 << 40) + table[:, 1]
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = every.join(counts, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length * (1 << 40) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(table[at, 2] + rank - table[at, 1]), pa.array(table[at, 3])], names + ["sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"
    return ranked.select(*names, "rank").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids themselves (``pack(..., with_ids=True)``): sequence_id and ids, four bytes each, low byte first."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    return held.select("sequence_id", F.aggregate("held", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
