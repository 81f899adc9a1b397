"""Validity joins and overlap searches by a sweep line.

Starts and points of an entity are one stream in the order of their days. A task reads it once, sorted, and carries the
versions that are open: a start enters, an end leaves, a point meets exactly what is open. So the cost is events plus
results, however many versions an entity has and however they nest.

The stream is dealt by entity and bucket of ``WIDTH`` days; a version is carried into each later bucket that it reaches,
as far as there are points at all. The points of an (entity, bucket) with more than ``HOT`` of them are dealt to several tasks,
and its versions to each of these. What a task holds are the open versions of one entity and one batch. Rows with a NULL
in the entity or the day meet nothing; versions that end no later than they start are never open. The sweep itself
runs on Arrow batches: only day numbers are looked at in Python, rows are taken by their place.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 366
HOT = 5_000_000
PAIRS = 65_536  # given out at a time
DEALT = ["_entity", "_bucket", "_part"]


def _stream(points: DataFrame, versions: DataFrame, keys: Sequence[str], date: str, start: str, end: str, width: int, hot: int) -> DataFrame:
    """Points (``_p``) and versions (``_v``, open until ``_till``) of each entity and bucket by day, versions first."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    entity = F.concat_ws("\x00", *[F.col(k).cast("string") for k in keys])

    def bucket(day):
        return F.floor(day / width).cast("int")

    p = points.select(F.when(known & F.col(date).isNotNull(), entity).alias("_entity"), F.unix_date(date).alias("_at"), F.struct("*").alias("_p"))
    p = p.withColumn("_bucket", bucket(F.col("_at")))
    v = versions.where(known & (F.col(start) < F.col(end)))
    v = v.select(entity.alias("_entity"), F.unix_date(start).alias("_at"), F.unix_date(end).alias("_till"), F.struct("*").alias("_v"))
    sizes = p.where("_entity is not null").groupBy("_entity", "_bucket").agg(F.count("*").alias("_n"))
    first = F.greatest(bucket(F.col("_at")), sizes.agg(F.min("_bucket")).scalar())
    last = F.least(bucket(F.col("_till") - 1), sizes.agg(F.max("_bucket")).scalar())
    v = v.where(first <= last).withColumn("_bucket", F.explode(F.sequence(first, last)))
    # at most one row for every HOT points
    many = F.broadcast(sizes.where(F.col("_n") > hot).select("_entity", "_bucket", F.ceil(F.col("_n") / hot).alias("_parts")))
    p = p.join(many, ["_entity", "_bucket"], "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("_p"), F.col("_parts")), F.lit(0)))
    v = v.join(many, ["_entity", "_bucket"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1)))
    rows = p.select(*DEALT, "_at", F.lit(None).cast("int").alias("_till"), "_p", F.lit(None).cast(v.schema["_v"].dataType).alias("_v"))
    rows = rows.unionByName(v.select(*DEALT, "_at", "_till", F.lit(None).cast(p.schema["_p"].dataType).alias("_p"), "_v"))
    # points without an entity are spread by their rows
    deal = F.when(F.col("_entity").isNull(), F.xxhash64("_p")).otherwise(F.xxhash64(*DEALT))
    return rows.withColumn("_deal", deal).repartition("_deal").drop("_deal").sortWithinPartitions(*DEALT, "_at", F.col("_till").isNull())


def _swept(stream: DataFrame, outer: bool) -> DataFrame:
    """Pairs (``_p``, ``_v``) of a point and a version open on its day; with ``outer`` a point that meets none has one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ends, carried = None, [], None  # ends: (day, place) of open versions, the first to leave on top
        for batch in batches:
            # open versions of earlier batches come first, then those of this one
            base, before = batch.column("_v"), len(ends)
            if before:
                base = pa.concat_arrays([carried, base])
            points, place, met = batch.column("_p"), [], []

            def pairs():
                made = pa.RecordBatch.from_arrays([points.take(pa.array(place, pa.int64())), base.take(pa.array(met, pa.int64()))], ["_p", "_v"])
                place.clear()
                met.clear()
                return made

            events = zip(*(batch.column(c).to_pylist() for c in (*DEALT, "_at", "_till")))
            for i, (entity, bucket, part, at, till) in enumerate(events):
                if (entity, bucket, part) != now:
                    now, ends = (entity, bucket, part), []
                while ends and ends[0][0] <= at:
                    heapq.heappop(ends)
                if till is not None:
                    heapq.heappush(ends, (till, before + i))
                    continue
                if ends and entity is not None:
                    place += [i] * len(ends)
                    met += [n for _, n in ends]
                elif outer:
                    place.append(i)
                    met.append(None)
                if len(place) >= PAIRS:
                    yield pairs()
            if place:
                yield pairs()
            carried = base.take(pa.array([n for _, n in ends], pa.int64()))
            ends = [(day, n) for n, (day, _) in enumerate(ends)]

    kinds = ", ".join(f"{c} {stream.schema[c].dataType.simpleString()}" for c in ("_p", "_v"))
    return stream.mapInArrow(run, kinds)


def sweep_join(points: DataFrame, versions: DataFrame, keys: Sequence[str], date: str, take: Sequence[str], start: str = "valid_from",
               end: str = "valid_to", outer: bool = True, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """Points with ``take`` of every version valid on their day; a taken column replaces one of the points of the same name."""
    kept = [c for c in points.columns if c not in take]
    narrow = versions.select(*dict.fromkeys([*keys, start, end, *take]))
    pairs = _swept(_stream(points.select(*kept), narrow, keys, date, start, end, width, hot), outer)
    return pairs.select(*[F.col("_p")[c].alias(c) for c in kept], *[F.col("_v")[c].alias(c) for c in take])


def sweep_overlaps(versions: DataFrame, keys: Sequence[str], version_key: str, take: Sequence[str] = (), start: str = "valid_from",
                   end: str = "valid_to", width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """Pairs of versions of one entity whose half-open intervals intersect, each pair once, the smaller key first.

    Every start is a point as well: it meets the versions open on that day, which is when the later of two begins.
    """
    cols = list(dict.fromkeys([version_key, start, end, *take]))
    rows = versions.select(*dict.fromkeys([*keys, *cols])).where(F.col(start) < F.col(end))
    pairs = _swept(_stream(rows, rows, keys, start, start, end, width, hot), outer=False)
    p, v = F.col("_p"), F.col("_v")
    later = (p[start] > v[start]) & (p[version_key] != v[version_key]) | (p[start] == v[start]) & (v[version_key] < p[version_key])
    v_first = v[version_key] < p[version_key]
    out = [F.when(v_first, x[c]).otherwise(y[c]).alias(f"{c}_{side}") for side, x, y in (("a", v, p), ("b", p, v)) for c in cols]
    return pairs.where(later).select(*[p[k].alias(k) for k in keys], *out)
