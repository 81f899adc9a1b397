"""A slowly changing dimension kept up to date by deliveries.

Stored are the versions themselves: their first and last days are all that a version needs to know of its observations, and
they merge by minimum and maximum. A delivery is folded to such spans; only the versions of entities that it touches are
merged and ended anew, and only the partitions these entities lie in are replaced. Deliveries may come late, in any
order and more than once; the result is that of a build from all observations. A job that dies while partitions are replaced
is repaired by the same delivery again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicemill.functions.columns import null_safe_key
from slicemill.operators.compare import multiset_diff
from slicemill.operators.history import join_valid_at, spans, versions_of_spans
from slicemill.session import work_path
from slicemill.sinks.observed import remove_folder, stored, write_observed

BUCKET = "entity_bucket"


@dataclass
class Delivery:
    """Versions of the touched entities before and after, and the rows that were written for them."""
    before: DataFrame
    after: DataFrame
    rows_written: int
    buckets: list[int]


class ScdDimension:
    """Versions of ``attr`` per entity below ``path``, in ``buckets`` partitions by the hash of the entity.

    The number of buckets is fixed with the first delivery; a bucket is what a delivery rewrites at least.
    """

    def __init__(self, spark: SparkSession, path: str, entity: Sequence[str], attr: str, date: str, attr_name: str | None = None, buckets: int = 64):
        self.spark, self.path, self.entity, self.attr, self.date, self.attr_name, self.buckets = spark, path, list(entity), attr, date, attr_name, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.entity), F.lit(self.buckets)).cast("int")

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        path = work_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _among(self, df: DataFrame, touched: DataFrame, how: str) -> DataFrame:
        return df.withColumn("_key", null_safe_key(*self.entity)).join(touched, "_key", how).drop("_key")

    def read(self) -> DataFrame | None:
        """The versions, or None before the first delivery."""
        found = stored(self.spark, self.path)
        return None if found is None else found.drop(BUCKET)

    def deliver(self, obs: DataFrame, replaced: DataFrame | None = None) -> Delivery:
        """Adds observations. Entities in ``replaced`` forget what they had: ``obs`` holds all observations they still have."""
        new = self._kept(spans(obs, self.entity, self.attr, self.date, self.attr_name), "spans")
        touched = new.select(*self.entity)
        if replaced is not None:
            touched = touched.unionByName(replaced.select(*self.entity))
        touched = self._kept(touched.distinct().select(null_safe_key(*self.entity).alias("_key"), self._bucket().alias(BUCKET)), "touched")
        buckets = sorted(r[BUCKET] for r in touched.select(BUCKET).distinct().collect())  # at most self.buckets
        touched = touched.select("_key")
        if not buckets:
            none = versions_of_spans(new, self.entity)
            return Delivery(none, none, 0, buckets)
        old = stored(self.spark, self.path)
        if old is None:
            rest, before = None, versions_of_spans(new, self.entity).where("false")
        else:
            old = old.where(F.col(BUCKET).isin(buckets)).drop(BUCKET)
            rest, before = self._among(old, touched, "left_anti"), self._kept(self._among(old, touched, "left_semi"), "before")
        kept = before
        if replaced is not None:
            gone = replaced.select(null_safe_key(*self.entity).alias("_key")).distinct()
            kept = self._among(before, gone, "left_anti")
        kept = kept.drop("valid_to").withColumnsRenamed({"valid_from": "first_seen", "last_observed_on": "last_seen"})
        names = [F.max(self.attr_name).alias(self.attr_name)] if self.attr_name else []
        merged = kept.unionByName(new).groupBy(*self.entity, self.attr).agg(*names, F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
        after = self._kept(versions_of_spans(merged, self.entity), "after")
        out = after if rest is None else rest.unionByName(after)
        swap = self._kept(out.withColumn(BUCKET, self._bucket()), "swap")

        def write(rows: DataFrame) -> None:
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
             .partitionBy(BUCKET).parquet(self.path))

        done = write_observed(swap.hint("rebalance", BUCKET), write, {"rows": F.count(F.lit(1))})
        if replaced is not None:  # a bucket that lost its last version gets no new folder
            self._clear(set(buckets) - {r[BUCKET] for r in swap.select(BUCKET).distinct().collect()})
        return Delivery(before, after, done["rows"], buckets)

    def _clear(self, buckets: set[int]) -> None:
        for b in buckets:
            remove_folder(f"{self.path}/{BUCKET}={b}")

    def changed_facts(self, delivery: Delivery, facts: DataFrame, key: Sequence[str], date: str, version: Sequence[str]) -> DataFrame:
        """Fact keys with the version columns they lost (``extra`` -1) and gained (1) by a delivery.

        Only facts of touched entities are looked up, once in the versions before and once in those after.
        """
        touched = delivery.before.select(*self.entity).unionByName(delivery.after.select(*self.entity)).distinct()
        touched = touched.select(null_safe_key(*self.entity).alias("_key"))
        own = self._kept(self._among(facts.select(*dict.fromkeys([*key, *self.entity, date])), touched, "left_semi"), "facts")
        was, now = (join_valid_at(own, v, self.entity, date, list(version)).select(*key, *version) for v in (delivery.before, delivery.after))
        return multiset_diff(now, was)
