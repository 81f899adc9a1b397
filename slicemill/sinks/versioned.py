"""Slice publication with a log on plain Parquet, catalog tables, labelled copies.

Data folders are written first and a log record last. Readers follow the log only, so a job that dies
half way leaves a folder nobody reads, and a repeat simply writes another one.
"""

from __future__ import annotations

import datetime as dt
import heapq
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicemill.functions.aggregates import count_where, digest
from slicemill.functions.columns import holds, slice_bounds
from slicemill.operators.marts import MART_COLS, MART_KEY
from slicemill.operators.quality import gate, unique_combination
from slicemill.operators.relations import with_scalar
from slicemill.sinks.observed import remove_folder, stored, write_observed
from slicemill.sources.inline import values

PUBLICATION_LOG = ("publication_id bigint, run_id string, scenario string, slice_start date, slice_end date, "
                   "rows_published bigint, checksum string, published_at timestamp")


# Types of the published team-day mart.
PUBLISHED_MART = ("match_date date, date_key int, source_system string, team_id bigint, team_name string, "
                  "manager_name string, competition_name string, stage_name string, match_id bigint, "
                  "opponent_name string, team_score int, shots bigint, shots_on_target bigint, goals bigint, "
                  "penalty_goals bigint, xg decimal(12,4), goals_minus_xg decimal(12,4), published_run_id string, "
                  "published_at timestamp")


class PublicationRefused(ValueError):
    """The candidate may not replace the published slice."""


class _Log:
    """One-row Parquet appends; a reader sees a record completely or not at all."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except Exception as e:  # no commit yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return values(self.spark, [], self.schema)

    def next_id(self, col: str) -> int:
        return self.read().agg(F.coalesce(F.max(col), F.lit(0)).alias("m")).first()["m"] + 1

    def append(self, row: tuple) -> None:
        values(self.spark, [row], self.schema).coalesce(1).write.mode("append").parquet(self.path)


def create_table_as(df: DataFrame, name: str, transform: tuple[str, str]) -> None:
    """Create-or-replace a catalog table partitioned by ``months(col)`` or ``days(col)``.

    A catalog other than the session catalog gets the real transform through the V2 writer; the
    session catalog gets the derived column.
    """
    kind, col = transform
    spark = df.sparkSession
    catalog = name.split(".")[0] if name.count(".") >= 2 else spark.catalog.currentCatalog()
    if catalog != "spark_catalog":
        fn = F.partitioning.months if kind == "months" else F.partitioning.days
        df.writeTo(name).partitionedBy(fn(F.col(col))).createOrReplace()
        return
    part = F.trunc(F.col(col), "MM") if kind == "months" else F.to_date(F.col(col))
    out = df.withColumn(f"_{kind}", part)
    out.hint("rebalance", f"_{kind}").write.mode("overwrite").format("parquet").partitionBy(f"_{kind}").saveAsTable(name)


# --- publication -------------------------------------------------------------------------------

def owned_intervals(slices: Iterable[tuple[int, dt.date, dt.date]]) -> list[tuple[dt.date, dt.date, int]]:
    """Disjoint half-open intervals with the last publication that covers them, from (publication, start, end).

    A sweep over the starts and ends in order of their days: open publications lie on a heap, the last one on top, and
    leave it when they are met there after their end. Neighbours of one owner are one interval.
    """
    starts = sorted((start, pid, end) for pid, start, end in slices if start < end)
    days = sorted({d for start, _, end in starts for d in (start, end)})
    out: list[tuple[dt.date, dt.date, int]] = []
    heap: list[tuple[int, dt.date]] = []
    at = 0
    for day, following in zip(days, days[1:]):
        while at < len(starts) and starts[at][0] == day:
            heapq.heappush(heap, (-starts[at][1], starts[at][2]))
            at += 1
        while heap and heap[0][1] <= day:
            heapq.heappop(heap)
        if heap:
            owner = -heap[0][0]
            if out and out[-1][1:] == (day, owner):
                out[-1] = (out[-1][0], following, owner)
            else:
                out.append((day, following, owner))
    return out


class PublishedMart:
    """A mart replaced slice by slice.

    Each publication writes the rows of its slice to its own folder. A day belongs to the last
    publication whose slice covers it, so an empty candidate clears its slice, days that vanished
    from the source disappear, and nothing outside the slice is rewritten. The log, one record for each publication, is
    resolved to disjoint intervals with one owner each; a reader opens the folders of the owners it needs and no others.
    """

    def __init__(self, spark: SparkSession, root: str, cols: Sequence[str] = MART_COLS,
                 key: Sequence[str] = MART_KEY, date: str = "match_date"):
        self.spark, self.root = spark, root
        self.schema = PUBLISHED_MART if list(cols) == MART_COLS else None
        self.cols, self.key, self.date = list(cols), list(key), date
        self.log = _Log(spark, f"{root}/log", PUBLICATION_LOG)

    def intervals(self, start=None, end=None) -> list[tuple[dt.date, dt.date, int]]:
        """(from, to, publication) of the whole mart, or of a slice."""
        records = self.log.read().select("publication_id", "slice_start", "slice_end").collect()  # one for each publication
        found = owned_intervals(tuple(r) for r in records)
        if start is None and end is None:
            return found
        lo, hi = slice_bounds(start, end)
        return [(max(a, lo), min(b, hi), pid) for a, b, pid in found if a < hi and b > lo]

    def _folder(self, pid: int) -> str:
        return f"{self.root}/data/publication_id={pid}"

    def rows(self, start=None, end=None) -> DataFrame:
        """Published rows, of a slice if one is named; none, with the mart's columns, before the first publication."""
        owned = self.intervals(start, end)
        if not owned:
            if self.schema:
                return values(self.spark, [], self.schema)
            found = stored(self.spark, f"{self.root}/data")
            return found.drop("publication_id").where("false")
        owners = sorted({pid for _, _, pid in owned})
        data = self.spark.read.option("mergeSchema", False).option("basePath", f"{self.root}/data").parquet(*map(self._folder, owners))
        # fewer than two intervals for each publication
        own = F.broadcast(self.spark.createDataFrame(owned, "_from date, _to date, _owner bigint"))
        on = (F.col("publication_id") == F.col("_owner")) & (F.col(self.date) >= F.col("_from")) & (F.col(self.date) < F.col("_to"))
        return data.join(own, on, "left_semi").drop("publication_id")

    def drop_superseded(self) -> list[int]:
        """Deletes the folders of publications that own no day any more; returns their ids. The log stays whole.

        For a moment without readers: one that began earlier may still want them.
        """
        logged = {r[0] for r in self.log.read().select("publication_id").collect()}
        gone = sorted(logged - {pid for _, _, pid in self.intervals()})
        for pid in gone:
            remove_folder(self._folder(pid))
        return gone

    def view(self) -> DataFrame:
        """What consumers read: the rows with the time of the last successful publication."""
        last = self.log.read().agg(F.max("published_at").alias("last_successful_publication"))
        return with_scalar(self.rows(), last)

    def last_publication(self) -> DataFrame:
        return self.log.read().orderBy(F.col("publication_id").desc()).limit(1)

    def publish(self, candidate: DataFrame, start, end, run_id: str, scenario: str = "",
                report: DataFrame | None = None) -> dict:
        """Replace the slice by the candidate, or refuse and leave everything as it was.

        The candidate is read once, by the write into its folder, which also counts what would refuse it; only the unique key is looked at
        in what was written. Nobody reads the folder before its log record is there; a refused one is taken away.
        """
        lo, hi = slice_bounds(start, end)
        if report is not None:
            failed = gate(report)
            if failed:
                raise PublicationRefused(f"failed rules: {', '.join(failed)}")
        pid = self.log.next_id("publication_id")
        now = dt.datetime.now(dt.timezone.utc)
        day = F.col(self.date)
        other = ~(F.col("slice_start").eqNullSafe(F.lit(lo)) & F.col("slice_end").eqNullSafe(F.lit(hi)) & F.col("run_id").eqNullSafe(F.lit(run_id)))
        marked = candidate.withColumns({"_outside": ~holds((day >= F.lit(lo)) & (day < F.lit(hi))), "_other": other})
        money = {c: F.col(c).cast("decimal(12,4)") for c in ("xg", "goals_minus_xg") if c in self.cols}
        out = marked.select(*self.cols, "_outside", "_other").withColumns({
            **money, "published_run_id": F.lit(run_id), "published_at": F.lit(now).cast("timestamp")})
        folder = self._folder(pid)

        def write(rows: DataFrame) -> None:
            rows.drop("_outside", "_other").write.mode("overwrite").option("compression", "snappy").parquet(folder)

        m = write_observed(out, write, {"rows": F.count(F.lit(1)), "checksum": digest(self.cols), "outside": count_where(F.col("_outside")), "other": count_where(F.col("_other"))})
        why = None
        if m["other"]:
            why = f"{m['other']} rows of the candidate were not built for {(lo, hi, run_id)}"
        elif m["outside"]:
            why = f"{m['outside']} rows of the candidate lie outside its slice"
        elif not unique_combination(self.spark.read.schema(candidate.select(*self.cols).schema).parquet(folder).select(*self.key), self.key).isEmpty():
            why = f"candidate repeats the key {self.key}"
        if why:
            remove_folder(folder)
            raise PublicationRefused(why)
        self.log.append((pid, run_id, scenario, lo, hi, m["rows"], m["checksum"], now))
        return {"publication_id": pid, "rows": m["rows"], "checksum": m["checksum"]}

    def slice_checksum(self, start, end) -> DataFrame:
        """Rows and digest of a published slice; ``'empty'`` without rows."""
        rows = self.rows(start, end)
        return rows.agg(F.count(F.lit(1)).alias("rows"), digest(self.cols).alias("checksum"))


# --- labelled snapshots --------------------------------------------------------------------------

class EvidenceStore:
    """Copies of relations under a label, one folder each, replaced as a whole."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def capture(self, name: str, label: str, df: DataFrame) -> None:
        now = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")
        df.withColumn("captured_at", now).write.mode("overwrite").parquet(f"{self.root}/{name}/label={label}")

    def read(self, name: str, label: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/label={label}")

    def labels(self, name: str) -> DataFrame:
        """All copies of a relation, with their label as a column."""
        return self.spark.read.option("mergeSchema", False).parquet(f"{self.root}/{name}")
