"""Parquet layouts, write guards, sizes, statistics and exports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicemill.functions.columns import slice_bounds
from slicemill.operators.quality import QueryRule, RowRule, gate, reject_counts, run_rules, violators
from slicemill.sinks.observed import RoundTripError

BUCKET = "year_bucket"


class RuleViolation(ValueError):
    """A write refused because its rows break a rule."""


# --- layouts -----------------------------------------------------------------------------------

def _no_blank(df: DataFrame, col: str) -> Column:
    """Folder names cannot tell '' from NULL, so a blank text partition value stops the write."""
    if not isinstance(df.schema[col].dataType, T.StringType):
        return F.col(col)
    stop = F.raise_error(F.lit(f"blank value in partition column {col}"))
    return F.when(F.col(col) == "", stop).otherwise(F.col(col))


def write_partitioned(df: DataFrame, path: str, by: str | Sequence[str], mode: str = "overwrite") -> None:
    """Snappy Parquet in one folder per value of ``by``.

    The rebalance hint gathers a folder's rows into few files and, unlike a repartition by the
    column, splits the rows of a value that holds much of the data over many tasks.
    """
    by = [by] if isinstance(by, str) else list(by)
    safe = df.withColumns({c: _no_blank(df, c) for c in by})
    safe.hint("rebalance", *by).write.mode(mode).option("compression", "snappy").partitionBy(*by).parquet(path)


def read_like(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back with the schema written: no inference on folder names, original column order."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def row_spread(df: DataFrame) -> Column:
    """A number from the whole row, to split ties of a range layout over several tasks."""
    return F.xxhash64(*[c for c in df.columns if not isinstance(df.schema[c].dataType, T.VariantType)])


def write_clustered(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite") -> None:
    """Parquet sorted by (equality, range, group) columns, so row-group statistics can skip.

    The row hash after ``cols`` lets the range split inside a value that many rows share.
    """
    spread = df.withColumn("_spread", row_spread(df))
    (spread.repartitionByRange(*cols, "_spread").sortWithinPartitions(*cols).drop("_spread")
     .write.mode(mode).option("compression", "snappy").parquet(path))


def interleaved(df: DataFrame, cols: Sequence[str], bits: int = 6) -> Column:
    """The Z-order place of a row: the bits of its ranks in all columns in turn, the highest first.

    A rank is the number of the quantile that a value lies in, of ``2 ** bits`` each, from Spark's approximate quantiles; so
    skewed and differently scaled columns share the places evenly. Dates and times are ranked by their number, NULLs lowest.
    """
    def number(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, T.DateType):
            return F.unix_date(c)
        return F.unix_micros(F.col(c).cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.col(c).cast("double")

    steps = [i / 2 ** bits for i in range(1, 2 ** bits)]
    edges = df.agg(*[F.percentile_approx(number(c), F.lit(steps).cast("array<double>"), F.lit(10_000)).alias(f"e{i}") for i, c in enumerate(cols)]).first()
    place = F.lit(0).cast("bigint")
    ranks = []
    for i, c in enumerate(cols):
        known = F.array(*[F.lit(e) for e in sorted(set(edges[f"e{i}"] or []))] or [F.lit(0.0)])
        ranks.append(F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(F.filter(known, lambda e: e <= number(c)))))
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            place = place * 2 + F.shiftright(rank, bit).bitwiseAND(F.lit(1))
    return place


def write_zorder(df: DataFrame, path: str, cols: Sequence[str], bits: int = 6, mode: str = "overwrite") -> None:
    """Parquet in Z-order of ``cols``: files and row groups are narrow in every one of them, not in the first alone.

    The row hash after the place lets the range split inside a place that many rows share.
    """
    placed = df.withColumn("_place", interleaved(df, cols, bits)).withColumn("_spread", row_spread(df))
    (placed.repartitionByRange("_place", "_spread").sortWithinPartitions("_place").drop("_place", "_spread")
     .write.mode(mode).option("compression", "snappy").parquet(path))


def files_met(stored: DataFrame, col: str, lo, hi) -> DataFrame:
    """Files, and rows in them, whose values of ``col`` reach into ``[lo, hi]``: what a scan with that condition cannot skip."""
    per_file = stored.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("a"), F.max(col).alias("b"))
    met = (F.col("a") <= F.lit(hi)) & (F.col("b") >= F.lit(lo))
    zero = F.lit(0).cast("bigint")
    return per_file.agg(F.count_if(met).alias("files_met"), F.coalesce(F.sum(F.when(met, F.col("n"))), zero).alias("rows_met"), F.coalesce(F.sum("n"), zero).alias("rows"))


def year_bucket(date: str | Column, first_year: int) -> Column:
    """Partition value of a date: its year, or the year before ``first_year`` for all older dates."""
    return F.greatest(F.year(date), F.lit(first_year - 1))


def expected_buckets(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """All partitions of the layout, the empty ones too."""
    return spark.range(first_year - 1, last_year + 1).select(F.col("id").cast("int").alias(BUCKET))


def write_by_year(df: DataFrame, path: str, date: str, lowest: dt.date, first_year: int, last_year: int) -> None:
    """Yearly partitions ``[first_year, last_year]`` plus one for older dates from ``lowest`` on.

    A date outside all partitions fails the write, as does a NULL one.
    """
    d = F.col(date)
    fits = (d >= F.lit(lowest)) & (d < F.lit(dt.date(last_year + 1, 1, 1)))
    text = F.concat(F.lit("no partition for date "), F.coalesce(d.cast("string"), F.lit("NULL")))
    bucket = F.when(fits, year_bucket(d, first_year)).otherwise(F.raise_error(text))
    write_partitioned(df.withColumn(BUCKET, bucket.cast("int")), path, BUCKET)


def with_bucket(df: DataFrame, date: str, first_year: int) -> DataFrame:
    return df.withColumn(BUCKET, year_bucket(date, first_year))


def slice_partitions(start, end, first_year: int, bucket: str = BUCKET) -> Column:
    """Predicate on the partition column that covers the slice ``[start, end)``."""
    lo, hi = slice_bounds(start, end)
    last = hi - dt.timedelta(days=1)
    return F.col(bucket).between(max(lo.year, first_year - 1), max(last.year, first_year - 1))


def partition_stats(df: DataFrame, expected: DataFrame, date: str, bucket: str = BUCKET) -> DataFrame:
    """Rows, first and last day of every expected partition, empty ones included."""
    have = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("_rows"), F.min(date).alias("first_day"),
                                  F.max(date).alias("last_day"))
    return expected.join(have, bucket, "left").select(
        bucket, F.coalesce("_rows", F.lit(0)).alias("rows"), "first_day", "last_day")


def scan_work(df: DataFrame) -> dict[str, int]:
    """Files, partitions and rows read by the scans of ``df``, from the metrics of a run whose rows are only counted."""
    rows = df._jdf.queryExecution()
    rows.toRdd().count()
    total = {"files": 0, "partitions": 0, "rows": 0}
    names = {"numFiles": "files", "numPartitions": "partitions", "numOutputRows": "rows"}

    def visit(node) -> None:
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return visit(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return visit(node.plan())
        if node.nodeName().startswith("Scan "):
            for metric, name in names.items():
                found = node.metrics().get(metric)
                if found.isDefined():
                    total[name] += found.get().value()
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(rows.executedPlan())
    return total


def pruned_partitions(spark: SparkSession, df_slice: DataFrame, path: str) -> dict[str, int]:
    """Partition folders read by a slice query against all folders of the layout."""
    every = spark.read.parquet(path).groupBy(BUCKET).count().count()
    return {"read": scan_work(df_slice)["partitions"], "total": every}


# --- guards ------------------------------------------------------------------------------------

def assert_roundtrip(before: DataFrame, after: DataFrame) -> int:
    """Row count after a write; raises when rows, names or types changed (column order may differ)."""
    a = {f.name: f.dataType for f in before.schema.fields}
    b = {f.name: f.dataType for f in after.schema.fields}
    if a != b:
        raise RoundTripError(f"columns changed: {sorted(set(a.items()) ^ set(b.items()), key=str)}")
    n, m = before.count(), after.count()
    if n != m:
        raise RoundTripError(f"row count changed from {n} to {m}")
    return m


def write_rejects(rejected: DataFrame, path: str) -> DataFrame:
    """Write the rejected rows and return the count per reason, read from what was written.

    Written also when empty: a clean run must not leave the rejects of an earlier one behind.
    """
    rejected.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return reject_counts(rejected.sparkSession.read.schema(rejected.schema).parquet(path))


def store_failures(rule: RowRule | QueryRule, ctx: Mapping[str, DataFrame], root: str) -> str:
    """Keep a rule's violators for later reading; returns the path."""
    path = f"{root}/{rule.name}"
    violators(rule, ctx).write.mode("overwrite").parquet(path)
    return path


def guarded_append(df: DataFrame, path: str, ctx: Mapping[str, DataFrame],
                   rules: Sequence[RowRule | QueryRule]) -> None:
    """Append a batch unless it breaks a rule; nothing is written on refusal."""
    broken = gate(run_rules(ctx, rules))
    if broken:
        raise RuleViolation(f"append refused: {', '.join(broken)}")
    df.write.mode("append").option("compression", "snappy").parquet(path)


# --- batches -----------------------------------------------------------------------------------

def split_batches(df: DataFrame, date: str, boundary: dt.date) -> tuple[DataFrame, DataFrame]:
    """The parts before and from the boundary date."""
    edge = F.lit(boundary)
    return df.where(F.col(date) < edge), df.where(F.col(date) >= edge)


def batch_metrics(df: DataFrame, date: str, boundary: dt.date) -> DataFrame:
    """Rows, rows of both parts and rows without a date, in one pass."""
    before = F.col(date) < F.lit(boundary)

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")

    return df.agg(F.count(F.lit(1)).alias("rows"), total(before).alias("first_batch"),
                  total(~before).alias("second_batch"), total(F.col(date).isNull()).alias("undated"))


def check_batches(df: DataFrame, date: str, boundary: dt.date) -> None:
    """Both parts must have rows and add up to the whole."""
    m = batch_metrics(df, date, boundary).first()
    if not m["first_batch"] or not m["second_batch"] or m["first_batch"] + m["second_batch"] != m["rows"]:
        raise ValueError(f"batches do not add up: {m.asDict()}")


# --- catalog, sizes, statistics, export ----------------------------------------------------------

def dataset_size(df: DataFrame) -> DataFrame:
    """Files and bytes behind a file-based frame."""
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).groupBy("f")
    return files.agg(F.max("s").alias("s")).agg(F.count(F.lit(1)).alias("files"), F.sum("s").alias("bytes"))


def size_ratio(a: DataFrame, b: DataFrame) -> DataFrame:
    """MiB of two formats of one dataset and their ratio."""
    mib = F.lit(1024 * 1024)
    x = dataset_size(a).select((F.col("bytes") / mib).alias("a_mib"))
    y = dataset_size(b).select((F.col("bytes") / mib).alias("b_mib"))
    return x.select("a_mib", y.scalar().alias("b_mib")).withColumn("ratio", F.col("a_mib") / F.col("b_mib"))


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Tables of a namespace; temporary views, which SHOW TABLES adds everywhere, are left out."""
    return spark.sql(f"SHOW TABLES IN {namespace}").where("not isTemporary").select("namespace", "tableName")


def analyze(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> None:
    """Refresh table and column statistics for the optimizer."""
    which = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS {which}")


def column_statistics(spark: SparkSession, name: str, column: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE EXTENDED {name} {column}").collect()
    return {r["info_name"]: r["info_value"] for r in rows}


def export_csv(df: DataFrame, order: Sequence[str], path: str) -> None:
    """CSV in total order: the part files, read by name, follow one another.

    Not forced into a single file, which would pass the whole result through one task.
    """
    (df.orderBy(*order).write.mode("overwrite").option("header", True)
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("dateFormat", "yyyy-MM-dd").csv(path))
