"""Writes, layouts, snapshots and publication, checked on what is read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicemill.functions.columns import out_of_range, stamp
from slicemill.operators import quality, sketches
from slicemill.operators.compare import tables_equal, verify_copy
from slicemill.operators.marts import MART_KEY, team_day
from slicemill.operators.relations import cached, distinct_rows, with_scalar
from slicemill.plans.compare_queries import COLS, digest_sql
from slicemill.plans.mart_queries import MEASURES_SQL, team_day_sql
from slicemill.plans.quality_queries import KEY, SPLIT_SQL, line_rules
from slicemill.plans.registry import query, table
from slicemill.plans.standins import (
    EXACT_ORDERS_SQL, FACT_SQL, FIRST_YEAR, LAST_YEAR, LOWEST, NARROW, WIDE, exact_orders, fact, fact_slice, orders,
)
from slicemill.session import work_path
from slicemill.sinks import datasets, observed
from slicemill.sinks.versioned import (
    PUBLICATION_LOG, EvidenceStore, PublishedMart, create_table_as,
)
from slicemill.sources.files import read_typed_csv, sql_on_path

BOUNDARY = dt.date(1998, 1, 1)
DAY_COLS = ["source_system", "team_id", "match_date", "shots", "shots_on_target", "goals", "penalty_goals", "xg",
            "goals_minus_xg"]


# --- layouts -----------------------------------------------------------------------------------

@query("partitioned_roundtrip", "SNK-01 SNK-03 SRC-02", f"""WITH {EXACT_ORDERS_SQL}
SELECT o_orderkey, o_orderpriority, o_orderstatus, CAST(price AS DOUBLE) AS price, CAST(day AS VARCHAR) AS day FROM eo""")
def partitioned_roundtrip(spark, sf_dir):
    """Written by status, read back with the saved schema, guarded by types, counts and a digest observed while writing."""
    o = exact_orders(spark, sf_dir)
    path = work_path(spark, "by-status")
    back = observed.checked_roundtrip(o, lambda rows: datasets.write_partitioned(rows, path, "o_orderstatus"), lambda: datasets.read_like(spark, path, o.schema))
    return back.select("o_orderkey", "o_orderpriority", "o_orderstatus", "price", "day")


@query("partition_text_values", "SNK-01", """
SELECT code, count(*) AS n FROM (SELECT '00' || CAST(l_linenumber AS VARCHAR) AS code FROM lineitem) GROUP BY code""")
def partition_text_values(spark, sf_dir):
    """Number-like text in folder names stays text."""
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.concat(F.lit("00"), F.col("l_linenumber").cast("string")).alias("code"))
    path = work_path(spark, "text-partitions")
    datasets.write_partitioned(df, path, "code")
    return datasets.read_like(spark, path, df.schema).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("rejects_written", "SNK-02 AGG-15", f"""WITH {SPLIT_SQL}
SELECT reject_reason, count(*) AS count FROM tagged WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")
def rejects_written(spark, sf_dir):
    """Rejects of a first run, replaced by those of a second one over the same path."""
    lines = table(spark, sf_dir, "lineitem")
    path = work_path(spark, "rejects")
    datasets.write_rejects(quality.split_valid(lines, line_rules()[:1], KEY)[1], path)
    return datasets.write_rejects(quality.split_valid(lines, line_rules(), KEY)[1], path)


@query("year_partition_stats", "SNK-13 SNK-14", f"""WITH {EXACT_ORDERS_SQL},
b AS (SELECT greatest(year(day), {FIRST_YEAR - 1}) AS y, count(*) AS n, min(day) AS lo, max(day) AS hi FROM eo GROUP BY 1)
SELECT CAST(e.y AS BIGINT) AS year_bucket, coalesce(n, 0) AS rows, CAST(lo AS VARCHAR) AS first_day, CAST(hi AS VARCHAR) AS last_day
FROM generate_series({FIRST_YEAR - 1}, {LAST_YEAR}) AS e(y) LEFT JOIN b ON b.y = e.y""")
def year_partition_stats(spark, sf_dir):
    """Every yearly partition of the layout, among them empty ones."""
    path = work_path(spark, "by-year")
    datasets.write_by_year(exact_orders(spark, sf_dir), path, "day", LOWEST, FIRST_YEAR, LAST_YEAR)
    expected = datasets.expected_buckets(spark, FIRST_YEAR, LAST_YEAR)
    return datasets.partition_stats(spark.read.parquet(path), expected, "day")


@query("year_layout_mart", "SNK-13 C-11 C-15", team_day_sql(NARROW))
def year_layout_mart(spark, sf_dir):
    """The narrow mart over the yearly layout, with the predicate on the partition column."""
    path = work_path(spark, "fact-by-year")
    datasets.write_by_year(fact(spark, sf_dir), path, "match_date", LOWEST, FIRST_YEAR, LAST_YEAR)
    rows = spark.read.parquet(path).where(datasets.slice_partitions(*NARROW, FIRST_YEAR))
    return team_day(rows, "main", *NARROW)


OLD = (dt.date(1996, 2, 1), dt.date(1996, 5, 1))


@query("old_bucket_slice", "FLT-01 SNK-13", team_day_sql(OLD))
def old_bucket_slice(spark, sf_dir):
    """A slice older than the first yearly partition is read from the partition of all older days."""
    path, first = work_path(spark, "fact-old-bucket"), 1998
    datasets.write_by_year(fact(spark, sf_dir), path, "match_date", LOWEST, first, LAST_YEAR)
    return team_day(spark.read.parquet(path).where(datasets.slice_partitions(*OLD, first)), "main", *OLD)


@query("pruned_partitions", "C-24 SNK-13", f"""WITH y AS (
  SELECT DISTINCT greatest(year(l_shipdate), {FIRST_YEAR - 1}) AS y FROM lineitem)
SELECT s.slice, CAST(count(*) FILTER (WHERE y BETWEEN s.lo AND s.hi) AS BIGINT) AS read, count(*) AS total
FROM y, (VALUES ('narrow', {NARROW[0].year}, {NARROW[1].year}), ('wide', {WIDE[0].year}, {WIDE[1].year - 1})) AS s(slice, lo, hi)
GROUP BY s.slice""")
def pruned_partitions(spark, sf_dir):
    """Partitions that the scans of the narrow and the wide slice really read."""
    path = work_path(spark, "pruning")
    datasets.write_by_year(fact(spark, sf_dir), path, "match_date", LOWEST, FIRST_YEAR, LAST_YEAR)
    parts = []
    for name, s in (("narrow", NARROW), ("wide", WIDE)):
        rows = spark.read.parquet(path).where(datasets.slice_partitions(*s, FIRST_YEAR))
        work = datasets.pruned_partitions(spark, team_day(rows, "main", *s, sort=False), path)
        parts.append(spark.range(1).select(F.lit(name).alias("slice"), F.lit(work["read"]).alias("read"),
                                           F.lit(work["total"]).alias("total")))
    return parts[0].unionByName(parts[1])


@query("clustered_roundtrip", "SNK-15 C-15", "SELECT count(*) AS rows_a, count(*) AS rows_b, 0::BIGINT AS a_minus_b, 0::BIGINT AS b_minus_a, true AS equal FROM lineitem")
def clustered_roundtrip(spark, sf_dir):
    f = fact(spark, sf_dir)
    path = work_path(spark, "clustered")
    datasets.write_clustered(f, path, ["source_system", "match_date", "team_id"])
    return tables_equal(f, spark.read.parquet(path))


@query("zorder_rows_met", "SNK-15", """
SELECT layout, col, rows, better FROM (SELECT count(*) AS rows FROM lineitem), (VALUES
  ('lexicographic', 'match_date', true), ('lexicographic', 'player_id', false), ('zorder', 'match_date', true), ('zorder', 'player_id', true)) AS t(layout, col, better)""")
def zorder_rows_met(spark, sf_dir):
    """Rows in files that a narrow condition on the leading and on the last column cannot skip: sorted by the columns in turn, and in
    Z-order. ``better``: less than 60 % of all rows."""
    f = fact(spark, sf_dir)
    cols = ["match_date", "player_id"]
    span = f.agg(F.percentile_approx("player_id", 0.3).alias("p"), F.min("match_date").alias("d")).first()
    asked = {"match_date": (span["d"], span["d"] + dt.timedelta(days=90)), "player_id": (span["p"], span["p"])}
    parts = []
    for name, write in (("lexicographic", datasets.write_clustered), ("zorder", datasets.write_zorder)):
        path = work_path(spark, name)
        with_small_files(spark, lambda: write(f, path, cols))
        for col in cols:
            met = datasets.files_met(spark.read.parquet(path), col, *asked[col])
            parts.append(met.select(F.lit(name).alias("layout"), F.lit(col).alias("col"), "rows", (F.col("rows_met") < 0.6 * F.col("rows")).alias("better")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def with_small_files(spark, write, files=16):
    """Runs ``write`` with ``files`` partitions that are not gathered, so that a small table has files to skip as a large one has."""
    want = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(files)}
    old = {name: spark.conf.get(name) for name in want}
    try:
        for name, value in want.items():
            spark.conf.set(name, value)
        write()
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


@query("sketch_slices", "SNK-14 C-23", f"""WITH {FACT_SQL}, y AS (SELECT *, greatest(year(match_date), {FIRST_YEAR - 1}) AS y FROM fact)
SELECT s.slice, count(*) AS rows, CAST(min(match_date) AS VARCHAR) AS first_day, CAST(max(match_date) AS VARCHAR) AS last_day, true AS close
FROM y JOIN (VALUES ('all', 0, 9999), ('late', 1997, 1998), ('one', 1996, 1996)) AS s(slice, lo, hi) ON y BETWEEN lo AND hi GROUP BY s.slice""")
def sketch_slices(spark, sf_dir):
    """Slices answered from stored partition statistics; ``close``: distinct players, matches and the median are within 3 % of the rows'."""
    rows = datasets.with_bucket(fact(spark, sf_dir), "match_date", FIRST_YEAR)
    path = work_path(spark, "sketches")
    sketches.sketch_stats(rows, [datasets.BUCKET], ["player_id", "match_id"], ["player_id"], "match_date").write.parquet(path)
    stats, parts = spark.read.parquet(path), []
    for name, lo, hi in (("all", 0, 9999), ("late", 1997, 1998), ("one", 1996, 1996)):
        here = F.col(datasets.BUCKET).between(lo, hi)
        est = sketches.estimates(sketches.merged_stats(stats.where(here)))
        n = rows.where(here).agg(F.count_distinct("player_id").alias("p"), F.count_distinct("match_id").alias("m"), F.avg((F.col("player_id") <= est.select("player_id_p50").scalar()).cast("int")).alias("at"))
        near = (F.abs(F.col("distinct_player_id") - F.col("p")) <= 0.03 * F.col("p")) & (F.abs(F.col("distinct_match_id") - F.col("m")) <= 0.03 * F.col("m")) & (F.abs(F.col("at") - 0.5) <= 0.03)
        parts.append(with_scalar(est, n).select(F.lit(name).alias("slice"), "rows", "first_day", "last_day", near.alias("close")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("lakehouse_run", "C-01 SRC-01 SNK-01 SNK-02 SNK-03 SNK-05 SNK-06 Q-01 C-18", f"""WITH {EXACT_ORDERS_SQL},
t AS (SELECT *, CASE WHEN price > 350000 THEN 'price_out_of_range' WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'odd_state' END AS reason FROM eo),
a AS (SELECT * FROM t WHERE reason IS NULL)
SELECT 'batch_' || (1 + CAST(day >= DATE '{BOUNDARY}' AS INTEGER)) AS part, o_orderstatus AS name, count(*) AS rows, round(CAST(sum(price) AS DOUBLE), 2) AS price, true AS same FROM a GROUP BY 1, 2
UNION ALL SELECT 'rejected', reason, count(*), round(CAST(sum(price) AS DOUBLE), 2), true FROM t WHERE reason IS NOT NULL GROUP BY reason""")
def lakehouse_run(spark, sf_dir):
    """The lakehouse job as one: typed CSV, split with accepted = raw - rejected, rejects and a partitioned table written and read
    back, the accepted rows appended in two batches, and one query on CSV and table (``same``: equal results)."""
    o = exact_orders(spark, sf_dir)
    raw, root = work_path(spark, "raw-csv"), work_path(spark, "lake")
    o.write.option("header", True).csv(raw)
    rules = [("price_out_of_range", F.col("price") > 350000), ("odd_state", (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"))]
    typed = read_typed_csv(spark, raw, o.schema)
    accepted, rejected = quality.split_valid(typed, rules, ["o_orderkey"])
    reasons = datasets.write_rejects(rejected, f"{root}/rejected")
    kept = observed.checked_roundtrip(accepted, lambda rows: datasets.write_partitioned(rows, f"{root}/accepted", "o_orderstatus"),
                                      lambda: datasets.read_like(spark, f"{root}/accepted", accepted.schema))
    if typed.count() != kept.count() + reasons.agg(F.sum("count")).first()[0]:
        raise ValueError("accepted and rejected rows do not add up")
    datasets.check_batches(kept, "day", BOUNDARY)
    for number, batch in enumerate(datasets.split_batches(kept, "day", BOUNDARY), 1):
        observed.add_snapshot(batch, f"{root}/table", number, ("overwrite", "append")[number - 1], ["o_orderkey"], by_month())

    def totals(rows, part, name):
        return rows.groupBy(part.alias("part"), F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("price").cast("double"), 2).alias("price"))

    batch = F.concat(F.lit("batch_"), 1 + (F.col("day") >= F.lit(BOUNDARY)).cast("int"))
    by_csv = totals(accepted, batch, "o_orderstatus")
    by_table = totals(observed.current_rows(observed.stored(spark, f"{root}/table")), F.concat(F.lit("batch_"), F.col("snapshot_id")), "o_orderstatus")
    same = tables_equal(by_csv, by_table).select("equal").scalar()
    refused = totals(spark.read.schema(rejected.schema).parquet(f"{root}/rejected"), F.lit("rejected"), "reject_reason")
    return by_table.unionByName(refused).withColumn("same", same)


@query("load_core", "SNK-16 PRJ-03", """
SELECT l_orderkey AS match_id, l_suppkey AS team_id, CAST(count(*) FILTER (WHERE l_linenumber = 5) AS BIGINT) AS shootout,
       CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS goals, CAST(sum(CAST(l_discount AS DECIMAL(12,10))) AS DOUBLE) AS xg,
       CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS match_date, CAST(min(o_custkey) AS BIGINT) AS home_team_id
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, l_suppkey""")
def load_core(spark, sf_dir):
    """Flat staging to the star, both parts written, read back and joined."""
    from slicemill.operators.star import load_core as load
    shots = table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("match_date"), F.lit("main").alias("source_system"),
        F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber")).alias("event_id"), F.col("l_orderkey").alias("match_id"),
        F.col("l_suppkey").alias("team_id"), F.col("l_partkey").alias("player_id"),
        F.col("l_linenumber").cast("smallint").alias("period"), F.lit(0).cast("smallint").alias("minute"),
        F.lit(0).cast("smallint").alias("second"), F.lit("Open Play").alias("shot_type"),
        F.when(F.col("l_returnflag") == "R", "Goal").otherwise("Saved").alias("outcome"),
        F.col("l_discount").cast("decimal(12,10)").alias("xg"))
    matches = orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("match_id"), F.col("day").alias("match_date"), F.lit(1).alias("competition_id"),
        F.lit("Cup").alias("competition_name"), F.lit(1).alias("season_id"), F.lit("1").alias("season_name"),
        F.lit("Final").alias("stage_name"), F.col("o_custkey").alias("home_team_id"), F.lit("h").alias("home_team_name"),
        F.col("o_custkey").alias("away_team_id"), F.lit("a").alias("away_team_name"), F.lit(1).alias("home_score"),
        F.lit(1).alias("away_score"))
    stored = []
    for name, part in zip(("match", "fact"), load(matches, shots, "main")):
        path = work_path(spark, f"core-{name}")
        part.write.parquet(path)
        stored.append(spark.read.parquet(path))
    match, rows = stored
    sums = rows.groupBy("match_id", "team_id").agg(
        F.count_if("is_shootout").alias("shootout"), F.count_if("is_goal").alias("goals"), F.sum("xg").alias("xg"))
    return sums.join(match.select("match_id", "match_date", "home_team_id"), "match_id")


# --- batches and snapshots ---------------------------------------------------------------------

@query("batch_split_totals", "SNK-06 AGG-04", f"""WITH {EXACT_ORDERS_SQL}
SELECT count(*) AS rows, CAST(count(*) FILTER (WHERE day < DATE '{BOUNDARY}') AS BIGINT) AS first_batch,
       CAST(count(*) FILTER (WHERE day >= DATE '{BOUNDARY}') AS BIGINT) AS second_batch, 0::BIGINT AS undated FROM eo""")
def batch_split_totals(spark, sf_dir):
    return datasets.batch_metrics(exact_orders(spark, sf_dir), "day", BOUNDARY)


def two_batch_table(spark, sf_dir, by=None):
    """Replace with the first batch, append the second, twice over: a rerun must not add rows."""
    o = exact_orders(spark, sf_dir)
    datasets.check_batches(o, "day", BOUNDARY)
    parts = datasets.split_batches(o, "day", BOUNDARY)
    path = work_path(spark, "snapshots")
    for number in range(4):
        observed.add_snapshot(parts[number % 2], path, number + 1, ("overwrite", "append")[number % 2], ["o_orderkey"], by)
    return observed.stored(spark, path)


def by_month():
    return {"month": F.trunc("day", "MM")}


@query("snapshot_log", "SNK-04 SNK-05 SCA-05", f"""WITH {EXACT_ORDERS_SQL},
n AS (SELECT count(*) FILTER (WHERE day < DATE '{BOUNDARY}') AS f, count(*) AS a FROM eo)
SELECT CAST(i AS BIGINT) AS snapshot_id, CASE WHEN i % 2 = 1 THEN 'overwrite' ELSE 'append' END AS operation,
       CAST(CASE WHEN i % 2 = 1 THEN f ELSE a END AS BIGINT) AS total_records FROM n, generate_series(1, 4) AS g(i)""")
def snapshot_log(spark, sf_dir):
    return observed.snapshot_totals(two_batch_table(spark, sf_dir, by_month())).select("snapshot_id", "operation", "total_records")


@query("snapshot_rows", "SNK-04 SNK-05 C-03", f"""WITH {EXACT_ORDERS_SQL}
SELECT o_orderstatus, count(*) AS rows, count(DISTINCT o_orderkey) AS keys, CAST(sum(price) AS DOUBLE) AS price FROM eo GROUP BY o_orderstatus""")
def snapshot_rows(spark, sf_dir):
    """Rows and keys of the table after a repeated two-batch load."""
    return observed.current_rows(two_batch_table(spark, sf_dir)).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("keys"), F.sum("price").alias("price"))


@query("snapshot_slice", "SNK-04 FLT-01", f"""WITH {EXACT_ORDERS_SQL}
SELECT o_orderkey, CAST(day AS VARCHAR) AS day FROM eo WHERE day >= DATE '1997-12-20' AND day < DATE '1998-02-03'""")
def snapshot_slice(spark, sf_dir):
    """A slice across both batches, pruned by the derived month."""
    rows = observed.current_rows(two_batch_table(spark, sf_dir, by_month()))
    lo, hi = dt.date(1997, 12, 20), dt.date(1998, 2, 3)
    return rows.where(F.col("month").between(lo.replace(day=1), hi) & (F.col("day") >= F.lit(lo)) & (F.col("day") < F.lit(hi))).select("o_orderkey", "day")


@query("new_snapshots", "SNK-05", "SELECT CAST(2 AS BIGINT) AS snapshot_id, count(*) AS total_records FROM orders")
def added_snapshots(spark, sf_dir):
    """The snapshot that an append added."""
    first, second = datasets.split_batches(exact_orders(spark, sf_dir), "day", BOUNDARY)
    path, before = work_path(spark, "added"), work_path(spark, "before")
    observed.add_snapshot(first, path, 1, "overwrite", ["o_orderkey"])
    observed.snapshot_totals(observed.stored(spark, path)).write.parquet(before)
    observed.add_snapshot(second, path, 2, "append", ["o_orderkey"])
    history = observed.snapshot_totals(observed.stored(spark, path))
    return observed.new_snapshots(spark.read.parquet(before), history).join(history, "snapshot_id").select("snapshot_id", "total_records")


@query("refused_append", "SNK-05 C-18", """
SELECT o_orderstatus, count(*) AS rows, 2::BIGINT AS refused FROM orders GROUP BY o_orderstatus""")
def refused_append(spark, sf_dir):
    """A batch that repeats keys and one without keys are refused and leave no rows behind."""
    first, second = datasets.split_batches(exact_orders(spark, sf_dir), "day", BOUNDARY)
    path, refused = work_path(spark, "appended"), 0
    for number, batch in enumerate((first, first, second.withColumn("o_orderkey", F.lit(None).cast("bigint")), second), 1):
        try:
            observed.add_snapshot(batch, path, number, key=["o_orderkey"])
        except observed.AppendRefused:
            refused += 1
    return observed.stored(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.lit(refused).alias("refused"))


@query("catalog_table", "SNK-04 SNK-17 SNK-21 SRC-04", f"""WITH {EXACT_ORDERS_SQL}
SELECT CAST(count(DISTINCT date_trunc('month', day)) AS BIGINT) AS months, count(*) AS rows,
       CAST(min(o_custkey) AS VARCHAR) AS stat_min, CAST(max(o_custkey) AS VARCHAR) AS stat_max, '0' AS stat_nulls FROM eo""")
def catalog_table(spark, sf_dir):
    """A catalog table partitioned by month, analysed, described and dropped again."""
    name = f"slicemill_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_path(spark, name)}'")
    try:
        create_table_as(exact_orders(spark, sf_dir), f"{name}.orders", ("months", "day"))
        datasets.analyze(spark, f"{name}.orders", ["o_custkey"])
        stats = datasets.column_statistics(spark, f"{name}.orders", "o_custkey")
        counted = spark.table(f"{name}.orders").agg(F.count_distinct("_months").alias("m"), F.count(F.lit(1)).alias("n")).first()
        if datasets.list_tables(spark, name).count() != 1 or "_months" not in [
                r["col_name"] for r in datasets.describe(spark, f"{name}.orders").collect()]:
            raise ValueError("table is not listed as written")
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
    return spark.range(1).select(
        F.lit(counted["m"]).alias("months"), F.lit(counted["n"]).alias("rows"), F.lit(stats["min"]).alias("stat_min"),
        F.lit(stats["max"]).alias("stat_max"), F.lit(stats["num_nulls"]).alias("stat_nulls"))


# --- publication -------------------------------------------------------------------------------

def day_mart(spark, sf_dir, slice_, run_id):
    mart = team_day(fact_slice(spark, sf_dir, *slice_), "main", *slice_, sort=False)
    return stamp(mart, *slice_, run_id)


S1 = (dt.date(1998, 1, 1), dt.date(1998, 4, 1))
S2 = (dt.date(1998, 2, 1), dt.date(1998, 3, 1))
S3 = (dt.date(1998, 3, 10), dt.date(1998, 3, 20))


def published(spark, sf_dir):
    """Three publications: a quarter, a month of it without team 1, and an empty slice."""
    target = PublishedMart(spark, work_path(spark, "published"), DAY_COLS, MART_KEY)
    target.publish(day_mart(spark, sf_dir, S1, "r1"), *S1, "r1", "baseline")
    target.publish(day_mart(spark, sf_dir, S2, "r2").where("team_id <> 1"), *S2, "r2", "correction")
    target.publish(day_mart(spark, sf_dir, S3, "r3").where("false"), *S3, "r3", "empty")
    return target


@query("candidate_params", "AGG-17 SET-04 PRJ-05", f"""SELECT DISTINCT CAST(o_orderkey * 0 + 1 AS BIGINT) AS versions,
  '{S1[0]}' AS slice_start, '{S1[1]}' AS slice_end, 'r1' AS run_id FROM orders""")
def candidate_params(spark, sf_dir):
    """The parameters a candidate was built for: one combination, as every publication requires."""
    params = distinct_rows(day_mart(spark, sf_dir, S1, "r1"), ["slice_start", "slice_end", "run_id"])
    return params.select(params.agg(F.count(F.lit(1)).alias("n")).scalar().alias("versions"), "slice_start", "slice_end", "run_id")


PUBLISHED_SQL = f"""{FACT_SQL}, p AS (
  SELECT source_system, team_id, match_date, {MEASURES_SQL} FROM fact
  WHERE source_system = 'main' AND NOT is_shootout AND match_date >= DATE '{S1[0]}' AND match_date < DATE '{S1[1]}'
    AND NOT (match_date >= DATE '{S3[0]}' AND match_date < DATE '{S3[1]}')
    AND NOT (match_date >= DATE '{S2[0]}' AND match_date < DATE '{S2[1]}' AND team_id = 1)
  GROUP BY source_system, team_id, match_date)"""


@query("publish_slice_result", "SNK-08 C-12 AGG-17", f"""WITH {PUBLISHED_SQL}
SELECT source_system, team_id, CAST(match_date AS VARCHAR) AS match_date, shots, goals, round(xg, 4) AS xg,
       CASE WHEN match_date >= DATE '{S2[0]}' AND match_date < DATE '{S2[1]}' THEN 'r2' ELSE 'r1' END AS published_run_id FROM p""")
def publish_slice_result(spark, sf_dir):
    return published(spark, sf_dir).rows().select("source_system", "team_id", "match_date", "shots", "goals", "xg",
                                                  "published_run_id")


PUBLICATIONS_SQL = """
p AS (
  SELECT row_number() OVER (ORDER BY epoch(l_shipdate)::BIGINT // 86400 % 97, l_shipdate) AS pid, CAST(l_shipdate AS DATE) AS s, n
  FROM (SELECT l_shipdate, count(*) AS n FROM lineitem GROUP BY l_shipdate)),
x AS (SELECT pid, s, CASE WHEN pid = 1000 THEN DATE '9999-12-31' ELSE s + CAST(1 + n % 40 AS INTEGER) END AS e FROM p)"""


def many_publications(spark, sf_dir):
    """A log of a publication for each ship date, in a mixed order, of up to 40 days, and one with an open end."""
    days = table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    pid = F.row_number().over(Window.orderBy(F.pmod(F.unix_date("s"), F.lit(97)), "s"))  # one row for each day
    end = F.when(F.col("pid") == 1000, F.lit(dt.date(9999, 12, 31))).otherwise(F.date_add("s", (1 + F.col("n") % 40).cast("int")))
    log = days.withColumn("pid", pid).select(F.col("pid").cast("bigint").alias("publication_id"), F.lit("r").alias("run_id"), F.lit("s").alias("scenario"), F.col("s").alias("slice_start"),
                                             end.alias("slice_end"), F.col("n").alias("rows_published"), F.lit("x").alias("checksum"), F.current_timestamp().alias("published_at"))
    root = work_path(spark, "many")
    log.to(T.StructType.fromDDL(PUBLICATION_LOG)).write.parquet(f"{root}/log")
    return PublishedMart(spark, root, DAY_COLS, MART_KEY)


@query("publication_intervals", "SNK-08 SNK-10 C-12", f"""WITH {PUBLICATIONS_SQL},
b AS (SELECT s AS d FROM x UNION SELECT e FROM x),
i AS (SELECT d, lead(d) OVER (ORDER BY d) AS f FROM b),
o AS (SELECT d, f, max(pid) AS pid FROM i JOIN x ON s <= d AND e >= f GROUP BY d, f),
g AS (SELECT *, CASE WHEN lag(f) OVER (ORDER BY d) = d AND lag(pid) OVER (ORDER BY d) = pid THEN 0 ELSE 1 END AS fresh FROM o),
h AS (SELECT *, sum(fresh) OVER (ORDER BY d) AS run FROM g)
SELECT CAST(min(d) AS VARCHAR) AS slice_from, CAST(max(f) AS VARCHAR) AS slice_to, pid AS publication_id FROM h GROUP BY run, pid""")
def publication_intervals(spark, sf_dir):
    """Some 2 500 publications resolved to the intervals that each still owns."""
    return spark.createDataFrame(many_publications(spark, sf_dir).intervals(), "slice_from date, slice_to date, publication_id bigint")


@query("publication_log", "SNK-09 Q-16", f"""WITH {FACT_SQL}, d AS (
  SELECT DISTINCT team_id, match_date FROM fact WHERE source_system = 'main' AND NOT is_shootout)
SELECT CAST(1 AS BIGINT) AS publication_id, 'r1' AS run_id, 'baseline' AS scenario, false AS empty,
       count(*) AS rows_published FROM d WHERE match_date >= DATE '{S1[0]}' AND match_date < DATE '{S1[1]}'
UNION ALL SELECT 2, 'r2', 'correction', false, count(*) FROM d WHERE match_date >= DATE '{S2[0]}' AND match_date < DATE '{S2[1]}' AND team_id <> 1
UNION ALL SELECT 3, 'r3', 'empty', true, 0""")
def publication_log(spark, sf_dir):
    log = published(spark, sf_dir).log.read()
    return log.select("publication_id", "run_id", "scenario", (F.col("checksum") == "empty").alias("empty"),
                      "rows_published")


@query("last_publication", "Q-16 SRT-02", "SELECT CAST(3 AS BIGINT) AS publication_id, 'r3' AS run_id, CAST(min(0) AS BIGINT) AS rows_published FROM lineitem")
def last_publication(spark, sf_dir):
    return published(spark, sf_dir).last_publication().select("publication_id", "run_id", "rows_published")


@query("published_view", "SNK-10 JOI-10", f"""WITH {PUBLISHED_SQL}
SELECT CAST(match_date AS VARCHAR) AS match_date, count(*) AS teams, true AS stamped FROM p GROUP BY match_date""")
def published_view(spark, sf_dir):
    view = published(spark, sf_dir).view()
    stamped = F.col("last_successful_publication") >= F.col("published_at")
    return view.groupBy("match_date").agg(F.count(F.lit(1)).alias("teams"), F.bool_and(stamped).alias("stamped"))


@query("refused_publication", "C-12 C-04", f"""WITH {FACT_SQL}
SELECT count(*) AS rows, 3::BIGINT AS refused FROM (
  SELECT DISTINCT team_id, match_date FROM fact WHERE source_system = 'main' AND NOT is_shootout
  AND match_date >= DATE '{S1[0]}' AND match_date < DATE '{S1[1]}')""")
def refused_publication(spark, sf_dir):
    """A wrong slice, a repeated key and a failed rule are refused; the published rows stay."""
    from slicemill.sinks.versioned import PublicationRefused
    target = PublishedMart(spark, work_path(spark, "refused"), DAY_COLS, MART_KEY)
    good = day_mart(spark, sf_dir, S1, "r1")
    target.publish(good, *S1, "r1")
    rule = quality.value_between("mart", "shots", 0, 0)
    attempts = [(good, S2, None), (good.unionByName(good), S1, None),
                (good, S1, quality.run_rules({"mart": good}, [rule]))]
    refused = 0
    for candidate, slice_, report in attempts:
        try:
            target.publish(candidate, *slice_, "r1", report=report)
        except PublicationRefused:
            refused += 1
    return target.rows().agg(F.count(F.lit(1)).alias("rows"), F.lit(refused).alias("refused"))


@query("labelled_snapshots", "SNK-11 C-14", """
SELECT 'before' AS label, count(*) AS rows FROM orders
UNION ALL SELECT 'after', count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'none', 0""")
def labelled_snapshots(spark, sf_dir):
    """A label captured twice holds the second capture only, an empty one holds nothing."""
    store = EvidenceStore(spark, work_path(spark, "evidence"))
    o = exact_orders(spark, sf_dir)
    store.capture("orders", "after", o)
    store.capture("orders", "before", o)
    store.capture("orders", "after", o.where("o_orderstatus = 'F'"))
    store.capture("orders", "none", o.where("false"))
    parts = [store.read("orders", label).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(label).alias("label"), "rows")
             for label in ("before", "after", "none")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stored_failures", "SNK-12 SRT-03", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def stored_failures(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    rule = quality.unique_key("lineitem", lines, KEY)
    return spark.read.parquet(datasets.store_failures(rule, {"lineitem": lines}, work_path(spark, "audit")))


@query("guarded_append", "C-18 C-04", """WITH {E}
SELECT count(*) AS rows, 3::BIGINT AS refused FROM eo""".replace("{E}", EXACT_ORDERS_SQL))
def guarded_append(spark, sf_dir):
    """A clean batch is appended; a repeated key, a value out of range and an orphan are refused."""
    o = exact_orders(spark, sf_dir)
    first, second = datasets.split_batches(o, "day", BOUNDARY)
    path = work_path(spark, "guarded")
    first.write.parquet(path)
    customers = table(spark, sf_dir, "customer")

    def rules(batch):
        both = spark.read.schema(o.schema).parquet(path).unionByName(batch)
        return ({"batch": batch, "all": both}, [
            quality.unique_key("all", both, ["o_orderkey"]),
            quality.row_condition("price_in_range", "batch", out_of_range("price", 0, 1000000)),
            quality.relationships("batch", batch, ["o_custkey"], customers, ["c_custkey"])])

    refused = 0
    high = second.withColumn("price", (F.col("price") + 2000000).cast("decimal(12,2)"))
    orphan = second.withColumn("o_custkey", -F.col("o_custkey") - 1)
    for batch in (first, high, orphan, second):
        try:
            datasets.guarded_append(batch, path, *rules(batch))
        except datasets.RuleViolation:
            refused += 1
    return spark.read.schema(o.schema).parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.lit(refused).alias("refused"))


@query("verify_copy", "C-17 SNK-03 AGG-13", """
SELECT c AS check, true AS ok, CASE c WHEN 'schema' THEN '6' WHEN 'nulls' THEN '0' ELSE CAST(n AS VARCHAR) END AS detail
FROM (SELECT count(*) AS n FROM orders), (VALUES ('schema'), ('rows'), ('nulls'), ('unique_key')) AS t(c)
UNION ALL SELECT 'control_rows', true, CAST(count(*) AS VARCHAR) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL SELECT 'query_by_priority', true, CAST(count(DISTINCT o_orderpriority) AS VARCHAR) FROM orders
UNION ALL SELECT 'content', true, checksum FROM (SELECT """ + digest_sql(COLS) + f" AS checksum FROM (WITH {EXACT_ORDERS_SQL} SELECT * FROM eo))")
def copy_verified(spark, sf_dir):
    o = exact_orders(spark, sf_dir)
    path = work_path(spark, "copy")
    datasets.write_clustered(o, path, ["o_orderstatus", "day"])
    control = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return verify_copy(o, spark.read.parquet(path), ["o_orderkey"], control, ["o_custkey"],
                       {"by_priority": lambda d: d.groupBy("o_orderpriority").agg(F.sum("price").alias("price"))})


@query("sizes", "SNK-18 SNK-19 SRC-03", "SELECT count(*) AS rows, true AS csv_larger FROM lineitem")
def sizes(spark, sf_dir):
    """CSV and Parquet copies of the lines, written from one cached frame."""
    csv, parquet = work_path(spark, "size-csv"), work_path(spark, "size-parquet")
    with cached(table(spark, sf_dir, "lineitem")) as lines:
        lines.write.option("header", True).csv(csv)
        lines.write.option("compression", "snappy").parquet(parquet)
    ratio = datasets.size_ratio(spark.read.text(csv), spark.read.parquet(parquet)).select("ratio")
    return sql_on_path(spark, parquet).agg(F.count(F.lit(1)).alias("rows"), (ratio.scalar() > 1).alias("csv_larger"))


@query("export_csv", "SNK-20 SRC-01 SRT-01", team_day_sql(NARROW))
def exported(spark, sf_dir):
    """The narrow mart exported as CSV and read back by its schema."""
    mart = team_day(fact_slice(spark, sf_dir, *NARROW), "main", *NARROW, sort=False)
    path = work_path(spark, "export")
    datasets.export_csv(mart, ["match_date", "team_id"], path)
    return read_typed_csv(spark, path, mart.schema)
