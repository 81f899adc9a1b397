"""Differences, digests, profiles and copy checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from slicemill.functions.aggregates import count_where
from slicemill.operators import compare
from slicemill.operators.marts import team_day
from slicemill.operators.relations import pair_snapshots
from slicemill.plans.mart_queries import MEASURES_SQL
from slicemill.plans.registry import query, table
from slicemill.plans.standins import (
    EXACT_ORDERS_SQL, FACT_SQL, NARROW, WIDE, exact_orders, fact, fact_slice, orders, web_events,
)
from slicemill.session import work_path
from slicemill.sinks import hashtree

# B is A with prices raised for pending urgent orders, January 1995 missing and March 1996 repeated.
B_SQL = f"""{EXACT_ORDERS_SQL},
c AS (SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN CAST(price + 1 AS DECIMAL(12,2)) ELSE price END AS price,
        day, o_orderpriority FROM eo WHERE day >= DATE '1995-02-01'),
b AS (SELECT * FROM c UNION ALL SELECT * FROM c WHERE day >= DATE '1996-03-01' AND day < DATE '1996-04-01')"""
COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "price", "day", "o_orderpriority"]


def two_states(spark, sf_dir, repeat=True):
    a = exact_orders(spark, sf_dir)
    raised = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    price = F.when(raised, (F.col("price") + 1).cast("decimal(12,2)")).otherwise(F.col("price"))
    b = a.withColumn("price", price).where(F.col("day") >= F.lit(dt.date(1995, 2, 1)))
    if not repeat:
        return a, b
    march = (F.col("day") >= F.lit(dt.date(1996, 3, 1))) & (F.col("day") < F.lit(dt.date(1996, 4, 1)))
    copies = F.when(march, F.array_repeat(F.lit(1), 2)).otherwise(F.array(F.lit(1)))
    return a, b.withColumn("_copy", F.explode(copies)).drop("_copy")


@query("except_all_counts", "SET-03 C-15", f"""WITH {B_SQL}
SELECT (SELECT count(*) FROM (SELECT * FROM eo EXCEPT ALL SELECT * FROM b)) AS a_minus_b,
       (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM eo)) AS b_minus_a""")
def except_all_counts(spark, sf_dir):
    return compare.except_all_counts(*two_states(spark, sf_dir))


@query("multiset_diff", "SET-03 C-15", f"""WITH {B_SQL}, d AS (
  SELECT 1 AS s, * FROM (SELECT * FROM eo EXCEPT ALL SELECT * FROM b)
  UNION ALL SELECT -1, * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM eo))
SELECT o_orderkey, CAST(price AS DOUBLE) AS price, CAST(sum(s) AS BIGINT) AS extra FROM d
GROUP BY o_orderkey, o_custkey, o_orderstatus, price, day, o_orderpriority""")
def multiset_diff(spark, sf_dir):
    return compare.multiset_diff(*two_states(spark, sf_dir)).select("o_orderkey", "price", "extra")


FEW_SQL = f"""{EXACT_ORDERS_SQL},
k AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM eo WHERE o_orderstatus = 'P'),
few AS (SELECT eo.* REPLACE (CASE WHEN n BETWEEN 2 AND 8 THEN CAST(price + 1 AS DECIMAL(12,2)) ELSE price END AS price)
        FROM eo LEFT JOIN k USING (o_orderkey) WHERE n IS DISTINCT FROM 1
        UNION ALL SELECT eo.* FROM eo JOIN k USING (o_orderkey) WHERE n = 10)"""


@query("tree_diff", "C-14 C-15 C-17 AGG-16", f"""WITH {FEW_SQL}, d AS (
  SELECT 1 AS s, * FROM (SELECT * FROM eo EXCEPT ALL SELECT * FROM few)
  UNION ALL SELECT -1, * FROM (SELECT * FROM few EXCEPT ALL SELECT * FROM eo))
SELECT o_orderkey, CAST(price AS DOUBLE) AS price, CAST(sum(s) AS BIGINT) AS extra, true AS read_few FROM d
GROUP BY o_orderkey, o_custkey, o_orderstatus, price, day, o_orderpriority""")
def tree_diff(spark, sf_dir):
    """Two stored copies of the orders of which nine keys differ: one is gone, seven are changed, one is repeated."""
    a = exact_orders(spark, sf_dir)
    first = a.where("o_orderstatus = 'P'").orderBy("o_orderkey").limit(10).select("o_orderkey")  # a small set of keys to change
    place = first.select("o_orderkey", F.row_number().over(Window.orderBy("o_orderkey")).alias("n"))
    marked = a.join(F.broadcast(place), "o_orderkey", "left").where(~F.col("n").eqNullSafe(F.lit(1)))
    price = F.when(F.col("n").between(2, 8), (F.col("price") + 1).cast("decimal(12,2)")).otherwise(F.col("price"))
    times = F.when(F.col("n") == 10, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    b = marked.withColumn("price", price).withColumn("_copy", F.explode(times)).select(*a.columns)
    paths = [work_path(spark, f"tree-{n}") for n in "ab"]
    total = sum(hashtree.write_with_tree(df, path, ["o_orderkey"])["rows"] for df, path in zip((a, b), paths))
    odd = hashtree.differing_leaves(spark, *paths)
    read = sum(hashtree.leaf_rows(spark, path, odd).count() for path in paths)
    out = hashtree.tree_diff(spark, *paths).select("o_orderkey", "price", "extra")
    return out.withColumn("read_few", F.lit(20 * read < total))


@query("sym_diff", "SET-02 C-14", f"""WITH {B_SQL}
SELECT 'only_in_A' AS side, o_orderkey, CAST(price AS DOUBLE) AS price FROM (SELECT * FROM eo EXCEPT SELECT * FROM b)
UNION ALL SELECT 'only_in_B', o_orderkey, CAST(price AS DOUBLE) FROM (SELECT * FROM b EXCEPT SELECT * FROM eo)""")
def sym_diff(spark, sf_dir):
    return compare.sym_diff(*two_states(spark, sf_dir), COLS).select("side", "o_orderkey", "price")


@query("tables_equal", "C-15", f"""WITH {B_SQL}, n AS (SELECT (SELECT count(*) FROM eo) AS rows_a, (SELECT count(*) FROM b) AS rows_b,
  (SELECT count(*) FROM (SELECT * FROM eo EXCEPT ALL SELECT * FROM b)) AS a_minus_b,
  (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM eo)) AS b_minus_a)
SELECT *, a_minus_b = 0 AND b_minus_a = 0 AS equal FROM n""")
def tables_equal(spark, sf_dir):
    return compare.tables_equal(*two_states(spark, sf_dir))


@query("changed_rows", "FLT-04 JOI-15 C-14 SCA-12", f"""WITH {B_SQL}
SELECT a.o_orderkey, CAST(a.price AS DOUBLE) AS a_price, CAST(c.price AS DOUBLE) AS b_price
FROM eo a JOIN c ON a.o_orderkey = c.o_orderkey
WHERE a.price IS DISTINCT FROM c.price OR a.o_orderstatus IS DISTINCT FROM c.o_orderstatus""")
def changed_rows(spark, sf_dir):
    a, b = two_states(spark, sf_dir, repeat=False)
    out = compare.changed_rows(a, b, ["o_orderkey"], ["price", "o_orderstatus"])
    return out.select("o_orderkey", "a_price", "b_price")


@query("pair_snapshots", "JOI-15", f"""WITH {B_SQL}
SELECT a.o_orderstatus, count(*) AS n, CAST(sum(c.price - a.price) AS DOUBLE) AS moved
FROM eo a JOIN c ON a.o_orderkey = c.o_orderkey GROUP BY a.o_orderstatus""")
def paired(spark, sf_dir):
    a, b = two_states(spark, sf_dir, repeat=False)
    pairs = pair_snapshots(a, b, ["o_orderkey"], ["price", "o_orderstatus"])
    return pairs.groupBy(F.col("a_o_orderstatus").alias("o_orderstatus")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("b_price") - F.col("a_price")).alias("moved"))


@query("snapshot_keys", "C-14", f"""WITH {B_SQL}
SELECT 'only_in_A' AS side, count(*) AS count FROM (SELECT o_orderkey FROM eo EXCEPT SELECT o_orderkey FROM c)""")
def snapshot_keys(spark, sf_dir):
    a, b = two_states(spark, sf_dir, repeat=False)
    return compare.compare(a, b, ["o_orderkey"], ["price", "o_orderstatus"])["keys"]


@query("compare_by_key", "JOI-14", f"""WITH {EXACT_ORDERS_SQL},
a AS (SELECT o_custkey, count(*) AS n, sum(price) AS total FROM eo WHERE o_orderpriority <> '1-URGENT' GROUP BY 1),
b AS (SELECT o_custkey, count(*) AS n, sum(price) + 0.00005 AS total FROM eo WHERE o_orderpriority <> '2-HIGH' GROUP BY 1)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'extra' ELSE 'different' END AS status,
       a.n AS a_n, b.n AS b_n
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey
WHERE b.n IS NULL OR a.n IS NULL OR a.n <> b.n OR abs(a.total - b.total) >= 0.0001""")
def compare_by_key(spark, sf_dir):
    """Two results per customer that differ in rows, and in a total by more or less than the tolerance."""
    def result(skip, shift):
        rows = exact_orders(spark, sf_dir).where(F.col("o_orderpriority") != skip)
        total = F.sum("price").cast("decimal(20,5)") + F.lit(shift).cast("decimal(6,5)")
        return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), total.alias("total"))

    out = compare.compare_by_key(result("1-URGENT", "0"), result("2-HIGH", "0.00005"), ["o_custkey"], ["n", "total"],
                                 {"total": "0.0001"})
    return out.select("o_custkey", "status", "a_n", "b_n")


def digest_sql(cols: list[str]) -> str:
    text = "concat_ws('|', " + ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols) + ")"

    def part(start):
        return f"CAST(coalesce(sum(CAST('0x' || substr(md5({text}), {start}, 15) AS BIGINT)), 0) AS VARCHAR)"

    return f"CASE WHEN count(*) = 0 THEN 'empty' ELSE md5(count(*) || ':' || {part(1)} || ':' || {part(17)}) END"


@query("content_checksum", "AGG-09", f"""WITH {EXACT_ORDERS_SQL}
SELECT o_orderpriority, count(*) AS rows, {digest_sql(COLS)} AS checksum FROM eo GROUP BY o_orderpriority""")
def content_checksum(spark, sf_dir):
    return compare.content_checksum(exact_orders(spark, sf_dir), COLS, ["o_orderpriority"])


@query("empty_checksum", "AGG-09", f"""WITH {EXACT_ORDERS_SQL}
SELECT count(*) AS rows, {digest_sql(COLS)} AS checksum FROM eo WHERE day > DATE '2100-01-01'""")
def empty_checksum(spark, sf_dir):
    late = exact_orders(spark, sf_dir).where(F.col("day") > F.lit(dt.date(2100, 1, 1)))
    return compare.content_checksum(late, COLS)


@query("snapshot_summary", "C-14 AGG-05 AGG-09", f"""WITH {B_SQL}, s AS (SELECT 'A' AS label, * FROM eo UNION ALL SELECT 'B', * FROM b)
SELECT 'orders' AS obj, label, count(*) AS rows, count(DISTINCT o_orderkey) AS keys, CAST(round(sum(price), 4) AS DOUBLE) AS sum_xg,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS goals, {digest_sql(COLS)} AS checksum FROM s GROUP BY label""")
def snapshot_summary(spark, sf_dir):
    a, b = two_states(spark, sf_dir)
    return compare.snapshot_summary("orders", {"A": a, "B": b}, ["o_orderkey"], COLS, "price",
                                    count_where(F.col("o_orderstatus") == "F"))


@query("digest_of_digests", "AGG-16", f"""WITH {EXACT_ORDERS_SQL}, d AS (
  SELECT CAST(year(day) AS BIGINT) AS y, {digest_sql(COLS)} AS checksum FROM eo GROUP BY 1)
SELECT count(*) AS ids, sha256(string_agg(y || ':' || checksum || chr(10), '' ORDER BY y)) AS digest FROM d""")
def digest_of_digests(spark, sf_dir):
    """A table digest made of one order-free digest per year."""
    yearly = compare.content_checksum(exact_orders(spark, sf_dir).withColumn("y", F.year("day").cast("bigint")), COLS, ["y"])
    return compare.digest_of(yearly, "y", "checksum")


@query("null_profile", "AGG-13", """
SELECT CAST(count(*) FILTER (WHERE lang = 'en') AS BIGINT) AS lang, 0::BIGINT AS doc_id,
       CAST(count(*) FILTER (WHERE n_chars < 500) AS BIGINT) AS n_chars FROM documents""")
def null_profile(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") != "en", F.col("lang")).alias("lang"),
        F.when(F.col("n_chars") >= 500, F.col("n_chars")).alias("n_chars"))
    return compare.null_profile(d)


def _profile_sql() -> str:
    cols = [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")]
    return " UNION ALL ".join(f"SELECT '{c}' AS col_name, '{t}' AS data_type, count(*) AS rows, count(*) - count({c}) AS nulls "
                              "FROM labels" for c, t in cols)


@query("column_profile", "SNK-17 AGG-13", _profile_sql())
def column_profile(spark, sf_dir):
    return compare.column_profile(table(spark, sf_dir, "labels"))


@query("filter_shares", "C-23", f"""WITH {FACT_SQL}
SELECT count(*) AS rows_total, CAST(count(*) FILTER (WHERE NOT is_shootout) AS BIGINT) AS not_shootout,
  CAST(count(*) FILTER (WHERE match_date >= DATE '{NARROW[0]}' AND match_date < DATE '{NARROW[1]}') AS BIGINT) AS narrow_date_only,
  CAST(count(*) FILTER (WHERE NOT is_shootout AND match_date >= DATE '{NARROW[0]}' AND match_date < DATE '{NARROW[1]}') AS BIGINT) AS narrow_all_filters,
  CAST(count(*) FILTER (WHERE match_date >= DATE '{WIDE[0]}' AND match_date < DATE '{WIDE[1]}') AS BIGINT) AS wide_date_only,
  CAST(count(*) FILTER (WHERE NOT is_shootout AND match_date >= DATE '{WIDE[0]}' AND match_date < DATE '{WIDE[1]}') AS BIGINT) AS wide_all_filters,
  CAST(min(match_date) AS VARCHAR) AS date_min, CAST(max(match_date) AS VARCHAR) AS date_max FROM fact""")
def filter_shares(spark, sf_dir):
    def within(s):
        return (F.col("match_date") >= F.lit(s[0])) & (F.col("match_date") < F.lit(s[1]))

    live = ~F.col("is_shootout")
    return compare.filter_shares(fact(spark, sf_dir), {
        "not_shootout": live, "narrow_date_only": within(NARROW), "narrow_all_filters": live & within(NARROW),
        "wide_date_only": within(WIDE), "wide_all_filters": live & within(WIDE)}, "match_date")


@query("distinct_estimate", "C-23", f"""WITH {FACT_SQL}
SELECT count(*) AS rows_total, CAST(min(match_date) AS VARCHAR) AS date_min, CAST(max(match_date) AS VARCHAR) AS date_max,
       true AS estimate_close FROM fact""")
def distinct_estimate(spark, sf_dir):
    """The approximate distinct count of the filter column lies within a tenth of the exact one."""
    f = fact(spark, sf_dir)
    shares = compare.filter_shares(f, {}, "match_date", "match_date")
    exact = f.agg(F.count_distinct("match_date").alias("n")).scalar()
    close = F.abs(F.col("distinct_estimate") - exact) <= exact * 0.1
    return shares.select("rows_total", "date_min", "date_max", close.alias("estimate_close"))


@query("layer_counts", "C-22", """
SELECT 'raw' AS layer, count(*) AS rows FROM lineitem
UNION ALL SELECT 'ods', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
UNION ALL SELECT 'orders', count(*) FROM orders""")
def layer_counts(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem")
    current = raw.select("l_orderkey", "l_linenumber").distinct()
    return compare.layer_counts({"raw": raw, "ods": current, "orders": table(spark, sf_dir, "orders")})


@query("id_collisions", "C-21 AGG-08", """
SELECT l_partkey, count(*) AS rows_with_same_local_id,
       string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS sources
FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_returnflag) > 1""")
def id_collisions(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "source_system")
    return compare.id_collisions(rows, "l_partkey")


RESULT_SQL = f"""SELECT source_system, team_id, match_date, {MEASURES_SQL} FROM fact
  WHERE source_system = 'main' AND NOT is_shootout AND match_date >= DATE '{WIDE[0]}' AND match_date < DATE '{WIDE[1]}'
  GROUP BY source_system, team_id, match_date"""


@query("results_across", "C-15 SRC-14", f"""WITH {FACT_SQL}, r AS ({RESULT_SQL})
SELECT layout, count(*) AS rows, CAST(sum(shots) AS BIGINT) AS sum_shots, CAST(sum(goals) AS BIGINT) AS sum_goals,
       true AS same_checksum FROM r, (VALUES ('whole'), ('sliced')) AS t(layout) GROUP BY layout""")
def results_across(spark, sf_dir):
    """The wide query on the fact filtered late and early: equal rows, sums and digests."""
    layouts = {"whole": fact(spark, sf_dir), "sliced": fact_slice(spark, sf_dir, *WIDE)}
    both = compare.results_across(lambda f: team_day(f, "main", *WIDE, sort=False), layouts, ["shots", "goals", "xg"])
    same = both.agg(F.min("checksum") == F.max("checksum")).scalar()
    return both.select("layout", "rows", "sum_shots", "sum_goals", same.alias("same_checksum"))


@query("reconcile_raw", "C-19", f"""WITH s AS (
  SELECT l_orderkey AS match_id, l_suppkey AS team_id, count(*) FILTER (WHERE l_returnflag <> 'N') AS shots,
         count(*) FILTER (WHERE l_returnflag = 'R') AS goals, count(*) FILTER (WHERE l_returnflag = 'N') AS own_goals_for,
         sum(CAST(l_discount AS DECIMAL(12,8))) FILTER (WHERE l_returnflag <> 'N') AS xg
  FROM lineitem WHERE least(l_linenumber, 5) < 5 GROUP BY ALL),
sides AS (SELECT o_orderkey AS match_id, CAST(o_orderdate AS DATE) AS d, o_custkey % 100 AS team_id, 0 AS score FROM orders
  UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), (o_custkey + 50) % 100, 1 FROM orders)
SELECT sides.match_id, sides.team_id, coalesce(shots, 0) AS shots, coalesce(goals, 0) AS goals,
       coalesce(own_goals_for, 0) AS own_goals_for, CAST(coalesce(xg, 0) AS DOUBLE) AS xg,
       coalesce(goals, 0) + coalesce(own_goals_for, 0) = score AS score_ok
FROM sides LEFT JOIN s ON s.match_id = sides.match_id AND s.team_id = sides.team_id""")
def reconcile_raw(spark, sf_dir):
    """Measures recounted from raw events for both sides of every match, against the official score."""
    return compare.recount(*raw_events(spark, sf_dir)).select("match_id", "team_id", "shots", "goals", "own_goals_for", "xg",
                                                              "score_ok")


def raw_events(spark, sf_dir):
    """lineitem as raw events and orders as matches."""
    flag = F.col("l_returnflag")
    events = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("team_id"),
        F.when(flag == "N", "Own Goal For").otherwise("Shot").alias("event_type"),
        F.least("l_linenumber", F.lit(5)).alias("period"), F.when(flag == "R", "Goal").otherwise("Saved").alias("outcome"),
        F.col("l_discount").cast("decimal(12,8)").alias("xg"))
    matches = orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("match_id"), F.col("day").alias("match_date"),
        (F.col("o_custkey") % 100).alias("home_team_id"), ((F.col("o_custkey") + 50) % 100).alias("away_team_id"),
        F.lit(0).alias("home_score"), F.lit(1).alias("away_score"))
    return events, matches


@query("reconcile_published", "C-19", """WITH s AS (
  SELECT l_orderkey AS match_id, l_suppkey AS team_id, count(*) FILTER (WHERE l_returnflag <> 'N') AS shots
  FROM lineitem WHERE least(l_linenumber, 5) < 5 GROUP BY ALL),
sides AS (SELECT o_orderkey AS match_id, CAST(o_orderdate AS DATE) AS d, o_custkey % 100 AS team_id FROM orders
  UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), (o_custkey + 50) % 100 FROM orders),
p AS (SELECT d, team_id, count(*) AS n FROM sides GROUP BY ALL),
c AS (SELECT sides.*, coalesce(shots, 0) AS shots FROM sides LEFT JOIN s USING (match_id, team_id))
SELECT team_id % 2 = 0 AS listed, count(*) AS sides, count(*) FILTER (WHERE team_id % 2 = 0 AND shots = 0 AND xg0) AS ok
FROM (SELECT c.*, coalesce(x, 0) = 0 AS xg0 FROM c LEFT JOIN (
  SELECT l_orderkey AS match_id, l_suppkey AS team_id, sum(l_discount) FILTER (WHERE l_returnflag <> 'N') AS x
  FROM lineitem WHERE least(l_linenumber, 5) < 5 GROUP BY ALL) USING (match_id, team_id)) GROUP BY 1""")
def reconcile_published(spark, sf_dir):
    """Recount against a publication of even teams without shots; another source's rows for the same days do not count."""
    events, matches = raw_events(spark, sf_dir)
    sides = matches.select("match_date", F.col("home_team_id").alias("team_id")).union(matches.select("match_date", "away_team_id")).distinct()
    zero = {c: F.lit(0) for c in ("shots", "shots_on_target", "goals")} | {"xg": F.lit(0).cast("decimal(12,8)")}
    main = sides.where("team_id % 2 = 0").withColumns(zero).withColumn("source_system", F.lit("main"))
    partner = sides.withColumns(zero).withColumn("source_system", F.lit("partner"))
    out = compare.reconcile(events, matches, main.unionByName(partner), "main")
    return out.groupBy((F.col("team_id") % 2 == 0).alias("listed")).agg(
        F.count(F.lit(1)).alias("sides"), F.count_if("published_ok").alias("ok"))


@query("user_day_profile", "AGG-07 SRT-01", """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, event_type, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM events GROUP BY user_id, CAST(ts AS DATE), event_type""")
def user_day_profile(spark, sf_dir):
    return (web_events(spark, sf_dir).groupBy("user_id", "event_date", "event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
            .orderBy("event_date", "user_id", "event_type"))
