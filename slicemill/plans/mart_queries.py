"""Team-day marts, the queries on them, and the lake queries (profiles, dictionary joins)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from slicemill.functions.aggregates import count_where, null_share
from slicemill.functions.columns import date_key, date_slice, day_name, iso_day_of_week, pct
from slicemill.operators import marts
from slicemill.operators.history import calendar
from slicemill.operators.relations import (
    enrich, extent, federate, group_all, groups_where, join_conservation, order_by_hidden, profile, run_on,
    sample_rows, top_k, totals,
)
from slicemill.plans.registry import query, table
from slicemill.plans.standins import (
    EVENTS_SQL, EXACT_ORDERS_SQL, FACT_SQL, NARROW, WIDE, exact_orders, fact, fact_slice, orders, web_events,
)
from slicemill.sources.inline import values

MEASURES_SQL = """
       count(*) AS shots,
       CAST(count(*) FILTER (WHERE is_on_target) AS BIGINT) AS shots_on_target,
       CAST(count(*) FILTER (WHERE is_goal) AS BIGINT) AS goals,
       CAST(count(*) FILTER (WHERE is_goal AND is_penalty) AS BIGINT) AS penalty_goals,
       CAST(sum(xg) AS DOUBLE) AS xg,
       CAST(count(*) FILTER (WHERE is_goal) - sum(xg) AS DOUBLE) AS goals_minus_xg"""


def team_day_sql(slice_: tuple[dt.date, dt.date], extra: str = "") -> str:
    return f"""WITH {FACT_SQL}
SELECT source_system, team_id, CAST(match_date AS VARCHAR) AS match_date, {MEASURES_SQL}
FROM fact
WHERE source_system = 'main' AND NOT is_shootout {extra}
  AND match_date >= DATE '{slice_[0]}' AND match_date < DATE '{slice_[1]}'
GROUP BY source_system, team_id, match_date"""


@query("team_day_narrow", "C-11 Q-17 FLT-01 AGG-03 AGG-07 AGG-12 SRT-01 PRJ-03", team_day_sql(NARROW))
def team_day_narrow(spark, sf_dir):
    return marts.team_day(fact_slice(spark, sf_dir, *NARROW), "main", *NARROW)


@query("team_day_wide", "C-11 Q-18", team_day_sql(WIDE))
def team_day_wide(spark, sf_dir):
    return marts.team_day(fact_slice(spark, sf_dir, *WIDE), "main", *WIDE)


@query("control_subset_mart", "Q-19 SRC-15 JOI-13 FLT-06", team_day_sql(
    WIDE, "AND match_id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"))
def control_subset_mart(spark, sf_dir):
    control = orders(spark, sf_dir).where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("match_id"))
    return marts.team_day(fact_slice(spark, sf_dir, *WIDE), "main", *WIDE, keys_only=control)


@query("derived_flags", "PRJ-03 AGG-07", f"""WITH {FACT_SQL}
SELECT is_shootout, is_penalty, is_on_target, is_goal, count(*) AS n FROM fact GROUP BY ALL""")
def derived_flags(spark, sf_dir):
    return group_all(fact(spark, sf_dir), ["is_shootout", "is_penalty", "is_on_target", "is_goal"],
                     {"n": F.count(F.lit(1))})


# --- the published-mart queries over a mart of all days and sources ------------------------------

MART_SQL = f"""{FACT_SQL},
mart AS (
  SELECT f.source_system, f.team_id, s.s_name AS team_name, 'Nation ' || s.s_nationkey AS manager_name, f.match_date,
         CAST(2 AS BIGINT) AS team_score, count(*) AS shots,
         count(*) FILTER (WHERE is_on_target) AS shots_on_target,
         count(*) FILTER (WHERE is_goal) AS goals,
         count(*) FILTER (WHERE is_goal AND is_penalty) AS penalty_goals, sum(xg) AS xg,
         count(*) FILTER (WHERE is_goal) - sum(xg) AS goals_minus_xg
  FROM fact f JOIN supplier s ON f.team_id = s.s_suppkey
  WHERE NOT is_shootout GROUP BY ALL)"""


def whole_mart(spark, sf_dir):
    """Team-day mart of the whole fact with team and manager names from supplier."""
    shots = fact(spark, sf_dir).where(~F.col("is_shootout"))
    day = shots.groupBy(*marts.MART_KEY).agg(*marts.shot_measures()).withColumn("goals_minus_xg", F.col("goals") - F.col("xg"))
    names = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("team_id"), F.col("s_name").alias("team_name"),
        F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("manager_name"))
    return day.join(names, "team_id").withColumn("team_score", F.lit(2).cast("bigint"))


@query("day_detail", "Q-12 SRT-01 JOI-02", f"""WITH {MART_SQL}
SELECT CAST(match_date AS VARCHAR) AS match_date, team_name, manager_name, manager_name AS opponent_name, team_score,
       shots, shots_on_target, goals, penalty_goals, CAST(xg AS DOUBLE) AS xg,
       CAST(goals_minus_xg AS DOUBLE) AS goals_minus_xg
FROM mart WHERE match_date = DATE '1998-06-18'""")
def day_detail(spark, sf_dir):
    mart = whole_mart(spark, sf_dir).withColumn("opponent_name", F.col("manager_name"))
    return marts.day_detail(mart, dt.date(1998, 6, 18))


@query("day_totals", "Q-13 AGG-02 AGG-06", f"""WITH {MART_SQL}
SELECT CAST(match_date AS VARCHAR) AS match_date, min(manager_name) AS competition, min(team_name) AS stage,
       count(*) AS team_matches, CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(goals) AS BIGINT) AS goals_from_shots,
       CAST(sum(team_score) AS BIGINT) AS goals_in_score, CAST(round(sum(xg), 2) AS DOUBLE) AS xg,
       CAST(round(sum(goals) - sum(xg), 2) AS DOUBLE) AS goals_minus_xg
FROM mart GROUP BY match_date""")
def day_totals(spark, sf_dir):
    mart = whole_mart(spark, sf_dir).withColumns({"competition_name": F.col("manager_name"),
                                                "stage_name": F.col("team_name")})
    return marts.day_totals(mart)


@query("manager_ratios", "Q-14 AGG-11 SRT-04 SCA-09", f"""WITH {MART_SQL}
SELECT team_name, manager_name, count(*) AS matches, CAST(sum(shots) AS BIGINT) AS shots,
       CAST(sum(goals) AS BIGINT) AS goals, CAST(round(sum(xg), 2) AS DOUBLE) AS xg,
       floor((CAST(sum(xg) * 10000000000 AS HUGEINT) * 200 / (count(*) * CAST(10000000000 AS HUGEINT)) + 1) // 2) / 100.0 AS xg_per_match,
       floor((sum(goals) * 200.0 / count(*) + 1) / 2) / 100.0 AS goals_per_match
FROM mart GROUP BY team_name, manager_name""")
def manager_ratios(spark, sf_dir):
    return marts.manager_ratios(whole_mart(spark, sf_dir))


@query("top_finishers", "Q-15 AGG-12 SRT-02", f"""WITH {MART_SQL}
SELECT team_name, count(*) AS matches, CAST(sum(goals) AS BIGINT) AS goals,
       CAST(round(sum(xg), 2) AS DOUBLE) AS xg, CAST(round(sum(goals) - sum(xg), 2) AS DOUBLE) AS goals_minus_xg
FROM mart GROUP BY team_name
ORDER BY round(sum(goals) - sum(xg), 2) DESC, team_name LIMIT 5""")
def top_finishers(spark, sf_dir):
    return marts.top_finishers(whole_mart(spark, sf_dir))


@query("order_by_hidden", "SRT-04", f"""WITH {EXACT_ORDERS_SQL}
SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(price) AS DOUBLE) AS price
FROM eo GROUP BY ALL""")
def hidden_order(spark, sf_dir):
    return order_by_hidden(exact_orders(spark, sf_dir), ["o_orderstatus", "o_orderpriority"],
                           {"n": F.count(F.lit(1)), "price": F.sum("price")}, ["o_orderstatus"], F.min("day"))


# --- lake queries --------------------------------------------------------------------------------

MONTH = (dt.date(2024, 1, 10), dt.date(2024, 1, 20))


@query("type_slice_average", "Q-01 Q-07 FLT-01 AGG-01", f"""WITH {EVENTS_SQL}
SELECT count(*) AS n_rows, CAST(sum(value) AS DOUBLE) / count(*) AS avg_value FROM ev
WHERE event_type = 'purchase' AND event_date >= DATE '{MONTH[0]}' AND event_date < DATE '{MONTH[1]}'""")
def type_slice_average(spark, sf_dir):
    rows = date_slice(web_events(spark, sf_dir).where("event_type = 'purchase'"), "event_date", *MONTH)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"),
                    (F.sum("value").cast("double") / F.count(F.lit(1))).alias("avg_value"))


@query("exact_average", "AGG-01", f"""WITH {EVENTS_SQL}
SELECT count(*) AS n_rows, CAST(sum(value) * 100 AS BIGINT) // count(*) AS avg_cents FROM ev""")
def exact_average(spark, sf_dir):
    t = totals(web_events(spark, sf_dir), "value")
    return t.select("n_rows", F.floor(F.col("avg_value") * 100).alias("avg_cents"))


@query("total_rows", "Q-02 SRC-02", "SELECT count(*) AS all_rows FROM lineitem")
def total_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("all_rows"))


# average rounded half up to six digits, then to two (all values are positive)
MICRO_AVG = "((sum(CAST(value * 100 AS BIGINT)) * 20000 + count(*)) // (2 * count(*)))"
HALF_UP_AVG = f"(({MICRO_AVG} + 5000) // 10000) / 100.0"


@query("hour_profile", "Q-03 AGG-02 SCA-07", f"""WITH {EVENTS_SQL}
SELECT event_type, hour_of_day, {HALF_UP_AVG} AS avg_value, count(*) AS n FROM ev GROUP BY event_type, hour_of_day""")
def hour_profile(spark, sf_dir):
    return profile(web_events(spark, sf_dir), ["event_type", "hour_of_day"], "value")


GROUPS = [("click", "engaged"), ("view", "engaged"), ("purchase", "buying")]
GROUPS_SQL = "g(event_key, event_group) AS (VALUES ('click', 'engaged'), ('view', 'engaged'), ('purchase', 'buying'))"


def event_groups(spark):
    """A dictionary that covers only part of the event types."""
    return values(spark, GROUPS, "event_key string, event_group string")


@query("hour_profile_by_group", "Q-04 JOI-06 SRC-13", f"""WITH {EVENTS_SQL}, {GROUPS_SQL}
SELECT coalesce(event_group, 'unmatched') AS region_group, hour_of_day, {HALF_UP_AVG} AS avg_value, count(*) AS n
FROM ev LEFT JOIN g ON event_type = event_key GROUP BY coalesce(event_group, 'unmatched'), hour_of_day""")
def hour_profile_by_group(spark, sf_dir):
    tagged = enrich(web_events(spark, sf_dir), event_groups(spark), "event_type", "event_key", "event_group",
                    "unmatched", "region_group")
    return profile(tagged, ["region_group", "hour_of_day"], "value")


@query("duplicate_dictionary_keys", "Q-05 FLT-05",
       """SELECT p_name AS dict_key, count(*) AS key_count FROM part GROUP BY p_name HAVING count(*) > 1""")
def duplicate_dictionary_keys(spark, sf_dir):
    d = table(spark, sf_dir, "part").withColumnRenamed("p_name", "dict_key")
    return groups_where(d, ["dict_key"], {"key_count": F.count(F.lit(1))}, F.col("key_count") > 1)


@query("join_conservation", "Q-06 JOI-07", f"""WITH {GROUPS_SQL}
SELECT (SELECT count(*) FROM events) AS before_join, count(*) AS after_join,
       CAST(count(*) FILTER (WHERE event_key IS NULL) AS BIGINT) AS unmatched
FROM events LEFT JOIN g ON event_type = event_key""")
def conservation(spark, sf_dir):
    return join_conservation(table(spark, sf_dir, "events"), event_groups(spark), "event_type", "event_key")


@query("join_conservation_repeated", "JOI-07", """
SELECT (SELECT count(*) FROM lineitem) AS before_join, count(*) AS after_join,
       CAST(count(*) FILTER (WHERE o_custkey IS NULL) AS BIGINT) AS unmatched
FROM lineitem LEFT JOIN orders ON l_suppkey = o_custkey""")
def conservation_repeated(spark, sf_dir):
    """A dictionary with repeated keys multiplies rows, which the check must show."""
    return join_conservation(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"),
                             "l_suppkey", "o_custkey")


@query("top_price", "Q-08 SRT-02 SCA-09", """
SELECT p_brand, p_type, count(*) AS events,
       CAST(round(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / 1e6, 2) AS DOUBLE) AS price_sum_mln
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'
GROUP BY p_brand, p_type ORDER BY price_sum_mln DESC, p_brand, p_type LIMIT 10""")
def top_price(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    # lines are folded per part before the join, so the join moves parts and not lines
    lines = (table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy("l_partkey")
             .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("_p")))
    sums = (lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "p_type")
            .agg(F.sum("_n").alias("events"),
                 F.round(F.sum("_p").cast("double") / F.lit(1e6), 2).alias("price_sum_mln")))
    return top_k(sums, [F.col("price_sum_mln").desc(), F.col("p_brand"), F.col("p_type")], 10)


@query("purchase_view_pct", "Q-09 AGG-03 AGG-10", f"""WITH {EVENTS_SQL}, c AS (
  SELECT user_id, CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS views,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases
  FROM ev GROUP BY user_id)
SELECT user_id, views, purchases,
       CASE WHEN views > 0 THEN floor((purchases * 20000 + views) // (2 * views)) / 100.0 END AS purchase_to_view_pct
FROM c ORDER BY purchases DESC, user_id LIMIT 10""")
def purchase_view_pct(spark, sf_dir):
    per_user = web_events(spark, sf_dir).groupBy("user_id").agg(
        count_where(F.col("event_type") == "view").alias("views"),
        count_where(F.col("event_type") == "purchase").alias("purchases"))
    rows = per_user.withColumn("purchase_to_view_pct", pct(F.col("purchases"), F.col("views")))
    return top_k(rows, [F.col("purchases").desc(), F.col("user_id")], 10)


@query("purchases_by_group", "Q-10 JOI-06", """WITH g(nation_key, district) AS (VALUES (0, 'north'), (1, 'north'),
  (2, 'south'), (3, 'south'), (4, 'east'))
SELECT coalesce(district, 'unmatched') AS region_group, count(*) AS purchase_events,
       floor((sum(CAST(o_totalprice * 100 AS BIGINT)) * 2 + count(*)) // (2 * count(*))) / 100.0 AS mean_purchase_price
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN g ON c_nationkey = nation_key
WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01'
GROUP BY coalesce(district, 'unmatched')""")
def purchases_by_group(spark, sf_dir):
    districts = values(spark, [(0, "north"), (1, "north"), (2, "south"), (3, "south"), (4, "east")],
                       "nation_key int, district string")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sold = date_slice(table(spark, sf_dir, "orders"), "o_orderdate", "1998-01-01", "1999-01-01").join(
        customer, F.col("o_custkey") == F.col("c_custkey"))
    tagged = enrich(sold, districts, "c_nationkey", "nation_key", "district", "unmatched", "region_group")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return (tagged.groupBy("region_group").agg(F.count(F.lit(1)).alias("purchase_events"),
                                               F.round(F.avg(price), 2).alias("mean_purchase_price"))
            .orderBy(F.col("purchase_events").desc(), "region_group"))


@query("sample_projection", "Q-11 SRT-03", "SELECT CAST(least(count(*), 10) AS BIGINT) AS sampled FROM events")
def sample_projection(spark, sf_dir):
    """Any ten rows; which ten is not fixed, so their number is compared."""
    sample = sample_rows(web_events(spark, sf_dir).select("event_id", "event_type", "value"), 10)
    return sample.agg(F.count(F.lit(1)).alias("sampled"))


@query("hour_amplitude", "Q-22", f"""WITH {EVENTS_SQL}, h AS (
  SELECT event_type, hour_of_day, {HALF_UP_AVG} AS v FROM ev GROUP BY event_type, hour_of_day),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY v DESC, hour_of_day) AS hi,
             row_number() OVER (PARTITION BY event_type ORDER BY v, hour_of_day) AS lo FROM h)
SELECT event_type, CAST(round(max(v) - min(v), 2) AS DOUBLE) AS amplitude,
       max(hour_of_day) FILTER (WHERE hi = 1) AS peak_hour, max(hour_of_day) FILTER (WHERE lo = 1) AS trough_hour
FROM r GROUP BY event_type""")
def hour_amplitude(spark, sf_dir):
    return marts.peak_hours(profile(web_events(spark, sf_dir), ["event_type", "hour_of_day"], "value"), "event_type")


@query("one_query_many_relations", "SRC-14 SRC-03 SRC-04 SRC-16", """
SELECT layout, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price
FROM orders, (VALUES ('frame'), ('path'), ('view')) AS t(layout) GROUP BY layout""")
def one_query_many_relations(spark, sf_dir):
    """The same aggregate on a frame, on a path used as a relation and on a catalog name."""
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("slicemill_orders")
    (view,) = federate(spark, "slicemill_orders")
    path = spark.sql(f"SELECT * FROM parquet.`{sf_dir}/orders.parquet`")
    relations = {"frame": table(spark, sf_dir, "orders"), "path": path, "view": view}
    results = run_on(lambda d: d.agg(F.count(F.lit(1)).alias("n"),
                                     F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("price")), relations)
    parts = [r.select(F.lit(n).alias("layout"), "*") for n, r in results.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("calendar_days", "SCA-08 SCA-06 SCA-07", """
WITH d AS (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                              INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS VARCHAR) AS calendar_date,
       CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month, CAST(isodow(d) AS BIGINT) AS iso_day_of_week,
       strftime(d, '%a') AS day_name FROM d""")
def calendar_days(spark, sf_dir):
    return calendar(orders(spark, sf_dir), "day")


@query("extent_per_priority", "AGG-06", f"""WITH {EXACT_ORDERS_SQL}
SELECT o_orderpriority, CAST(min(day) AS VARCHAR) AS first, CAST(max(day) AS VARCHAR) AS last, count(*) AS rows
FROM eo GROUP BY o_orderpriority""")
def extent_per_priority(spark, sf_dir):
    return extent(exact_orders(spark, sf_dir), ["o_orderpriority"], "day")


@query("date_parts", "SCA-07", """
SELECT CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS ym, strftime(o_orderdate, '%a') AS day_name,
       CAST(min(isodow(o_orderdate)) AS BIGINT) AS iso_dow, count(*) AS n FROM orders GROUP BY 1, 2""")
def date_parts(spark, sf_dir):
    d = F.col("day")
    return (orders(spark, sf_dir).groupBy(F.floor(date_key(d) / 100).alias("ym"), day_name(d).alias("day_name"))
            .agg(F.min(iso_day_of_week(d)).alias("iso_dow"), F.count(F.lit(1)).alias("n")))


@query("null_share_of_group", "AGG-14 JOI-03", """WITH g(event_key, event_group) AS (VALUES ('click', 'engaged'))
SELECT round(CAST(count(*) FILTER (WHERE event_group IS NULL) AS DOUBLE) / count(*), 9) AS share
FROM events LEFT JOIN g ON event_type = event_key""")
def null_share_of_group(spark, sf_dir):
    g = values(spark, [("click", "engaged")], "event_type string, event_group string")
    joined = table(spark, sf_dir, "events").join(g, "event_type", "left")
    return joined.agg(F.round(null_share("event_group"), 9).alias("share"))
