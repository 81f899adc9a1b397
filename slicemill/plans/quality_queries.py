"""Quality split, contract, rule library and business assertions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from slicemill.functions.aggregates import count_where, distinct_keys, null_share
from slicemill.functions.columns import in_range, in_set, is_blank, out_of_range
from slicemill.operators import contract, quality
from slicemill.operators.history import mark_duplicates
from slicemill.operators.marts import team_day
from slicemill.operators.relations import (
    in_keys, key_counts, not_in_keys, orphans,
)
from slicemill.plans.registry import query, table
from slicemill.plans.standins import FACT_SQL, WIDE, fact, fact_slice, orders

KEY = ["l_orderkey", "l_linenumber"]


def line_rules():
    """Ordered reject rules for lines; some hold together, so the order matters."""
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    quantity = F.when(F.col("l_quantity") < 49, F.col("l_quantity"))
    return [("missing_required_field", is_blank(flag) & (F.col("l_linestatus") == "F")),
            ("quantity_out_of_range", out_of_range(quantity, 2, 45)),
            ("negative_margin", F.col("l_discount") > F.col("l_tax") + 0.055)]


SPLIT_SQL = """
t AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem),
tagged AS (SELECT *, CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'missing_required_field'
  WHEN l_quantity < 49 AND (l_quantity < 2 OR l_quantity > 45) THEN 'quantity_out_of_range'
  WHEN l_discount > l_tax + 0.055 THEN 'negative_margin'
  WHEN copies > 1 THEN 'duplicate_key' END AS reject_reason FROM t)"""


@query("split_accepted", "C-01 WIN-05 SCA-11", f"""WITH {SPLIT_SQL}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM tagged WHERE reject_reason IS NULL""")
def split_accepted(spark, sf_dir):
    accepted, _ = quality.split_valid(table(spark, sf_dir, "lineitem"), line_rules(), KEY)
    return accepted.select("l_orderkey", "l_linenumber", "l_quantity")


@query("split_rejected_by_reason", "C-01 AGG-15 SNK-02", f"""WITH {SPLIT_SQL}
SELECT reject_reason, count(*) AS count FROM tagged WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")
def split_rejected_by_reason(spark, sf_dir):
    _, rejected = quality.split_valid(table(spark, sf_dir, "lineitem"), line_rules(), KEY)
    return quality.reject_counts(rejected)


@query("duplicate_flags", "WIN-05", """WITH t AS (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_duplicate FROM lineitem)
SELECT is_duplicate, l_returnflag, count(*) AS n FROM t GROUP BY ALL""")
def duplicate_flags(spark, sf_dir):
    marked = mark_duplicates(table(spark, sf_dir, "lineitem"), KEY)
    return marked.groupBy("is_duplicate", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("contract_metrics", "C-02 AGG-04 AGG-05 FLT-02 FLT-03", """
SELECT count(*) AS rows, count(DISTINCT event_id) AS unique_ids, CAST(count(*) FILTER (WHERE
  event_type NOT IN ('click', 'view', 'purchase', 'signup')
  OR CAST(ts AS DATE) < DATE '2024-01-03' OR CAST(ts AS DATE) >= DATE '2024-01-29'
  OR (event_type = 'purchase' AND NOT (value > 1 AND value <= 300))
  OR (event_type <> 'purchase' AND value > 200)) AS BIGINT) AS invalid_rows FROM events""")
def contract_metrics(spark, sf_dir):
    """Required fields, an enumeration, a date window and a rule that depends on the type, in one pass."""
    day, buys = F.to_date("ts"), F.col("event_type") == "purchase"
    bad = quality.contract_violation(["event_id", "ts", "event_type", "props"], [
        ~in_set("event_type", ["click", "view", "purchase", "signup"]),
        (day < F.lit(dt.date(2024, 1, 3))) | (day >= F.lit(dt.date(2024, 1, 29))),
        buys & ~((F.col("value") > 1) & in_range("value", hi=300)), ~buys & (F.col("value") > 200)])
    return quality.contract_metrics(table(spark, sf_dir, "events"), ["event_id"], bad)


# events as rows of the event contract, with what breaks each of its rules here and there
EVENTS_21 = {
    "event_id": "'e' || CAST(event_id AS STRING)", "user_id": "CAST(user_id AS INT)",
    "session_id": "CASE WHEN event_id % 1000 = 7 THEN ' ' ELSE 's' || CAST(user_id % 100 AS STRING) END", "event_ts": "CAST(ts AS TIMESTAMP)",
    "event_date": "CASE WHEN event_id % 700 = 0 THEN CAST(ts AS DATE) + INTERVAL '1' DAY ELSE CAST(ts AS DATE) END",
    "event_type": "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'search' ELSE event_type END",
    "platform": "CASE WHEN user_id % 3 = 0 THEN 'web' ELSE 'app' END", "device_type": "CASE WHEN user_id % 2 = 0 THEN 'phone' ELSE 'desktop' END",
    "os_version": "'os' || CAST(user_id % 5 AS STRING)", "app_version": "CASE WHEN event_id % 333 <> 5 THEN '1.' || CAST(user_id % 9 AS STRING) END",
    "region": "'r' || CAST(user_id % 8 AS STRING)", "city": "'c' || CAST(user_id % 40 AS STRING)", "referrer": "CASE WHEN event_id % 500 = 3 THEN NULL ELSE 'direct' END",
    "category_id": "CAST(event_id % 12 AS INT)", "category_name": "CASE WHEN event_id % 12 = 11 AND event_id % 5 = 0 THEN '' ELSE 'cat' END",
    "price_rub": "CASE WHEN event_type = 'purchase' AND event_id % 90 <> 0 THEN CAST(value AS DECIMAL(12,2)) WHEN event_id % 800 = 1 THEN CAST(0 AS DECIMAL(12,2)) END",
    "quantity": "CASE WHEN event_type = 'purchase' THEN CAST(1 + event_id % 5 AS INT) WHEN event_id % 800 = 1 THEN 1 END",
    "currency": "CASE WHEN event_id % 600 = 2 THEN 'USD' ELSE 'RUB' END",
    "payment_method": "CASE WHEN event_type = 'purchase' THEN CASE event_id % 6 WHEN 0 THEN 'card' WHEN 1 THEN 'sbp' WHEN 2 THEN 'wallet' WHEN 3 THEN 'cash_on_delivery' WHEN 4 THEN 'installment' ELSE 'cheque' END END",
    "duration_ms": "CASE WHEN event_id % 450 <> 9 THEN CAST(100 + event_id % 1000 AS INT) END", "ab_group": "CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END"}
WINDOW = (dt.date(2024, 1, 3), dt.date(2024, 1, 29))


def contract_sql() -> tuple[str, list[str]]:
    """The masks' rules as one boolean column each, and their names in order."""
    money = ["price_rub", "quantity", "payment_method"]
    text = [c for c in EVENTS_21 if c not in (*money, "user_id", "event_ts", "event_date", "category_id", "duration_ms")]
    rules = {f"missing_{c}": f"{c} IS NULL" + (f" OR trim({c}) = ''" if c in text else "") for c in EVENTS_21 if c not in money}
    types, methods = (", ".join(f"'{x}'" for x in xs) for xs in (contract.EVENT_TYPES, contract.PAYMENT_METHODS))
    pays = "event_type IN ('purchase', 'refund')"
    rules |= {"unknown_event_type": f"event_type NOT IN ({types})", "other_day_than_time": "event_date <> CAST(event_ts AS DATE)",
              "outside_window": f"event_date < DATE '{WINDOW[0]}' OR event_date >= DATE '{WINDOW[1]}'", "foreign_currency": "currency <> 'RUB'",
              "bad_price": f"{pays} AND (price_rub IS NULL OR price_rub <= 0)", "bad_quantity": f"{pays} AND (quantity IS NULL OR quantity NOT BETWEEN 1 AND 4)",
              "bad_payment_method": f"{pays} AND (payment_method IS NULL OR payment_method NOT IN ({methods}))"}
    rules |= {f"unexpected_{c}": f"NOT {pays} AND {c} IS NOT NULL" for c in money}
    cols = ", ".join(f"{x} AS {c}" for c, x in EVENTS_21.items())
    listed = ", ".join(f"CASE WHEN {x} THEN '{n}' END" for n, x in rules.items())
    return f"""WITH ev AS (SELECT {cols} FROM events), k AS (SELECT list_filter([{listed}], lambda x: x IS NOT NULL) AS l FROM ev),
r AS MATERIALIZED (SELECT l, count(*) AS n FROM k GROUP BY l)""", list(rules)


CONTRACT_SQL, CONTRACT_NAMES = contract_sql()


def events_21(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*[f"{x} AS {c}" for c, x in EVENTS_21.items()])


@query("event_contract", "C-02 AGG-04 AGG-15", CONTRACT_SQL + f"""
SELECT rule, coalesce(sum(n) FILTER (WHERE list_contains(l, rule)), 0)::BIGINT AS failures, coalesce(sum(n) FILTER (WHERE l[1] = rule), 0)::BIGINT AS first_reason
FROM (SELECT unnest([{", ".join(f"'{n}'" for n in CONTRACT_NAMES)}]) AS rule), r GROUP BY rule""")
def event_contract(spark, sf_dir):
    """All rules of the event contract over 21 columns, counted from one number per row."""
    rules = contract.event_rules(*WINDOW)
    return contract.rule_counts(contract.mask_counts(events_21(spark, sf_dir), rules), rules)


@query("event_contract_pairs", "C-02 AGG-15", CONTRACT_SQL + """,
x AS (SELECT l, n, unnest(l) AS rule_a, generate_subscripts(l, 1) AS i FROM r), y AS (SELECT rule_a, i, n, unnest(l) AS rule_b, generate_subscripts(l, 1) AS j FROM x)
SELECT rule_a, rule_b, sum(n)::BIGINT AS rows FROM y WHERE i < j GROUP BY rule_a, rule_b""")
def event_contract_pairs(spark, sf_dir):
    """Rules that are broken together."""
    rules = contract.event_rules(*WINDOW)
    return contract.pair_counts(contract.mask_counts(events_21(spark, sf_dir), rules), rules)


@query("event_contract_split", "C-01 C-02 AGG-15", CONTRACT_SQL + " SELECT array_to_string(l, ',') AS reasons, n AS rows FROM r")
def event_contract_split(spark, sf_dir):
    """Accepted rows and the combinations of reasons of the others."""
    good, bad = contract.split_by_mask(events_21(spark, sf_dir), contract.event_rules(*WINDOW))
    every = bad.select(F.array_join("reasons", ",").alias("reasons")).unionByName(good.select(F.lit("").alias("reasons")))
    return every.groupBy("reasons").agg(F.count(F.lit(1)).alias("rows"))


@query("predicate_counts", "FLT-02 FLT-03 AGG-03", """
SELECT CAST(count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS BIGINT) AS blank,
       CAST(count(*) FILTER (WHERE n_chars BETWEEN 100 AND 1000) AS BIGINT) AS in_range,
       CAST(count(*) FILTER (WHERE n_chars < 100 OR n_chars > 1000) AS BIGINT) AS out_of_range,
       CAST(count(*) FILTER (WHERE lang IN ('en', 'de')) AS BIGINT) AS in_set,
       CAST(count(*) FILTER (WHERE lang NOT IN ('en', 'de')) AS BIGINT) AS not_in_set FROM documents""")
def predicate_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(
        count_where(is_blank("text")).alias("blank"), count_where(in_range("n_chars", 100, 1000)).alias("in_range"),
        count_where(out_of_range("n_chars", 100, 1000)).alias("out_of_range"),
        count_where(in_set("lang", ["en", "de"])).alias("in_set"),
        count_where(~in_set("lang", ["en", "de"])).alias("not_in_set"))


@query("unique_violations", "C-03 C-04 FLT-05", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def unique_violations(spark, sf_dir):
    return quality.unique_combination(table(spark, sf_dir, "lineitem"), KEY)


@query("key_counts", "C-03 AGG-05", """
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS keys
FROM lineitem""")
def key_count(spark, sf_dir):
    return key_counts(table(spark, sf_dir, "lineitem"), KEY)


@query("distinct_with_nulls", "AGG-05", """
SELECT (SELECT count(*) FROM (SELECT DISTINCT CASE WHEN lang <> 'en' THEN lang END, CASE WHEN source <> 'src1' THEN source END
                              FROM documents)) AS keys""")
def distinct_with_nulls(spark, sf_dir):
    """Composite distinct count in which a missing part is a value like any other."""
    lang = F.when(F.col("lang") != "en", F.col("lang"))
    source = F.when(F.col("source") != "src1", F.col("source"))
    d = table(spark, sf_dir, "documents").select(lang.alias("a"), source.alias("b"))
    return d.agg(distinct_keys("a", "b").alias("keys"))


@query("accepted_values", "C-04", """
SELECT o_orderpriority AS value, count(*) AS n_records FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY o_orderpriority""")
def accepted_values(spark, sf_dir):
    return quality.unexpected_values(table(spark, sf_dir, "orders"), "o_orderpriority",
                                     ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query("value_between", "C-04 FLT-03", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_discount FROM lineitem
WHERE l_discount < 0.01 OR l_discount > 0.09""")
def value_between(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    rule = quality.value_between("lineitem", "l_discount", 0.01, 0.09)
    return quality.violators(rule, {"lineitem": lines}).select("l_orderkey", "l_linenumber", "l_discount")


@query("orphans", "JOI-12 C-04", """
SELECT event_id, user_id FROM events WHERE user_id IS NOT NULL AND event_type <> 'error'
 AND user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def orphan_events(spark, sf_dir):
    """Events whose user has no pending order; errors carry no user and are not orphans."""
    user = F.when(F.col("event_type") != "error", F.col("user_id"))
    ev = table(spark, sf_dir, "events").select("event_id", user.alias("user_id"))
    pending = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return orphans(ev, ["user_id"], pending, ["o_custkey"])


@query("keys_in_and_out", "FLT-06", """
SELECT (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)) AS inside,
       (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)) AS outside""")
def keys_in_and_out(spark, sf_dir):
    keys = (table(spark, sf_dir, "customer").where("c_acctbal < 0")
            .select(F.col("c_custkey").alias("o_custkey")))
    o = table(spark, sf_dir, "orders")
    inside = in_keys(o, keys, ["o_custkey"]).agg(F.count(F.lit(1)).alias("inside"))
    outside = not_in_keys(o, keys, ["o_custkey"]).agg(F.count(F.lit(1)).alias("outside"))
    return inside.select("inside", outside.scalar().alias("outside"))


@query("rules_report", "C-04", """WITH u AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1),
r(rule, severity, failures) AS (
  SELECT 'not_null_lineitem_l_shipdate', 'error', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
  UNION ALL SELECT 'value_between_lineitem_l_discount', 'error', count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.05) FROM lineitem
  UNION ALL SELECT 'value_between_lineitem_l_tax', 'warn', count(*) FILTER (WHERE l_tax < 0 OR l_tax > 0.05) FROM lineitem
  UNION ALL SELECT 'unique_combination_lineitem_l_orderkey_l_linenumber', 'error', count(*) FROM u
  UNION ALL SELECT 'unique_orders_o_orderkey', 'error', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'accepted_values_lineitem_l_returnflag', 'warn', count(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag <> 'R'
  UNION ALL SELECT 'relationships_lineitem_l_orderkey', 'error', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
SELECT rule, severity, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail' ELSE 'warn' END AS status,
       CAST(failures AS BIGINT) AS failures FROM r""")
def rules_report(spark, sf_dir):
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rules = [quality.not_null("lineitem", "l_shipdate"), quality.value_between("lineitem", "l_discount", 0, 0.05),
             quality.value_between("lineitem", "l_tax", 0, 0.05, quality.WARN),
             quality.unique_key("lineitem", li, KEY), quality.unique("orders", o, "o_orderkey"),
             quality.accepted_values("lineitem", li, "l_returnflag", ["R"], quality.WARN),
             quality.relationships("lineitem", li, ["l_orderkey"], o, ["o_orderkey"])]
    return quality.run_rules({"lineitem": li, "orders": o}, rules)


MATCH_SQL = """
m AS (SELECT o_orderkey AS match_id, CAST(o_orderdate AS DATE) AS match_date, o_custkey AS home_team_id,
             CAST(floor(o_totalprice / 400000) AS BIGINT) AS score FROM orders)"""


@query("goals_not_exceed", "C-13 PRJ-04 JOI-02", f"""WITH {FACT_SQL}, {MATCH_SQL}, g AS (
  SELECT source_system, match_id, team_id, count(*) FILTER (WHERE is_goal) AS goals FROM fact
  WHERE NOT is_shootout GROUP BY ALL)
SELECT source_system, m.match_id, CAST(match_date AS VARCHAR) AS match_date, team_id,
       CASE WHEN team_id = home_team_id THEN 'home' ELSE 'away' END AS team_name,
       CAST(goals AS BIGINT) AS goals_from_shots,
       CASE WHEN team_id = home_team_id THEN score ELSE score + 1 END AS team_score
FROM g JOIN m ON g.match_id = m.match_id
WHERE goals > CASE WHEN team_id = home_team_id THEN score ELSE score + 1 END""")
def goals_not_exceed(spark, sf_dir):
    score = F.floor(F.col("o_totalprice") / 400000)
    matches = orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("match_key"), F.col("o_orderkey").alias("match_id"), F.col("day").alias("match_date"),
        F.col("o_custkey").alias("home_team_id"), F.lit("home").alias("home_team_name"),
        F.lit("away").alias("away_team_name"), score.alias("home_score"), (score + 1).alias("away_score"))
    shots = fact(spark, sf_dir).withColumn("match_key", F.col("match_id"))
    return quality.goals_not_exceed_score(shots, matches)


@query("measure_order", "C-13", f"""WITH {FACT_SQL}, t AS (
  SELECT team_id, CAST(match_date AS VARCHAR) AS match_date, count(*) AS shots,
         count(*) FILTER (WHERE is_on_target) AS shots_on_target,
         count(*) FILTER (WHERE is_goal) + count(*) FILTER (WHERE is_penalty) AS goals
  FROM fact GROUP BY team_id, match_date)
SELECT * FROM t WHERE NOT (goals <= shots_on_target AND shots_on_target <= shots)""")
def measure_order(spark, sf_dir):
    """A measure counted wrongly on purpose (penalties added to goals) must be found."""
    mart = fact(spark, sf_dir).groupBy("team_id", "match_date").agg(
        F.count(F.lit(1)).alias("shots"), count_where(F.col("is_on_target")).alias("shots_on_target"),
        (count_where(F.col("is_goal")) + count_where(F.col("is_penalty"))).alias("goals"))
    return quality.measure_order(mart)


@query("mart_reconciles", "C-13 JOI-08", f"""WITH {FACT_SQL}, f AS (
  SELECT * FROM fact WHERE source_system = 'main' AND NOT is_shootout AND match_date >= DATE '{WIDE[0]}' AND match_date < DATE '{WIDE[1]}')
SELECT count(*) AS fact_shots, CAST(count(*) FILTER (WHERE team_id <> 1) AS BIGINT) AS mart_shots,
       CAST(count(*) FILTER (WHERE is_goal) AS BIGINT) AS fact_goals,
       CAST(count(*) FILTER (WHERE is_goal AND team_id <> 1) AS BIGINT) AS mart_goals,
       CAST(round(sum(xg), 4) AS DOUBLE) AS fact_xg, CAST(round(sum(xg) FILTER (WHERE team_id <> 1), 4) AS DOUBLE) AS mart_xg
FROM f""")
def mart_reconciles(spark, sf_dir):
    """A mart that lost one team differs from the fact."""
    rows = fact_slice(spark, sf_dir, *WIDE).where("source_system = 'main'")
    mart = team_day(rows, "main", *WIDE, sort=False).where("team_id <> 1")
    return quality.mart_reconciles(rows.where("not is_shootout"), mart)


@query("valid_intervals", "C-13", """WITH v AS (
  SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS valid_from, max(CAST(o_orderdate AS DATE)) AS valid_to
  FROM orders GROUP BY o_custkey, o_orderpriority)
SELECT o_custkey, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM v
WHERE valid_from >= valid_to""")
def valid_intervals(spark, sf_dir):
    """Periods closed on their last day are empty when there was only one day."""
    v = (orders(spark, sf_dir).groupBy("o_custkey", "o_orderpriority")
         .agg(F.min("day").alias("valid_from"), F.max("day").alias("valid_to")).drop("o_orderpriority"))
    return quality.valid_intervals(v)


@query("grain_check", "C-16", f"""WITH {FACT_SQL}
SELECT count(*) AS groups, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS groups_with_several FROM (
  SELECT count(DISTINCT match_id) AS n FROM fact WHERE NOT is_shootout GROUP BY source_system, team_id, match_date)""")
def grain_check(spark, sf_dir):
    return quality.grain_check(fact(spark, sf_dir).where("not is_shootout"),
                               ["source_system", "team_id", "match_date"], "match_id")


@query("null_share", "AGG-14", """
SELECT CAST(count(*) FILTER (WHERE lang = 'fr') AS DOUBLE) / count(*) AS share FROM documents""")
def document_null_share(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.when(F.col("lang") != "fr", F.col("lang")).alias("lang"))
    return d.agg(null_share("lang").alias("share"))
