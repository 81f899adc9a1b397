"""Versions, slowly changing dimensions, validity joins, keys, JSON and unnesting."""

from __future__ import annotations

from pyspark.sql import functions as F

from slicemill.functions.columns import json_value, payload_hash, row_text, surrogate_key
from slicemill.operators import history, sweep
from slicemill.operators.relations import explode_keep, with_scalar
from slicemill.plans.registry import query, table
from slicemill.plans.standins import orders
from slicemill.session import work_path
from slicemill.sinks.dimension import ScdDimension

LINE_ORDER = ["l_shipdate desc", "l_partkey desc", "l_suppkey desc", "l_extendedprice desc", "l_quantity desc",
              "l_discount desc", "l_tax desc"]
LINE_ORDER_SQL = ("l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, "
                  "l_discount DESC, l_tax DESC")


@query("latest_version", "C-05 WIN-01 WIN-02 WIN-03", f"""WITH h AS (
  SELECT *, md5(concat_ws('|', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), l_returnflag)) AS payload_hash FROM lineitem),
d AS (SELECT *, dense_rank() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate ORDER BY payload_hash) AS hr FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn,
        count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS raw_copies,
        max(hr) OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate) AS variants_same_version FROM d)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, payload_hash,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day, raw_copies, variants_same_version
FROM r WHERE rn = 1""")
def latest_version(spark, sf_dir):
    text = row_text(F.col("l_quantity").cast("bigint"), "l_returnflag")
    hashed = table(spark, sf_dir, "lineitem").withColumn("payload_hash", F.md5(text))
    out = history.latest_version(hashed, ["l_orderkey", "l_linenumber"], LINE_ORDER, "payload_hash")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "payload_hash",
                      F.to_date("l_shipdate").alias("ship_day"), "raw_copies", "variants_same_version")


@query("payload_variants", "WIN-03 C-05", """WITH v AS (
  SELECT o_custkey, o_orderpriority, count(DISTINCT o_orderstatus) AS variants, count(*) AS copies
  FROM orders GROUP BY o_custkey, o_orderpriority)
SELECT o_custkey, CAST(sum(copies) AS BIGINT) AS raw_copies, max_by(variants, o_orderpriority) AS variants_same_version
FROM v GROUP BY o_custkey HAVING max_by(variants, o_orderpriority) > 1""")
def payload_variants(spark, sf_dir):
    """Customers whose newest version (priority) came with several contents (status)."""
    o = table(spark, sf_dir, "orders").withColumn("payload_hash", F.md5("o_orderstatus"))
    out = history.latest_version(o, ["o_custkey"], ["o_orderpriority desc", "o_orderkey desc"], "payload_hash")
    return out.where("variants_same_version > 1").select("o_custkey", "raw_copies", "variants_same_version")


@query("scd1_names", "WIN-04", """
SELECT o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey ASC) AS rn FROM orders) WHERE rn = 1""")
def scd1_names(spark, sf_dir):
    return history.latest_attr(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderpriority"],
                               ["o_orderdate desc", "o_orderkey asc"])


@query("last_wins", "SRC-12", f"""
SELECT l_orderkey, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey ORDER BY l_linenumber DESC, {LINE_ORDER_SQL}) AS rn FROM lineitem) WHERE rn = 1""")
def last_wins(spark, sf_dir):
    order = ["l_linenumber", *[o.split()[0] for o in LINE_ORDER]]
    out = history.last_wins(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order)
    return out.select("l_orderkey", "l_partkey", "l_suppkey")


def versions_sql(attr: str) -> str:
    return f"""
v AS (SELECT o_custkey, {attr} AS attr, min(CAST(o_orderdate AS DATE)) AS valid_from,
             max(CAST(o_orderdate AS DATE)) AS last_observed_on FROM orders GROUP BY o_custkey, {attr}),
versions AS (
  SELECT v.o_custkey, v.attr, v.valid_from, v.last_observed_on,
         coalesce((SELECT min(o.valid_from) FROM v o WHERE o.o_custkey = v.o_custkey AND o.attr IS DISTINCT FROM v.attr
                   AND o.valid_from > v.last_observed_on), DATE '9999-12-31') AS valid_to FROM v)"""


SELECT_VERSIONS = """SELECT o_custkey, attr, CAST(valid_from AS VARCHAR) AS valid_from,
  CAST(last_observed_on AS VARCHAR) AS last_observed_on, CAST(valid_to AS VARCHAR) AS valid_to FROM versions"""


def versions(spark, sf_dir, attr):
    """Customer history over an attribute of the orders (overlapping when values alternate)."""
    obs = orders(spark, sf_dir).withColumn("attr", attr)
    return history.scd2_from_observations(obs, ["o_custkey"], "attr", "day")


def dimension(spark, sf_dir, attr):
    """The history as a table of its own, as facts meet it in a warehouse."""
    path = work_path(spark, "dimension")
    versions(spark, sf_dir, attr).write.parquet(path)
    return spark.read.parquet(path)


@query("scd2_versions", "C-08 JOI-09", f"WITH {versions_sql('o_orderpriority')} {SELECT_VERSIONS}")
def scd2_versions(spark, sf_dir):
    return versions(spark, sf_dir, F.col("o_orderpriority"))


@query("scd2_by_year", "C-08", f"WITH {versions_sql('CAST(year(o_orderdate) AS VARCHAR)')} {SELECT_VERSIONS}")
def scd2_by_year(spark, sf_dir):
    return versions(spark, sf_dir, F.year("day").cast("string"))


# late first, then the newest, then what lies between
DELIVERIES = ("day < DATE '1994-01-01'", "day >= DATE '1997-01-01'", "day >= DATE '1994-01-01' AND day < DATE '1997-01-01'")


def delivered(spark, sf_dir, order):
    """A stored customer dimension after deliveries of the orders in some order of their days."""
    dim = ScdDimension(spark, work_path(spark, "scd2"), ["o_custkey"], "attr", "day")
    obs = orders(spark, sf_dir).withColumn("attr", F.col("o_orderpriority"))
    done = None
    for number in order:
        done = dim.deliver(obs.where(DELIVERIES[number]))
    return dim, done


@query("scd2_incremental", "C-08 C-09 JOI-09", f"WITH {versions_sql('o_orderpriority')} {SELECT_VERSIONS}")
def scd2_incremental(spark, sf_dir):
    """Three deliveries, the second of them newer than the third, one of them twice: what a build from all orders gives."""
    return delivered(spark, sf_dir, (1, 0, 2, 0))[0].read()


@query("scd2_changed_facts", "C-08 C-09 JOI-04", f"""WITH {versions_sql('o_orderpriority')},
part AS (SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1994-01-01' OR CAST(o_orderdate AS DATE) >= DATE '1997-01-01'),
v0 AS (SELECT o_custkey, o_orderpriority AS attr, min(CAST(o_orderdate AS DATE)) AS valid_from,
              max(CAST(o_orderdate AS DATE)) AS last_observed_on FROM part GROUP BY o_custkey, o_orderpriority),
was AS (SELECT v0.*, coalesce((SELECT min(o.valid_from) FROM v0 o WHERE o.o_custkey = v0.o_custkey AND o.valid_from > v0.last_observed_on),
               DATE '9999-12-31') AS valid_to FROM v0),
touched AS (SELECT DISTINCT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1994-01-01' AND CAST(o_orderdate AS DATE) < DATE '1997-01-01'),
f AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders JOIN touched USING (o_custkey)),
a AS (SELECT o_orderkey, x.attr, x.valid_from FROM f LEFT JOIN versions x ON x.o_custkey = f.o_custkey AND day >= x.valid_from AND day < x.valid_to),
b AS (SELECT o_orderkey, x.attr, x.valid_from FROM f LEFT JOIN was x ON x.o_custkey = f.o_custkey AND day >= x.valid_from AND day < x.valid_to)
SELECT o_orderkey, attr, CAST(valid_from AS VARCHAR) AS valid_from, extra FROM (
  SELECT *, CAST(1 AS BIGINT) AS extra FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
  UNION ALL SELECT *, CAST(-1 AS BIGINT) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))""")
def scd2_changed_facts(spark, sf_dir):
    """Orders whose valid versions changed with the last delivery: those lost and those gained."""
    dim, last = delivered(spark, sf_dir, (0, 1, 2))
    return dim.changed_facts(last, orders(spark, sf_dir), ["o_orderkey"], "day", ["attr", "valid_from"])


@query("next_version_start", "JOI-09", f"""WITH {versions_sql('o_orderpriority')}
SELECT o_custkey, CAST(last_observed_on AS VARCHAR) AS last_seen,
       CAST(min(CASE WHEN valid_to < DATE '9999-12-31' THEN valid_to END) AS VARCHAR) AS next_start
FROM versions GROUP BY o_custkey, last_observed_on""")
def next_version_start(spark, sf_dir):
    seen = (orders(spark, sf_dir).groupBy("o_custkey", "o_orderpriority")
            .agg(F.min("day").alias("first_seen"), F.max("day").alias("last_seen")))
    nxt = history.next_start(seen, ["o_custkey"])
    return seen.select("o_custkey", "last_seen").distinct().join(nxt, ["o_custkey", "last_seen"])


OVERLAPS_SQL = f"""WITH {versions_sql('o_orderpriority')}
SELECT a.o_custkey, a.attr AS attr_a, CAST(a.valid_from AS VARCHAR) AS valid_from_a, CAST(a.valid_to AS VARCHAR) AS valid_to_a,
       b.attr AS attr_b, CAST(b.valid_from AS VARCHAR) AS valid_from_b, CAST(b.valid_to AS VARCHAR) AS valid_to_b
FROM versions a JOIN versions b ON a.o_custkey = b.o_custkey AND a.attr < b.attr
 AND a.valid_from < b.valid_to AND b.valid_from < a.valid_to"""


@query("scd2_overlaps", "JOI-05 C-13", OVERLAPS_SQL)
def scd2_overlaps(spark, sf_dir):
    return history.overlapping_versions(dimension(spark, sf_dir, F.col("o_orderpriority")), ["o_custkey"], "attr")


@query("sweep_overlaps", "JOI-05 C-13", OVERLAPS_SQL)
def sweep_overlaps(spark, sf_dir):
    """The overlaps of ``scd2_overlaps`` by a sweep line."""
    return sweep.sweep_overlaps(dimension(spark, sf_dir, F.col("o_orderpriority")), ["o_custkey"], "attr")


@query("asof_join_counts", "JOI-04", f"""WITH {versions_sql('o_orderpriority')}
SELECT o_orderkey, count(versions.attr) AS valid_versions, min(versions.attr) AS first_attr
FROM orders LEFT JOIN versions ON versions.o_custkey = orders.o_custkey
 AND CAST(o_orderdate AS DATE) >= valid_from AND CAST(o_orderdate AS DATE) < valid_to GROUP BY o_orderkey""")
def asof_join_counts(spark, sf_dir):
    dim = dimension(spark, sf_dir, F.col("o_orderpriority"))
    joined = history.join_valid_at(orders(spark, sf_dir), dim, ["o_custkey"], "day", ["attr"])
    return joined.groupBy("o_orderkey").agg(F.count("attr").alias("valid_versions"), F.min("attr").alias("first_attr"))


ASOF_ROWS_SQL = f"""WITH {versions_sql('CAST(year(o_orderdate) AS VARCHAR)')}
SELECT e.event_id, v.attr FROM events e LEFT JOIN versions v ON v.o_custkey = e.user_id
 AND CAST(e.ts AS DATE) - 8400 + CAST(e.event_id % 3000 AS INTEGER) >= v.valid_from
 AND CAST(e.ts AS DATE) - 8400 + CAST(e.event_id % 3000 AS INTEGER) < v.valid_to"""


def moved_events(spark, sf_dir):
    """Events of known and unknown customers, moved into the years of the versions and before."""
    day = F.date_add(F.date_sub(F.to_date("ts"), 8400), (F.col("event_id") % 3000).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("o_custkey"), day.alias("day"))


@query("asof_join_rows", "JOI-04", ASOF_ROWS_SQL)
def asof_join_rows(spark, sf_dir):
    dim = dimension(spark, sf_dir, F.year("day").cast("string"))
    return history.join_valid_at(moved_events(spark, sf_dir), dim, ["o_custkey"], "day", ["attr"]).select("event_id", "attr")


@query("sweep_join_rows", "JOI-04", ASOF_ROWS_SQL)
def sweep_join_rows(spark, sf_dir):
    """The rows of ``asof_join_rows`` by a sweep line."""
    dim = dimension(spark, sf_dir, F.year("day").cast("string"))
    return sweep.sweep_join(moved_events(spark, sf_dir), dim, ["o_custkey"], "day", ["attr"]).select("event_id", "attr")


@query("versions_per_event", "C-13 AGG-08", f"""WITH {versions_sql('o_orderpriority')}
SELECT o_orderkey, count(v.attr) AS versions_on_event_date,
       string_agg(v.attr, ' | ' ORDER BY v.valid_from, v.attr) AS managers
FROM orders LEFT JOIN versions v ON v.o_custkey = orders.o_custkey
 AND CAST(o_orderdate AS DATE) >= valid_from AND CAST(o_orderdate AS DATE) < valid_to
GROUP BY o_orderkey HAVING count(v.attr) <> 1""")
def versions_per_event(spark, sf_dir):
    dim = dimension(spark, sf_dir, F.col("o_orderpriority")).withColumn("label", F.col("attr"))
    out = history.versions_per_event(orders(spark, sf_dir), dim, ["o_custkey"], "day", "attr", "label")
    return out.select("o_orderkey", "versions_on_event_date", "managers")


@query("surrogate_keys", "C-07 SCA-01 SCA-02", """
SELECT o_orderkey, md5('main' || '|' || coalesce(CAST(o_orderkey AS VARCHAR), '∅') || '|' ||
       coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '∅') || '|' ||
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS order_key FROM orders""")
def surrogate_keys(spark, sf_dir):
    """Keys over text, number, date and a part that is NULL for some rows."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return orders(spark, sf_dir).select("o_orderkey", surrogate_key(F.lit("main"), "o_orderkey", status, "day")
                                        .alias("order_key"))


@query("sha_hashes", "SCA-02", "SELECT doc_id, sha256(text) AS sha, md5(text) AS md FROM documents")
def sha_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.md5("text").alias("md"))


@query("json_props", "SCA-04 SCA-10", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.none.x') AS absent FROM events""")
def json_props(spark, sf_dir):
    doc = table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("doc"))
    return doc.select("event_id", json_value("doc", "$.k", "bigint").alias("k"),
                      json_value("doc", "$.k").alias("k_text"), json_value("doc", "$.none.x").alias("absent"))


@query("canonical_json", "SCA-03", """
SELECT event_type, count(*) AS n, count(DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT) || '/' || event_type) AS contents
FROM events GROUP BY event_type""")
def canonical_json(spark, sf_dir):
    """The same content spelt with other key order and spacing hashes alike."""
    k = F.regexp_extract("props", r"(\d+)", 1)
    spelt = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"k": '), k, F.lit(', "t":"'), "event_type", F.lit('"}'))
                   ).otherwise(F.concat(F.lit('{ "t" : "'), "event_type", F.lit('","k":'), k, F.lit("}")))
    hashed = table(spark, sf_dir, "events").select("event_type", payload_hash(F.parse_json(spelt)).alias("h"))
    return hashed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("h").alias("contents"))


@query("managers_unnest", "JOI-11 C-06 SET-01", """WITH s AS (
  SELECT o_orderkey, 'home' AS side, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END AS n FROM orders
  UNION ALL SELECT o_orderkey, 'away', CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END FROM orders),
e AS (SELECT o_orderkey, side, n, unnest(CASE WHEN n = 0 THEN [NULL] ELSE generate_series(1, n) END) AS manager_id FROM s)
SELECT side, CAST(manager_id AS BIGINT) AS manager_id, count(*) AS n FROM e GROUP BY side, manager_id""")
def managers_unnest(spark, sf_dir):
    """Two sides per order with zero, one or two managers; absent and empty lists keep their row."""
    def people(n):
        return F.transform(F.slice(F.array(F.lit(1), F.lit(2)), 1, n), lambda i: F.struct(
            i.cast("bigint").alias("id"), F.lit("m").alias("name")))

    home = people(F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 1).otherwise(0))
    away = F.when(F.col("o_orderpriority") != "5-LOW", people(F.lit(1)))
    matches = orders(spark, sf_dir).select(
        F.lit("main").alias("source_system"), F.col("o_orderkey").alias("match_id"), F.col("day").alias("match_date"),
        F.lit(1).cast("bigint").alias("home_team_id"), F.lit("home").alias("home_team_name"),
        F.lit(2).cast("bigint").alias("away_team_id"), F.lit("away").alias("away_team_name"),
        home.alias("home_managers"), away.alias("away_managers"))
    return (history.observations(matches).groupBy(F.col("team_name").alias("side"), "manager_id")
            .agg(F.count(F.lit(1)).alias("n")))


@query("explode_keep_words", "JOI-11 SCA-01", """
SELECT conv_id, turn, w AS word, count(*) AS n FROM (
  SELECT conv_id, turn, unnest(CASE WHEN len(f) = 0 THEN [NULL] ELSE f END) AS w FROM (
    SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda x: x <> '') AS f FROM conversations))
GROUP BY ALL""")
def explode_keep_words(spark, sf_dir):
    """Words of every turn; a turn without any keeps one row."""
    words = F.filter(F.split("text", " ", -1), lambda x: x != "")
    rows = explode_keep(table(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("w")), "w", "word")
    return rows.groupBy("conv_id", "turn", "word").agg(F.count(F.lit(1)).alias("n"))


@query("scalar_subquery", "JOI-10", """
SELECT o_orderstatus, count(*) AS n, CAST(max(top_price) AS DOUBLE) AS top_price FROM orders,
  (SELECT max(CAST(o_totalprice AS DECIMAL(12,2))) AS top_price FROM orders)
WHERE CAST(o_totalprice AS DECIMAL(12,2)) * 2 > top_price GROUP BY o_orderstatus""")
def scalar_subquery(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(12,2)"))
    tall = with_scalar(o, o.agg(F.max("price").alias("top_price"))).where(F.col("price") * 2 > F.col("top_price"))
    return tall.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("top_price").alias("top_price"))
