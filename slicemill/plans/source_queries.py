"""Readers and raw batches over files that Spark writes from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicemill.functions.aggregates import EMPTY, digest_parts
from slicemill.functions.columns import json_value
from slicemill.plans.registry import query, table
from slicemill.plans.standins import orders
from slicemill.session import work_path
from slicemill.sources import documents, files
from slicemill.sources.inline import dictionary

LINES_PER_FILE = 4_000_000  # far below the 2 GB that a hash of bytes can hold

ORDER_CSV = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
    T.StructField("price", T.DecimalType(12, 2)), T.StructField("order_ts", T.TimestampType()),
    T.StructField("day", T.DateType()), T.StructField("priority", T.StringType())])


def order_csv(spark, sf_dir, name, gz=False):
    """Orders as CSV files; the priority is blank for the lowest one."""
    path = work_path(spark, name)
    rows = orders(spark, sf_dir).select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_ts"), "day",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"))
    writer = rows.write.option("header", True).option("emptyValue", "").option("nullValue", "")
    (writer.option("compression", "gzip") if gz else writer).csv(path)
    return path


@query("typed_csv", "SRC-01", """
SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price,
       CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_day,
       CAST(count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS BIGINT) AS no_priority,
       CAST(count(*) AS BIGINT) AS ts_on_day FROM orders GROUP BY o_orderstatus""")
def typed_csv(spark, sf_dir):
    df = files.read_typed_csv(spark, order_csv(spark, sf_dir, "csv"), ORDER_CSV)
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"), F.max("day").alias("last_day"),
        F.count_if(F.col("priority").isNull()).alias("no_priority"),
        F.count_if(F.to_date("order_ts") == F.col("day")).alias("ts_on_day"))


@query("csv_row_numbers", "SRC-05", "SELECT count(*) AS rows, true AS numbered FROM orders")
def csv_row_numbers(spark, sf_dir):
    """Row numbers of gzip files run from 1 to the row count of each file without a gap."""
    scan = files.read_typed_csv(spark, order_csv(spark, sf_dir, "gz", gz=True), ORDER_CSV)
    per_file = files.number_rows(scan, "row_no", "file").groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_no").alias("lo"), F.max("row_no").alias("hi"),
        F.count_distinct("row_no").alias("numbers"))
    gapless = (F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("numbers") == F.col("n"))
    return per_file.agg(F.sum("n").alias("rows"), F.bool_and(gapless).alias("numbered"))


@query("csv_row_order", "SRC-05 SRC-06", """
SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS BIGINT) AS row_no FROM orders""")
def csv_row_order(spark, sf_dir):
    """Order and numbers of lines by value: gzip files of sorted orders, one for each status and priority, read in one scan that
    stores the places; the numbers come from what was stored."""
    path, kept = work_path(spark, "sorted-csv"), work_path(spark, "placed")
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey")
    (rows.repartition("o_orderstatus", "o_orderpriority").sortWithinPartitions("o_orderstatus", "o_orderpriority", "o_orderkey")
     .write.partitionBy("o_orderstatus", "o_orderpriority").option("header", True).option("compression", "gzip").csv(path))
    scan = files.read_typed_csv(spark, f"{path}/*/*", T.StructType([T.StructField("o_orderkey", T.LongType())]))
    files.place_rows(scan).write.parquet(kept)
    stored = spark.read.parquet(kept)
    return files.dense_numbers(stored, files.block_offsets(stored), "row_no").select("o_orderkey", "row_no")


def event_lines(spark, sf_dir, name):
    """events as JSON-line envelopes, one folder per type, with a blank line after every error event."""
    path = work_path(spark, name)
    tag = F.when(F.col("event_type") != "signup", F.struct(F.col("event_id").alias("event_id"), F.lit("demo").alias("test_case")))
    record = F.struct("event_id", "user_id", "event_type", F.col("value").alias("value"),
                      F.regexp_extract("props", r"(\d+)", 1).cast("bigint").alias("k"))
    line = F.to_json(F.struct(tag.alias("_source"), record.alias("record")))
    blank = F.when(F.col("event_type") == "error", F.concat(line, F.lit("\n  "))).otherwise(line)
    (table(spark, sf_dir, "events").select(blank.alias("value"), F.col("event_type").alias("kind"))
     .write.partitionBy("kind").text(path))
    return path


def event_files(spark, path):
    return files.file_fingerprints(spark, f"{path}/*")


@query("envelope_lines", "SRC-06 SCA-04", """
SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k,
       CASE WHEN event_type = 'signup' THEN 0 ELSE count(*) END AS with_envelope, true AS numbered
FROM events GROUP BY event_type""")
def envelope_lines(spark, sf_dir):
    """Non-blank lines per type with their payload, envelope and gapless numbering per file."""
    docs = files.read_envelopes(spark, f"{event_lines(spark, sf_dir, 'envelopes')}/*")
    rows = docs.select("file", "line_no", json_value("payload", "$.event_type").alias("event_type"),
                       json_value("payload", "$.k", "bigint").alias("k"),
                       json_value("envelope", "$.event_id", "bigint").alias("tagged"))
    per_file = rows.groupBy("event_type", "file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"), F.count("tagged").alias("with_envelope"),
        F.min("line_no").alias("lo"), F.max("line_no").alias("hi"), F.count_distinct("line_no").alias("numbers"))
    gapless = (F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("numbers") == F.col("n"))
    return per_file.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("k").alias("k"),
                                              F.sum("with_envelope").alias("with_envelope"),
                                              F.bool_and(gapless).alias("numbered"))


@query("source_manifest", "SRC-17", """
SELECT event_type AS kind, count(*) AS events_total, true AS hashed FROM events GROUP BY event_type""")
def source_manifest(spark, sf_dir):
    m = files.source_manifest(spark, f"{event_lines(spark, sf_dir, 'manifest')}/*")
    kind = F.regexp_extract("file", r"kind=(\w+)", 1)
    return m.groupBy(kind.alias("kind")).agg(F.sum("events_total").alias("events_total"),
                                             F.bool_and(F.length("sha256") == 64).alias("hashed"))


@query("fingerprint_by_lines", "SRC-17 SRC-07", """
SELECT event_type AS kind, true AS by_lines, count(*) AS row_count FROM events GROUP BY event_type""")
def fingerprint_by_lines(spark, sf_dir):
    """Files too large for one task get a digest of their numbered lines instead of a byte hash."""
    path = event_lines(spark, sf_dir, "large")
    f = files.file_fingerprints(spark, f"{path}/*", method="lines")
    return f.groupBy(F.regexp_extract("file", r"kind=(\w+)", 1).alias("kind")).agg(
        F.bool_and(F.col("sha256").startswith("lines:")).alias("by_lines"), F.sum("row_count").alias("row_count"))


@query("fingerprint_order", "SRC-17 SRC-07", "SELECT 2 AS files, 2 AS hashes, 1 AS contents, count(*) AS rows FROM events")
def fingerprint_order(spark, sf_dir):
    """The same lines in two orders have different hashes by either method. Each order is a folder of range-partitioned
    files; a folder's digest is that of its files' hashes and their places, and ``files`` counts the folders."""
    rows = table(spark, sf_dir, "events").select(F.concat_ws(" ", "event_id", "event_type").alias("value"), "event_id")
    path = work_path(spark, "orders-of-lines")
    for name, order in (("up", F.asc), ("down", F.desc)):
        order = [order("event_id"), order("value")]
        ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("value")
        ordered.write.option("maxRecordsPerFile", LINES_PER_FILE).text(f"{path}/{name}")
    place = [F.regexp_extract("file", pattern, 1).cast("long") for pattern in (r"/part-(\d+)", r"-c(\d+)\.txt$")]
    folder = F.regexp_extract("file", r"/(up|down)/[^/]*$", 1)
    digests = {}
    for method in ("bytes", "lines"):
        found = files.file_fingerprints(spark, f"{path}/*/*.txt", method=method)
        found = found.select(folder.alias("folder"), place[0].alias("part"), place[1].alias("piece"), "sha256", "row_count")
        n, hi, lo = digest_parts(["part", "piece", "sha256"])
        per = found.groupBy("folder").agg(n, hi, lo, F.sum("row_count").alias("row_count"))
        digests[method] = per.select("folder", "row_count", F.concat_ws(":", "n", "hi", "lo").alias(method))
    both = digests["bytes"].join(digests["lines"].drop("row_count"), "folder")
    return both.agg(F.count(F.lit(1)).alias("files"), F.least(F.count_distinct("bytes"), F.count_distinct("lines")).alias("hashes"),
                    F.count_distinct("row_count").alias("contents"), F.max("row_count").alias("rows"))


def batch_inputs(spark, sf_dir, name):
    """Manifest, registry and files for the event batches of one run.

    click and view were loaded before with the same content, purchase with other content, and
    ``retired`` is not in the manifest any more.
    """
    path = event_lines(spark, sf_dir, name)
    found = event_files(spark, path).select(
        F.regexp_extract("file", r"kind=(\w+)", 1).alias("kind"), "sha256", "row_count")
    per_kind = found.groupBy("kind").agg(F.max("sha256").alias("file_sha256"), F.sum("row_count").alias("row_count"))
    entity = F.when(F.col("kind") == "purchase", "matches").otherwise("shots")
    listed = per_kind.select(F.concat(F.col("kind"), F.lit(".jsonl")).alias("file_path"), "file_sha256", "row_count",
                             entity.alias("entity"), F.lit("main").alias("source_system"), "kind")
    kinds = ["click", "error", "purchase", "signup", "view"]
    seq = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind")).cast("int")
    manifest = listed.select("file_path", "entity", "source_system", seq.alias("batch_seq"), F.lit("again").alias("scenario"))
    old = listed.where(F.col("kind").isin("click", "view", "purchase")).select(
        seq.cast("bigint").alias("batch_id"), F.lit(99).alias("batch_seq"), F.lit("first").alias("scenario"),
        "source_system", "entity", "file_path",
        F.when(F.col("kind") == "purchase", F.lit(EMPTY)).otherwise(F.col("file_sha256")).alias("file_sha256"),
        "row_count", F.lit("run0").alias("run_id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("loaded_at"))
    retired = old.where("batch_id = 1").withColumns({
        "batch_id": F.lit(40).cast("bigint"), "file_path": F.lit("retired.jsonl"), "file_sha256": F.lit("00")})
    return manifest, old.unionByName(retired), listed.select("file_path", "file_sha256", "row_count")


@query("raw_batches_plan", "SRC-07", """WITH t AS (SELECT event_type AS k, count(*) AS n FROM events GROUP BY event_type)
SELECT k || '.jsonl' AS file_path, CASE WHEN k IN ('click', 'view') THEN 'skip' ELSE 'load' END AS action, n AS row_count FROM t
UNION ALL SELECT 'purchase.jsonl', 'drop', n FROM t WHERE k = 'purchase'
UNION ALL SELECT 'retired.jsonl', 'drop', n FROM t WHERE k = 'click'""")
def raw_batches_plan(spark, sf_dir):
    plan = files.plan_batches(*batch_inputs(spark, sf_dir, "plan"))
    return plan.select("file_path", "action", "row_count")


@query("raw_batches_applied", "SRC-07", """WITH t AS (SELECT event_type AS k, count(*) AS n FROM events GROUP BY event_type)
SELECT k || '.jsonl' AS file_path, CAST(CASE k WHEN 'click' THEN 1 WHEN 'view' THEN 5 WHEN 'error' THEN 42
         WHEN 'purchase' THEN 43 ELSE 44 END AS BIGINT) AS batch_id,
       CAST(CASE k WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS BIGINT) AS batch_seq,
       'again' AS scenario, CASE WHEN k IN ('click', 'view') THEN 'run0' ELSE 'run1' END AS run_id, n AS row_count FROM t""")
def raw_batches_applied(spark, sf_dir):
    manifest, registry, found = batch_inputs(spark, sf_dir, "apply")
    after = files.apply_batches(files.plan_batches(manifest, registry, found), registry, "run1")
    return after.select("file_path", "batch_id", "batch_seq", "scenario", "run_id", "row_count")


@query("raw_summary", "SRC-08 Q-21 SET-01", """
SELECT entity, source_system, count(*) AS rows FROM (
  SELECT 'matches' AS entity, o_orderpriority AS source_system FROM orders
  UNION ALL SELECT 'shots', l_returnflag FROM lineitem) GROUP BY entity, source_system""")
def raw_summary(spark, sf_dir):
    return files.raw_summary(table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "source_system"),
                             table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "source_system"))


@query("parallel_arrays", "SRC-09 SCA-06", """WITH w AS (
  SELECT doc_id, lang, unnest(string_split(text, ' ')) AS anchor FROM documents)
SELECT doc_id, count(*) AS n, CAST(CASE WHEN lang <> 'fr' THEN sum(length(anchor)) END AS BIGINT) AS letters,
       CAST(CASE WHEN lang = 'fr' THEN count(*) ELSE 0 END AS BIGINT) AS missing FROM w GROUP BY doc_id, lang""")
def parallel_arrays(spark, sf_dir):
    """Words and their lengths as parallel arrays; the lengths are absent for one language."""
    words = F.split("text", " ", -1)
    lengths = F.when(F.col("lang") != "fr", F.transform(words, lambda x: F.length(x)))
    docs = table(spark, sf_dir, "documents").select("doc_id", words.alias("words"), lengths.alias("sizes"))
    flat = documents.flatten_parallel_arrays(docs, F.col("words"), {"letters": F.col("sizes")})
    return flat.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("letters").alias("letters"),
                                      F.count_if(F.col("letters").isNull()).alias("missing"))


def match_documents(spark, sf_dir):
    """Orders as nested match documents."""
    o = orders(spark, sf_dir)
    team = F.col("o_custkey")
    return o.select(
        F.col("o_orderkey").alias("match_id"), F.col("day").cast("string").alias("match_date"),
        F.struct(F.lit(43).alias("competition_id"), F.lit("Cup").alias("competition_name")).alias("competition"),
        F.struct(F.year("day").alias("season_id"), F.year("day").cast("string").alias("season_name")).alias("season"),
        F.struct(F.when(F.col("o_orderstatus") == "P", "Group Stage").otherwise("Final").alias("name")).alias("competition_stage"),
        F.struct(team.alias("home_team_id"), F.lit("home").alias("home_team_name")).alias("home_team"),
        F.struct((team + 1).alias("away_team_id"), F.lit("away").alias("away_team_name")).alias("away_team"),
        F.lit(1).alias("home_score"), F.lit(0).alias("away_score"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("last_updated"))


@query("flatten_matches", "SRC-10", """
SELECT o_orderkey AS match_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS match_date, CAST(year(o_orderdate) AS VARCHAR) AS season_name,
       o_custkey AS home_team_id, o_custkey + 1 AS away_team_id FROM orders WHERE o_orderstatus <> 'P'""")
def flatten_matches(spark, sf_dir):
    """Match documents written as JSON, read by explicit schema and flattened without the group stage."""
    docs = match_documents(spark, sf_dir)
    path = work_path(spark, "match-docs")
    docs.write.json(path)
    read = spark.read.schema(docs.schema).option("mode", "FAILFAST").json(path)
    return documents.flatten_matches(read).select("match_id", "match_date", "season_name", "home_team_id", "away_team_id")


@query("extract_shots", "SRC-11", """
SELECT 'main' AS source_system, l_orderkey AS match_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS match_date,
       CAST(l_linenumber AS BIGINT) AS index, l_suppkey AS team_id, CASE l_returnflag WHEN 'R' THEN 'Goal' ELSE 'Saved' END AS outcome,
       CAST(CASE WHEN l_tax < 0.07 THEN l_discount END AS DOUBLE) AS xg
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F' AND o_orderstatus <> 'P'""")
def extract_shots(spark, sf_dir):
    """Shot events among all events, dated by their match; some have no xG."""
    xg = F.when(F.col("l_tax") < 0.07, F.col("l_discount"))
    outcome = F.when(F.col("l_returnflag") == "R", "Goal").otherwise("Saved")
    events = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"), F.upper(F.md5(F.col("l_partkey").cast("string"))).alias("id"),
        F.col("l_linenumber").alias("index"),
        F.struct(F.when(F.col("l_linestatus") == "F", "Shot").otherwise("Pass").alias("name")).alias("type"),
        F.struct(F.col("l_suppkey").alias("id"), F.lit("t").alias("name")).alias("team"),
        F.struct(F.col("l_partkey").alias("id"), F.lit("p").alias("name")).alias("player"),
        F.lit(1).alias("period"), F.lit(0).alias("minute"), F.lit(0).alias("second"),
        F.struct(F.struct(F.lit("Open Play").alias("name")).alias("type"), F.struct(outcome.alias("name")).alias("outcome"),
                 F.struct(F.lit("Head").alias("name")).alias("body_part"), xg.alias("statsbomb_xg")).alias("shot"))
    matches = documents.flatten_matches(match_documents(spark, sf_dir))
    out = documents.extract_shots(events, matches, "main")
    return out.select("source_system", "match_id", "match_date", "index", "team_id", "outcome", "xg")


@query("dictionary_view", "SRC-13 JOI-06", """
SELECT word, count(*) AS n FROM orders JOIN (VALUES ('F', 'final'), ('O', 'open')) AS d(code, word) ON o_orderstatus = code
GROUP BY word""")
def dictionary_view(spark, sf_dir):
    """An inline dictionary replaced under its name and joined from SQL."""
    dictionary(spark, [("F", "wrong")], "code string, word string", "slicemill_status")
    dictionary(spark, [("F", "final"), ("O", "open")], "code string, word string", "slicemill_status")
    table(spark, sf_dir, "orders").createOrReplaceTempView("slicemill_status_orders")
    return spark.sql("SELECT word, count(*) AS n FROM slicemill_status_orders JOIN slicemill_status "
                     "ON o_orderstatus = code GROUP BY word")


@query("map_lookup", "SCA-05", """
SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k, count(*) AS absent FROM events GROUP BY event_type""")
def map_lookup(spark, sf_dir):
    props = F.from_json("props", "map<string,string>")
    m = table(spark, sf_dir, "events").select("event_type", props.alias("summary"))
    return m.groupBy("event_type").agg(F.sum(F.col("summary")["k"].cast("bigint")).alias("k"),
                                       F.count_if(F.col("summary")["total-records"].isNull()).alias("absent"))
