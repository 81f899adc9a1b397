"""Readers, writers, layouts, snapshots and publication."""

import datetime as dt
import gzip
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicemill.plans import source_queries
from slicemill.sinks import datasets
from slicemill.sinks.versioned import PublicationRefused, PublishedMart
from slicemill.sources import documents, files
from slicemill.sources.inline import dictionary, values

SCHEMA = (T.StructType().add("city", "string").add("ts", "timestamp").add("d", "date")
          .add("x", T.DecimalType(5, 2)).add("n", "integer"))


def csv(tmp_path, name, text, packed=False):
    path = tmp_path / name
    path.write_bytes(gzip.compress(text.encode()) if packed else text.encode())
    return str(path)


def test_typed_csv(spark, tmp_path, rows):
    text = "city,ts,d,x,n\nА,2023-01-01 05:00:00,2023-01-01,1.25,1\n,2023-01-01 06:00:00,2023-01-01,,\n"
    df = files.read_typed_csv(spark, csv(tmp_path, "a.csv.gz", text, True), SCHEMA, row_no=True)
    assert rows(df, "row_no", "city", "n") == [(1, "А", 1), (2, None, None)]
    for bad in ("town,ts,d,x,n\na,2023-01-01 05:00:00,2023-01-01,1,1\n", "city,ts,d,x,n\na,2023-01-01 05:00:00,2023-01-01,1,one\n"):
        with pytest.raises(Exception):
            files.read_typed_csv(spark, csv(tmp_path, f"bad{len(bad)}.csv", bad), SCHEMA).collect()


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    """A file that is read as many blocks numbers its non-blank lines without a gap, in order."""
    path = tmp_path / "lines.txt"
    path.write_text("".join(f"line-{i}\n" + ("   \n" if i % 3 == 0 else "") for i in range(1, 3001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_lines(spark, str(path))
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 4
        got = {r["line_no"]: r["value"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {i: f"line-{i}" for i in range(1, 3001)}


def test_envelopes_and_fingerprints(spark, tmp_path):
    lines = [json.dumps({"_source": {"v": 1}, "record": {"id": 5}}), "", json.dumps({"record": {"id": 6}})]
    path = tmp_path / "e.jsonl"
    path.write_text("\n".join(lines) + "\n")
    got = sorted((r["line_no"], r["e"], r["i"]) for r in files.read_envelopes(spark, str(path)).select(
        "line_no", F.to_json("envelope").alias("e"), F.variant_get("payload", "$.id", "int").alias("i")).collect())
    assert got == [(1, '{"v":1}', 5), (2, "{}", 6)]
    row = files.file_fingerprints(spark, str(path)).first()
    assert (row["sha256"], row["row_count"]) == (hashlib.sha256(path.read_bytes()).hexdigest(), 2)
    large = files.file_fingerprints(spark, str(path), method="lines").first()
    assert large["sha256"].startswith("lines:") and large["row_count"] == 2


@pytest.mark.parametrize("method", ["bytes", "lines"])
def test_fingerprints_see_the_order_and_odd_names(spark, tmp_path, method):
    (tmp_path / "up 1+2%.txt").write_text("a\nb\n")
    (tmp_path / "down é.txt").write_text("b\na\n")
    (tmp_path / "blank.txt").write_text("\n")
    got = {r["file"].rsplit("/", 1)[1]: (r["sha256"], r["row_count"]) for r in files.file_fingerprints(spark, str(tmp_path), method=method).collect()}
    assert {n: c for n, (_, c) in got.items()} == {"up 1+2%.txt": 2, "down é.txt": 2, "blank.txt": 0}
    assert len({h for h, _ in got.values()}) == 3
    names = {r["file"].rsplit("/", 1)[1] for r in files.read_lines(spark, str(tmp_path)).collect()}
    assert names == {"up 1+2%.txt", "down é.txt"}


def test_longer_arrays_add_no_rows(spark):
    df = spark.createDataFrame([(1, ["t1", "t2"], [1.0, 2.0, 3.0], None), (2, ["t3"], [], [9.0])], "id int, t array<string>, a array<double>, b array<double>")
    out = documents.flatten_parallel_arrays(df, F.col("t"), {"x": F.col("a"), "y": F.col("b")})
    assert sorted((r["id"], r["anchor"], r["x"], r["y"]) for r in out.collect()) == [(1, "t1", 1.0, None), (1, "t2", 2.0, None), (2, "t3", None, 9.0)]


def test_unknown_entity_is_refused(spark):
    m = values(spark, [("a", "passes", "s", 1, "x")], "file_path string, entity string, source_system string, batch_seq int, scenario string")
    reg = values(spark, [], "batch_id bigint, batch_seq int, scenario string, source_system string, entity string, "
                            "file_path string, file_sha256 string, row_count bigint, run_id string, loaded_at timestamp")
    f = values(spark, [("a", "00", 1)], "file_path string, file_sha256 string, row_count bigint")
    with pytest.raises(Exception, match="unknown entity"):
        files.plan_batches(m, reg, f).collect()


def test_weather_documents(spark, tmp_path, rows):
    doc = {"hourly": {"time": ["2023-01-01T00:00", "2023-01-01T01:00"], "temperature_2m": [1.5, None], "precipitation": [0.1, 0.2]}}
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(doc, indent=1))
    docs = documents.read_json_documents(spark, str(path), documents.WEATHER_DOC).select(
        F.lit("A").alias("city"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), "hourly")
    flat = documents.flatten_weather(docs)
    got = flat.select(F.date_format("event_ts", "HH").alias("h"), F.col("temperature_2m").cast("string"), "relative_humidity_2m",
                      F.col("precipitation_mm").cast("string"))
    assert rows(got) == [("00", "1.50", None, "0.10"), ("01", None, None, "0.20")]


def test_match_id_from_path(spark):
    df = values(spark, [("file:/x/events/3869685.json",), ("s3a://b/events/12.json",)], "file string")
    assert [r[0] for r in df.select(documents.match_id_of()).collect()] == [3869685, 12]


def test_partition_values_survive(spark, tmp_path, rows):
    df = values(spark, [("007", 1), ("1e3", 2), (None, 3)], "code string, v int")
    path = str(tmp_path / "p")
    datasets.write_partitioned(df, path, "code")
    back = datasets.read_like(spark, path, df.schema)
    assert rows(back) == rows(df)
    assert datasets.assert_roundtrip(df, back) == 3
    with pytest.raises(Exception, match="blank value"):
        datasets.write_partitioned(values(spark, [("", 1)], "code string, v int"), str(tmp_path / "q"), "code")
    with pytest.raises(datasets.RoundTripError):
        datasets.assert_roundtrip(df, back.withColumn("v", F.col("v").cast("bigint")))
    with pytest.raises(datasets.RoundTripError):
        datasets.assert_roundtrip(df, back.where("v < 3"))


def test_hot_partition_value_is_split(spark, tmp_path):
    """The hint that gathers partition folders must not push a hot value through one task."""
    df = spark.range(10).select(F.lit("hot").alias("c"), "id")
    plan = df.hint("rebalance", "c")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_year_layout_edges_and_pruning(spark, tmp_path, rows):
    days = [dt.date(1900, 1, 1), dt.date(2014, 12, 31), dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 6, 20)]
    df = values(spark, [(i, d) for i, d in enumerate(days)], "i int, d date")
    path = str(tmp_path / "y")
    datasets.write_by_year(df, path, "d", dt.date(1900, 1, 1), 2015, 2026)
    stats = datasets.partition_stats(spark.read.parquet(path), datasets.expected_buckets(spark, 2015, 2026), "d")
    assert stats.count() == 13 and stats.where("rows = 0").count() == 10
    assert rows(stats.where("rows > 0"), "year_bucket", "rows") == [(2014, 2), (2023, 1), (2024, 2)]
    part = spark.read.parquet(path).where(datasets.slice_partitions("2024-06-14", "2024-06-24", 2015)).where("d >= '2024-06-14'")
    work = datasets.pruned_partitions(spark, part, path)
    assert (work["read"], work["total"]) == (1, 3)
    old = spark.read.parquet(path).where(datasets.slice_partitions("1950-01-01", "2000-01-01", 2015))
    assert old.count() == 2
    for bad in (dt.date(2027, 1, 1), dt.date(1899, 12, 31), None):
        with pytest.raises(Exception, match="no partition for date"):
            datasets.write_by_year(values(spark, [(1, bad)], "i int, d date"), str(tmp_path / "z"), "d", dt.date(1900, 1, 1), 2015, 2026)


def test_clustered_layout_reads_less(spark, tmp_path):
    df = spark.range(40000).select((F.col("id") % 2).cast("string").alias("s"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 1000).cast("int")).alias("d"), "id")
    path = str(tmp_path / "c")
    datasets.write_clustered(df, path, ["s", "d"])
    rows_read = datasets.scan_work(spark.read.parquet(path).where("s = '1' and d = '2021-01-01'"))["rows"]
    assert 0 < rows_read < 40000
    assert spark.read.parquet(path).count() == 40000


def test_publication_replaces_only_its_slice(spark, tmp_path, rows):
    def candidate(data, lo, hi, run):
        df = values(spark, data, "source_system string, team_id int, match_date date, shots int")
        return df.withColumns({"slice_start": F.lit(lo), "slice_end": F.lit(hi), "run_id": F.lit(run)})

    d = [dt.date(2024, 1, n) for n in range(1, 8)]
    m = PublishedMart(spark, str(tmp_path / "m"), ["source_system", "team_id", "match_date", "shots"],
                      ["source_system", "team_id", "match_date"])
    m.publish(candidate([("s", 1, d[0], 5), ("s", 1, d[2], 6), ("s", 2, d[4], 7)], d[0], d[6], "r1"), d[0], d[6], "r1")
    m.publish(candidate([("s", 1, d[2], 9)], d[1], d[4], "r:2"), d[1], d[4], "r:2")
    assert rows(m.rows(), "match_date", "shots") == [(d[0], 5), (d[2], 9), (d[4], 7)]
    for bad, lo, hi in ((candidate([("s", 1, d[0], 1)], d[0], d[1], "r3"), d[0], d[2]),
                        (candidate([("s", 1, d[0], 1), ("s", 1, d[0], 2)], d[0], d[2], "r3"), d[0], d[2]),
                        (candidate([("s", 1, d[5], 1)], d[0], d[2], "r3"), d[0], d[2])):
        with pytest.raises(PublicationRefused):
            m.publish(bad, lo, hi, "r3")
    assert m.log.read().count() == 2
    m.publish(candidate([], d[0], d[6], "r4"), d[0], d[6], "r4")
    assert m.rows().count() == 0
    assert m.last_publication().first()["checksum"] == "empty"


def test_nothing_published_yet(spark, tmp_path):
    m = PublishedMart(spark, str(tmp_path / "none"))
    assert m.rows().count() == 0 and "goals_minus_xg" in m.view().columns
    assert m.slice_checksum("2024-01-01", "2024-02-01").first()["checksum"] == "empty"
    assert m.last_publication().count() == 0


def test_inline_values_are_known_to_be_small(spark):
    d = dictionary(spark, [("a", "x")], "k string, v string", "small_dictionary")
    big = spark.range(10).select(F.col("id").cast("string").alias("k"))
    plan = big.join(d, "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_orders_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source_queries, "work_path", lambda spark, name: str(tmp_path / name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
        assert tuple(source_queries.fingerprint_order(spark, "/root/testdata/sf0.001").first()) == (2, 2, 1, events)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name in ("up", "down"):
        parts = sorted((tmp_path / "orders-of-lines" / name).glob("part-*.txt"))
        ids = [[int(line.split()[0]) for line in p.read_text().splitlines()] for p in parts]
        assert sum(map(bool, ids)) > 1
        assert sum(ids, []) == sorted(sum(ids, []), reverse=name == "down")
