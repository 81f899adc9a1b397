"""How the layers of the run over the test tables are built: rows as before, work that grows with the rows only."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from slicemill.functions.columns import payload_hash
from slicemill.plans import elt_queries as Q
from slicemill.plans import registry
from slicemill.session import freed_shuffles, shared_root

LINE = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
DAY = dt.datetime(1998, 3, 1)
# discount, tax and quantity as JSON numbers of every form: whole, zero, long, with an exponent, absent
NUMBERS = [(0.0, 0.07, 17.0), (0.1, 0.0, 1.5), (0.05, 0.00001, 50.0), (0.30000000000000004, 0.0012345678901234567, 12345678.0),
           (None, None, None), (0.1, 0.08, -0.0)]


@pytest.fixture
def tables(spark, tmp_path):
    return written(spark, tmp_path, NUMBERS)


def written(spark, tmp_path, numbers):
    spark.createDataFrame([(1, 7), (2, None)], "c_custkey bigint, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(
        [(1, 1, "F", 250000.0, DAY, '5-LOW "quoted" ∅'), (2, 2, None, None, DAY, None), (3, 1, "O", 1.0, None, "5-LOW")],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1 + i % 3, 5, 6, 1 + i, q, 100.25, d, t, "RAN"[i % 3], "OF"[i % 2], DAY) for i, (d, t, q) in enumerate(numbers)]
    spark.createDataFrame(lines + lines[:1], LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def files(df):
    return [pq.ParquetFile(f.removeprefix("file://")) for f in df.inputFiles()]


def test_raw_hash_is_that_of_the_document(spark, tables):
    raw = Q.raw(spark, tables)
    for name, n in (("matches", 3), ("shots", 7)):
        assert raw[name].count() == n
        assert raw[name].where(~payload_hash("payload").eqNullSafe(Q.F.col("payload_hash"))).count() == 0
    numbers = raw["shots"].selectExpr("to_json(payload) AS j").where("j LIKE '%\"location\":[17,0.07]%'")
    assert numbers.count() == 2 and '"statsbomb_xg":0,' in numbers.first()["j"]
    assert raw["shots"].where("to_json(payload) LIKE '%1.2345678E7,0.0012345678901234567%'").count() == 1
    assert raw["shots"].where("to_json(payload) LIKE '%[null,null]%' AND to_json(payload) NOT LIKE '%statsbomb%'").count() == 1


def test_raw_documents_are_stored_whole_and_the_setting_is_put_back(spark, tables):
    key = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(key)
    raw = Q.raw(spark, tables)
    assert not any("typed_value" in str(f.schema) for name in ("matches", "shots") for f in files(raw[name]))
    assert spark.conf.get(key) == before


def test_raw_is_dealt_by_size_and_not_into_a_fixed_number(spark, tables, monkeypatch):
    plans = {}
    monkeypatch.setattr(Q, "stored", lambda s, name, df: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or df)
    Q.raw(spark, tables)
    for name in ("raw-matches", "raw-shots"):
        assert "REPARTITION_BY_NUM" not in plans[name] and "SortMergeJoin" in plans[name]


def test_documents_are_taken_apart_once_for_the_layers_above(spark, tmp_path):
    tables = written(spark, tmp_path, NUMBERS[:3])  # the others hold a number that no location can
    ctx = Q.layers(spark, tables, 1)
    for name in ("stg_matches", "stg_shots"):
        assert ctx[name].inputFiles() and all(name in f for f in ctx[name].inputFiles())
        assert "variant" not in {t for _, t in ctx[name].dtypes}
    assert Q.layers(spark, tables, 0)["stg_shots"].count() == ctx["stg_shots"].count() == 4


def test_newest_version_sorts_by_a_number_first(spark):
    from slicemill.operators.history import latest_version

    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("x", 1, "a"), ("x", 1, "b")], "k string, v int, h string")
    out = latest_version(df, ["k"], ["v desc", "h desc"], "h")
    assert sorted(map(tuple, out.collect()), key=str) == [("x", 1, "b", 2, 2), (None, 2, "b", 2, 1)]
    assert "Sort [_hash" in out._jdf.queryExecution().executedPlan().toString()


def folders(spark):
    """Relations that lie in the shared folder now."""
    root = Path(f"{shared_root(spark)}/slicemill".removeprefix("file:"))
    return {f.name for f in root.iterdir()} if root.exists() else set()


def test_shuffle_files_go_with_the_write_and_the_settings_are_put_back(spark, tables):
    keys = ["spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.variant.inferShreddingSchema"]
    before, seen = [spark.conf.get(k) for k in keys], []
    with freed_shuffles(spark):
        seen.append(spark.conf.get(keys[0]))
    out = Q.stored(spark, "grouped", spark.range(100, numPartitions=4).groupBy((Q.F.col("id") % 7).alias("k")).count())
    assert seen == ["true"] and [spark.conf.get(k) for k in keys] == before
    assert out.count() == 7 and {f.metadata.row_group(0).column(0).compression for f in files(out) if f.metadata.num_row_groups} == {"ZSTD"}


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_layers_made_part_by_part_are_those_made_at_once(spark, tmp_path, monkeypatch, parts):
    tables = written(spark, tmp_path, NUMBERS[:3] * 4)  # null keys, repeated rows, parts without rows
    whole = Q.layers(spark, tables, 3)
    monkeypatch.setattr(Q, "PART_ROWS", 1)
    monkeypatch.setattr(Q, "PARTS", parts)
    monkeypatch.setattr(Q, "FACT_PARTS", 2)
    ctx = Q.layers(spark, tables, 3)
    assert set(ctx) == set(whole)
    for name in ("stg_matches", "stg_shots", "ods_matches", "ods_shots", "dim_player", "fact_shot"):
        assert ctx[name].schema == whole[name].schema
        assert ctx[name].count() and ctx[name].exceptAll(whole[name]).count() == whole[name].exceptAll(ctx[name]).count() == 0


def test_layers_of_empty_tables_are_empty(spark, tmp_path):
    for name in ("customer", "orders", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    ctx = Q.layers(spark, str(tmp_path), 3, ["ods_shots", "fact_shot"])
    assert ctx["fact_shot"].count() == ctx["ods_shots"].count() == 0 and set(ctx) == {"batches", "ods_shots", "fact_shot"}


KEPT = {
    "elt_rules_report": {"fact_shot", "ods_matches"},
    "elt_goals_not_exceed": {"fact_shot", "ods_matches"},
    "elt_fact_shot": {"fact_shot"},
    "elt_mart_team_day": {"fact_shot", "dim_team", "dim_match"},
    "elt_layer_counts": {"fact_shot", "ods_shots", "dim_team", "raw_count"},
    "elt_trace": {"raw_lines", "versions", "current"},
    "elt_dim_player": {"ods_shots"},
    "elt_ods_shots": {"ods_shots"},
    "elt_dim_match": {"ods_matches"},
    "elt_team_observations": {"ods_matches"},
    "elt_dim_team": {"ods_matches"},
}


@pytest.mark.parametrize("name", sorted(KEPT))
def test_only_what_the_query_still_reads_is_kept(spark, tmp_path, monkeypatch, name):
    tables = written(spark, tmp_path, NUMBERS[:3])
    monkeypatch.setattr(Q, "PART_ROWS", 2)
    before = folders(spark)
    out = registry.QUERIES[name](spark, tables)
    kept = {f.rsplit("-", 1)[0] for f in folders(spark) - before}
    assert kept == KEPT[name] | {"raw-batches"}
    assert out.count() >= 0
