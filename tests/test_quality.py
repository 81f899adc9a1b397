"""Quality split, contract, rules and comparison operators on small hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from slicemill.functions.aggregates import null_share, ordered_concat
from slicemill.functions.columns import (
    by_side, changed, date_key, date_slice, is_blank, out_of_range, payload_hash, pct, per_unit, surrogate_key,
)
from slicemill.operators import compare, quality, relations
from slicemill.sources.inline import values

WEATHER = ("city string, event_ts timestamp, event_date date, temperature_2m decimal(5,2), "
           "relative_humidity_2m decimal(5,2), precipitation_mm decimal(6,2), wind_speed_10m decimal(6,2)")
T = dt.datetime(2023, 1, 1, 5, tzinfo=dt.timezone.utc)


def hour(n):
    return T + dt.timedelta(hours=n)


def weather_rules():
    bad = is_blank("city") | F.col("event_ts").isNull() | F.col("event_date").isNull() | F.col("temperature_2m").isNull()
    return [("missing_required_field", bad), ("event_date_mismatch", F.col("event_date") != F.to_date("event_ts")),
            ("temperature_out_of_range", out_of_range("temperature_2m", -55, 45)),
            ("humidity_out_of_range", out_of_range("relative_humidity_2m", 0, 100)),
            ("negative_precipitation", F.col("precipitation_mm") < 0), ("negative_wind_speed", F.col("wind_speed_10m") < 0)]


def test_quality_split(spark, rows):
    d = T.date()
    data = [("ok", hour(0), d, 1, 50, 0, 1), ("nulls", hour(0), d, -6, None, None, None), (" ", hour(0), d, 1, 50, 0, 1),
            ("m", hour(0), d, None, 500, 0, 1), ("dm", hour(0), dt.date(2023, 1, 2), 1, 50, 0, 1), ("t", hour(0), d, 46, 50, 0, 1),
            ("h", hour(0), d, 1, 101, 0, 1), ("p", hour(0), d, 1, 50, -1, -1), ("w", hour(0), d, 1, 50, 0, -1),
            ("dup", hour(0), d, 1, 50, 0, 1), ("dup", hour(0), d, 2, 50, 0, 1),
            ("twin", hour(0), d, 1, 50, 0, 1), ("twin", hour(0), d, 99, 50, 0, 1)]
    df = values(spark, data, WEATHER)
    accepted, rejected = quality.split_valid(df, weather_rules(), ["city", "event_ts"])
    assert rows(accepted, "city") == [("nulls",), ("ok",)]
    assert accepted.columns == df.columns
    assert accepted.count() + rejected.count() == len(data)
    assert rows(rejected, "city", "reject_reason") == sorted([
        (" ", "missing_required_field"), ("m", "missing_required_field"), ("dm", "event_date_mismatch"),
        ("t", "temperature_out_of_range"), ("h", "humidity_out_of_range"), ("p", "negative_precipitation"),
        ("w", "negative_wind_speed"), ("dup", "duplicate_key"), ("dup", "duplicate_key"), ("twin", "duplicate_key"),
        ("twin", "temperature_out_of_range")], key=str)


def test_contract(spark):
    df = values(spark, [(1, "a"), (2, "b")], "id int, kind string")
    ok = quality.contract_violation(["id", "kind"], [~F.col("kind").isin("a", "b")])
    assert quality.validate(df, ["id"], ok) == 2
    for bad in (df.where("false"), df.unionAll(df), values(spark, [(1, " ")], "id int, kind string"),
                values(spark, [(1, "c")], "id int, kind string")):
        with pytest.raises(quality.QualityError):
            quality.validate(bad, ["id"], ok)


def test_rules_ignore_null_where_they_should(spark, rows):
    df = values(spark, [(1, 0.5, "x"), (None, None, None), (None, 1.5, "y"), (1, 0.0, "x")], "k int, xg double, v string")
    parent = values(spark, [(2,)], "k int")
    rules = [quality.not_null("t", "k"), quality.value_between("t", "xg", 0, 1), quality.unique("t", df, "k"),
             quality.unique_key("t", df, ["k", "v"]), quality.accepted_values("t", df, "v", ["x"], quality.WARN),
             quality.relationships("t", df, ["k"], parent, ["k"])]
    report = quality.run_rules({"t": df}, rules)
    assert rows(report, "rule", "status", "failures") == sorted([
        ("not_null_t_k", "fail", 2), ("value_between_t_xg", "fail", 1), ("unique_t_k", "fail", 1),
        ("unique_combination_t_k_v", "fail", 1), ("accepted_values_t_v", "warn", 1), ("relationships_t_k", "fail", 2)], key=str)
    assert "accepted_values_t_v" not in quality.gate(report)
    rows_only = quality.run_rules({"t": df}, rules[:2])
    assert rows_only._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1   # one pass for all


def test_column_functions(spark, rows):
    df = values(spark, [("statsbomb", 779, 5677, dt.date(2022, 12, 3), Decimal("1.235")), ("s", None, 1, None, None)],
                "src string, team bigint, mgr bigint, d date, x decimal(6,3)")
    out = df.select(surrogate_key("src", "team", "mgr", "d").alias("k"), date_key("d").alias("dk"), F.round("x", 2).alias("r"),
                    by_side("team", F.lit(779), F.lit("home"), F.lit("away")).alias("side"),
                    changed([F.col("team"), F.col("mgr")], [F.lit(None).cast("bigint"), F.lit(1).cast("bigint")]).alias("ch"),
                    pct(F.lit(1), F.lit(8)).alias("p"), pct(F.lit(1), F.lit(0)).alias("p0"),
                    per_unit(F.lit(7), F.lit(3)).alias("u"))
    a, b = out.collect()
    assert (a["k"], a["dk"], a["r"], a["side"], a["ch"]) == ("ea7ce4cf1b495ce26558c41ece9a51cb", 20221203, Decimal("1.24"), "home", True)
    assert (b["dk"], b["side"], b["ch"]) == (None, "away", False)
    assert (a["p"], a["p0"], a["u"]) == (Decimal("12.50"), None, Decimal("2.33"))
    spelt = values(spark, [('{"b":1,"a":[1,2]}',), ('{ "a": [1, 2], "b": 1 }',), ('{"a":[2,1],"b":1}',)], "j string")
    hashes = [r[0] for r in spelt.select(payload_hash(F.parse_json("j"))).collect()]
    assert hashes[0] == hashes[1] != hashes[2]


def test_slice_is_half_open_and_needs_bounds(spark):
    df = values(spark, [(dt.date(2024, 6, d),) for d in (13, 14, 23, 24)], "d date")
    assert date_slice(df, "d", "2024-06-14", "2024-06-24").count() == 2
    for lo, hi in ((None, "2024-06-24"), ("2024-06-14", ""), ("2024-06-24", "2024-06-14")):
        with pytest.raises(ValueError):
            date_slice(df, "d", lo, hi)


def test_except_all_and_symmetric_difference(spark, rows):
    a = values(spark, [(1, "x"), (1, "x"), (2, None), (3, "c")], "id int, v string")
    b = values(spark, [(1, "x"), (2, None), (2, None), (4, "d")], "id int, v string")
    assert rows(compare.except_all_counts(a, b)) == [(2, 2)]
    assert rows(compare.sym_diff(a, b)) == [("only_in_A", 3, "c"), ("only_in_B", 4, "d")]
    assert rows(compare.tables_equal(a, b)) == [(4, 4, 2, 2, False)]
    assert rows(compare.tables_equal(a, a)) == [(4, 4, 0, 0, True)]
    assert rows(compare.except_all_counts(a.where("false"), b.where("false"))) == [(0, 0)]


def test_compare_by_key_tolerates_only_what_it_should(spark, rows):
    a = values(spark, [(1, 5, 1.00001), (2, 5, 1.0), (None, 5, 1.0), (4, 5, None)], "k int, n int, x decimal(10,5)")
    b = values(spark, [(1, 5, 1.0), (3, 5, 1.0), (None, 6, 1.0), (4, 5, None)], "k int, n int, x decimal(10,5)")
    assert rows(compare.compare_by_key(a, b, ["k"], ["n", "x"], {"x": "0.0001"}), "k", "status") == sorted([
        (2, "missing"), (3, "extra"), (None, "different")], key=str)
    assert compare.compare_by_key(a, b, ["k"], ["n", "x"]).where("k = 1").count() == 1


def test_checksum_sees_repeats_but_not_order(spark):
    a = values(spark, [(1, "x"), (2, None)], "id int, v string")
    b = values(spark, [(2, None), (1, "x")], "id int, v string")
    twice = a.unionAll(a)

    def sums(df):
        return compare.content_checksum(df, ["id", "v"]).first()["checksum"]

    assert sums(a) == sums(b) != sums(twice)
    assert sums(a) != sums(values(spark, [(1, "x"), (2, "")], "id int, v string"))
    assert sums(a.where("false")) == "empty"


def test_digest_of_digests(spark):
    import hashlib
    df = values(spark, [(10, "bb"), (9, "aa")], "id int, sha string")
    assert compare.digest_of(df, "id", "sha").first()["digest"] == hashlib.sha256(b"9:aa\n10:bb\n").hexdigest()


def test_join_helpers(spark, rows):
    fact = values(spark, [("a",), ("a",), ("b",), (None,)], "c string")
    d = values(spark, [("a", "G"), ("a", "H")], "k string, v string")
    assert rows(relations.join_conservation(fact, d, "c", "k")) == [(4, 6, 2)]
    assert rows(relations.enrich(fact, d.where("v = 'G'"), "c", "k", "v", "none", "g")) == sorted([
        ("a", "G"), ("a", "G"), ("b", "none"), (None, "none")], key=str)
    arrays = spark.range(1).select(F.explode(F.array(F.array(F.lit(1), F.lit(2)), F.array().cast("array<int>"),
                                                     F.lit(None).cast("array<int>"))).alias("a"))
    assert rows(relations.explode_keep(arrays, "a", "x"), "x") == [(1,), (2,), (None,), (None,)]
    text = values(spark, [(2, "b"), (1, "a")], "o int, v string").agg(ordered_concat(F.col("v"), F.col("o")).alias("t"))
    assert rows(text) == [("a | b",)]
    assert rows(fact.agg(null_share("c").alias("s"))) == [(0.25,)]
    assert rows(relations.with_scalar(fact, fact.agg(F.max("c").alias("m"))), "m") == [("b",)] * 4


def test_reconcile_against_published(spark, rows):
    events = values(spark, [(1, 10, "Shot", 1, "Goal", Decimal("0.5")), (1, 10, "Shot", 5, "Goal", Decimal("0.7")),
                            (1, 20, "Own Goal For", 2, None, None), (1, 20, "Pass", 1, None, None)],
                    "match_id int, team_id int, event_type string, period int, outcome string, xg decimal(12,8)")
    matches = values(spark, [(1, dt.date(2024, 1, 1), 10, 20, 1, 1)],
                     "match_id int, match_date date, home_team_id int, away_team_id int, home_score int, away_score int")
    pub = values(spark, [(10, dt.date(2024, 1, 1), 1, 1, 1, Decimal("0.50005"))],
                 "team_id int, match_date date, shots int, shots_on_target int, goals int, xg decimal(12,5)")
    out = compare.reconcile(events, matches, pub)
    assert rows(out, "team_id", "shots", "goals", "own_goals_for", "score_ok", "published_ok") == [
        (10, 1, 1, 0, True, True), (20, 0, 0, 1, True, False)]
    both = pub.withColumn("source_system", F.lit("a")).union(pub.withColumns({"shots": F.lit(7), "source_system": F.lit("b")}))
    assert rows(compare.reconcile(events, matches, both, "a"), "team_id", "published_ok") == [(10, True), (20, False)]
    assert rows(compare.reconcile(events, matches, both, "b"), "team_id", "published_ok") == [(10, False), (20, False)]


def test_group_rules_share_a_pass(spark, rows):
    df = values(spark, [(1, "x", "a"), (1, "x", "b"), (2, None, "c"), (2, None, "c"), (None, "y", None), (None, "z", "a")], "k int, s string, v string")
    rules = [quality.unique("t", df, "k"), quality.unique_key("t", df, ["k", "s"]), quality.accepted_values("t", df, "v", ["a"], quality.WARN),
             quality.unique("t", df.where("false"), "s")]
    assert rows(quality.run_rules({"t": df}, rules), "rule", "status", "failures") == sorted([
        ("unique_t_k", "fail", 2), ("unique_combination_t_k_s", "fail", 2), ("accepted_values_t_v", "warn", 2), ("unique_t_s", "pass", 0)], key=str)
    assert all(r.violators.count() == n for r, n in zip(rules, [2, 2, 2, 0]))
