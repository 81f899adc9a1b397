"""Reductions, SCD2 and validity joins against brute force, with NULL keys and hot entities."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from slicemill.operators import history
from slicemill.sources.inline import values

D0 = dt.date(2020, 1, 1)
FAR = dt.date(9999, 12, 31)


def day(n):
    return D0 + dt.timedelta(days=n)


def test_latest_version_with_null_keys_and_versions(spark, rows):
    data = [("a", None, 1, 1, "h1"), ("a", None, 1, 2, "h2"), ("a", None, 0, 9, "h3"), ("a", 7, 1, 1, None),
            ("a", 7, 1, 2, None), ("b", 7, None, 1, "n1"), ("b", 7, None, 1, "n2"), ("b", 7, 5, 1, "n3")]
    df = values(spark, data, "src string, id int, version int, line int, h string")
    out = history.latest_version(df, ["src", "id"], ["version desc", "line desc", "h desc"], "h")
    assert rows(out, "src", "id", "version", "h", "raw_copies", "variants_same_version") == [
        ("a", 7, 1, None, 2, 1), ("a", None, 1, "h2", 3, 2), ("b", 7, None, "n2", 3, 2)]
    plain = history.latest_version(df, ["src", "id"], ["version desc", "line desc", "h desc"])
    assert rows(plain, "src", "raw_copies") == [("a", 2), ("a", 3), ("b", 3)]


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = history.first_per_key(df, ["k"], ["v desc"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[:exchange] and "WindowGroupLimit" in plan[exchange:]
    assert out.where("k = 0").first()["v"] == 4998
    assert out.count() == df.select("k").distinct().count()


def test_mixed_order_and_last_wins(spark, rows):
    df = values(spark, [(1, 5, "b", "x"), (1, 5, "a", "y"), (1, None, "c", "z"), (2, 1, "q", "w")],
                "k int, v int, e string, name string")
    assert rows(history.latest_attr(df, ["k"], ["name"], ["v desc", "e asc"])) == [(1, "z"), (2, "w")]
    assert rows(history.latest_attr(df.where("v is not null"), ["k"], ["name"], ["v desc", "e asc"])) == [(1, "y"), (2, "w")]
    assert rows(history.last_wins(df.where("v is not null"), ["k"], ["e"]), "k", "name") == [(1, "x"), (2, "w")]


def test_mark_duplicates_counts_null_parts_as_equal(spark, rows):
    df = values(spark, [(1, "a", None), (2, "a", None), (3, "a", 1), (4, None, None)], "n int, k1 string, k2 int")
    assert rows(history.mark_duplicates(df, ["k1", "k2"]), "n", "is_duplicate") == [
        (1, True), (2, True), (3, False), (4, False)]


def test_scd2_null_value_return_and_overlap(spark, rows):
    obs = [(1, None, day(0)), (1, 10, day(5)), (1, 10, day(9)), (1, 20, day(7)), (1, 30, day(20)),
           (2, 10, day(3)), (None, 10, day(1)), (None, 20, day(2))]
    df = values(spark, obs, "team int, mgr int, d date")
    out = history.scd2_from_observations(df, ["team"], "mgr", "d")
    assert rows(out, "team", "mgr", "valid_from", "valid_to") == sorted([
        (1, None, day(0), day(5)), (1, 10, day(5), day(20)), (1, 20, day(7), day(20)), (1, 30, day(20), FAR),
        (2, 10, day(3), FAR), (None, 10, day(1), day(2)), (None, 20, day(2), FAR)], key=str)


def made_versions(seed, entities, hot):
    """Random intervals, empty and open ones among them; entity 0 holds most versions."""
    rnd = random.Random(seed)
    out = []
    for n in range(entities):
        for i in range(hot if n == 0 else rnd.randint(0, 4)):
            start = rnd.randint(0, 900)
            end = FAR if rnd.random() < 0.02 else day(start + rnd.randint(0, 40))
            out.append((n, f"v{n}-{i:04d}", day(start), end))
    return out


@pytest.mark.parametrize("hot", [5, 200])
def test_validity_join_matches_brute_force(spark, rows, hot):
    dim = made_versions(1, 6, hot)
    rnd = random.Random(2)
    facts = [(i, rnd.choice([0, 0, 0, 1, 2, 3, 9, None]), None if i % 50 == 0 else day(rnd.randint(-5, 990))) for i in range(400)]
    f = values(spark, facts, "id int, team int, d date")
    v = values(spark, dim, "team int, vk string, valid_from date, valid_to date")
    want = []
    for i, team, d in facts:
        hits = [vk for t, vk, a, b in dim if t == team and d is not None and a <= d < b]
        want += [(i, vk) for vk in hits] or [(i, None)]
    got = history.join_valid_at(f, v, ["team"], "d", ["vk"])
    assert rows(got, "id", "vk") == sorted(want, key=str)
    # a column of the same name is replaced, at the same place whatever the number of versions
    clash = history.join_valid_at(f.withColumn("vk", F.lit("old")).withColumn("z", F.lit(1)), v, ["team"], "d", ["vk"])
    assert clash.columns == ["id", "team", "d", "z", "vk"] and rows(clash, "id", "vk") == sorted(want, key=str)
    counts = {}
    for i, vk in want:
        counts[i] = counts.get(i, 0) + (vk is not None)
    wrong = history.versions_per_event(f, v.withColumn("label", F.col("vk")), ["team"], "d", "vk", "label")
    assert rows(wrong, "id", "versions_on_event_date") == sorted(((i, n) for i, n in counts.items() if n != 1), key=str)


@pytest.mark.parametrize("hot", [5, 150])
def test_overlaps_match_brute_force(spark, rows, hot):
    dim = made_versions(3, 6, hot)
    v = values(spark, dim, "team int, vk string, valid_from date, valid_to date")
    want = [(a[0], a[1], b[1]) for a in dim for b in dim
            if a[0] == b[0] and a[1] < b[1] and a[2] < b[3] and b[2] < a[3]]
    got = history.overlapping_versions(v, ["team"], "vk")
    assert rows(got, "team", "vk_a", "vk_b") == sorted(want, key=str)


def test_next_start_uses_a_bounded_time_line(spark, rows):
    v = values(spark, [(1, day(0), day(4)), (1, day(4), day(6)), (1, day(5), day(5))], "e int, first_seen date, last_seen date")
    out = history.next_start(v, ["e"])
    got = {r["last_seen"]: r["next_start"] for r in out.collect()}
    assert (got[day(4)], got[day(5)], got[day(6)]) == (day(5), None, None)


def test_calendar(spark):
    df = values(spark, [(dt.date(2022, 12, 3),), (dt.date(2024, 7, 14),)], "d date")
    cal = history.calendar(df, "d")
    assert cal.count() == 590
    first = cal.orderBy("date_key").first()
    assert (first["date_key"], first["iso_day_of_week"], first["day_name"]) == (20221203, 6, "Sat")
    assert history.calendar(df.where("false"), "d").count() == 0
