"""Contracts as bitmasks, rules on groups by grouping sets, sketches, Z-order and places of lines."""

import datetime as dt
import gzip
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from slicemill.operators import contract, quality, sketches
from slicemill.sinks import datasets
from slicemill.sources import files

START, END = dt.date(2026, 9, 1), dt.date(2026, 11, 30)
GOOD = dict(event_id="e", user_id=1, session_id="s", event_ts=dt.datetime(2026, 9, 5, 12), event_date=dt.date(2026, 9, 5), event_type="click", platform="web", device_type="d", os_version="o",
            app_version="a", region="r", city="c", referrer="x", category_id=1, category_name="n", price_rub=None, quantity=None, currency="RUB", payment_method=None, duration_ms=100, ab_group="A")
PAID = dict(GOOD, event_type="purchase", price_rub=1, quantity=4, payment_method="card")
BREAKS = [({}, []), (PAID, []), ({"city": " "}, ["missing_city"]), ({"user_id": None}, ["missing_user_id"]), ({"event_type": "look"}, ["unknown_event_type"]),
          ({"event_date": dt.date(2026, 9, 6)}, ["other_day_than_time"]), ({"event_ts": dt.datetime(2026, 11, 30), "event_date": dt.date(2026, 11, 30)}, ["outside_window"]),
          ({"currency": "USD"}, ["foreign_currency"]), (dict(PAID, price_rub=0), ["bad_price"]), (dict(PAID, price_rub=None), ["bad_price"]), (dict(PAID, quantity=5), ["bad_quantity"]),
          (dict(PAID, payment_method="cheque", quantity=0), ["bad_quantity", "bad_payment_method"]), ({"price_rub": 5}, ["unexpected_price_rub"]),
          ({"quantity": 1, "payment_method": "card", "currency": None}, ["missing_currency", "unexpected_quantity", "unexpected_payment_method"]),
          ({"event_type": None}, ["missing_event_type"]), (dict(PAID, event_type="refund", price_rub=None, city=None), ["missing_city", "bad_price"])]


def events(spark, rows):
    ddl = contract.EVENT_SCHEMA.replace("price_rub decimal(12,2)", "price_rub int")
    df = spark.createDataFrame([tuple({**GOOD, **r, "event_id": f"e{i}"}.values()) for i, r in enumerate(rows)], ddl)
    return df.withColumn("price_rub", F.col("price_rub").cast("decimal(12,2)"))


def test_event_contract(spark, rows):
    rules = contract.event_rules(START, END)
    assert len(rules) == 28 and len(contract.EVENT_SCHEMA.split(", ")) == 21
    df = events(spark, [r for r, _ in BREAKS])
    good, bad = contract.split_by_mask(df, rules)
    assert rows(good, "event_id") == [("e0",), ("e1",)]
    assert {r["event_id"]: r["reasons"] for r in bad.collect()} == {f"e{i}": why for i, (_, why) in enumerate(BREAKS) if why}
    counts = contract.mask_counts(df, rules)
    every = Counter(w for _, why in BREAKS for w in why)
    first = Counter(why[0] for _, why in BREAKS if why)
    assert {r["rule"]: (r["failures"], r["first_reason"]) for r in contract.rule_counts(counts, rules).collect()} == {n: (every[n], first[n]) for n, _ in rules}
    pairs = Counter(p for _, why in BREAKS for p in itertools.combinations(why, 2))
    assert {(r["rule_a"], r["rule_b"]): r["rows"] for r in contract.pair_counts(counts, rules).collect()} == dict(pairs)


def test_contract_is_enforced(spark):
    rules = contract.event_rules(START, END)
    assert contract.validate_contract(events(spark, [{}, PAID]), ["event_id"], rules) == 2
    with pytest.raises(quality.QualityError, match="missing_city': 2"):
        contract.validate_contract(events(spark, [{"city": ""}, {"city": None}, {}]), ["event_id"], rules)
    with pytest.raises(quality.QualityError, match="2 rows, 1 keys"):
        contract.validate_contract(events(spark, [{}]).unionAll(events(spark, [{}])), ["event_id"], rules)
    with pytest.raises(quality.QualityError, match="no rows"):
        contract.validate_contract(events(spark, [{}]).where("false"), ["event_id"], rules)
    with pytest.raises(ValueError, match="63"):
        contract.violation_mask([(f"r{i}", F.lit(True)) for i in range(64)])
    all_bits = spark.range(1).select(contract.violation_mask([(f"r{i}", F.lit(True)) for i in range(63)]).alias("m")).first()["m"]
    assert all_bits == 2 ** 63 - 1


def test_group_rules_share_one_grouping(spark, rows):
    """Rules of the same and of different columns, with NULLs that are values, groups and absent at once."""
    rnd = random.Random(1)
    data = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "a", "b", "c"]), i % 50) for i in range(60)]
    df = spark.createDataFrame(data, "k int, v string, n int")
    rules = [quality.unique("t", df, "k"), quality.unique("t", df, "n"), quality.unique_key("t", df, ["k", "v"]), quality.unique_key("t", df, ["v", "k"]),
             quality.accepted_values("t", df, "v", ["a"]), quality.accepted_values("t", df, "k", [1, 2, 3]), quality.unique_key("t", df, ["n", "k", "v"])]
    got = {r["rule"]: r["failures"] for r in quality.group_failures(rules).collect()}

    def repeated(values):
        return sum(c > 1 for c in Counter(values).values())

    assert got == {"unique_t_k": repeated(k for k, _, _ in data if k is not None), "unique_t_n": repeated(n for _, _, n in data),
                   "unique_combination_t_k_v": repeated((k, v) for k, v, _ in data), "unique_combination_t_v_k": repeated((k, v) for k, v, _ in data),
                   "accepted_values_t_v": len({v for _, v, _ in data} - {None, "a"}), "accepted_values_t_k": 0, "unique_combination_t_n_k_v": repeated(data)}
    assert {r["failures"] for r in quality.group_failures([quality.unique("t", df.where("false"), "k")]).collect()} == {0}


def test_sketches_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 7).alias("p"), F.col("id").alias("k"), (F.col("id") * F.col("id") % 10_007).alias("m"), F.lit(dt.date(2020, 1, 1)).alias("d"))
    stats = sketches.sketch_stats(df, ["p"], ["k"], ["m"], "d")
    assert stats.count() == 7
    for keep in ("p < 7", "p in (1, 4)", "p = 3"):
        est = sketches.estimates(sketches.merged_stats(stats.where(keep)), (0.1, 0.5, 0.9)).first()
        exact = sorted(r["m"] for r in df.where(keep).collect())
        assert est["rows"] == len(exact) and abs(est["distinct_k"] - len(exact)) <= 0.03 * len(exact) and est["first_day"] == dt.date(2020, 1, 1)
        for name, q in (("m_p10", 0.1), ("m_p50", 0.5), ("m_p90", 0.9)):
            assert abs(sum(x <= est[name] for x in exact) / len(exact) - q) <= 0.03
    halves = sketches.merged_stats(stats.withColumn("even", F.col("p") % 2 == 0), ["even"])
    assert {r["rows"] for r in halves.select("rows").collect()} == {df.where("p % 2 = 0").count(), df.where("p % 2 = 1").count()}


def test_zorder_places(spark):
    """Equal places are near in all columns, the place grows with each, and NULLs lie lowest."""
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.random() ** 4, dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(400))) for _ in range(2000)] + [(None, None)], "x double, d date")
    got = df.select("x", "d", datasets.interleaved(df, ["x", "d"], 3).alias("p")).collect()
    assert {r["p"] for r in got} == set(range(64)) and next(r["p"] for r in got if r["x"] is None) == 0
    low = [r for r in got if r["x"] is not None and r["p"] < 16]  # the lower half of both columns
    xs, ds = sorted(r["x"] for r in got if r["x"] is not None), sorted(r["d"] for r in got if r["d"])
    assert max(r["x"] for r in low) <= xs[1020] and max(r["d"] for r in low) <= ds[1030]


def test_places_of_lines(spark, tmp_path, rows):
    """Numbers from stored places are those of the lines, in files of several blocks as well."""
    want = []
    for name, n in (("a", 3000), ("b", 1), ("c", 500)):
        text = "".join(f"{name}{i}\n" + ("\n" if i % 7 == 0 else "") for i in range(n))
        if name == "c":
            (tmp_path / "c.gz").write_bytes(gzip.compress(text.encode()))
        else:
            (tmp_path / f"{name}.txt").write_text(text)
        want += [(f"{name}{i}", i + 1) for i in range(n)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        scan = spark.read.text(str(tmp_path)).where("value <> ''")
        files.place_rows(scan).write.parquet(str(tmp_path / "kept"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    stored = spark.read.parquet(str(tmp_path / "kept"))
    assert stored.select("block").distinct().count() > 3
    numbered = files.dense_numbers(stored, files.block_offsets(stored), "n")
    assert rows(numbered, "value", "n") == sorted(want, key=str)
    plan = files.place_rows(scan)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1
