"""Stores that are maintained by parts: dimensions by deliveries, trees of digests, publications, observed writes, sweeps."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from slicemill.operators import compare, history, sweep
from slicemill.sinks import hashtree, observed
from slicemill.sinks.dimension import BUCKET, ScdDimension
from slicemill.sinks.versioned import PUBLICATION_LOG, PublishedMart, owned_intervals
from slicemill.sources.inline import values

D0, FAR = dt.date(2020, 1, 1), dt.date(9999, 12, 31)
OBS = "src string, team int, mgr int, name string, d date"


def day(n):
    return D0 + dt.timedelta(days=n)


def observations(rnd, n, teams=12):
    return [(rnd.choice(["a", None]), rnd.randrange(teams), rnd.choice([None, 1, 2, 3, 4]), rnd.choice(["x", "y", None]), day(rnd.randrange(900))) for _ in range(n)]


def full(spark, data):
    return history.scd2_from_observations(spark.createDataFrame(data, OBS), ["src", "team"], "mgr", "d", "name")


def stamps(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_deliveries_in_any_order(spark, tmp_path, rows):
    rnd = random.Random(1)
    parts = [observations(rnd, 60) for _ in range(4)]
    dim = ScdDimension(spark, str(tmp_path / "dim"), ["src", "team"], "mgr", "d", "name", buckets=7)
    assert dim.read() is None
    empty = dim.deliver(spark.createDataFrame([], OBS))
    assert dim.read() is None and empty.rows_written == 0 and empty.after.count() == 0
    so_far = []
    for number in (2, 0, 3, 0, 1):  # one of them twice
        dim.deliver(spark.createDataFrame(parts[number], OBS))
        so_far += parts[number]
        cols = full(spark, so_far).columns
        assert rows(dim.read(), *cols) == rows(full(spark, so_far), *cols)


def test_a_delivery_rewrites_its_partitions_only(spark, tmp_path, rows):
    rnd = random.Random(2)
    base = observations(rnd, 400, 60)
    dim = ScdDimension(spark, str(tmp_path / "dim"), ["src", "team"], "mgr", "d", "name", buckets=32)
    dim.deliver(spark.createDataFrame(base, OBS))
    before = stamps(dim.path)
    late = [("a", 5, 9, "z", day(100)), ("a", 5, 1, "z", day(2000)), (None, 7, 9, "z", day(3))]
    done = dim.deliver(spark.createDataFrame(late, OBS))
    assert len(done.buckets) <= 2
    assert done.rows_written == spark.read.parquet(dim.path).where(F.col(BUCKET).isin(done.buckets)).count()
    kept = {f: t for f, t in before.items() if not any(f"{BUCKET}={b}/" in f for b in done.buckets)}
    assert kept and kept.items() <= stamps(dim.path).items()
    cols = full(spark, base).columns
    assert rows(dim.read(), *cols) == rows(full(spark, base + late), *cols)
    assert {(r["src"], r["team"]) for r in done.after.collect()} == {("a", 5), (None, 7)}


def test_corrected_entities_forget_what_they_had(spark, tmp_path, rows):
    base = [("a", 1, 1, "x", day(0)), ("a", 1, 2, "x", day(5)), ("a", 2, 1, "x", day(1)), ("b", 3, 1, "x", day(1))]
    dim = ScdDimension(spark, str(tmp_path / "dim"), ["src", "team"], "mgr", "d", "name", buckets=64)
    dim.deliver(spark.createDataFrame(base, OBS))
    right = [("a", 1, 2, "x", day(3))]
    dim.deliver(spark.createDataFrame(right, OBS), replaced=values(spark, [("a", 1), ("b", 3)], "src string, team int"))
    cols = full(spark, base).columns
    assert rows(dim.read(), *cols) == rows(full(spark, right + base[2:3]), *cols)  # the third entity has no observation left


def test_changed_facts(spark, tmp_path, rows):
    base = [("a", 1, 1, "x", day(0)), ("a", 1, 2, "x", day(100)), ("a", 2, 1, "x", day(0))]
    dim = ScdDimension(spark, str(tmp_path / "dim"), ["src", "team"], "mgr", "d", "name")
    dim.deliver(spark.createDataFrame(base, OBS))
    done = dim.deliver(spark.createDataFrame([("a", 1, 3, "x", day(50))], OBS))
    facts = spark.createDataFrame([(n, "a", t, day(n)) for t in (1, 2) for n in (10, 40, 60, 110)], "id int, src string, team int, d date")
    changed = dim.changed_facts(done, facts, ["team", "id"], "d", ["mgr", "valid_from"])
    assert rows(changed, "team", "id", "mgr", "extra") == sorted([(1, 60, 1, -1), (1, 60, 3, 1)], key=str)


def test_tree_diff(spark, tmp_path, rows):
    data = [(i, i % 7, None if i % 5 == 0 else f"v{i}") for i in range(3000)]
    other = [(i, k + (i in (17, 900)), v) for i, k, v in data if i != 44] + [(5000, 1, "new"), (3, 3, "v3")]
    a, b = (spark.createDataFrame(x, "id int, k int, v string") for x in (data, other))
    paths = [str(tmp_path / n) for n in "abc"]
    for df, path in zip((a, b, a.select("v", "k", "id").repartition(5)), paths):
        assert hashtree.write_with_tree(df, path, ["id"], leaves=100, fanout=4)["rows"] == df.count()
    odd = hashtree.differing_leaves(spark, paths[0], paths[1])
    assert 1 <= len(odd) <= 5
    assert rows(hashtree.tree_diff(spark, *paths[:2]), "id", "k", "v", "extra") == rows(compare.multiset_diff(a, b), "id", "k", "v", "extra")
    assert sum(hashtree.leaf_rows(spark, p, odd).count() for p in paths[:2]) < 0.1 * 6000
    assert hashtree.differing_leaves(spark, paths[0], paths[2]) == [] and hashtree.tree_diff(spark, paths[0], paths[2]).count() == 0
    before = stamps(f"{paths[1]}/rows")
    hashtree.replace_leaves(hashtree.leaf_rows(spark, paths[0], odd), paths[1], odd)
    assert hashtree.differing_leaves(spark, *paths[:2]) == [] and rows(hashtree.leaf_rows(spark, paths[1], range(100)), "id") == rows(a, "id")
    assert sum(before.get(f) == t for f, t in stamps(f"{paths[1]}/rows").items()) >= 90


def test_trees_of_empty_and_other_tables(spark, tmp_path):
    a = spark.range(100).select("id", F.lit("x").alias("v"))
    paths = [str(tmp_path / n) for n in "abcd"]
    for df, path, leaves in ((a, paths[0], 16), (a.where("false"), paths[1], 16), (a.where("false"), paths[2], 16), (a, paths[3], 32)):
        hashtree.write_with_tree(df, path, ["id"], leaves=leaves, fanout=4)
    assert hashtree.differing_leaves(spark, paths[1], paths[2]) == [] and hashtree.tree_diff(spark, paths[1], paths[2]).count() == 0
    assert hashtree.tree_diff(spark, *paths[:2]).count() == 100
    with pytest.raises(hashtree.TreesDiffer):
        hashtree.differing_leaves(spark, paths[0], paths[3])
    assert [hashtree.levels(n, 4) for n in (1, 4, 5, 16, 17, 64)] == [1, 1, 2, 2, 3, 3]


def test_owned_intervals():
    rnd = random.Random(3)
    for _ in range(200):
        slices = [(pid, day(s), FAR if rnd.random() < 0.05 else day(s + rnd.randint(0, 20))) for pid, s in enumerate([rnd.randrange(60) for _ in range(rnd.randint(0, 25))], 1)]
        rnd.shuffle(slices)
        found = owned_intervals(slices)
        assert all(a < b for a, b, _ in found) and all(x[1] <= y[0] and x[1:] != y[::2] for x, y in zip(found, found[1:]))
        for n in range(-1, 90):
            owner = max((pid for pid, s, e in slices if s <= day(n) < e), default=None)
            assert [pid for a, b, pid in found if a <= day(n) < b] == ([] if owner is None else [owner])


def test_only_owners_are_read_and_superseded_folders_go(spark, tmp_path, rows):
    cols, key = ["source_system", "team_id", "match_date", "shots"], ["source_system", "team_id", "match_date"]
    m = PublishedMart(spark, str(tmp_path / "m"), cols, key)

    def publish(run, data, lo, hi):
        df = values(spark, [("s", 1, d, n) for d, n in data], "source_system string, team_id int, match_date date, shots int")
        return m.publish(df.withColumns({"slice_start": F.lit(lo), "slice_end": F.lit(hi), "run_id": F.lit(run)}), lo, hi, run)

    publish("r1", [(day(n), n) for n in range(10)], day(0), FAR)
    publish("r2", [(day(5), 50)], day(5), day(6))
    publish("r3", [(day(5), 51)], day(4), day(7))
    folders = lambda df: {f.split("publication_id=")[1].split("/")[0] for f in df.inputFiles()}
    assert m.intervals() == [(day(0), day(4), 1), (day(4), day(7), 3), (day(7), FAR, 1)]
    assert folders(m.rows(day(4), day(6))) == {"3"} and folders(m.rows()) == {"1", "3"}
    want = [(day(n), n) for n in (0, 1, 2, 3, 7, 8, 9)] + [(day(5), 51)]
    assert rows(m.rows(), "match_date", "shots") == sorted(want, key=str)
    assert m.drop_superseded() == [2] and m.drop_superseded() == [2] and not os.path.exists(f"{m.root}/data/publication_id=2")
    assert rows(m.rows(), "match_date", "shots") == sorted(want, key=str) and m.log.read().count() == 3
    assert m.rows(day(-9), day(-5)).count() == 0


def test_many_publications(spark, tmp_path):
    rnd = random.Random(4)
    log = [(pid, "r", "s", day(s), FAR if pid == 700 else day(s + rnd.randint(1, 30)), 0, "x", dt.datetime(2020, 1, 1)) for pid, s in enumerate([rnd.randrange(1500) for _ in range(1000)], 1)]
    m = PublishedMart(spark, str(tmp_path / "m"), ["shots"], ["shots"])
    spark.createDataFrame(log, PUBLICATION_LOG).write.parquet(f"{m.root}/log")
    found = m.intervals()
    assert found == owned_intervals((r[0], r[3], r[4]) for r in log) and found[-1][1:] == (FAR, 700)
    assert m.intervals(day(10), day(20))[0][0] >= day(10) and m.intervals(day(10), day(20))[-1][1] <= day(20)


def test_observed_writes_read_their_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).select("id", (F.col("id") % 3).alias("k")).mapInArrow(counted, "id long, k long")
    path = str(tmp_path / "t")
    back = observed.checked_roundtrip(df, lambda rows: rows.write.parquet(path), lambda: spark.read.parquet(path))
    assert back.count() == 1000 and seen.value == 1000
    with pytest.raises(observed.RoundTripError):
        observed.checked_roundtrip(df, lambda rows: rows.where("id < 999").write.mode("overwrite").parquet(path), lambda: spark.read.parquet(path).where("k < 2"))


def test_snapshots_by_day(spark, tmp_path, rows):
    df = values(spark, [(i, dt.datetime(2026, 9, 28 + i % 2, 23, tzinfo=dt.timezone.utc)) for i in range(6)], "id int, ts timestamp")
    path, by = str(tmp_path / "t"), {"day": F.to_date("ts")}
    observed.add_snapshot(df.where("id < 2"), path, 1, "overwrite", ["id"], by)
    observed.add_snapshot(df.where("id < 4"), path, 2, "overwrite", ["id"], by)
    before = values(spark, [(1,), (2,)], "snapshot_id int")
    assert observed.add_snapshot(df.where("id >= 4"), path, 3, "append", ["id"], by)["total"] == 6
    assert observed.add_snapshot(df.where("id >= 4"), path, 3, "append", ["id"], by)["total"] == 6  # a repeat
    for bad in (df.where("id = 1"), df.where("id = 1").withColumn("id", F.lit(None).cast("int"))):
        with pytest.raises(observed.AppendRefused):
            observed.add_snapshot(bad, path, 4, "append", ["id"], by)
    every = observed.stored(spark, path)
    assert rows(observed.new_snapshots(before, every)) == [(3,)]
    assert rows(observed.snapshot_totals(every), "operation", "total_records") == [("append", 6), ("overwrite", 2), ("overwrite", 4)]
    assert rows(observed.current_rows(every), "id") == [(i,) for i in range(6)]
    assert rows(observed.current_rows(every).where(F.col("day") == F.lit(dt.date(2026, 9, 29))), "id") == [(1,), (3,), (5,)]


def brute_join(points, versions):
    out = []
    for n, entity, d in points:
        met = [v for e, v, a, b in versions if e is not None and e == entity and d is not None and a <= d < b]
        out += [(n, v) for v in met] or [(n, None)]
    return sorted(out, key=str)


@pytest.mark.parametrize("width,hot,parts", [(366, 10**9, 3), (20, 4, 5), (1, 1, 2), (3650, 7, 1)])
def test_sweep_join(spark, rows, width, hot, parts):
    rnd = random.Random(width)
    versions = [(rnd.choice([None, 1, 2, 3]), i, day(s), rnd.choice([FAR, day(s + rnd.randint(-3, 80))])) for i, s in enumerate([rnd.randrange(200) for _ in range(60)])]
    points = [(n, rnd.choice([None, 1, 1, 1, 2, 4]), rnd.choice([None] + [day(rnd.randrange(-20, 260)) for _ in range(9)])) for n in range(300)]
    p = spark.createDataFrame(points, "n int, e int, d date").repartition(parts)
    v = spark.createDataFrame(versions, "e int, v int, valid_from date, valid_to date").repartition(parts)
    out = sweep.sweep_join(p, v, ["e"], "d", ["v"], width=width, hot=hot)
    assert out.columns == ["n", "e", "d", "v"] and rows(out, "n", "v") == brute_join(points, versions)
    assert rows(sweep.sweep_join(p, v, ["e"], "d", ["v"], outer=False, width=width, hot=hot), "n", "v") == [r for r in brute_join(points, versions) if r[1] is not None]
    assert rows(history.join_valid_at(p, v, ["e"], "d", ["v"]), "n", "v") == brute_join(points, versions)
    assert sweep.sweep_join(p.where("false"), v, ["e"], "d", ["v"]).count() == 0 and sweep.sweep_join(p, v.where("false"), ["e"], "d", ["v"]).where("v is null").count() == 300
    pairs = sorted((min(a[1], b[1]), max(a[1], b[1])) for i, a in enumerate(versions) for b in versions[i + 1:] if a[0] is not None and a[0] == b[0] and max(a[2], b[2]) < min(a[3], b[3]))
    assert rows(sweep.sweep_overlaps(v, ["e"], "v", width=width, hot=hot), "v_a", "v_b") == sorted(pairs, key=str)
    assert rows(history.overlapping_versions(v.where("valid_from < valid_to"), ["e"], "v"), "v_a", "v_b") == sorted(pairs, key=str)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_plans_stay_narrow(spark, tmp_path):
    """Exchanges with broadcasts off: version ends, validity joins and overlaps deal their rows once each."""
    v = spark.createDataFrame([(1, 1, D0, FAR)], "e int, v int, valid_from date, valid_to date")
    p = spark.createDataFrame([(1, 1, D0)], "n int, e int, d date")
    v.write.parquet(str(tmp_path / "v"))
    p.write.parquet(str(tmp_path / "p"))
    v, p = spark.read.parquet(str(tmp_path / "v")), spark.read.parquet(str(tmp_path / "p"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(history.join_valid_at(p, v, ["e"], "d", ["v"])) <= 2
        assert exchanges(history.overlapping_versions(v, ["e"], "v")) <= 2
        assert exchanges(history.scd2_from_observations(p, ["e"], "n", "d")) <= 2
        assert exchanges(sweep.sweep_join(p, v, ["e"], "d", ["v"])) <= 4  # two of them of the same counts
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
