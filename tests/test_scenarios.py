"""The warehouse run over small files: baseline, repeats, corrections, conflicts and refusals."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import football as fb
from slicemill.operators import compare, quality
from slicemill.plans.elt import Warehouse

FULL = ("2022-12-03", "2024-07-15")
KEYS = ["source_system", "team_id", "match_date"]
BUSINESS = [*KEYS, "team_name", "manager_name", "opponent_name", "team_score", "shots", "shots_on_target", "goals",
            "penalty_goals", "xg", "goals_minus_xg"]


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    fb.write_inputs(root)
    w = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")), str(root))
    w.first = w.run("baseline", *FULL, "run-1")
    w.rows_before = w.mart.rows().select(*BUSINESS).collect()
    w.fact_before = w.first.layers["fact_shot"]
    return w


def published(house):
    return sorted(map(tuple, house.mart.rows().select(*BUSINESS).collect()), key=str)


def restored(house):
    return published(house) == sorted(map(tuple, house.rows_before), key=str)


def test_baseline(house):
    run = house.first
    assert run.failed == []
    assert run.report.count() == 62
    assert run.report.where("severity = 'warn'").count() == 1
    assert {r["action"] for r in run.actions.collect()} == {"load"}
    assert run.published["rows"] == 8
    assert run.layers["dim_date"].count() == 590
    arg = house.mart.rows().where(f"team_id = {fb.ARG} and match_date = '2022-12-18'").first()
    assert (arg["shots"], arg["shots_on_target"], arg["goals"], arg["penalty_goals"]) == (2, 2, 2, 1)
    assert (arg["xg"], arg["goals_minus_xg"]) == (Decimal("1.0869"), Decimal("0.9131"))
    assert (arg["team_score"], arg["opponent_name"], arg["manager_name"]) == (3, "France", "Lionel Scaloni")
    # the shoot-out is not part of the mart but stays in the fact
    assert house.fact_before.where("is_shootout").count() == 2
    assert house.mart.rows().where(f"team_id = {fb.ESP} and match_date < '2023-01-01'").first()["shots"] == 1


def test_history_of_managers(house, rows):
    spain = house.first.layers["dim_team"].where(f"team_id = {fb.ESP}")
    assert rows(spain, "manager_name", "valid_from", "valid_to") == [
        ("De la Fuente", dt.date(2024, 7, 14), dt.date(9999, 12, 31)),
        ("Luis Enrique", dt.date(2022, 12, 6), dt.date(2024, 7, 14))]


def test_known_keys(house):
    layers = house.first.layers
    key = {n: r[0] for n, r in {
        "match": layers["dim_match"].where(f"match_id = {fb.FINAL}").select("match_key").first(),
        "player": layers["dim_player"].where("player_id = 5503").select("player_key").first(),
        "team": layers["dim_team"].where(f"team_id = {fb.ARG}").select("team_version_key").first()}.items()}
    assert key == {"match": "f051eea4984c10972b76962d5a5757c4", "player": "0f20ffda4400de19f030c528ad3eb2ba",
                   "team": "ea7ce4cf1b495ce26558c41ece9a51cb"}


def test_repeat_changes_nothing(house):
    again = house.run("baseline", *FULL, "run-2")
    assert {r["action"] for r in again.actions.collect()} == {"skip"}
    assert again.published["checksum"] == house.first.published["checksum"]
    assert restored(house)
    assert compare.tables_equal(house.fact_before, again.layers["fact_shot"]).first()["equal"]


def test_duplicate_delivery(house):
    run = house.run("duplicate", *FULL, "run-3")
    assert run.failed == [] and restored(house)
    assert run.layers["shots"].count() == len(fb.shots()) + 1
    assert run.layers["ods_shots"].count() == len(fb.shots())
    row = run.layers["ods_shots"].where(F.col("event_id") == fb.DI_MARIA).first()
    assert (row["raw_copies"], row["variants_same_version"]) == (2, 1)


def test_conflicting_copy_only_warns(house, rows):
    run = house.run("conflict", *FULL, "run-4")
    assert run.failed == [] and run.published is not None
    assert rows(run.report.where("status = 'warn'"), "failures") == [(1,)]
    row = run.layers["ods_shots"].where(F.col("event_id") == fb.DI_MARIA).first()
    assert (row["variants_same_version"], row["outcome"]) == (2, "Saved")   # the later batch wins a tie
    assert house.run("baseline", *FULL, "run-4b").published and restored(house)


def test_late_correction_of_one_day(house, rows):
    day = ("2022-12-18", "2022-12-19")
    before = house.mart.rows()
    before = house.spark.createDataFrame(before.select(*BUSINESS).collect(), before.select(*BUSINESS).schema)
    run = house.run("correction", *day, "run-5")
    assert run.published["rows"] == 2
    changed = compare.changed_rows(house.fact_before, run.layers["fact_shot"], ["shot_key"],
                                   ["outcome", "xg", "team_version_key"])
    assert [(r["a_xg"], r["b_xg"]) for r in changed.collect()] == [(Decimal("0.30340916"), Decimal("0.45000000"))]
    diff = compare.sym_diff(before, house.mart.rows().select(*BUSINESS), BUSINESS)
    assert rows(diff, "side", "team_id", "xg") == [("only_in_A", fb.ARG, Decimal("1.0869")),
                                                   ("only_in_B", fb.ARG, Decimal("1.2335"))]
    again = house.run("correction", *day, "run-6")
    assert again.published["checksum"] == run.published["checksum"]
    house.run("baseline", *FULL, "run-7")
    assert restored(house)


def test_second_source_is_kept_apart(house, rows):
    run = house.run("partner", *FULL, "run-8")
    assert run.failed == []
    assert run.layers["fact_shot"].count() == house.fact_before.count() + 1
    assert run.published["rows"] == 9
    keys = run.layers["dim_match"].where(f"match_id = {fb.FINAL}")
    assert ("partner_demo", "5dd7381ff6700176d0261db98eb3ea06") in rows(keys, "source_system", "match_key")
    shared = compare.id_collisions(run.layers["ods_matches"], "match_id")
    assert rows(shared) == [(fb.FINAL, 2, "partner_demo, statsbomb")]
    shot = run.layers["fact_shot"].where(F.col("event_id") == fb.PARTNER).first()
    assert shot["shot_key"] != "2a2dbd84afb8664c0588b834d93d7c1c"   # that one belongs to the other source
    back = house.run("baseline", *FULL, "run-9")
    assert sorted(r["action"] for r in back.actions.collect()) == ["drop", "drop", "skip", "skip"]
    assert restored(house)


def test_overlapping_history_blocks_publication(house, rows):
    run = house.run("overlap", *FULL, "run-10")
    assert run.published is None and restored(house)
    assert {"one_team_version_per_shot", "team_versions_no_overlap", "unique_fact_shot_shot_key"} <= set(run.failed)
    pairs = quality.no_overlap(run.layers["dim_team"])
    assert pairs.count() == 1
    doubled = run.layers["fact_shot"].groupBy("shot_key").count().where("count > 1")
    assert doubled.count() == 2 and run.layers["fact_shot"].count() == house.fact_before.count() + 2
    ambiguous = quality.one_version_per_shot(run.layers["ods_shots"], run.layers["ods_matches"], run.layers["dim_team"])
    assert rows(ambiguous, "versions_on_event_date", "managers") == [(2, "Lionel Scaloni | Co-manager")] * 2


def test_corrupted_value_is_refused_and_recovers(house, rows):
    run = house.run("corrupted", *FULL, "run-11")
    assert run.published is None and restored(house)
    assert rows(run.report.where("rule = 'value_between_fact_shot_xg'"), "status", "failures") == [("fail", 1)]
    candidate = run.layers["mart"].where(f"team_id = {fb.FRA}").first()
    assert candidate["xg"] == Decimal("7.9550")
    sample = quality.failing_samples(run.layers, run.rules, ["value_between_fact_shot_xg"])
    assert rows(sample["value_between_fact_shot_xg"], "event_id") == [(fb.MBAPPE,)]
    batches = run.layers["batches"]
    traced = compare.trace(run.layers["ods_shots"], run.layers["stg_shots"], batches, run.layers["shots"],
                           ["source_system", "event_id"], F.col("xg") > 1, "xg", "source_version")
    assert rows(traced, "file_path", "line_no", "test_case") == [
        ("baseline/shots.jsonl", 9, None), ("scenarios/bad_xg.jsonl", 1, "corrupted")]
    assert house.run("baseline", *FULL, "run-12").published["checksum"] == house.first.published["checksum"]


def test_empty_slice_clears_old_rows(house):
    out = house.mart.publish(house.first.layers["mart"].where("false"), "2024-07-14", "2024-07-15", "run-13")
    assert (out["rows"], out["checksum"]) == (0, "empty")
    assert house.mart.rows().count() == 6
    assert house.mart.slice_checksum("2024-07-14", "2024-07-15").first()["checksum"] == "empty"
    house.run("baseline", *FULL, "run-14")
    assert restored(house)


def test_superseded_data_goes(house, rows):
    run = house.run("partner", *FULL, "run-16")
    back = house.run("baseline", *FULL, "run-17")
    before = rows(house.mart.rows(), *BUSINESS)
    raw = {n: house.raw()[n].count() for n in ("matches", "shots")}
    gone = house.drop_superseded([run.folder])
    assert gone["batches"] and gone["publications"] and gone["runs"] == [run.folder]
    assert rows(house.mart.rows(), *BUSINESS) == before and {n: house.raw()[n].count() for n in raw} == raw
    assert back.layers["fact_shot"].count() == house.fact_before.count() and restored(house)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        run.layers["fact_shot"].count()
    assert house.run("baseline", *FULL, "run-18").published["checksum"] == house.first.published["checksum"]


def test_missing_slice_is_an_error(house):
    with pytest.raises(ValueError, match="missing"):
        house.run("baseline", None, "2024-07-15", "run-15")
    with pytest.raises(ValueError, match="empty slice"):
        house.run("baseline", "2024-07-15", "2024-07-15", "run-15")


def test_batches_keep_their_identity(spark, tmp_path):
    """Dropped batches stay dropped, ids are not given twice, and another process goes on from the stored registry."""
    fb.write_inputs(tmp_path / "in")
    (tmp_path / "in/baseline/shots 2+é.jsonl").write_bytes((tmp_path / "in/baseline/shots.jsonl").read_bytes())
    listed = {"a": ["baseline/matches.jsonl", "baseline/shots.jsonl", "scenarios/partner_matches.jsonl"],
              "b": ["baseline/matches.jsonl", "baseline/shots.jsonl"],
              "c": ["scenarios/two_managers.jsonl", "baseline/matches.jsonl", "baseline/shots.jsonl"],
              "d": ["baseline/matches.jsonl", "baseline/shots 2+é.jsonl"]}
    for name, paths in listed.items():
        entries = [{"path": p, "entity": "shots" if "shots" in p else "matches", "source_system": "s"} for p in paths]
        (tmp_path / f"in/manifests/{name}.json").write_text(fb.json.dumps({"scenario": name, "description": "", "files": entries}))
    root = str(tmp_path / "house")
    seen, counts = {}, {}
    for name in listed:
        house = Warehouse(spark, root, str(tmp_path / "in"))  # as after a restart
        actions = {r["file_path"]: r["action"] for r in house.load_raw(name, f"run-{name}").collect()}
        for r in house.registry().collect():
            assert seen.setdefault(r["batch_id"], r["file_path"]) == r["file_path"]
        raw = house.raw()
        counts[name] = (raw["matches"].count(), raw["shots"].count())
        if name in "bc":
            assert actions["baseline/matches.jsonl"] == actions["baseline/shots.jsonl"] == "skip"
    shots = len(fb.shots())
    assert counts == {"a": (5, shots), "b": (4, shots), "c": (5, shots), "d": (4, shots)}
    assert house.registry().where("file_path like '%shots 2%'").first()["row_count"] == shots
