"""The whole run: raw batches, current state, star, mart candidate, rules, gated publication."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicemill.functions.columns import slice_bounds
from slicemill.operators import quality as q
from slicemill.operators import star
from slicemill.operators.history import calendar, dim_team, observations
from slicemill.operators.marts import MART_KEY, in_play, mart_team_day
from slicemill.session import work_path
from slicemill.sinks.datasets import store_failures, write_partitioned
from slicemill.sinks.observed import remove_folder
from slicemill.sinks.versioned import PublicationRefused, PublishedMart
from slicemill.sources import files
from slicemill.sources.inline import values

REGISTRY = ("batch_id bigint, batch_seq int, scenario string, source_system string, entity string, file_path string, "
            "file_sha256 string, row_count bigint, run_id string, loaded_at timestamp")
MANIFEST = "scenario string, description string, files array<struct<path: string, entity: string, source_system: string>>"

# The accepted stages, outcomes, shot types and periods.
STAGES = ["Round of 16", "Quarter-finals", "Semi-finals", "3rd Place Final", "Final"]
OUTCOMES = ["Goal", "Saved", "Saved to Post", "Saved Off Target", "Off T", "Wayward", "Post", "Blocked"]
SHOT_TYPES = ["Open Play", "Penalty", "Free Kick", "Corner", "Kick Off"]
PERIODS = [1, 2, 3, 4, 5]


# --- layers ------------------------------------------------------------------------------------

def staging(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Typed staging of raw ``matches`` and ``shots`` with their ``batches``."""
    return {"stg_matches": star.stage_matches(raw["matches"], raw["batches"]),
            "stg_shots": star.stage_shots(raw["shots"], raw["batches"])}


def current_state(stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    matches = star.ods_matches(stg["stg_matches"])
    return {"ods_matches": matches, "ods_shots": star.ods_shots(stg["stg_shots"])}


def dimensions(ods: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    obs = observations(ods["ods_matches"])
    return {"dim_date": calendar(ods["ods_matches"], "match_date"), "dim_team": dim_team(obs),
            "dim_player": star.dim_player(ods["ods_shots"]), "dim_match": star.dim_match(ods["ods_matches"])}


def facts(ods: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {"fact_shot": star.fact_shot(ods["ods_shots"], ods["ods_matches"], dims["dim_team"], dims["dim_player"])}


def rules(ctx: Mapping[str, DataFrame], start, end) -> list[q.RowRule | q.QueryRule]:
    """All data tests of the layers; ``ctx`` holds every relation by name."""
    lo, hi = slice_bounds(start, end)
    out: list[q.RowRule | q.QueryRule] = []

    def key(relation: str, col: str) -> None:
        out.extend([q.unique(relation, ctx[relation], col), q.not_null(relation, col)])

    def child(relation: str, col: str, parent: str) -> None:
        out.extend([q.not_null(relation, col), q.relationships(relation, ctx[relation], [col], ctx[parent], [col])])

    key("batches", "batch_id")
    for raw in ("matches", "shots"):
        out.append(q.not_null(raw, "payload"))
        out.append(q.relationships(raw, ctx[raw], ["batch_id"], ctx["batches"], ["batch_id"]))
    for relation, cols in (("stg_matches", ["match_id", "match_date", "source_last_updated"]),
                           ("stg_shots", ["event_id", "match_id", "source_version"]),
                           ("ods_matches", ["home_score", "away_score"]),
                           ("dim_team", ["team_id", "valid_from", "valid_to"]),
                           ("mart", ["team_id", "match_date", "xg"])):
        out.extend(q.not_null(relation, c) for c in cols)
    key("ods_matches", "match_key")
    out.append(q.unique_key("ods_matches", ctx["ods_matches"], ["source_system", "match_id"]))
    key("ods_shots", "shot_key")
    out.append(q.unique_key("ods_shots", ctx["ods_shots"], ["source_system", "event_id"]))
    out.append(q.accepted_values("ods_shots", ctx["ods_shots"], "variants_same_version", [1], q.WARN))
    for dim, col in (("dim_date", "date_key"), ("dim_team", "team_version_key"), ("dim_player", "player_key"),
                     ("dim_match", "match_key"), ("fact_shot", "shot_key")):
        key(dim, col)
    out.append(q.unique_key("dim_team", ctx["dim_team"], ["source_system", "team_id", "valid_from", "manager_id"]))
    child("dim_match", "date_key", "dim_date")
    out.append(q.accepted_values("dim_match", ctx["dim_match"], "stage_name", STAGES))
    for col, parent in (("match_key", "dim_match"), ("date_key", "dim_date"), ("team_version_key", "dim_team"),
                        ("player_key", "dim_player")):
        child("fact_shot", col, parent)
    for col, accepted in (("period", PERIODS), ("outcome", OUTCOMES), ("shot_type", SHOT_TYPES)):
        out.append(q.accepted_values("fact_shot", ctx["fact_shot"], col, accepted))
    out += [q.not_null("fact_shot", "xg"), q.value_between("fact_shot", "xg", 0, 1),
            q.unique_key("mart", ctx["mart"], MART_KEY), q.value_between("mart", "shots", 1, 100)]
    checks = {
        "goals_not_exceed_match_score": q.goals_not_exceed_score(ctx["fact_shot"], ctx["dim_match"]),
        "mart_measure_order": q.measure_order(ctx["mart"]),
        "mart_reconciles_with_fact": q.mart_reconciles(in_play(fact_years(ctx["fact_shot"], lo, hi), lo, hi), ctx["mart"]),
        "one_team_version_per_shot": q.one_version_per_shot(ctx["ods_shots"], ctx["ods_matches"], ctx["dim_team"]),
        "team_version_valid_interval": q.valid_intervals(ctx["dim_team"]),
        "team_versions_no_overlap": q.no_overlap(ctx["dim_team"]),
    }
    return out + [q.QueryRule(name, "", rows) for name, rows in checks.items()]


FACT_YEAR = "match_year"


def fact_years(fact: DataFrame, start, end) -> DataFrame:
    """The partitions of the stored fact that the slice can lie in."""
    lo, hi = slice_bounds(start, end)
    return fact.where(F.col(FACT_YEAR).between(lo.year, (hi - dt.timedelta(days=1)).year))


# --- warehouse ---------------------------------------------------------------------------------

@dataclass
class Run:
    """Relations, rule report and publication of one run, and the folder of its layers below the root."""
    layers: dict[str, DataFrame]
    rules: list
    report: DataFrame
    failed: list[str]
    published: dict | None
    actions: DataFrame
    violations: dict[str, str]
    folder: str


class Warehouse:
    """Folders of a warehouse under one root."""

    def __init__(self, spark: SparkSession, root: str, input_dir: str, fingerprints: str = "bytes"):
        """``fingerprints``: how raw files are told apart, see ``file_fingerprints``; ``lines`` for files over 2 GB."""
        self.spark, self.root, self.input_dir, self.fingerprints = spark, root.rstrip("/"), input_dir.rstrip("/"), fingerprints
        self.mart = PublishedMart(spark, f"{self.root}/publish")

    # raw layer

    def _issued(self) -> tuple[DataFrame, int]:
        """All batches that ever got an id, with ``live``, and the number of this registry version.

        The versions are stored below the root, so another process goes on where this one ended.
        """
        try:
            every = self.spark.read.schema(f"{REGISTRY}, live boolean, version int").parquet(f"{self.root}/raw/registry")
            newest = every.agg(F.max("version")).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            newest = None
        if newest is None:
            return values(self.spark, [], f"{REGISTRY}, live boolean"), 0
        return every.where(F.col("version") == newest).drop("version"), newest

    def registry(self) -> DataFrame:
        """Batches now loaded: the live ones of the newest registry version."""
        return self._issued()[0].where("live").drop("live")

    def manifest(self, scenario: str) -> DataFrame:
        """Files of a scenario in manifest order."""
        path = f"{self.input_dir}/manifests/{scenario}.json"
        doc = self.spark.read.schema(MANIFEST).option("multiLine", True).option("mode", "FAILFAST").json(path)
        return doc.select(F.lit(scenario).alias("scenario"), F.posexplode("files").alias("i", "f")).select(
            F.col("f.path").alias("file_path"), F.col("f.entity").alias("entity"),
            F.col("f.source_system").alias("source_system"), (F.col("i") + 1).alias("batch_seq"), "scenario")

    def _relative(self, file: str = "file"):
        """Path below the input folder, however the file system spells its absolute form."""
        return F.substring_index(F.col(file), f"{self.input_dir.split('://')[-1].lstrip('/')}/", -1)

    def load_raw(self, scenario: str, run_id: str) -> DataFrame:
        """Load new batches, skip known ones, drop unlisted ones; returns the actions taken.

        A manifest names files, so its rows may pass through the driver as paths do in every read.
        """
        manifest = self.manifest(scenario)
        issued, version = self._issued()
        known = issued.where("live").drop("live")
        listed = [f"{self.input_dir}/{r['file_path']}" for r in manifest.select("file_path").distinct().collect()]
        found = files.file_fingerprints(self.spark, listed, self.fingerprints).select(
            self._relative().alias("file_path"), F.col("sha256").alias("file_sha256"), "row_count")
        plan_path = work_path(self.spark, "batch-plan")
        files.plan_batches(manifest, known, found).write.parquet(plan_path)
        plan = self.spark.read.parquet(plan_path)
        after = work_path(self.spark, "registry")
        files.apply_batches(plan, known, run_id, issued).write.parquet(after)
        registry = self.spark.read.schema(REGISTRY).parquet(after)
        new = registry.join(plan.where("action = 'load'").select(*files.BATCH_KEY), files.BATCH_KEY, "left_semi")
        fresh = [f"{self.input_dir}/{r['file_path']}" for r in new.select("file_path").distinct().collect()]
        if fresh:
            lines = files.read_envelopes(self.spark, fresh).withColumn("file", self._relative())
            rows = files.raw_rows(lines, new).hint("rebalance", "entity", "batch_id")
            # only the folders of these batches are replaced, so a repeated attempt adds nothing twice
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("entity", "batch_id").parquet(f"{self.root}/raw/rows"))
        # only now do the new rows count; ids of dropped batches are kept and never given again
        gone = issued.join(registry.select("batch_id"), "batch_id", "left_anti").select(*registry.columns, F.lit(False).alias("live"))
        (registry.withColumn("live", F.lit(True)).unionByName(gone).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/raw/registry/version={version + 1}"))
        return plan

    def raw(self) -> dict[str, DataFrame]:
        """Raw rows of the registered batches per entity, and the registry itself."""
        batches = self.registry()
        schema = ("line_no bigint, source_system string, envelope variant, payload variant, "
                  "payload_hash string, entity string, batch_id bigint")
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/raw/rows")
        rows = rows.join(batches.select("batch_id"), "batch_id", "left_semi")
        return {"batches": batches, **{e: rows.where(F.col("entity") == e).drop("entity") for e in files.ENTITIES}}

    def drop_superseded(self, runs: Sequence[str] = ()) -> dict[str, list]:
        """Deletes what no reader of the newest state asks for: rows of dropped batches, publications without a day left, and
        the layers of the runs named. Returns what went; for a moment in which no run is under way."""
        gone = [r["batch_id"] for r in self._issued()[0].where("not live").select("batch_id").distinct().collect()]  # as many as files ever listed
        for batch in gone:
            for entity in files.ENTITIES:
                remove_folder(f"{self.root}/raw/rows/entity={entity}/batch_id={batch}")
        for run in runs:
            remove_folder(f"{self.root}/{run}")
        return {"batches": sorted(gone), "publications": self.mart.drop_superseded(), "runs": list(runs)}

    # layers

    def _kept(self, name: str, df: DataFrame, run: str, by: str | None = None) -> DataFrame:
        """Write a layer table, in partitions of ``by`` if named, and go on from what was written."""
        path = f"{self.root}/{run}/{name}"
        if by:
            write_partitioned(df, path, by)
        else:
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def build(self, start, end, run_id: str, run: str | None = None) -> dict[str, DataFrame]:
        """All relations of a run; staging stays a view, later layers are tables in the folder ``run``."""
        run = run or f"runs/{work_path(self.spark, 'run')[-32:]}"
        ctx: dict[str, DataFrame] = dict(self.raw())
        ctx |= staging(ctx)
        ctx |= {n: self._kept(n, df, run) for n, df in current_state(ctx).items()}
        ctx |= {n: self._kept(n, df, run) for n, df in dimensions(ctx).items()}
        # a slice reads the years that it lies in
        fact = facts(ctx, ctx)["fact_shot"].withColumn(FACT_YEAR, F.year("match_date"))
        ctx["fact_shot"] = self._kept("fact_shot", fact, run, FACT_YEAR)
        mart = mart_team_day(fact_years(ctx["fact_shot"], start, end), ctx["dim_team"], ctx["dim_match"], start, end, run_id)
        ctx["mart"] = self._kept("mart", mart, run)
        return ctx

    def run(self, scenario: str, start, end, run_id: str) -> Run:
        """Load, build, test and publish the slice; failed rules leave the published mart as it was."""
        lo, hi = slice_bounds(start, end)
        actions = self.load_raw(scenario, run_id)
        folder = f"runs/{work_path(self.spark, 'run')[-32:]}"
        ctx = self.build(lo, hi, run_id, folder)
        tests = rules(ctx, lo, hi)
        path = f"{self.root}/audit/report-{work_path(self.spark, 'r')[-32:]}"
        q.run_rules(ctx, tests).write.parquet(path)
        report = self.spark.read.parquet(path)
        failed = q.gate(report)
        # the violators of failed rules stay readable; one folder for each rule that failed
        kept = {r.name: store_failures(r, ctx, path.replace("/report-", "/failures-")) for r in tests if r.name in set(failed)}
        try:
            done = self.mart.publish(ctx["mart"], lo, hi, run_id, scenario, report)
        except PublicationRefused:
            done = None
        return Run(ctx, tests, report, failed, done, actions, kept, folder)
