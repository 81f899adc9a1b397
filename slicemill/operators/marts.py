"""Team-by-day marts and the analytic queries on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicemill.functions.aggregates import count_where
from slicemill.functions.columns import by_side, date_slice, per_unit, slice_bounds, stamp

MART_KEY = ["source_system", "team_id", "match_date"]
# Columns of the published mart, in order.
MART_COLS = ["match_date", "date_key", "source_system", "team_id", "team_name", "manager_name",
             "competition_name", "stage_name", "match_id", "opponent_name", "team_score", "shots",
             "shots_on_target", "goals", "penalty_goals", "xg", "goals_minus_xg"]


def shot_measures() -> list[Column]:
    """The additive measures of a set of shots."""
    return [F.count(F.lit(1)).alias("shots"),
            count_where(F.col("is_on_target")).alias("shots_on_target"),
            count_where(F.col("is_goal")).alias("goals"),
            count_where(F.col("is_goal") & F.col("is_penalty")).alias("penalty_goals"),
            F.sum("xg").alias("xg")]


def in_play(fact: DataFrame, start, end) -> DataFrame:
    """Shots of the slice without the shoot-out."""
    return date_slice(fact.where(~F.col("is_shootout")), "match_date", start, end)


def mart_team_day(fact: DataFrame, teams: DataFrame, matches: DataFrame, start, end, run_id: str) -> DataFrame:
    """Mart candidate: team by match day in the slice, stamped with the run parameters.

    Shots are folded to one row per (team version, match, day) before the dimensions are joined, so
    the joins move the mart and not the fact. Measures are additive and summed again afterwards,
    which keeps a dimension that repeats a key visible as a multiplied measure.
    """
    lo, hi = slice_bounds(start, end)
    small = in_play(fact, lo, hi).groupBy(
        "match_date", "date_key", "source_system", "team_id", "team_version_key", "match_key").agg(*shot_measures())
    t = teams.select("team_version_key", "team_name", "manager_name")
    m = matches.select("match_key", "competition_name", "stage_name", "match_id", "home_team_id",
                       "home_team_name", "away_team_name", "home_score", "away_score")
    wide = small.join(t, "team_version_key", "inner").join(m, "match_key", "inner").withColumns({
        "opponent_name": by_side("team_id", "home_team_id", "away_team_name", "home_team_name"),
        "team_score": by_side("team_id", "home_team_id", "home_score", "away_score")})
    dims = MART_COLS[:11]
    sums = wide.groupBy(*dims).agg(*[F.sum(c).alias(c) for c in
                                     ("shots", "shots_on_target", "goals", "penalty_goals", "xg")])
    mart = sums.select(*dims, "shots", "shots_on_target", "goals", "penalty_goals",
                       F.round("xg", 4).alias("xg"),
                       F.round(F.col("goals") - F.col("xg"), 4).alias("goals_minus_xg"))
    return stamp(mart, lo, hi, run_id)


def team_day(fact: DataFrame, source: str, start, end, keys_only: DataFrame | None = None,
             sort: bool = True) -> DataFrame:
    """Mart straight from the fact for one source and slice, unrounded and ordered.

    ``keys_only`` restricts the fact to a control list of matches.
    """
    rows = in_play(fact.where(F.col("source_system") == source), start, end)
    if keys_only is not None:
        rows = rows.join(keys_only.select("match_id"), "match_id", "left_semi")
    out = (rows.groupBy(*MART_KEY).agg(*shot_measures())
           .withColumn("goals_minus_xg", F.col("goals") - F.col("xg")))
    return out.orderBy("match_date", "team_id") if sort else out


# --- queries on the published mart -------------------------------------------------------------

def day_detail(mart: DataFrame, day) -> DataFrame:
    return mart.where(F.col("match_date") == F.lit(day)).select(
        "match_date", "team_name", "manager_name", "opponent_name", "team_score", "shots", "shots_on_target",
        "goals", "penalty_goals", "xg", "goals_minus_xg").orderBy("team_name")


def day_totals(mart: DataFrame) -> DataFrame:
    return mart.groupBy("match_date").agg(
        F.min("competition_name").alias("competition"), F.min("stage_name").alias("stage"),
        F.count(F.lit(1)).alias("team_matches"), F.sum("shots").alias("shots"),
        F.sum("goals").alias("goals_from_shots"), F.sum("team_score").alias("goals_in_score"),
        F.round(F.sum("xg"), 2).alias("xg"),
        F.round(F.sum("goals") - F.sum("xg"), 2).alias("goals_minus_xg")).orderBy("match_date")


def manager_ratios(mart: DataFrame, teams: Sequence[str] | None = None) -> DataFrame:
    """Per team and manager: totals and per-match averages, ordered by the first day."""
    rows = mart if teams is None else mart.where(F.col("team_name").isin(list(teams)))
    n = F.col("matches")
    return (rows.groupBy("team_name", "manager_name").agg(
        F.count(F.lit(1)).alias("matches"), F.sum("shots").alias("shots"), F.sum("goals").alias("goals"),
        F.sum("xg").alias("_xg"), F.min("match_date").alias("_first"))
        .withColumns({"xg": F.round("_xg", 2), "xg_per_match": per_unit(F.col("_xg"), n),
                      "goals_per_match": per_unit(F.col("goals"), n)})
        .orderBy("team_name", "_first").drop("_xg", "_first"))


def top_finishers(mart: DataFrame, k: int = 5) -> DataFrame:
    """Teams with the largest goals minus xG; the name breaks ties."""
    out = mart.groupBy("team_name").agg(
        F.count(F.lit(1)).alias("matches"), F.sum("goals").alias("goals"),
        F.round(F.sum("xg"), 2).alias("xg"),
        F.round(F.sum("goals") - F.sum("xg"), 2).alias("goals_minus_xg"))
    return out.orderBy(F.col("goals_minus_xg").desc(), "team_name").limit(k)


def peak_hours(hourly: DataFrame, group: str, hour: str = "hour_of_day", value: str = "avg_value") -> DataFrame:
    """Daily amplitude of an hourly profile with its peak and trough hour (earliest on ties)."""
    return hourly.groupBy(group).agg(
        (F.max(value) - F.min(value)).alias("amplitude"),
        F.min_by(hour, F.struct(-F.col(value), F.col(hour))).alias("peak_hour"),
        F.min_by(hour, F.struct(F.col(value), F.col(hour))).alias("trough_hour"))
