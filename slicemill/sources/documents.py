"""Nested source documents flattened to rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


WEATHER_DOC = ("hourly struct<time: array<string>, temperature_2m: array<double>, "
               "relative_humidity_2m: array<double>, precipitation: array<double>, wind_speed_10m: array<double>>")


def flatten_parallel_arrays(df: DataFrame, anchor: Column, cols: Mapping[str, Column]) -> DataFrame:
    """One row per element of ``anchor`` with the elements of the parallel arrays beside it.

    The anchor alone decides the rows: an absent or shorter array gives NULLs, what a longer one has
    beyond it is not read. Names: ``anchor`` and the keys of ``cols``; the other columns of ``df``
    are carried along.
    """
    rows = F.transform(anchor, lambda a, i: F.struct(a.alias("anchor"), *[F.get(c, i).alias(n) for n, c in cols.items()]))
    zipped = df.select(*df.columns, F.explode(rows).alias("_e"))
    return zipped.select(*df.columns, *[F.col("_e").getItem(n).alias(n) for n in ["anchor", *cols]])


def flatten_weather(docs: DataFrame) -> DataFrame:
    """Hourly weather documents (city, latitude, longitude, hourly) as typed rows."""
    h = F.col("hourly")
    flat = flatten_parallel_arrays(docs, h["time"], {
        "temperature_2m": h["temperature_2m"], "relative_humidity_2m": h["relative_humidity_2m"],
        "precipitation_mm": h["precipitation"], "wind_speed_10m": h["wind_speed_10m"]})
    ts = F.concat(F.replace(F.col("anchor"), F.lit("T"), F.lit(" ")), F.lit(":00"))
    return flat.select(
        "city", "latitude", "longitude", ts.cast("timestamp").alias("event_ts"),
        F.left(F.col("anchor"), F.lit(10)).cast("date").alias("event_date"),
        F.col("temperature_2m").cast("decimal(5,2)").alias("temperature_2m"),
        F.col("relative_humidity_2m").cast("decimal(5,2)").alias("relative_humidity_2m"),
        F.col("precipitation_mm").cast("decimal(6,2)").alias("precipitation_mm"),
        F.col("wind_speed_10m").cast("decimal(6,2)").alias("wind_speed_10m"))


def read_json_documents(spark: SparkSession, path: str | list[str], schema) -> DataFrame:
    """Whole JSON documents (one array or object per file) by explicit schema, with their path."""
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return df.select("*", F.col("_metadata.file_path").alias("file"))


def match_id_of(file: str | Column = "file") -> Column:
    """Match id from an event file's path ``events/<id>.json``."""
    file = F.col(file) if isinstance(file, str) else file
    return F.regexp_extract(file, r"events/(\d+)\.", 1).cast("bigint")


def flatten_matches(docs: DataFrame, skip_stage: str | None = "Group Stage") -> DataFrame:
    """Nested match documents as flat rows, without the group stage, ordered by date and id; no stage is kept."""
    flat = docs.select(
        F.col("match_id").cast("bigint").alias("match_id"), F.col("match_date").cast("date").alias("match_date"),
        F.col("competition.competition_id").cast("int").alias("competition_id"),
        F.col("competition.competition_name").alias("competition_name"),
        F.col("season.season_id").cast("int").alias("season_id"), F.col("season.season_name").alias("season_name"),
        F.col("competition_stage.name").alias("stage_name"),
        F.col("home_team.home_team_id").cast("bigint").alias("home_team_id"),
        F.col("home_team.home_team_name").alias("home_team_name"),
        F.col("away_team.away_team_id").cast("bigint").alias("away_team_id"),
        F.col("away_team.away_team_name").alias("away_team_name"),
        F.col("home_score").cast("int").alias("home_score"), F.col("away_score").cast("int").alias("away_score"),
        F.col("last_updated").cast("timestamp_ntz").alias("last_updated"))
    if skip_stage is not None:
        flat = flat.where(~F.col("stage_name").eqNullSafe(skip_stage))
    return flat.orderBy("match_date", "match_id")


def extract_shots(events: DataFrame, matches: DataFrame, source: str) -> DataFrame:
    """Shots among the events of each match, with the match's date and version.

    ``events``: match_id plus the nested event; a shot without xG keeps a NULL. ``index`` gives the
    order of events inside a match.
    """
    shots = events.where(F.col("type.name") == "Shot")
    m = matches.select("match_id", "match_date", F.col("last_updated").alias("version"))
    return shots.join(m, "match_id", "inner").select(
        F.lit(source).alias("source_system"), F.lower("id").alias("event_id"), "match_id", "match_date", "version",
        "index", F.col("team.id").alias("team_id"), F.col("team.name").alias("team_name"),
        F.col("player.id").alias("player_id"), F.col("player.name").alias("player_name"),
        F.col("period").cast("smallint").alias("period"), F.col("minute").cast("smallint").alias("minute"),
        F.col("second").cast("smallint").alias("second"), F.col("shot.type.name").alias("shot_type"),
        F.col("shot.outcome.name").alias("outcome"), F.col("shot.body_part.name").alias("body_part"),
        F.col("shot.statsbomb_xg").cast("decimal(12,10)").alias("xg"))
