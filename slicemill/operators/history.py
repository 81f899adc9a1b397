"""Versions, observations, slowly changing dimensions and validity joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slicemill.functions.aggregates import ordered_concat
from slicemill.functions.columns import (
    OPEN_END, date_key, day_name, iso_day_of_week, null_safe_key, order_columns, surrogate_key,
)
from slicemill.operators.relations import both_sides, explode_keep


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key under ``order`` (``"version desc"``, ...), which should be total.

    Nothing but ``row_number() = 1`` is asked of the window, so Spark limits the groups before the
    shuffle as well: a task sends at most one row per key, however many copies a hot key has.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_columns(order)))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   payload_hash: str | None = None) -> DataFrame:
    """Newest version per key with ``raw_copies`` and, given a hash, ``variants_same_version``.

    ``order[0]`` is the version, newest first; the rest break ties. Counts over the key would keep
    the window from limiting its groups early, so they are taken by aggregates over narrow columns:
    the different contents per (key, version, hash) and their copies, then per (key, version), then
    per key. Wide rows are shuffled once, and both parts end partitioned by the same key struct, so
    joining them adds no shuffle. A hash of the key goes before it: the sorts then compare one number
    and open the structs only where it is equal.
    """
    key = ["_hash", "_key"]
    keyed = df.withColumns({"_hash": F.xxhash64(*keys), "_key": null_safe_key(*keys)})
    newest = first_per_key(keyed, key, order)
    if payload_hash is None:
        counts = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("raw_copies"))
        return newest.join(counts, key).drop(*key)
    version = order[0].split()[0]
    contents = keyed.groupBy(*key, version, payload_hash).agg(F.count(F.lit(1)).alias("_n"))
    per_version = contents.groupBy(*key, version).agg(F.count(F.lit(1)).alias("_v"), F.sum("_n").alias("_n"))
    undated = F.max(F.when(F.col(version).isNull(), F.col("_v")))
    counts = per_version.groupBy(*key).agg(
        F.sum("_n").alias("raw_copies"),
        F.coalesce(undated, F.max_by("_v", version)).alias("variants_same_version"))
    return newest.join(counts, key).drop(*key)


def latest_attr(df: DataFrame, keys: Sequence[str], attrs: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``distinct on (keys) ... order by``: the attributes of the first row per key (SCD1)."""
    names = [o.split()[0] for o in order]
    narrow = df.select(*dict.fromkeys([*keys, *attrs, *names]))
    return first_per_key(narrow, keys, order).select(*dict.fromkeys([*keys, *attrs]))


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Dictionary built from several files in order: a later entry replaces an earlier one."""
    return first_per_key(df, key, [f"{o} desc" for o in order])


def mark_duplicates(df: DataFrame, keys: Sequence[str], name: str = "is_duplicate") -> DataFrame:
    """Flag every copy of a repeated key.

    Only keys seen more than once go into the join, already one row each; the copies of a hot key
    stay spread, since the skew-join rule may split the row side of a left join.
    """
    keyed = df.withColumn("_key", null_safe_key(*keys))
    repeated = (keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                .select("_key", F.lit(True).alias(name)))
    return (keyed.join(repeated, "_key", "left").drop("_key")
            .withColumn(name, F.coalesce(F.col(name), F.lit(False))))


# --- observations and SCD2 ---------------------------------------------------------------------

def observations(matches: DataFrame) -> DataFrame:
    """Team, manager and match date for both sides; no manager gives a row with NULL manager.

    ``home_managers`` / ``away_managers`` are arrays of (id, name).
    """
    cols = {"team_id": "{}_team_id", "team_name": "{}_team_name", "managers": "{}_managers"}
    sides = both_sides(matches, {k: v.format("home") for k, v in cols.items()},
                       {k: v.format("away") for k, v in cols.items()},
                       ["source_system", "match_id", "match_date"])
    flat = explode_keep(sides, "managers", "m")
    return flat.select("source_system", "team_id", "team_name", "match_id", "match_date",
                       F.col("m.id").cast("bigint").alias("manager_id"), F.col("m.name").alias("manager_name"))


def with_next_start(versions: DataFrame, entity: Sequence[str], first="first_seen", last="last_seen") -> DataFrame:
    """``versions`` with ``next_start``: the first start of any version of the entity after the version's last day.

    A start later than a version's last day belongs to another version, so the correlated minimum is the next start on the
    entity's time line. Every version is put on it twice, where it starts and where it was last seen; the frame runs from the
    newest day down to the day after the row's own, so it is a running minimum. Versions, not observations, are sorted
    per entity, and the sort spills.
    """
    entity = list(entity)
    rest = [c for c in versions.columns if c not in entity]
    none = F.lit(None).cast("date")
    row = F.struct(*rest)
    line = versions.select(*entity, F.inline(F.array(
        F.struct(F.col(first).alias("_day"), F.col(first).alias("_start"), F.when(F.lit(False), row).alias("_row")),
        F.struct(F.col(last).alias("_day"), none.alias("_start"), row.alias("_row")))))
    later = Window.partitionBy(*entity).orderBy(F.unix_date("_day").desc()).rangeBetween(Window.unboundedPreceding, -1)
    line = line.withColumn("next_start", F.min("_start").over(later))
    return line.where(F.col("_row").isNotNull()).select(*entity, "_row.*", "next_start")


def next_start(versions: DataFrame, entity: Sequence[str], first="first_seen", last="last_seen") -> DataFrame:
    """For each (entity, last day) the first start of any version after that day."""
    found = with_next_start(versions.select(*entity, first, last), entity, first, last)
    return found.select(*entity, last, "next_start").distinct()


def spans(obs: DataFrame, entity: Sequence[str], attr: str, date: str, attr_name: str | None = None) -> DataFrame:
    """First and last day of each (entity, attribute value), and its greatest name: what can be merged with other spans."""
    aggs = [F.min(date).alias("first_seen"), F.max(date).alias("last_seen")]
    if attr_name:
        aggs.insert(0, F.max(attr_name).alias(attr_name))
    return obs.groupBy(*entity, attr).agg(*aggs)


def versions_of_spans(found: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Spans as versions with ``[valid_from, valid_to)``, open where no version starts after the last day seen."""
    out = with_next_start(found, entity)
    out = out.select(*found.columns, F.coalesce("next_start", F.lit(OPEN_END)).alias("valid_to"))
    return out.withColumnsRenamed({"first_seen": "valid_from", "last_seen": "last_observed_on"})


def scd2_from_observations(obs: DataFrame, entity: Sequence[str], attr: str, date: str,
                           attr_name: str | None = None) -> DataFrame:
    """One version per (entity, attribute value) with ``[valid_from, valid_to)``.

    valid_from is the first day seen; valid_to is the first start of another version after the last
    day seen, else the open end. Values seen on the same days give overlapping versions on purpose.
    A NULL value is a version of its own.
    """
    return versions_of_spans(spans(obs, entity, attr, date, attr_name), entity)


def dim_team(obs: DataFrame) -> DataFrame:
    """Team dimension: SCD2 over the manager, latest spelling of the team name."""
    entity = ["source_system", "team_id"]
    versions = scd2_from_observations(obs, entity, "manager_id", "match_date", "manager_name")
    names = latest_attr(obs, entity, ["team_name"], ["match_date desc", "match_id desc"])
    return versions.join(names, entity, "inner").select(
        surrogate_key(*entity, "manager_id", "valid_from").alias("team_version_key"),
        surrogate_key(*entity).alias("team_nk"),
        *entity, "team_name", "manager_id", "manager_name", "valid_from", "valid_to", "last_observed_on")


# --- validity joins ----------------------------------------------------------------------------

def _slotted(points: DataFrame, versions: DataFrame, keys: Sequence[str], date: str, start: str,
             end: str) -> tuple[DataFrame, DataFrame]:
    """Points and versions with the calendar year (``_slot``) to join on besides the entity.

    A version is repeated once per year that it shares with any point, so an open end reaches no further than the
    points do, and a point meets the versions of its entity's year only.
    """
    lo, hi = points.agg(F.min(date)).scalar(), points.agg(F.max(date)).scalar()
    first, last = F.greatest(F.col(start), lo), F.least(F.date_sub(F.col(end), 1), hi)
    met = versions.where((F.col(start) < F.col(end)) & (first <= last))
    return points.withColumn("_slot", F.year(date)), met.withColumn("_slot", F.explode(F.sequence(F.year(first), F.year(last))))


def valid_on(points: DataFrame, versions: DataFrame, keys: Sequence[str], date: str,
             start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Every version valid on each distinct (entity, day) point; points without a version drop out."""
    keys = list(keys)
    points = points.select(*keys, date).dropna().distinct()
    slotted, slots = _slotted(points, versions, keys, date, start, end)
    met = slotted.join(slots, [*keys, "_slot"], "inner")
    return met.where((F.col(date) >= F.col(start)) & (F.col(date) < F.col(end))).drop("_slot")


def join_valid_at(fact: DataFrame, versions: DataFrame, keys: Sequence[str], date: str,
                  take: Sequence[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Left join of facts to the version(s) valid on the event date; an overlap fans out.

    Facts and versions are each dealt once, by entity and year; a hot entity's facts may be split by the skew rule.
    Where an entity has very many versions a year, ``sweep.sweep_join`` tries none in vain. Columns: those of the fact that are
    not taken, then ``take``; a taken column replaces one of the fact of the same name.
    """
    keys = list(keys)
    names = dict.fromkeys([start, end, *take])
    narrow = versions.select(*[F.col(c).alias(f"_k_{c}") for c in keys], *[F.col(c).alias(f"_v_{c}") for c in names])
    kept = [c for c in fact.columns if c not in take]
    facts, slots = _slotted(fact.select(*kept), narrow, [f"_k_{c}" for c in keys], date, f"_v_{start}", f"_v_{end}")
    on = [F.col(c) == F.col(f"_k_{c}") for c in keys] + [facts["_slot"] == slots["_slot"]]
    on += [F.col(date) >= F.col(f"_v_{start}"), F.col(date) < F.col(f"_v_{end}")]
    return facts.join(slots, on, "left").select(*kept, *[F.col(f"_v_{c}").alias(c) for c in take])


def overlapping_versions(versions: DataFrame, keys: Sequence[str], version_key: str, take: Sequence[str] = (),
                         start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Pairs of versions of one entity whose half-open intervals intersect, each pair once.

    Two intervals intersect only if the later start lies inside the other one, so starts are looked up
    in the intervals of their year instead of comparing all pairs of the entity.
    """
    keys = list(keys)
    cols = list(dict.fromkeys([version_key, start, end, *take]))
    a = versions.select(*keys, *[F.col(c).alias(f"{c}_x") for c in cols])
    b = versions.select(*keys, *[F.col(c).alias(f"{c}_y") for c in cols])
    starts, slots = _slotted(b, a, keys, f"{start}_y", f"{start}_x", f"{end}_x")
    x_from, x_to, y_from, y_to = (F.col(c) for c in (f"{start}_x", f"{end}_x", f"{start}_y", f"{end}_y"))
    x_key, y_key = F.col(f"{version_key}_x"), F.col(f"{version_key}_y")
    pairs = slots.join(starts, [*keys, "_slot"], "inner").where(
        (y_from >= x_from) & (y_from < x_to) & (x_from < y_to)
        & ((y_from > x_from) & (x_key != y_key) | (x_key < y_key)))
    x_first = x_key < y_key
    out = [F.when(x_first, F.col(f"{c}_{p}")).otherwise(F.col(f"{c}_{q}")).alias(f"{c}_{side}")
           for side, p, q in (("a", "x", "y"), ("b", "y", "x")) for c in cols]
    return pairs.select(*keys, *out)


def versions_per_event(events: DataFrame, versions: DataFrame, keys: Sequence[str], date: str,
                       version_key: str, label: str,
                       start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Events with no or more than one valid version, with the count and the ordered version labels."""
    narrow = versions.select(*dict.fromkeys([*keys, start, end, version_key, label]))
    found = valid_on(events, narrow, keys, date, start, end)
    counts = found.groupBy(*keys, date).agg(
        F.count(version_key).alias("versions_on_event_date"),
        ordered_concat(F.col(label), F.struct(start, version_key)).alias("managers"))
    joined = events.join(counts, [*keys, date], "left")
    n = F.coalesce(F.col("versions_on_event_date"), F.lit(0))
    return joined.withColumn("versions_on_event_date", n).where(n != 1)


def calendar(df: DataFrame, col: str) -> DataFrame:
    """Calendar days between the first and the last date of the data."""
    span = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    days = span.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("calendar_date"))
    d = F.col("calendar_date")
    return days.select(date_key(d).alias("date_key"), d, F.year(d).alias("year"), F.month(d).alias("month"),
                       iso_day_of_week(d).alias("iso_day_of_week"), day_name(d).alias("day_name"))
