"""Quality split, contract metrics, the rule library and the violator queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicemill.functions.aggregates import count_where, distinct_keys, invalid_count
from slicemill.functions.columns import by_side, first_label, holds, in_set, is_blank, out_of_range
from slicemill.operators.history import mark_duplicates, overlapping_versions, versions_per_event
from slicemill.operators.relations import compare_totals, groups_where, orphans

ERROR, WARN = "error", "warn"


class QualityError(ValueError):
    """Input that breaks its contract."""


# --- quality split -----------------------------------------------------------------------------

def tag_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]], key: Sequence[str]) -> DataFrame:
    """Add ``reject_reason``: the first rule that holds, else duplicate_key, else NULL.

    Copies are counted over all rows, so the valid twin of an invalid row is a duplicate as well.
    """
    tagged = mark_duplicates(df, key, "_duplicate")
    reasons = [*rules, ("duplicate_key", F.col("_duplicate"))]
    return tagged.withColumn("reject_reason", first_label(reasons)).drop("_duplicate")


def split_valid(df: DataFrame, rules: Sequence[tuple[str, Column]], key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reject_reason); the two parts always add up to the input."""
    tagged = tag_rejects(df, rules, key)
    accepted = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, tagged.where(F.col("reject_reason").isNotNull())


def reject_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("count"))


# --- contract in one pass ----------------------------------------------------------------------

def contract_violation(required: Sequence[str], conditions: Sequence[Column]) -> Column:
    """Row predicate: a required column is missing or blank, or one of the conditions holds."""
    bad = F.lit(False)
    for c in required:
        bad = bad | is_blank(c)
    for cond in conditions:
        bad = bad | holds(cond)
    return bad


def contract_metrics(df: DataFrame, key: Sequence[str], bad: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), distinct_keys(*key).alias("unique_ids"),
                  invalid_count(bad).alias("invalid_rows"))


def validate(df: DataFrame, key: Sequence[str], bad: Column) -> int:
    """Rows of a valid input; empty input, bad rows or repeated keys raise."""
    m = contract_metrics(df, key, bad).first()
    if m["rows"] == 0:
        raise QualityError("input has no rows")
    if m["invalid_rows"] or m["unique_ids"] != m["rows"]:
        raise QualityError(f"contract broken: {m.asDict()}")
    return m["rows"]


# --- rules -------------------------------------------------------------------------------------

@dataclass(frozen=True)
class RowRule:
    """Rows for which ``bad`` holds are violators; rules of one relation share a single pass."""
    name: str
    relation: str
    bad: Column
    severity: str = ERROR


@dataclass(frozen=True)
class QueryRule:
    """Every row of ``violators`` is a violation."""
    name: str
    relation: str
    violators: DataFrame = field(compare=False)
    severity: str = ERROR


@dataclass(frozen=True)
class GroupRule(QueryRule):
    """A rule on the groups of ``cols`` in ``table``; those of one table share a pass.

    Groups that ``asked`` leaves out are not looked at; a group is a violation if it has more than ``most`` rows.
    """
    table: DataFrame = field(compare=False, default=None)
    cols: tuple[str, ...] = ()
    asked: Column = field(compare=False, default=None)
    most: int = 1


def not_null(relation: str, col: str, severity: str = ERROR) -> RowRule:
    return RowRule(f"not_null_{relation}_{col}", relation, F.col(col).isNull(), severity)


def value_between(relation: str, col: str, lo, hi, severity: str = ERROR) -> RowRule:
    return RowRule(f"value_between_{relation}_{col}", relation, out_of_range(col, lo, hi), severity)


def row_condition(name: str, relation: str, bad: Column, severity: str = ERROR) -> RowRule:
    return RowRule(name, relation, bad, severity)


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key combinations held by more than one row."""
    return groups_where(df, cols, {"row_count": F.count(F.lit(1))}, F.col("row_count") > 1)


def unexpected_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Values outside the accepted list, one row each; NULL is not a value."""
    bad = df.where(F.col(col).isNotNull() & ~in_set(col, values))
    return bad.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))


def unique(relation: str, df: DataFrame, col: str, severity: str = ERROR) -> QueryRule:
    present = df.where(F.col(col).isNotNull())
    return GroupRule(f"unique_{relation}_{col}", relation, unique_combination(present, [col]), severity, df, (col,),
                     F.col(col).isNotNull())


def unique_key(relation: str, df: DataFrame, cols: Sequence[str], severity: str = ERROR) -> QueryRule:
    name = "_".join(["unique_combination", relation, *cols])
    return GroupRule(name, relation, unique_combination(df, cols), severity, df, tuple(cols), F.lit(True))


def accepted_values(relation: str, df: DataFrame, col: str, values: Sequence, severity: str = ERROR) -> QueryRule:
    return GroupRule(f"accepted_values_{relation}_{col}", relation, unexpected_values(df, col, values), severity, df, (col,),
                     F.col(col).isNotNull() & ~in_set(col, values), 0)


def relationships(relation: str, df: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str],
                  severity: str = ERROR) -> QueryRule:
    name = "_".join(["relationships", relation, *fk])
    return QueryRule(name, relation, orphans(df, fk, parent, pk), severity)


def violators(rule: RowRule | QueryRule, ctx: Mapping[str, DataFrame]) -> DataFrame:
    return ctx[rule.relation].where(holds(rule.bad)) if isinstance(rule, RowRule) else rule.violators


def run_rules(ctx: Mapping[str, DataFrame], rules: Sequence[RowRule | QueryRule]) -> DataFrame:
    """Report (rule, severity, status, failures), one row per rule, evaluated as a single job.

    All row rules of a relation become counters of one aggregate, and all rules on groups of a table
    one grouping by grouping sets, so a relation is read once for each kind however many rules there
    are; the other rules are counted where they run.
    """
    by_relation: dict[str, list[RowRule]] = {}
    by_table: dict[int, list[GroupRule]] = {}
    parts: list[DataFrame] = []
    for rule in rules:
        if isinstance(rule, RowRule):
            by_relation.setdefault(rule.relation, []).append(rule)
        elif isinstance(rule, GroupRule):
            by_table.setdefault(id(rule.table), []).append(rule)
        else:
            parts.append(rule.violators.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("severity"), "failures"))
    for relation, group in by_relation.items():
        counted = ctx[relation].agg(*[count_where(r.bad).alias(f"r{i}") for i, r in enumerate(group)])
        lines = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                          F.col(f"r{i}").alias("failures")) for i, r in enumerate(group)]
        parts.append(counted.select(F.inline(F.array(*lines))))
    parts += [group_failures(group) for group in by_table.values()]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    bad = F.when(F.col("severity") == ERROR, "fail").otherwise("warn")
    status = F.when(F.col("failures") == 0, "pass").otherwise(bad)
    return report.select("rule", "severity", status.alias("status"), "failures")


def group_failures(rules: Sequence[GroupRule]) -> DataFrame:
    """(rule, severity, failures) of rules on one table, in one scan and one shuffle of their typed keys.

    Each set of columns is a grouping set of one grouping; rules of the same columns share theirs. What a rule does
    not ask for is not counted in its groups.
    """
    table = rules[0].table
    cols = list(dict.fromkeys(c for r in rules for c in r.cols))
    sets = list(dict.fromkeys(tuple(c for c in cols if c in r.cols) for r in rules))
    marked = table.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(cols)], *[holds(r.asked).alias(f"_a{i}") for i, r in enumerate(rules)])
    # a row that no rule asks for is not spread over the sets
    marked = marked.where(reduce(lambda x, y: x | y, [F.col(f"_a{i}") for i in range(len(rules))]))
    names = {c: f"_g{i}" for i, c in enumerate(cols)}
    sizes = marked.groupingSets([[F.col(names[c]) for c in s] for s in sets], *[F.col(n) for n in names.values()])
    sizes = sizes.agg(F.grouping_id().alias("_set"), *[F.count_if(F.col(f"_a{i}")).alias(f"_n{i}") for i in range(len(rules))])
    # the grouping id has a bit for each column that a set leaves out, the first column highest
    ids = {s: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for s in sets}
    own = [ids[tuple(c for c in cols if c in r.cols)] for r in rules]
    counted = sizes.agg(*[F.count_if((F.col("_set") == own[i]) & (F.col(f"_n{i}") > r.most)).alias(f"_f{i}") for i, r in enumerate(rules)])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"_f{i}").alias("failures")) for i, r in enumerate(rules)])))


def gate(report: DataFrame) -> list[str]:
    """Names of the failed error-severity rules; publication is allowed when there are none.

    The report has one row per rule, so its size does not depend on the data.
    """
    return [r["rule"] for r in report.where("status = 'fail'").orderBy("rule").collect()]


def failing_samples(ctx: Mapping[str, DataFrame], rules: Sequence[RowRule | QueryRule],
                    failed: Sequence[str], n: int = 10) -> dict[str, DataFrame]:
    """A few violators of each failed rule, for the diagnosis printed after a refused run."""
    return {r.name: violators(r, ctx).limit(n) for r in rules if r.name in set(failed)}


# --- business assertions (each returns violators) ----------------------------------------------

def goals_not_exceed_score(fact: DataFrame, matches: DataFrame) -> DataFrame:
    """Teams whose goals from shots in play exceed their official score of the match."""
    goals = (fact.where(~F.col("is_shootout")).groupBy("source_system", "match_key", "team_id")
             .agg(count_where(F.col("is_goal")).alias("goals_from_shots")))
    m = matches.select("match_key", "match_id", "match_date", "home_team_id", "home_team_name",
                       "away_team_name", "home_score", "away_score")
    out = goals.join(m, "match_key", "inner").select(
        "source_system", "match_id", "match_date", "team_id",
        by_side("team_id", "home_team_id", "home_team_name", "away_team_name").alias("team_name"),
        "goals_from_shots",
        by_side("team_id", "home_team_id", "home_score", "away_score").alias("team_score"))
    return out.where(F.col("goals_from_shots") > F.col("team_score"))


def measure_order(mart: DataFrame) -> DataFrame:
    """Mart rows that break goals <= on target <= shots."""
    return mart.where(~((F.col("goals") <= F.col("shots_on_target")) & (F.col("shots_on_target") <= F.col("shots"))))


def mart_reconciles(fact_slice: DataFrame, mart: DataFrame, tolerance: str = "0.001") -> DataFrame:
    """One row when the mart's sums differ from the fact's sums over the slice, else none.

    ``fact_slice`` is the fact in play restricted to the slice.
    """
    zero = F.lit(0).cast("bigint")
    f = fact_slice.agg(F.count(F.lit(1)).alias("fact_shots"),
                       count_where(F.col("is_goal")).alias("fact_goals"),
                       F.round(F.sum("xg"), 4).alias("fact_xg"))
    m = mart.agg(F.coalesce(F.sum("shots"), zero).alias("mart_shots"),
                 F.coalesce(F.sum("goals"), zero).alias("mart_goals"),
                 F.coalesce(F.round(F.sum("xg"), 4), F.lit(0)).alias("mart_xg"))
    off = F.abs(F.col("fact_xg") - F.col("mart_xg")) > F.lit(tolerance).cast("decimal(10,4)")
    both = compare_totals(f, m).where(
        (F.col("fact_shots") != F.col("mart_shots")) | (F.col("fact_goals") != F.col("mart_goals")) | off)
    return both.select("fact_shots", "mart_shots", "fact_goals", "mart_goals", "fact_xg", "mart_xg")


def one_version_per_shot(shots: DataFrame, matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Shots for which not exactly one team version is valid on the match date.

    Works from the current shots and the dimension, independently of the fact table.
    """
    dated = shots.select("source_system", "event_id", "match_id", "team_id", "team_name").join(
        matches.select("source_system", "match_id", "match_date"), ["source_system", "match_id"], "inner")
    return versions_per_event(dated, teams, ["source_system", "team_id"], "match_date",
                              "team_version_key", "manager_name")


def valid_intervals(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("valid_from") >= F.col("valid_to"))


def no_overlap(teams: DataFrame) -> DataFrame:
    return overlapping_versions(teams, ["source_system", "team_id"], "team_version_key",
                                ["team_name", "manager_name"])


def grain_check(fact: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Number of groups and how many of them hold more than one distinct ``col``.

    Smallest and largest value tell one from several, so no distinct count is needed.
    """
    groups = fact.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    return groups.agg(F.count(F.lit(1)).alias("groups"),
                      count_where(F.col("_lo") != F.col("_hi")).alias("groups_with_several"))
