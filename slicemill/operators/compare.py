"""Snapshots, tables and results compared by keys, rows and measures."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicemill.functions.aggregates import count_where, digest, distinct_keys, null_count, ordered_concat
from slicemill.functions.columns import ON_TARGET, changed, holds
from slicemill.operators.quality import QueryRule, RowRule, run_rules
from slicemill.operators.relations import both_sides, pair_snapshots, semi_subset, with_scalar


# --- set differences ---------------------------------------------------------------------------

def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with ``extra`` = copies in A minus copies in B.

    One shuffle for both directions of EXCEPT ALL: copies are folded to a signed count first, so a
    row repeated a billion times still moves once per task.
    """
    cols = a.columns
    signed = a.select(*cols, F.lit(1).alias("_sign")).unionByName(b.select(*cols, F.lit(-1).alias("_sign")))
    return signed.groupBy(*cols).agg(F.sum("_sign").alias("extra")).where("extra <> 0")


def except_all_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sizes of A EXCEPT ALL B and B EXCEPT ALL A, one row."""
    zero = F.lit(0).cast("bigint")
    d = multiset_diff(a, b)
    return d.agg(F.coalesce(F.sum(F.when(F.col("extra") > 0, F.col("extra"))), zero).alias("a_minus_b"),
                 F.coalesce(F.sum(F.when(F.col("extra") < 0, -F.col("extra"))), zero).alias("b_minus_a"))


def sym_diff(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None,
             labels: tuple[str, str] = ("only_in_A", "only_in_B")) -> DataFrame:
    """Distinct rows present on one side only, labelled with the side; one shuffle."""
    cols = list(cols or a.columns)
    tagged = a.select(*cols, F.lit(True).alias("_a")).unionByName(b.select(*cols, F.lit(False).alias("_a")))
    seen = tagged.groupBy(*cols).agg(F.bool_or("_a").alias("_in_a"), F.bool_and("_a").alias("_not_b"))
    one_sided = seen.where(F.col("_in_a") == F.col("_not_b"))
    return one_sided.select(F.when(F.col("_in_a"), labels[0]).otherwise(labels[1]).alias("side"), *cols)


def compare_by_key(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str],
                   tolerance: Mapping[str, str] | None = None) -> DataFrame:
    """Keys of two results that are missing in B, extra in B, or differ in a measure.

    Measures named in ``tolerance`` may differ by less than the given amount, others not at all.
    """
    tolerance = tolerance or {}
    l = a.select(*[F.col(k).alias(f"_ka{i}") for i, k in enumerate(keys)],
                 *[F.col(m).alias(f"a_{m}") for m in measures], F.lit(True).alias("_in_a"))
    r = b.select(*[F.col(k).alias(f"_kb{i}") for i, k in enumerate(keys)],
                 *[F.col(m).alias(f"b_{m}") for m in measures], F.lit(True).alias("_in_b"))
    on = [F.col(f"_ka{i}").eqNullSafe(F.col(f"_kb{i}")) for i in range(len(keys))]

    def differs(m: str) -> Column:
        x, y = F.col(f"a_{m}"), F.col(f"b_{m}")
        if m in tolerance:
            near = F.abs(x - y) < F.lit(tolerance[m]).cast("decimal(20,10)")
            return ~F.coalesce(near, x.isNull() & y.isNull())
        return ~x.eqNullSafe(y)

    different = differs(measures[0])
    for m in measures[1:]:
        different = different | differs(m)
    status = (F.when(F.col("_in_b").isNull(), "missing").when(F.col("_in_a").isNull(), "extra")
              .when(different, "different"))
    joined = l.join(r, on, "full_outer").withColumn("status", status).where(F.col("status").isNotNull())
    return joined.select(*[F.coalesce(f"_ka{i}", f"_kb{i}").alias(k) for i, k in enumerate(keys)],
                         "status", *[f"{s}_{m}" for m in measures for s in "ab"])


def changed_rows(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str],
                 show: Sequence[str] = ()) -> DataFrame:
    """Rows present in both snapshots whose ``cols`` changed, NULL-safe."""
    every = list(dict.fromkeys([*cols, *show]))
    pairs = pair_snapshots(a, b, keys, every)
    return pairs.where(changed([F.col(f"a_{c}") for c in cols], [F.col(f"b_{c}") for c in cols]))


# --- digests -----------------------------------------------------------------------------------

def content_checksum(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count and order-free digest of the relation, or of each group of ``by``."""
    aggs = [F.count(F.lit(1)).alias("rows"), digest(cols).alias("checksum")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def digest_of(df: DataFrame, id_: str, sha: str) -> DataFrame:
    """SHA-256 over the ``id:sha`` lines in id order: the digest of a manifest's digests.

    For manifests (one row per file or per group digest), not for data rows: the hash needs all
    lines in order. Spark already holds one entry per file on the driver when it lists them.
    """
    line = F.concat_ws(":", F.col(id_).cast("string"), F.col(sha))
    return df.agg(F.count(F.lit(1)).alias("ids"),
                  F.sha2(F.concat(ordered_concat(line, F.col(id_), "\n"), F.lit("\n")), 256).alias("digest"))


# --- profiles ----------------------------------------------------------------------------------

def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column as one row, in one pass."""
    return df.agg(*[null_count(c).alias(c) for c in cols or df.columns])


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type, rows and NULLs of every column: DESCRIBE joined with the NULL profile."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[null_count(c).alias(c) for c in df.columns])
    lines = [F.struct(F.lit(f.name).alias("col_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                      F.col("_rows").alias("rows"), F.col(f.name).alias("nulls")) for f in df.schema.fields]
    return one.select(F.inline(F.array(*lines)))


def filter_shares(df: DataFrame, predicates: Mapping[str, Column], date: str,
                  estimate: str | None = None) -> DataFrame:
    """Rows in total and under each predicate, first and last day, in one pass.

    ``estimate`` adds an approximate distinct count of that column, as planner statistics hold.
    """
    aggs = [F.count(F.lit(1)).alias("rows_total"),
            *[count_where(p).alias(n) for n, p in predicates.items()],
            F.min(date).alias("date_min"), F.max(date).alias("date_max")]
    if estimate:
        aggs.append(F.approx_count_distinct(estimate).alias("distinct_estimate"))
    return df.agg(*aggs)


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named layer."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("layer"), "rows")
             for n, df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def id_collisions(df: DataFrame, id_: str, source: str = "source_system") -> DataFrame:
    """Local ids used by several sources, with the rows that share them and the sorted sources.

    Rows are counted per (id, source) first; what is listed per id is the set of source names.
    """
    per_source = df.groupBy(id_, source).agg(F.count(F.lit(1)).alias("_n"))
    return (per_source.groupBy(id_).agg(
        F.sum("_n").alias("rows_with_same_local_id"), F.count(F.lit(1)).alias("_sources"),
        ordered_concat(F.col(source), F.col(source), ", ").alias("sources"))
        .where("_sources > 1").drop("_sources"))


def trace(current: DataFrame, staged: DataFrame, batches: DataFrame, raw: DataFrame,
          keys: Sequence[str], condition: Column, measure: str, version: str) -> DataFrame:
    """Lineage of suspicious current rows: every staged version with its file, line and envelope tag."""
    suspects = current.where(holds(condition)).select(*keys).distinct()
    versions = staged.select(*keys, measure, version, "batch_id", "line_no").join(suspects, list(keys), "left_semi")
    files = batches.select("batch_id", "file_path", F.substring("file_sha256", 1, 12).alias("sha"))
    tags = raw.select("batch_id", "line_no", F.variant_get("envelope", "$.test_case", "string").alias("test_case"))
    return (versions.join(files, "batch_id", "inner").join(tags, ["batch_id", "line_no"], "inner")
            .select(*keys, measure, version, "file_path", "sha", "line_no", "test_case"))


# --- whole comparisons -------------------------------------------------------------------------

def snapshot_summary(name: str, snapshots: Mapping[str, DataFrame], keys: Sequence[str], cols: Sequence[str],
                     xg: str, goals: Column) -> DataFrame:
    """Per label: rows, distinct keys, summed measure, goals and digest."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows"), distinct_keys(*keys).alias("keys"),
                    F.round(F.sum(xg), 4).alias("sum_xg"), goals.alias("goals"), digest(cols).alias("checksum"))
             .select(F.lit(name).alias("obj"), F.lit(label).alias("label"), "*")
             for label, df in snapshots.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> dict[str, DataFrame]:
    """Keys on one side only, changed rows, and the symmetric row difference of two snapshots."""
    only = sym_diff(a, b, keys).groupBy("side").agg(F.count(F.lit(1)).alias("count"))
    return {"keys": only, "changed": changed_rows(a, b, keys, cols), "rows": sym_diff(a, b, [*keys, *cols])}


def tables_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row counts, both EXCEPT ALL sizes and the verdict, as one row."""
    cols = a.columns
    signed = a.select(*cols, F.lit(1).alias("_sign")).unionByName(b.select(*cols, F.lit(-1).alias("_sign")))
    rows = signed.groupBy(*cols).agg(F.sum("_sign").alias("_extra"), F.count(F.lit(1)).alias("_n"))
    zero = F.lit(0).cast("bigint")
    # n = copies_a + copies_b and extra = copies_a - copies_b give both counts from one grouping
    one = rows.agg(
        F.coalesce(F.sum((F.col("_n") + F.col("_extra")) / 2), F.lit(0)).cast("bigint").alias("rows_a"),
        F.coalesce(F.sum((F.col("_n") - F.col("_extra")) / 2), F.lit(0)).cast("bigint").alias("rows_b"),
        F.coalesce(F.sum(F.when(F.col("_extra") > 0, F.col("_extra"))), zero).alias("a_minus_b"),
        F.coalesce(F.sum(F.when(F.col("_extra") < 0, -F.col("_extra"))), zero).alias("b_minus_a"))
    return one.withColumn("equal", (F.col("a_minus_b") == 0) & (F.col("b_minus_a") == 0))


def result_summary(result: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Rows, summed measures and digest of a query result."""
    return result.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(f"sum_{m}") for m in measures],
                      digest(result.columns).alias("checksum"))


def results_across(query: Callable[[DataFrame], DataFrame], layouts: Mapping[str, DataFrame],
                   measures: Sequence[str]) -> DataFrame:
    """Summary of one query on every layout of the same table; all rows must agree."""
    parts = [result_summary(query(df), measures).select(F.lit(n).alias("layout"), "*") for n, df in layouts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verify_copy(src: DataFrame, dst: DataFrame, key: Sequence[str], control: DataFrame, control_on: Sequence[str],
                queries: Mapping[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Report (check, ok, detail) on a copy of a table.

    Schema by name and type, rows equal and above zero, no NULLs, unique key, equal content digest,
    equal control rows and equal results of the given queries. One pass per side for the counts.
    """
    cols = src.columns
    nulls = [null_count(c) for c in cols]
    total_nulls = nulls[0]
    for n in nulls[1:]:
        total_nulls = total_nulls + n
    same_schema = ({f.name: f.dataType for f in src.schema.fields} == {f.name: f.dataType for f in dst.schema.fields})
    a = src.agg(F.count(F.lit(1)).alias("a_rows"), digest(cols).alias("a_sum"))
    b = dst.agg(F.count(F.lit(1)).alias("b_rows"), digest(cols).alias("b_sum"), total_nulls.alias("b_nulls"),
                distinct_keys(*key).alias("b_keys"))

    def line(name: str, ok: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), ok.alias("ok"), detail.cast("string").alias("detail"))

    both = with_scalar(a, b)
    lines = [line("schema", F.lit(same_schema), F.lit(len(cols))),
             line("rows", (F.col("a_rows") == F.col("b_rows")) & (F.col("b_rows") > 0), F.col("b_rows")),
             line("nulls", F.col("b_nulls") == 0, F.col("b_nulls")),
             line("unique_key", F.col("b_rows") == F.col("b_keys"), F.col("b_keys")),
             line("content", F.col("a_sum") == F.col("b_sum"), F.col("b_sum"))]
    report = both.select(F.inline(F.array(*lines)))
    pairs = {"control_rows": (semi_subset(src, control, control_on), semi_subset(dst, control, control_on))}
    pairs |= {f"query_{n}": (q(src), q(dst)) for n, q in queries.items()}
    for name, (x, y) in pairs.items():
        d = tables_equal(x, y).select(F.lit(name).alias("check"), F.col("equal").alias("ok"),
                                      F.col("rows_b").cast("string").alias("detail"))
        report = report.unionByName(d)
    return report


def guarded_report(ctx: Mapping[str, DataFrame], rules: Sequence[RowRule | QueryRule]) -> DataFrame:
    """Rules that a batch breaks; an append is allowed when there are none."""
    return run_rules(ctx, rules).where("status = 'fail'")


# --- independent reconciliation ----------------------------------------------------------------

def recount(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Measures per team and match straight from raw events, with the official score.

    ``events``: match_id, team_id, event_type, period, outcome, xg; ``matches``: match_id,
    match_date, home/away team ids and scores. Own goals count for the team they are given to.
    """
    live = events.where(F.col("period") < 5)
    is_shot = F.col("event_type") == "Shot"
    sums = live.groupBy("match_id", "team_id").agg(
        count_where(is_shot).alias("shots"),
        count_where(is_shot & F.col("outcome").isin(ON_TARGET)).alias("shots_on_target"),
        count_where(is_shot & (F.col("outcome") == "Goal")).alias("goals"),
        F.coalesce(F.sum(F.when(is_shot, F.col("xg"))), F.lit(0)).alias("xg"),
        count_where(F.col("event_type") == "Own Goal For").alias("own_goals_for"))
    sides = both_sides(matches, {"team_id": "home_team_id", "score": "home_score"},
                       {"team_id": "away_team_id", "score": "away_score"}, ["match_id", "match_date"])
    joined = sides.join(sums, ["match_id", "team_id"], "left")
    zero = F.lit(0)
    counts = ["shots", "shots_on_target", "goals", "own_goals_for", "xg"]
    out = joined.withColumns({c: F.coalesce(F.col(c), zero) for c in counts})
    return out.withColumn("score_ok", F.col("goals") + F.col("own_goals_for") == F.col("score"))


def reconcile(events: DataFrame, matches: DataFrame, published: DataFrame, source: str | None = None) -> DataFrame:
    """Recounted rows of one source beside the rows published for it, with both verdicts.

    ``source`` picks the published rows; without it they must be of one source already.

    A side without a published row is a mismatch; extra published rows are not looked at, as the
    recount drives the comparison.
    """
    calc = recount(events, matches)
    own = published if source is None else published.where(F.col("source_system") == source)
    pub = own.select("team_id", "match_date", *[F.col(c).alias(f"pub_{c}") for c in
                                                      ("shots", "shots_on_target", "goals", "xg")])
    same = F.lit(True)
    for c in ("shots", "shots_on_target", "goals"):
        same = same & (F.col(c) == F.col(f"pub_{c}"))
    near = F.abs(F.col("xg") - F.col("pub_xg")) < F.lit("0.0001").cast("decimal(10,4)")
    return (calc.join(pub, ["team_id", "match_date"], "left")
            .withColumn("published_ok", holds(same & near)))
