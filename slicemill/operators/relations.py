"""Small joins, set operations, sorting and sampling used by the larger operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark import StorageLevel

from slicemill.functions.aggregates import distinct_keys


# --- joins -------------------------------------------------------------------------------------

def with_batch(rows: DataFrame, batches: DataFrame, on: Sequence[str] = ("batch_id",)) -> DataFrame:
    return rows.join(batches, list(on), "inner")


def left_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "left")


def join_dims(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Inner equi joins of a fact to dimensions, one per key column."""
    for key, dim in dims.items():
        fact = fact.join(dim, key, "inner")
    return fact


def enrich(df: DataFrame, dictionary: DataFrame, key: str, dict_key: str, value: str,
           default: str, name: str) -> DataFrame:
    """Left join to a dictionary; rows without a match fall into the ``default`` group.

    No broadcast hint: Catalyst broadcasts a dictionary whose size it knows to be small and falls
    back to a shuffled join for one that has grown.
    """
    d = dictionary.select(F.col(dict_key).alias("_dict_key"), F.col(value).alias("_dict_value"))
    joined = df.join(d, F.col(key) == F.col("_dict_key"), "left")
    return (joined.withColumn(name, F.coalesce(F.col("_dict_value"), F.lit(default)))
            .drop("_dict_key", "_dict_value"))


def join_conservation(left: DataFrame, dictionary: DataFrame, key: str, dict_key: str) -> DataFrame:
    """Rows before and after a left join and rows without a match, without doing the row join.

    Both sides are first counted per key, so a key that holds a third of the rows is one row by the
    time it is shuffled.
    """
    l = left.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    d = (dictionary.where(F.col(dict_key).isNotNull()).groupBy(F.col(dict_key).alias("_k"))
         .agg(F.count(F.lit(1)).alias("_m")))
    zero = F.lit(0).cast("bigint")
    return l.join(d, "_k", "left").agg(
        F.coalesce(F.sum("_n"), zero).alias("before_join"),
        F.coalesce(F.sum(F.col("_n") * F.coalesce(F.col("_m"), F.lit(1))), zero).alias("after_join"),
        F.coalesce(F.sum(F.when(F.col("_m").isNull(), F.col("_n"))), zero).alias("unmatched"),
    )


def orphans(child: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Child rows whose (complete) foreign key has no parent; a NULL key part is not an orphan."""
    keys = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(pk)])
    present = child
    for c in fk:
        present = present.where(F.col(c).isNotNull())
    cond = [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(fk)]
    return present.join(keys, cond, "left_anti")


def in_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in the list (also the control subset of a fact)."""
    return df.join(keys.select(*on), list(on), "left_semi")


def not_in_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_anti")


semi_subset = in_keys


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row, as an uncorrelated scalar subquery."""
    row = one_row.select(F.struct(*one_row.columns).alias("_row")).scalar()
    return df.select("*", row.alias("_row")).select(*df.columns, "_row.*")


def compare_totals(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row aggregates side by side."""
    return with_scalar(a, b)


def pair_snapshots(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows of two snapshots matched by key, columns prefixed ``a_`` and ``b_``."""
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in cols])
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in cols])
    return left.join(right, list(keys), "inner")


def explode_keep(df: DataFrame, array: str | Column, name: str) -> DataFrame:
    """One row per array element; an empty or NULL array keeps its row with a NULL element."""
    array = F.col(array) if isinstance(array, str) else array
    return df.select("*", F.explode_outer(array).alias(name))


# --- aggregation shapes ------------------------------------------------------------------------

def group_all(df: DataFrame, dims: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*dims).agg(*[c.alias(n) for n, c in aggs.items()])


def groups_where(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], cond: Column) -> DataFrame:
    """Grouped aggregate with a HAVING condition over the aggregate names."""
    return group_all(df, keys, aggs).where(cond)


def totals(df: DataFrame, measure: str) -> DataFrame:
    """Row count and exact average (sum and division stay decimal)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.avg(F.col(measure).cast("decimal(18,6)")).alias("avg_value"))


def profile(df: DataFrame, keys: Sequence[str], measure: str, digits: int = 2) -> DataFrame:
    """Rounded average and count of a measure per group."""
    return df.groupBy(*keys).agg(
        F.round(F.avg(F.col(measure).cast("decimal(18,6)")).cast("decimal(18,6)"), digits).alias("avg_value"),
        F.count(F.lit(1)).alias("n"))


def extent(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(col).alias("first"), F.max(col).alias("last"),
                                 F.count(F.lit(1)).alias("rows"))


def key_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and distinct keys of a relation; equal when the key is unique."""
    return df.agg(F.count(F.lit(1)).alias("rows"), distinct_keys(*cols).alias("keys"))


# --- sort, limit, distinct ---------------------------------------------------------------------

def ordered(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.orderBy(*cols)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; ``order`` should end in a key, else ties are cut arbitrarily."""
    return df.orderBy(*order).limit(k)


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows, for looking at."""
    return df.limit(n)


def order_by_hidden(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column],
                    first: Sequence[str], hidden: Column) -> DataFrame:
    """Grouped result ordered by ``first`` and then by an aggregate that is not part of the output."""
    out = group_all(df, keys, {**aggs, "_order": hidden})
    return out.orderBy(*first, "_order").drop("_order")


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


# --- several relations -------------------------------------------------------------------------

def both_sides(df: DataFrame, home: Mapping[str, str], away: Mapping[str, str],
               common: Sequence[str]) -> DataFrame:
    """UNION ALL of the two sides of a row under common names, in one scan of the input.

    A union of two selects would read (and recompute) the input twice; exploding a two-element array
    gives the same rows from a single pass.
    """
    def side(mapping: Mapping[str, str]) -> Column:
        return F.struct(*[F.col(src).alias(name) for name, src in mapping.items()])

    if list(home) != list(away):
        raise ValueError("both sides must name the same columns in the same order")
    return df.select(*common, F.inline(F.array(side(home), side(away))))


def run_on(query: Callable[[DataFrame], DataFrame], relations: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """One query bound to several relations (layouts, formats, copies)."""
    return {name: query(df) for name, df in relations.items()}


def federate(spark: SparkSession, *names: str) -> tuple[DataFrame, ...]:
    """Relations of any catalogs known to the session, by qualified name; nothing is copied."""
    return tuple(spark.table(name) for name in names)


@contextmanager
def cached(df: DataFrame):
    """Keep a frame that several actions read, release it afterwards.

    Memory first, then executor disk; a lost executor's part is recomputed from the lineage.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
