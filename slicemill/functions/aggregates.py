"""Aggregate expressions and order-free digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_col, holds

# Text logged instead of a digest when there is nothing to digest.
EMPTY = "empty"


def count_where(cond: Column) -> Column:
    return F.count_if(holds(cond))


def invalid_count(cond: Column) -> Column:
    """Conditional sum used as a quality metric; 0 instead of NULL on empty input."""
    return F.coalesce(F.sum(F.when(holds(cond), 1).otherwise(0)), F.lit(0)).cast("bigint")


def null_count(c: str | Column) -> Column:
    return F.count(F.lit(1)) - F.count(as_col(c))


def null_share(c: str | Column) -> Column:
    return F.avg(as_col(c).isNull().cast("int"))


def distinct_keys(*cols: str | Column) -> Column:
    """Exact count of distinct combinations; NULL parts count (a bare multi-column one drops them)."""
    return F.count_distinct(F.struct(*[as_col(c) for c in cols]))


def ordered_concat(value: Column, order: Column, sep: str = " | ") -> Column:
    """Values of a group joined in the given order; only for groups that are small by their meaning."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), sep)


def digest_parts(cols: Sequence[str | Column]) -> list[Column]:
    """Count and two 60-bit sums of row hashes.

    Each value is written with its length, so that no two different rows have the same text, and sums hold
    for 10^20 rows.

    Addition does not care for order, so the digest is a plain two-phase aggregate: no sort and no
    task that has to see all rows, and repeated rows still change it (unlike XOR).
    """
    values = [as_col(c).cast("string") for c in cols]
    sized = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    h = F.md5(F.concat_ws("|", *sized))

    def part(start: int) -> Column:
        number = F.conv(F.substring(h, start, 15), 16, 10).cast("decimal(28,0)")
        return F.coalesce(F.sum(number), F.lit(0)).cast("decimal(38,0)")

    return [F.count(F.lit(1)).alias("n"), part(1).alias("hi"), part(17).alias("lo")]


def digest(cols: Sequence[str | Column]) -> Column:
    """Content digest of a relation or group, ``'empty'`` without rows."""
    n, hi, lo = digest_parts(cols)
    text = F.concat_ws(":", n.cast("string"), hi.cast("string"), lo.cast("string"))
    return F.when(F.count(F.lit(1)) == 0, F.lit(EMPTY)).otherwise(F.md5(text))
