"""Column expressions: keys, predicates, JSON access, dates, ordering."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# NULL marker inside keys, last day of an open interval.
NULL_MARK = "∅"
OPEN_END = dt.date(9999, 12, 31)
# Outcome names that count as on target; outcome of a goal; type of a penalty;
# period number of the shoot-out.
ON_TARGET = ["Goal", "Saved", "Saved to Post"]
GOAL = "Goal"
PENALTY = "Penalty"
SHOOTOUT_PERIOD = 5


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- keys and row text -------------------------------------------------------------------------

def row_text(*cols: str | Column) -> Column:
    """Columns as one ``|``-joined text; a NULL is written as the marker, so it is never skipped."""
    return F.concat_ws("|", *[F.coalesce(as_col(c).cast("string"), F.lit(NULL_MARK)) for c in cols])


def surrogate_key(*cols: str | Column) -> Column:
    """Warehouse key over the natural key parts; the source system is always one of them."""
    return F.md5(row_text(*cols))


def null_safe_key(*cols: str | Column) -> Column:
    """One struct column that groups and joins with NULL parts equal to each other."""
    return F.struct(*[as_col(c).alias(f"k{i}") for i, c in enumerate(cols)])


# --- predicates --------------------------------------------------------------------------------

def is_blank(c: str | Column) -> Column:
    c = as_col(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def in_range(c: str | Column, lo=None, hi=None) -> Column:
    """Closed range; a missing bound is open; NULL stays NULL."""
    c = as_col(c)
    if lo is None and hi is None:
        raise ValueError("in_range needs a bound")
    if lo is None:
        return c <= F.lit(hi)
    if hi is None:
        return c >= F.lit(lo)
    return c.between(F.lit(lo), F.lit(hi))


def in_set(c: str | Column, values: Iterable) -> Column:
    return as_col(c).isin(list(values))


def out_of_range(c: str | Column, lo=None, hi=None) -> Column:
    """True for a present value outside the closed range; NULL passes."""
    c = as_col(c)
    return c.isNotNull() & ~in_range(c, lo, hi)


def holds(cond: Column) -> Column:
    """Two-valued form of a predicate: unknown counts as false."""
    return F.coalesce(cond, F.lit(False))


def changed(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Row-wise ``IS DISTINCT FROM`` over several columns."""
    return ~F.struct(*a).eqNullSafe(F.struct(*b))


def first_label(rules: Sequence[tuple[str, Column]]) -> Column:
    """Label of the first rule that holds, NULL when none does."""
    return F.coalesce(*[F.when(holds(cond), F.lit(label)) for label, cond in rules])


def by_side(team: str | Column, home: str | Column, if_home: str | Column, if_away: str | Column) -> Column:
    """Value of the home branch where ``team`` is the home team, else (also for NULL) the other."""
    return F.when(as_col(team) == as_col(home), as_col(if_home)).otherwise(as_col(if_away))


def derive_flags(df: DataFrame, period="period", shot_type="shot_type", outcome="outcome") -> DataFrame:
    """Add is_shootout, is_penalty, is_on_target, is_goal."""
    return df.withColumns({
        "is_shootout": as_col(period) == SHOOTOUT_PERIOD,
        "is_penalty": as_col(shot_type) == PENALTY,
        "is_on_target": as_col(outcome).isin(ON_TARGET),
        "is_goal": as_col(outcome) == GOAL,
    })


def stamp(df: DataFrame, start: dt.date, end: dt.date, run_id: str) -> DataFrame:
    """Run parameters as constant columns."""
    return df.withColumns({"slice_start": F.lit(start), "slice_end": F.lit(end), "run_id": F.lit(run_id)})


def project(df: DataFrame, cols: dict[str, str | Column] | Sequence[str]) -> DataFrame:
    """Keep (and rename) only the given columns."""
    if isinstance(cols, dict):
        return df.select(*[as_col(c).alias(name) for name, c in cols.items()])
    return df.select(*cols)


# --- dates -------------------------------------------------------------------------------------

def as_date(value: str | dt.date | None) -> dt.date:
    """A slice bound as a date; a missing one is an error, never today."""
    if value is None or value == "":
        raise ValueError("slice bound is missing: give both start and end as dates")
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def slice_bounds(start: str | dt.date | None, end: str | dt.date | None) -> tuple[dt.date, dt.date]:
    lo, hi = as_date(start), as_date(end)
    if lo >= hi:
        raise ValueError(f"empty slice: start {lo} is not before end {hi}")
    return lo, hi


def date_slice(df: DataFrame, col: str, start, end) -> DataFrame:
    """Rows of the half-open event-date slice ``[start, end)``.

    On a yearly layout, ``datasets.slice_partitions`` gives the predicate that skips whole folders.
    """
    lo, hi = slice_bounds(start, end)
    return df.where((F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi)))


def date_key(c: str | Column) -> Column:
    """Date as the integer YYYYMMDD."""
    c = as_col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def iso_day_of_week(c: str | Column) -> Column:
    """1 for Monday .. 7 for Sunday."""
    return F.weekday(as_col(c)) + 1


def day_name(c: str | Column) -> Column:
    return F.date_format(as_col(c), "EEE")


def month_start(c: str | Column) -> Column:
    return F.trunc(as_col(c), "MM")


# --- JSON --------------------------------------------------------------------------------------

def json_value(c: str | Column, path: str, type_: str = "string") -> Column:
    """Typed value at ``path`` of a variant column; a value that does not fit the type is an error."""
    return F.variant_get(as_col(c), path, type_)


def payload_hash(c: str | Column) -> Column:
    """Hash of the canonical JSON text: key order and white space do not matter."""
    return text_hash(F.to_json(as_col(c)))


def text_hash(c: str | Column) -> Column:
    """``payload_hash`` of the variant that a text parses to, for a text that is canonical JSON already."""
    return F.md5(as_col(c))


# --- arithmetic --------------------------------------------------------------------------------

def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, NULL for an empty whole."""
    share = part.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)") / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(share, digits)


def per_unit(total: Column, n: Column, digits: int = 2) -> Column:
    """Average as total over count; the count may not be averaged again."""
    return F.round(total.cast("decimal(28,8)") / F.nullif(n, F.lit(0)).cast("decimal(18,0)"), digits)


# --- ordering ----------------------------------------------------------------------------------

def order_columns(order: Sequence[str]) -> list[Column]:
    """Sort columns of an order spec such as ``["version desc", "id asc"]``.

    NULL counts as larger than every value, as in the warehouse dialect: it comes first in a
    descending and last in an ascending column.
    """
    out = []
    for item in order:
        name, _, way = item.strip().partition(" ")
        down = way.strip().lower() == "desc"
        out.append(F.col(name).desc_nulls_first() if down else F.col(name).asc_nulls_last())
    return out
