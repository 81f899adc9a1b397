"""Partition statistics that can be merged: distinct values and quantiles of any slice without reading its rows.

Each partition keeps a HyperLogLog sketch per counted column and a KLL sketch per measured one beside its row count and
first and last day. Sketches of the same kind merge, so a slice of whole partitions is answered from the small
statistics table; the errors are those of the sketches, below 3 % at the default sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HLL_BITS, KLL_SIZE = 12, 400


def sketch_stats(df: DataFrame, by: Sequence[str], distinct: Sequence[str], measures: Sequence[str], date: str | None = None) -> DataFrame:
    """Rows, first and last day and sketches of every partition: one pass, folded before the shuffle."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if date:
        aggs += [F.min(date).alias("first_day"), F.max(date).alias("last_day")]
    aggs += [F.hll_sketch_agg(F.col(c), F.lit(HLL_BITS)).alias(f"hll_{c}") for c in distinct]
    aggs += [F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(KLL_SIZE)).alias(f"kll_{m}") for m in measures]
    return df.groupBy(*by).agg(*aggs)


def merged_stats(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Statistics of coarser groups, or of all rows of ``stats``, in the same form."""
    aggs = [F.sum("rows").alias("rows")]
    for c in stats.columns:
        if c in ("first_day", "last_day"):
            aggs.append((F.min if c == "first_day" else F.max)(c).alias(c))
        elif c.startswith("hll_"):
            aggs.append(F.hll_union_agg(c).alias(c))
        elif c.startswith("kll_"):
            aggs.append(F.kll_merge_agg_double(c).alias(c))
    return stats.groupBy(*by).agg(*aggs) if by else stats.agg(*aggs)


def estimates(stats: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """``distinct_<column>`` and ``<measure>_p<percent>`` of every row of ``stats``, beside its other columns."""
    kept = [c for c in stats.columns if not c.startswith(("hll_", "kll_"))]
    out = [F.hll_sketch_estimate(c).alias(f"distinct_{c[4:]}") for c in stats.columns if c.startswith("hll_")]
    out += [F.kll_sketch_get_quantile_double(F.col(c), F.lit(float(q))).alias(f"{c[4:]}_p{round(q * 100)}") for c in stats.columns if c.startswith("kll_") for q in quantiles]
    return stats.select(*kept, *out)
