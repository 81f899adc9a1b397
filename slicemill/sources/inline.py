"""Small relations written in the code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def values(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """An inline ``VALUES`` relation of the given schema.

    Built from literals on a one-row range, so the optimizer knows that it is small and neither the
    plan nor the tasks need Python data.
    """
    fields = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields
    one = spark.range(1)
    if not rows:
        return one.where("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    lines = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows]
    return one.select(F.inline(F.array(*lines)))


def dictionary(spark: SparkSession, rows: Sequence[tuple], schema: str, name: str) -> DataFrame:
    """Inline dictionary under a view name, replaced when it exists."""
    df = values(spark, rows, schema)
    df.createOrReplaceTempView(name)
    return df
