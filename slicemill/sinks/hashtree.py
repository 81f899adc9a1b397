"""Tables with a tree of digests beside them, so that two of them are compared without being read.

Rows lie in ``leaves`` partitions by the hash of their key. A leaf has its row count and order-free digest, an inner node a
digest of those of its ``fanout`` children, up to one root; the tree is stored as (level, node, rows, digest). Two tables
with equal roots are equal. Else the comparison descends from differing nodes to their children, one small join a level, and
only the leaves that differ are read and compared row by row.

Comparable trees have the same columns, key, leaves and fanout; others are refused.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicemill.functions.aggregates import digest
from slicemill.operators.compare import multiset_diff
from slicemill.session import work_path
from slicemill.sinks.observed import remove_folder, write_observed

LEAVES, FANOUT = 256, 16
LEAF = "leaf"


class TreesDiffer(ValueError):
    """The trees are not built alike."""


def _shape(df: DataFrame, key: Sequence[str], leaves: int, fanout: int) -> str:
    fields = sorted((f.jsonValue() for f in df.schema.fields), key=lambda f: f["name"])
    bare = [{**f, "nullable": True, "metadata": {}} for f in fields]
    return json.dumps({"fields": bare, "key": list(key), "leaves": leaves, "fanout": fanout}, sort_keys=True)


def _about(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(f"{path}/tree").where("level = -1").first()["shape"])


def _rows(spark: SparkSession, path: str, about: dict) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson({"type": "struct", "fields": about["fields"]}).add(LEAF, T.IntegerType())).parquet(f"{path}/rows")


def levels(leaves: int, fanout: int) -> int:
    """Number of the root's level; the leaves are level 0."""
    return max(1, math.ceil(round(math.log(leaves, fanout), 9)))


def leaf_digests(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(node, rows, digest) of rows that carry their leaf."""
    return rows.groupBy(F.col(LEAF).cast("bigint").alias("node")).agg(F.count(F.lit(1)).alias("rows"), digest(cols).alias("digest"))


def tree_of(own: DataFrame, leaves: int, fanout: int) -> DataFrame:
    """(level, node, rows, digest) above and with stored leaves. A parent's children are few: at most ``fanout``."""
    level = own.select(F.lit(0).alias("level"), "node", "rows", "digest")
    out = level
    for number in range(1, levels(leaves, fanout) + 1):
        lines = F.array_sort(F.collect_list(F.concat_ws(":", F.lpad(F.col("node").cast("string"), 20, "0"), F.col("rows").cast("string"), "digest")))
        level = level.groupBy(F.floor(F.col("node") / fanout).alias("node")).agg(F.sum("rows").alias("rows"), F.sha2(F.array_join(lines, "\n"), 256).alias("digest"))
        level = level.select(F.lit(number).alias("level"), "node", "rows", "digest")
        out = out.unionByName(level)
    return out


def _write_tree(spark: SparkSession, path: str, shape: str) -> None:
    about = json.loads(shape)
    cols = [f["name"] for f in about["fields"]]
    digests = work_path(spark, "leaves")
    leaf_digests(_rows(spark, path, about), cols).coalesce(1).write.parquet(digests)  # the table is read once for all levels
    tree = tree_of(spark.read.parquet(digests), about["leaves"], about["fanout"]).withColumn("shape", F.lit(None).cast("string"))
    # one row says how the tree is built, also for a table without rows
    own = spark.range(1).select(F.lit(-1).alias("level"), F.lit(0).cast("bigint").alias("node"), F.lit(0).cast("bigint").alias("rows"), F.lit("").alias("digest"), F.lit(shape).alias("shape"))
    tree.unionByName(own).coalesce(1).write.mode("overwrite").parquet(f"{path}/tree")  # about one row for each leaf


def write_with_tree(df: DataFrame, path: str, key: Sequence[str], leaves: int = LEAVES, fanout: int = FANOUT) -> dict:
    """Writes ``df`` below ``path`` by leaf, then its tree; returns the metrics of the write."""
    out = df.withColumn(LEAF, F.pmod(F.xxhash64(*key), F.lit(leaves)).cast("int"))
    done = write_observed(out.hint("rebalance", LEAF), lambda rows: rows.write.mode("overwrite").option("compression", "snappy").partitionBy(LEAF).parquet(f"{path}/rows"),
                          {"rows": F.count(F.lit(1))})
    _write_tree(df.sparkSession, path, _shape(df, key, leaves, fanout))
    return done


def replace_leaves(df: DataFrame, path: str, numbers: Sequence[int]) -> None:
    """Puts ``df``, all rows that the leaves ``numbers`` are to have, in their place; nothing else is rewritten but the tree."""
    spark, about = df.sparkSession, _about(df.sparkSession, path)
    key = about["key"]
    if _shape(df, key, about["leaves"], about["fanout"]) != json.dumps(about, sort_keys=True):
        raise TreesDiffer("the rows have other columns than the table")
    out = df.withColumn(LEAF, F.pmod(F.xxhash64(*key), F.lit(about["leaves"])).cast("int"))
    full = {r[LEAF] for r in out.select(LEAF).distinct().collect()}  # at most one for each leaf
    if not full <= set(numbers):
        raise ValueError(f"rows of other leaves: {sorted(full - set(numbers))}")
    (out.hint("rebalance", LEAF).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .partitionBy(LEAF).parquet(f"{path}/rows"))
    for number in set(numbers) - full:
        remove_folder(f"{path}/rows/{LEAF}={number}")
    _write_tree(spark, path, _shape(df, key, about["leaves"], about["fanout"]))


def differing_leaves(spark: SparkSession, a: str, b: str) -> list[int]:
    """Numbers of the leaves that differ, found from the roots down; at most as many as there are leaves."""
    about, other = _about(spark, a), _about(spark, b)
    if about != other:
        raise TreesDiffer(f"{about} / {other}")
    names, nodes = ["node", "rows", "digest"], None
    for level in range(levels(about["leaves"], about["fanout"]), -1, -1):
        sides = []
        for number, path in ((1, a), (2, b)):
            tree = spark.read.parquet(f"{path}/tree").where(F.col("level") == level)
            if nodes is not None:
                tree = tree.where(F.floor(F.col("node") / about["fanout"]).isin(nodes))
            sides.append(tree.select(*names, F.lit(number).alias("side")))
        odd = sides[0].unionByName(sides[1]).groupBy(*names).agg(F.sum("side").alias("sides")).where("sides <> 3")
        nodes = sorted(r["node"] for r in odd.select("node").distinct().collect())
        if not nodes:
            break
    return nodes


def leaf_rows(spark: SparkSession, path: str, numbers: Sequence[int]) -> DataFrame:
    """The rows of some leaves; no other folder is read."""
    return _rows(spark, path, _about(spark, path)).where(F.col(LEAF).isin(list(numbers))).drop(LEAF)


def tree_diff(spark: SparkSession, a: str, b: str) -> DataFrame:
    """``multiset_diff`` of two stored tables, by their differing leaves alone."""
    odd = differing_leaves(spark, a, b)
    return multiset_diff(leaf_rows(spark, a, odd), leaf_rows(spark, b, odd))
