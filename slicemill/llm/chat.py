"""Chat formatting after the collapse of cumulative snapshots.

Logs often hold a conversation again after each turn. Every turn gets a digest of its place, role and text; the running
sum of these digests in four lanes is the digest of the prefix that ends there. A conversation whose whole digest is
a proper prefix digest of another one, or that equals one with a smaller id, is dropped by anti-joins; what stays is maximal
and is rendered.

Prefix digests are additive, so a long conversation is cut into chunks of ``CHUNK`` turn numbers: places and sums are
counted inside chunks and shifted by those of earlier chunks. Prefix digests are folded to one row each before
they are joined, so a first turn that a third of all conversations share is one row.

Defined cases: turns are ordered by number, then role and text, nulls last; gaps in the numbers do not matter; a null role or
text differs from an empty one and is rendered as empty; a repeated turn is a turn of its own; rows without a conversation id
are one conversation; empty tables give none; extra columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slicemill.llm.common import written

CHUNK = 1024
LANES = 4
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def lane(i: int, at: Column) -> Column:
    """31 bits, so that sums over 2^32 turns fit a long."""
    parts = [F.lit(i), at, F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 31) - 1))


def prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, at (place of the turn from 1 on), prefix (digest of all turns up to it), role and text."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    rows = rows.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit((1 << 62))).cast("long"))
    inside = W.partitionBy("conv_id", "chunk").orderBy(F.asc_nulls_last("turn"), F.asc_nulls_last("role"), F.asc_nulls_last("text"))
    rows = rows.withColumn("own", F.row_number().over(inside))
    earlier = W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    sizes = sizes.select(F.col("conv_id").alias("of"), F.col("chunk").alias("part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    here = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("part"))
    rows = rows.join(sizes, here).select("conv_id", "chunk", "role", "text", (F.col("own") + F.col("before")).alias("at"))
    rows = rows.select("*", *[lane(i, F.col("at")).alias(f"l{i}") for i in range(LANES)])
    running = W.partitionBy("conv_id", "chunk").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    sums = rows.groupBy("conv_id", "chunk").agg(*[F.sum(f"l{i}").alias(f"s{i}") for i in range(LANES)])
    sums = sums.select(F.col("conv_id").alias("of"), F.col("chunk").alias("part"), *[F.coalesce(F.sum(f"s{i}").over(earlier), F.lit(0)).alias(f"b{i}") for i in range(LANES)])
    rows = rows.select("conv_id", "chunk", "at", "role", "text", *[F.sum(f"l{i}").over(running).alias(f"r{i}") for i in range(LANES)])
    return rows.join(sums, here).select("conv_id", "at", F.struct(*[(F.col(f"r{i}") + F.col(f"b{i}")).alias(f"p{i}") for i in range(LANES)]).alias("prefix"), "role", "text")


def collapse(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, kept): stored turns with their prefix digests; conv_id, n_turns and n_collapsed of maximal conversations."""
    turns = written(prefixes(conversations), "turns")
    ends = written(turns.groupBy("conv_id").agg(F.max("at").alias("at"), F.max_by("prefix", "at").alias("prefix")), "ends")
    size = ends.select(F.col("conv_id").alias("conv"), F.col("at").alias("n_turns"))
    inner = turns.join(size, F.col("conv_id").eqNullSafe(F.col("conv"))).where(F.col("at") < F.col("n_turns")).select("at", "prefix").distinct()
    whole = ends.join(inner, ["at", "prefix"], "left_anti")
    # of equal conversations the one with the smallest id stays
    id_order = F.struct(F.col("conv_id").isNull().alias("no_id"), "conv_id")
    kept = written(whole.groupBy("at", "prefix").agg(F.min(id_order)["conv_id"].alias("conv_id")), "maximal")
    # each conversation is counted once, for the first maximal one that holds it
    k = kept.select(F.col("conv_id").alias("into"))
    holders = turns.join(k, F.col("conv_id").eqNullSafe(F.col("into"))).groupBy("at", "prefix").agg(F.min(id_order)["conv_id"].alias("into"))
    into = ends.join(holders, ["at", "prefix"]).groupBy("into").agg((F.count("*") - 1).alias("n_collapsed"))
    kept = kept.join(into, F.col("conv_id").eqNullSafe(F.col("into"))).select("conv_id", F.col("at").cast("long").alias("n_turns"), "n_collapsed")
    return turns, kept


def render(turns: DataFrame) -> DataFrame:
    """conv_id and the conversation as one text; bounded by the conversation itself."""
    piece = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE + "\n"))
    held = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", piece.alias("piece")))).alias("held"))
    return held.select("conv_id", F.array_join(F.col("held.piece"), "").alias("rendered"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_collapsed and rendered of every maximal conversation."""
    turns, kept = collapse(conversations)
    k = kept.select(F.col("conv_id").alias("id"), "n_turns", "n_collapsed")
    mine = turns.join(k, F.col("conv_id").eqNullSafe(F.col("id")), "left_semi")
    r = render(mine)
    return r.join(k, F.col("conv_id").eqNullSafe(F.col("id"))).select("conv_id", "n_turns", "n_collapsed", "rendered")
