"""Contracts as one number per row: bit i is set where rule i is broken.

All conditions are compiled to one bigint column, so one pass over the data gives everything there is to say: rows are
counted per number, and failures per rule, first reasons and rules that are broken together follow from these few counts.
At most 63 rules; a condition that is NULL is not broken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicemill.functions.aggregates import distinct_keys
from slicemill.functions.columns import holds, in_set, is_blank, out_of_range
from slicemill.operators.quality import QualityError
from slicemill.session import work_path

Rule = tuple[str, Column]

# Fixed values of the event contract.
EVENT_TYPES = ["page_view", "item_view", "click", "search", "add_to_cart", "remove_from_cart", "purchase", "refund"]
PAYMENT_METHODS = ["card", "sbp", "wallet", "cash_on_delivery", "installment"]
FINANCIAL_TYPES = ["purchase", "refund"]
EVENT_SCHEMA = ("event_id string, user_id int, session_id string, event_ts timestamp, event_date date, event_type string, "
                "platform string, device_type string, os_version string, app_version string, region string, city string, "
                "referrer string, category_id int, category_name string, price_rub decimal(12,2), quantity int, currency string, "
                "payment_method string, duration_ms int, ab_group string")


def event_rules(start, end) -> list[Rule]:
    """The contract of an event: what must be there, which values it may have, and money for the types that move some alone."""
    schema = T.StructType.fromDDL(EVENT_SCHEMA)
    money = ["price_rub", "quantity", "payment_method"]
    rules: list[Rule] = []
    for f in schema.fields:
        if f.name not in money:
            text = isinstance(f.dataType, T.StringType)
            rules.append((f"missing_{f.name}", is_blank(f.name) if text else F.col(f.name).isNull()))
    pays = F.col("event_type").isin(FINANCIAL_TYPES)
    day = F.col("event_date")
    rules += [("unknown_event_type", ~in_set("event_type", EVENT_TYPES)), ("other_day_than_time", day != F.to_date("event_ts")),
              ("outside_window", (day < F.lit(start)) | (day >= F.lit(end))), ("foreign_currency", F.col("currency") != "RUB"),
              ("bad_price", pays & (F.col("price_rub").isNull() | (F.col("price_rub") <= 0))),
              ("bad_quantity", pays & (F.col("quantity").isNull() | out_of_range("quantity", 1, 4))),
              ("bad_payment_method", pays & (F.col("payment_method").isNull() | ~in_set("payment_method", PAYMENT_METHODS)))]
    return rules + [(f"unexpected_{c}", ~pays & F.col(c).isNotNull()) for c in money]


def violation_mask(rules: Sequence[Rule]) -> Column:
    """Bit i where rule i is broken; 0 for a row that keeps the contract."""
    if len(rules) > 63:
        raise ValueError("more than 63 rules")
    mask = F.lit(0).cast("bigint")
    for i, (_, bad) in enumerate(rules):
        mask = mask.bitwiseOR(F.when(holds(bad), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    return mask


def mask_counts(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Rows per combination of broken rules, of each group of ``by``: one pass, folded before the shuffle.

    Stored, as all reports start from these few rows, and so that no condition on a report is worked into the rules.
    """
    counts = df.select(*by, violation_mask(rules).alias("mask")).groupBy(*by, "mask").agg(F.count(F.lit(1)).alias("rows"))
    path = work_path(df.sparkSession, "masks")
    counts.write.parquet(path)
    return df.sparkSession.read.schema(counts.schema).parquet(path)


def _bits(rules: Sequence[Rule], mask: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.lit(len(rules) - 1)), lambda i: F.getbit(mask, i) == 1)


def _name(rules: Sequence[Rule], i: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n, _ in rules]), i)


def rule_counts(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break each rule, and rows of which it is the first reason; rules that no row breaks are listed with 0."""
    set_bits = counts.withColumn("_bits", _bits(rules, F.col("mask")))
    hits = set_bits.select("rows", F.get("_bits", 0).alias("_first"), F.explode("_bits").alias("_i"))
    found = hits.groupBy("_i").agg(F.sum("rows").alias("failures"), F.coalesce(F.sum(F.when(F.col("_first") == F.col("_i"), F.col("rows"))), F.lit(0)).alias("first_reason"))
    listed = counts.sparkSession.range(len(rules)).select(F.col("id").cast("int").alias("_i"))
    zero = F.lit(0).cast("bigint")
    return listed.join(found, "_i", "left").select(_name(rules, F.col("_i")).alias("rule"), F.coalesce("failures", zero).alias("failures"), F.coalesce("first_reason", zero).alias("first_reason"))


def pair_counts(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break two rules together, for every pair that some row breaks."""
    bits = counts.select("rows", _bits(rules, F.col("mask")).alias("_bits"))
    first = bits.select("rows", "_bits", F.explode("_bits").alias("_i"))
    both = first.select("rows", "_i", F.explode("_bits").alias("_j")).where("_i < _j").groupBy("_i", "_j").agg(F.sum("rows").alias("rows"))
    return both.select(_name(rules, F.col("_i")).alias("rule_a"), _name(rules, F.col("_j")).alias("rule_b"), "rows")


def split_by_mask(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and the others with all their reasons, the first one first."""
    marked = df.withColumn("_mask", violation_mask(rules))
    reasons = F.transform(_bits(rules, F.col("_mask")), lambda i: _name(rules, i))
    return marked.where("_mask = 0").drop("_mask"), marked.where("_mask <> 0").withColumn("reasons", reasons).drop("_mask")


def validate_contract(df: DataFrame, key: Sequence[str], rules: Sequence[Rule]) -> int:
    """Rows of an input that keeps the contract; an empty input, broken rules or repeated keys raise.

    One pass: the key is counted beside the masks' sums.
    """
    mask = violation_mask(rules)
    bits = [F.count_if(mask.bitwiseAND(F.lit(1 << i).cast("bigint")) != 0).alias(f"r{i}") for i in range(len(rules))]
    m = df.agg(F.count(F.lit(1)).alias("rows"), distinct_keys(*key).alias("unique_ids"), *bits).first()
    if m["rows"] == 0:
        raise QualityError("input has no rows")
    broken = {name: m[f"r{i}"] for i, (name, _) in enumerate(rules) if m[f"r{i}"]}
    if broken or m["unique_ids"] != m["rows"]:
        raise QualityError(f"contract broken: {m['rows']} rows, {m['unique_ids']} keys, {broken}")
    return m["rows"]
