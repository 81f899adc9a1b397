"""Writes that measure what they write.

Metrics are taken by the job that writes, from the rows on their way into the files, so that round trips, appends and
publications need no second scan of their input. They are set above all shuffles of the frame: the tasks that write are those
that count, and only a task that succeeds is counted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from slicemill.functions.aggregates import digest, distinct_keys, null_count


class AppendRefused(ValueError):
    """The stored rows and the batch do not add up."""


class RoundTripError(ValueError):
    """Data read back differs from the data written."""


def remove_folder(path: str) -> None:
    """Deletes a folder that nothing reads any more; one that is not there is fine."""
    system, folder = fs.FileSystem.from_uri(path)
    if system.get_file_info(folder).type != fs.FileType.NotFound:
        system.delete_dir(folder)


def content_metrics(cols: Sequence[str], nulls: Sequence[str] = ()) -> dict[str, Column]:
    """Rows, order-free digest and NULLs of the columns named, as a write and its reader both take them."""
    return {"rows": F.count(F.lit(1)), "checksum": digest(cols), **{f"nulls_{c}": null_count(c) for c in nulls}}


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], metrics: Mapping[str, Column] | None = None) -> dict:
    """What ``write`` writes of ``df``, measured by the same job."""
    taken = Observation()
    write(df.observe(taken, *[c.alias(n) for n, c in (metrics or content_metrics(df.columns)).items()]))
    return taken.get


def checked_roundtrip(df: DataFrame, write: Callable[[DataFrame], None], read: Callable[[], DataFrame]) -> DataFrame:
    """Writes ``df``, compares what is read back with what was observed, and returns it. Its input is read once."""
    before = write_observed(df, write)
    after = read()
    a, b = ({f.name: f.dataType for f in x.schema.fields} for x in (df, after))
    if a != b:
        raise RoundTripError(f"columns changed: {sorted(set(a.items()) ^ set(b.items()), key=str)}")
    found = after.agg(*[c.alias(n) for n, c in content_metrics(df.columns).items()]).first().asDict()
    if found != before:
        raise RoundTripError(f"written {before}, read {found}")
    return after


# --- snapshots in one partitioned table ----------------------------------------------------------

SNAPSHOT, OPERATION = "snapshot_id", "operation"


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows below ``path``, or None before the first row is written."""
    try:
        return spark.read.option("mergeSchema", False).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def add_snapshot(df: DataFrame, path: str, number: int, operation: str = "append", key: Sequence[str] = (),
                 by: Mapping[str, Column] | None = None) -> dict:
    """Adds ``df`` as the snapshot ``number`` and returns its metrics with the rows now current.

    The number and the operation (``append``, or ``overwrite``, which replaces all rows before) are ordinary partition
    columns; ``by`` adds derived ones. A repeat of the same number replaces its folder. With ``key`` the current rows must have
    a unique key without NULLs and be as many as before plus those written; else the folder is taken away again.
    """
    spark = df.sparkSession
    before = stored(spark, path)
    if before is not None:
        before = before.where(F.col(SNAPSHOT) < number)
    earlier = 0 if before is None or operation == "overwrite" else current_rows(before).count()
    folder = f"{path}/{SNAPSHOT}={number}/{OPERATION}={operation}"
    out = df.withColumns(dict(by or {}))
    hinted = out.hint("rebalance", *by) if by else out

    def write(rows: DataFrame) -> None:
        w = rows.write.mode("overwrite").option("compression", "snappy")
        (w.partitionBy(*by) if by else w).parquet(folder)

    done = write_observed(hinted, write, content_metrics(df.columns, key))
    done["total"] = earlier + done["rows"]
    if key:
        now = current_rows(stored(spark, path).where(F.col(SNAPSHOT) <= number)).agg(F.count(F.lit(1)).alias("rows"), distinct_keys(*key).alias("keys")).first()
        blank = {c: done[f"nulls_{c}"] for c in key if done[f"nulls_{c}"]}
        if blank or now["rows"] != done["total"] or now["keys"] != now["rows"]:
            remove_folder(f"{path}/{SNAPSHOT}={number}")
            raise AppendRefused(f"{done['total']} rows expected, {now['rows']} with {now['keys']} keys found, blank keys: {blank}")
    return done


def current_rows(rows: DataFrame) -> DataFrame:
    """Rows from the last overwriting snapshot on."""
    last = rows.agg(F.max(F.when(F.col(OPERATION) == "overwrite", F.col(SNAPSHOT)))).scalar()
    return rows.where(F.col(SNAPSHOT) >= F.coalesce(last, F.lit(0)))


def snapshot_totals(rows: DataFrame) -> DataFrame:
    """Snapshots with the rows that were current after each."""
    sizes = rows.groupBy(SNAPSHOT, OPERATION).agg(F.count(F.lit(1)).alias("added_records"))
    base = sizes.where(F.col(OPERATION) == "overwrite").select(F.col(SNAPSHOT).alias("_base"))
    # one row for each snapshot on either side
    owned = sizes.join(base, F.col("_base") <= F.col(SNAPSHOT), "left").groupBy(SNAPSHOT, OPERATION, "added_records").agg(F.max("_base").alias("_base"))
    parts = sizes.select(F.col(SNAPSHOT).alias("_part"), F.col("added_records").alias("_n"))
    since = owned.join(parts, (F.col("_part") <= F.col(SNAPSHOT)) & (F.col("_part") >= F.coalesce("_base", F.lit(0))))
    return since.groupBy(SNAPSHOT, OPERATION, "added_records").agg(F.sum("_n").alias("total_records"))


def new_snapshots(before: DataFrame, after: DataFrame) -> DataFrame:
    """Snapshot ids that a write added."""
    return after.select(SNAPSHOT).distinct().join(before.select(SNAPSHOT).distinct(), SNAPSHOT, "left_anti")
