"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicemill.session import work_path

BATCH_ROWS, BATCH_BYTES = 4000, 16 << 20  # what a Python task works on at a time; a single text may be longer


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """The narrow form operators work on: doc_id, th (hash of the text), text and the named columns.

    (doc_id, th) tells rows apart even where an id is null or repeated; rows equal in both are the same
    document and get the same result. Columns that the operator does not use are left out, so their
    names cannot clash.
    """
    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text", *more)


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])


def packed(docs: DataFrame) -> DataFrame:
    """Whole rows as one struct beside their key; ``unpacked`` gives the columns back."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"], F.xxhash64(docs["text"]).alias("th"))


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, th) is not in ``keys``."""
    p = packed(docs)
    return p.join(keys.select("doc_id", "th"), same_document(p, keys), "left_anti").select("row.*")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in the shared folder and read again: cuts the lineage and survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of at most BATCH_ROWS rows and, by their mean size, BATCH_BYTES."""
    step = max(1, min(BATCH_ROWS, BATCH_BYTES * batch.num_rows // max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_batches(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], dict[str, list]]], schema: str) -> DataFrame:
    """``start`` is called once for each task; what it gives turns pieces of batches into columns, row by row."""
    fields = [f.split() for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = start()
        for batch in batches:
            for piece in slices(batch):
                out = fn(piece)
                yield pa.RecordBatch.from_arrays([pa.array(out[n], ARROW[t]) if isinstance(out[n], list) else out[n] for n, t in fields], [n for n, _ in fields])

    return df.mapInArrow(run, schema)


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
         "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
