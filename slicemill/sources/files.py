"""Readers with explicit schemas, numbered lines, content fingerprints and batch planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicemill.functions.aggregates import digest_parts
from slicemill.functions.columns import payload_hash
from slicemill.operators.relations import not_in_keys

ENTITIES = ["matches", "shots"]
BATCH_KEY = ["source_system", "entity", "file_path", "file_sha256"]


# --- typed readers -----------------------------------------------------------------------------

def read_typed_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, row_no: bool = False) -> DataFrame:
    """CSV by explicit schema: header checked, malformed rows fail, empty text is NULL.

    ``row_no`` adds the row's number within its file, counted from 1.
    """
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
          .option("mode", "FAILFAST").option("nullValue", "")
          .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("dateFormat", "yyyy-MM-dd").csv(path))
    return number_rows(df, "row_no") if row_no else df


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet; a saved schema keeps text partition values such as ``007`` as they were."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def sql_on_path(spark: SparkSession, path: str, where: str = "true") -> DataFrame:
    """A Parquet path used directly as a SQL relation."""
    return spark.sql(f"SELECT * FROM parquet.`{path}` WHERE {where}")


def decoded(path: Column) -> Column:
    """The path of a file from its URL form in the metadata, as manifests and listings name it."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


# --- numbering ---------------------------------------------------------------------------------

def number_rows(scan: DataFrame, name: str, file: str | None = None) -> DataFrame:
    """Number the rows of each file from 1 in file order, for scans of any size.

    A file is read as blocks, each by one task in order. The id Spark gives to rows grows by one
    inside a block, so a row's place in its block is its id minus the block's smallest id, and its
    place in the file adds the rows of the blocks before. The files are read twice, once for the
    counts per block, and the rows meet their block's offset in a join by block, which shuffles them
    unless the offsets are small enough to be broadcast. A recomputed task gets the same ids.
    ``file`` keeps the path of the file under that name.
    """
    cols = scan.columns
    tagged = scan.select("*", F.col("_metadata.file_path").alias("_file"),
                         F.col("_metadata.file_block_start").alias("_block"),
                         F.monotonically_increasing_id().alias("_id"))
    blocks = tagged.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_file", "_block", "_first",
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    out = tagged.join(offsets, ["_file", "_block"], "inner")
    number = F.col("_before") + F.col("_id") - F.col("_first") + 1
    return out.select(*cols, number.alias(name), *([decoded(F.col("_file")).alias(file)] if file else []))


PLACE = ["file", "block", "place"]


def place_rows(scan: DataFrame) -> DataFrame:
    """Adds where a row lies: its file, the start of its block and its place there, in one scan without a shuffle.

    Places grow inside a block in file order, so (block, place) is the order of a file's rows. Store them with the rows;
    a number that is dense as well can be had from what was stored, see ``dense_numbers``.
    """
    return scan.select("*", decoded(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("place"))


def block_offsets(stored: DataFrame) -> DataFrame:
    """(file, block, first place, rows of the file before it) from the stored places: one row for each block."""
    blocks = stored.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"), F.min("place").alias("_first"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("file", "block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))


def dense_numbers(some: DataFrame, offsets: DataFrame, name: str) -> DataFrame:
    """Numbers from 1 in file order for any of the stored rows, by the offsets of their blocks."""
    number = F.col("_before") + F.col("place") - F.col("_first") + 1
    return some.join(offsets, ["file", "block"]).withColumn(name, number).drop("_before", "_first")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Non-blank lines with their file and their number among the non-blank lines of that file."""
    text = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_path"))
    lines = number_rows(text.where(F.trim("value") != ""), "line_no")
    return lines.select("value", decoded(F.col("_path")).alias("file"), "line_no")


def read_envelopes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSON lines split into ``envelope`` (empty object when absent) and ``payload``."""
    doc = F.parse_json("value")
    parsed = read_lines(spark, paths).select("file", "line_no", doc.alias("doc"))
    envelope = F.coalesce(F.variant_get("doc", "$._source", "variant"), F.parse_json(F.lit("{}")))
    return parsed.select("file", "line_no", envelope.alias("envelope"),
                         F.variant_get("doc", "$.record", "variant").alias("payload"))


# --- fingerprints and manifests ----------------------------------------------------------------

def file_fingerprints(spark: SparkSession, paths: str | list[str], method: str = "bytes") -> DataFrame:
    """(file, sha256, row_count) per file.

    ``bytes`` hashes the whole content, one file in one task, up to the 2 GB that a value can hold.
    ``lines`` is the caller's choice for larger files: a digest of the numbered lines, which is spread out and sees
    their order, prefixed ``lines:``. A registry should stay with one method: the other gives other hashes.
    """
    text = spark.read.text(paths).select("value", decoded(F.col("_metadata.file_path")).alias("file"))
    counts = text.groupBy("file").agg(F.count_if(F.trim("value") != "").alias("row_count"))
    binary = spark.read.format("binaryFile").load(paths)
    if method == "bytes":
        hashes = binary.select(F.col("path").alias("file"), F.sha2("content", 256).alias("sha256"))
    elif method == "lines":
        n, hi, lo = digest_parts(["line_no", "value"])
        lines = number_rows(spark.read.text(paths), "line_no", "file").groupBy("file").agg(n, hi, lo)
        lines = lines.select("file", F.concat_ws(":", "n", "hi", "lo").alias("_text"))
        # the listing knows files without lines, too
        hashes = binary.select(F.col("path").alias("file")).join(lines, "file", "left").select(
            "file", F.concat(F.lit("lines:"), F.sha2(F.coalesce("_text", F.lit("")), 256)).alias("sha256"))
    else:
        raise ValueError(f"unknown method: {method}")
    # a file of blank lines has bytes to hash but no rows; one without bytes is not in the scan
    return hashes.join(counts, "file", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))


def source_manifest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Hash and number of events per source file."""
    return file_fingerprints(spark, paths).select(
        "file", F.col("sha256"), F.col("row_count").alias("events_total"))


def plan_batches(manifest: DataFrame, registry: DataFrame, files: DataFrame) -> DataFrame:
    """Action per batch: ``load`` a new file, ``skip`` one loaded with the same content, ``drop`` one
    that the manifest no longer lists.

    manifest: file_path, entity, source_system, batch_seq, scenario; files: file_path, file_sha256,
    row_count; registry: as written by ``apply_batches``.
    """
    known = F.when(F.col("entity").isin(ENTITIES), F.col("entity")).otherwise(
        F.raise_error(F.concat(F.lit("unknown entity: "), F.coalesce("entity", F.lit("NULL")))))
    # a listed file without content is not among the files that a scan finds
    wanted = (manifest.withColumn("entity", known).join(files, "file_path", "left")
              .withColumns({"file_sha256": F.coalesce("file_sha256", F.sha2(F.lit(b""), 256)), "row_count": F.coalesce("row_count", F.lit(0))})
              .select(*BATCH_KEY, "batch_seq", "scenario", "row_count"))
    have = registry.select(*BATCH_KEY, F.col("batch_id").alias("_batch_id"), F.col("row_count").alias("_rows"),
                           F.col("batch_seq").alias("_seq"), F.col("scenario").alias("_scenario"))
    both = wanted.withColumn("_wanted", F.lit(True)).join(have, BATCH_KEY, "full_outer")
    action = (F.when(F.col("_wanted").isNull(), "drop").when(F.col("_batch_id").isNull(), "load").otherwise("skip"))
    return both.select(F.col("_batch_id").alias("batch_id"), *BATCH_KEY,
                       F.coalesce("batch_seq", "_seq").alias("batch_seq"),
                       F.coalesce("scenario", "_scenario").alias("scenario"),
                       F.coalesce("row_count", "_rows").alias("row_count"), action.alias("action"))


def apply_batches(plan: DataFrame, registry: DataFrame, run_id: str, issued: DataFrame | None = None) -> DataFrame:
    """The registry after a plan: dropped batches gone, skipped ones refreshed, new ones added.

    A new batch is numbered above all ids ever given (``issued``; without it those of the registry) by its
    place in the manifest, so that the id of a dropped batch never comes back.
    """
    top = (registry if issued is None else issued).agg(F.coalesce(F.max("batch_id"), F.lit(0)).alias("top"))
    new_id = top.scalar() + F.col("batch_seq")
    meta = registry.select(F.col("batch_id").alias("_b"), F.col("run_id").alias("_run"),
                           F.col("loaded_at").alias("_at"))
    kept = plan.where("action <> 'drop'").join(meta, F.col("batch_id") == F.col("_b"), "left")
    return kept.select(F.coalesce("batch_id", new_id).cast("bigint").alias("batch_id"), "batch_seq", "scenario",
                       *BATCH_KEY, "row_count", F.coalesce("_run", F.lit(run_id)).alias("run_id"),
                       F.coalesce("_at", F.current_timestamp()).alias("loaded_at"))


def drop_batches(raw: DataFrame, plan: DataFrame) -> DataFrame:
    """Raw rows without those of dropped batches."""
    return not_in_keys(raw, plan.where("action = 'drop'"), ["batch_id"])


def raw_rows(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """Envelope lines with the batch they belong to and the hash of their canonical content.

    Writing a document out in canonical form costs more than reading all its fields, so the hash is
    made once, when the row is loaded, and stored with it.
    """
    batches = registry.select("batch_id", "source_system", "entity", F.col("file_path").alias("file"))
    return lines.join(batches, "file", "inner").select(
        "batch_id", "line_no", "source_system", "entity", "envelope", "payload",
        payload_hash("payload").alias("payload_hash"))


def raw_summary(matches: DataFrame, shots: DataFrame) -> DataFrame:
    """Raw rows per entity and source."""
    def tag(df: DataFrame, entity: str) -> DataFrame:
        return df.select(F.lit(entity).alias("entity"), "source_system")

    return (tag(matches, "matches").unionByName(tag(shots, "shots")).groupBy("entity", "source_system")
            .agg(F.count(F.lit(1)).alias("rows")).orderBy("entity", "source_system"))


def file_name(c: str | Column = "file") -> Column:
    """Last path part of a file column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.element_at(F.split(c, "/"), -1)
