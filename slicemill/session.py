"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "slicemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot join key even where that costs one more shuffle afterwards
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset and the master is local (tests, a laptop) a new folder is made and set for
    the session; on a cluster a folder of one machine would lose what other machines write.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; never reused, so nothing has to be deleted first."""
    return f"{shared_root(spark)}/slicemill/{name}-{uuid.uuid4().hex}"


SHRED = "spark.sql.variant.inferShreddingSchema"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def held(spark: SparkSession, key: str, value: str):
    """The setting has this value meanwhile, and the one from before afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def whole_variants(spark: SparkSession):
    """Variants written meanwhile stay one value each.

    Shredded, a nested document becomes some fifty Parquet columns; rows of a layer that is read as whole documents are
    taken apart and put together again for nothing.
    """
    return held(spark, SHRED, "false")


def freed_shuffles(spark: SparkSession):
    """What is written meanwhile leaves no shuffle files: they go with the write that made them.

    Else they stay until the driver happens to collect its garbage, beside those of all writes before.
    """
    return held(spark, FREE_SHUFFLES, "true")


def drop_work(spark: SparkSession, path: str) -> None:
    """Deletes a folder below ``work_path`` that nothing reads any more, by the file system that Spark wrote it with."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
