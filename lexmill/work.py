"""The shared work folder: where intermediate tables are written, and lineage ends."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from lexmill.session import shipped


def work_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    The setting is only made up (a temporary folder) where it is unset and the master is
    local, as in tests; on a cluster without it this raises.
    """
    shipped(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = getattr(work_dir, "base", None)
        if base is None:
            base = work_dir.base = tempfile.mkdtemp(prefix="lexmill-")
            atexit.register(shutil.rmtree, base, True)
        base = "file://" + base
    return f"{base.rstrip('/')}/lexmill-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str, codec: str = "zstd") -> DataFrame:
    """df as a Parquet table in the shared folder, reread: lineage ends here."""
    path = f"{folder}/{name}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of the work folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def released(spark: SparkSession) -> None:
    """Let the driver forget tables that are out of use, so that their shuffle files go now and not at some later collection."""
    gc.collect()
    spark._jvm.System.gc()
