"""Sinks: appends, overwrites, upserts and dead letters, through Spark's writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.rows import keep_last, upsert


def append_json(df: DataFrame, path: str) -> None:
    """K-01."""
    df.write.mode("append").json(path)


def append_by_table(df: DataFrame, path: str, table: str) -> None:
    """K-02."""
    df.withColumn("table", F.lit(table)).write.mode("append").partitionBy("table").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """K-07."""
    df.write.mode("overwrite").parquet(path)


def overwrite_last(df: DataFrame, path: str, key: str, pos: str) -> None:
    """K-06: the last row of each key."""
    keep_last(df, [key], pos).drop(pos).write.mode("overwrite").json(path)


def swap(df: DataFrame, path: str) -> None:
    """K-08: write beside, then rename into place; a rename that fails puts the old version back and raises.

    Between the two renames, which touch no data, a reader finds no table and has to try again.
    """
    spark = df.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    name = uuid.uuid4().hex
    new, old, at = (jvm.Path(p) for p in (f"{path}.new-{name}", f"{path}.old-{name}", path))
    df.write.parquet(new.toString())
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    there = fs.exists(at)
    if there and not fs.rename(at, old):
        fs.delete(new, True)
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(new, at):
        if there and not fs.rename(old, at):
            raise OSError(f"cannot rename {new.toString()} to {path}; the old version is {old.toString()}")
        fs.delete(new, True)
        raise OSError(f"cannot rename into {path}; it is as it was")
    if there:
        fs.delete(old, True)


def merge(spark: SparkSession, new: DataFrame, path: str, key: str) -> int:
    """K-03 to K-05: an upsert of a Parquet table by key; the rows after it."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path)
    swap(upsert(spark.read.parquet(path), new, key) if there else new, path)
    return spark.read.parquet(path).count()


def dead_letters(df: DataFrame, path: str, run_id: str, stage: str) -> None:
    """K-09: rows that failed, with when and where."""
    df.withColumns({"ts": F.current_timestamp(), "run_id": F.lit(run_id), "stage": F.lit(stage)}).write.mode("append").json(path)


def report_csv(df: DataFrame, path: str) -> None:
    """K-10."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
