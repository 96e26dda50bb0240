"""What the training-data operators share: the work folder, the tables and the words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.session import shipped
from lexmill.work import released, removed, work_dir, written

#: The characters that separate words: blank and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed() -> None:
    """Give the memory that this worker has freed back: it stays for later tasks, and an executor has several."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


__all__ = ["WORD", "released", "removed", "shipped", "table", "trimmed", "work_dir", "written"]
