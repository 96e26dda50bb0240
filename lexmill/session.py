"""What a session needs before Python workers run this package's functions."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def shipped(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a context; they need not have it installed."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")  # whole texts travel in these batches
    if getattr(shipped, "to", None) is sc:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lexmill-code-")  # the context fetches it from here as executors come
    atexit.register(shutil.rmtree, folder, True)
    with zipfile.ZipFile(f"{folder}/{root.name}.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(f"{folder}/{root.name}.zip")
    shipped.to = sc
