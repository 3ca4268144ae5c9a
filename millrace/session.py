"""Sending the package to the executors, and working tables in the folder they share."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once a context: their Python may not find it by itself."""
    context = spark.sparkContext
    if not getattr(context, "_millrace_shipped", False):
        package = Path(__file__).resolve().parent
        # The driver serves the file as long as it lives.
        folder = tempfile.mkdtemp()
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        staged = shutil.copytree(package, Path(folder, "zip", package.name), ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(str(Path(folder, package.name)), "zip", staged.parent))
        context._millrace_shipped = True


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table under spark.checkpoint.dir and read it back, so that it is computed once; a cluster without that setting is refused."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "millrace")
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # Shuffle files of what has been written would stay until the driver happens to collect its garbage.
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)
