"""Session helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ship

#: Rows in an Arrow batch; texts may be long, so a batch stays small.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data; the path is opened by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that Python's memory does not depend on the partition."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that the cluster names.

    Only where spark.checkpoint.dir is unset and all tasks run on this machine, as in
    tests, a local one is made; a cluster without that setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "millrace")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.millrace_path = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Delete tables of `keep` once all that was made of them has been written itself."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.millrace_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
