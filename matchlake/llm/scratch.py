"""Tables in the folder that the driver and all executors share, used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Spark removes the shuffle files of a query when it ends. A table that `cut` has written never reads them again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a new local one only on one machine (tests). Elsewhere a missing setting is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def cut(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder as Parquet and read again: computed once, and safe against lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Empties tables of `cut` from which nothing is going to be read any more."""
    for t in tables:
        t.sparkSession.createDataFrame([], t.schema).write.mode("overwrite").parquet(t.cut_path)


def with_workers(spark: SparkSession) -> SparkSession:
    """Python workers on this machine find this package even if the driver only put it on sys.path."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark
