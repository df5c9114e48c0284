"""Where a table that a plan uses several times is computed once."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """df, computed now and kept in the checkpoint folder that driver and executors share, so that what follows is planned without what made it.

    The folder is the session's spark.checkpoint.dir; where none is set a local master takes a temporary one, and a cluster is an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
