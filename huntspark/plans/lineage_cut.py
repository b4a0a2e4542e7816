"""Tables in the shared folder that cut the lineage of iterative plans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; where none is named, one in the session's warehouse,
    which a cluster shares as well. Never a temporary folder of one machine."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as a table to the shared checkpoint folder and read back.

    It survives the loss of executors, is computed once however often it is used, is read by column, and its size is
    known to the planner.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
