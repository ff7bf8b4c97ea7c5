"""Intermediate tables that outlive the executors that made them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, one in the warehouse in local mode; on a cluster that is an error."""
    conf = spark.sparkContext.getConf()
    folder = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder, with its lineage cut there."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
