"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.chunks import forget


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 3; fold 1 is held out from all learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold_of(doc_id) == 1, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, one in the warehouse in local mode, as in tests; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, with its lineage cut there."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def per_batch(df: DataFrame, schema: str, f: Callable[[pa.RecordBatch], Iterator[dict]], table: str = "") -> DataFrame:
    """``mapInArrow`` with a function from one batch to column dictionaries. Workers forget chunk tables of other kinds than ``table``, and return free memory."""

    def apply(batches):
        names = None
        forget(table)
        for batch in batches:
            if batch.num_rows:
                for columns in f(batch):
                    names = names or list(columns)
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(apply, schema)
