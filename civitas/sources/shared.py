"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> None:
    """Make spark.checkpoint.dir the checkpoint folder; where none is configured (tests on one machine), a temporary one.

    On a cluster without a configured folder this raises: a machine's own folder would not do.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        folder = tempfile.mkdtemp(prefix="civitas-")
    context.setCheckpointDir(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder: a lost executor costs a read, and no plan grows from round to round."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder as parquet and read from there: what several steps use is worked out once."""
    checkpoint_folder(df.sparkSession)
    path = os.path.join(df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().get(), uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt over all cores by keys, before work that is long for each row.

    Tasks follow the size of a file, so that a small table of long work would keep a core or two busy. A given
    number of partitions is one that adaptive execution leaves as it is.
    """
    spark = rows.sparkSession
    return rows.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


#: Bytes of rows that a task hands to Python at once.
BATCH = 8 << 20


def small_batches(df: DataFrame) -> None:
    """Let Spark hand Python BATCH bytes of rows at once, not 10,000 rows of any length; a setting of the session, read when a plan runs."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
