"""Shared-folder storage: lineage cuts and size-checked small tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Rows up to which a bounded result travels through the driver as a local table.
LOCAL_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A session in one process (master ``local``) that names none gets a temporary folder of its own, since there the driver is
    the only executor. On a cluster the setting must be there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="treelab-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(path)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and keeps plans short in loops."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def local_table(spark: SparkSession, rows: list[dict] | pd.DataFrame, schema: T.StructType) -> DataFrame:
    """A table of rows held by the driver, with exact size statistics.

    Built from Arrow it becomes a local relation, so Spark broadcasts it only while it is below
    ``autoBroadcastJoinThreshold`` and shuffles it otherwise; no join here carries a hint.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    if isinstance(rows, pd.DataFrame):
        table = pa.Table.from_pandas(rows[[f.name for f in arrow]], schema=arrow, preserve_index=False)
    else:
        table = pa.Table.from_pylist(rows, schema=arrow)
    return spark.createDataFrame(table, schema=schema)


def settle_small(df: DataFrame, max_rows: int = LOCAL_ROWS) -> DataFrame:
    """Compute a small table once; Spark knows its size and broadcasts it only below its limit. Above ``max_rows`` it is checkpointed."""
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows <= max_rows:
        return df.sparkSession.createDataFrame(head, schema=df.schema)
    return cut_lineage(df)
