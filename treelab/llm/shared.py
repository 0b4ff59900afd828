"""Intermediate tables in the folder that all executors of a session share."""

from __future__ import annotations

import atexit
import contextlib
import gc
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from treelab.functions.storage import shared_dir


#: Settled tables of this driver as (folder name, call that removes it): all of them in order, and those of stages that may still be read.
_made: list[tuple[str, Callable[[], None]]] = []
_of_stages: list[tuple[str, Callable[[], None]]] = []


def folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark itself resolves it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again: computed once, lineage cut, size known to the planner."""
    path = folder(df.sparkSession, name)
    _remove_at_exit(df.sparkSession, path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs that begin inside send a Python task at most ``most`` rows at a time; a smaller setting of the session stands."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= most:
        yield
        return
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Intermediate tables go when the driver ends; results that are still to be read need them until then."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def remove() -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            store.delete(place, True)

    atexit.register(remove)
    _made.append((place.getName(), remove))


def staged(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage of a chain whose results are written one by one: its settled tables go when the next stage begins.

    Tables that the next stage's rows still read (if a result was passed on unwritten) stay until a later stage begins. A result
    that is to be read after another stage began must be written before.
    """
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, docs)
        begin = len(_made)
        try:
            return stage(spark, docs, sf_dir)
        finally:
            _of_stages.extend(_made[begin:])
            del _made[begin:]

    return run


def settle_stage(df: DataFrame, name: str) -> DataFrame:
    """Settles the result of a stage for the next one only."""
    out = settle(df, name)
    _of_stages.append(_made.pop())
    return out


def release(spark: SparkSession, docs: DataFrame) -> None:
    """Removes the settled tables of earlier stages that ``docs`` does not read; Spark drops the shuffle files of plans collected here."""
    if not _of_stages:
        return
    read = {part for file in docs.inputFiles() for part in file.split("/")}
    kept = [(name, remove) for name, remove in _of_stages if name in read]
    for name, remove in _of_stages:
        if name not in read:
            remove()
    _of_stages[:] = kept
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str):
    """A text column, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))
