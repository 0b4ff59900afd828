"""Tasks that run side by side and exchange bytes, as Spark's barrier stages allow."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import BarrierTaskContext
from pyspark.sql import SparkSession

#: Most tasks of a gang: each receives what all others send.
MAX_GANG = 64


def gang_size(spark: SparkSession) -> int:
    """Tasks that can run at the same time in this session; 1 if executors come and go."""
    if spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 1
    context = spark.sparkContext._jsc.sc()
    slots = context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())
    return max(1, min(slots, MAX_GANG))


def gather(data: bytes) -> list[bytes]:
    """Inside a task of a barrier stage: the data of all its tasks, in the order of their partitions."""
    return [base64.b64decode(x) for x in BarrierTaskContext.get().allGather(base64.b64encode(data).decode())]


def first_of_gang() -> bool:
    return BarrierTaskContext.get().partitionId() == 0


@contextmanager
def anywhere(spark: SparkSession) -> Iterator[None]:
    """Jobs started here wait for no preferred executor: the tasks of a gang start together or not at all, and where more of them prefer an
    executor than it has room for they would wait for ever."""
    conf, name = spark.sparkContext._jsc.sc().conf(), "spark.locality.wait"
    before = conf.get(name, None)
    conf.set(name, "0s")
    try:
        yield
    finally:
        conf.set(name, before) if before else conf.remove(name)
