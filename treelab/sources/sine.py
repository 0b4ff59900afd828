"""The one-dimensional regression demo: evenly spaced x in [0, 10], y = sin(x) + noise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treelab.functions.hashing import normal_hash


def sine_table(spark: SparkSession, n: int = 100, noise_sd: float = 0.1, seed: int = 42) -> DataFrame:
    return noisy_sine(spark.range(n).select(
        F.col("id").alias("row_id"), (F.lit(10.0) * F.col("id") / F.lit(n - 1)).alias("x")), F.col("x"), noise_sd, seed)


def noisy_sine(df: DataFrame, x: Column, noise_sd: float = 0.1, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Add ``y`` to any table; the noise is hashed from the row id, so every engine draws the same."""
    return df.withColumn("y", F.sin(x) + F.lit(noise_sd) * normal_hash(F.col(row_id), seed))
