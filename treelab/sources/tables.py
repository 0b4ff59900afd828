"""Feature-table sources: numeric tables, mixed-type tables, features joined to targets, shape report."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Tasks that one partition of a scan, which Spark bounds in bytes, is spread over.
PIECES = 8


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
               rename_spaces: bool = False, **options) -> DataFrame:
    """Read a table with a declared schema; ``mean radius`` becomes ``mean_radius`` on request.

    A scan with fewer partitions than cores (a few small files) is spread over the cores, and over ``PIECES`` tasks for every further
    partition, so that what a task reads does not grow with the table; any larger scan is left as it is.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt in ("csv", "json"):
        raise ValueError("text formats need a declared schema")
    df = reader.load(path)
    cores = spark.sparkContext.defaultParallelism
    found = df.rdd.getNumPartitions()
    if found < cores:
        df = df.repartition(max(cores, PIECES * (found - 1)))
    if rename_spaces:
        df = df.select(*[F.col(f"`{c}`").alias(c.strip().replace(" ", "_")) for c in df.columns])
    return df


def assemble(df: DataFrame, cols: list[str], label: str = "label", out: str = "features") -> DataFrame:
    """Feature vector with column names as ML attributes, and a double label."""
    df = VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)
    return df.withColumn(label, F.col(label).cast("double"))


def align_target(features: DataFrame, target: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Features and target that arrive as two tables, joined on the row id (never by position)."""
    return features.join(target, row_id, "inner")


def shape_report(df: DataFrame, cols: list[str], label: str = "label") -> DataFrame:
    """One row: number of rows, features and classes, and the feature names."""
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(label).alias("n_classes")).select(
        "n_rows", F.lit(len(cols)).cast("long").alias("n_features"), "n_classes",
        F.lit(",".join(cols)).alias("feature_names"))


def feature_names(spark: SparkSession, cols: list[str]) -> DataFrame:
    """The ``feature_idx -> feature`` table."""
    schema = T.StructType([T.StructField("feature_idx", T.IntegerType()), T.StructField("feature", T.StringType())])
    from treelab.functions.storage import local_table
    return local_table(spark, [{"feature_idx": i, "feature": c} for i, c in enumerate(cols)], schema)


def with_feature_names(df: DataFrame, cols: list[str]) -> DataFrame:
    """Attach names to importances or nodes by ``feature_idx``; one row per column, so the side is bounded."""
    return df.join(F.broadcast(feature_names(df.sparkSession, cols)), "feature_idx", "left")
