"""Feature tables with planted targets, built from the supplied tables.

The supplied labels carry no signal, so each table plants one by a fixed rule and flips about 5 % of it by
a hash that any SQL engine can repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treelab.functions.hashing import unit_below, unit_hash
from treelab.operators.clean import clean_features
from treelab.operators.resample import stratified_folds, stratified_split
from treelab.sources.sine import noisy_sine
from treelab.sources.tables import read_table

#: The width of the vectors in ``embeddings``; every entry is a feature.
VECTOR_SIZE = 64
WIDE_COLS = [f"f{i}" for i in range(VECTOR_SIZE)]
MIXED_COLS = ["o_totalprice", "c_acctbal", "c_nationkey", "o_orderpriority", "c_mktsegment", "o_orderstatus"]
SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _flipped(clean: Column, *key) -> Column:
    c = clean.cast("int")
    return F.when(unit_below(0.05, *key), 1 - c).otherwise(c).alias("label")


def wide_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries of the vectors as numeric features (embeddings)."""
    df = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(VECTOR_SIZE)])
    clean = ((F.col("f14") > 0) & (F.col("f28") > -0.1)) | (F.col("f3") > 0.15)
    return df.select("*", _flipped(clean, F.col("row_id"), "flip"))


def mixed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, texts and planted nulls (orders with their customers)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    df = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    clean = (F.col("o_totalprice") > 300000) | (
        (F.col("c_acctbal") < 2000) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    hidden = unit_below(0.02, F.col("o_orderkey"), "null")
    return df.select(
        F.col("o_orderkey").alias("row_id"), "o_totalprice", F.when(~hidden, F.col("c_acctbal")).alias("c_acctbal"),
        "c_nationkey", "o_orderpriority", "c_mktsegment", "o_orderstatus",
        _flipped(clean, F.col("o_orderkey"), "flip"))


def mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mixed_raw`` cleaned: complete rows, texts as ranks, all features double."""
    return clean_features(mixed_raw(spark, sf_dir), MIXED_COLS)


def scale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four numeric features over the largest table (lineitem)."""
    df = table(spark, sf_dir, "lineitem")
    row_id = F.concat_ws(":", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         F.round(F.col("l_extendedprice") * 100).cast("long"))
    clean = (F.col("l_quantity") > 30) & (F.col("l_discount") < 0.06)
    return df.select(row_id.alias("row_id"), *SCALE_COLS, clean.alias("c")).select(
        "row_id", *SCALE_COLS, _flipped(F.col("c"), F.col("row_id")))


def split_rows(df: DataFrame, seed: int = 42) -> DataFrame:
    return stratified_split(df, "label", "row_id", 0.2, seed)


def sine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regression demo with one point per order: x hashed from the key, y = sin(x) + noise."""
    df = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), (F.lit(10.0) * unit_hash(F.col("o_orderkey"), "x")).alias("x"))
    return noisy_sine(df, F.col("x"), 0.1, 42)


#: Weights (price, priority, noise) of the three fixed score formulas that stand in for models.
SCORE_WEIGHTS = {"price": (0.8, 0.1, 0.1), "priority": (0.3, 0.5, 0.2), "noise": (0.1, 0.1, 0.8)}


def scored_rows(spark: SparkSession, sf_dir: str, folds: int = 0) -> DataFrame:
    """Scores by a fixed formula with many ties: ``(model, row_id, split, label, p1, prediction)``, and ``fold`` if asked for."""
    df = mixed_raw(spark, sf_dir)
    df = split_rows(df.where(F.col("c_acctbal").isNotNull()))
    extra = ["fold"] if folds else []
    df = stratified_folds(df, folds) if folds else df
    price = F.least(F.col("o_totalprice"), F.lit(500000.0)) / F.lit(500000.0)
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("double")
    u = unit_hash(F.col("row_id"), "score")
    cols = [F.struct(F.lit(name).alias("model"), (
        F.floor((F.lit(a) * price + F.lit(b) * urgent + F.lit(c) * u) * 100) / F.lit(100.0)).alias("p1"))
        for name, (a, b, c) in SCORE_WEIGHTS.items()]
    return df.select("row_id", "split", "label", *extra, F.explode(F.array(*cols)).alias("s")).select(
        "s.model", "row_id", "split", "label", *extra, "s.p1", (F.col("s.p1") >= 0.5).cast("int").alias("prediction"))
