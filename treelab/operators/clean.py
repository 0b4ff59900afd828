"""Cleaning and encoding of mixed-type feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from treelab.functions.ranks import sorted_ranks
from treelab.functions.storage import settle_small


def encode_sorted(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """Replace each column by the rank of its text among the sorted distinct texts ("10" < "2").

    A missing value counts as the text ``nan``. Ranks are computed by range partitions and joined back; Spark broadcasts a level
    table that is small, and splits the partitions of a text that dominates otherwise.
    """
    order = [c if c not in cols or not suffix else c for c in df.columns] + [c + suffix for c in cols if suffix]
    work = df.select("*", *[F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias(f"__t_{c}") for c in cols])
    for c in cols:
        levels = settle_small(sorted_ranks(work.select(f"__t_{c}").distinct(), f"__t_{c}", f"__r_{c}"))
        work = work.join(levels, f"__t_{c}")
    return work.withColumns({c + suffix: F.col(f"__r_{c}").cast("int") for c in cols}).select(*order)


def target_classes(df: DataFrame, target: str) -> DataFrame:
    """The sorted distinct target texts with their codes: ``(label_name, code)``."""
    names = df.select(F.coalesce(F.col(target).cast("string"), F.lit("nan")).alias("label_name")).distinct()
    return sorted_ranks(names, "label_name", "code")


def collapse_binary(df: DataFrame, code: str, out: str = "label") -> DataFrame:
    """Every class above the first becomes 1."""
    return df.withColumn(out, (F.col(code) > 0).cast("int"))


def drop_missing(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Keep rows whose features are all present; the target is not looked at."""
    return df.na.drop("any", subset=feature_cols)


def categorical_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns to encode by type; fails on a type that is neither text nor number."""
    out = []
    for c in cols:
        kind = df.schema[c].dataType
        if isinstance(kind, (T.StringType, T.BooleanType)):
            out.append(c)
        elif not isinstance(kind, T.NumericType):
            raise TypeError(f"column {c!r} has unsupported type {kind.simpleString()}")
    return out


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cast to double; what cannot be read as a number becomes missing."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def clean_features(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Drop incomplete rows, encode text columns, cast everything to double (in this order)."""
    df = drop_missing(df, feature_cols)
    texts = categorical_columns(df, feature_cols)
    if texts:
        df = encode_sorted(df, texts)
    return coerce_numeric(df, feature_cols)


def relabel(df: DataFrame, code: str, names: dict, out: str) -> DataFrame:
    """Display names for codes; a code without a name stays as text."""
    chain = None
    for k, v in names.items():
        chain = F.when(F.col(code) == k, v) if chain is None else chain.when(F.col(code) == k, v)
    return df.withColumn(out, chain.otherwise(F.col(code).cast("string")))


def metrics_wide(long: DataFrame, row: str = "model", col: str = "metric", value: str = "value",
                 metrics: list[str] | None = None) -> DataFrame:
    """One row per model, one column per metric."""
    return long.groupBy(row).pivot(col, metrics).agg(F.first(value))


def clean_names(df: DataFrame, col: str = "model") -> DataFrame:
    """Line breaks in display names become blanks."""
    return df.withColumn(col, F.regexp_replace(col, "\n", " "))
