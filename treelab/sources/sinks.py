"""Report sinks: fixed-width text lines and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def text_report(df: DataFrame, name: str, metrics: list[str], width: int = 30) -> DataFrame:
    """One fixed-width line per row: padded name, then every metric with four decimals.

    A name longer than the width is kept whole.
    """
    clean = F.regexp_replace(F.col(name), "\n", " ")
    numbers = [F.format_string("%8.4f", F.col(m)) for m in metrics]
    padded = F.when(F.length(clean) >= width, clean).otherwise(F.rpad(clean, width, " "))
    return df.select(clean.alias(name), F.concat_ws(" ", padded, *numbers).alias("line"))


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
