"""Best split of each node over every threshold, with no binning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treelab.functions.ranks import bucketize, running_totals, splitters
from treelab.operators.grower import GiniRule, NewtonRule


def exact_splits(df: DataFrame, cols: list[str], rule: GiniRule | NewtonRule, node: str = "node", buckets: int = 64) -> DataFrame:
    """The best split per node: ``(node, feature, threshold, gain, left and total sums)``.

    ``df`` carries the node, the raw features and the statistic columns of ``rule``. Every (node, feature, value) is reduced to one row first; the running sums
    over the values are built bucket by bucket, so a node holding all rows is no single task. The
    threshold is the midpoint to the next value; equal gains go to the first feature, then the
    smallest threshold. Null and NaN are missing: such rows count for no threshold of that feature.
    """
    stats = list(rule.stats)
    edges = splitters(df, cols, buckets)
    wide = bucketize(df, cols, edges, [f"__k{i}" for i in range(len(cols))])
    cells = wide.select(node, *stats, F.explode(F.array(*[
        F.struct(F.lit(i).alias("fi"), F.col(f"__k{i}").alias("bucket"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value"))
        for i, c in enumerate(cols)])).alias("s")).select(node, *stats, "s.*").where(F.col("value").isNotNull())
    counts = cells.groupBy(node, "fi", "bucket", "value").agg(
        *[F.sum(s).alias(s) for s in stats], F.count("*").alias("n"))
    sums = [*stats, "n"]
    run = running_totals(counts, [node, "fi"], "bucket", "value", sums)
    run = run.where(F.col("next").isNotNull())
    run = run.selectExpr("*", *[f"cum_{s} AS l_{s}" for s in sums], *[f"tot_{s} AS t_{s}" for s in sums],
                         *[f"tot_{s} - cum_{s} AS r_{s}" for s in sums])
    gain = F.expr(f"round({rule.gain()}, 10)")
    threshold = (F.col("value") + F.col("next.value")) / F.lit(2.0)
    top = run.select(node, F.struct(gain.alias("gain"), (-F.col("fi")).alias("nf"), (-threshold).alias("nt"),
                                    *[f"l_{s}" for s in sums],
                                    *[f"t_{s}" for s in sums]).alias("o"))
    best = top.where(F.col("o.gain").isNotNull()).groupBy(node).agg(F.max("o").alias("o"))
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), (-F.col("o.nf") + 1).cast("int"))
    return best.select(node, name.alias("feature"), (-F.col("o.nt")).alias("threshold"), F.col("o.gain").alias("gain"),
                       *[F.col(f"o.{k}_{s}").cast("double").alias(f"{k}_{s}") for k in ("l", "t") for s in sums])

