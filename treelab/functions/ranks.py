"""Global order statistics without a global sort in one task.

Running sums, exact quantiles and ranks over one hot key: the rows are pre-aggregated per value, cut
into ordered buckets, the (small) bucket totals are summed first, and only then each bucket is ordered
on its own. No task ever sees a whole group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from treelab.functions.storage import cut_lineage, settle_small


def splitters(df: DataFrame, cols: list[str], n: int, accuracy: int = 2000) -> list[list[float]]:
    """About ``n`` equal-frequency cut points per column, by a bounded sketch in one pass."""
    probs = [k / n for k in range(1, n)]
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])).alias("s")).select("s.*")
    known = cells.where(F.col("v").isNotNull() & ~F.isnan("v"))
    found = {r["i"]: r["cuts"] for r in known.groupBy("i").agg(F.percentile_approx("v", probs, accuracy).alias("cuts")).collect()}
    return [sorted({float(v) for v in found.get(i) or []}) for i in range(len(cols))]


def bucketize(df: DataFrame, cols: list[str], edges: list[list[float]], outs: list[str]) -> DataFrame:
    """Bucket index = number of edges strictly below the value, so ``value <= edge`` stays left.

    Null and NaN give -1. Columns without an edge have the single bucket 0.
    """
    used = [i for i in range(len(cols)) if edges[i]]
    tmp = {i: f"__x{i}" for i in used}
    wide = df.select("*", *[F.nanvl(F.col(cols[i]).cast("double"), F.lit(None).cast("double")).alias(tmp[i])
                            for i in used])
    if used:
        wide = Bucketizer(
            splitsArray=[[-math.inf, *[float(np.nextafter(e, math.inf)) for e in edges[i]], math.inf] for i in used],
            inputCols=[tmp[i] for i in used], outputCols=[f"__b{i}" for i in used],
            handleInvalid="keep").transform(wide)
    picked = []
    for i, out in enumerate(outs):
        if i in tmp:
            picked.append(F.when(F.col(tmp[i]).isNull(), -1).otherwise(F.col(f"__b{i}").cast("int")).alias(out))
        else:
            x = F.col(cols[i]).cast("double")
            picked.append(F.when(x.isNull() | F.isnan(x), -1).otherwise(0).alias(out))
    return wide.select(*[F.col(f"`{c}`") for c in df.columns], *picked)


def running_totals(counts: DataFrame, keys: list[str], bucket: str, value: str, sums: list[str]) -> DataFrame:
    """Inclusive running sums of ``sums`` in ``value`` order within ``keys``.

    ``counts`` holds one row per (keys, bucket, value), ``bucket`` not decreasing in ``value``. Adds
    ``cum_<sum>``, the key's total ``tot_<sum>`` and ``next``: the struct (value, sums) of the following value, null at the end.
    """
    counts = cut_lineage(counts)  # read twice below; it is pre-aggregated, the scan behind it is not
    first = F.min(F.struct(value, *sums)).alias("__first")
    per_bucket = counts.groupBy(*keys, bucket).agg(*[F.sum(s).alias(f"__t_{s}") for s in sums], first)
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    small = whole.orderBy(bucket)
    offsets = per_bucket.select(
        *keys, bucket, *[(F.sum(f"__t_{s}").over(small) - F.col(f"__t_{s}")).alias(f"__o_{s}") for s in sums],
        *[F.sum(f"__t_{s}").over(whole).alias(f"tot_{s}") for s in sums],
        F.lead("__first").over(small).alias("__next_first"))
    inside = Window.partitionBy(*keys, bucket).orderBy(value)
    joined = counts.join(offsets, [*keys, bucket])
    return joined.select(
        *[F.col(f"`{c}`") for c in counts.columns],
        *[(F.sum(s).over(inside) + F.col(f"__o_{s}")).alias(f"cum_{s}") for s in sums],
        *[f"tot_{s}" for s in sums],
        F.coalesce(F.lead(F.struct(value, *sums)).over(inside), F.col("__next_first")).alias("next"))


def exact_quantiles(long: DataFrame, keys: list[str], value: str, probs: list[float],
                    accuracy: int = 10_000) -> DataFrame:
    """Exact linearly interpolated quantiles per key: columns ``keys, prob, n, quantile``.

    A bounded sketch brackets every quantile (its rank error is at most n/accuracy, the bracket is twice
    that wide); a second pass counts what lies below each bracket and orders only the values inside it.
    """
    if not keys:
        return exact_quantiles(long.withColumn("__k", F.lit(0)), ["__k"], value, probs, accuracy).drop("__k")
    slack = 2.0 / accuracy
    asked = [p for q in probs for p in (max(0.0, q - slack), min(1.0, q + slack))]
    long = long.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    sketch = long.groupBy(*keys).agg(F.percentile_approx("__v", asked, accuracy).alias("__a"),
                                     F.count("*").alias("n"))
    brackets = sketch.select(*keys, "n", F.explode(F.array(*[
        F.struct(F.lit(float(q)).alias("prob"), F.col("__a")[2 * i].alias("lo"), F.col("__a")[2 * i + 1].alias("hi"))
        for i, q in enumerate(probs)])).alias("__b")).select(*keys, "n", "__b.*")
    zone = F.when(F.col("__v") < F.col("lo"), -1).when(F.col("__v") > F.col("hi"), 1).otherwise(0)
    rows = long.join(settle_small(brackets), keys)
    counted = (rows.withColumn("zone", zone)
               .withColumn("inner", F.when(F.col("zone") == 0, F.col("__v")))
               .groupBy(*keys, "prob", "n", "zone", "inner")
               .agg(F.count("*").alias("cnt"), F.max("__v").alias("vmax"), F.min("__v").alias("vmin")))
    order = Window.partitionBy(*keys, "prob").orderBy("zone", "inner")
    pos = F.col("prob") * (F.col("n") - 1)
    ranked = (counted.withColumn("upto", F.sum("cnt").over(order))
              .withColumn("r_lo", F.floor(pos) + 1)
              .withColumn("r_hi", F.least(F.floor(pos) + 2, F.col("n"))))

    def at(rank: str) -> Column:
        # below the bracket only its largest value is a candidate, above it only its smallest
        hit = (F.col(rank) > F.col("upto") - F.col("cnt")) & (F.col(rank) <= F.col("upto"))
        return F.max(F.when(hit, F.when(F.col("zone") == -1, F.col("vmax")).otherwise(F.col("vmin"))))

    out = ranked.groupBy(*keys, "prob", "n").agg(at("r_lo").alias("lo"), at("r_hi").alias("hi"))
    frac = pos - F.floor(pos)
    return out.select(*keys, "prob", "n", (F.col("lo") + (F.col("hi") - F.col("lo")) * frac).alias("quantile"))


#: Distinct hash keys of a bucket that may come to the driver to pick one by rank.
MAX_BUCKET_KEYS = 50_000
#: Digits of a whole hash key.
KEY_DIGITS = 32


@dataclass(frozen=True)
class Cut:
    """The hash key at a rank; ``taken`` of the ``rows`` rows that have this key are at or before the rank."""

    key: str
    taken: int
    rows: int


def hash_cuts(df: DataFrame, label: str, key: Column, ranks_of) -> dict:
    """Per label, the ``Cut`` at each of the given ranks (1-based) of the hash order; None for rank 0.

    ``ranks_of`` turns the class sizes {label: n} into {label: [ranks]}. One job counts the rows per class
    and hash prefix (three hex digits: 4,096 buckets); the buckets that hold a wanted rank are narrowed by three more
    digits at a time, all targets together, until their rows are few or the key is whole. Rows with equal keys
    are counted, so they never hold up the search. No row is shuffled or sorted.
    """
    keyed = df.select(F.col(label).alias("label"), key.alias("hkey"))

    def counts(rows: DataFrame, digits: int) -> dict:
        out: dict = {}
        grouped = rows.groupBy("label", F.substring("hkey", 1, digits).alias("prefix")).count()
        for r in grouped.collect():  # at most classes x 4,096 rows, or MAX_BUCKET_KEYS, per bucket looked at
            out.setdefault(r["label"], {})[r["prefix"]] = r["count"]
        return out

    def inside(buckets: set) -> DataFrame:
        parts = []
        for digits in sorted({len(p) for _, p in buckets}):
            prefix, same = F.substring("hkey", 1, digits), sorted((b for b in buckets if len(b[1]) == digits), key=str)
            # the prefix test first: it turns nearly all rows away with a single hash
            parts.append(prefix.isin(sorted({p for _, p in same})) & reduce(Column.__or__, [
                F.col("label").eqNullSafe(F.lit(lab)) & (prefix == p) for lab, p in same]))
        return keyed.where(reduce(Column.__or__, parts))

    seen = counts(keyed, 3)
    ranks = ranks_of({lab: sum(c.values()) for lab, c in seen.items()})
    # open targets: (label, rank) -> (bucket prefix, rank within the bucket)
    open_ = {(lab, r): ("", r) for lab, rs in ranks.items() for r in rs if r > 0}
    found: dict = {}
    while open_:
        few, many = {}, {}
        for (lab, r), (prefix, rest) in open_.items():
            for p, n in sorted((p, n) for p, n in seen[lab].items() if p.startswith(prefix)):
                if rest <= n:
                    if len(p) >= KEY_DIGITS:
                        found[(lab, r)] = Cut(p, rest, n)
                    else:
                        (few if n <= MAX_BUCKET_KEYS else many)[(lab, r)] = (p, rest)
                    break
                rest -= n
        open_ = few | many
        if open_:
            buckets = {(lab, p) for (lab, _), (p, _) in open_.items()}
            digits = KEY_DIGITS if not many else min(KEY_DIGITS, max(len(p) for _, p in buckets) + 3)
            seen = counts(inside(buckets), digits)
    return {lab: [found.get((lab, r)) for r in rs] for lab, rs in ranks.items()}


def sorted_ranks(distinct: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """0-based rank of every row of a table of distinct values, at any size.

    Range partitions are ordered one by one; the checkpoint pins their bounds.
    """
    parts = cut_lineage(distinct.repartitionByRange(F.col(value)).withColumn("__p", F.spark_partition_id()))
    sizes = parts.groupBy("__p").agg(F.count("*").alias("__c"))
    before = sizes.select("__p", (F.sum("__c").over(Window.orderBy("__p")) - F.col("__c")).alias("__before"))
    inside = Window.partitionBy("__p").orderBy(value)
    return (parts.join(before, "__p")
            .select(*distinct.columns, (F.row_number().over(inside) - 1 + F.col("__before")).cast("long").alias(out)))


def hash_positions(df: DataFrame, keys: list[str], hkey: Column, out: str, digits: int = 4) -> DataFrame:
    """1-based position of each row in hash order within ``keys``, counted per hash prefix."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.withColumn("__h", hkey).withColumn("__p", F.substring("__h", 1, digits))
    small = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__p")
    before = (keyed.groupBy(*keys, "__p").agg(F.count("*").alias("__c"))
              .select(*keys, "__p", (F.sum("__c").over(small) - F.col("__c")).alias("__before")))
    inside = Window.partitionBy(*keys, "__p").orderBy("__h")
    return keyed.join(before, [*keys, "__p"]).select(
        *cols, (F.row_number().over(inside) + F.col("__before")).cast("long").alias(out))

