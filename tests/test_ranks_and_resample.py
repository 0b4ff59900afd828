import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from treelab.functions import ranks
from treelab.functions.hashing import unit_below, unit_hash
from treelab.operators import clean, profile, resample

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@FEW
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60), st.sampled_from([10_000, 20]))
def test_quantiles_match_numpy(spark, values, accuracy):
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 1.0)], "k string, v double")
    got = {r.prob: r.quantile for r in ranks.exact_quantiles(df, ["k"], "v", [0.25, 0.5, 0.75], accuracy).where("k = 'a'").collect()}
    for q in (0.25, 0.5, 0.75):
        assert got[q] == pytest.approx(np.quantile(values, q))


def test_quantiles_with_a_coarse_sketch_on_many_rows(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), (F.hash("id") % 1000).cast("double").alias("v"))
    values = [r.v for r in df.collect()]
    for r in ranks.exact_quantiles(df, ["k"], "v", [0.1, 0.5, 0.9], accuracy=50).collect():
        assert r.quantile == pytest.approx(np.quantile(values, r.prob))


def test_running_totals_cross_buckets(spark):
    df = spark.range(200).select((F.col("id") % 37).cast("double").alias("v"), F.lit(1).alias("c"))
    edges = ranks.splitters(df, ["v"], 8)
    counts = ranks.bucketize(df, ["v"], edges, ["b"]).groupBy("b", "v").agg(F.sum("c").alias("c"))
    rows = sorted(ranks.running_totals(counts, [], "b", "v", ["c"]).collect(), key=lambda r: r.v)
    assert [r.cum_c for r in rows] == list(np.cumsum([r.c for r in rows]))
    assert [r.next.v for r in rows[:-1]] == [r.v for r in rows[1:]] and rows[-1].next is None
    assert {r.tot_c for r in rows} == {200}


def test_bucketize_keeps_values_equal_to_an_edge_on_the_left(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (9.0,), (None,), (float("nan"),)], "v double")
    got = [r.b for r in ranks.bucketize(df, ["v"], [[1.0, 2.0]], ["b"]).collect()]
    assert got == [0, 0, 1, 1, 2, -1, -1]


def labelled(spark, n, share=3):
    return spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") % share == 0).cast("int").alias("label"))


def brute_split(rows, fraction=0.2, seed=42):
    by = {}
    for r in rows:
        by.setdefault(r.label, []).append(r.row_id)
    quota = resample.split_quota({k: len(v) for k, v in by.items()}, fraction)
    return {i for k, ids in by.items() for i in sorted(ids, key=lambda i: hashlib.md5(f"{i}:{seed}".encode()).hexdigest())[:quota[k]]}


@pytest.mark.parametrize("n", [1, 7, 103, 1000])
def test_split_is_exact_and_stratified(spark, n):
    df = labelled(spark, n)
    got = {r.row_id for r in resample.stratified_split(df).where("split = 'test'").collect()}
    assert got == brute_split(df.collect()) and len(got) == math.ceil(0.2 * n)


def test_split_narrows_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranks, "MAX_BUCKET_KEYS", 1)
    df = labelled(spark, 3000)
    assert {r.row_id for r in resample.stratified_split(df).where("split = 'test'").collect()} == brute_split(df.collect())


def test_folds_cover_every_row_once_even_with_few_rows(spark):
    rows = resample.stratified_folds(labelled(spark, 103), 5).groupBy("label").pivot("fold", list(range(5))).count().collect()
    for r in rows:
        sizes = [r[str(f)] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    tiny = resample.stratified_folds(labelled(spark, 4, 2), 5).collect()
    assert all(0 <= r.fold < 5 for r in tiny) and len(tiny) == 4


def test_poisson_share_of_zeros(spark):
    bag = resample.bootstrap_weights(spark.range(4000).withColumnRenamed("id", "row_id"), 6)
    w = np.array([r.bag for r in bag.collect()])
    assert w.shape == (4000, 6) and abs((w == 0).mean() - math.exp(-1)) < 0.02 and abs(w.mean() - 1) < 0.03


def test_permuted_column_keeps_its_values(spark):
    df = spark.range(300).select(F.col("id").alias("row_id"), (F.col("id") * 2.0).alias("v"))
    rows = resample.permute_column(df, "v", 2).collect()
    for rep in (0, 1):
        part = [r for r in rows if r.rep == rep]
        assert sorted(r.permuted for r in part) == sorted(r.value for r in part)
        assert sum(r.permuted == r.value for r in part) < 10


def test_a_column_is_shuffled_anew_in_every_repeat(spark):
    def order(tail):
        return sorted(range(50), key=lambda i: hashlib.md5(f"{i}:42:{tail}".encode()).hexdigest())

    df = spark.range(50).select(F.col("id").alias("row_id"), (F.col("id") * 2.0).alias("v"))
    got = {(r.row_id, r.rep): (r.value, r.permuted) for r in resample.permute_column(df, "v", 3).collect()}
    assert got == {(i, rep): (2.0 * i, 2.0 * j) for rep in range(3) for i, j in zip(order("pos"), order(f"v:{rep}"))}


def test_encoding_is_lexicographic_and_keeps_missing_targets(spark):
    df = spark.createDataFrame([("10",), ("2",), (None,), ("2",)], "t string")
    assert [r.t for r in clean.encode_sorted(df, ["t"]).collect()] == [0, 1, 2, 1]
    assert sorted(r.t for r in clean.encode_sorted(df, ["t"]).collect()) == [0, 1, 1, 2]


def test_cleaning_order_and_coercion(spark):
    df = spark.createDataFrame([(1.0, "a", None), (None, "b", "x"), (2.0, "c", "y")], "x double, s string, target string")
    out = clean.clean_features(df, ["x", "s"]).orderBy("x").collect()
    assert [(r.x, r.s, r.target) for r in out] == [(1.0, 0.0, None), (2.0, 1.0, "y")]
    bad = clean.coerce_numeric(spark.createDataFrame([("1.5",), ("x",)], "v string"), ["v"]).collect()
    assert [r.v for r in bad] == [1.5, None]
    with pytest.raises(TypeError):
        clean.categorical_columns(spark.sql("SELECT current_date() AS d"), ["d"])


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 0), (3.0, 0), (7.0, 1)], "v double, label int")
    rows = profile.class_histograms(df, ["v"], bins=3).collect()
    assert {(r.label, r.bin): r["count"] for r in rows} == {(0, 0): 1, (0, 1): 1, (0, 2): 1, (1, 0): 0, (1, 1): 1, (1, 2): 0}


def test_describe_and_box_against_pandas(spark):
    values = [1.0, 2.0, 2.0, 3.0, 4.0, 50.0]
    df = spark.createDataFrame([("s", v) for v in values], "series string, v double")
    d, p = profile.describe(df, ["v"]).first(), pd.Series(values).describe()
    assert (d["count"], d["mean"], d["std"], d["p25"], d["max"]) == (6, round(p["mean"], 2), round(p["std"], 2), p["25%"], 50.0)
    b = profile.box_summary(df, "series", "v").first()
    assert (b.median, b.whisker_lo, b.whisker_hi, b.n_outliers) == (2.5, 1.0, 4.0, 1)
    assert [r.v for r in profile.box_outliers(df, "series", "v").collect()] == [50.0]


def test_first_of_equal_scores_wins(spark):
    df = spark.createDataFrame([(3, 0.9), (1, 0.8), (2, 0.9)], "depth int, acc double")
    assert profile.best_param(df, "depth", "acc").first().best_param == 2


def test_shuffles_are_bijections(spark, monkeypatch):
    """Every position sends and receives once, in 64 bits and in decimals, also in tiny tables."""
    for limit in (resample.MAX_PRODUCT_ROWS, 0):
        monkeypatch.setattr(resample, "MAX_PRODUCT_ROWS", limit)
        for n in (1, 2, 7, 60):
            base = spark.range(n).selectExpr("id AS pos", "id AS v", "CAST(id + 100 AS DOUBLE) AS w")
            rows = resample.permuted_values(base, ["v", "w"], 3, n).collect()
            for slot in range(6):
                a, b = resample.shuffle_key(n, "vw"[slot // 3], slot % 3)
                assert sorted((r.pos, r.permuted - 100 * (slot // 3)) for r in rows if r.slot == slot) == [(p, (a * p + b) % n) for p in range(n)]
    assert resample.permuted_values(base.limit(0), ["v"], 2, 0).collect() == []


def test_a_share_is_the_same_by_digits_and_by_number(spark):
    rows = spark.range(3000).select(*[(unit_hash(F.col("id"), "s") < f).eqNullSafe(unit_below(f, F.col("id"), "s")).alias(f"c{i}")
                                      for i, f in enumerate((-0.5, 0.0, 1e-12, 0.05, 0.5, 0.8, 1 - 2**-33, 1.0))])
    assert all(all(r) for r in rows.collect())
