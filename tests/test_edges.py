"""Missing values, repeated ids, one-class fits, named eval sets and other edges."""

import math

import pytest
from pyspark.sql import functions as F

from treelab.functions import ranks, storage
from treelab.operators import bins, boosting, metrics, pruning, resample
from treelab.plans import compare
from treelab.sources import sinks


def test_nan_and_null_leave_a_features_bins_alone(spark):
    base = spark.range(500).select((F.col("id") / 7).alias("x"), (F.col("id") % 5).cast("double").alias("few"))
    holes = base.unionByName(spark.createDataFrame([(float("nan"), float("nan")), (None, None)], "x double, few double"))
    for method in ("quantile", "width"):
        clean, holed = (bins.fit_bins(d, ["x", "few"], 16, method) for d in (base, holes))
        assert holed.edges == clean.edges and len(holed.edges[0]) == 15 and holed.edges[1] == [0.5, 1.5, 2.5, 3.5]
        assert holed.missing and not clean.missing
    assert {tuple(r["bins"]) for r in bins.with_bins(holes.where("x is null or isnan(x)"), holed).collect()} == {(-1, -1)}


def test_each_feature_decides_its_edges_alone(spark):
    few = [f"c{i}" for i in range(12)]
    df = spark.range(2000).select(*[(F.col("id") % 30).cast("double").alias(c) for c in few], F.col("id").cast("double").alias("wide"),
                                  (F.col("id") % 40).cast("double").alias("over"), F.lit(None).cast("double").alias("none"))
    found = bins.fit_bins(df, [*few, "wide", "over", "none"], 32)
    assert all(found.edges[i] == [k + 0.5 for k in range(29)] for i in range(12)) and found.edges[-1] == []
    assert bins.fit_bins(df, ["over"], 32).edges[0] == found.edges[-2]


def test_quota_is_exact_when_rows_share_ids(spark):
    df = spark.range(100).select(F.lit(7).alias("row_id"), (F.col("id") % 2).cast("int").alias("label"), "id")
    out = resample.stratified_split(df)
    assert {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()} == {
        (0, "test"): 10, (0, "train"): 40, (1, "test"): 10, (1, "train"): 40}
    assert sorted(r["count"] for r in resample.stratified_folds(df, 5).groupBy("label", "fold").count().collect()) == [10] * 10
    nulls = df.withColumn("row_id", F.lit(None).cast("int"))
    assert resample.stratified_split(nulls).where("split = 'test'").count() == 20
    with pytest.raises(ValueError, match="equal rows"):
        resample.stratified_split(df.drop("id")).count()


def test_search_ends_when_one_key_fills_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(ranks, "MAX_BUCKET_KEYS", 10)
    df = spark.range(300).select(F.lit(0).alias("label"), F.when(F.col("id") < 200, F.md5(F.lit("a"))).otherwise(F.md5(F.col("id").cast("string"))).alias("k"))
    want = sorted(r["k"] for r in df.collect())
    cuts = ranks.hash_cuts(df, "label", F.col("k"), lambda sizes: {0: [0, 1, 60, 150, 299]})[0]
    assert cuts[0] is None
    for rank, cut in zip((1, 60, 150, 299), cuts[1:], strict=True):
        assert cut.key == want[rank - 1] and cut.taken == rank - want.index(cut.key) and cut.rows == want.count(cut.key)


def _sets(spark):
    return spark.range(400).select("id", (F.col("id") % 17).cast("double").alias("x"), F.when(F.col("id") % 17 > 8, 1).otherwise(0).alias("clean"),
                                   F.element_at(F.array(F.lit("train"), F.lit("train"), F.lit("test"), F.lit("dev")), (F.col("id") % 4 + 1).cast("int")).alias("role")) \
        .select(F.col("id").alias("row_id"), "x", "role", F.when((F.col("role") == "dev"), 1 - F.col("clean")).otherwise(F.col("clean")).alias("label"))


def test_last_named_eval_set_decides(spark):
    config = boosting.BoostConfig(n_rounds=6, max_depth=2, learning_rate=0.5)
    data = _sets(spark)
    kept = {last: boosting.boost_early_stop(data, ["x"], config, "role", patience=2, eval_sets=["train", last]).config.n_rounds for last in ("test", "dev")}
    assert kept == {"test": 6, "dev": 1}
    with pytest.raises(ValueError, match="eval sets"):
        boosting.boost(data, ["x"], [config], role="role", patience=2)
    only = boosting.boost(data.where("role != 'test'"), ["x"], [config], role="role", patience=2)[0]
    assert only.watch == "dev" and len(boosting._watched(only)) == 3


def test_prior_of_one_class_is_finite(spark):
    one = spark.range(50).select(F.col("id").alias("row_id"), F.col("id").cast("double").alias("x"), F.lit(1).alias("label"))
    model, = boosting.boost(one, ["x"], [boosting.BoostConfig(n_rounds=1, base_score="prior")])
    assert math.isfinite(model.base_margin) and boosting.score_boost(one, model).where("p1 < 0.99").count() == 0


def test_reports_by_group_equal_reports_alone(spark):
    df = spark.range(90).select((F.col("id") % 3).alias("m"), (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 5 > 1).cast("int").alias("prediction"),
                                F.when(F.col("id") % 4 > 0, "train").otherwise("test").alias("split"))
    for report in (metrics.confusion_matrix, metrics.classification_report, metrics.overfit_gap):
        both = report(df, by=["m"])
        for m in range(3):
            assert sorted(both.where(F.col("m") == m).drop("m").collect()) == sorted(report(df.where(F.col("m") == m)).collect())


def test_sweeps_take_one_tree():
    with pytest.raises(ValueError, match="one tree"):
        pruning.one_tree([{"tree_id": 0}, {"tree_id": 1}])


def test_report_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a b", 0.5), ("c,d", 1.0)], "model string, accuracy double")
    for fmt in ("parquet", "csv"):
        sinks.write_report(df, str(tmp_path / fmt), fmt)
        back = spark.read.schema(df.schema).option("header", "true").format(fmt).load(str(tmp_path / fmt))
        assert sorted(back.collect()) == sorted(df.collect())


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Other:
        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

    with pytest.raises(ValueError, match="checkpoint"):
        storage.shared_dir(Other)


def test_nan_is_missing_in_profiles(spark):
    from treelab.operators import profile

    rows = [(float(i), 0) for i in range(10)]
    holes = rows + [(float("nan"), 0), (None, 0)]
    frames = [spark.createDataFrame(r, "x double, label int") for r in (rows, holes)]
    for look in (lambda d: profile.describe(d, ["x"]), lambda d: profile.class_histograms(d, ["x"], bins=4)):
        assert sorted(map(tuple, look(frames[0]).collect())) == sorted(map(tuple, look(frames[1]).collect()))


def test_a_thread_without_an_active_session_scores_boosted_models(spark):
    rows = spark.range(60).selectExpr("id AS row_id", "id % 7 * 1.0D AS x", "CAST(id % 7 > 3 AS INT) AS label", "CAST(id % 3 AS INT) AS fold").persist()
    fits = {"boost": compare.boost_fit(boosting.BoostConfig(n_rounds=2, max_depth=1, learning_rate=1.0, min_child_weight=0.0), ["x"])}
    assert [(r.fold, r.accuracy) for r in compare.cv_scores(rows, fits, 3, parallelism=2).orderBy("fold").collect()] == [(0, 1.0), (1, 1.0), (2, 1.0)]
