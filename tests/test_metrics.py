import itertools

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from treelab.operators import metrics

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def scored(spark, rows):
    return spark.createDataFrame(pd.DataFrame(rows, columns=["label", "p1"])).selectExpr(
        "label", "p1", "CAST(p1 >= 0.5 AS INT) AS prediction")


@FEW
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6).map(lambda k: k / 6)), min_size=2, max_size=40))
def test_auc_is_the_pairwise_win_rate(spark, rows):
    pos, neg = [p for y, p in rows if y == 1], [p for y, p in rows if y == 0]
    got = metrics.auc(scored(spark, rows), buckets=4).first()["auc"]
    if not pos or not neg:
        assert got is None
        return
    wins = sum((a > b) + 0.5 * (a == b) for a, b in itertools.product(pos, neg))
    assert got == pytest.approx(wins / (len(pos) * len(neg)))


def test_auc_of_equal_scores_is_one_half(spark):
    assert metrics.auc(scored(spark, [(0, 0.3), (1, 0.3), (1, 0.3)])).first()["auc"] == 0.5


def test_roc_drops_only_points_on_straight_runs(spark):
    rows = scored(spark, [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (1, 0.5), (0, 0.4), (0, 0.3)])
    full = {(r.fpr, r.tpr) for r in metrics.roc_points(rows, drop_collinear=False).collect()}
    few = {(r.fpr, r.tpr) for r in metrics.roc_points(rows).collect()}
    assert few < full and {(0.0, 0.0), (1.0, 1.0)} <= few and (0.0, 0.5) not in few


def test_report_without_predicted_positives(spark):
    rows = {r.class_name: r for r in metrics.classification_report(scored(spark, [(0, 0.1), (1, 0.2), (1, 0.3)])).collect()}
    assert rows["1"].precision == 0 and rows["1"].f1 == 0 and rows["1"].support == 2
    assert rows["accuracy"].f1 == pytest.approx(1 / 3)
    assert rows["weighted avg"].recall == pytest.approx(1 / 3)


def test_confusion_lists_empty_cells_and_sums_to_n(spark):
    cells = {(r.label, r.prediction): r["count"] for r in metrics.confusion_matrix(scored(spark, [(1, 0.9), (1, 0.1)])).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 1, (1, 1): 1}
    rates = metrics.binary_rates(scored(spark, [(1, 0.9), (1, 0.1)])).first()
    assert rates.specificity is None and rates.recall == 0.5
    flipped = metrics.binary_rates(scored(spark, [(1, 0.9), (1, 0.1)]), positive_label=0).first()
    assert flipped.specificity == 0.5


def losses(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "iteration int, loss double")


def test_patience_keeps_the_first_minimum(spark):
    r = metrics.patience_stop(losses(spark, [5, 3, 3, 4, 4, 1]), 3).first()
    assert (r.best_iteration, r.best_loss, r.last_iteration) == (1, 3.0, 4)
    r = metrics.patience_stop(losses(spark, [5, 4, 3]), 3).first()
    assert (r.best_iteration, r.last_iteration) == (2, 2)


def test_window_rule_compares_with_the_worst_of_the_last_losses(spark):
    r = metrics.window_stop(losses(spark, [5, 4, 3, 3, 3, 3, 2]), 2, tol=0.1).first()
    assert (r.n_estimators, r.stopped) == (5, True)
    assert metrics.window_stop(losses(spark, [5, 4, 3]), 2).first().n_estimators == 3
