import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from treelab.operators import boosting, exact, explain, forest, grower, nodes, pruning, resample
from treelab.operators.bins import fit_bins
from treelab.plans import compare
from treelab.sources.sine import sine_table

COLS = ["a", "b", "c"]


def frame(spark, n=400, seed=3, flip=0.1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    y = ((x[:, 0] > 5) & (x[:, 1] <= 7)).astype(int) ^ (rng.random(n) < flip)
    pdf = pd.DataFrame(x, columns=COLS).assign(label=y.astype(int), row_id=range(n))
    pdf["split"] = np.where(pdf.row_id % 5 == 0, "test", "train")
    return spark.createDataFrame(pdf), pdf


@pytest.fixture(scope="module")
def sample(spark):
    df, pdf = frame(spark)
    return df.persist(), pdf


@pytest.fixture(scope="module")
def grown(spark, sample):
    return forest.grow_tree(sample[0].where("split = 'train'"), COLS, 8)[0]


def best_gini(pdf):
    def gini(y):
        return 1 - (y == 0).mean() ** 2 - (y == 1).mean() ** 2
    best = (0, None)
    y = pdf.label.to_numpy()
    for i, c in enumerate(COLS):
        v = np.unique(pdf[c])
        for t in (v[1:] + v[:-1]) / 2:
            left = (pdf[c] <= t).to_numpy()
            gain = gini(y) - left.mean() * gini(y[left]) - (1 - left.mean()) * gini(y[~left])
            if gain > best[0] + 1e-9:
                best = (gain, (c, t))
    return best


def test_documented_impurities():
    assert grower.gini_leaf({"s0": 170, "s1": 285, "n": 455})["impurity"] == pytest.approx(0.4681, abs=1e-4)
    assert grower.gini_leaf({"s0": 143, "s1": 8, "n": 151})["impurity"] == pytest.approx(0.1003, abs=1e-4)


def test_root_split_is_the_best_of_all_thresholds(spark, sample, grown):
    train = sample[1][sample[1].split == "train"]
    gain, where = best_gini(train)
    root = grown[0]
    assert (root["feature"], root["threshold"]) == where and root["gain"] == pytest.approx(gain)
    df = sample[0].where("split = 'train'").selectExpr(*COLS, "0 AS node", "CAST(1 - label AS DOUBLE) AS s0", "CAST(label AS DOUBLE) AS s1")
    row = exact.exact_splits(df, COLS, grower.GiniRule(), buckets=4).first()
    assert (row.feature, row.threshold) == where and row.gain == pytest.approx(gain)


def test_full_tree_learns_distinct_rows(spark):
    pdf = pd.DataFrame({"a": range(16), "label": [0, 1, 1, 0] * 4})
    found, _ = forest.grow_tree(spark.createDataFrame(pdf), ["a"], 12)
    scored = nodes.predict_forest(spark.createDataFrame(pdf), found, ["a"])
    assert scored.where("prediction != label").count() == 0


def test_duplicates_and_constant_features_end_in_a_leaf(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 1)], "a double, label int")
    found, _ = forest.grow_tree(df, ["a"], 5)
    assert len(found) == 1 and found[0]["is_leaf"] and found[0]["value"] == pytest.approx(2 / 3)
    assert fit_bins(df, ["a"]).edges == [[]]


def test_depth_sweep_equals_refits(spark, sample, grown):
    df = sample[0]
    sweep = {r.depth: (r.train_acc, r.test_acc) for r in pruning.depth_sweep(df, grown, COLS, [1, 3, 8]).collect()}
    for d in (1, 3):
        again = forest.grow_tree(df.where("split = 'train'"), COLS, d)[0]
        scored = nodes.predict_forest(df, again, COLS)
        for split, acc in zip(("train", "test"), sweep[d]):
            assert scored.where(F.col("split") == split).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] == pytest.approx(acc)
    assert sweep[8][0] >= sweep[3][0] >= sweep[1][0]


def test_pruning_is_nested_and_matches_a_step_by_step_search(spark, grown):
    pruned = pruning.prune_alphas(nodes.node_table(spark, grown))
    rows = nodes.rows_of(pruned)
    total = rows[0]["cover"]

    def cost(tree, alpha):  # brute force: cheapest pruning by dynamic programming, smaller tree on ties
        kids = {r["node_id"]: (r["left_id"], r["right_id"]) for r in tree if not r["is_leaf"]}
        by = {r["node_id"]: r for r in tree}

        def best(i):
            own = by[i]["cover"] / total * by[i]["impurity"] + alpha
            if i not in kids:
                return own, 1
            (cl, nl), (cr, nr) = best(kids[i][0]), best(kids[i][1])
            return (own, 1) if own <= cl + cr + 1e-12 else (cl + cr, nl + nr)
        return best(0)

    sizes = {r.alpha: (r.depth, r.leaves) for r in pruning.tree_sizes(pruned).collect()}
    alphas = sorted(sizes)
    assert [sizes[a][1] for a in alphas] == sorted((sizes[a][1] for a in alphas), reverse=True)
    assert sizes[alphas[-1]] == (0, 1)
    for a, b in zip(alphas, alphas[1:]):
        if b - a > 1e-9:  # equal links differ by rounding only
            assert sizes[a][1] == cost(rows, (a + b) / 2)[1]
        assert sum(r["is_leaf"] for r in pruning.prune(rows, a)) == sizes[a][1]
    path = pruning.pruning_path(pruned).orderBy("alpha").collect()
    assert all(x.total_impurity <= y.total_impurity + 1e-12 for x, y in zip(path, path[1:]))


def test_alpha_sweep_equals_scoring_each_pruned_tree(spark, sample, grown):
    rows = nodes.rows_of(pruning.prune_alphas(nodes.node_table(spark, grown)))
    sweep = pruning.alpha_sweep(sample[0], rows, COLS).orderBy("alpha").collect()
    for r in sweep[::max(1, len(sweep) // 3)]:
        scored = nodes.predict_forest(sample[0].where("split = 'test'"), pruning.prune(rows, r.alpha), COLS)
        acc = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
        assert acc == pytest.approx(r.test_acc)


def test_rules_describe_the_leaves(spark, sample, grown):
    table = nodes.node_table(spark, pruning.truncate(grown, 3))
    rules = nodes.leaf_rules(table).collect()
    for r in rules:
        assert sample[0].where("split = 'train'").where(r.rule).count() == r.n_samples
    text = [r.line for r in nodes.rules_text(table).orderBy("line_no").collect()]
    assert text[0].startswith(f"|--- {grown[0]['feature']} <= ") and sum("class:" in t for t in text) == len(rules)
    order = [r.prediction for r in sorted(rules, key=lambda r: r.leaf_no)]
    assert [int(t.rsplit(" ", 1)[1]) for t in text if "class:" in t] == order


def test_forest_prefix_and_oob(spark, sample):
    train = sample[0].where("split = 'train'")
    ten = forest.grow_forest(train, COLS, 10, 4)
    six = forest.grow_forest(train, COLS, 6, 4)
    assert [r for r in ten if r["tree_id"] < 6] == six
    curve = forest.oob_curve(train, ten, COLS).orderBy("n_trees").collect()
    bag = {r.row_id: r.bag for r in resample.bootstrap_weights(train, 10).select("row_id", "bag").collect()}
    p = {r.row_id: (r.label, r.p) for r in train.withColumn("p", nodes.tree_values(ten, COLS)).collect()}
    for n in (1, 10):
        hits = votes = 0
        for i, (label, vote) in p.items():
            out = [v for v, w in zip(vote[:n], bag[i][:n]) if w == 0]
            if out:
                votes += 1
                hits += int(round(sum(out) - len(out) / 2, 9) > 0) == label
        assert curve[n - 1].n_rows == votes and curve[n - 1].oob_score == pytest.approx(hits / votes)
    imp = {r.feature: r.importance for r in explain.impurity_importance(nodes.node_table(spark, ten), COLS).collect()}
    assert sum(imp.values()) == pytest.approx(1) and imp["a"] > imp["c"]
    small = forest.forest_size_curve(sample[0], ten, COLS).where("n_trees = 6").first()
    again = nodes.predict_forest(train, six, COLS).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert small.train_acc == pytest.approx(again)


def test_trees_grown_in_batches_are_the_same(spark, sample, monkeypatch):
    train = sample[0].where("split = 'train'")
    whole = forest.grow_forest(train, COLS, 5, 3)
    monkeypatch.setattr(grower, "LOCAL_ROWS", 32)
    assert forest.grow_forest(train, COLS, 5, 3) == whole
    monkeypatch.setattr(nodes, "NODES_PER_BROADCAST", 10)
    a = [r.p for r in train.orderBy("row_id").select(nodes.tree_values(whole, COLS).alias("p")).collect()]
    monkeypatch.setattr(nodes, "NODES_PER_BROADCAST", 10_000)
    assert a == [r.p for r in train.orderBy("row_id").select(nodes.tree_values(whole, COLS).alias("p")).collect()]


def test_spark_tree_becomes_the_same_node_table(spark, sample):
    from treelab.sources.tables import assemble
    train = assemble(sample[0].where("split = 'train'"), COLS)
    model = forest.decision_tree(4).fit(train)
    rows = nodes.model_nodes(model, COLS)
    mine = nodes.predict_forest(model.transform(train).withColumnRenamed("prediction", "theirs"), rows, COLS)
    assert mine.where("prediction != theirs").count() == 0
    assert max(r["depth"] for r in rows) == model.depth and len(rows) == model.numNodes
    boosted = boosting.gbt(4).fit(train)
    parts = boosting.staged_loss(sample[0], nodes.model_nodes(boosted, COLS), COLS, scale=2.0).where("split = 'train'").orderBy("iteration").collect()
    theirs = boosted.evaluateEachIteration(train)
    assert [r.log_loss for r in parts] == pytest.approx([v / 2 for v in theirs])


def brute_boost(pdf, rounds, eta, lam, alpha, gamma, depth):
    """Small row-by-row second-order boosting to compare with."""
    x, y = pdf[COLS].to_numpy(float), pdf.label.to_numpy()
    margin = np.zeros(len(y))

    def score(g, h):
        return max(abs(g) - alpha, 0) ** 2 / (h + lam)

    def build(idx, g, h, level):
        G, H = g[idx].sum(), h[idx].sum()
        best = (1e-10, None)
        if level < depth:
            for f in range(x.shape[1]):
                v = np.unique(x[idx, f])
                for t in (v[1:] + v[:-1]) / 2:
                    left = idx[x[idx, f] <= t]
                    gl, hl = g[left].sum(), h[left].sum()
                    if hl < 1 or H - hl < 1:
                        continue
                    gain = round(0.5 * (score(gl, hl) + score(G - gl, H - hl) - score(G, H)) - gamma, 10)
                    if gain > best[0]:
                        best = (gain, (f, t))
        if best[1] is None:
            out[idx] = -eta * np.sign(G) * max(abs(G) - alpha, 0) / (H + lam)
            return
        f, t = best[1]
        build(idx[x[idx, f] <= t], g, h, level + 1)
        build(idx[x[idx, f] > t], g, h, level + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        out = np.zeros(len(y))
        build(np.arange(len(y)), p - y, p * (1 - p), 0)
        margin = margin + out
    return margin


@pytest.mark.parametrize("lam,alpha,gamma", [(1.0, 0.0, 0.0), (5.0, 0.5, 1.0)])
def test_second_order_boosting_matches_brute_force(spark, sample, lam, alpha, gamma):
    df, pdf = sample
    config = boosting.BoostConfig(n_rounds=3, learning_rate=0.3, max_depth=2, reg_lambda=lam, reg_alpha=alpha, gamma=gamma)
    model, = boosting.boost(df, COLS, [config])
    got = [r.margin for r in boosting.score_boost(df, model).orderBy("row_id").collect()]
    assert got == pytest.approx(list(brute_boost(pdf, 3, 0.3, lam, alpha, gamma, 2)), abs=1e-9)


def test_boosting_side_by_side_prefix_and_checkpoint(spark, sample, monkeypatch):
    df = sample[0]
    one = boosting.BoostConfig(n_rounds=3, max_depth=2, subsample=0.7, colsample_bytree=0.7)
    two = boosting.BoostConfig(n_rounds=2, max_depth=1, reg_lambda=4.0)
    both = boosting.boost(df, COLS, [one, two], role="split")
    alone = boosting.boost(df, COLS, [one], role="split")[0]
    assert both[0].nodes == alone.nodes and len({r["tree_id"] for r in both[1].nodes}) == 2
    monkeypatch.setattr(boosting, "CHECKPOINT_EVERY", 1)
    cut = boosting.boost(df, COLS, [one], role="split")[0]
    assert cut.nodes == alone.nodes
    short = boosting.boost(df, COLS, [boosting.BoostConfig(n_rounds=2, max_depth=2, subsample=0.7, colsample_bytree=0.7)], role="split")[0]
    assert short.nodes == alone.prefix(2).nodes
    assert {h["eval_set"] for h in alone.history} == {"train", "test"}


def test_early_stop_keeps_the_best_prefix(spark, sample):
    config = boosting.BoostConfig(n_rounds=12, learning_rate=1.0, max_depth=3, reg_lambda=0.1)
    model = boosting.boost_early_stop(sample[0], COLS, config, "split", patience=2)
    curve = [h["logloss"] for h in model.history if h["eval_set"] == "test"]
    assert len(curve) < 12 and model.config.n_rounds == int(np.argmin(curve)) + 1
    assert len({r["tree_id"] for r in model.nodes}) == model.config.n_rounds


def test_missing_values_take_the_better_side(spark):
    rows = [(float(i), int(i > 5)) for i in range(12)] + [(None, 1)] * 6
    df = spark.createDataFrame([(i, v, y) for i, (v, y) in enumerate(rows)], "row_id int, a double, label int")
    model, = boosting.boost(df, ["a"], [boosting.BoostConfig(n_rounds=1, max_depth=1, min_child_weight=0.0)])
    root = model.nodes[0]
    assert root["missing_left"] is False and root["threshold"] == 5.5
    flipped = df.withColumn("label", 1 - F.col("label"))
    low = flipped.withColumn("label", F.when(F.col("a").isNull(), 1).otherwise(F.col("label")))
    assert boosting.boost(low, ["a"], [boosting.BoostConfig(n_rounds=1, max_depth=1, min_child_weight=0.0)])[0].nodes[0]["missing_left"] is True
    scored = boosting.score_boost(df, model).groupBy(F.col("a").isNull().alias("m")).agg(F.min("margin"), F.max("margin")).collect()
    assert [tuple(r)[1:] for r in scored if r.m][0][0] > 0


def brute_shap(tree, cols, x):
    by = {r["node_id"]: r for r in tree}

    def value(i, known):
        r = by[i]
        if r["is_leaf"]:
            return r["value"]
        if r["feature"] in known:
            return value(r["left_id"] if x[cols.index(r["feature"])] <= r["threshold"] else r["right_id"], known)
        return sum(by[k]["cover"] / r["cover"] * value(k, known) for k in (r["left_id"], r["right_id"]))

    out = []
    for c in cols:
        rest = [k for k in cols if k != c]
        out.append(sum(math.factorial(s) * math.factorial(len(cols) - 1 - s) / math.factorial(len(cols))
                       * (value(0, set(sub) | {c}) - value(0, set(sub)))
                       for s in range(len(rest) + 1) for sub in itertools.combinations(rest, s)))
    return out


def test_shap_matches_brute_force_and_adds_up(spark, sample):
    df = sample[0].where("row_id < 12")
    model, = boosting.boost(sample[0], COLS, [boosting.BoostConfig(n_rounds=2, max_depth=4, reg_lambda=0.5)])
    rows = {}
    for r in explain.shap_values(df, model.nodes, COLS).collect():
        rows.setdefault(r.row_id, {})[r.feature] = r.phi
    base = explain.expected_value(model.nodes, model.base_margin)
    for r in boosting.score_boost(df, model).collect():
        phi = [rows[r.row_id][c] for c in COLS]
        assert base + sum(phi) == pytest.approx(r.margin)
        want = np.sum([brute_shap([n for n in model.nodes if n["tree_id"] == t], COLS, [r[c] for c in COLS]) for t in (0, 1)], axis=0)
        assert phi == pytest.approx(list(want))


def test_permutation_importance_ranks_the_planted_features(spark, sample, grown):
    imp = {r.feature: r.importance_mean for r in explain.permutation_importance(
        sample[0].where("split = 'test'"), lambda d: nodes.predict_forest(d, pruning.truncate(grown, 2), COLS), COLS, 3).collect()}
    assert imp["a"] > 0.1 and imp["b"] > 0.02 and abs(imp["c"]) < 0.05


def test_cross_validated_trees_equal_separate_fits(spark, sample):
    folded = resample.stratified_folds(sample[0], 3).persist()
    found = forest.cross_validated_trees(folded, COLS, 3, 3)
    got = {r.fold: r.accuracy for r in forest.fold_scores(folded, found, COLS).collect()}
    own = forest.grow_tree(folded.where("fold != 1"), COLS, 3)[0]
    scored = nodes.predict_forest(folded.where("fold = 1"), own, COLS)
    assert got[1] == pytest.approx(scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0])


def test_grid_points_and_search(spark, sample):
    full = {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1], "max_depth": [3, 4, 6], "subsample": [0.7, 0.9], "colsample_bytree": [0.7, 0.9]}
    assert len(compare.grid_points(full)) == 48
    data = resample.stratified_folds(sample[0], 2)
    table, best, final = compare.grid_search(data, COLS, {"n_rounds": [1, 2], "max_depth": [1, 2]}, 2, models_per_pass=3)
    rows = table.orderBy("point").collect()
    top = max(rows, key=lambda r: (r.cv_mean, -r.point))
    assert top.params == ", ".join(f"{k}={v}" for k, v in best.items()) and len(rows) == 4
    assert final.config.max_depth == best["max_depth"]


def test_residual_boosting_falls(spark):
    curve = [r.mse for r in boosting.residual_boosting(sine_table(spark), ["x"]).orderBy("round").collect()]
    assert len(curve) == 6 and all(a > b for a, b in zip(curve, curve[1:]))
