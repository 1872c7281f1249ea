import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerflow.explain import report, tree
from ledgerflow.ml import features as mf
from ledgerflow.ml import boosting, metrics, train
from ledgerflow.ml import forest as counted_forest

SCHEMA = "is_fraud int, prediction int, probability double"


def scored(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute_auc(rows):
    pos = [s for y, _, s in rows if y == 1]
    neg = [s for y, _, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [3, 50, 10**6])
@pytest.mark.parametrize("rows_per_task", [None, 20])
def test_auc(spark, levels, rows_per_task):
    rng = random.Random(levels)
    rows = [(int(rng.random() < 0.3), 0, rng.randrange(levels) / levels) for _ in range(400)]
    assert metrics.roc_auc(scored(spark, rows), rows_per_task=rows_per_task).first().auc == pytest.approx(brute_auc(rows), abs=1e-12)


def test_roc_curve(spark):
    rows = [(1, 1, 0.9), (0, 1, 0.9), (1, 0, 0.4), (0, 0, 0.1)]
    points = [tuple(r) for r in metrics.roc_curve(scored(spark, rows)).orderBy("fpr", "tpr").collect()]
    assert points == [(math.inf, 0.0, 0.0), (0.9, 0.5, 0.5), (0.4, 0.5, 1.0), (0.1, 1.0, 1.0)]


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_only(spark, label):
    df = scored(spark, [(label, 1, 0.7), (label, 0, 0.2)])
    assert metrics.roc_auc(df).first().auc is None
    assert metrics.accuracy(df).first().accuracy == 0.5
    fraud = metrics.fraud_prf(df).first()
    assert tuple(fraud) == ((0.0, 0.0, 0.0) if label == 0 else (1.0, 0.5, pytest.approx(2 / 3)))


def test_nothing_predicted_and_equal_scores(spark):
    df = scored(spark, [(1, 0, 0.5), (0, 0, 0.5), (0, 0, 0.5)])
    assert tuple(metrics.fraud_prf(df).first()) == (0.0, 0.0, 0.0)
    assert metrics.roc_auc(df).first().auc == 0.5
    cells = {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_report(spark):
    df = scored(spark, [(1, 1, 0.9), (1, 0, 0.4), (0, 1, 0.8), (0, 0, 0.1), (0, 0, 0.2)])
    out = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert out["Fraud"].precision == 0.5 and out["Fraud"].recall == 0.5 and out["Fraud"].support == 2
    assert out["Legitimate"].precision == pytest.approx(2 / 3)
    assert out["accuracy"].f1 == 0.6 and out["macro avg"].recall == pytest.approx((0.5 + 2 / 3) / 2)
    assert out["weighted avg"].recall == pytest.approx(0.6)


def test_best_model(spark):
    table = spark.createDataFrame([("b", 0.7), ("a", 0.7), ("c", None), ("d", 0.1)], "model string, auc double")
    assert metrics.best_model(table).first().model == "a"
    assert metrics.best_model(table, "d").first().auc == 0.1


@pytest.fixture(scope="module")
def labelled(spark):
    i = F.col("id")
    return spark.range(2000).select(
        i.alias("transaction_id"), (i % 10 == 0).cast("int").alias("is_fraud"), (i % 7).cast("double").alias("x"), F.lit(3.0).alias("c")
    )


@pytest.mark.parametrize("frac, fraud, legit", [(0.0, 200, 1800), (1.0, 0, 0), (0.999, 1, 2)])
def test_exact_split_at_the_ends(labelled, frac, fraud, legit):
    a, b = mf.stratified_split(labelled, frac=frac, exact=True)
    assert b.filter("is_fraud = 1").count() == fraud and b.filter("is_fraud = 0").count() == legit
    assert a.count() == 2000 - fraud - legit


def test_exact_split(labelled):
    a, b = mf.stratified_split(labelled, exact=True)
    counts = {r.is_fraud: r["count"] for r in b.groupBy("is_fraud").count().collect()}
    assert counts == {0: 360, 1: 40}
    assert a.unionByName(b).distinct().count() == 2000


def test_hashed_split_is_repeatable_and_seeded(labelled):
    a, b = mf.stratified_split(labelled)
    again, _ = mf.stratified_split(labelled.repartition(7))
    assert sorted(a.collect()) == sorted(again.collect())
    assert a.count() + b.count() == 2000 and 0.75 < a.count() / 2000 < 0.85
    assert sorted(mf.stratified_split(labelled, seed=1)[0].collect()) != sorted(a.collect())


def test_scaling(labelled):
    a, b = mf.stratified_split(labelled)
    fit, other = mf.standardize(a, b, cols=["x", "c"])
    row = fit.agg(F.avg("x"), F.stddev_pop("x"), F.max("c")).first()
    assert row[0] == pytest.approx(0, abs=1e-12) and row[1] == pytest.approx(1) and row[2] == 0.0
    assert other.count() == b.count()


def test_weights(labelled):
    out = mf.class_weights(labelled).groupBy("is_fraud").agg(F.max("weight").alias("w")).collect()
    assert {r.is_fraud: r.w for r in out} == {0: 2000 / 3600, 1: 5.0}


def test_rows_are_not_shuffled_by_category(labelled, monkeypatch):
    def text():
        df = labelled.withColumn("k", F.concat(F.lit("v"), F.col("x")))
        return mf.label_encode(df, ["k"])._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in text() and "SortMergeJoin" not in text()
    monkeypatch.setattr("ledgerflow.ml.features.BROADCAST_CODES", 3)
    labelled.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in text()
    finally:
        labelled.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_label_encoding(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), (None, "x")], "k string, m string")
    out = mf.label_encode(df, ["k", "m"]).select("k", "k_enc", "m_enc").collect()
    assert sorted(map(tuple, out), key=str) == [("a", 0, 0), ("b", 1, 1), (None, 2, 1)]


# ---- forests and their explanation --------------------------------------------------------------------------------

COLS = ("a", "b", "c")


@pytest.fixture(scope="module")
def forest(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 8, (400, 3)).astype(float)
    y = ((x[:, 0] > 4) & (x[:, 1] < 3) | (x[:, 2] > 6)).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "transaction_id int, a double, b double, c double, is_fraud int")
    return train.random_forest(df, COLS, trees=5, depth=4), df


def path_value(t, x, known, node=0):
    """Expected tree value when only the features in `known` are given."""
    if t.left[node] < 0:
        return t.value[node]
    a, b = t.left[node], t.right[node]
    j = t.feature[node]
    if j in known:
        return path_value(t, x, known, a if x[j] <= t.threshold[node] else b)
    return (t.cover[a] * path_value(t, x, known, a) + t.cover[b] * path_value(t, x, known, b)) / (t.cover[a] + t.cover[b])


def test_contributions_equal_brute_force(spark, forest):
    model, df = forest
    trees = tree.read_trees(tree.node_table(spark, model))
    x = np.array([[r.a, r.b, r.c] for r in df.orderBy("transaction_id").limit(25).collect()])
    phi = tree.contributions(trees, x)
    for row in range(len(x)):
        for i in range(3):
            others = [j for j in range(3) if j != i]
            total = 0.0
            for size in range(3):
                for s in itertools.combinations(others, size):
                    weight = math.factorial(size) * math.factorial(2 - size) / math.factorial(3)
                    total += weight * np.mean([path_value(t, x[row], {*s, i}) - path_value(t, x[row], set(s)) for t in trees])
            assert phi[row, i] == pytest.approx(total, abs=1e-10)


def test_few_and_many_rows_alike(monkeypatch):
    """Arrays of all rows and leaves against the walk with tables: deep trees, repeated features, NaN, leaves without weight."""
    draw = np.random.default_rng(3)

    def grown(depth, weight, out):
        at = len(out)
        out.append([-1, -1, 0, 0.0, weight, draw.random()])
        if depth and weight > 1 and draw.random() < 0.9:
            part = float(draw.integers(0, int(weight) + 1))
            out[at][2:4] = [int(draw.integers(6)), float(draw.normal())]
            out[at][0] = grown(depth - 1, part, out)
            out[at][1] = grown(depth - 1, weight - part, out)
        return at

    trees = []
    for _ in range(6):
        nodes = []
        grown(9, 900.0, nodes)
        trees.append(tree.Tree(*map(np.array, zip(*nodes))))
    x = draw.normal(size=(50, 6))
    x[3, 2] = np.nan
    few = tree.contributions(trees, x)
    monkeypatch.setattr(tree, "MOST_CELLS", 100)
    steps = tree.contributions(trees, x)
    monkeypatch.setattr(tree, "FEW_ROWS", 0)
    many = tree.contributions(trees, x)
    assert np.abs(few - many).max() < 1e-12 and np.abs(few - steps).max() < 1e-12
    for t in trees:
        paths = t.paths(6)
        assert paths.share.prod(axis=1).sum() == pytest.approx(1.0)
        reached = paths.passed(x).all(axis=2)
        assert (reached.sum(axis=1) <= 1).all()


def test_many_features_and_gathered_batches():
    """Paths of more features than a kept table has, over batches put together."""
    rng = np.random.default_rng(3)
    depth, width = 8, 9
    inner = 2**depth - 1
    node = np.arange(2 * inner + 1)
    one = tree.Tree(
        left=np.where(node < inner, 2 * node + 1, -1),
        right=np.where(node < inner, 2 * node + 2, -1),
        feature=np.where(node < inner, node % width, -1),
        threshold=rng.random(len(node)),
        cover=1.0 + rng.random(len(node)),
        value=rng.random(len(node)),
    )
    x = rng.random((200, width))
    x[0, 0] = np.nan
    batches = [pd.DataFrame({"x": list(part)}) for part in (x[:70], x[:0], x[70:90], x[90:])]
    sizes = [len(b) for b in tree.gathered(iter(batches), 80)]
    assert sizes == [90, 110] and list(tree.gathered(iter([]), 80)) == []
    whole = np.concatenate([tree.contributions([one], np.stack(b["x"].to_numpy())) for b in tree.gathered(iter(batches), 80)])
    assert np.allclose(whole, tree.contributions_of_few([one], x), atol=1e-12)


@pytest.mark.parametrize(("states", "joint"), [(2, 10), (40, 200), (3000, 10**6)])
def test_rows_that_a_subtree_cannot_tell_apart(monkeypatch, states, joint):
    """One walk per state of a subtree gives what one walk per row gives: NaN, repeated features, nodes without weight."""
    draw = np.random.default_rng(5)

    def grown(depth, weight, out):
        at = len(out)
        out.append([-1, -1, 0, 0.0, weight, draw.random()])
        if depth and weight > 1 and draw.random() < 0.9:
            part = float(draw.integers(0, int(weight) + 1))
            out[at][2:4] = [int(draw.integers(6)), float(draw.integers(-3, 3))]
            out[at][0] = grown(depth - 1, part, out)
            out[at][1] = grown(depth - 1, weight - part, out)
        return at

    trees = []
    for _ in range(4):
        nodes = []
        grown(8, 900.0, nodes)
        trees.append(tree.Tree(*map(np.array, zip(*nodes))))
    x = draw.integers(-4, 4, (600, 6)) + 0.5 * draw.integers(0, 2, (600, 6))
    x[3, 2] = x[4, 0] = np.nan
    plain = tree.contributions(trees, x)
    walks, walk = [], tree.walk
    monkeypatch.setattr(tree, "MANY_ROWS", 0)
    monkeypatch.setattr(tree, "ROWS_PER_STATE", len(x) / states)
    monkeypatch.setattr(tree, "JOINT_POSITIONS", joint)
    monkeypatch.setattr(tree, "ROWS_IN_CACHE", 256)
    monkeypatch.setattr(tree, "walk", lambda *a: walks.append(len(a[3])) or walk(*a))
    found = tree.contributions(trees, x)
    assert found.shape == plain.shape and np.abs(found - plain).max() < 1e-12
    # The rows themselves are never walked: a walk has a row per state, and no more states than allowed or a leaf's own.
    assert walks and max(walks) <= max(states, 2**6)


def test_contributions_add_up_to_the_probability(forest):
    model, df = forest
    out = tree.tree_contributions(model, df.repartition(3), cols=COLS, keep=["is_fraud"])
    both = out.join(train.score(model, df).select("transaction_id", F.col("probability").alias("p")), "transaction_id")
    assert both.filter(F.abs(F.col("p") - F.col("probability")) > 1e-9).count() == 0
    assert both.count() == 400 and set(out.columns) == {"transaction_id", "is_fraud", "x", "base", "probability", "phi"}


def test_kept_nodes_give_the_same_trees(forest, monkeypatch):
    """The forest keeps each row's nodes, and its trees are those that walking from the root gives."""
    _, df = forest
    kept, plain = train.random_forest(df, COLS, trees=4, depth=6), train.RandomForestClassifier
    assert kept.stages[-1].getOrDefault("cacheNodeIds")
    monkeypatch.setattr(train, "RandomForestClassifier", lambda **k: plain(**{**k, "cacheNodeIds": False}))
    walked = train.random_forest(df, COLS, trees=4, depth=6)
    lines = [m.stages[-1].toDebugString.splitlines()[1:] for m in (kept, walked)]
    assert lines[0] == lines[1] and len(lines[0]) > 4


def noisy(spark, forest, copies=20):
    _, rows = forest
    noise = [(F.col(c) + F.round(F.rand(i), 2) * (F.rand(9 + i) > 0.3).cast("int")).alias(c) for i, c in enumerate(COLS)]
    return spark.createDataFrame(rows.crossJoin(spark.range(copies)).select("transaction_id", *noise, "is_fraud").toPandas())


@pytest.mark.parametrize(("copies", "pieces"), [(1, False), (40, False), (40, True)])
def test_counted_trees_are_those_of_the_classifier(spark, forest, monkeypatch, copies, pieces):
    """Without draws, the tree grown from counts is Spark's: thresholds of all 400 rows or of a sample, weights, pruning."""
    df = noisy(spark, forest, copies)
    if pieces:
        for name, value in {"BLOCK_ROWS": 500, "MOST_CELLS": 1, "PIECE_NODES": 3}.items():
            monkeypatch.setattr(counted_forest, name, value)
    estimator = train.RandomForestClassifier(
        labelCol=train.LABEL, featuresCol=train.VECTOR, weightCol="weight", numTrees=1, maxDepth=7, seed=42, featureSubsetStrategy="all", bootstrap=False
    )
    assembled = train.assemble(mf.class_weights(df), COLS)
    plain = estimator.fit(assembled)
    found = counted_forest.fit(estimator, df, COLS, counted_forest.classes(df, train.LABEL), len(COLS), bootstrap=False)
    order = ["transaction_id", *COLS]
    a, b = (train.score(m, assembled).select(*order, "prediction", "probability").sort(*order).toPandas() for m in (plain, found))
    assert (a.prediction == b.prediction).all() and np.allclose(a.probability, b.probability, atol=1e-12) and len(a) == 400 * copies
    assert found.totalNumNodes == plain.totalNumNodes > 10 and found.getMaxDepth() == 7 and found.getNumTrees == 1


def test_large_forests_keep_and_move_counts_not_rows(spark, forest, monkeypatch):
    """Beyond the limit a row is kept as one byte per feature, once for all trees, and only counts are shuffled."""
    df = noisy(spark, forest)
    plain = train.random_forest(df, COLS, trees=20, depth=6)
    monkeypatch.setattr(train, "CLASSIFIER_ROWS", 1000)
    monkeypatch.setattr(counted_forest, "BLOCK_ROWS", 1000)
    seen, counted = [], counted_forest.counted
    monkeypatch.setattr(counted_forest, "counted", lambda blocks, *rest: seen.append(blocks) or counted(blocks, *rest))
    model = train.random_forest(df, COLS, trees=20, depth=6)
    assert len(seen) == 6 and seen[0].columns == ["block", "bins"]
    sizes = seen[0].select("block", F.octet_length("bins")).collect()
    assert sum(n for _, n in sizes) == len(COLS) * 8000 and len({b for b, _ in sizes}) == len(sizes) >= 8
    both = {"plain": train.score(plain, df), "counted": train.score(model, df)}
    auc = {r.model: r.auc for r in metrics.model_comparison(both).collect()}
    assert auc["counted"] == pytest.approx(auc["plain"], abs=0.02) and auc["counted"] > 0.9
    weights = [m.stages[-1].featureImportances.toArray() for m in (plain, model)]
    assert np.abs(weights[0] - weights[1]).max() < 0.1
    out = tree.tree_contributions(model, df, cols=COLS)
    assert out.agg(F.max(F.abs(F.col("base") + F.aggregate("phi", F.lit(0.0), lambda a, v: a + v) - F.col("probability")))).first()[0] < 1e-9
    again = train.random_forest(df, COLS, trees=20, depth=6)
    assert again.stages[-1].toDebugString.splitlines()[1:] == model.stages[-1].toDebugString.splitlines()[1:]


def test_draws_are_poisson_and_repeatable():
    found = np.concatenate([counted_forest.draws(50_000, 42, block, 7) for block in range(20)])
    share = np.bincount(found, minlength=5)[:5] / len(found)
    assert np.abs(share - np.exp(-1) / np.array([1, 1, 2, 6, 24])).max() < 0.003 and found.max() > 6
    assert (counted_forest.draws(50_000, 42, 3, 7) == found[150_000:200_000]).all()
    assert (counted_forest.draws(50_000, 42, 3, 8) != found[150_000:200_000]).any()


def test_counted_forests_refuse_nulls(spark, forest, monkeypatch):
    _, df = forest
    monkeypatch.setattr(train, "CLASSIFIER_ROWS", 0)
    for name, bad in {"null": F.lit(None).cast("double"), "NaN": F.lit(float("nan"))}.items():
        with pytest.raises(Exception, match=name):
            train.random_forest(df.withColumn(COLS[0], bad), COLS, trees=2, depth=2)


def test_importance_and_scores(spark, forest):
    model, df = forest
    rows = train.feature_importance(model, COLS).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
    assert metrics.roc_auc(train.score(model, df)).first().auc > 0.95


def test_other_models_learn(forest):
    _, df = forest
    boosted = train.gradient_boosting(df, COLS, rounds=5)
    scaled = mf.standardize(df, cols=COLS)[0]
    linear = train.logistic_regression(scaled, COLS, iterations=50)
    out = metrics.model_comparison({"boosted": train.score(boosted, df), "linear": train.score(linear, scaled)})
    assert {r.model: r.auc > 0.7 for r in out.collect()} == {"boosted": True, "linear": True}


@pytest.mark.parametrize("copies", [1, 40])
def test_boosted_trees_are_those_of_the_classifier(spark, forest, copies):
    """Thresholds come from all 400 rows, or from a sample of 16,000; every probability is that of ``GBTClassifier``."""
    _, rows = forest
    noise = [(F.col(c) + F.rand(i) * (F.rand(9 + i) > 0.3).cast("int")).alias(c) for i, c in enumerate(COLS)]
    df = spark.createDataFrame(rows.crossJoin(spark.range(copies)).select("transaction_id", *noise, "is_fraud").toPandas())
    boosted = train.gradient_boosting(df, COLS, rounds=10)
    plain = GBTClassifier(labelCol=train.LABEL, featuresCol=train.VECTOR, maxIter=10, maxDepth=3, stepSize=0.1, seed=42)
    expected = train.score(train._fitted(plain, df, COLS), df)
    found = train.score(boosted, df)
    assert set(found.columns) == set(expected.columns)
    order = ["transaction_id", *COLS]
    pairs = list(zip(*[x.select(*order, "prediction", "probability").sort(*order).collect() for x in (found, expected)]))
    assert all(a.prediction == b.prediction and abs(a.probability - b.probability) < 1e-9 for a, b in pairs)
    assert len(pairs) == 400 * copies and len(boosted.trees) == 10


def test_boosting_moves_sums_not_rows(spark, forest, monkeypatch):
    """Rows are kept as blocks of bytes; a pass gives the driver one result a task, whatever the number of rows."""
    _, df = forest
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    passes, grown = [], boosting.grown
    monkeypatch.setattr(boosting, "grown", lambda blocks, *rest: passes.append(blocks) or grown(blocks, *rest))
    whole = train.gradient_boosting(df, COLS, rounds=3)
    assert len(passes) == 3 and passes[0].columns == ["bins", "label", "margin"]
    packed = passes[0].select(F.octet_length("bins"), F.octet_length("label"), F.octet_length("margin")).collect()
    assert sum(n for _, n, _ in packed) == 400 and all(b == len(COLS) * n and m == 8 * n and n <= 64 for b, n, m in packed)
    monkeypatch.setattr(boosting, "KEEP_ROUNDS", 1)
    again = train.gradient_boosting(df.repartition(5), COLS, rounds=3)
    assert [(t.features, t.cuts) for t in again.trees] == [(t.features, t.cuts) for t in whole.trees]
    assert np.allclose([t.leaves for t in again.trees], [t.leaves for t in whole.trees], atol=1e-12)


def test_boosting_refuses_nulls_and_other_labels(spark, forest):
    _, df = forest
    bad = {"null": df.withColumn(COLS[0], F.lit(None).cast("double")), "NaN": df.withColumn(COLS[0], F.lit(float("nan")))}
    for name, rows in {**bad, "labels": df.withColumn(train.LABEL, F.lit(2)), "no rows": df.limit(0)}.items():
        with pytest.raises(Exception, match=name):
            train.gradient_boosting(rows, COLS, rounds=1)
    model = train.gradient_boosting(df, COLS, rounds=1)
    with pytest.raises(Exception, match="null"):
        train.score(model, bad["null"]).agg(F.sum("probability")).collect()


def test_boosting_without_a_useful_threshold(spark):
    """A constant input has no threshold, and a node that no division improves keeps its mean."""
    df = spark.createDataFrame([(i, 1.0, float(i % 2), i % 2) for i in range(20)], "transaction_id int, a double, b double, is_fraud int")
    model = train.gradient_boosting(df, ("a", "b"), rounds=2)
    assert [len(t) for t in model.thresholds] == [0, 1] and model.trees[0].leaves == (-1.0,) * 4 + (1.0,) * 4
    assert train.score(model, df).filter(F.col("prediction") != F.col("is_fraud")).count() == 0


def test_models_score_after_an_observation(spark, forest):
    """An observation leaves the session with what cannot be sent to tasks; models must not hold the session."""
    _, df = forest
    spark.range(5).observe(Observation("seen"), F.count(F.lit(1)).alias("n")).count()
    scaled = mf.standardize(df, cols=COLS)[0]
    for model, rows in ((train.random_forest(df, COLS, trees=2, depth=2), df), (train.logistic_regression(scaled, COLS, iterations=5), scaled)):
        assert not model.stages[-1].hasSummary
        assert train.score(model, rows).agg(F.count("probability")).first()[0] == df.count()


def test_reports_on_contributions(spark):
    df = spark.createDataFrame([(1, 2.0, 10.0, 1.0, 1), (2, 4.0, 30.0, 1.0, 0)], "transaction_id int, a double, b double, c double, is_fraud int")
    phi = report.linear_contributions(df, (1.0, -0.1, 5.0), 0.5, cols=COLS, keep=["is_fraud"])
    rows = {r.transaction_id: r for r in phi.collect()}
    assert rows[1].phi == [-1.0, 1.0, 0.0] and rows[1].base == pytest.approx(0.5 + 3 - 2 + 5)
    assert rows[2].score == pytest.approx(0.5 + 4 - 3 + 5)
    impact = report.global_impact(phi, COLS).collect()
    assert [tuple(r) for r in impact] == [("a", 1.0, False), ("b", 1.0, False), ("c", 0.0, False)]
    top = report.top_contributors(phi, 2, names=("A", "B", "C")).orderBy("transaction_id", "position").collect()
    assert [(r.transaction_id, r.position, r.feature) for r in top] == [(1, 1, "A"), (1, 2, "B"), (2, 1, "A"), (2, 2, "B")]
    reasons = {r.transaction_id: r for r in report.reason_codes(phi, 3, names=("A", "B", "C")).collect()}
    assert reasons[1].up == ["B 10.00 raises the score by 1.0000"]
    assert reasons[1].down == ["A 2.00 lowers the score by 1.0000"]
    assert sorted(tuple(r) for r in report.dependence_rows(phi, "b", COLS).collect()) == [(10.0, 1.0, 1), (30.0, -1.0, 0)]


def test_contributions_are_ordered_without_lambdas(spark):
    """Ties keep the order of features, null contributions come first; sorting is Spark's own, not a lambda per comparison."""
    df = spark.createDataFrame([(1, [2.0, -2.0, None, 0.5], [1.0, 2.0, 3.0, 4.0])], "transaction_id int, phi array<double>, x array<double>")
    top = report.top_contributors(df, 3, names=("A", "B", "C", "D"))
    assert [(r.position, r.feature, r.value, r.phi) for r in top.collect()] == [(1, "C", 3.0, None), (2, "A", 1.0, 2.0), (3, "B", 2.0, -2.0)]
    assert "lambda" not in top._jdf.queryExecution().executedPlan().toString()


def test_sample_to_explain(labelled):
    rows = sorted((r.is_fraud, r.transaction_id) for r in mf.explain_sample(labelled).collect())
    assert rows == [(0, 1), (0, 2), (1, 0), (1, 10), (1, 20)]
    assert "WindowGroupLimit" in mf.explain_sample(labelled)._jdf.queryExecution().executedPlan().toString()
