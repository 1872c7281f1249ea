import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.llm import quality
from tests.llm.data import docs, none


def test_features_are_distinct_and_whole():
    text = "One two, two two three!!\n\n1 2 x" * 500 + " last"
    found = quality.features(text)
    assert len(set(found.tolist())) == len(found) and found.min() >= 1 and found.max() < quality.DIMENSIONS
    assert set(quality.features(text[:-5]).tolist()) < set(found.tolist())
    assert quality.features("").tolist() == quality.features(None).tolist() == quality.features(" \t").tolist() == [0]


def test_descent_reaches_the_optimum():
    """The dual found is that of the hinge-loss problem: its gap to the primal is small."""
    draw = np.random.default_rng(3)
    rows = [np.unique(draw.integers(1, 60, size=12)).astype(np.int32) for _ in range(200)]
    labels = np.array([int(len(set(r.tolist()) & set(range(1, 25))) > 4) for r in rows])
    model = quality.fit(rows, labels, cost=1.0, passes=400)
    ratios = quality.log_count_ratios(rows, labels)
    values = [ratios[r] / np.sqrt(len(r)) for r in rows]
    weights = np.divide(model.weights, ratios, out=np.zeros_like(ratios), where=ratios != 0)
    signs = np.where(labels == 1, 1.0, -1.0)
    margins = np.array([s * (v @ weights[r] + model.bias) for s, v, r in zip(signs, values, rows)])
    primal = 0.5 * (weights @ weights + model.bias**2) + np.maximum(0, 1 - margins).sum()
    for step in draw.normal(size=(30, 60)) * 0.05:
        other = weights.copy()
        other[:60] += step
        moved = np.array([s * (v @ other[r] + model.bias) for s, v, r in zip(signs, values, rows)])
        assert 0.5 * (other @ other + model.bias**2) + np.maximum(0, 1 - moved).sum() >= primal - 1e-2


def test_ratios_count_texts():
    rows = [np.array([1, 2]), np.array([1]), np.array([2, 3])]
    ratios = quality.log_count_ratios(rows, np.array([1, 1, 0]))
    assert ratios[1] > 0 > ratios[3] and abs((ratios[1] - ratios[2]) - np.log(3 / 2) - np.log(2)) < 1e-12


def test_one_class_or_none():
    assert quality.fit([np.array([1])], np.array([1])).score("x") > 0.5
    assert quality.fit([np.array([1])], np.array([0])).score("x") < 0.5
    assert quality.fit([], np.array([], dtype=int)).score(None) > 0.5


def test_held_out_rows_teach_nothing(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    ids = [r.doc_id for r in labels.collect()]
    out = {r.doc_id: r.h for r in labels.select("doc_id", quality.held_out().alias("h")).collect()}
    assert out == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in ids}
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(table, labels), quality.train(table, flipped)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_sample_is_bounded_and_by_hash(spark, small):
    table, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    assert quality.sample(table, labels, most=7).count() == 7
    twice = labels.unionByName(labels)
    assert quality.sample(table, twice).count() == quality.sample(table, labels).count()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    table, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(table, labels)
    judged = table.join(labels, "doc_id").filter(quality.held_out()).select("text", "quality")
    scored = quality.with_score(judged, model).select("quality", "score").collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in scored)
    assert len(scored) > 500 and right / len(scored) > 0.98
    assert sum(r.score < 0.5 for r in scored if r.quality == 1) / sum(r.quality == 1 for r in scored) < 0.005


def test_all_cases(spark):
    table = docs(spark)
    marks = spark.createDataFrame([(0, 1, None), (1, 0, 0), (1, 1, 0), (None, 0, 0), (5, None, 0), (3, 1, 1), (9, 7, 1)], "doc_id long, quality int, toxic int")
    scored = quality.with_score(table, quality.train(table, marks), "grade")
    assert all(0 <= r.grade <= 1 for r in scored.select("grade").collect()) and scored.count() == table.count()
    assert scored.columns == [*table.columns, "grade"]
    model = quality.train(none(spark), marks)
    assert quality.with_score(none(spark), model).count() == 0
    assert quality.train(table, marks.limit(0)).bias == 1.0


def test_copies_of_a_labelled_id_do_not_raise_the_rows(spark):
    table = spark.range(3000).select((F.col("id") % 3).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(n, n % 2) for n in range(40)], "doc_id long, quality int")
    first = quality.sample(table, labels).collect()
    assert len(first) <= 3 and sorted(quality.sample(table.repartition(5), labels).collect()) == sorted(first)
