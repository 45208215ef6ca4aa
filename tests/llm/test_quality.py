"""The compression classifier on small tables: nulls, empty and long texts, one class, no labels, repeated rows, clashing names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wrenfield.llm import quality


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("aeioulrnst") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    good = [say(rnd.randint(30, 200)).capitalize() + "." for _ in range(120)]
    bad = [" | ".join(f"{w}$$$" for w in say(rnd.randint(30, 200)).upper().split()) for _ in range(60)]
    return [(i, t, int(i < 120)) for i, t in enumerate(good + bad)]


def tables(spark, rows):
    return spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")


def test_scores_part_the_classes_and_more_rows_pass(spark, texts):
    docs, labels = tables(spark, texts)
    model = quality.fit(docs, labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1), (1, None), (10**6, 0)], labels.schema)))
    odd = spark.createDataFrame([(500, None), (501, ""), (None, "x"), (1, texts[1][1]), (1, texts[1][1]), (502, texts[3][1] * 3000)], docs.schema)
    got = quality.score(docs.unionByName(odd).withColumn("score", F.lit("old")).withColumn("good", F.lit(1)), model)
    assert got.columns == ["doc_id", "text", "good", "score"] and got.count() == len(texts) + 6
    by = {}
    for r in got.collect():
        assert 0 <= r.score <= 1 and by.setdefault((r.doc_id, r.text), r.score) == r.score
    assert all((by[(i, t)] >= 0.5) == (y == 1) for i, t, y in texts)
    assert by[(500, None)] == by[(501, "")] and by[(502, texts[3][1] * 3000)] is not None
    assert quality.score(docs.where("false"), model).count() == 0


def test_model_of_few_or_like_rows(spark, texts):
    docs, labels = tables(spark, texts[:8])
    for usable, share in ((F.lit(True), 1 - 1e-6), (F.lit(False), 0.5)):
        model = quality.fit(docs, labels, usable=usable)
        assert model[:2] == (None, None) and {round(r.score, 9) for r in quality.score(docs, model).collect()} == {share}
    assert quality.fit(docs.where("false"), labels)[0] is None


def test_fit_is_bounded_and_repeatable(spark, texts):
    docs, labels = tables(spark, texts)
    assert quality.fit(docs, labels, sample=150) == quality.fit(docs.repartition(7), labels, sample=150)
    assert quality.fit(docs, labels, most=10)[0] is None  # one text is no sample


def test_logistic_against_gradient():
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(400), rng.normal(size=(400, 2))])
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.4 + x[:, 1] - 2 * x[:, 2])))).astype(float)
    w = quality.logistic(x, y, ridge=0.05)
    slope = x.T @ (y - 1 / (1 + np.exp(-x @ w))) - np.array([1e-6, 0.05, 0.05]) * w
    assert np.abs(slope).max() < 1e-6
