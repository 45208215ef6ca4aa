"""Periodic runs on small tables: random words, nested and touching runs, nulls, empty and long texts, repeated rows, clashing names."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from wrenfield.llm import runs


def lists():
    rnd = random.Random(7)
    out = [[], ["a"], ["a"] * 11, ["a"] * 12, list("abababa" * 2), list("ababababa" * 2), list("abaababaabaababaababa" * 3)]
    for _ in range(120):
        n, k = rnd.choice((5, 12, 30, 100, 250)), rnd.choice((1, 2, 3, 9, 60))
        w = [str(rnd.randrange(k)) for _ in range(n)]
        if rnd.random() < 0.6:
            a = rnd.randrange(n)
            p = rnd.randint(1, max(1, (n - a) // 2))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        out.append(w + (w if rnd.random() < 0.2 else []))
    return out


def collapsed(w):
    gone = {i for s, k, q in runs.brute_force(w) for i in range(s + q, s + k)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_of_many_texts(spark):
    texts = [" \t".join(w) for w in lists()]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[60]), (3, texts[60]), (None, texts[61]), (900, None), (901, " \n\t ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("old")).withColumn("n", F.lit(1)).repartition(3)
    got = runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "text", "n", "n_words", "runs", "collapsed"]
    found = got.collect()
    assert len(found) == len(rows) and sorted((str(r.doc_id), r.text or "") for r in found) == sorted((str(d), t or "") for d, t in rows)
    for r in found:
        w = (r.text or "").split()
        assert r.n_words == len(w) and [tuple(x) for x in r.runs] == runs.brute_force(w) and r.collapsed == collapsed(w)
    assert runs.periodic_runs(docs.where("false")).count() == 0


def test_other_least_length(spark):
    docs = spark.createDataFrame([(1, "x a b a b c c y")], "doc_id long, text string")
    assert [tuple(x) for x in runs.periodic_runs(docs, least=2).first().runs] == [(1, 4, 2), (5, 2, 1)]


def test_long_texts_of_few_words_take_little_longer_than_others():
    rnd = random.Random(3)
    took = []
    for n in (30_000, 240_000):
        for word in (np.zeros(n, np.int64), np.array([rnd.randrange(2) for _ in range(n)])):
            began = time.time()
            start, length, _ = runs.find(word, n)
            took.append(time.time() - began)
        assert len(start) > 100
    assert runs.find(np.zeros(5000, np.int64), 5000)[1].tolist() == [5000]
    assert took[2] < 40 * took[0] + 1 and took[3] < 40 * took[1] + 1  # the square would be 64 times
