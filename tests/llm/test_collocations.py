"""Counting quotient filters and phrases on small tables: shards of any size, nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wrenfield.llm import collocations, quotient


@pytest.mark.parametrize("bits", (1, 2, 7, 12, 17, 22, 25, 32, 33, 40, 64))
def test_filters_lose_nothing(bits):
    rng = np.random.default_rng(bits)
    for n in range(1, 6):
        for m in (0, 1, 40, 3000):
            ids = rng.integers(0, 1 << min(bits, 62), (n, m))
            keys = quotient.packed(ids, bits)
            assert (quotient.unpacked(keys, n, bits) == ids).all()
            own, counts, number = quotient.summed(keys)
            assert (own[:, number] == keys).all() and counts.sum() == m
            counts = counts * rng.choice([1, 254, 255, 10**12], len(counts))
            p = quotient.bucket_bits(n, bits, 5)
            bucket = quotient.buckets(own, n, bits, p)
            for b in np.unique(bucket):
                at = bucket == b
                again, times = quotient.decode(quotient.encode(own[:, at], counts[at], n, bits, p), n, bits, p, int(b))
                assert (again == own[:, at]).all() and (times == counts[at]).all()


def test_filters_are_compact_and_even():
    ids = np.stack([np.arange(40_000) // 200, np.arange(40_000) % 200]) + 1
    keys, counts, _ = quotient.summed(quotient.packed(ids, 17))
    sizes = np.bincount(quotient.buckets(keys, 2, 17, 4), minlength=16)
    assert sizes.max() < 1.2 * sizes.min()
    first = keys[:, : sizes[0]]
    assert len(quotient.encode(first, counts[: sizes[0]], 2, 17, 4)) < 5 * sizes[0]  # of 34 bits each, and a counter


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    words = ["de", "la", "été", "x", "y", "z", "\x00", "l'a", "(b)", "ÀB"]
    rows = []
    for i in range(160):
        t = "".join(rnd.choice(words[: rnd.choice((3, 6, 10))]) + rnd.choice([" "] * 6 + ["\t", ". ", ",", "\n", "  ", "\x0b", " ; "]) for _ in range(rnd.randint(0, 60)))
        rows.append((rnd.choice(["en", "en", "fr", None, "und"]), t))
    rows += [("en", "Big Apple pie tin"), ("en", "big apple Pie TIN")] * 12 + [(None, None), ("fr", None), ("fr", ""), ("fr", " \t.,"), ("xx", "y"), ("en", "la la " * 3000)]
    return rows


@pytest.mark.parametrize("options", ({}, {"shard_bytes": 300, "bucket_words": 100}, {"longest": 2}, {"longest": 3, "most": 7, "least": 2}))
def test_phrases_against_a_table(spark, texts, options):
    docs = spark.createDataFrame(texts, "lang string, text string").withColumn("n", F.lit("x")).withColumn("word", F.lit(1)).repartition(4)
    least = options.pop("least", 5)
    got = collocations.collocations(docs, least, **options).collect()
    want = collocations.brute_force(texts, least, options.get("longest", 5), options.get("most", 2000))
    assert sorted(map(tuple, got)) == want and len(want) > 10


def test_empty_and_wordless_tables(spark):
    docs = spark.createDataFrame([("en", " .")], "lang string, text string")
    assert collocations.collocations(docs.where("false")).count() == collocations.collocations(docs).count() == 0
