"""Shares of the names' words in whole texts, against a loop."""

import re

from wrenfield.registry import QUERIES


def test_word_overlap(spark, tmp_path):
    texts = ["été à la plage", "Über den Fluß und in die Wälder des Nordens ging er", "a" * 38 + " cut word", "short name of forty characters, then " + "word " * 20_000 + "été", "", "...", "日本 語", None, "x_1 y-2 ½"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'s' AS source", "'de' AS lang", "0L AS n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in enumerate(texts):
        a, b = (set(re.findall(r"\w+", x.lower())) for x in ((t or "")[:40], t or ""))
        want.append((i, round(len(a & b) / min(len(a), len(b)), 6) if a and b else 0.0))
    assert 0 < min(s for _, s in want if s) < 1
    assert sorted(map(tuple, QUERIES["word_overlap_all_texts"](spark, str(tmp_path)).collect())) == want
