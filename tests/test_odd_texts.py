"""Queries over blank and missing texts against their SQL."""

import duckdb

from wrenfield.registry import QUERIES, SQL
from wrenfield.staging import new_folder


def test_only_every_third_row_cannot_be_processed(spark):
    folder = new_folder(spark, "odd")
    texts = [None, "", "   ", "a text", "\t\n"]
    rows = [(i, texts[i % 5], "src", "en", 0) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars int").write.parquet(f"{folder}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    got = QUERIES["couldnt_process"](spark, folder).select("id", "tier").collect()
    assert sorted(map(tuple, got), key=str) == sorted(duck.execute(f"SELECT id, tier FROM ({SQL['couldnt_process']})").fetchall(), key=str)
