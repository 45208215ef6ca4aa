"""Stored snapshots, publication behind gates, and greedy duplicates along chains, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from wrenfield.operators import gates, linkage
from wrenfield.staging import new_folder
from wrenfield.streaming import snapshot
from wrenfield.versions import Versions

SCHEMA = "id long, name string, url string, date string, end_date string, pipeline_state string, notion_page_id string"


def table(spark, seed, n, first=0):
    rnd = random.Random(seed)
    rows = []
    for i in range(first, first + n):
        url = rnd.choice([None, "", *(f"https://lu.ma/e{rnd.randrange(n // 2)}" for _ in range(5))])
        day = f"2024-01-{rnd.randint(10, 14)}"
        rows.append((i, f"Name {rnd.randrange(n // 3)}", url, day, rnd.choice([None, "2024-02-01"]), rnd.choice(["vetoed", "expired", "written", "pending_llm"]), rnd.choice([None, None, "page"])))
    return spark.createDataFrame(rows, SCHEMA)


def merged(stored: dict, batch: list, names: bool) -> dict:
    """The snapshot (by id) after a batch of keyed rows."""
    urls, taken = {r["url_id"] for r in stored.values() if r["url_id"]}, {(r["name_id"], r["date"]) for r in stored.values()}
    newest, kept = {}, []
    for r in sorted(batch, key=lambda r: r["id"]):
        if r["url_id"]:
            newest[r["url_id"]] = r
        if r["url_id"] in urls or names and (r["name_id"], r["date"]) in taken:
            continue
        if not any(r["url_id"] and r["url_id"] == k["url_id"] or names and (r["name_id"], r["date"]) == (k["name_id"], k["date"]) for k in kept):
            kept.append(r)
    out = {}
    for i, r in stored.items():
        n = newest.get(r["url_id"])
        if n and n["date"] != r["date"]:
            state = "pending_llm" if r["pipeline_state"] in ("expired", "llm_rejected", "vetoed") and r["notion_page_id"] is None else r["pipeline_state"]
            r = r | {"date": n["date"], "end_date": n["end_date"], "pipeline_state": state}
        out[i] = r
    return out | {r["id"]: r for r in kept}


@pytest.mark.parametrize("names", (True, False))
def test_batches_with_restarts_against_a_loop(spark, names):
    path = new_folder(spark, "upserts")
    want: dict = {}
    for k in range(4):
        batch = table(spark, k, 60, k * 60)
        batch.repartition(2).write.mode("append").parquet(f"{path}/landed")
        want = merged(want, [r.asDict() for r in linkage.keys(batch).collect()], names)
        stored = snapshot.Snapshot(spark, f"{path}/stored", 5, names)
        stored.run(spark.readStream.schema(SCHEMA).parquet(f"{path}/landed"), f"{path}/checkpoint")
        columns = snapshot.ROWS.fieldNames()
        assert sorted(map(tuple, stored.rows().collect())) == sorted(tuple(r[c] for c in columns) for r in want.values())
    # a batch that comes again, as after a lost commit of the stream, changes nothing
    before = stored.versions.manifest()
    stored.apply(table(spark, 9, 60, 900), 3)
    assert stored.versions.manifest() == before and stored.versions.numbers() == [0, 1, 2, 3]
    assert stored.rows(0).count() < stored.rows().count()


def test_only_touched_buckets_are_written(spark):
    stored = snapshot.Snapshot(spark, new_folder(spark, "upserts"), 32)
    stored.apply(table(spark, 1, 200), 0)
    before = stored.versions.manifest()["parts"]
    stored.apply(spark.createDataFrame([(5000, "New name", "https://lu.ma/new", "2024-03-01", None, "pending_llm", None)], SCHEMA), 1)
    after = stored.versions.manifest()["parts"]
    assert sum(before.get(k) != v for k, v in after.items()) == 2 and len(before) > 20  # a bucket of rows, and one of names
    stored.apply(spark.createDataFrame([], SCHEMA), 2)
    assert stored.versions.manifest()["parts"] == after
    rows = sorted(map(tuple, stored.rows().collect()))
    assert stored.versions.vacuum(1) == 0 and sorted(map(tuple, stored.rows().collect())) == rows  # both older folders are still in use
    assert stored.versions.numbers() == [2]


def test_a_batch_that_broke_off_is_done_again(spark, monkeypatch):
    stored = snapshot.Snapshot(spark, new_folder(spark, "upserts"), 4)
    stored.apply(table(spark, 1, 50), 0)
    rows = stored.rows().count()
    with monkeypatch.context() as m:
        m.setattr(Versions, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stored.apply(table(spark, 2, 50, 50), 1)
    assert stored.rows().count() == rows
    stored.apply(table(spark, 2, 50, 50), 1)
    want = merged(merged({}, [r.asDict() for r in linkage.keys(table(spark, 1, 50)).collect()], True), [r.asDict() for r in linkage.keys(table(spark, 2, 50, 50)).collect()], True)
    assert sorted(r.id for r in stored.rows().collect()) == sorted(want)
    assert stored.versions.vacuum(9) == 1  # what the lost attempt had written


def test_a_refused_table_leaves_the_published_one(spark):
    versions = Versions(spark, new_folder(spark, "published"))
    full = table(spark, 3, 40).withColumn("run_date", F.when(F.col("id") < 20, "2024-01-01").otherwise("2024-01-02")).withColumn("end_date", F.lit(None).cast("string"))
    assert gates.publish_or_refuse(versions, full) == 0
    before = versions.manifest()
    with pytest.raises(gates.Refused, match="lost_rows: 20, lost_run_dates: 1"):
        gates.publish_or_refuse(versions, full.where("id < 20"))
    back = full.withColumn("pipeline_state", F.when(F.col("notion_page_id").isNotNull(), F.lit("pending_travel")).otherwise(F.col("pipeline_state")))
    assert set(gates.publish(versions, back).reasons) == {"regressions"}
    assert versions.manifest() == before and versions.vacuum(1) == 0
    assert gates.publish(versions, full, {"crowded": gates.crowded("2024-01-01")}).accepted
    assert versions.numbers() == [0, 1] and versions.read(full.schema).count() == 40


def loop(rows):
    kept = []
    for i, u, n, d in sorted(rows):
        if not any(u is not None and u == b or (n, d) == (c, e) for _, b, c, e in kept):
            kept.append((i, u, n, d))
    return [k[0] for k in kept]


def quick(rows):
    urls, names, kept = set(), set(), []
    for i, u, n, d in sorted(rows):
        if not (u is not None and u in urls or (n, d) in names):
            kept.append(i)
            names.add((n, d))
            urls.add(u)
    return kept


def test_chains_take_few_rounds(spark, monkeypatch):
    n = 10_000
    rows = [(i, f"u{(i + 1) // 2}", f"n{i // 2}", "d") for i in range(n)]  # each row shares its name with one neighbour, its URL with the other
    written = []
    keep = linkage.staged
    monkeypatch.setattr(linkage, "staged", lambda df: written.append(1) or keep(df))
    got = sorted(r.id for r in linkage.greedy(spark.createDataFrame(rows, "id long, url_id string, name_id string, date string")).collect())
    assert got == quick(rows) == list(range(0, n, 2)) and len(written) <= 20


def test_greedy_on_groups_of_any_size(spark):
    rnd = random.Random(5)
    for n, urls, names in ((80, 20, 20), (80, 60, 60), (120, 4, 90), (60, 1, 1), (90, 200, 30)):
        rows = [(i, rnd.choice([None, f"u{rnd.randrange(urls)}", f"u{rnd.randrange(urls)}"]), f"n{rnd.randrange(names)}", rnd.choice("de")) for i in range(n)]
        df = spark.createDataFrame(rows, "id long, url_id string, name_id string, date string")
        assert sorted(r.id for r in linkage.greedy(df).collect()) == loop(rows) == quick(rows)
