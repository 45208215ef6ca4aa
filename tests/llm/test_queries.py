"""Registered queries with SQL against DuckDB, and the pipeline's stages on the smallest tables."""

import pathlib

import duckdb
import pytest

from wrenfield.llm import decontaminate, near_dedup, ogg, packing, runs, suffix_dedup
from wrenfield.llm.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="needs the driver's tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_duckdb(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = QUERIES[name](spark, DATA)
    cols = sorted(got.columns)
    want = c.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted((tuple(r[names.index(k)] for k in cols) for r in want.fetchall()), key=str)


CONTRACT = {
    "op2_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op3_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op4_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_decontaminate": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op6_near_dedup": {"doc_id": "bigint", "class_id": "bigint"},
    "op8_ogg_media": {"doc_id": "bigint", "n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"},
    "op9_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op11_periodic_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op12_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op10_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
}


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract(spark, name, texts):
    got = QUERIES[name](spark, DATA)
    kinds = dict(got.dtypes)
    assert {c: kinds.get(c) for c in CONTRACT[name]} == CONTRACT[name]
    rows = got.collect()
    assert rows
    key = "page_id" if "page_id" in kinds else "doc_id"
    table = "pages" if key == "page_id" else "documents"
    ids = sorted(r[0] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect())
    assert (sorted(set(r[key] for r in rows)) if name.startswith("op10") else sorted(r[key] for r in rows)) == ids


def test_decontamination_query_against_a_loop(spark, texts):
    bench = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op5_decontaminate"](spark, DATA).select(*CONTRACT["op5_decontaminate"]).collect())
    assert got == sorted(decontaminate.brute_force(texts, bench)) and any(r[5] for r in got)


def test_near_dedup_query_against_all_pairs(spark, texts):
    got = sorted(map(tuple, QUERIES["op6_near_dedup"](spark, DATA).select("doc_id", "class_id").collect()))
    assert got == near_dedup.brute_force(texts) and any(d != c for d, c in got)


def test_near_dedup_recall_against_all_rows(spark):
    """Links of every row whose id is divisible by 20 with all rows have both ends in one class."""
    import re
    from collections import Counter

    data = DATA.replace("0.001", "0.01")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    group = {r.doc_id: r.class_id for r in QUERIES["op6_near_dedup"](spark, data).collect()}
    bags = {}
    for d, t in docs:
        w = tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")))
        bags[d] = Counter(w[i : i + 5] for i in range(max(1, len(w) - 4))) if w else Counter()
    links = []
    for q in (d for d, _ in docs if d % 20 == 0 and bags[d]):
        for d, bag in bags.items():
            shared = sum((bags[q] & bag).values()) if d != q and not bags[q].keys().isdisjoint(bag) else 0
            if shared and shared >= 0.8 * (bags[q].total() + bag.total() - shared):
                links.append((q, d))
    assert len(links) > 10 and sum(group[q] == group[d] for q, d in links) >= 0.95 * len(links)


def test_repeats_query_against_a_table_of_strings(spark, texts):
    got = sorted(tuple(r) for r in QUERIES["op9_suffix_dedup"](spark, DATA).select(*CONTRACT["op9_suffix_dedup"]).collect())
    assert got == sorted(suffix_dedup.brute_force(texts)) and any(r[2] for r in got)


def test_runs_query_against_the_definition(spark, texts):
    import hashlib
    import re
    import zlib

    want = []
    for d, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h = zlib.crc32(str(d).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = runs.brute_force(w)
        top = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None,) * 3
        gone = {i for s, k, q in found for i in range(s + q, s + k)}
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        want.append((d, len(found), *top, 1000 * top[1] // top[2] if found else None, digest(lines), digest(" ".join(x for i, x in enumerate(w) if i not in gone))))
    got = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, DATA).select(*CONTRACT["op11_periodic_runs"]).collect())
    assert got == sorted(want) and sum(r[1] > 0 for r in got) > 10


def test_quality_of_held_out_documents(spark):
    import zlib

    data = DATA.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    rows = QUERIES["op12_quality"](spark, data).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    seen = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, _, y in seen if y == k] for k in (1, 0))
    assert len(bad) > 5 and sum(p == y for _, p, y in seen) >= 0.97 * len(seen)
    assert sum(g > b for g in good for b in bad) > 0.95 * len(good) * len(bad)


def test_media_query_against_the_payload(spark, texts):
    import hashlib
    import zlib

    of = dict(texts)
    rows = QUERIES["op8_ogg_media"](spark, DATA).collect()
    for r in rows:
        raw = (of[r.doc_id] or "").encode()
        padded = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        media = ogg.encode(padded, len(raw))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
    same: dict = {}
    for r in rows:
        assert same.setdefault(of[r.doc_id] or "", (r.feature, r.media_sha256)) == (r.feature, r.media_sha256)


def test_packing_query_against_the_tokenizer(spark, texts):
    import struct
    import zlib

    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    want = set()
    for d, t in texts:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want.add((d, k // 2048, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    rows = QUERIES["op10_best_fit_packing"](spark, DATA).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    bins: dict = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 2048
    assert len(bins) <= 1.01 * sum(r[3] for r in want) / 2048 + 1


def test_stages_of_empty_and_odd_tables(spark):
    """No rows, null texts and ids, repeated rows, and columns with the names that operators use."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = ["score", "class_id", "n_bytes", "hit_words", "id", "__k1", "bands"]
    odd = docs.limit(12).unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, None, None, None, None), (7, None, "x", "s", 0), (8, "", None, None, None)], docs.schema))
    odd = odd.selectExpr("*", *(f"'{n}' AS {n}" for n in names))
    for name, apply in corpus_pipeline.STAGES[:-1]:
        empty = apply(spark, odd.where("false"), DATA)
        assert empty.count() == 0 and empty.columns == odd.columns, name
        rows = apply(spark, odd, DATA).collect()
        assert rows and all(r[n] == n for r in rows for n in names), name
    assert corpus_pipeline.STAGES[-1][1](spark, odd.where("false"), DATA).count() == 0


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    at = docs.where("doc_id < 120").cache()
    steps = dict(corpus_pipeline.STAGES)
    calm = steps["toxicity"](spark, at, DATA)
    assert calm.columns == docs.columns and 0 < calm.count() < at.count()
    one = steps["near-duplicates"](spark, at, DATA)
    classes = near_dedup.brute_force([(r.doc_id, r.text) for r in at.collect()])
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, c in classes})
    cut = {r.doc_id: r for r in steps["repeated strings"](spark, at, DATA).collect()}
    for d, _, gone, _, _ in suffix_dedup.brute_force([(r.doc_id, r.text) for r in at.collect()]):
        assert d not in cut or cut[d].n_chars == len(cut[d].text)
        assert d in cut or gone > 0
    clean = steps["decontamination"](spark, at, DATA)
    bench = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    want = [r[0] for r in decontaminate.brute_force([(r.doc_id, r.text) for r in at.collect()], bench) if not r[5]]
    assert sorted(r.doc_id for r in clean.collect()) == sorted(want)
    assert corpus_pipeline.run(spark, DATA).count() > 0
