"""The operators on small tables with nulls, empty and long texts, ties, repeated rows and further columns."""

import base64
import hashlib
import html
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wrenfield.llm import chat_format, decontaminate, html_text, induced, near_dedup, ogg, packing, suffix_dedup, toxicity, url_reputation, warc

WORDS = "the of and to in is it that was for on are as with they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    say = lambda n: " ".join(rnd.choice(WORDS) + (rnd.choice("., ") if rnd.random() < 0.1 else "") for _ in range(n))
    passage = say(70)
    base = [say(120) for _ in range(6)]
    out = [say(rnd.randint(1, 150)) for _ in range(30)] + base + base[:3]
    for b in base:  # near copies
        w = b.split(" ")
        for _ in range(3):
            w[rnd.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += [f"{say(20)} {passage} {say(20)}" for _ in range(12)]
    out += [None, "", "  ", "###", "###", "one", "One.", "été déjà vu 😀 " * 40, "x" * 900, "ab" * 400, say(6000)]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    from pyspark.sql import functions as F

    return df.withColumn("start", F.lit(1)).withColumn("spans", F.lit("x")).withColumn("id", F.col("doc_id") + 1).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, start int, spans string, id long")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_decontamination(spark, docs, texts, none):
    items = [(1, " ".join(texts[31][1].split(" ")[20:45])), (2, "One"), (3, None), (4, "..."), (None, texts[33][1]), (5, texts[46][1]), (5, "way find use")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(decontaminate.brute_force(texts, items), key=str)
    for size, part in ((10**6, 50_000), (200, 50_000), (10**6, 1), (300, 7)):  # one block, and several; parts of items
        got = decontaminate.scan(docs, bench, keep=["doc_id"], block_bytes=size, part_words=part)
        flat = [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.hit_words), len(r.item_ids), hashlib.sha256(",".join(r.item_ids).encode()).hexdigest(), bool(r.hit_words)) for r in got.collect()]
        assert sorted(flat, key=str) == want
    hit = {w[0] for w in want if w[5]}
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == {d for d, _ in texts} - hit
    cut = {r.doc_id: r for r in decontaminate.clean(docs, bench, "span").collect()}
    assert len(cut) == len(texts) and cut[40].text != texts[40][1] or 40 not in hit
    assert set(decontaminate.clean(docs, bench).columns) == set(docs.columns)
    assert decontaminate.scan(none, bench).count() == 0
    assert rows(decontaminate.clean(docs, bench.limit(0)), "doc_id") == sorted(((d,) for d, _ in texts), key=str)


def test_repeated_words_in_order_of_spans(spark):
    d = spark.createDataFrame([(1, "a b c d e f g h i j k a b c"), (1, "a b c d e f g h i j k a b c")], "doc_id long, text string")
    got = decontaminate.clean(d, spark.createDataFrame([(1, "b c d e f g h i j k")], "item_id long, text string"), "span").collect()
    assert [r.text for r in got] == ["a  a b c"] * 2


def test_near_duplicates(spark, docs, texts, none):
    assert rows(near_dedup.near_duplicates(docs), "doc_id", "class_id") == sorted(near_dedup.brute_force(texts), key=str)
    assert near_dedup.near_duplicates(none).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (None, None), (3, "a b c d e f"), (3, "a b c d e f"), (4, "u v w x y z"), (4, "a b c d e f"), (9, "u v w x y z")], "doc_id long, text string")
    got = rows(near_dedup.near_duplicates(odd), "doc_id", "class_id")
    assert got == sorted([(None, None), (None, None), (3, 3), (3, 3), (4, 3), (4, 3), (9, 3)], key=str)
    kept = near_dedup.keep_one(odd)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([None, None, 3], key=str)


def test_near_copies_of_versions(spark):
    rnd = random.Random(7)
    say = lambda: [rnd.choice(WORDS) for _ in range(150)]
    near = lambda w, at: " ".join([*w[:at], "changed", *w[at + 1 :]])
    a, b, c, d, e, f = (say() for _ in range(6))
    # 5: near copies of both texts; 20: a copy of one elsewhere; 30: three texts, one of them twice; 40: also empty
    texts = [(5, a), (5, b), (7, near(a, 60)), (8, near(b, 60)), (20, c), (20, d), (2, d), (21, near(c, 40)), (22, near(d, 40))]
    texts += [(30, e), (30, e), (30, f), (30, say()), (31, near(e, 9)), (32, near(f, 9)), (40, None), (40, ""), (40, "###"), (40, say()), (41, say())]
    texts = [(d, " ".join(t) if isinstance(t, list) else t) for d, t in texts]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    want = sorted(((5, 5), (5, 5), (7, 5), (8, 5), (20, 2), (20, 2), (2, 2), (21, 2), (22, 2), *[(30, 30)] * 4, (31, 30), (32, 30), *[(40, 40)] * 4, (41, 41)), key=str)
    assert sorted(near_dedup.brute_force(texts), key=str) == want
    assert rows(near_dedup.near_duplicates(docs), "doc_id", "class_id") == want
    assert rows(near_dedup.keep_one(docs), "doc_id") == [(2,), (30,), (40,), (41,), (5,)]


def test_texts_just_below_the_threshold_make_few_pairs(spark, monkeypatch):
    """Near copies of one text, texts a little too far from all of these, and texts linked with one near copy only."""
    rnd = random.Random(11)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]

    def changed(w, times, lo=5, hi=195):
        w = list(w)
        for i in rnd.sample(range(lo, hi, 6), times):
            w[i] = f"x{rnd.randrange(10**9)}"
        return w

    copies = [changed(base, 1) for _ in range(150)]
    far = [changed(base, 5) for _ in range(40)]
    halves = [changed(base, 2, 5, 60) for _ in range(10)]
    children = [changed(w, 4, 65) for w in halves]
    repeats = [[*w[:100], *["again"] * 40, *w[100:]] for w in (*copies[:5], *far[:5])]
    texts = list(enumerate(" ".join(w) for w in (base, *copies, *far, *halves, *children, *repeats)))
    rnd.shuffle(texts)
    rows_of = {}

    def watched(df, name, real=near_dedup.stage):
        out = real(df, name)
        rows_of[name] = max(out.count(), rows_of.get(name, 0))
        return out

    monkeypatch.setattr(near_dedup, "stage", watched)
    want = near_dedup.brute_force(texts)
    top = dict(want)
    assert all(top[201 + i] == 0 for i in range(10)) and sum(top[151 + i] == 151 + i for i in range(40)) > 30
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert rows(near_dedup.near_duplicates(docs), "doc_id", "class_id") == sorted(want, key=str)
    assert rows_of["more"] <= 2 * len(texts)  # all pairs of the near copies and the others: 6,000


def test_differences_give_the_similarity():
    rnd = random.Random(12)
    a, b = ([" ".join(rnd.choices("abc", [8, 1, 1], k=rnd.randrange(60))) for _ in range(200)] for _ in "ab")
    a, b = pa.array([*a, "", None, "a a a a a a a b"]), pa.array([*b, "x", None, "a a a a a a a a a a c"])
    got = np.zeros(len(a))
    for i, j, n, m, unit, of in near_dedup.differences(a, b):
        d = np.bincount(of, minlength=j - i)
        assert all(len(set(unit[of == k])) == d[k] for k in range(j - i))
        got[i:j] = (n + m - d) / np.maximum(n + m + d, 1)
    assert np.allclose(got, near_dedup.similarity(a, b)) and got[-1] == 3 / 8


def test_dart_signatures_estimate_weighted_jaccard():
    rnd = np.random.default_rng(3)
    shared, own = rnd.integers(1, 2**63, 300, dtype=np.uint64), [rnd.integers(1, 2**63, 100, dtype=np.uint64) for _ in range(2)]
    for scale in (1.0, 1e-3, 1e5):  # any positive weights, and the work does not follow them
        w = [np.exp(rnd.normal(0, 2, 400)) * scale for _ in range(2)]
        w[1][:200] = w[0][:200]
        element, of = np.concatenate((shared, own[0], shared, own[1])), np.repeat([0, 1], 400)
        s = near_dedup.signatures(element, of, np.concatenate(w), 2, 4000)
        low, high = (sum(f(w[0][i], w[1][i]) for i in range(300)) for f in (min, max))
        want = low / (high + w[0][300:].sum() + w[1][300:].sum())
        assert abs((s[0] == s[1]).mean() - want) < 0.04
        assert (s > 0).all()
    assert list(near_dedup.similarity(pa.array(["a a a b c d e f a a a"]), pa.array(["a a a b c d e f a a a"]))) == [1.0]
    a, b = "a a a a a a a b", "a a a a a a a a a a c"  # (a a a a a) weighs 3 and 6
    assert near_dedup.similarity(pa.array([a]), pa.array([b]))[0] == 3 / 8


def test_agreement_counts_equal_coordinates(spark):
    rnd = np.random.default_rng(4)
    a = rnd.integers(1, 2**40, (50, 144), dtype=np.uint64)
    b = np.where(rnd.random((50, 144)) < 0.6, a, rnd.integers(1, 2**40, (50, 144), dtype=np.uint64))
    x, y = (near_dedup.band_values(s, 24, 6) for s in (a, b))
    df = spark.createDataFrame([(i, x[i].astype(np.int64).tolist(), y[i].astype(np.int64).tolist()) for i in range(50)], "i int, x array<bigint>, y array<bigint>")
    got = [r[0] for r in df.orderBy("i").select(near_dedup.agreement("x", "y", 6)).collect()]
    assert all(0 <= g - w <= 3 for g, w in zip(got, (a == b).sum(axis=1)))
    shared = [(a[i].reshape(6, 24) == b[i].reshape(6, 24)).all(axis=0) for i in range(50)]
    assert all((x[i] == y[i])[shared[i]].all() for i in range(50))
    assert sum(((x[i] == y[i]) != shared[i]).sum() for i in range(50)) <= 5  # by chance


def test_word_sequences_with_one_polynomial_hash_are_not_copies(spark):
    thue = [bin(i).count("1") % 2 for i in range(1024)]
    texts = [(1, " ".join("ab"[x] for x in thue)), (2, " ".join("ba"[x] for x in thue)), (3, " ".join("AB"[x] for x in thue))]
    signed = spark.createDataFrame(texts, "id long, text string").mapInArrow(near_dedup._sign(24, 6), near_dedup.SIGNED)
    q = {r.id: (r.q1, r.q2) for r in signed.collect()}
    assert q[1] != q[2] and q[1] == q[3]


def test_suffix_arrays():
    rnd = np.random.default_rng(1)
    for k in range(120):
        n = int(rnd.integers(1, 900))
        t = np.append(rnd.integers(1, 3 + k % 90, n), 0).astype(np.uint8)
        t = np.append(np.tile(t[: n // 4 + 1][t[: n // 4 + 1] > 0], 4), 0).astype(np.uint8) if k % 4 == 0 else t
        b = t.tobytes()
        assert induced.suffix_array(t, 256).tolist() == sorted(range(len(b)), key=lambda i: b[i:])


@pytest.mark.parametrize("crowd,shard", [(4000, 500_000), (2, 500_000), (4000, 300)])
def test_repeated_strings(spark, docs, texts, none, crowd, shard):
    twice = docs.unionByName(docs.where("doc_id in (3, 40)"))
    all_texts = texts + [texts[3], texts[40]]
    want = sorted(suffix_dedup.brute_force(all_texts), key=str)
    got = suffix_dedup.remove_repeats(twice, crowd=crowd, shard_bytes=shard)
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    left = {r.doc_id: r for r in got.collect()}
    assert left[texts[-1][0]].text == texts[-1][1] and left[next(d for d, t in texts if t is None)].text is None and set(docs.columns) < set(got.columns)
    if crowd > 2:
        assert suffix_dedup.remove_repeats(none).count() == 0


def test_packing(spark, docs, texts, none):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack(docs).collect()
    want = {}
    for d, t in texts:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            want[d, k // 2048] = (k, ids[k : k + 2048])
    assert {(r.doc_id, r.piece): (r.start, r.ids) for r in got} == want
    assert all(r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *r.ids)) for r in got)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        assert [o for o, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:i]) for i in range(len(places))] and sum(n for _, n in places) <= 2048
    assert packing.pack(none).count() == 0


def test_tokens_of_odd_texts():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    odd = ["<|endoftext|> a<|startoftext|>b <|startoftext|>", "don't.. (a). x'll, é\u0301. 1. ²! ½, \u00a0x\ty\r\nz", "a.\nB,\n\nC  d", "...", "ſ. İ. Σ, \u200b."]
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.Ids(packing.tokenizer_path()).of(pa.array([*odd, None, ""]))]
    assert got == [e.ids for e in whole.encode_batch([*odd, "", ""], add_special_tokens=False)]


def test_best_fit_closes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 5, 4, 3, 5)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 5), (3, 0)]


def test_ogg(spark, docs, texts, none):
    got = {r.doc_id: r for r in ogg.from_ogg(ogg.to_ogg(docs), keep=["doc_id"]).collect()}
    for d, t in texts:
        raw = (t or "").encode()
        padded = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        r = got[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    assert ogg.from_ogg(ogg.to_ogg(none), keep=["doc_id"]).count() == 0


@pytest.mark.parametrize("n", [1, 254, 255, 256, 4095, 4096, 65025, 150_000])
def test_ogg_pages(n):
    raw = bytes(i * 7 % 251 for i in range(n))
    file = ogg.encode(raw, n)
    assert ogg.samples(file)[:2] == (raw, n)
    for at in (3, 30, len(file) // 2, len(file) - 1):
        with pytest.raises(ValueError):
            ogg.samples(file[:at] + bytes([file[at] ^ 1]) + file[at + 1 :])
    with pytest.raises(ValueError):
        ogg.samples(file[:-1])
    stream = ogg.Stream(9)
    packets = [(b"h", 0), (b"x" * (255 * 300), 5), (b"", 6), (b"y" * 255, 7)]
    made = ogg.decode(b"".join(stream.pages(packets[:1])) + b"".join(stream.pages(packets[1:], last=True)))
    assert [p for p, _ in made[9]] == [p for p, _ in packets] and made[9][-1][1] == 7


def test_warc(spark, none):
    pages = [(1, "http://a.b/c", "same"), (2, None, "same"), (2, "http://a.b/c?d", "same"), (3, "http://x", None), (4, "http://x", ""), (5, "http://é", "WARC/1.1\r\n\r\nx\r\n\r\n"), (None, "u", "same")]
    df = spark.createDataFrame([(*p, "more") for p in pages], "page_id long, url string, html string, digest string")
    from wrenfield.llm.common import shared_dir

    path = f"{shared_dir(spark)}/warc-test"
    warc.write_archives(df, path)
    got = warc.assemble(warc.read_records(spark, path)).collect()
    assert len(got) == len(pages) and all(len(r.requests) == len(r.metadata) == 1 and not r.others for r in got)
    kinds = Counter((re.search(r"capture:(\d*):", r.answer.record_id)[1], r.answer.type) for r in got)
    assert kinds == Counter({("2", "response"): 1, ("2", "revisit"): 1, ("1", "revisit"): 1, ("", "revisit"): 1, ("4", "response"): 1, ("3", "revisit"): 1, ("5", "response"): 1})
    for r in got:
        if r.answer.type == "response":
            assert base64.b32encode(hashlib.sha1(bytes(r.answer.payload)).digest()).decode() == r.answer.payload_digest
    assert all(r.answer.payload_bytes == 4 for r in got if r.answer.payload_digest == base64.b32encode(hashlib.sha1(b"same").digest()).decode())
    empty = f"{shared_dir(spark)}/warc-empty"
    warc.write_archives(df.limit(0), empty)
    assert warc.assemble(warc.read_records(spark, empty)).count() == 0
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort"))


def test_warc_links_in_either_direction(spark, tmp_path):
    import gzip

    def record(kind, name, *to, block="x", more=()):
        head = [f"WARC-Type: {kind}", *([f"WARC-Record-ID: <{name}>"] if name else []), *(f"WARC-Concurrent-To: <{t}>" for t in to), *more, f"Content-Length: {len(block)}"]
        return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n" + block + "\r\n\r\n").encode()

    packed = [
        record("response", "a", "a-req1", "a-req2", block="h\r\n\r\nbody"), record("request", "a-req1"), record("request", "a-req2"), record("metadata", "a-m1", "a-req1"), record("metadata", "a-m2", "a"),
        record("revisit", "b", block="h\r\nContent-Length: 7"), record("request", "b-req", "b"), record("conversion", "b-conv", "b"),
        record("request", "lone", "missing"), record("metadata", "lone-m", "lone"), record("warcinfo", "info"),
        record("response", "bad", block="h\r\n\r\nx", more=["WARC-Payload-Digest: sha1:AAAA"]), record("request", None),
    ]
    (tmp_path / "1.txt.gz").write_bytes(b"".join(map(gzip.compress, packed)))
    (tmp_path / "2.txt").write_bytes(record("response", "c", block="h\r\n\r\n") + b"WARC/1.0\r\nContent-Length: 99\r\n\r\ncut")
    records = warc.read_records(spark, f"file://{tmp_path}")
    assert records.where("error is not null").count() == 3
    ids = lambda rows_: [r.record_id.strip("<>") for r in rows_]
    got = {r.capture.strip("<>"): (r.answer and r.answer.record_id.strip("<>"), ids(r.requests), ids(r.metadata), ids(r.others)) for r in warc.assemble(records).collect()}
    assert got == {"a": ("a", ["a-req1", "a-req2"], ["a-m1", "a-m2"], []), "b": ("b", ["b-req"], [], ["b-conv"]), "lone-m": (None, ["lone"], ["lone-m"], []), "info": (None, [], [], ["info"]), "c": ("c", [], [], [])}


def test_warc_against_a_loop(spark):
    rnd = random.Random(11)
    bodies = [None, "", "é😀", "WARC/1.1\r\n\r\n", "\r\n\r\n", *("".join(rnd.choice("ab é\n") for _ in range(rnd.randint(1, 9))) for _ in range(40)), "long " * 300_000]
    pages = [(i, rnd.choice([None, "", "http://h/ü?q", f"https://x.y/{i}\r\nX: 1"]), rnd.choice(bodies)) for i in range(400)] + [(1000 + i, "http://hot", "hot") for i in range(300)] + [(2000, "u", bodies[-1])]
    rnd.shuffle(pages)
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, type int").repartition(5)
    from wrenfield.llm.common import shared_dir

    path = f"{shared_dir(spark)}/warc-loop"
    warc.write_archives(df, path)
    last = {}
    for p, _, h in pages:
        last[h or ""] = max(p, last.get(h or "", p))
    want = set()
    for p, u, h in pages:
        raw = (h or "").encode()
        first = last[h or ""]
        want.add((p, " ".join((u or "").replace("\r", " ").replace("\n", " ").split(" ")).strip(), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if p == first else "revisit", None if p == first else first, raw if p == first else None))
    number = lambda x: x and int(re.search(r"capture:(\d+):", x)[1])
    got = {(number(r.answer.record_id), r.answer.target_uri, r.answer.payload_bytes, r.answer.payload_digest, r.answer.type, number(r.answer.refers_to), None if r.answer.payload is None else bytes(r.answer.payload)) for r in warc.assemble(warc.read_records(spark, path)).collect()}
    assert got == want


def test_warc_keeps_a_row_for_each_row_of_repeated_pages(spark):
    rnd = random.Random(12)
    ids, urls, bodies = [None, 1, 1, 2, 3, 4], [None, "", "http://a/b", "http://a/c"], [None, "", "x", "y", "long " * 900]
    pages = [(rnd.choice(ids), rnd.choice(urls), rnd.choice(bodies)) for _ in range(300)] + [(7, "http://hot", "hot")] * 2500 + [(9, "u", "x" * 3_000_000)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, n string").repartition(4)
    from wrenfield.llm.common import shared_dir

    number = lambda x: int(m) if (m := re.search(r"capture:(-?\d*):", x)[1]) else None
    for least in (0, 2, 10**9):
        path = f"{shared_dir(spark)}/warc-again-{least}"
        warc.write_archives(df, path, least)
        got = warc.assemble(warc.read_records(spark, path)).collect()
        assert all(len(r.requests) == len(r.metadata) == 1 and not r.others for r in got)
        assert Counter((number(r.answer.record_id), r.answer.target_uri, r.answer.payload_bytes) for r in got) == Counter((p, u or "", len((h or "").encode())) for p, u, h in pages)
        by = defaultdict(list)
        for r in got:
            by[r.answer.payload_digest].append(r.answer)
        for answers in by.values():
            full = [a for a in answers if a.type == "response"]
            if answers[0].payload_bytes < least:
                assert len(full) == len(answers)
            else:
                top = max((number(a.record_id) for a in answers if number(a.record_id) is not None), default=None)
                assert len(full) == 1 and number(full[0].record_id) == top and {a.refers_to for a in answers if a.type == "revisit"} <= {full[0].record_id}


def test_warc_records_in_parts():
    import gzip

    records = [b"WARC/1.1\r\nA: %d\r\nContent-Length: %d\r\n\r\n" % (i, i * 7) + b"\r\nWARC " * i for i in range(60)]
    whole = b"\r\n\r\n".join(records) + b"\r\n"
    want = [(str(i), b"\r\nWARC " * i) for i in range(60)]
    for size in (1, 7, 100, 10**6):
        assert [(h["a"][0], b) for h, b in warc.parse(whole[k : k + size] for k in range(0, len(whole), size))] == want
    for packed in (gzip.compress(whole), b"".join(map(gzip.compress, records)), whole):
        assert [(h["a"][0], b) for h, b in warc.parse(warc.unpacked(packed))] == want
    with pytest.raises(ValueError):
        list(warc.parse(warc.unpacked(gzip.compress(whole)[:-60])))


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><div class="cookie-notice"><p>We use cookies a lot, really</p></div>
<nav><ul><li><a href="/">Home</a></ul></nav><div class="col1"><div class="sidebar"><p>A long side text that would score well if it counted at all</p></div>
<div class="post{n}"><h1>A &amp; b</h1><p>One <b>bo</b>ld<p>Two&nbsp;three&#33; <a href="x">a link</a>.<div class="ad">buy now</div><form><p>mail</p></form><ul><li>i<li>j</ul><div id="comments"><p>Nice</p></div></div></div>
<script>var x = "<p>no</p>";</script><footer>f</footer></body></html>"""


def test_html(spark):
    want = "A & b One bold Two three! a link. i j"
    pages = [(i, f"http://h.org/{i}", PAGE.replace("{n}", str(i))) for i in range(4)]
    pages += [(9, None, PAGE), (10, "http://h.org/x", None), (11, "http://h.org/y", ""), (12, "http://h.org/z", "plain &lt; text"), (13, "http://z.org/", "<div><p>cut off <a href='x"), (0, "http://h.org/0", pages[0][2])]
    df = spark.createDataFrame([(*p, "e") for p in pages], "page_id long, url string, html string, path string")
    got = rows(html_text.extract(df), "page_id", "text")
    assert got == sorted([(i, want) for i in (0, 1, 2, 3, 9, 0)] + [(10, ""), (11, ""), (12, "plain < text"), (13, "cut off")], key=str)
    assert html.unescape("&am") == "&am"


def test_toxicity(spark, none):
    rnd = random.Random(2)
    bad = ["scum", "idiot", "moron"]
    rows_ = []
    for i in range(400):
        w = [rnd.choice(WORDS) for _ in range(40)]
        if toxic := i % 5 == 0:
            w[rnd.randrange(40)] = rnd.choice(bad)
            w[rnd.randrange(40)] = rnd.choice(bad)
        rows_.append((i, " ".join(w), int(toxic)))
    df = spark.createDataFrame([(i, t) for i, t, _ in rows_] + [(None, None), (-1, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows_] + [(None, 1), (7, None)], "doc_id long, toxic int")
    weights = toxicity.fit(df, labels, usable=~toxicity.held_out())
    got = {r.doc_id: r.score for r in toxicity.score(df, weights).collect()}
    held = [(i, y) for i, _, y in rows_ if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, y in held]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and len(weights[0]) < 2000
    same = toxicity.fit(df.repartition(7), labels, usable=~toxicity.held_out())
    assert np.array_equal(weights[0], same[0]) and np.allclose(weights[1], same[1])
    assert [r.score for r in toxicity.score(df.limit(1), toxicity.fit(df, labels.limit(0))).collect()] == [0.5]
    assert toxicity.score(none, weights).count() == 0


def test_ftrl_against_a_loop():
    rnd = random.Random(3)
    texts = [[*rnd.sample(range(30), 6), 32] for _ in range(300)]
    labels = [int(0 in t or rnd.random() < 0.1) for t in texts]
    z, n = {}, {}
    a, b, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((b + math.sqrt(n[i])) / a + l2)

    for _ in range(toxicity.EPOCHS):
        for t, y in zip(texts, labels):
            w = {i: weight(i) for i in t}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in t:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / a * w[i]
                n[i] = old + g * g
    want = {i: weight(i) for i in z if weight(i)}
    at, w = toxicity.train([np.array(t) for t in texts], np.array(labels), 5)
    assert dict(zip(at.tolist(), w.tolist())) == pytest.approx(want) and 0 in want and len(want) < 33


def test_toxicity_query_contract(spark):
    """Every document once; labels of held-out rows are not learned from; the sample is bounded."""
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = toxicity.op4_toxicity(spark, data)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows_ = got.collect()
    assert sorted(r.doc_id for r in rows_) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows_)
    labels = spark.read.parquet(f"{data}/labels.parquet")
    known = {r.doc_id: r.toxic for r in labels.collect()}
    turned = spark.createDataFrame([(d, 1 - t if zlib.crc32(str(d).encode()) % 3 == 1 else t) for d, t in known.items()], "doc_id long, toxic int")
    fits = [toxicity.fit(docs, x, usable=~toxicity.held_out(), sample=60) for x in (labels, turned)]
    assert np.array_equal(fits[0][0], fits[1][0]) and np.array_equal(fits[0][1], fits[1][1])


def test_html_of_random_pages(spark):
    """Pages built around a known article give back the article, whichever boilerplate stands around it."""
    rnd = random.Random(8)
    say = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    shells = [
        lambda k: f'<nav><a href="/">{say(3)}</a></nav>', lambda k: f'<header><h1>{say(2)}</h1></header>', lambda k: f'<div class="sidebar"><p>{say(30)}</p></div>', lambda k: f'<aside>{say(9)}</aside>',
        lambda k: f'<div id="cookie-banner">{say(8)}</div>', lambda k: f"<script>var a = '<p>{k}</p>';</script>", lambda k: f"<!-- {say(4)} -->", lambda k: f"<form><input name=q><label>{say(2)}</label></form>",
    ]
    pages, want = [], []
    for i in range(60):
        host, blocks, raw = i % 3, [], []
        for _ in range(rnd.randint(2, 6)):
            kind, said = rnd.choice(["p", "h2", "li", "open"]), say(rnd.randint(8, 25)) + rnd.choice(["", " & é <x"])
            blocks.append(said)
            inner = esc(said).replace(" ", rnd.choice([" ", "\n  ", "\t"]), 2)
            inner = inner if rnd.random() < 0.5 else re.sub(r"(\w+)$", r"<b>\1</b>", inner)
            raw.append({"p": f"<p>{inner}</p>", "h2": f"<h2>{inner}</h2>", "li": f"<ul><li>{inner}</li></ul>", "open": f"<p>{inner}"}[kind])
            if rnd.random() < 0.3:
                raw.append(f'<div class="ad">{say(5)}</div>')
        article = [f'<article class="post-{i}">', '<div class="entry">', "<main>"][host] + "".join(raw) + ["</article>", "</div>", "</main>"][host]
        around = [rnd.choice(shells)(i) for _ in range(5)]
        pages.append((i, f"http://host{host}.org/{i}", f"<html><head><title>{say(3)}</title></head><body>{''.join(around[:3])}{article}{''.join(around[3:])}<footer>{say(6)}</footer></body></html>"))
        want.append((i, " ".join(blocks)))
    pages.append((99, "http://host0.org/long", "<article>" + "<p>one two</p>" * 50_000 + "</article>"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = dict(rows(html_text.extract(df), "page_id", "text"))
    assert got.pop(99) == " ".join(["one two"] * 50_000)
    assert got == dict(want)
    assert html_text.extract(df.limit(0)).count() == 0
    # the ways beyond the broadcast: hot hosts apart from others, and none of them hot
    named = df.withColumn("host", F.coalesce(F.regexp_extract("url", "://([^/]*)", 1), F.lit("")))
    named = named.unionByName(named.where("page_id < 3").withColumn("host", F.lit("")))
    winners = html_text.host_paths(named)
    want = rows(html_text.with_paths(named, winners), "page_id", "host", "path")
    for share in (0.1, 1.0):
        plan = html_text.with_paths(named, winners, 1000, share)
        assert sorted(rows(plan, "page_id", "host", "path"), key=str) == sorted(want, key=str)


def test_repeats_of_very_many_equal_rows(spark):
    """The cost is in proportion to the rows, whether they have one doc_id, none, or ids of their own."""
    import time

    rnd = random.Random(4)
    say = " ".join(rnd.choice(WORDS) for _ in range(220))
    took = []
    for n in (1_000, 20_000):
        rows_ = spark.range(n).selectExpr("case id % 3 when 0 then null when 1 then 7 else id end as doc_id").withColumn("text", F.lit(say))
        rows_ = rows_.unionByName(spark.createDataFrame([(-1, say[:100] + "#" + say[101:]), (-2, "x" + say[300:520])], "doc_id long, text string"))
        began = time.time()
        got = suffix_dedup.remove_repeats(rows_, keep=["doc_id"]).groupBy("n_bytes", "n_removed", "n_spans").count().collect()
        took.append(time.time() - began)
        whole = len(say)
        assert {(r.n_bytes, r.n_removed): r["count"] for r in got} == {(whole, whole): n, (whole, whole - 101): 1, (221, 220): 1}
    assert took[1] < 4 * took[0] + 5


def test_registered_domains(spark):
    cases = {"shop.a.co.uk": ("a.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "example.com:8080": ("example.com", "com"), "a.b.example.org": ("example.org", "org"), "10.1.2.3": ("10.1.2.3", "10.1.2.3"), "10.1.2.3:80": ("10.1.2.3", "10.1.2.3"), "localhost": ("localhost", "localhost"), "": ("", "")}
    df = spark.createDataFrame([(k,) for k in cases], "host string")
    got = {r.host: (r.d, r.s) for r in df.select("host", url_reputation.domain_of(F.col("host")).alias("d"), url_reputation.suffix_of(F.col("host")).alias("s")).collect()}
    assert got == cases


def test_long_lists_of_rules(spark, monkeypatch):
    """Joined rules say what compiled ones say, over repeated rows, long urls and columns of the added names."""
    rnd = random.Random(6)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "ab.org", "com", "", "c.net:80"]
    pages = [(i, rnd.choice([None, "no url", *(f"https://{rnd.choice(hosts)}/{rnd.choice('abc')}/{rnd.choice('de')}{'z' * rnd.choice((0, 3, 50_000))}?q" for _ in range(9))])) for i in range(150)]
    df = spark.createDataFrame([(*p, "x") for p in pages + pages[:5]], "page_id long, url string, rules string")
    seen = spark.createDataFrame([(rnd.choice(hosts), rnd.randrange(2)) for _ in range(60)], "host string, bad long").where("host <> ''")
    rules = list(dict.fromkeys((rnd.choice(("block", "allow")), f"{d}/{p}") for d in ("a.com", "x.a.com", "com", "org", "b.org", "c.net:80") for p in ("", "a", "a/", "a/d", "b/ez", "c")))
    rules = list({r: (v, r) for v, r in rules}.values())
    columns = ["page_id", "host", "path", "rule", "verdict", "bad_bound"]
    want = rows(url_reputation.judge(df, seen, rules), *columns)
    monkeypatch.setattr(url_reputation, "RULES_AT_MOST", 3)
    assert rows(url_reputation.judge(df, seen, rules), *columns) == want and len({w[3] for w in want}) > 8


def test_benchmark_of_repeated_rows(spark, docs, texts):
    items = [(1, " ".join(texts[31][1].split(" ")[20:45]))] * 400 + [(2, " ".join(texts[33][1].split(" ")[5:30]))]
    got = decontaminate.scan(docs, spark.createDataFrame(items, "item_id long, text string"), keep=["doc_id"], block_bytes=400).select("doc_id", F.size("hit_words").alias("n"), "item_ids").collect()
    want = {w[0]: w for w in decontaminate.brute_force(texts, items)}
    assert {r.doc_id for r in got if r.n} == {d for d, w in want.items() if w[5]} and {x for r in got for x in r.item_ids} == {"1", "2"}


def test_media_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "text one", 5, "f"), (2, None, 6, "g"), (3, "long " * 1_000_000, 7, "h")], "doc_id long, text string, n_bytes long, feature string")
    got = ogg.from_ogg(ogg.to_ogg(df, keep=["doc_id", "n_bytes", "feature"]), keep=["doc_id", "n_bytes", "feature"])
    assert got.columns.count("n_bytes") == got.columns.count("feature") == 1
    assert {r.doc_id: r.n_bytes for r in got.collect()} == {1: 8, 2: 0, 3: 5_000_000}


def test_html_by_consensus_of_a_host(spark):
    """Articles in containers whose words hint at boilerplate come back, boilerplate without such words goes, and what repeats itself is no article."""
    rnd = random.Random(9)
    say = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    pages, want = [], []
    for h, name in enumerate(("search-result", "related-story", "comment-piece", "share_text", "x1")):
        promise, other = say(12), say(9)
        for i in range(12):
            said, more = say(60), say(40)
            extra = f'<div class="k7"><p>{promise}</p></div>' if i % 3 else ""
            inner = f'<p>{said}</p>{extra}<section class="q"><p>{more}</p></section><div class="comments"><p>{say(150)}</p></div><ul class="share"><li>{other}</li></ul>'
            pages.append((h * 100 + i, f"http://host{h}/{i}", f'<body><div class="top">{say(2)}</div><div class="{name}">{inner}</div><div class="cookie-notice"><p>{other * 5}</p></div></body>'))
            want.append((h * 100 + i, f"{said} {more}"))
        pages.append((h * 100 + 50, f"http://host{h}/none", f'<body><div class="cookie-notice"><p>{other * 5}</p></div></body>'))
        want.append((h * 100 + 50, ""))
    notice = say(80)
    for i in range(12):  # no articles: a notice that is everywhere isn't one
        pages.append((900 + i, f"http://empty/{i}", f'<body><div class="cookie-notice"><p>{notice}</p></div><p>{say(2)}</p></body>'))
    # copies of a page, and of one with one word changed, are articles still
    body = say(90)
    pages += [(1000 + i, f"http://copies/{i}", f'<body><div class="entry"><h1>Head</h1><div class="body"><p>{i % 2}</p></div><p>{body}</p></div></body>') for i in range(40)]
    want += [(1000 + i, f"Head {i % 2} {body}") for i in range(40)]
    got = dict(rows(html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("drops", F.lit("x"))), "page_id", "text"))
    assert {k: got[k] for k, _ in want} == dict(want)
    assert not any(notice in got[900 + i] for i in range(12))


def test_html_of_deep_and_wide_pages():
    import time

    took = []
    for n in (2_000, 8_000):
        began = time.time()
        page = html_text.Page("<div>" * n + "<table>" + "<tr><td>a b</td></tr>" * n + "</table>" + "</div>" * n)
        assert len(list(page.votes())) == n + 1 and page.text(None) == " ".join(["a b"] * n)
        took.append(time.time() - began)
    assert took[1] < 10 * took[0] + 1


def test_chat(spark):
    turns = [(1, 0, "user", "a <|end|> [\\INST] <\\\\|x|> [INST] <"), (1, 1, "user", ""), (1, 2, "assistant", "</s>\n<<SYS>>"), (1, 3, "assistant", "😀<|more|>"), (2, 0, None, None), (3, 1, "user", "x"), (3, 1, "user", "x"), (3, 0, "assi<|end|>", "<|"), (None, 0, "assistant", "n")]
    df = spark.createDataFrame([(*t, "e") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(df)).collect()}
    want = defaultdict(list)
    for c, _, role, text in sorted(turns, key=lambda t: (str(t[0]), t[1], t[2] or "")):
        want[c].append((role or "", text or ""))
    assert {c: [tuple(t) for t in r.turns] for c, r in got.items()} == want
    one = got[1].formatted
    masked = "".join(one[m.start : m.start + m.length] for m in got[1].loss_mask)
    assert masked == "<\\/s>\n<\\<SYS>>😀<\\|more|>" and one.count("<|turn|>") == 2
    assert chat_format.read_back(chat_format.format_chats(df.limit(0))).count() == 0


def test_url_reputation(spark):
    pages = [(i, f"https://bad.site.org/{i}") for i in range(20)] + [(100 + i, f"https://good.site.org/{i}") for i in range(20)]
    pages += [(200, "HTTP://WWW.Example.COM/en/7x?q#f"), (201, "https://a.com/en/"), (202, None), (203, "nothing"), (204, "x://b.de.net/de/#y"), (205, "https://new.site.org/q"), (0, "https://bad.site.org/0")]
    df = spark.createDataFrame([(*p, "e") for p in pages], "page_id long, url string, domain string")
    out = spark.createDataFrame([("bad.site.org", 1)] * 30 + [("good.site.org", 0)] * 30 + [("other.com", 0)] * 50, "host string, bad long")
    got = {r.page_id: r for r in url_reputation.judge(df, out).collect()}
    assert got[0].verdict == "block" and got[100].verdict == "allow" and got[205].verdict == "block"  # by its domain
    assert (got[200].host, got[200].path, got[200].rule, got[200].verdict) == ("www.example.com", "/en/7x", "example.com/en/7", "allow")
    assert (got[201].rule, got[201].verdict, got[204].rule) == ("com/en/", "block", "net/de/")
    assert (got[202].host, got[202].path, got[203].host, got[203].rule) == ("", "", "", None)
    assert {r.verdict for r in url_reputation.judge(df, out.limit(0)).where("rule is null").collect()} == {"allow"}
    assert url_reputation.judge(df.limit(0), out).count() == 0
