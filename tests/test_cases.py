"""Literal cases: inputs and what must come out."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from wrenfield.functions import columns as C
from wrenfield.operators import linkage, review, scoring
from wrenfield.operators.rules import Rule, first_key, load
from wrenfield.settings import DEFAULT as S


def values(spark, rows, make, *names):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} string" for n in names))
    return [r[0] for r in df.orderBy("i").select(make(*(F.col(n) for n in names))).collect()]


def test_names(spark):
    got = values(spark, ["ﬁne  Art", "it’s", "a—b–c", "a b", "a​b", None, "", " É  x "], C.normalise_name, "a")
    assert got == ["fine art", "it's", "a-b-c", "a b", "ab", "", "", "é x"]


def test_urls(spark):
    got = values(spark, ["https://luma.com/a?x=1", "https://lu.ma/b", "https://x.org/a?b=1", "http://lu.ma/a?b", None, ""], C.canonical_url, "a")
    assert got == ["https://lu.ma/a", "https://lu.ma/b", "https://x.org/a?b=1", "http://lu.ma/a?b", None, ""]
    assert values(spark, ["https://lu.ma/a/b", "https://lu.ma/", "https://luma.com/z?q", "https://www.meetup.com/g/events/123/", None], C.url_key, "a") == [None, None, "z", "123", None]


def test_local_times(spark):
    got = values(spark, ["2026-07-04T19:30-04:00", "2026-07-04T19:00:00Z", "2026-01-04T19:00:00Z", "2026-07-04T19:00", "soon", None], lambda a: F.concat_ws(" ", *C.local_datetime(a, "Europe/London")), "a")
    assert got == ["2026-07-05 00:30", "2026-07-04 20:00", "2026-01-04 19:00", "2026-07-04 19:00", " ", " "]


def test_costs(spark):
    assert values(spark, ["£1,500", "£5-£10", "Free entry", "TBC", "", None, "12.50"], C.parse_cost, "a") == [1500.0, 5.0, 0.0, None, None, None, 12.5]


def test_utf16(spark):
    texts = ["x" * 2500, "😀" * 1500, "y" * 2000, "a" + "😀" * 1500]
    cut = values(spark, texts, lambda a: C.truncate_utf16(a, 2000), "a")
    assert cut[0] == "x" * 1999 + "…" and cut[2] == texts[2] and cut[1] == "😀" * 999 + "…" and cut[3] == "a" + "😀" * 999 + "…"
    assert all(len(c.encode("utf-16-le")) <= 4000 for c in cut)


def test_venues_and_stems(spark):
    got = values(spark, ["The Hall, Springfield, UK", "The Hall Springfield", "Annex, AB1 2CD"], lambda a: C.normalise_venue(a, S.city, S.geocode_suffix), "a")
    assert got == ["the hall", "the hall", "annex,"]
    assert values(spark, ["Jazz Night #41", "Jazz Night (June)", "Jazz Night 12/05"], C.title_stem, "a") == ["jazz night"] * 3


def test_whole_words(spark):
    pattern = C.any_of(["draw", "spa", "45+"])
    assert values(spark, ["withdraw now", "to draw", "space", "a spa", "45+ only"], lambda a: a.rlike(pattern), "a") == [False, True, False, True, False]


def test_exemption_spares_its_own_rule_only(spark):
    rules = load('[{"key": "classical", "words": ["opera"], "exempt": ["crossover"]}, {"key": "late", "words": ["midnight"]}]')
    got = values(spark, ["opera", "opera crossover", "opera crossover at midnight"], lambda a: first_key(rules, {"blob": a}), "a")
    assert got == ["classical", None, "late"]
    assert rules[0] == Rule("classical", ("opera",), exempt=("crossover",))


@pytest.mark.parametrize("title,text,want", [("Sunday walk", "", "Outdoor"), ("Talk", "walk from the station", "Talk"), ("6 or 8 miles", "", "Outdoor"), ("Evening", "painting and course", "Creative social"), ("Meetup #3", "", "Talk"), ("Hello", "photo gallery", "Social meetup"), ("Gallery", "panel", "Exhibition")])
def test_formats(spark, title, text, want):
    assert values(spark, [(title, text)], scoring.classify_format, "a", "b") == [want]


def test_tiers(spark):
    got = spark.createDataFrame([(x,) for x in (9, 8, 7, 4, 3, 0, -2)], "s int").select(scoring.tier(F.col("s"))).collect()
    assert [r[0] for r in got] == ["Top Picks", "Top Picks", "Recommended", "Recommended", "Borderline", "Borderline", "Borderline"]


def test_greedy_against_a_loop(spark):
    rows = [(i, f"https://lu.ma/{(i * 7) % 11}" if i % 4 else "", f"n{(i * 5) % 13}", "2024-01-01") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, url string, name string, date string")
    urls, names, want = set(), set(), []
    for i, u, n, d in rows:
        if (u and u in urls) or (n, d) in names:
            continue
        want.append(i)
        urls.add(u)
        names.add((n, d))
    assert sorted(r.id for r in linkage.greedy(linkage.keys(df)).collect()) == want


def test_chain_keeps_the_third(spark):
    df = spark.createDataFrame([(1, "u1", "a", "d"), (2, "u1", "b", "d"), (3, "u2", "b", "d")], "id long, url string, name string, date string")
    assert sorted(r.id for r in linkage.greedy(linkage.keys(df)).collect()) == [1, 3]


def test_fuzzy_names_against_all_pairs(spark):
    names = ["jazz night", "jazz", "", "night jazz x", "jazz night live", "other thing", "é clair", "é", "o", None, "thing other", "a b c d e", "a b c d f"]
    rows = [(i, n, "2024-02-01", None, "pending_llm") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "id long, name string, date string, end_date string, pipeline_state string")
    got = {(r.id, r.other_id): r.kind for r in linkage.fuzzy_pairs(df, "2024-01-16").collect()}
    import re
    import unicodedata

    norm = lambda s: re.sub(r"\s+", " ", unicodedata.normalize("NFKD", s).lower().strip())
    want = {}
    for (i, a), (j, b) in itertools.product(enumerate(names), repeat=2):
        if j < i and a and b:
            x, y = norm(a), norm(b)
            w, v = set(re.findall(r"\w+", x)), set(re.findall(r"\w+", y))
            if x.startswith(y) or y.startswith(x):
                want[i, j] = "prefix"
            elif w and v and len(w & v) / min(len(w), len(v)) >= 0.7:
                want[i, j] = "word_overlap"
    assert got == want


@pytest.mark.parametrize("borderline,others,demoted", [(5, 6, 3), (3, 8, 0), (2, 4, 0)])
def test_borderline_cap(spark, borderline, others, demoted):
    rows = [(i, "Borderline" if i < borderline else "Recommended", i % 2) for i in range(borderline + others)]
    got = review.borderline_cap(spark.createDataFrame(rows, "id long, llm_tier string, score int")).where("demoted").select("id").collect()
    assert len(got) == demoted
    if demoted == 3:
        assert {r.id for r in got} == {0, 2, 4}


def test_multiday(spark):
    make = lambda i, d, name="Fair", venue=None, end=None: (i, name, d, end, venue, "r", "Newsletter", "pending_llm", "x" * i)
    rows = [make(1, "2024-02-01"), make(2, "2024-02-03", venue="Hall"), make(3, "2024-02-04", end="2024-02-09"), make(4, "2024-02-01", "Gap"), make(5, "2024-02-04", "Gap"), make(6, "2024-02-01", "Two", "A"), make(7, "2024-02-02", "Two", "B")]
    df = spark.createDataFrame(rows, "id long, name string, date string, end_date string, venue_name string, run_date string, source string, pipeline_state string, description string")
    got = {r.id: (r.kept_id, r.end_date, r.description, r.role) for r in linkage.merge_multiday(df, "2024-01-16").collect()}
    assert got == {i: (1, "2024-02-09", "xxx", "kept" if i == 1 else "duplicate") for i in (1, 2, 3)}


def test_calendar_match_against_a_loop(spark):
    rng = random.Random(5)
    pick = lambda n, of: " ".join(rng.choice(of) for _ in range(rng.randint(0, n)))
    words, venues = "jazz rust ai x night lab y choir quiz salsa poetry chess".split(), [None, "", "Annex", "Hall A", "Hall A Back", "Loft"]
    days = [None, *(f"2024-01-{d:02}" for d in range(1, 16))]
    cal = [(i, pick(4, words), rng.choice(venues), rng.choice(days)) for i in range(120)]
    cand = [(i, pick(5, words), rng.choice(venues), rng.choice(days)) for i in range(150)]

    def best(title, place, date):
        found = []
        for i, name, venue, day in cand:
            if day is None or day != date:
                continue
            a, b = ({w for w in s.split() if len(w) > 1} for s in (title, name))
            share = len(a & b) / min(len(a), len(b)) if a and b else 0.0
            v, w = ((s or "").lower() for s in (place, venue))
            met = bool(v and w and (v in w or w in v))
            rank = 2 if title == name or met and share >= 0.6 else 1 if met or share >= 0.6 else 0
            if rank:
                found.append((-rank, -(1.0 if title == name else share if met or share >= 0.4 else 0.0), i))
        return min(found, default=None)

    want = {i: (m[2], "high" if m[0] == -2 else "medium", -m[1]) for i, *row in cal if (m := best(*row))}
    x = spark.createDataFrame(cal, "calendar_id long, title string, location string, date string")
    y = spark.createDataFrame(cand, "id long, name string, venue_name string, date string")
    got = {r.calendar_id: (r.id, r.confidence, r.overlap) for r in linkage.calendar_match(x, y).collect()}
    assert {k: (got.get(k), want.get(k)) for k in {*got, *want} if got.get(k) != want.get(k)} == {}
    assert len({m[1:] for m in want.values()}) > 4
    assert linkage.calendar_match(x.limit(0), y).count() == linkage.calendar_match(x, y.limit(0)).count() == 0


def test_jargon_goes_word_by_word(spark):
    cases = {
        "Fetch failed at run/step.py line 40; HTTP 503; exit code 3 ;": "Fetch failed at",
        "MAX_RETRY_COUNT was 3, Line 7 ; see notes.md ;done": "was 3,; see; done",
        "line up at line x, HTTP 20 and code 5": "line up at line x, HTTP 20 and code 5",
        "Exit Code 9 LINE 4 a_b A_B": "a_b A_B",
        "": "",
        None: None,
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "said string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", C.strip_jargon(F.col("said"))).collect())


def _calendar_loop(cal, cand):
    """The best candidates by all pairs: {calendar_id: (id, confidence, overlap)}."""
    want = {}
    for c, title, place, date in cal:
        found = []
        for i, name, venue, day in cand:
            if day is None or day != date:
                continue
            a, b = ({w for w in s.split() if len(w) > 1} for s in (title, name))
            share = len(a & b) / min(len(a), len(b)) if a and b else 0.0
            v, w = ((s or "").lower() for s in (place, venue))
            met = bool(v and w and (v in w or w in v))
            rank = 2 if title == name or met and share >= 0.6 else 1 if met or share >= 0.6 else 0
            if rank:
                found.append((-rank, -(1.0 if title == name else share if met or share >= 0.4 else 0.0), i))
        if found:
            rank, share, i = min(found)
            want[c] = (i, "high" if rank == -2 else "medium", -share)
    return want


@pytest.mark.parametrize("longest", [(4, 9), (9, 4), (9, 9), (7, 7), (6, 6), (2, 1)])
def test_calendar_match_of_long_and_short_titles(spark, longest):
    rng = random.Random(sum(longest))
    words, venues = "jazz rust ai x night lab y choir quiz salsa poetry chess live open mic".split(), [None, "", "Annex", "Hall A", "Hall A Back", "Loft"]
    pick = lambda n: " ".join(rng.choice(words) for _ in range(rng.randint(0, n)))
    days = [None, *(f"2024-01-{d:02}" for d in range(1, 13))]
    cal = [(i, pick(longest[0]), rng.choice(venues), rng.choice(days)) for i in range(150)]
    cand = [(i, pick(longest[1]), rng.choice(venues), rng.choice(days)) for i in range(150)]
    x = spark.createDataFrame(cal, "calendar_id long, title string, location string, date string")
    y = spark.createDataFrame(cand, "id long, name string, venue_name string, date string")
    got = {r.calendar_id: (r.id, r.confidence, r.overlap) for r in linkage.calendar_match(x, y).collect()}
    want = _calendar_loop(cal, cand)
    assert {k: (got.get(k), want.get(k)) for k in {*got, *want} if got.get(k) != want.get(k)} == {}


def test_calendar_match_shuffles_little(spark):
    """One date: names of which each shares two of three words with each title."""
    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()

    cal = spark.range(1000).select(F.col("id").alias("calendar_id"), F.format_string("Night click u%d", "id").alias("title"), F.lit("Hall").alias("location"), F.lit("2024-01-16").alias("date"))
    cand = spark.range(20000).select("id", F.format_string("click night u%d part", F.col("id") + 900).alias("name"), F.lit("Annex").alias("venue_name"), F.lit("2024-01-16").alias("date"))
    before = written()
    got = {r.calendar_id: (r.id, r.confidence, round(r.overlap, 6)) for r in linkage.calendar_match(cal, cand).collect()}
    assert got == {i: (i - 900, "medium", 1.0) if i >= 900 else (0, "medium", 0.666667) for i in range(1000)}
    assert written() - before < 2e6


def test_fuzzy_pairs_move_names_not_pairs(spark):
    """Names that are all alike, one of them so often that its ids are in several blocks: pairs leave without a shuffle of their own."""
    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()

    name = F.when(F.col("id") % 3 == 0, "click night 0 part 2").otherwise(F.format_string("click night %d part 2", "id"))
    state = F.when(F.col("id") % 5 == 0, "pending_llm").otherwise("written")
    rows = spark.range(3000).select("id", name.alias("name"), F.lit("2024-02-01").alias("date"), F.lit(None).cast("string").alias("end_date"), state.alias("pipeline_state"))
    before = written()
    got = linkage.fuzzy_pairs(rows, "2024-01-16")
    count = got.groupBy().agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "prefix").alias("p"), F.sum("other_id").alias("s")).first()
    moved = written() - before
    pairs = [(i, j) for i in range(0, 3000, 5) for j in range(i)]
    same = lambda i, j: i % 3 == 0 and j % 3 == 0
    assert (count.n, count.p, count.s) == (len(pairs), sum(same(i, j) for i, j in pairs), sum(j for _, j in pairs))
    assert got.distinct().count() == count.n
    assert moved < 1.5e6


@pytest.mark.parametrize("longest,vocabulary", [(4, 6), (8, 10), (22, 24)])
def test_fuzzy_pairs_of_random_names(spark, longest, vocabulary, monkeypatch):
    import re

    monkeypatch.setattr(linkage, "BLOCK", 2)
    rng = random.Random(longest)
    words = [f"w{i}" for i in range(vocabulary)] + ["-", "w1-w2"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(0, longest))) for _ in range(12)]
    names = [" ".join(w for w in rng.choice(base).split() if rng.random() < 0.9)[: rng.choice((99, 99, 99, 7))].strip() for _ in range(160)]
    rows = [(i, n, f"2024-02-0{rng.randint(1, 2)}", None, rng.choice(("pending_llm", "written", "vetoed"))) for i, n in enumerate(names)]
    want = {}
    for (i, a, d, _, s), (j, b, e, _, o) in itertools.product(rows, repeat=2):
        if j < i and a and b and d == e and s == "pending_llm" and o != "vetoed":
            w, v = set(re.findall(r"\w+", a)), set(re.findall(r"\w+", b))
            if a.startswith(b) or b.startswith(a):
                want[i, j] = "prefix"
            elif w and v and len(w & v) / min(len(w), len(v)) >= 0.7:
                want[i, j] = "word_overlap"
    got = linkage.fuzzy_pairs(spark.createDataFrame(rows, "id long, name string, date string, end_date string, pipeline_state string"), "2024-01-16").collect()
    assert len(got) == len(want) and {(r.id, r.other_id): r.kind for r in got} == want and set(want.values()) == {"prefix", "word_overlap"}
