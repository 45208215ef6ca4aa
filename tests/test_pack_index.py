"""Packs as tables against the compiled form, and packs of thousands of rules against a loop."""

import json
import random
import re

from pyspark.sql import functions as F

from wrenfield.functions import columns as C
from wrenfield.operators import pack_index, packs, scoring
from wrenfield.operators.rules import Rule, first_key
from wrenfield.staging import new_folder


def texts(spark, n=400, vocabulary=900):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(vocabulary)] + ["été", "ÉTÉ", "naïve", "a_b", "c-d", "straße", "x's", "ſee", "K1"]
    rows = []
    for i in range(n):
        say = lambda k: "".join(rnd.choice(words) + rnd.choice([" ", " ", "-", ", ", "  "]) for _ in range(k))
        rows.append((i, rnd.choice([None, "", say(3)]), rnd.choice([None, say(rnd.randint(0, 40))]), rnd.choice([None, say(1)])))
    return spark.createDataFrame(rows, "id long, name string, description string, organiser string")


def pack(n, vocabulary=900):
    rnd = random.Random(4)
    out = []
    for i in range(n):
        phrases = [" ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(rnd.choice((1, 2, 2, 3)))) for _ in range(rnd.randint(1, 3))]
        phrases += rnd.choice([[], ["été"], ["C-D"], ["x's w1"], ["a_b"], ["see"], ["k1"], ["-"], ["w1-w2"]]) if i % 7 == 0 else []
        out.append(Rule(f"k{i}", tuple(phrases), rnd.choice(("blob", "title", "name")), (f"w{rnd.randrange(vocabulary)}",) if i % 5 == 0 else ()))
    return out


def test_same_first_keys_as_the_compiled_form(spark):
    rows, rules = texts(spark), pack(150)
    scopes = scoring.scopes(F.col("name"), F.col("description"), F.col("organiser"))
    want = {r.id: r.k for r in rows.select("id", first_key(rules, scopes).alias("k")).collect() if r.k}
    phrases = pack_index.from_rules(spark, rules)
    for counts in (None, pack_index.word_counts(rows, scopes, phrases)):
        got = {r.id: r.rule_key for r in pack_index.first_keys(rows, scopes, pack_index.index(phrases, counts)).collect()}
        assert got == want and len(want) > 100


def test_a_pack_of_thousands_from_a_file(spark):
    rows, rules = texts(spark, 120, 5000), pack(5000, 5000)
    path = new_folder(spark, "pack")
    spark.createDataFrame([(json.dumps([{"key": r.key, "words": r.words, "scope": r.scope, "exempt": r.exempt} for r in rules]),)], "value string").coalesce(1).write.text(path)
    phrases = pack_index.from_json(spark, path)
    assert phrases.select("ordinal").distinct().count() == 5000
    scopes = scoring.scopes(F.col("name"), F.col("description"), F.col("organiser"))
    compiled = [(r.key, r.scope, re.compile("|".join(rf"\b{re.escape(w.lower())}\b" for w in r.words)), [re.compile(rf"\b{re.escape(w)}\b") for w in r.exempt]) for r in rules]
    want = {}
    for r in rows.select("id", *(c.alias(k) for k, c in scopes.items())).collect():
        # the long s and the Kelvin sign match their letters regardless of case
        said = {k: r[k].replace("ſ", "s").replace("K", "k") for k in scopes}
        key = next((k for k, s, p, but in compiled if p.search(said[s]) and not any(b.search(said["blob"]) for b in but)), None)
        if key:
            want[r.id] = key
    got = pack_index.first_keys(rows, scopes, pack_index.index(phrases, pack_index.word_counts(rows, scopes, phrases)))
    assert {r.id: r.rule_key for r in got.collect()} == want and len(want) > 20


def test_the_plan_is_that_of_a_small_pack(spark):
    rows = texts(spark, 10)
    scopes = scoring.scopes(F.col("name"), F.col("description"), F.col("organiser"))
    size = lambda n: pack_index.first_keys(rows, scopes, pack_index.index(pack_index.from_rules(spark, pack(n))))._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert size(5) == size(2000)


def test_demonstration_packs(spark):
    rows = texts(spark, 60).withColumn("name", F.concat_ws(" ", "name", F.lit("art walk at the gallery")))
    text = {"blob": C.text_blob(F.col("name"), F.col("description")), "name": F.lower(F.coalesce("name", F.lit("")))}
    plain = [r for r in packs.FORMATS if not r.pattern]
    want = {r.id: r.k for r in rows.select("id", first_key(plain, text).alias("k")).collect() if r.k}
    assert {r.id: r.rule_key for r in pack_index.first_keys(rows, text, pack_index.index(pack_index.from_rules(spark, plain))).collect()} == want and want


def test_words_are_moved_without_their_text(spark):
    """A text of many words: what is shuffled follows its length, not the product of its words and its length."""
    said = " ".join(f"word{i}" for i in range(3000))
    rows = spark.createDataFrame([(i, said) for i in range(20)], "id long, description string")
    phrases = spark.createDataFrame([(i, f"k{i}", "blob", f"word{i}", []) for i in range(2999, 0, -1)], pack_index.PHRASES)
    path = new_folder(spark, "keys")

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()

    before = written()
    pack_index.first_keys(rows, {"blob": F.lower("description")}, pack_index.index(phrases)).write.parquet(path)
    assert {(r.id, r.rule_key) for r in spark.read.parquet(path).collect()} == {(i, "k1") for i in range(20)}
    assert written() - before < 5e6


def test_spellings_of_one_word(spark):
    """Words as the phrase has them, in other case, and in letters that only some rules of case make equal."""
    said = ["straße", "STRASSE", "strasse", "Straße", "ÉTÉ", "été", "éte", "Kelvin", "see", "ﬁt", "FIT", "x-fit", "fits", "Ix", "ix", "ΟΔΟΣ", "οδος", "e\u0301te\u0301", None, "straße strasse"]
    rules = [Rule("a", ("straße",)), Rule("b", ("strasse",)), Rule("c", ("Été",)), Rule("d", ("kelvin", "see")), Rule("e", ("fit",), "blob", ("x",)), Rule("f", ("fits", "ﬁt")), Rule("g", ("οδος",)), Rule("h", ("ix",))]
    rows = spark.createDataFrame(list(enumerate(said)), "id long, t string")
    scopes = {"blob": F.lower(F.coalesce("t", F.lit("")))}
    want = {r.id: r.k for r in rows.select("id", first_key(rules, scopes).alias("k")).collect() if r.k}
    got = {r.id: r.rule_key for r in pack_index.first_keys(rows, scopes, pack_index.index(pack_index.from_rules(spark, rules))).collect()}
    raw = {r.id: r.rule_key for r in pack_index.first_keys(rows, {"blob": F.coalesce("t", F.lit(""))}, pack_index.index(pack_index.from_rules(spark, rules))).collect()}
    assert got == want and {want[i] for i in (0, 2, 5, 7, 10)} == set("abcde")
    assert raw == {r.id: r.k for r in rows.select("id", first_key(rules, {"blob": F.coalesce("t", F.lit(""))}).alias("k")).collect() if r.k}
