"""Rule packs of any size as tables, met by words instead of one pattern per rule.

A phrase can only occur in a text that has all its words, so each phrase is filed under its rarest word, and a text meets only the phrases filed under
its own words; these are then matched as the compiled form (``rules.py``) matches them. The cost of a text follows its words and the phrases met, not the number of
rules, and the plan is the same for a pack of any size. A pack is configuration, but nothing here gathers it: it may be as large as a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import staged
from .rules import Rule

PHRASES = "ordinal int, rule_key string, scope string, phrase string, exempt array<string>"
_WORD = r"(?U)\w+"


def _folded(c: Column) -> Column:
    """Letters that match each other regardless of case become one."""
    return F.lower(F.upper(c))


def words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(_folded(c), F.lit(_WORD), F.lit(0)))


def _any_of(phrases: Column) -> Column:
    """A pattern of any of the phrases, as whole words; null for none. The phrases are quoted."""
    quoted = F.transform(phrases, lambda p: F.concat(F.lit("\\Q"), F.replace(F.lower(F.trim(p)), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    return F.when(F.size(phrases) > 0, F.concat(F.lit(r"(?iU)\b(?:"), F.array_join(quoted, "|"), F.lit(r")\b")))


def from_rules(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The phrases of a pack; rules with a pattern of their own have none and stay with the compiled form."""
    rows = [(i, r.key, r.scope, w, list(r.exempt)) for i, r in enumerate(rules) if not r.pattern for w in r.words]
    return spark.createDataFrame(rows, PHRASES)


def from_json(spark: SparkSession, path: str) -> DataFrame:
    """The phrases of a pack in a JSON file, a list of objects with the fields of ``Rule``, read by Spark."""
    kind = "array<struct<key:string, words:array<string>, scope:string, exempt:array<string>, pattern:string>>"
    rules = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", kind)).alias("ordinal", "r")).where("r.pattern is null")
    made = rules.select("ordinal", F.col("r.key").alias("rule_key"), F.coalesce("r.scope", F.lit("blob")).alias("scope"), F.explode("r.words").alias("phrase"), F.coalesce("r.exempt", F.array().cast("array<string>")).alias("exempt"))
    return made.selectExpr("cast(ordinal as int) as ordinal", "rule_key", "scope", "phrase", "exempt")


def index(phrases: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """``phrases`` with the ``word`` that each is filed under: the one with the fewest texts by ``counts`` (word, n), then the longest. Phrases of signs alone
    are filed under no word, which every text has."""
    one = phrases.withColumn("phrase", F.lower(F.trim("phrase"))).dropDuplicates(["ordinal", "scope", "phrase"])
    one = one.withColumn("word", F.explode(F.when(F.size(words(F.col("phrase"))) > 0, words(F.col("phrase"))).otherwise(F.array(F.lit("")))))
    n = F.lit(0)
    if counts is not None:
        one, n = one.join(counts, "word", "left"), F.coalesce("n", F.lit(0))
    rare = F.min_by("word", F.struct(n, -F.length("word"), F.col("word"))).alias("word")
    return one.groupBy("ordinal", "rule_key", "scope", "phrase", "exempt").agg(rare).withColumns({"pattern": _any_of(F.array("phrase")), "but": _any_of(F.col("exempt"))})


def word_counts(rows: DataFrame, scopes: dict[str, Column], phrases: DataFrame) -> DataFrame:
    """(word, n): in how many texts each word of the pack occurs."""
    said = rows.select(F.explode(F.array_distinct(F.flatten(F.array(*(words(c) for c in scopes.values()))))).alias("word"))
    used = phrases.select(F.explode(words(F.col("phrase"))).alias("word")).distinct()
    return said.join(used, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))


def _met(texts: DataFrame, scope: str, indexed: DataFrame, row_id: str) -> DataFrame:
    """(row_id, ordinal, rule_key, scope, pattern, but) of the rules of a scope whose words a row has; without a pattern where it fires for sure.

    Words meet phrases with the row's id alone. A phrase of one word can only match a whole word of the text, so it is decided here unless it has exemptions: it fires
    where the word stands as the phrase has it, but for the case of ASCII letters; any other spelling is matched by itself.
    """
    spelt = F.array_distinct(F.regexp_extract_all(F.coalesce(f"text_{scope}", F.lit("")), F.lit(_WORD), F.lit(0)))
    w = F.col("spelt")
    plain = (F.octet_length(w) == F.length(w)) | (w == _folded(w))
    said = texts.select(row_id, F.explode(F.array_append(spelt, F.lit(""))).alias("spelt")).select(row_id, _folded(w).alias("word"), F.when(~plain, w).alias("other"))
    one = (F.size(words(F.col("phrase"))) == 1) & F.col("phrase").rlike(r"(?U)^\w+$") & F.col("but").isNull()
    found = said.join(indexed.where(F.col("scope") == scope).withColumn("one", one).select("word", "ordinal", "rule_key", "phrase", "pattern", "but", "one"), "word")
    sure = F.col("one") & F.when(F.col("other").isNull() & (F.col("phrase") == F.col("word")), True).otherwise(F.rlike(F.coalesce("other", "word"), F.col("pattern")))
    return found.where(sure | ~F.col("one")).select(row_id, "ordinal", "rule_key", F.lit(scope).alias("scope"), F.when(~F.col("one"), F.col("pattern")).alias("pattern"), "but")


def first_keys(rows: DataFrame, scopes: dict[str, Column], indexed: DataFrame, row_id: str = "id") -> DataFrame:
    """(row_id, ordinal, rule_key) of the first rule that fires in each row; rows without one are left out. ``scopes``: texts by name, with ``blob`` for exemptions;
    rows of one id count as one. Texts are moved only to rules that come before the first sure one of their row."""
    texts = rows.select(row_id, *(c.alias(f"text_{k}") for k, c in scopes.items()))
    met = reduce(DataFrame.unionByName, (_met(texts, scope, indexed, row_id) for scope in scopes))
    rule, sure = F.struct("ordinal", "rule_key"), F.col("pattern").isNull()
    best = F.min(F.when(sure, rule)).over(Window.partitionBy(row_id))
    left = staged(met.withColumn("best", best).where(F.when(sure, rule == F.col("best")).otherwise(F.col("best").isNull() | (rule < F.col("best")))).drop("best"))
    first, doubt = left.where(sure).select(row_id, "ordinal", "rule_key"), staged(left.where(~sure))
    for scope in scopes:  # few doubts are sent to the texts instead
        judged = doubt.where(F.col("scope") == scope).join(texts.select(F.col(row_id).alias("of"), F.col(f"text_{scope}").alias("text"), "text_blob"), F.col(row_id).eqNullSafe(F.col("of")))
        first = first.unionByName(judged.where("text rlike pattern and not coalesce(text_blob rlike but, false)").select(row_id, "ordinal", "rule_key"))
    first = first.groupBy(row_id).agg(F.min(F.struct("ordinal", "rule_key")).alias("r"))
    return first.select(row_id, "r.ordinal", "r.rule_key")
