"""Rules that are data, compiled into column expressions.

A pack is an ordered list of rules; of several that fire, the first counts. Each rule's words become one pattern,
so that a rule costs one match per row however many words it has. Packs are read from JSON or given as lists.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_of


@dataclass(frozen=True)
class Rule:
    key: str
    words: tuple[str, ...] = ()
    scope: str = "blob"
    exempt: tuple[str, ...] = ()
    pattern: str | None = None

    def regex(self) -> str:
        return self.pattern or any_of(list(self.words))


def load(text: str) -> list[Rule]:
    """A pack from JSON: a list of objects with the fields of ``Rule``."""
    return [Rule(**{k: tuple(v) if isinstance(v, list) else v for k, v in r.items()}) for r in json.loads(text)]


def once(values: dict[str, Column], use) -> Column:
    """``use`` of the values, each computed once for a row however often it is used."""
    return F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), lambda x: use({k: x[k] for k in values}))[0]


def folded(scopes: dict[str, Column]) -> dict[str, Column]:
    """Lower-case scopes, and each again with the two other letters that patterns take for plain ones, for ``says``."""
    return scopes | {f"{k}_plain": F.translate(c, "ſı", "si") for k, c in scopes.items()}


def says(scopes: dict[str, Column], scope: str, words: Iterable[str]) -> Column:
    """Whether a scope has one of the words. A pattern is only tried where the letters of a word occur at all, which is much quicker to see."""
    words = [w.strip().lower() for w in words]
    hit = scopes[scope].rlike(any_of(words))
    if f"{scope}_plain" not in scopes or not all(w.isascii() for w in words):
        return hit
    there = [F.contains(scopes[f"{scope}_plain"], F.lit(w)) for w in words]
    return reduce(lambda a, b: a | b, there) & hit


def fires(rule: Rule, scopes: dict[str, Column]) -> Column:
    hit = scopes[rule.scope].rlike(rule.pattern) if rule.pattern else says(scopes, rule.scope, rule.words)
    return hit & ~says(scopes, "blob", rule.exempt) if rule.exempt else hit


def first_key(rules: Iterable[Rule], scopes: dict[str, Column], more: Iterable[tuple[str, Column]] = (), otherwise: str | None = None) -> Column:
    """Key of the first rule that fires, then of the first of ``more`` conditions."""
    found = [F.when(fires(r, scopes), r.key) for r in rules] + [F.when(c, k) for k, c in more]
    return F.coalesce(*found, F.lit(otherwise).cast("string"))


def all_keys(rules: Iterable[Rule], scopes: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(fires(r, scopes), r.key) for r in rules)))


def rule_table(spark, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(i, r.key, r.scope, r.regex()) for i, r in enumerate(rules)], "ordinal int, rule_key string, scope string, pattern string")


def surface_drift(rules: DataFrame, checklist: DataFrame) -> DataFrame:
    """Rules without an entry in the checklist and entries without a rule."""
    both = rules.select("rule_key").join(checklist.select("rule_key", "letter"), "rule_key", "full_outer")
    known = rules.select("rule_key", F.lit(True).alias("known"))
    joined = both.join(known, "rule_key", "left")
    return joined.select("rule_key", "letter", F.when(F.col("letter").isNull(), "unmapped").when(F.col("known").isNull(), "stale").otherwise("ok").alias("status"))
