"""Descriptions that are too thin: which, in what batches, and what a look-up brings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..settings import DEFAULT, Settings


def strategy(url: Column, blocked: tuple[str, ...]) -> Column:
    host = C.url_host(url)
    shut = reduce(lambda a, d: a | (host == d) | host.endswith(f".{d}"), blocked, F.lit(False))
    return F.when(C.blank(url) | C.is_homepage(url), "web_search").when(shut, "proxy_blocked").otherwise("url_follow")


def venue_domain(cand: DataFrame, organisers: DataFrame, sources: DataFrame, hosts: tuple[str, ...] = ()) -> DataFrame:
    """``cand`` with ``domain``: by organiser, else the first of ``hosts`` that the URL's host has, else by source.

    The two tables (key, domain) and the hosts are settings of a few rows.
    """
    found = cand.join(organisers.toDF("__o", "__by"), F.lower("organiser") == F.col("__o"), "left").join(sources.toDF("__s", "__for"), F.col("source") == F.col("__s"), "left")
    host = C.url_host(F.col("url"))
    at = F.coalesce(*(F.when(host.contains(h), h) for h in hosts), F.lit(None).cast("string"))
    return found.withColumn("domain", F.coalesce("__by", at, "__for")).drop("__o", "__by", "__s", "__for")


def thin(cand: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Rows (id, description, url, ...) whose description is missing or short, with a strategy."""
    short = F.length(F.coalesce("description", F.lit(""))) < s.thin_chars
    return cand.where(short).withColumn("strategy", strategy(F.col("url"), s.blocked_domains))


def apply_found(cand: DataFrame, found: DataFrame) -> DataFrame:
    """``cand`` after look-ups ``found`` (id, name, text): taken if the name is right and the text is longer."""
    f = found.select("id", F.col("name").alias("__n"), C.decode_entities(F.col("text")).alias("__t"))
    joined = cand.join(f, "id", "left")
    outcome = (
        F.when(F.col("__t").isNull() & F.col("__n").isNull(), "none")
        .when(~F.col("__n").eqNullSafe(F.col("name")) | C.blank(F.col("__t")), "failed")
        .when(F.length("__t") > F.length(F.coalesce("description", F.lit(""))), "enriched")
        .otherwise("skipped")
    )
    out = joined.withColumn("outcome", outcome)
    return out.withColumn("description", F.when(F.col("outcome") == "enriched", F.col("__t")).otherwise(F.col("description"))).drop("__n", "__t")


def fill_from_detail(cand: DataFrame, fresh: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fields of flagged rows replaced by fresh values that are not null; the flag goes where a row was found."""
    f = fresh.select(key, *(F.col(c).alias(f"__{c}") for c in fields), F.lit(True).alias("__found"))
    joined = cand.join(f, key, "left")
    take = F.col("needs_enrichment") & F.col("__found")
    for c in fields:
        joined = joined.withColumn(c, F.when(F.coalesce(take, F.lit(False)), F.coalesce(f"__{c}", c)).otherwise(F.col(c)))
    return joined.withColumn("needs_enrichment", F.col("needs_enrichment") & F.col("__found").isNull()).drop(*(f"__{c}" for c in [*fields, "found"]))
