"""Venues: travel times from a cache, and what to do without."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..settings import DEFAULT, Settings

CLOSED = ("vetoed", "llm_rejected", "duplicate", "expired")
# Tiers and states that decide whether travel is looked up.
LOOKED_UP_TIERS = ("Top Picks", "Recommended", "Borderline", "Couldn't Process")
NOT_LOOKED_UP = ("written", "vetoed", "llm_rejected", "duplicate")


def latest(venues: DataFrame, key: str) -> DataFrame:
    """The newest row of each key, lower-cased."""
    rows = venues.where(~C.blank(F.col(key))).withColumn("venue_key", F.lower(F.trim(key)))
    w = Window.partitionBy("venue_key").orderBy(F.desc("lookup_date"), F.desc("travel_transit_min"))
    return rows.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def with_cache(cand: DataFrame, venues: DataFrame, as_of: str | None, keys: list[str], s: Settings = DEFAULT) -> DataFrame:
    """``cand`` with ``cached`` (struct) and ``cached_by``: by the first of ``keys`` that has a fresh row."""
    fresh = venues if as_of is None else venues.where(F.col("lookup_date") >= F.date_sub(F.lit(as_of).cast("date"), s.cache_days).cast("string"))
    out = cand
    for k in keys:
        side = latest(fresh, k).select(F.col("venue_key").alias(f"__k_{k}"), F.struct("travel_transit_min", "lookup_date").alias(f"__v_{k}"))
        out = out.join(side, F.lower(F.trim(F.col(k))) == F.col(f"__k_{k}"), "left")
    by = F.coalesce(*(F.when(F.col(f"__v_{k}").isNotNull(), k) for k in keys))
    out = out.withColumn("cached", F.coalesce(*(F.col(f"__v_{k}") for k in keys))).withColumn("cached_by", by)
    return out.drop(*(f"__{x}_{k}" for k in keys for x in "kv"))


def awaiting(cand: DataFrame, as_of: str) -> DataFrame:
    """Upcoming rows of a tier that is shown, with neither a travel time nor a failed look-up."""
    open_ = F.col("travel_display").isNull() & ~F.coalesce("travel_lookup_failed", F.lit(False)) & ~F.col("pipeline_state").isin(*NOT_LOOKED_UP)
    return cand.where((F.coalesce("end_date", "date") >= as_of) & F.col("llm_tier").isin(*LOOKED_UP_TIERS) & open_)


def newest(venues: DataFrame, key: str, fields: list[str], exact: bool) -> DataFrame:
    """(venue_key, found): the newest row of each key as a struct of ``fields``; one aggregate with map-side combining."""
    name = F.trim(key) if exact else F.lower(F.trim(key))
    return venues.where(~C.blank(F.col(key))).groupBy(name.alias("venue_key")).agg(F.max_by(F.struct(*fields), F.struct("lookup_date", *fields)).alias("found"))


def in_tiers(cand: DataFrame, venues: DataFrame, keys: dict[str, bool], fields: list[str], fresh_from: str | None = None) -> DataFrame:
    """``cand`` with ``found`` (struct of ``fields``) and ``found_by``, by the first of ``keys`` that has a row.

    ``keys`` says of each whether it is exact; others ignore case. Fields of two venues are never mixed. Rows looked
    up before ``fresh_from`` don't count.
    """
    out, names = cand, list(keys)
    for i, k in enumerate(names):
        side = newest(venues.where(F.col("lookup_date") >= fresh_from) if fresh_from else venues, k, fields, keys[k]).toDF(f"__k{i}", f"__v{i}")
        out = out.join(side, (F.trim(k) if keys[k] else F.lower(F.trim(k))) == F.col(f"__k{i}"), "left")
    found = [F.col(f"__v{i}") for i in range(len(names))]
    by = F.coalesce(*(F.when(v.isNotNull(), k) for v, k in zip(found, names)))
    return out.withColumn("found", F.coalesce(*found)).withColumn("found_by", by).drop(*(f"__{x}{i}" for x in "kv" for i in range(len(names))))


def travel_tiers(cand: DataFrame, venues: DataFrame, as_of: dt.date, s: Settings = DEFAULT) -> DataFrame:
    """``awaiting`` rows with a travel time not older than the cache's days: by name, postcode or place."""
    oldest = (as_of - dt.timedelta(days=s.cache_days)).isoformat()
    return in_tiers(awaiting(cand, as_of.isoformat()), venues, {"venue_name": False, "venue_postcode": False, "place_id": True}, ["travel_transit_min", "lookup_date"], oldest)


def geo_tiers(cand: DataFrame, venues: DataFrame) -> DataFrame:
    """``cand`` with the place of its venue by name, else by postcode; places don't age."""
    return in_tiers(cand, venues.where("venue_lat is not null"), {"venue_name": False, "venue_postcode": False}, ["venue_lat", "venue_lon"])


def cache_fill(cand: DataFrame, venues: DataFrame, as_of: dt.date, s: Settings = DEFAULT) -> DataFrame:
    """Rows to add to the cache: the newest candidate with a travel time of each venue name that has none.

    It is left out if its postcode has a fresh row, in the cache or from a newer candidate of another name. A
    candidate without a run date gives a row that has expired.
    """
    oldest, aged = ((as_of - dt.timedelta(days=s.cache_days + more)).isoformat() for more in (0, 1))
    known = venues.select(F.lower("venue_name").alias("__known")).distinct()
    rows = cand.where(F.col("travel_display").isNotNull() & ~C.blank(F.col("venue_name")))
    rows = rows.join(known, F.lower("venue_name") == F.col("__known"), "left_anti")
    newest_ = F.max_by(F.struct("id", "venue_name", C.or_null(F.col("venue_postcode")).alias("venue_postcode"), "travel_transit_min", F.coalesce("run_date", F.lit(aged)).alias("lookup_date")), "id")
    new = rows.groupBy(F.lower(F.trim("venue_name")).alias("venue_key")).agg(newest_.alias("r")).select("venue_key", "r.*").withColumn("__code", F.lower("venue_postcode"))
    fresh = venues.where((F.col("lookup_date") >= oldest) & ~C.blank(F.col("venue_postcode"))).select(F.lower("venue_postcode").alias("__code")).distinct()
    first = new.where((F.col("lookup_date") >= oldest) & F.col("__code").isNotNull()).groupBy("__code").agg(F.max("id").alias("__first"))
    j = new.join(fresh, "__code", "left_anti").join(first, "__code", "left")
    return j.where(F.col("__first").isNull() | (F.col("id") >= F.col("__first"))).drop("__code", "__first", "id")


def eligible(cand: DataFrame, as_of: str) -> DataFrame:
    return cand.where((F.coalesce("end_date", "date") >= as_of) & ~F.col("pipeline_state").isin(*CLOSED))


def same_place(lookups: DataFrame) -> DataFrame:
    """Venues of one place share the look-up of the first: (venue_name, travel_transit_min)."""
    first = lookups.groupBy("place_id").agg(F.min_by("travel_transit_min", "ord").alias("shared"))
    return lookups.join(first, "place_id").select("venue_name", F.col("shared").alias("travel_transit_min"))


def cache_backfill(cand: DataFrame, venues: DataFrame) -> DataFrame:
    """Venues with travel data on candidates but none in the cache: the newest candidate's."""
    known = venues.select(F.lower(F.trim("venue_name")).alias("venue_key")).distinct()
    rows = cand.where(~C.blank(F.col("venue_name")) & F.col("travel_transit_min").isNotNull()).withColumn("venue_key", F.lower(F.trim("venue_name")))
    new = rows.groupBy("venue_key").agg(F.max_by(F.struct("venue_name", "travel_transit_min", F.col("run_date").alias("lookup_date")), "id").alias("r"))
    return new.join(known, "venue_key", "left_anti").select("venue_key", "r.*")


def apply_travel(cand: DataFrame, lookups: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """``cand`` after look-ups (venue_key, transit, cycle, walk, limited); limited ones are not applied."""
    took = lookups.where("not limited").drop("limited").withColumn("found", F.lit(True))
    j = cand.join(took, F.lower(F.trim("venue_name")) == F.col("venue_key"), "left")
    shown = C.travel_display(F.col("transit"), F.col("cycle"), F.col("walk"), s.cycle_shown, s.walk_shown)
    ready = F.col("found") & (F.col("pipeline_state") == "pending_travel")
    return j.withColumn("travel_display", shown).withColumn("failed", F.when(F.col("found"), shown.isNull())).withColumn("new_state", F.when(F.coalesce(ready, F.lit(False)), "ready_to_write").otherwise(F.col("pipeline_state")))


def source_detail(cand: DataFrame, emails: DataFrame) -> DataFrame:
    """Where a newsletter row came from: sender and day."""
    m = emails.select(F.col("message_id").alias("__m"), "sender", "email_date")
    j = cand.where("source = 'Newsletter'").join(m, F.col("source_snapshot") == F.col("__m"), "left")
    said = F.concat("sender", F.lit(" Newsletter, "), C.date_labels(F.col("email_date"))[0])
    return j.select("id", F.coalesce(said, F.lit("Newsletter")).alias("detail"))
