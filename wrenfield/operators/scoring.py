"""Vetoes, formats, signals, scores and tiers of candidates."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..settings import DEFAULT, Settings
from . import packs
from .rules import Rule, first_key, folded, once, says as has


def scopes(name: Column, description: Column, organiser: Column) -> dict[str, Column]:
    return {"blob": C.text_blob(name, description, organiser), "title": C.text_blob(name, organiser), "name": F.lower(F.coalesce(name, F.lit("")))}


def classify_format(name: Column, description: Column, rules: list[Rule] = packs.FORMATS) -> Column:
    text = {"blob": C.text_blob(name, description), "name": F.lower(F.coalesce(name, F.lit("")))}
    return once(folded(text), lambda t: first_key(rules, t, otherwise=packs.DEFAULT_FORMAT))


def verify_format(format_type: Column, name: Column) -> Column:
    outdoor = F.lower(name).rlike(r"\b\d+\s*(?:or\s+\d+\s*)?miles?\b|\bcircular\b")
    return F.when((format_type == packs.DEFAULT_FORMAT) & outdoor, "Outdoor").otherwise(format_type)


def mapped(c: Column, table: dict[str, str]) -> Column:
    """``c`` through a fixed table; what it has not stays."""
    return F.coalesce(F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[c], c)


def normalise_format(c: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in packs.CANONICAL.items() for x in kv))[F.lower(c)], c)


def retire_format(format_type: Column, name: Column, description: Column) -> Column:
    kept = mapped(format_type, packs.RETIRED)
    return F.when(kept == packs.DEFAULT_FORMAT, classify_format(name, description)).otherwise(kept)


def cost_veto(cost: Column, s: Settings = DEFAULT) -> Column:
    return C.parse_cost(cost) > s.cost_limit


def far_park_veto(name: Column, transit: Column, s: Settings = DEFAULT) -> Column:
    return name.rlike(C.any_of(list(packs.PARKS))) & (transit > s.park_minutes)


def veto_reason(cand: DataFrame, rules: list[Rule] = packs.VETOES, s: Settings = DEFAULT) -> Column:
    """The first veto of a row, or null. Exempting words suppress only their own rule."""
    have = lambda c: F.col(c) if c in cand.columns else F.lit(None).cast("string")
    text = scopes(F.col("name"), have("description"), have("organiser"))
    dear, transit = F.coalesce(cost_veto(have("cost"), s), F.lit(False)), F.col("travel_transit_min") if "travel_transit_min" in cand.columns else F.lit(None).cast("int")
    far = F.coalesce(far_park_veto(F.col("name"), transit, s), F.lit(False))

    def reason(t: dict[str, Column]) -> Column:
        more = [("classical_concert", t["title"].rlike(r"\b(?:op|bwv)\.?\s*\d+")), ("singles_in_title_or_group", t["title"].rlike(r"\bsingles\b"))]
        return first_key(rules, t, [*more, ("cost_over_30", dear), ("park_hangout_far", far)])

    return once(folded(text), reason)


def load_overrides(text: str | None) -> dict[str, list[str]]:
    """Approved extra organisers and series; none if missing or malformed."""
    try:
        got = json.loads(text or "{}")
        return {k: [str(x).lower() for x in got.get(k, [])] for k in ("organisers", "series")}
    except (ValueError, AttributeError):
        return {"organisers": [], "series": []}


def signals(cand: DataFrame, words: dict[str, tuple[str, ...]] = packs.SIGNALS, overrides: dict | None = None, s: Settings = DEFAULT) -> Column:
    """array<struct<label, weight>> of what fires, in order of evaluation."""
    text = scopes(F.coalesce(F.col("name"), F.lit("")), F.col("description") if "description" in cand.columns else F.lit(None).cast("string"), F.col("organiser") if "organiser" in cand.columns else F.lit(None).cast("string"))
    return once(folded(text), lambda t: _signals(cand, t, words, overrides, s))


def _signals(cand: DataFrame, text: dict[str, Column], words: dict[str, tuple[str, ...]], overrides: dict | None, s: Settings) -> Column:
    have = lambda c: F.col(c) if c in cand.columns else F.lit(None).cast("string")
    extra = overrides or {"organisers": [], "series": []}
    organiser, form = F.lower(F.trim(F.coalesce(have("organiser"), F.lit("")))), F.coalesce(have("format_type"), F.lit(""))
    says = lambda key, scope="blob": has(text, scope, words[key])
    cost, hour, norm = C.parse_cost(have("cost")), C.parse_hour(have("time")), normalise_format(form)
    hands_on = says("hands_on_title", "name") | says("hands_on")
    social = form.isin(*packs.SOCIAL_THROUGH) | says("social")
    artist = says("artists")
    series = [*words["series"], *extra["series"]]
    transit = F.col("travel_transit_min") if "travel_transit_min" in cand.columns else F.lit(None).cast("int")
    known = organiser.isin(*words["organisers"], *extra["organisers"])
    # The labels and weights of the signals, in their order.
    fixed = [
        ("Signal #1: AI/tech community", 3, says("ai")),
        ("Signal #3: Listening bar/vinyl", 3, says("vinyl")),
        ("Signal #4: Hands-on", 2, hands_on),
        ("Signal #5: Creative activity", 2, says("creative")),
        ("Signal #5b: Music production/tech", 2, says("production")),
        ("Signal #6: Social through activity", 2, social),
        ("Signal #7: Known artist", 2, artist),
        ("Signal #9: Immersive (partial, needs LLM)", 1, says("immersive")),
        ("Signal #14: Climbing/bouldering", 2, says("climbing")),
        ("Signal #16: Free/cheap", 1, cost <= s.cheap_limit),
        ("Signal #17: Before 10am", -2, hour < 10),
        ("Signal #21: Breathwork/sound healing", 1, says("breathwork")),
        ("Signal #30: Repeat format", 1, norm.isin(*packs.REPEATED)),
        ("Signal #31: Known series", 2, has(text, "name", series)),
        ("Signal #32: Known organiser", 2, known),
        ("Signal #32: Known venue-as-organiser", 2, ~known & F.lower(F.coalesce(have("venue_name"), F.lit(""))).isin(*words["venues"])),
        ("Signal #33: Passive format", -1, norm.isin(*packs.PASSIVE) & ~hands_on),
    ]
    last = [
        ("Signal #35: Pompous gallery", -1, says("pompous")),
        ("Signal #36: Thought leadership panel", -1, says("thought") & ~hands_on),
        ("Signal #38: Networking drinks", -2, says("networking") & ~social),
        ("Signal #39: Unknown music act", -2, (form == "Concert") & ~artist),
        ("Signal #40: Violence", -2, says("violence")),
        ("Signal #41: Corporate", -2, says("corporate")),
    ]
    one = lambda label, weight, cond: F.when(cond, F.struct(F.lit(label).alias("label"), F.lit(weight).alias("weight")))
    first = F.array_compact(F.array(*(one(*x) for x in fixed)))
    # the sum so far decides whether a far place counts against a row
    far = F.transform(F.filter(F.array(F.struct(F.lit("Signal #34: Far + routine").alias("label"), F.lit(-1).alias("weight"))), lambda _: (transit > s.far_minutes) & (total(first) < 6)), lambda x: x)
    return F.concat(first, far, F.array_compact(F.array(*(one(*x) for x in last))))


def total(fired: Column) -> Column:
    return F.aggregate(fired, F.lit(0), lambda a, x: a + x["weight"])


def tier(score: Column) -> Column:
    return F.when(score >= 8, "Top Picks").when(score >= 4, "Recommended").otherwise("Borderline")


def review_flags(fired: Column, score: Column, transit: Column, s: Settings = DEFAULT) -> Column:
    """Questions that need judgement: immersive ones, and far ones with a high score."""
    immersive = F.exists(fired, lambda x: x["label"].startswith("Signal #9:"))
    return F.array_compact(F.array(F.when(immersive, "is it immersive?"), F.when((transit > s.far_minutes) & (score >= 6), "is it worth the trip?")))


def score_job(cand: DataFrame, as_of: str, rescore: bool = False, s: Settings = DEFAULT, overrides: dict | None = None) -> DataFrame:
    """All rows, those in scope with outcome, veto_reason, format_type, fired, new_score, new_tier and new_state.

    In scope are upcoming rows that are not vetoed or manual and, unless ``rescore``, have no tier yet. Vetoed rows
    that have a page keep their state; plain scoring resets the state of rows without one.
    """
    have = lambda c, kind="string": F.col(c) if c in cand.columns else F.lit(None).cast(kind)
    upcoming = F.coalesce(F.col("end_date"), F.col("date")) >= as_of
    in_scope = upcoming & (F.col("pipeline_state") != "vetoed") & (F.col("source") != "manual")
    in_scope = in_scope if rescore else in_scope & have("tier").isNull()
    described = "description" in cand.columns
    blank = C.blank(F.col("description")) if described else F.lit(False)
    form = F.coalesce(C.or_null(F.trim(F.col("format_type"))), classify_format(F.col("name"), have("description")))
    base = cand.withColumn("in_scope", F.coalesce(in_scope, F.lit(False))).withColumn("veto_reason", F.when(F.col("in_scope"), veto_reason(cand, s=s)))
    base = base.withColumn("format_type", F.when(F.col("in_scope"), verify_format(form, F.col("name"))).otherwise(F.col("format_type")))
    outcome = F.when(~F.col("in_scope"), "untouched").when(F.col("veto_reason").isNotNull(), "vetoed").when(blank, "no description").otherwise("scored")
    base = base.withColumn("outcome", outcome)
    scored = base.withColumn("fired", F.when(F.col("outcome") == "scored", signals(base, overrides=overrides, s=s)))
    score = F.when(F.col("outcome") == "scored", total(F.col("fired")))
    page = have("notion_page_id").isNotNull()
    state = F.when((F.col("outcome") == "vetoed") & ~page, "vetoed").when((F.col("outcome") == "scored") & ~page & F.lit(not rescore), "pending_llm").otherwise(F.col("pipeline_state"))
    named = F.when(F.col("outcome") == "vetoed", "Vetoed").when(F.col("outcome") == "no description", couldnt_process(F.lit(""))).when(F.col("outcome") == "scored", tier(score))
    return scored.withColumn("new_score", score).withColumn("new_tier", named).withColumn("new_state", state)


def couldnt_process(description: Column) -> Column:
    """The tier of rows without a description; they get no score."""
    return F.when(C.blank(description), "Couldn't Process")


def score_report(scored: DataFrame) -> DataFrame:
    return scored.groupBy("outcome", F.coalesce("new_tier", F.lit("-")).alias("tier")).agg(F.count("*").alias("n"), F.coalesce(F.sum("new_score"), F.lit(0)).alias("total"))


def hard_rule(name: Column, description: Column, organiser: Column) -> Column:
    text = scopes(name, description, F.lit(""))
    return first_key(packs.HARD_RULES, text, [("organiser", F.lower(organiser).isin(*packs.HARD_ORGANISERS))])
