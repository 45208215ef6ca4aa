"""Findings of a feedback digest, their state over digests, and the digest itself.

Findings are rows of two tables: one narrow row a finding, and a row for each event or correction it rests on. So a finding that a third of all events belong to is
many rows of a join, and never one long list; ``nested`` makes lists for a report, of a stated length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

EVENT = "finding_key string, role string, type string, event string, date string"
# Kinds of corrections that belong to an organiser or a venue.
ATTACHED = ("tier_mismatch", "over_recommended", "false_llm_reject", "expired_but_attended", "false_veto")


def _key(c: Column) -> Column:
    return F.lower(F.trim(c))


def finding_events(corrections: DataFrame, interest: DataFrame, gaps: DataFrame) -> DataFrame:
    """(finding_key, finding_type, target_name, role, type, event, date): what each finding rests on.

    Findings are organisers and venues of ``interest`` (kind, value, n), vetoes of ``corrections`` (type, event, date, organiser, venue_name, veto_reason), venues of two or more
    ``gaps`` (location, event, date), and corrections that belong to neither their organiser nor their venue. ``role`` is ``event``, or ``correction`` for those of an organiser or venue.
    """
    real = ~_key(F.col("value")).isin(*C.PLACEHOLDERS)
    prefix = F.when(F.col("kind") == "organiser", "organiser").otherwise("series")
    entities = interest.where((F.col("kind") == "organiser") | (F.col("kind") == "venue") & real)
    entities = entities.select(F.concat(prefix, F.lit(":"), _key(F.col("value"))).alias("finding_key"), prefix.alias("finding_type"), F.col("value").alias("target_name"), F.lit("event").alias("role"), F.lit(None).cast("string").alias("type"), F.concat("value", F.lit(" x "), F.col("n").cast("string")).alias("event"), F.lit(None).cast("string").alias("date"))
    row = lambda df, key, kind, target, role, type_: df.select(key.alias("finding_key"), kind.alias("finding_type"), target.alias("target_name"), F.lit(role).alias("role"), type_.alias("type"), "event", "date")
    none = F.lit(None).cast("string")
    veto = F.coalesce("veto_reason", F.lit("unknown"))
    vetoes = row(corrections.where("type = 'false_veto'"), F.concat(F.lit("veto:"), veto), F.lit("veto_exemption"), veto, "event", none)
    there = gaps.where(~C.blank(F.col("location")) & ~_key(F.col("location")).isin(*C.PLACEHOLDERS))
    often = there.groupBy("location").agg(F.count("*").alias("n")).where("n >= 2").select("location")
    missing = row(there.join(often, "location", "left_semi"), F.concat(F.lit("source_gap:"), _key(F.col("location"))), F.lit("source_gap"), F.col("location"), "event", none)

    known = entities.groupBy("finding_key", "finding_type").agg(F.min("target_name").alias("target_name"))
    of = lambda kind, c: known.where(F.col("finding_type") == kind).select(F.expr(f"substring(finding_key, {len(kind) + 2})").alias(c), F.struct("finding_key", "finding_type", "target_name").alias(f"{c}_of"))
    rows = corrections.where(F.col("type").isin(*ATTACHED)).withColumns({"org": _key(F.col("organiser")), "place": _key(F.col("venue_name"))})
    j = rows.join(of("organiser", "org"), "org", "left").join(of("series", "place"), "place", "left").withColumn("to", F.coalesce("org_of", "place_of"))
    attached = row(j.where("to is not null"), F.col("to.finding_key"), F.col("to.finding_type"), F.col("to.target_name"), "correction", F.col("type"))
    own = F.concat_ws(":", "type", C.normalise_ascii(F.col("event")), "date")
    alone = row(j.where("to is null and type <> 'false_veto'"), own, F.col("type"), F.col("event"), "event", none)
    return entities.unionByName(vetoes).unionByName(missing).unionByName(attached).unionByName(alone)


def _rationale() -> Column:
    kind = F.col("finding_type")
    said = F.when(kind == "organiser", "Events of this organiser are attended again and again").when(kind == "series", "Events at this place are attended again and again").when(kind == "veto_exemption", "This veto keeps out events that were attended")
    said = said.when(kind == "source_gap", "Attended events at this place come from no source").otherwise("An event was judged wrongly")
    more = F.when(F.size("additional_types") > 0, F.concat(F.lit("; corrected: "), F.array_join("additional_types", ", "))).otherwise("")
    return F.concat(F.format_string("%s (%d events, %d digests)", said, F.col("n_events"), F.col("evidence")), more)


def accumulate(findings: DataFrame, events: DataFrame, new: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """The state after a digest: ``findings`` (finding_key, finding_type, target_name, evidence, first_seen, last_seen, n_events, n_corrections, additional_types, rationale) and ``events``
    (finding_key, role, type, event, date, digest), with what ``finding_events`` returned as ``new``.

    A finding that comes again counts one more digest, its events are appended, its corrections and their types are replaced, and its rationale is written anew.
    """
    fresh = new.groupBy("finding_key").agg(
        F.min("finding_type").alias("new_type"), F.min("target_name").alias("new_target"), F.count_if(F.col("role") == "event").alias("more"), F.count_if(F.col("role") == "correction").alias("corrections"),
        F.array_sort(F.collect_set(F.when(F.col("role") == "correction", F.col("type")))).alias("types"),
    )
    j = findings.join(fresh, "finding_key", "full_outer")
    came = F.col("more").isNotNull()
    state = j.select(
        "finding_key", F.coalesce("finding_type", "new_type").alias("finding_type"), F.coalesce("target_name", "new_target").alias("target_name"), (F.coalesce("evidence", F.lit(0)) + came.cast("int")).cast("long").alias("evidence"),
        F.coalesce("first_seen", F.lit(as_of)).alias("first_seen"), F.when(came, as_of).otherwise(F.col("last_seen")).alias("last_seen"), (F.coalesce("n_events", F.lit(0)) + F.coalesce("more", F.lit(0))).cast("long").alias("n_events"),
        F.when(came, F.col("corrections")).otherwise(F.col("n_corrections")).cast("long").alias("n_corrections"), F.when(came, F.col("types")).otherwise(F.col("additional_types")).alias("additional_types"), F.col("rationale").alias("__old"), came.alias("__came"),
    ).withColumn("rationale", F.when(F.col("__came"), _rationale()).otherwise(F.col("__old"))).drop("__old", "__came")
    replaced = events.where("role = 'correction'").join(fresh.select("finding_key"), "finding_key", "left_anti")
    out = events.where("role = 'event'").unionByName(replaced).unionByName(new.select("finding_key", "role", "type", "event", "date").withColumn("digest", F.lit(as_of)))
    return state, out


def empty_state(spark) -> tuple[DataFrame, DataFrame]:
    findings = "finding_key string, finding_type string, target_name string, evidence long, first_seen string, last_seen string, n_events long, n_corrections long, additional_types array<string>, rationale string"
    return spark.createDataFrame([], findings), spark.createDataFrame([], f"{EVENT}, digest string")


def report(sections: dict[str, tuple[DataFrame, list[str]]], most: int = 20) -> DataFrame:
    """One record as JSON: how many rows each section has, and the first ``most`` of each in the order of its columns, then of all its columns. The counts are of all rows."""
    one = None
    for name, (rows, order) in sections.items():
        rest = [c for c in rows.columns if c not in order]
        count = rows.agg(F.count("*").alias(f"n_{name}"))
        keys = F.struct(*(F.col(c) for c in [*order, *rest]))
        first = rows.select(keys.alias("k"), F.struct(*rows.columns).alias("r")).orderBy("k").limit(most)
        lists = first.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "r"))), lambda x: x["r"]).alias(name))
        both = count.join(F.broadcast(lists))  # one row each
        one = both if one is None else one.join(F.broadcast(both))
    summary = F.struct(*(F.col(f"n_{n}").alias(n) for n in sections))
    return one.select(F.to_json(F.struct(summary.alias("summary"), *(F.col(n) for n in sections)), {"ignoreNullFields": "false"}).alias("digest"))


def surface_drift(rules: DataFrame, rule_only: list[str], checklist: DataFrame, markers: DataFrame, profile: DataFrame) -> DataFrame:
    """(surface, name, status) of the three places that name vetoes: ``rules`` (rule_key), the reviewer's ``checklist`` (rule_key, letter), and the ``profile`` (text) in which the ``markers``
    (letter, marker) of every letter must stand.

    A rule is mapped to a letter or declared to be a rule only; a mapping of no rule is stale; a letter without a rule is unclaimed; a marker that the profile lacks is missing.
    """
    keys = rules.select("rule_key").distinct().withColumn("there", F.lit(True))
    mapped = keys.join(checklist.groupBy("rule_key").agg(F.min("letter").alias("letter")), "rule_key", "full_outer")
    of_rules = F.when(F.col("there").isNull(), "stale").when(F.col("letter").isNotNull(), "ok").when(F.col("rule_key").isin(*rule_only), "rule_only").otherwise("unmapped")
    claimed = checklist.join(keys, "rule_key", "left_semi").select("letter", F.lit(True).alias("claimed")).distinct()
    said = profile.agg(F.listagg(F.lower("text"), F.lit("\n")).alias("said")) if "text" in profile.columns else profile
    letters = markers.join(claimed, "letter", "left").join(F.broadcast(said))
    of_letters = F.when(F.col("claimed").isNull(), "unclaimed").when(~F.contains(F.coalesce("said", F.lit("")), F.lower("marker")), "missing").otherwise("ok")
    return mapped.select(F.lit("rules").alias("surface"), F.col("rule_key").alias("name"), of_rules.alias("status")).unionByName(letters.select(F.lit("profile").alias("surface"), F.col("letter").alias("name"), of_letters.alias("status")))
