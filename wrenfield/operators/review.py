"""Review batches, what comes back from them, and the gates behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..settings import DEFAULT, Settings
from ..staging import staged
from .scoring import hard_rule

TIERS = ("Top Picks", "Recommended", "Borderline", "Not Recommended")
# Patterns of the reviewer's reasons.
PAST = r"(?i)attend|been to|went to|visited|previously|familiar|the user has|you've been|series.{0,20}before|organiser.{0,20}before|venue.{0,20}before"
SEASONAL = r"(?i)\b(?:lavender|strawberry|cherry blossom|fireworks|bonfire|outdoor cinema|festival|open[- ]air|harvest|pumpkin|christmas market|winter wonderland|summer fair|spring fair|sculpture trail|light show|lantern|one[- ]off|inaugural|limited[- ]run|special edition|first ever|farewell)\b"
TRAVEL = r"(?i)\b(?:travel|transit|journey|commute|too far|distance|\d+\s*min(?:ute)?s?\s*(?:away|each way|travel|transit))\b"
OTHER_CONCERN = r"(?i)\b(?:wrong crowd|wrong vibe|not (?:in|among) .{0,30}interest|passive .{0,20}format|veto [A-W]|hard no|wrong (?:age|sport|community))\b"
ARTEFACT = r"(?i)signal\s*\d+|past\s*pattern\s*:|already\s*counted"


def pending(cand: DataFrame, as_of: str) -> DataFrame:
    open_ = (F.col("pipeline_state") == "pending_llm") & (F.coalesce("end_date", "date") >= as_of)
    return cand.where(open_ & F.col("llm_reviewed").isNull()) if "llm_reviewed" in cand.columns else cand.where(open_)


def numbered(ids: DataFrame, size: int) -> DataFrame:
    """(id, batch): ids in order, ``size`` a batch.

    Positions come from counts of id ranges and a rank within each, so no task sees all ids.
    """
    # staged, so that the ranges are drawn once for the counts and the ranks
    parts = staged(ids.select("id").repartitionByRange("id").withColumn("part", F.spark_partition_id()))
    counts = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "before")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("id"))
    return parts.withColumn("rank", rank).join(F.broadcast(before), "part").select("id", (F.floor((F.col("before") + F.col("rank") - 1) / size) + 1).alias("batch"))


def review_batches(cand: DataFrame, as_of: str, s: Settings = DEFAULT) -> DataFrame:
    return numbered(pending(cand, as_of), s.review_batch).groupBy("batch").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.count("*").alias("n"))


def card(name: Column, date: Column, venue: Column, cost: Column, travel: Column) -> Column:
    return F.format_string("%s | %s | %s | %s | %s", name, date, F.coalesce(venue, F.lit("unknown venue")), F.coalesce(cost, F.lit("TBC")), F.coalesce(F.concat(travel.cast("string"), F.lit(" min")), F.lit("unknown")))


def full_card(row: dict[str, Column]) -> Column:
    """A card of a candidate as its reviewer reads it: what it is, the assessment so far with the signals that fired (array<struct<label, weight>>), and whether it is known."""
    known = F.when(F.coalesce(row["known_before"], F.lit(False)), "yes").otherwise("no")
    fired = F.array_join(F.transform(row["signals"], lambda s: F.format_string("%s (%+d)", s["label"], s["weight"])), ", ")
    said = F.when(C.blank(row["description"]), "none").otherwise(row["description"])
    assessed = F.concat(F.coalesce(row["tier"], F.lit("untiered")), F.lit(" / "), F.coalesce(row["score"].cast("string"), F.lit("unscored")))
    lines = [F.concat(F.lit("## "), row["id"].cast("string"), F.lit(" "), card(row["name"], row["date"], row["venue"], row["cost"], row["travel"]))]
    lines += [F.concat(F.lit(f"{k}: "), v) for k, v in (("Assessment", assessed), ("Signals", F.when(fired == "", "none").otherwise(fired)), ("Known", known), ("Description", said))]
    return F.concat_ws("\n", *lines)


def batch_prompts(cards: DataFrame, asked: str, size: int, units: int = 8_000) -> DataFrame:
    """(batch, n, prompt): cards (id, card) in order of id, ``size`` a batch, under the request; a card is cut at its share of ``units`` UTF-16 units, and
    no character is split."""
    j = numbered(cards, size).join(cards, "id").withColumn("card", C.truncate_utf16(F.col("card"), units // size))
    lines = F.expr(r"listagg(card, '\n\n') within group (order by id)")
    return j.groupBy("batch").agg(F.count("*").alias("n"), F.concat(F.lit(asked + "\n\n"), lines).alias("prompt"))


def volume(cand: DataFrame, as_of: str, first_run: bool = False, s: Settings = DEFAULT) -> DataFrame:
    n = pending(cand, as_of).agg(F.count("*").alias("n"))
    return n.withColumn("status", F.when(F.lit(first_run), "ok").when(F.col("n") > s.abort_volume, "abort").when(F.col("n") > s.warn_volume, "warn").otherwise("ok"))


def next_state(tier: Column, transit: Column, failed: Column) -> Column:
    return F.when(tier == "Not Recommended", "llm_rejected").when(transit.isNotNull() | failed, "ready_to_write").otherwise("pending_travel")


def parse_review(responses: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows (id, tier, reasoning) of the first to last bracket of each answer; only known ids and tiers."""
    array = F.from_json(F.regexp_extract("answer", r"(?s)(\[.*\])", 1), "array<struct<id:long,tier:string,reasoning:string,corrected_type:string>>")
    rows = responses.select(F.explode(array).alias("r")).select("r.*").where(F.col("tier").isin(*TIERS))
    return rows.join(manifest.select("id"), "id", "left_semi")


def apply_review(cand: DataFrame, reviews: DataFrame) -> DataFrame:
    """``cand`` after reviews (id, ord, tier, corrected_type): state only of pending rows, format of any."""
    good = reviews.where(F.col("tier").isin(*TIERS)).groupBy("id").agg(F.min_by("tier", "ord").alias("r_tier"), F.max_by(F.nullif(F.trim("corrected_type"), F.lit("")), "ord").alias("r_type"))
    j = cand.join(good, "id", "left")
    take = F.col("r_tier").isNotNull() & (F.col("pipeline_state") == "pending_llm")
    state = F.when(take, next_state(F.col("r_tier"), F.col("travel_transit_min"), F.lit(False))).otherwise(F.col("pipeline_state"))
    corrected = F.col("r_type").isNotNull() & ~F.col("r_type").eqNullSafe(F.col("format_type"))
    return j.withColumn("new_state", state).withColumn("new_format", F.when(corrected, F.col("r_type")).otherwise(F.col("format_type"))).withColumn("corrected", corrected)


def correction_patterns(applied: DataFrame) -> DataFrame:
    rows = applied.where("corrected").select("id", F.concat(F.coalesce("format_type", F.lit("None")), F.lit(" -> "), "new_format").alias("pattern"))
    return rows.groupBy("pattern").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


def disagreements(cand: DataFrame, rule_tier: Column, review_tier: Column) -> DataFrame:
    rank = lambda c: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for i, t in enumerate(TIERS) for x in (t, 4 - i))), c), F.lit(0))
    both = cand.select("id", rank(rule_tier).alias("a"), rank(review_tier).alias("b"), (rule_tier != review_tier).alias("differ")).where("differ")
    return both.select("id", F.when(F.col("b") > F.col("a"), "upgrade").otherwise("downgrade").alias("direction"))


def borderline_cap(cand: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Accepted rows (id, llm_tier, score) with ``demoted``: the lowest borderline ones beyond the share.

    How many go is one number. Counts by score tell the score at which it is reached: lower ones go whole, and the
    ids of that score are numbered by range counts, so no task gathers all rows that go.
    """
    accepted = cand.where(F.col("llm_tier") != "Not Recommended")
    t, b = accepted.agg(F.count("*"), F.count_if(F.col("llm_tier") == "Borderline")).first()
    share = s.borderline_share
    import math

    excess = min(b, math.ceil((b - share * t) / (1 - share) - 1e-9)) if t > s.borderline_least and b / t > share else 0
    if excess <= 0:
        return accepted.withColumn("demoted", F.lit(False))
    score, borderline = F.coalesce("score", F.lit(0)), F.col("llm_tier") == "Borderline"
    counts = accepted.where(borderline).groupBy(score.alias("at")).agg(F.count("*").alias("n"))
    reached = counts.withColumn("upto", F.sum("n").over(Window.orderBy("at"))).where(F.col("upto") >= excess)
    edge, upto, n = reached.agg(F.min(F.struct("at", "upto", "n")).alias("e")).select("e.at", "e.upto", "e.n").first()
    last = numbered(accepted.where(borderline & (score == edge)), excess - (upto - n)).where("batch = 1")
    j = accepted.join(last.select("id", F.lit(True).alias("last")), "id", "left")
    return j.withColumn("demoted", borderline & ((score < edge) | F.coalesce("last", F.lit(False)))).drop("last")


def gates(cand: DataFrame, as_of: str, run_date: str) -> DataFrame:
    """Hard rules, past notes and travel recovery in their order; notes start from the reasons before the rules."""
    described = F.col("description") if "description" in cand.columns else F.lit("")
    hit = hard_rule(F.col("name"), described, F.col("organiser"))
    first = cand.withColumn("rule", hit).withColumn("given", F.col("reasoning"))
    first = first.withColumn("llm_tier", F.when(F.col("rule").isNotNull(), "Not Recommended").otherwise(F.col("llm_tier")))
    first = first.withColumn("reasoning", F.when(F.col("rule").isNotNull(), F.concat(F.lit("Hard rule: "), "rule", F.lit(". "), "given")).otherwise(F.col("given")))
    note = F.col("known_before") & ~F.coalesce(F.col("given"), F.lit("")).rlike(PAST)
    second = first.withColumn("reasoning", F.when(note, F.concat("given", F.lit(" The user has been here before."))).otherwise(F.col("reasoning")))
    far = F.col("reasoning").rlike(TRAVEL) & ~F.col("reasoning").rlike(OTHER_CONCERN) & C.text_blob(F.col("name"), described).rlike(SEASONAL)
    back = (F.col("llm_tier") == "Not Recommended") & (F.col("run_date") == run_date) & (F.coalesce("end_date", "date") >= as_of) & far
    return second.withColumn("recovered", F.coalesce(back, F.lit(False))).withColumn("llm_tier", F.when(F.col("recovered"), "Borderline").otherwise(F.col("llm_tier")))


def close_unprocessable(cand: DataFrame, tier: Column) -> DataFrame:
    """(id, new_state): pending rows that could not be processed are closed."""
    closed = F.when(tier == "Couldn't Process", "llm_rejected").otherwise(F.col("pipeline_state"))
    return cand.where("pipeline_state = 'pending_llm'").select("id", closed.alias("new_state"))


def travel_gaps(cand: DataFrame, display: Column) -> DataFrame:
    """Accepted rows with a venue for which no travel time is shown."""
    return cand.where((F.col("llm_tier") != "Not Recommended") & ~C.blank(F.col("venue_name")) & display.isNull())


def required_fields(cand: DataFrame) -> DataFrame:
    """Ready rows with reasons why they are incomplete."""
    reasons = F.array_compact(F.array(F.when(C.blank(F.col("name")), "name"), F.when(C.blank(F.col("date")), "date"), F.when(C.blank(F.col("llm_tier")), "tier")))
    return cand.where("pipeline_state = 'ready_to_write'").select("id", F.array_join(reasons, ",").alias("missing"))


def url_traced(cand: DataFrame, emails: DataFrame) -> DataFrame:
    """Whether a newsletter row's URL stands in its message: match, skipped, missing or NOT_FOUND."""
    j = cand.join(emails.select("message_id", "body_text"), "message_id", "left")
    links = F.regexp_extract_all("body_text", F.lit(r"https?://[^\s\"'<>]+"), F.lit(0))
    host = F.regexp_replace(C.url_host(F.col("url")), r"^luma\.com$", "lu.ma")
    traced = F.when(C.blank(F.col("url")), "missing").when(F.contains("body_text", "url"), "match").when(F.col("body_text").isNull() | (F.size(links) == 0), "skipped")
    return j.select("id", traced.when(F.exists(links, lambda x: F.regexp_replace(x, r"luma\.com", "lu.ma").contains(host)), "match").otherwise("NOT_FOUND").alias("url_status"))


def artefact(name: Column, description: Column, venue: Column, cost: Column) -> Column:
    return F.coalesce(*(F.when(c.rlike(ARTEFACT), k) for k, c in (("name", name), ("description", description), ("venue_name", venue), ("cost", cost))))
