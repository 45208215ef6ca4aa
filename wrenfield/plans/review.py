"""Queries of review, validation and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import enrich, review, scoring
from ..settings import DEFAULT as S
from .catalog import query
from .linkage import _UP, AS_OF
from .rules import _TIER

_PENDING = f"(SELECT * FROM ce WHERE pipeline_state = 'pending_llm' AND {_UP})"


@query("review_batches", f"SELECT batch, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids, count(*) AS n FROM (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 20 + 1 AS batch FROM {_PENDING}) GROUP BY batch")
def _(t):
    b = review.review_batches(t.ce, AS_OF)
    return b.select("batch", F.array_join("ids", ",").alias("ids"), "n")


@query("review_card", f"SELECT id, name || ' | ' || date || ' | ' || coalesce(venue_name, 'unknown venue') || ' | ' || cost || ' | ' || travel_transit_min || ' min' AS card FROM {_PENDING}")
def _(t):
    return review.pending(t.ce, AS_OF).select("id", review.card(*map(F.col, ("name", "date", "venue_name", "cost", "travel_transit_min"))).alias("card"))


@query("review_prompts", f"""
WITH p AS (SELECT *, (row_number() OVER (ORDER BY id) - 1) // 20 + 1 AS batch, concat('## ', id, ' ', name, ' | ', date, ' | ', coalesce(venue_name, 'unknown venue'), ' | ', cost, ' | ', travel_transit_min, ' min', chr(10), 'Assessment: ', llm_tier, ' / ', score, chr(10),
  'Signals: ', CASE id % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'vinyl (+2)' ELSE 'vinyl (+2), corporate (-3)' END, chr(10), 'Known: ', CASE WHEN id % 4 = 0 THEN 'yes' ELSE 'no' END, chr(10), 'Description: ', CASE WHEN id % 5 = 0 THEN 'none' ELSE organiser END) AS card FROM {_PENDING})
SELECT batch, count(*) AS n, sha256(concat('Judge each event.', chr(10), chr(10), string_agg(CASE WHEN length(card) > 120 THEN concat(left(card, 119), '…') ELSE card END, chr(10) || chr(10) ORDER BY id))) AS prompt_sha256 FROM p GROUP BY batch""")
def _(t):
    """Prompts of 20 cards; a card is cut at 120 units."""
    i = F.col("id")
    one = lambda label, weight: F.struct(F.lit(label).alias("label"), F.lit(weight).alias("weight"))
    fired = F.slice(F.array(one("vinyl", 2), one("corporate", -3)), F.lit(1), (i % 3).cast("int"))
    of = {"id": i, "name": F.col("name"), "date": F.col("date"), "venue": F.col("venue_name"), "cost": F.col("cost"), "travel": F.col("travel_transit_min"), "tier": F.col("llm_tier"), "score": F.col("score")}
    of |= {"signals": fired, "known_before": i % 4 == 0, "description": F.when(i % 5 != 0, F.col("organiser"))}
    cards = review.pending(t.ce, AS_OF).select("id", review.full_card(of).alias("card"))
    return review.batch_prompts(cards, "Judge each event.", S.review_batch, 2400).select("batch", "n", F.sha2(F.col("prompt").cast("binary"), 256).alias("prompt_sha256"))


@query("volume_guard", f"SELECT n, CASE WHEN n > 600 THEN 'abort' WHEN n > 300 THEN 'warn' ELSE 'ok' END AS status FROM (SELECT count(*) AS n FROM {_PENDING})")
def _(t):
    return review.volume(t.ce, AS_OF)


@query("recover_stuck", "SELECT id, CASE WHEN llm_tier = 'Not Recommended' THEN 'llm_rejected' WHEN id % 2 = 0 THEN 'ready_to_write' ELSE 'pending_travel' END AS new_state FROM ce WHERE pipeline_state = 'pending_llm'")
def _(t):
    transit = F.when(F.col("id") % 2 == 0, F.col("travel_transit_min"))
    return t.ce.where("pipeline_state = 'pending_llm'").select("id", review.next_state(F.col("llm_tier"), transit, F.lit(False)).alias("new_state"))


@query("parse_review", f"SELECT id, llm_tier AS tier, 'because' AS reasoning FROM {_PENDING} WHERE id % 2 = 0")
def _(t):
    rows = t.ce.select(F.concat(F.lit("Here: "), F.to_json(F.array(F.struct("id", F.when(F.col("id") % 2 == 0, F.col("llm_tier")).otherwise("Great").alias("tier"), F.lit("because").alias("reasoning")))), F.lit(" done")).alias("answer"))
    return review.parse_review(rows, review.pending(t.ce, AS_OF)).select("id", "tier", "reasoning")


@query("apply_review", "SELECT id, CASE WHEN pipeline_state <> 'pending_llm' OR id % 3 > 0 THEN pipeline_state WHEN llm_tier = 'Not Recommended' THEN 'llm_rejected' ELSE 'ready_to_write' END AS new_state, CASE WHEN id % 6 = 0 THEN 'Film' ELSE format_type END AS new_format FROM ce")
def _(t):
    reviews = t.ce.select("id", F.lit(1).alias("ord"), F.when(F.col("id") % 3 == 0, F.col("llm_tier")).otherwise("Great").alias("tier"), F.when(F.col("id") % 6 == 0, "Film").otherwise(" ").alias("corrected_type"))
    return review.apply_review(t.ce, reviews).select("id", "new_state", "new_format")


@query("format_correction_patterns", "SELECT coalesce(format_type, 'None') || ' -> Film' AS pattern, count(*) AS n, min(id) AS first_id FROM ce WHERE id % 6 = 0 GROUP BY 1")
def _(t):
    reviews = t.ce.where("id % 6 = 0").select("id", F.lit(1).alias("ord"), "llm_tier", F.lit("Film").alias("corrected_type")).withColumnRenamed("llm_tier", "tier")
    return review.correction_patterns(review.apply_review(t.ce, reviews))


@query("close_unprocessable", "SELECT id, CASE WHEN id % 5 = 0 THEN 'llm_rejected' ELSE pipeline_state END AS new_state FROM ce WHERE pipeline_state = 'pending_llm'")
def _(t):
    tier = F.when(F.col("id") % 5 == 0, "Couldn't Process")
    return review.close_unprocessable(t.ce, tier)


@query("review_stragglers", f"SELECT id FROM {_PENDING} WHERE id % 4 <> 0")
def _(t):
    return review.pending(t.ce.withColumn("llm_reviewed", F.when(F.col("id") % 4 == 0, "2024-01-16T00:00:00")), AS_OF).select("id")


@query("disagreements", f"SELECT id, CASE WHEN rr > rs THEN 'upgrade' ELSE 'downgrade' END AS direction FROM (SELECT id, CASE llm_tier WHEN 'Top Picks' THEN 4 WHEN 'Recommended' THEN 3 WHEN 'Borderline' THEN 2 ELSE 1 END AS rr, CASE {_TIER.format('score')} WHEN 'Top Picks' THEN 4 WHEN 'Recommended' THEN 3 ELSE 2 END AS rs FROM ce) WHERE rr <> rs")
def _(t):
    return review.disagreements(t.ce, scoring.tier(F.col("score")), F.col("llm_tier"))


_ACCEPTED = "(SELECT * FROM ce WHERE pipeline_state IN ('ready_to_write', 'written') AND llm_tier <> 'Not Recommended')"


@query("borderline_cap", f"SELECT id, llm_tier = 'Borderline' AND row_number() OVER (PARTITION BY llm_tier ORDER BY score, id) <= (SELECT CASE WHEN count(*) > 10 AND b / count(*) > 0.3 THEN least(b, ceil((b - 0.3 * count(*)) / 0.7 - 1e-9)) ELSE 0 END FROM {_ACCEPTED}, (SELECT count(*) AS b FROM {_ACCEPTED} WHERE llm_tier = 'Borderline') GROUP BY b) AS demoted FROM {_ACCEPTED}")
def _(t):
    return review.borderline_cap(t.ce.where("pipeline_state in ('ready_to_write', 'written')")).select("id", "demoted")


def _reasoned(t):
    said = F.when(F.col("id") % 2 == 0, "Too far, a long journey").otherwise("A fair event you attended")
    return t.ce.withColumn("reasoning", said).withColumn("known_before", F.col("id") % 3 == 0).withColumn("name", F.when(F.col("id") % 5 == 0, F.concat("name", F.lit(" farewell"))).otherwise(F.col("name")))


_HARD = "(regexp_matches(lower(name), '\\b(night 1|night 2|idiot|clown|part 4|night 33|attion|hash|pathetic|night 41|moron|trash)\\b') OR organiser IN ('logout', 'src7', 'src11'))"


@query("gates", f"SELECT id, CASE WHEN hard AND id % 2 = 0 AND id % 5 = 0 AND run_date = '2024-01-16' AND {_UP} THEN 'x' WHEN tier = 'Not Recommended' AND id % 2 = 0 AND id % 5 = 0 AND run_date = '2024-01-16' AND {_UP} THEN 'x' END IS NOT NULL AS recovered, NOT (id % 3 = 0 AND id % 2 = 0) AND hard AS keeps_rule FROM (SELECT *, {_HARD} AS hard, llm_tier AS tier FROM ce)")
def _(t):
    g = review.gates(_reasoned(t), AS_OF, "2024-01-16")
    return g.select("id", "recovered", F.col("reasoning").startswith("Hard rule").alias("keeps_rule"))


@query("past_pattern_notes", "SELECT id, id % 6 = 0 AS noted FROM ce")
def _(t):
    return review.gates(_reasoned(t), AS_OF, "2024-01-16").select("id", F.col("reasoning").endswith("been here before.").alias("noted"))


@query("travel_gaps", "SELECT id FROM ce WHERE llm_tier <> 'Not Recommended' AND venue_name IS NOT NULL AND id % 5 > 0")
def _(t):
    display = F.when(F.col("id") % 5 == 0, "9 min (transit)")
    return review.travel_gaps(t.ce, display).select("id")


@query("required_fields", "SELECT id, CASE WHEN id % 2 = 0 THEN 'name' ELSE '' END AS missing FROM ce WHERE pipeline_state = 'ready_to_write'")
def _(t):
    return review.required_fields(t.ce.withColumn("name", F.when(F.col("id") % 2 == 0, " ").otherwise(F.col("name"))))


@query("invented_url_gate", "SELECT page_id AS id, CASE page_id % 3 WHEN 0 THEN 'match' WHEN 1 THEN 'NOT_FOUND' ELSE 'skipped' END AS url_status FROM pg")
def _(t):
    rows = t.pg.select(F.col("page_id").alias("id"), "url", F.concat(F.lit("m"), "page_id").alias("message_id"))
    body = F.when(F.col("id") % 3 == 0, F.concat(F.lit("see "), "url", F.lit(" now"))).when(F.col("id") % 3 == 1, "see https://other.test/x").otherwise("no links here")
    return review.url_traced(rows, rows.select("message_id", body.alias("body_text")))


@query("fit_description", "SELECT id, length(fit) AS n, sha256(fit) AS fit_sha256 FROM (SELECT id, CASE WHEN length(description) > 2000 THEN concat(left(description, 1999), '…') ELSE description END AS fit FROM cd)")
def _(t):
    fit = t.cd.select("id", C.truncate_utf16(F.col("description"), 2000).alias("fit"))
    return fit.select("id", F.length("fit").alias("n"), F.sha2(F.col("fit").cast("binary"), 256).alias("fit_sha256"))


@query("artefact_guard", "SELECT id, CASE WHEN id % 4 = 0 THEN 'name' WHEN id % 6 = 0 THEN 'cost' END AS field FROM ce")
def _(t):
    name = F.when(F.col("id") % 4 == 0, "Jazz (Signal 31)").otherwise(F.col("name"))
    cost = F.when(F.col("id") % 6 == 0, "Past pattern: free").otherwise(F.col("cost"))
    return t.ce.select("id", review.artefact(name, F.lit(""), F.col("venue_name"), cost).alias("field"))


@query("thin_descriptions", "SELECT id, CASE WHEN id % 2 = 0 THEN 'proxy_blocked' ELSE 'url_follow' END AS strategy FROM cd WHERE length(description) < 200")
def _(t):
    url = F.when(F.col("id") % 2 == 0, "https://a.example.net/x").otherwise("https://a.example.org/x")
    return enrich.thin(t.cd.withColumn("url", url)).select("id", "strategy")


@query("enrichment_batches", "SELECT batch, count(*) AS n, min(id) AS first_id FROM (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 10 + 1 AS batch FROM cd WHERE length(description) < 200) GROUP BY batch")
def _(t):
    rows = enrich.thin(t.cd.withColumn("url", F.lit("https://a.org/x")))
    return review.numbered(rows, S.enrich_batch).groupBy("batch").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query("apply_enrichment", "SELECT id, CASE id % 4 WHEN 0 THEN 'enriched' WHEN 1 THEN 'skipped' WHEN 2 THEN 'failed' ELSE 'none' END AS outcome FROM cd")
def _(t):
    found = t.cd.where("id % 4 < 3").select("id", F.when(F.col("id") % 4 == 2, "Another").otherwise(F.col("name")).alias("name"), F.when(F.col("id") % 4 == 0, F.concat("description", F.lit(" &amp; more"))).otherwise("").alias("text"))
    found = found.withColumn("text", F.when(F.col("id") % 4 == 1, "x").otherwise(F.col("text")))
    return enrich.apply_found(t.cd, found).select("id", "outcome")


@query("fill_from_detail", "SELECT id, CASE WHEN id % 2 = 0 AND id % 3 = 0 THEN 'New venue' ELSE venue_name END AS venue_name, id % 2 = 0 AND id % 3 > 0 AS needs_enrichment FROM ce")
def _(t):
    fresh = t.ce.where("id % 3 = 0").select("id", F.lit("New venue").alias("venue_name"), F.lit(None).cast("string").alias("cost"))
    return enrich.fill_from_detail(t.ce.withColumn("needs_enrichment", F.col("id") % 2 == 0), fresh, "id", ["venue_name", "cost"]).select("id", "venue_name", "needs_enrichment")
