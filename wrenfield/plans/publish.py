"""Queries of change sets and of newsletter messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import board, ingest, mail, publish
from ..settings import DEFAULT as S
from .catalog import query
from .linkage import _ORPHANS, _UP, AS_OF, _cards

_READY = "(SELECT * FROM ce WHERE pipeline_state = 'ready_to_write')"


@query("board_cards", f"SELECT id, name, CASE WHEN end_date IS NULL THEN date || 'T' || time || ':00+00:00' ELSE date END AS start_at, venue_name FROM {_READY}")
def _(t):
    c = publish.cards(t.ce)
    return c.select("id", *(F.get_json_object("card", p).alias(n) for n, p in (("name", "$.Name"), ("start_at", "$.Date.start"), ("venue_name", "$.Venue"))))


_PROPERTIES = {
    "event": "$.Event.title[0].text.content", "start_at": "$.Date.date.start", "end_at": "$.Date.date.end", "time_of_day": "$['Time of day'].rich_text[0].text.content", "month": "$.Month.select.name", "tier": "$.Tier.select.name",
    "score": "$.Score.number", "type": "$.Type.select.name", "added": "$.Added.date.start", "batch": "$.Batch.select.name", "venue": "$.Venue.rich_text[0].text.content", "cost": "$.Cost.rich_text[0].text.content",
    "description": "$.Description.rich_text[0].text.content", "link": "$.Link.url", "source": "$.Source.select.name", "travel": "$['Travel from home'].rich_text[0].text.content", "verdict": "$.Verdict.select.name", "place": "$.Place.place",
}


@query("board_properties", f"""
WITH v AS (SELECT venue_name, max(travel_transit_min) AS m FROM ve GROUP BY venue_name)
SELECT id, name AS event, CASE WHEN end_date IS NULL THEN date || 'T' || time || ':00+00:00' ELSE date END AS start_at, end_date AS end_at, time AS time_of_day, strftime(date::DATE, '%B') AS month, llm_tier AS tier, CAST(score AS VARCHAR) AS score,
  coalesce(format_type, 'Other') AS type, '2024-01-16' AS added, '16 Jan' AS batch, c.venue_name AS venue, cost, CASE WHEN id % 2 = 0 THEN concat('About ', name) END AS description, url AS link, source,
  CASE WHEN id % 3 > 0 THEN concat(travel_transit_min, ' min (transit)') WHEN c.venue_name IS NULL THEN 'Venue unknown' ELSE 'Route unavailable' END AS travel, 'Undecided' AS verdict,
  CASE WHEN date >= '2024-01-12' AND v.m IS NOT NULL THEN concat('{{"name":"', c.venue_name, '","address":"', CASE WHEN v.m % 2 = 0 THEN 'At ' || v.venue_name ELSE 'AB1 2CD' END, '","lat":', CAST(v.m AS VARCHAR), '.5,"lon":-0.25}}') END AS place
FROM {_READY} c LEFT JOIN v ON v.venue_name = lower(trim(c.venue_name))""")
def _(t):
    """Every property of every ready row."""
    i = F.col("id")
    rows = t.ce.withColumns({"venue_postcode": F.lit("AB1 2CD"), "description": F.when(i % 2 == 0, F.concat(F.lit("About "), "name")), "travel_display": F.when(i % 3 > 0, F.concat(F.col("travel_transit_min").cast("string"), F.lit(" min (transit) · 9 min (walk)")))})
    m = F.col("m")
    at = {"venue_lat": m + F.lit(0.5), "venue_lon": F.lit(-0.25), "formatted_address": F.when(m % 2 == 0, F.concat(F.lit("At "), "venue_name")), "lookup_date": F.lit("2024-01-01"), "venue_postcode": F.lit(None).cast("string")}
    venues = t.ve.groupBy("venue_name").agg(F.max("travel_transit_min").alias("m")).withColumns(at)
    made = board.properties(rows, venues, S.as_of, "2024-01-12")
    return made.select("id", *(F.get_json_object("properties", p).alias(k) for k, p in _PROPERTIES.items()))


def _pages(t):
    n = F.substring("page_id", 6, 20).cast("long")
    return ingest.board_flatten(_cards(t)).withColumn("in_trash", n % 11 == 0).withColumn("verdict", F.when(n % 17 == 0, "Later").otherwise(F.col("verdict")))


_PAGES = """(SELECT page_id, title, date, archived, n % 11 = 0 AS in_trash, n % 7 = 0 AS to_delete, CASE WHEN n % 17 = 0 THEN 'Later' ELSE verdict END AS verdict, CASE WHEN n % 4 = 0 THEN 'Too far' END AS reason, concat('seen ', n) AS notes
FROM (SELECT *, CAST(substr(page_id, 6) AS BIGINT) AS n FROM bd))"""


@query("board_changes", f"""
WITH c AS (SELECT *, CASE WHEN id % 2 = 0 THEN 'active' END AS old_status, CASE WHEN id % 8 = 0 THEN 'Too far' END AS old_reason, CASE WHEN id % 3 = 0 THEN concat('seen ', id) END AS old_notes FROM ce WHERE notion_page_id IS NOT NULL),
j AS (SELECT c.id, p.page_id, CASE WHEN in_trash THEN 'deleted' WHEN p.archived THEN 'archived' WHEN to_delete THEN 'flagged_delete' ELSE 'active' END AS s, c.*, p.verdict AS nv, p.reason AS nr, p.notes AS nn FROM c FULL JOIN {_PAGES} p ON p.page_id = c.notion_page_id),
k AS (SELECT id, page_id, CASE WHEN s IS DISTINCT FROM old_status THEN s END AS status, CASE WHEN nv IS DISTINCT FROM verdict THEN nv END AS verdict, CASE WHEN nr IS DISTINCT FROM old_reason THEN nr END AS reason, CASE WHEN nn IS DISTINCT FROM old_notes THEN nn END AS notes FROM j WHERE id IS NOT NULL AND page_id IS NOT NULL)
SELECT id, page_id, 'update' AS kind, status, verdict, reason, notes FROM k WHERE coalesce(status, verdict, reason, notes) IS NOT NULL
UNION ALL SELECT id, NULL, 'gone', 'gone', NULL, NULL, NULL FROM j WHERE page_id IS NULL UNION ALL SELECT NULL, page_id, 'untracked', NULL, NULL, NULL, NULL FROM j WHERE id IS NULL""")
def _(t):
    i = F.col("id")
    rows = t.ce.withColumns({"notion_status": F.when(i % 2 == 0, "active"), "verdict_reason": F.when(i % 8 == 0, "Too far"), "verdict_notes": F.when(i % 3 == 0, F.concat(F.lit("seen "), i.cast("string")))})
    return board.reconcile_changes(rows, _pages(t))


@query("verdict_changes", f"""
SELECT id, CASE WHEN p.page_id IS NULL THEN 'missing' WHEN p.verdict IS NULL THEN 'no_verdict' WHEN p.verdict = 'Later' THEN 'error' ELSE 'synced' END AS outcome, CASE WHEN p.verdict <> 'Later' THEN p.verdict END AS verdict, CASE WHEN p.verdict <> 'Later' THEN p.reason END AS reason,
  CASE WHEN p.verdict <> 'Later' THEN p.notes END AS notes, CASE WHEN p.verdict <> 'Later' THEN '2024-01-16 08:00' END AS synced_at
FROM ce c LEFT JOIN {_PAGES} p ON p.page_id = c.notion_page_id WHERE c.notion_page_id IS NOT NULL AND id % 5 > 0 AND coalesce(c.end_date, c.date) < '2024-01-15'""")
def _(t):
    rows = t.ce.withColumn("synced_at", F.when(F.col("id") % 5 == 0, "2024-01-01 08:00"))
    return board.verdict_changes(rows, _pages(t), AS_OF, "2024-01-16 08:00")


@query("orphan_changes", f"""
WITH a AS ({_ORPHANS})
SELECT CASE action WHEN 'matched' THEN 'update' WHEN 'stub' THEN 'insert' ELSE 'report' END AS op, id, page_id, CASE WHEN action = 'stub' THEN '2024-01-16' END AS run_date, CASE WHEN action = 'stub' THEN title END AS name, CASE WHEN action = 'stub' THEN date END AS date,
  CASE WHEN action = 'stub' THEN 'manual' END AS source, CASE WHEN action = 'stub' THEN 0 END AS score, CASE WHEN action = 'stub' THEN 'Manual' END AS tier, CASE WHEN action <> 'duplicate' THEN 'written' END AS pipeline_state,
  CASE WHEN action <> 'duplicate' THEN 'active' END AS notion_status, CASE WHEN action = 'stub' THEN 1 END AS travel_lookup_failed, CASE WHEN action = 'duplicate' THEN 'duplicate' END AS reason FROM a JOIN bd USING (page_id)""")
def _(t):
    return board.orphan_changes(t.bd, t.ce, AS_OF)


@query("board_body", f"SELECT id, concat('paragraph: ', CASE WHEN id % 4 = 0 THEN 'TBC' ELSE concat('About ', name) END, CASE WHEN venue_name IS NOT NULL THEN concat(' | venue: ', venue_name) ELSE '' END, ' | cost: ', cost, ' | link: ', url) AS blocks FROM {_READY}")
def _(t):
    rows = t.ce.withColumn("description", F.when(F.col("id") % 4 > 0, F.concat(F.lit("About "), "name")))
    return publish.body(rows).select("id", F.array_join(F.transform("blocks", lambda b: F.concat_ws(": ", b["kind"], b["text"])), " | ").alias("blocks"))


@query("publish_plan", f"SELECT id, CASE WHEN p.page_id IS NULL THEN 'create' ELSE 'adopt' END AS action, p.page_id FROM {_READY} r LEFT JOIN (SELECT title, date, min(page_id) AS page_id FROM bd GROUP BY ALL) p ON p.title = r.name AND p.date = r.date")
def _(t):
    return publish.publish_plan(t.ce, t.bd)


_SHOWN = f"(SELECT * FROM ce WHERE {_UP} AND verdict IN ('Going', 'Maybe', 'Undecided'))"


@query("calendar_diff", f"SELECT id, CASE WHEN id IN (SELECT id FROM {_SHOWN}) THEN CASE id % 3 WHEN 0 THEN 'create' WHEN 1 THEN 'update' ELSE 'unchanged' END ELSE 'delete' END AS action FROM ce WHERE id IN (SELECT id FROM {_SHOWN}) OR id % 3 > 0")
def _(t):
    own = C.content_hash({c: F.col(c) for c in ("name", "date", "end_date", "time", "venue_name", "cost", "url", "verdict")})
    synced = t.ce.where("id % 3 > 0").select("id", F.when(F.col("id") % 3 == 1, "old").otherwise(own).alias("content_hash"))
    return publish.calendar_diff(t.ce, synced, AS_OF)


@query("board_reconcile", """
SELECT c.id, b.page_id, CASE WHEN c.id IS NULL THEN 'untracked' WHEN b.page_id IS NULL THEN 'gone' WHEN b.archived THEN 'archived' ELSE 'active' END AS status, CASE WHEN b.verdict IS DISTINCT FROM c.verdict AND b.verdict IS NOT NULL THEN b.verdict END AS verdict
FROM (SELECT * FROM ce WHERE notion_page_id IS NOT NULL) c FULL JOIN bd b ON b.page_id = c.notion_page_id""")
def _(t):
    return publish.reconcile(t.ce, t.bd)


@query("calendar_body", "SELECT id, CASE verdict WHEN 'Going' THEN '✔ ' WHEN 'Maybe' THEN '? ' ELSE '' END || name AS title, CASE WHEN end_date IS NULL THEN date || ' ' || time ELSE date END AS start_at, CASE WHEN end_date IS NULL THEN strftime((date || ' ' || time || ':00')::TIMESTAMP + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M') ELSE (end_date::DATE + 1)::VARCHAR END AS end_at FROM ce")
def _(t):
    return publish.calendar_body(t.ce)


@query("verdict_sync", "SELECT c.id, CASE WHEN b.page_id IS NULL THEN 'missing' WHEN b.verdict IS NULL THEN 'unsynced' ELSE 'synced' END AS outcome, b.verdict AS new_verdict FROM ce c LEFT JOIN bd b ON b.page_id = c.notion_page_id WHERE c.notion_page_id IS NOT NULL AND coalesce(c.end_date, c.date) < '2024-01-15'")
def _(t):
    return publish.verdict_sync(t.ce, t.bd, AS_OF)


@query("archive_plan", "SELECT c.id, CASE WHEN b.page_id IS NULL THEN 'missing' WHEN b.archived THEN 'already archived' ELSE 'archive' END AS action FROM ce c LEFT JOIN bd b ON b.page_id = c.notion_page_id WHERE c.notion_page_id IS NOT NULL AND coalesce(c.end_date, c.date) < '2024-01-10'")
def _(t):
    return publish.archive_plan(t.ce, t.bd, "2024-02-09")


@query("backfill_plans", "SELECT k AS patch_kind, id FROM ce, (SELECT unnest(['source_detail', 'travel', 'place', 'type']) AS k) WHERE notion_page_id IS NOT NULL AND (k = 'type' OR k = 'travel' OR k = 'place' AND venue_name IS NOT NULL OR k = 'source_detail' AND source = 'Newsletter')")
def _(t):
    return publish.backfill_plans(t.ce)


@query("remediation_plan", "SELECT id, 'patch' AS action FROM ce WHERE run_date = '2024-01-16' AND notion_page_id IS NOT NULL")
def _(t):
    return publish.remediation_plan(t.ce, "2024-01-16")


@query("finding_cards", "SELECT 'organiser:' || organiser AS finding_key, upper(substr(organiser, 1, 1)) || substr(organiser, 2) AS title, 'Organiser, Series' AS types, min(date) || '–' || max(date) AS period, count(*) AS evidence FROM ce GROUP BY organiser")
def _(t):
    f = t.ce.groupBy("organiser").agg(F.collect_set("date").alias("dates"), F.count("*").alias("evidence"))
    return publish.finding_cards(f.select(F.concat(F.lit("organiser:"), "organiser").alias("finding_key"), F.lit("organiser").alias("type"), F.array(F.lit("series"), F.lit("organiser")).alias("types"), "dates", "evidence"))


@query("unprocessed_emails", "SELECT message_id FROM em WHERE message_id NOT LIKE '%-0'")
def _(t):
    return mail.unprocessed(t.em, t.em.where("message_id like '%-0'")).select("message_id")


@query("record_emails", "SELECT message_id, CASE WHEN message_id LIKE '%-1' THEN 'old' ELSE 'new' END AS sender, sha256(body_text) AS body FROM em")
def _(t):
    state = t.em.where("message_id not like '%-2'").withColumn("sender", F.lit("old"))
    new = t.em.where("message_id not like '%-1'").withColumn("sender", F.lit("new")).withColumn("body_text", F.when(F.col("message_id").like("%-2"), F.col("body_text")))
    return mail.record(state, new).select("message_id", "sender", F.sha2("body_text", 256).alias("body"))


@query("record_batch", "SELECT message_id, CASE WHEN message_id LIKE '%-0' THEN 'meta' WHEN message_id LIKE '%-1' THEN sender END AS sender, CASE WHEN message_id LIKE '%-0' THEN events_extracted WHEN message_id LIKE '%-1' THEN 1 ELSE 0 END AS n FROM em WHERE message_id NOT LIKE '%-3'")
def _(t):
    extracted = t.em.where("message_id like '%-1' or message_id like '%-0'").select("message_id", F.col("sender").alias("organiser"), F.lit(1).alias("ord"))
    meta = t.em.where("message_id like '%-0'").select("message_id", F.lit("meta").alias("sender"), "events_extracted")
    return mail.record_batch(extracted, meta, t.em.select("message_id"), t.em.where("message_id like '%-3'"))


@query("track_senders", "SELECT sender, sum(events_extracted) + CASE WHEN sender = 'sender1' THEN 10 ELSE 0 END AS events, count(*) + CASE WHEN sender = 'sender1' THEN 2 ELSE 0 END AS emails, max(email_date) AS last_seen FROM em GROUP BY sender UNION ALL SELECT 'gone', 1, 1, '2023-12-01' FROM (SELECT count(*) FROM em)")
def _(t):
    state = t.spark.createDataFrame([("sender1", 10, 2, "2023-12-01"), ("gone", 1, 1, "2023-12-01")], "sender string, events long, emails long, last_seen string")
    return mail.track_senders(state, t.em)


@query("active_senders", "SELECT sender, sum(events_extracted) AS events, sender NOT IN ('sender1', 'sender2') AS active FROM em GROUP BY sender")
def _(t):
    state = t.spark.createDataFrame([], "sender string, events long, emails long, last_seen string")
    left = t.em.where("sender IN ('sender1', 'sender2')").select("sender")
    return mail.active(mail.track_senders(state, t.em), left).select("sender", "events", "active")


@query("recent_emails", "SELECT message_id, email_date FROM em WHERE email_date >= '2024-01-09'")
def _(t):
    return mail.recent(t.em, AS_OF, 7).select("message_id", "email_date")


@query("repair_body", "SELECT message_id, CASE WHEN message_id LIKE '%-0' THEN 'fixed' ELSE substr(body_text, 1, 9) END AS body, CASE WHEN message_id LIKE '%-0' THEN NULL ELSE 'flagged' END AS qa_status FROM em")
def _(t):
    fixes = t.em.where("message_id like '%-0'").select("message_id", F.lit("fixed").alias("body_text"))
    return mail.repair_body(t.em.withColumn("qa_status", F.lit("flagged")), fixes).select("message_id", F.substring("body_text", 1, 9).alias("body"), "qa_status")


@query("discovery_candidates", "SELECT sender, arg_min(message_id, message_id) AS message_id, email_date FROM em JOIN (SELECT sender, max(email_date) AS email_date FROM em GROUP BY sender) USING (sender, email_date) WHERE sender <> 'sender2' GROUP BY ALL")
def _(t):
    return mail.discovery(t.em, t.em.where("sender = 'sender2'").select("sender").distinct())


@query("extraction_trace", "SELECT id, CASE WHEN id % 3 = 0 THEN 'NOT_FOUND' ELSE 'match' END AS name_status, CASE WHEN id % 2 = 0 THEN 'match' ELSE 'NOT_FOUND' END AS date_status, CASE WHEN venue_name IS NULL THEN 'skipped' WHEN id % 5 = 0 THEN 'match' ELSE 'NOT_FOUND' END AS venue_status FROM ce")
def _(t):
    rows = t.ce.select("id", "name", "date", "venue_name", F.concat(F.lit("m"), "id").alias("message_id"))
    body = F.concat(F.when(F.col("id") % 5 == 0, F.concat(F.coalesce("venue_name", F.lit("")), F.lit(": "))).otherwise(""), F.when(F.col("id") % 3 == 0, "Jazz").otherwise(F.upper("name")), F.lit(" on "), F.when(F.col("id") % 2 == 0, F.concat(F.date_format(F.col("date").cast("date"), "d MMMM"), F.lit(" at 8"))).otherwise("Friday"))
    return mail.extraction_trace(rows, rows.select("message_id", body.alias("body_text"))).select("id", "name_status", "date_status", "venue_status")


@query("extraction_fields", """
WITH r AS (SELECT *, CASE WHEN id % 3 = 0 THEN 'NOT_FOUND' ELSE 'match' END AS n, CASE WHEN id % 4 IN (0, 1) THEN 'match' ELSE 'NOT_FOUND' END AS d,
  CASE WHEN venue_name IS NULL THEN 'skipped' WHEN id % 5 = 0 THEN 'match' ELSE 'NOT_FOUND' END AS v, CASE id % 7 % 3 WHEN 0 THEN 'match' WHEN 1 THEN 'NOT_FOUND' ELSE 'skipped' END AS u FROM ce)
SELECT id, CASE WHEN id % 13 = 0 THEN 'NOT_FOUND' ELSE n END AS name_status, CASE WHEN id % 13 = 0 THEN 'NOT_FOUND' ELSE d END AS date_status, CASE WHEN id % 13 = 0 AND v = 'match' THEN 'NOT_FOUND' ELSE v END AS venue_status,
  CASE WHEN id % 13 = 0 THEN 'skipped' ELSE u END AS url_status, CASE WHEN id % 13 = 0 THEN 'skipped' WHEN 'NOT_FOUND' IN (n, d, v, u) THEN 'mismatch' ELSE 'ok' END AS row_status FROM r""")
def _(t):
    """Dates stand alone, within a span, beside two others, or not at all; some rows have no message."""
    i, day = F.col("id"), F.dayofmonth(F.col("date").cast("date"))
    month, short = F.date_format(F.col("date").cast("date"), " MMMM"), F.date_format(F.col("date").cast("date"), " MMM")
    text = lambda *parts: F.concat(*(p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts))
    span = F.when(i % 8 == 1, text(F.greatest(day - 1, F.lit(1)), "–", F.least(day + 2, F.lit(31)), short)).otherwise(text("from ", F.greatest(day - 2, F.lit(1)), " to ", F.least(day + 1, F.lit(31)), month))
    when = F.when(i % 4 == 0, text(day, month, " at 8")).when(i % 4 == 1, span).when(i % 4 == 2, text(day + 1, " & ", day + 3, short)).otherwise("Friday")
    link = F.when(i % 7 % 3 == 0, text(" see ", F.col("url"), " now")).when(i % 7 % 3 == 1, " see https://other.test/x").otherwise("")
    body = F.concat(F.when(i % 5 == 0, F.concat(F.coalesce("venue_name", F.lit("")), F.lit(": "))).otherwise(""), F.when(i % 3 == 0, "Jazz").otherwise(F.upper("name")), F.lit(" on "), when, link)
    rows = t.ce.select("id", "name", "date", "venue_name", "url", F.concat(F.lit("m"), "id").alias("message_id"))
    return mail.trace_fields(rows, t.ce.where(i % 13 != 0).select(F.concat(F.lit("m"), "id").alias("message_id"), body.alias("body_text"))).drop("message_id")


@query("newsletter_prompts", """
WITH r AS (SELECT id, name, date, venue_name, url, concat('m', id % 60, '-', id % 2) AS message_id, CASE WHEN id % 3 = 0 THEN '(from the page: not to be compared)' ELSE left(concat(name, ' "', organiser, '" £'), 200) END AS description FROM ce),
lines AS (SELECT message_id, count(*) AS n_rows, string_agg(CAST(json_object('id', id, 'name', name, 'date', date, 'venue', venue_name, 'url', url, 'description', description) AS VARCHAR), chr(10) ORDER BY id) AS lines FROM r GROUP BY message_id)
SELECT message_id, n_rows, sha256(concat('Which of these rows does the message support? Answer with one JSON object per row: id, and for name, date, venue, url and description whether they match.', chr(10), chr(10), 'ROWS', chr(10), lines, chr(10), chr(10), 'MESSAGE', chr(10),
  CASE WHEN length(body_text) > 300 THEN concat(left(body_text, 299), '…') ELSE body_text END)) AS prompt_sha256 FROM lines JOIN em USING (message_id) WHERE trim(coalesce(body_text, '')) <> ''""")
def _(t):
    """One prompt for each message with rows; its text is cut at 300 units."""
    i = F.col("id")
    rows = t.ce.select("id", "name", "date", "venue_name", "url", F.concat(F.lit("m"), i % 60, F.lit("-"), i % 2).alias("message_id"), F.concat("name", F.lit(' "'), "organiser", F.lit('" £')).alias("description"), F.when(i % 3 == 0, "page").alias("description_source"))
    made = mail.prompts(t.em, rows, t.em, 300)
    return made.select("message_id", "n_rows", F.sha2(F.col("prompt").cast("binary"), 256).alias("prompt_sha256"))


_SECOND_PASS = "SELECT message_id, n, bad FROM (SELECT 'm' || (id // 5) || '-' || (id % 5 // 3) AS message_id, count(*) AS n, count(*) FILTER (id % 7 = 0 OR id % 11 = 0) AS bad FROM ce GROUP BY 1) WHERE bad > 0 OR n >= 3"


def second_pass(t):
    rows = t.ce.select("id", "name", "date", F.concat(F.lit("m"), "id").alias("message_id"))
    body = F.concat(F.when(F.col("id") % 7 == 0, "Jazz").otherwise(F.upper("name")), F.lit(" on "), F.when(F.col("id") % 11 == 0, "Friday").otherwise(F.date_format(F.col("date").cast("date"), "d MMMM")))
    # messages hold three or two rows each, so that their number grows with the table
    key = F.concat(F.lit("m"), F.expr("id div 5"), F.lit("-"), F.expr("id % 5 div 3"))
    return mail.second_pass(mail.extraction_trace(rows, rows.select("message_id", body.alias("body_text"))).withColumn("message_id", key))


@query("second_pass_emails", _SECOND_PASS)
def _(t):
    return second_pass(t)


@query("second_pass_emails_all_rows", _SECOND_PASS)
def _(t):
    return second_pass(t)


@query("email_flags", "SELECT message_id, CASE WHEN message_id LIKE '%-0' THEN 'skipped' ELSE 'flagged' END AS qa_status FROM em")
def _(t):
    return mail.flags(t.em.withColumn("qa_status", F.when(F.col("message_id").like("%-0"), "flagged"))).select("message_id", "qa_status")
