"""Queries of ingest and record linkage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import ingest, linkage
from ..settings import DEFAULT as S
from ..staging import new_folder
from .catalog import query

AS_OF = S.as_of.isoformat()
_UP = f"coalesce(end_date, date) >= '{AS_OF}'"


def detail(name, venue, shown, pounds):
    """A landed detail document with a rich-text note."""
    note = F.concat(F.lit('{"type":"doc","content":[{"type":"paragraph","content":[{"type":"text","text":"Hello "},{"type":"odd","content":[{"type":"text","text":'), F.to_json(F.struct(name.alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(name.alias("x")))) - 6), F.lit("}]}]}]}"))
    price = lambda p: F.struct(F.struct((p * 100).cast("long").alias("cents"), F.lit("gbp").alias("currency")).alias("price"), F.struct(((p + 5) * 100).cast("long").alias("cents"), F.lit("gbp").alias("currency")).alias("max_price"))
    geo = F.create_map(F.lit("mode"), F.when(shown, "shown").otherwise("obfuscated"), F.lit("address"), venue)
    return F.to_json(F.struct(note.alias("description_mirror"), F.struct(name.alias("name"), geo.alias("geo_address_info")).alias("event"), price(pounds).alias("ticket_info")))


@query("listing_filter", "SELECT id, date FROM ce WHERE source <> 'Luma' AND date <= '2024-01-20'")
def _(t):
    return ingest.listing_filter(t.ce.withColumn("location_type", F.when(F.col("source") == "Luma", "online").otherwise("offline")).withColumn("start_at", F.col("date")), "2024-01-20").select("id", "date")


@query("physical_only", "SELECT id FROM ce WHERE source = 'Meetup'")
def _(t):
    return ingest.physical_only(t.ce.withColumn("eventType", F.when(F.col("source") == "Meetup", "PHYSICAL").otherwise("ONLINE"))).select("id")


@query("window_filter", f"SELECT id FROM ce WHERE date BETWEEN '{AS_OF}' AND '2024-02-27' AND id % 50 <> 0")
def _(t):
    blurred = t.ce.withColumn("date", F.when(F.col("id") % 50 == 0, "soon").otherwise(F.col("date")))
    return ingest.window_filter(blurred, S.as_of, S.window_weeks).select("id")


@query("priority_union", "SELECT url, CASE WHEN max((run_date = '2024-01-09')::INT) = 1 THEN 'own' ELSE 'feed' END AS origin, count(*) FILTER (run_date = '2024-01-09') AS n_own FROM ce GROUP BY url")
def _(t):
    own, feed = t.ce.where("run_date = '2024-01-09'"), t.ce.where("run_date = '2024-01-16'")
    first = ingest.priority_union(own, feed, "url")
    return first.join(own.groupBy("url").agg(F.count("*").alias("n_own")), "url", "left").select("url", "origin", F.coalesce("n_own", F.lit(0)).alias("n_own"))


@query("ingest_nodes", "SELECT id, name, date, '12:30' AS time, concat_ws(', ', venue_name, 'Springfield') AS address, CASE WHEN id % 6 = 0 THEN 'Free' ELSE 'GBP ' || (id % 30) END AS cost FROM ce")
def _(t):
    venue = F.struct(F.col("venue_name").alias("name"), F.lit("").alias("address"), F.lit("Springfield").alias("city"))
    fee = F.when(F.col("id") % 6 != 0, F.struct((F.col("id") % 30).cast("double").alias("amount"), F.lit("GBP").alias("currency")))
    raw = t.ce.select(F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.col("name").alias("title"), F.concat("date", F.lit("T12:30Z")).alias("dateTime"), venue.alias("venue"), fee.alias("feeSettings"))).alias("raw"))
    return ingest.ingest_nodes(raw, S).select(F.col("id").cast("long").alias("id"), "name", "date", "time", "address", F.replace("cost", F.lit("£"), F.lit("GBP ")).alias("cost"))


@query("ingest_details", "SELECT id, 'Hello ' || name AS description, CASE WHEN id % 2 = 0 THEN venue_name END AS venue_name, '£' || (id % 7) || '–£' || (id % 7 + 5) AS cost FROM ce")
def _(t):
    return ingest.ingest_details(t.ce.select(F.col("id"), detail(F.col("name"), F.col("venue_name"), F.col("id") % 2 == 0, F.col("id") % 7).alias("raw"))).select("id", "description", "venue_name", "cost")


@query("quarantine_errors", "SELECT id, CASE WHEN id % 5 = 0 THEN 'rejected' WHEN id % 3 = 0 THEN 'warned' ELSE 'good' END AS outcome, CASE WHEN id % 5 = 0 OR id % 3 = 0 THEN 'a; b; c' END AS messages FROM ce")
def _(t):
    errors = F.when((F.col("id") % 5 == 0) | (F.col("id") % 3 == 0), F.array(*map(F.lit, "abcd")))
    return ingest.quarantine(t.ce.select("id", errors.alias("errors"), F.when(F.col("id") % 5 != 0, F.col("name")).alias("data"))).select("id", "outcome", "messages")


@query("source_health", "SELECT source, count(*) AS n, count(*) FILTER (id % 3 = 0) AS n_errors, count(*) FILTER (id % 3 = 0) <= count(*) / 2 AS ok FROM ce GROUP BY ALL")
def _(t):
    return ingest.source_health(t.ce.select("source", F.when(F.col("id") % 3 == 0, "timeout").alias("error")))


@query("ingest_extractions", f"SELECT id, 'Newsletter' AS source, 'pending_llm' AS pipeline_state, contains(url, 'lu.ma') AS needs_enrichment FROM ce WHERE {_UP} AND run_date = '2024-01-16' AND (name, date) NOT IN (SELECT (name, date) FROM ce WHERE run_date = '2024-01-09')")
def _(t):
    new = t.ce.where("run_date = '2024-01-16'").groupBy("source_snapshot").agg(F.collect_list(F.struct("id", "name", "date", "end_date", "url", F.lit("").alias("description"))).alias("candidates"))
    landed = new.select(F.col("source_snapshot").alias("message_id"), F.lit("s").alias("sender"), "candidates")
    return ingest.ingest_extractions(landed, t.ce.where("run_date = '2024-01-09'"), AS_OF).select("id", "source", "pipeline_state", "needs_enrichment")


@query("schema_contract", "SELECT 'id' AS column_name, 'ok' AS status, count(*) AS n FROM ce UNION ALL SELECT 'place_written', 'migrate', count(*) FROM ce UNION ALL SELECT 'props', 'ok', count(*) FROM ce UNION ALL SELECT 'url', 'forbidden', count(*) FROM ce")
def _(t):
    report = ingest.schema_contract(t.ce, required=["id"], migratable={"place_written": 0}, forbidden=["url", "props"])
    return report.join(F.broadcast(t.ce.agg(F.count("*").alias("n"))))


@query("migrate_columns", "SELECT id, 0 AS place_written, url FROM ce")
def _(t):
    return ingest.migrated(t.ce, {"place_written": 0, "url": ""}).select("id", "place_written", "url")


@query("append_candidates", "SELECT run_date, pipeline_state, count(*) AS n, count(DISTINCT id) AS n_ids, 0 AS n_lost FROM (SELECT run_date, id, 'pending_llm' AS pipeline_state FROM ce) GROUP BY ALL")
def _(t):
    """Both run dates are appended one after the other, then the table is read back."""
    path = new_folder(t.spark, "candidates")
    for run in ("2024-01-09", "2024-01-16"):
        ingest.append_candidates(t.ce.where(F.col("run_date") == run), path)
    back = t.spark.read.schema(ingest.as_new(t.ce).schema).parquet(path).withColumn("run_date", F.col("run_date").cast("string"))
    kept = F.get_json_object("source_snapshot", "$.id").cast("long") == F.col("id")
    return back.groupBy("run_date", "pipeline_state").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"), F.count_if(~kept).alias("n_lost"))


@query("snapshot_guard", "SELECT true AS lost_rows, 1 AS lost_run_dates, count(*) FILTER (run_date = '2024-01-16') AS n_new, count(*) AS n_old FROM ce")
def _(t):
    return ingest.snapshot_guard(t.ce.where("run_date = '2024-01-16'"), t.ce)


@query("freshness", "SELECT id, coalesce(id % 3 <> 0 AND date >= '2024-01-10', false) AS fresh FROM ce")
def _(t):
    written = F.when(F.col("id") % 3 == 0, "n/a").otherwise(F.concat("date", F.lit(" 00:00:00")))
    return t.ce.select("id", ingest.is_fresh(written, "2024-01-10 00:00:00").alias("fresh"))


def _page(**properties):
    """A landed board page: every property is an object under its kind, as the board returns it."""
    made = F.struct(*(v.alias(k.replace("_", " ")) for k, v in properties.items()))
    return F.struct(F.col("page_id").alias("id"), F.col("archived"), F.lit(False).alias("in_trash"), made.alias("properties"))


def _texts(kind, *parts):
    return F.struct(F.array(*(F.struct(p.alias("plain_text")) for p in parts)).alias(kind))


def _chosen(name):
    return F.struct(F.when(name.isNotNull(), F.struct(name.alias("name"))).alias("select"))


def _landed(rows, page):
    return rows.select(F.to_json(page, {"ignoreNullFields": "false"}).alias("raw"))


def _cards(t):
    n = F.substring("page_id", 6, 20).cast("long")
    page = _page(
        Event=_texts("title", F.substring("title", 1, 4), F.expr("substring(title, 5)")), Date=F.struct(F.struct(F.concat("date", F.lit("T19:00:00Z")).alias("start")).alias("date")), Verdict=_chosen(F.col("verdict")),
        Tier=_chosen(F.when(n % 3 == 0, "Top Picks").when(n % 3 == 1, "Borderline")), Reason_it_failed=_chosen(F.when(n % 4 == 0, "Too far")), Notes=_texts("rich_text", F.lit("seen "), n.cast("string")), To_delete=F.struct((n % 7 == 0).alias("checkbox")),
    )
    return _landed(t.bd, page)


@query("board_flatten", """
SELECT page_id, title, substr(date, 1, 10) AS date, verdict, CASE n % 3 WHEN 0 THEN 'Top Picks' WHEN 1 THEN 'Borderline' END AS tier, CASE WHEN n % 4 = 0 THEN 'Too far' END AS reason,
  concat('seen ', n) AS notes, n % 7 = 0 AS to_delete, archived, false AS in_trash FROM (SELECT *, CAST(substr(page_id, 6) AS BIGINT) AS n FROM bd)""")
def _(t):
    return ingest.board_flatten(_cards(t))


@query("board_runs", """
SELECT concat('run-', run_date, '-', source) AS page_id, concat(source, ' of ', run_date) AS batch, CASE source WHEN 'Luma' THEN '' ELSE 'Done' END AS status, CASE source WHEN 'Luma' THEN 0 ELSE count(*) END AS events_added,
  concat(count(*) FILTER (pipeline_state = 'write_failed'), ' failed; ', count(*), ' rows') AS issues, source AS pipeline, '' AS duration, run_date AS batch_date, 'schedule' AS trigger FROM ce GROUP BY source, run_date""")
def _(t):
    n, failed, luma = F.count("*"), F.count_if(F.col("pipeline_state") == "write_failed"), F.col("source") == "Luma"
    runs = t.ce.groupBy("source", "run_date").agg(n.alias("n"), failed.alias("failed")).withColumns({"page_id": F.concat(F.lit("run-"), "run_date", F.lit("-"), "source"), "archived": F.lit(False)})
    page = _page(
        Batch=_texts("title", F.col("source"), F.concat(F.lit(" of "), "run_date")), Status=_chosen(F.when(~luma, "Done")), Events_added=F.struct(F.when(~luma, F.col("n")).alias("number")),
        Issues=_texts("rich_text", F.col("failed").cast("string"), F.lit(" failed; "), F.concat(F.col("n").cast("string"), F.lit(" rows"))), Pipeline=_texts("rich_text", F.col("source")),
        Batch_date=F.struct(F.struct(F.col("run_date").alias("start")).alias("date")), Trigger=_chosen(F.lit("schedule")),
    )
    return ingest.board_flatten(_landed(runs, page), "run")


@query("board_findings", """
SELECT concat('finding-', organiser) AS page_id, concat('key:', organiser) AS finding_key, CASE WHEN count(*) % 2 = 0 THEN 'source_gap' ELSE 'venue_to_add' END AS type, concat(organiser, ' in January') AS title FROM ce GROUP BY organiser""")
def _(t):
    rows = t.ce.groupBy("organiser").agg(F.count("*").alias("n")).withColumns({"page_id": F.concat(F.lit("finding-"), "organiser"), "archived": F.lit(False)})
    several, even = F.array(F.struct(F.lit("Source-gap").alias("name")), F.struct(F.lit("other").alias("name"))), F.col("n") % 2 == 0
    kind = F.struct(F.when(even, several).alias("multi_select"), F.when(~even, F.struct(F.lit("Venue to add").alias("name"))).alias("select"))
    page = _page(Finding_key=_texts("rich_text", F.lit("key:"), F.col("organiser")), Finding_Type=kind, Month=_texts("title", F.concat("organiser", F.lit(" in January"))))
    return ingest.board_flatten(_landed(rows, page), "finding")


@query("board_property_kinds", "SELECT property, kind, (SELECT count(*) FROM bd) AS n FROM (VALUES ('Event', 'title'), ('Date', 'date'), ('Verdict', 'select'), ('Tier', 'select'), ('Reason it failed', 'select'), ('Notes', 'rich_text'), ('To delete', 'checkbox')) k(property, kind)")
def _(t):
    return ingest.property_kinds(_cards(t))


@query("step_log", "SELECT source AS step, max(id) AS last_id, arg_max(pipeline_state, id) AS outcome FROM ce GROUP BY ALL")
def _(t):
    return ingest.latest_steps(t.ce.select(F.col("source").alias("step"), F.col("pipeline_state").alias("outcome"), F.col("id").alias("at"))).withColumnRenamed("at", "last_id")


#: The new rows against all others: every row of ce is on one side.
_PENDING, _STORED = "(SELECT * FROM ce WHERE pipeline_state = 'pending_llm')", "(SELECT * FROM ce WHERE pipeline_state <> 'pending_llm')"


def _sides(t):
    return t.ce.where("pipeline_state = 'pending_llm'"), t.ce.where("pipeline_state <> 'pending_llm'")


@query("exact_dedup", f"SELECT n.id FROM {_PENDING} n WHERE url NOT IN (SELECT url FROM {_STORED}) AND (name, date) NOT IN (SELECT (name, date) FROM {_STORED})")
def _(t):
    return linkage.not_existing(*_sides(t)).select("id")


@query("exact_dedup_all_rows", f"SELECT n.id FROM {_PENDING} n WHERE url NOT IN (SELECT url FROM {_STORED}) AND (name, date) NOT IN (SELECT (name, date) FROM {_STORED})")
def _(t):
    return linkage.not_existing(*_sides(t)).select("id")


@query("exact_dedup_greedy")
def _(t):
    return linkage.greedy(linkage.keys(t.ce))


@query("reschedule", f"""
SELECT o.id, n.date, n.end_date, CASE WHEN o.pipeline_state IN ('expired', 'llm_rejected', 'vetoed') AND o.notion_page_id IS NULL THEN 'pending_llm' ELSE o.pipeline_state END AS pipeline_state
FROM (SELECT url, arg_max(struct_pack(date := date, end_date := end_date), id) AS r, max(id) AS i FROM {_PENDING} GROUP BY url) g JOIN {_PENDING} n ON n.id = g.i
JOIN (SELECT url, max(id) AS i FROM {_STORED} GROUP BY url) h ON h.url = g.url JOIN {_STORED} o ON o.id = h.i WHERE n.date <> o.date""")
def _(t):
    return linkage.reschedule(*_sides(t))


@query("reschedule_all_rows", f"""
SELECT o.id, n.date, n.end_date, CASE WHEN o.pipeline_state IN ('expired', 'llm_rejected', 'vetoed') AND o.notion_page_id IS NULL THEN 'pending_llm' ELSE o.pipeline_state END AS pipeline_state
FROM (SELECT url, max(id) AS i FROM {_PENDING} GROUP BY url) g JOIN {_PENDING} n ON n.id = g.i
JOIN (SELECT url, max(id) AS i FROM {_STORED} GROUP BY url) h ON h.url = g.url JOIN {_STORED} o ON o.id = h.i WHERE n.date <> o.date""")
def _(t):
    return linkage.reschedule(*_sides(t))


_PAIRS = f"""
SELECT a.id, b.id AS other_id, CASE WHEN starts_with(a.name, b.name) OR starts_with(b.name, a.name) THEN 'prefix'
  WHEN len(list_intersect(a.w, b.w)) / least(len(a.w), len(b.w)) >= 0.7 THEN 'word_overlap' END AS kind
FROM (SELECT *, list_distinct(regexp_extract_all(name, '\\w+')) AS w FROM ce WHERE pipeline_state = 'pending_llm' AND {_UP}) a
JOIN (SELECT *, list_distinct(regexp_extract_all(name, '\\w+')) AS w FROM ce WHERE pipeline_state NOT IN ('vetoed', 'expired', 'duplicate')) b ON a.date = b.date AND b.id < a.id"""


@query("fuzzy_pairs", f"SELECT * FROM ({_PAIRS}) WHERE kind IS NOT NULL")
def _(t):
    return linkage.fuzzy_pairs(t.ce, AS_OF)


@query("apply_duplicates", "SELECT id AS new_id, id - 1 AS duplicate_of, CASE WHEN id % 6 IN (1, 2) THEN 'invalid' WHEN id % 6 = 3 THEN 'kept' WHEN id % 6 = 0 THEN 'kept' WHEN pipeline_state <> 'pending_llm' THEN 'skipped' ELSE 'duplicate' END AS action FROM ce")
def _(t):
    said = F.element_at(F.array(F.lit("true"), F.lit("85"), F.lit("0.5"), F.lit('"0.85"'), F.lit("0.9"), F.lit(None)), (F.when(F.col("id") % 6 == 0, 6).otherwise(F.col("id") % 6)).cast("int"))
    return linkage.apply_duplicates(t.ce, t.ce.select(F.col("id").alias("new_id"), (F.col("id") - 1).alias("duplicate_of"), said.alias("confidence")))


@query("merge_multiday", f"""
WITH r AS (SELECT *, date::DATE - lag(date::DATE) OVER (PARTITION BY name, run_date ORDER BY date, id) AS gap FROM ce WHERE source = 'Newsletter' AND pipeline_state = 'pending_llm' AND {_UP}),
g AS (SELECT name, run_date, min(struct_pack(date := date, id := id)).id AS kept_id, max(greatest(date, coalesce(end_date, date))) AS end_date FROM r GROUP BY ALL
  HAVING count(*) >= 2 AND coalesce(max(gap), 0) <= 2 AND max(date::DATE) - min(date::DATE) <= 7 AND count(DISTINCT nullif(lower(trim(venue_name)), '')) <= 1)
SELECT id, kept_id, g.end_date, CASE WHEN id = kept_id THEN 'kept' ELSE 'duplicate' END AS role FROM r JOIN g USING (name, run_date)""")
def _(t):
    return linkage.merge_multiday(t.ce, AS_OF).select("id", "kept_id", "end_date", "role")


@query("calendar_dedup", "SELECT min(calendar_id) AS calendar_id, title, location, date FROM (SELECT *, row_number() OVER (PARTITION BY lower(title), date ORDER BY length(location) DESC, calendar_id) AS nth FROM cal) WHERE nth = 1 GROUP BY ALL")
def _(t):
    return linkage.calendar_dedup(t.cal)


_MATCH = """
SELECT calendar_id, id, rank, share FROM (SELECT *, row_number() OVER (PARTITION BY calendar_id ORDER BY rank DESC, share DESC, id) AS nth FROM (
  SELECT calendar_id, id, CASE WHEN venue AND share >= 0.6 THEN 2 WHEN venue OR share >= 0.6 THEN 1 ELSE 0 END AS rank, CASE WHEN venue OR share >= 0.4 THEN share ELSE 0 END AS share FROM (
    SELECT calendar_id, id, coalesce(venue_name <> '' AND contains(location, venue_name), false) AS venue, len(list_intersect(tw, nw)) / least(len(tw), len(nw)) AS share
    FROM (SELECT *, list_distinct(list_filter(string_split(lower(title), ' '), lambda x: length(x) > 1)) AS tw FROM cal) x
    JOIN (SELECT *, list_distinct(list_filter(string_split(name, ' '), lambda x: length(x) > 1)) AS nw FROM ce) y USING (date))) WHERE rank > 0) WHERE nth = 1"""


@query("calendar_match", f"SELECT calendar_id, id, CASE rank WHEN 2 THEN 'high' ELSE 'medium' END AS confidence, round(share, 6) AS overlap FROM ({_MATCH})")
def _(t):
    return linkage.calendar_match(t.cal, t.ce).withColumn("overlap", F.round("overlap", 6))


@query("source_gaps", f"SELECT calendar_id, title FROM cal WHERE calendar_id NOT IN (SELECT calendar_id FROM ({_MATCH}))")
def _(t):
    return linkage.source_gaps(t.cal, linkage.calendar_match(t.cal, t.ce)).select("calendar_id", "title")


@query("source_gaps_all_rows", f"SELECT calendar_id, title FROM cal WHERE calendar_id NOT IN (SELECT calendar_id FROM ({_MATCH}))")
def _(t):
    return linkage.source_gaps(t.cal, linkage.calendar_match(t.cal, t.ce)).select("calendar_id", "title")


@query("virtual_filter", "SELECT calendar_id, CASE calendar_id % 4 WHEN 0 THEN 'empty' WHEN 1 THEN 'virtual' WHEN 2 THEN 'personal' END AS reason FROM cal")
def _(t):
    place = F.when(F.col("calendar_id") % 4 == 0, "").when(F.col("calendar_id") % 4 == 1, "https://Zoom.us/j/1").otherwise(F.col("location"))
    title = F.when(F.col("calendar_id") % 4 == 2, "GP check-up").otherwise(F.col("title"))
    return t.cal.select("calendar_id", ingest.calendar_reason(title, place).alias("reason"))


_ORPHANS = """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY title, date ORDER BY page_id) AS nth FROM bd WHERE page_id NOT IN (SELECT notion_page_id FROM ce WHERE notion_page_id IS NOT NULL)),
f AS (SELECT id, name, date, row_number() OVER (PARTITION BY name, date ORDER BY CASE pipeline_state WHEN 'ready_to_write' THEN 0 WHEN 'write_failed' THEN 1 ELSE 2 END, id) AS nth FROM ce WHERE notion_page_id IS NULL),
j AS (SELECT o.*, f.id, EXISTS (SELECT 1 FROM ce c WHERE c.notion_page_id IS NOT NULL AND c.name = o.title AND c.date = o.date) AS tracked FROM o LEFT JOIN f ON o.title = f.name AND o.date = f.date AND o.nth = f.nth)
SELECT page_id, id, CASE WHEN id IS NOT NULL THEN 'matched' WHEN tracked OR row_number() OVER (PARTITION BY title, date, id IS NULL ORDER BY page_id) > 1 THEN 'duplicate' ELSE 'stub' END AS action FROM j"""


@query("orphan_recovery", _ORPHANS)
def _(t):
    return linkage.orphan_recovery(t.bd, t.ce)


@query("date_drift", f"SELECT id, CASE WHEN k % 5 = 0 THEN 'not found' WHEN k % 7 = 0 THEN 'error' ELSE 'changed' END AS status FROM (SELECT *, regexp_extract(url, '(\\d+)$', 1)::INT AS k FROM ce) WHERE {_UP} AND source IN ('Meetup', 'Luma') AND verdict IN ('Going', 'Maybe', 'Undecided')")
def _(t):
    facts = t.ce.select(C.url_key(F.col("url")).alias("url_key"), F.regexp_extract("url", r"(\d+)$", 1).cast("int").alias("k")).distinct().where("k % 5 <> 0")
    fresh = facts.select("url_key", F.when(F.col("k") % 7 != 0, "2025-01-01").alias("date"), F.lit(None).cast("string").alias("time"), F.lit(None).cast("string").alias("end_date"))
    return linkage.date_drift(t.ce, fresh, AS_OF).select("id", "status")


@query("snapshot_compare", "SELECT id, id % 4 = 0 AS name_differs, id % 6 = 0 AS url_differs FROM ce")
def _(t):
    title = F.when(F.col("id") % 4 == 0, "Other").otherwise(F.concat(F.lit(" "), "name"))
    url = F.when(F.col("id") % 6 == 0, "https://lu.ma/other").otherwise(F.concat("url", F.lit("?x")))
    return linkage.snapshot_compare(t.ce, title, url)
