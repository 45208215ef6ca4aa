"""Queries of reports and of the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import digest, evidence, gates, linkage, packs, reports, rules, scoring
from ..settings import DEFAULT as S
from ..staging import new_folder, staged
from ..streaming import jobs
from ..streaming.snapshot import STORED
from ..versions import Versions
from .catalog import query
from .linkage import _MATCH, _UP, AS_OF

_DONE = ", ".join(f"count(*) FILTER (pipeline_state = '{s}') AS {s}" for s in reports.DONE)
_OPEN = ", ".join(f"count(*) FILTER (pipeline_state = '{s}' AND {_UP}) AS {s}" for s in reports.OPEN)
_FUNNEL = f"SELECT run_date, count(*) AS total, {_DONE}, {_OPEN} FROM ce GROUP BY run_date"


@query("funnel", _FUNNEL)
def _(t):
    return reports.funnel(t.ce, AS_OF)


@query("run_status", f"SELECT run_date, 'Partial' AS status, concat_ws('; ', pending_llm || ' pending_llm', pending_travel || ' pending_travel', ready_to_write || ' ready_to_write', write_failed || ' write_failed') AS issues FROM ({_FUNNEL})")
def _(t):
    return reports.run_status(reports.funnel(t.ce, AS_OF))


@query("sender_rollup", "SELECT sender, sum(events_extracted) AS events, string_agg(DISTINCT email_date, ',' ORDER BY email_date) AS dates FROM em WHERE sender <> 'sender3' GROUP BY sender")
def _(t):
    return reports.sender_rollup(t.em, ("sender3",))


@query("run_log_line", "SELECT source AS step, CASE source WHEN 'Luma' THEN 'Luma: no data' WHEN 'Meetup' THEN '(stale) Meetup: ' || count(*) ELSE source || ': ' || count(*) END AS line FROM ce GROUP BY source")
def _(t):
    m = t.ce.groupBy(F.col("source").alias("step")).agg(F.count("*").alias("n"))
    m = m.select("step", F.when(F.col("step") != "Luma", F.col("n")).alias("value"), F.when(F.col("step") == "Meetup", "2024-01-01 00:00:00").otherwise("2024-01-16 08:00:00").alias("written_at"))
    return reports.log_line(m, "2024-01-16 00:00:00")


def _matched(t):
    """Matched candidates with the calendar row; the others are left out before the join."""
    found = staged(linkage.calendar_match(t.cal, t.ce).select("calendar_id", "id"))
    return linkage.asked(t.ce, found, found.count(), "id").join(found, "id")


_JOINED = f"(SELECT c.*, m.calendar_id FROM ce c JOIN ({_MATCH}) m USING (id))"


@query("confirmed_interests", f"SELECT calendar_id, id, CASE WHEN verdict IN ('Going', 'Maybe') THEN 'confirmed' WHEN verdict = 'Not Going' THEN 'conflict' WHEN verdict IS NULL THEN 'unreviewed' END AS class, llm_tier AS tier FROM {_JOINED}")
def _(t):
    return _matched(t).select("calendar_id", "id", reports.verdict_class(F.col("verdict")).alias("class"), reports.shown_tier(F.col("llm_tier"), F.lit("x")).alias("tier"))


_CASES = "CASE WHEN pipeline_state = 'vetoed' THEN 'false_veto' WHEN pipeline_state = 'expired' THEN 'expired_but_attended' WHEN pipeline_state = 'llm_rejected' THEN 'false_llm_reject' WHEN verdict = 'Going' AND llm_tier IN ('Borderline', 'Not Recommended') THEN 'tier_mismatch' WHEN verdict = 'Not Going' AND llm_tier IN ('Top Picks', 'Recommended') THEN 'over_recommended' END"


@query("scoring_corrections", f"SELECT calendar_id, id, {_CASES} AS correction FROM {_JOINED}")
def _(t):
    return _matched(t).select("calendar_id", "id", reports.correction(F.col("pipeline_state"), F.col("verdict"), F.col("llm_tier")).alias("correction"))


_SEEN = f"(SELECT DISTINCT id, coalesce(format_type, 'Other') AS format, venue_name, organiser FROM {_JOINED})"
_INTEREST = f"""
SELECT 'format' AS kind, format AS value, count(*) AS n FROM {_SEEN} GROUP BY 2 UNION ALL SELECT 'venue', venue_name, count(*) FROM {_SEEN} WHERE venue_name IS NOT NULL GROUP BY 2 HAVING count(*) >= 2
UNION ALL SELECT 'organiser', organiser, count(*) FROM {_SEEN} GROUP BY 2 HAVING count(*) >= 2 UNION ALL SELECT 'declined', coalesce(format_type, 'Other'), count(*) FROM ce WHERE verdict = 'Not Going' GROUP BY 2"""


def _interest(t):
    found = staged(linkage.calendar_match(t.cal, t.ce).select("id").distinct())
    seen = linkage.asked(t.ce, found, found.count(), "id").join(found, "id", "left_semi")
    return reports.interest_evolution(seen, t.ce)


@query("interest_evolution", _INTEREST)
def _(t):
    return _interest(t)


@query("suggestions", f"SELECT 1 AS rank, 'Relax veto ' || source AS text FROM ce GROUP BY source UNION ALL SELECT CASE kind WHEN 'venue' THEN 2 ELSE 3 END, 'Follow ' || kind || ' ' || value || ' (' || n || ')' FROM ({_INTEREST}) WHERE kind IN ('venue', 'organiser')")
def _(t):
    return reports.suggestions(_interest(t), t.ce.select(F.col("source").alias("veto_reason")).distinct())


def _corrections(t):
    return t.ce.select("organiser", F.when(F.col("id") % 2 == 0, F.col("venue_name")).alias("venue_name"), "name", "date", F.lit("cost_over_30").alias("veto_reason"), "id", reports.correction(F.col("pipeline_state"), F.col("verdict"), F.col("llm_tier")).alias("correction")).where("correction is not null").withColumn("organiser", F.when(F.col("id") % 3 > 0, F.col("organiser")))


_KEYS = f"""
SELECT CASE WHEN correction = 'false_veto' THEN 'veto:cost_over_30' WHEN org IS NOT NULL THEN 'organiser:' || org WHEN place IS NOT NULL THEN 'series:' || place ELSE correction || ':' || name || ':' || date END AS finding_key, date
FROM (SELECT {_CASES} AS correction, CASE WHEN id % 3 > 0 THEN organiser END AS org, CASE WHEN id % 2 = 0 THEN lower(venue_name) END AS place, name, date FROM ce) WHERE correction IS NOT NULL"""


@query("findings", f"SELECT finding_key, count(*) AS n, min(date) AS first_seen, max(date) AS last_seen FROM ({_KEYS}) GROUP BY 1")
def _(t):
    return reports.findings(_corrections(t))


@query("finding_rationale", f"SELECT finding_key, CASE split_part(finding_key, ':', 1) WHEN 'veto' THEN 'A veto keeps out events that were attended' WHEN 'organiser' THEN 'Events of this organiser were judged wrongly' WHEN 'series' THEN 'Events of this place were judged wrongly' ELSE 'An event was judged wrongly' END || ' (' || count(*) || ')' AS rationale FROM ({_KEYS}) GROUP BY finding_key")
def _(t):
    return reports.rationale(reports.findings(_corrections(t)))


@query("accumulate_findings", "SELECT organiser AS finding_key, CASE organiser WHEN 'click' THEN 3 WHEN 'view' THEN 1 ELSE 1 END AS evidence, CASE organiser WHEN 'click' THEN 'a,b,' || n WHEN 'view' THEN 'c' ELSE n::VARCHAR END AS events, CASE organiser WHEN 'view' THEN '2024-01-01' ELSE '2024-01-16' END AS last_seen FROM (SELECT organiser, count(*) AS n FROM ce GROUP BY organiser)")
def _(t):
    state = t.spark.createDataFrame([("click", 2, ["a", "b"], "2024-01-01"), ("view", 1, ["c"], "2024-01-01")], "finding_key string, evidence int, events array<string>, last_seen string")
    new = t.ce.where("organiser <> 'view'").groupBy(F.col("organiser").alias("finding_key")).agg(F.array(F.count("*").cast("string")).alias("events"))
    return reports.accumulate(state, new, AS_OF).withColumn("events", F.array_join("events", ","))


def _findings_of(t, run=None):
    """What the findings of all rows, or of a run's, rest on."""
    rows = t.ce if run is None else t.ce.where(F.col("run_date") == run)
    made = rows.select("id", F.when(F.col("id") % 3 > 0, F.col("organiser")).alias("organiser"), F.when(F.col("id") % 2 == 0, F.col("venue_name")).alias("venue_name"), F.col("name").alias("event"), "date", F.when(F.col("id") % 2 == 0, "cost_over_30").alias("veto_reason"), reports.correction(F.col("pipeline_state"), F.col("verdict"), F.col("llm_tier")).alias("type"))
    seen = rows.where("verdict = 'Going'")
    again = lambda kind, c: seen.where(F.col(c).isNotNull()).groupBy(F.lit(kind).alias("kind"), F.col(c).alias("value")).agg(F.count("*").alias("n")).where("n >= 2")
    interest = again("organiser", "organiser").where("value <> 'purchase'").unionByName(again("venue", "venue_name").where("value <> 'Annex'"))
    gaps = t.cal.where("calendar_id % 26 = 0").select(F.when(F.col("calendar_id") % 4 == 0, "Online").otherwise(F.col("location")).alias("location"), F.col("title").alias("event"), "date")
    return digest.finding_events(made.where("type is not null"), interest, gaps)


def _finding_sql(where, n=""):
    """The CTE ev (with the suffix n) of what the findings of some rows rest on."""
    return f"""
r{n} AS (SELECT * FROM ce WHERE {where}), corr{n} AS (SELECT type, event, date, CASE WHEN id % 3 > 0 THEN organiser END AS org, CASE WHEN id % 2 = 0 THEN venue_name END AS place, CASE WHEN id % 2 = 0 THEN 'cost_over_30' ELSE 'unknown' END AS veto FROM (SELECT {_CASES} AS type, name AS event, * FROM r{n}) WHERE type IS NOT NULL),
ent{n} AS (SELECT 'organiser:' || lower(organiser) AS finding_key, 'organiser' AS finding_type, organiser AS target_name, count(*) AS n FROM r{n} WHERE verdict = 'Going' AND organiser <> 'purchase' GROUP BY organiser HAVING count(*) >= 2
  UNION ALL SELECT 'series:' || lower(venue_name), 'series', venue_name, count(*) FROM r{n} WHERE verdict = 'Going' AND venue_name <> 'Annex' GROUP BY venue_name HAVING count(*) >= 2),
gap{n} AS (SELECT location, title AS event, date FROM cal WHERE calendar_id % 26 = 0 AND calendar_id % 4 <> 0 QUALIFY count(*) OVER (PARTITION BY location) >= 2),
att{n} AS (SELECT c.*, coalesce(o.finding_key, p.finding_key) AS k, coalesce(o.finding_type, p.finding_type) AS t, coalesce(o.target_name, p.target_name) AS g FROM corr{n} c LEFT JOIN ent{n} o ON o.finding_key = 'organiser:' || lower(c.org) LEFT JOIN ent{n} p ON p.finding_key = 'series:' || lower(c.place)),
ev{n} AS (SELECT finding_key, finding_type, target_name, 'event' AS role, NULL AS type, target_name || ' x ' || n AS event, NULL AS date FROM ent{n} UNION ALL SELECT 'veto:' || veto, 'veto_exemption', veto, 'event', NULL, event, date FROM corr{n} WHERE type = 'false_veto'
  UNION ALL SELECT 'source_gap:' || lower(location), 'source_gap', location, 'event', NULL, event, date FROM gap{n} UNION ALL SELECT k, t, g, 'correction', type, event, date FROM att{n} WHERE k IS NOT NULL
  UNION ALL SELECT type || ':' || event || ':' || date, type, event, 'event', NULL, event, date FROM att{n} WHERE k IS NULL AND type <> 'false_veto')"""


@query("finding_events", f"WITH {_finding_sql('true')} SELECT * FROM ev")
def _(t):
    return _findings_of(t)


_WHY = """CASE finding_type WHEN 'organiser' THEN 'Events of this organiser are attended again and again' WHEN 'series' THEN 'Events at this place are attended again and again' WHEN 'veto_exemption' THEN 'This veto keeps out events that were attended'
  WHEN 'source_gap' THEN 'Attended events at this place come from no source' ELSE 'An event was judged wrongly' END"""


@query("finding_state", f"""
WITH {_finding_sql("run_date = '2024-01-09'", 1)},
{_finding_sql("run_date = '2024-01-16'", 2)},
both_ AS (SELECT *, 1 AS round FROM ev1 UNION ALL SELECT *, 2 FROM ev2),
f AS (SELECT finding_key, min(finding_type) AS finding_type, count(DISTINCT round) AS evidence, CASE min(round) WHEN 1 THEN '2024-01-09' ELSE '2024-01-16' END AS first_seen, CASE max(round) WHEN 1 THEN '2024-01-09' ELSE '2024-01-16' END AS last_seen, count(*) FILTER (role = 'event') AS n_events, max(round) AS last FROM both_ GROUP BY finding_key),
c AS (SELECT finding_key, round AS last, count(*) AS n, string_agg(DISTINCT type, ', ' ORDER BY type) AS types FROM both_ WHERE role = 'correction' GROUP BY finding_key, round)
SELECT finding_key, finding_type, evidence, first_seen, last_seen, n_events, coalesce(c.n, 0) AS n_corrections, coalesce(c.types, '') AS additional_types, concat({_WHY}, ' (', n_events, ' events, ', evidence, ' digests)', CASE WHEN c.types IS NOT NULL THEN '; corrected: ' || c.types ELSE '' END) AS rationale FROM f LEFT JOIN c USING (finding_key, last)""")
def _(t):
    """The state after the digests of both runs."""
    state = digest.empty_state(t.spark)
    for run in ("2024-01-09", "2024-01-16"):
        state = tuple(map(staged, digest.accumulate(*state, _findings_of(t, run), run)))
    return state[0].drop("target_name").withColumn("additional_types", F.array_join("additional_types", ", "))


@query("digest_record", f"""
WITH m AS (SELECT * FROM {_JOINED}), g AS (SELECT id, name, date FROM m WHERE verdict IN ('Going', 'Maybe')), k AS (SELECT id, {_CASES} AS type FROM m WHERE {_CASES} IS NOT NULL)
SELECT (SELECT count(*) FROM g) AS n_confirmed, (SELECT count(*) FROM k) AS n_corrections, (SELECT string_agg(concat(date, '/', name, '/', id), ';' ORDER BY date, id, name) FROM (SELECT * FROM g ORDER BY date, id, name LIMIT 20)) AS confirmed,
  (SELECT string_agg(concat(type, '/', id), ';' ORDER BY type, id) FROM (SELECT * FROM k ORDER BY type, id LIMIT 20)) AS corrections""")
def _(t):
    """The digest as one record, read back from its JSON: counts of all rows, and the first twenty of each section."""
    rows = staged(_matched(t))
    kind = reports.correction(F.col("pipeline_state"), F.col("verdict"), F.col("llm_tier"))
    sections = {"confirmed": (rows.where(F.col("verdict").isin("Going", "Maybe")).select("id", "name", "date"), ["date", "id"]), "corrections": (rows.select("id", kind.alias("type")).where("type is not null"), ["type", "id"])}
    made = digest.report(sections)
    got = made.select(F.from_json("digest", "summary struct<confirmed:long, corrections:long>, confirmed array<struct<id:long, name:string, date:string>>, corrections array<struct<id:long, type:string>>").alias("d"))
    line = lambda of, *cs: F.array_join(F.transform(F.col(f"d.{of}"), lambda x: F.concat_ws("/", *(x[c] for c in cs))), ";")
    return got.select(F.col("d.summary.confirmed").alias("n_confirmed"), F.col("d.summary.corrections").alias("n_corrections"), F.nullif(line("confirmed", "date", "name", "id"), F.lit("")).alias("confirmed"), F.nullif(line("corrections", "type", "id"), F.lit("")).alias("corrections"))


@query("veto_surfaces", f"""
WITH keys(k, i) AS (VALUES {", ".join(f"('{k}', {i})" for i, k in enumerate(packs.VETO_KEYS))}), s AS (SELECT string_agg(DISTINCT organiser, ' ') AS said FROM ce),
l AS (SELECT chr(65 + CAST(i AS INTEGER)) AS letter, CASE CAST(i AS INTEGER) % 3 WHEN 0 THEN 'Click' WHEN 1 THEN 'view' ELSE 'nowhere' END AS marker, i FROM range(22) x(i))
SELECT 'rules' AS surface, k AS name, CASE WHEN i < 20 THEN 'ok' WHEN k = '{packs.VETO_KEYS[-1]}' THEN 'rule_only' ELSE 'unmapped' END AS status FROM keys UNION ALL SELECT 'rules', 'old_rule', 'stale'
UNION ALL SELECT 'profile', letter, CASE WHEN i >= 20 THEN 'unclaimed' WHEN contains(said, lower(marker)) THEN 'ok' ELSE 'missing' END FROM l, s""")
def _(t):
    """The packs' veto keys, a checklist of their first twenty, and a profile of the organisers' names."""
    letter = lambda i: chr(65 + i)
    checklist = t.spark.createDataFrame([(k, letter(i)) for i, k in enumerate(packs.VETO_KEYS[:20])] + [("old_rule", "A")], "rule_key string, letter string")
    markers = t.spark.createDataFrame([(letter(i), ("Click", "view", "nowhere")[i % 3]) for i in range(22)], "letter string, marker string")
    rules_ = rules.rule_table(t.spark, packs.VETOES)
    return digest.surface_drift(rules_, [packs.VETO_KEYS[-1]], checklist, markers, t.ce.select(F.col("organiser").alias("text")).distinct())


@query("apply_findings", "SELECT DISTINCT 'organiser:' || organiser AS finding_key, CASE organiser WHEN 'click' THEN 'present' WHEN 'view' THEN 'missing' ELSE 'added' END AS action FROM ce UNION ALL SELECT DISTINCT 'veto:' || source, 'manual' FROM ce")
def _(t):
    keys = t.ce.select(F.concat(F.lit("organiser:"), "organiser").alias("finding_key")).distinct()
    approved = keys.unionByName(t.ce.select(F.concat(F.lit("veto:"), "source").alias("finding_key")).distinct())
    return reports.apply_findings(approved, keys.where("finding_key <> 'organiser:view'"), t.spark.createDataFrame([("Click",)], "target string"))


@query("pipeline_health", "SELECT 'degraded' AS health, count(*) FILTER (id % 4 = 0) AS n_success, count(*) FILTER (id % 4 = 1) AS n_partial, count(*) FILTER (id % 4 = 2) AS n_incomplete, count(*) FILTER (id % 4 = 3) AS n_failed, sum(score) AS events_added FROM ce")
def _(t):
    status = F.element_at(F.array(*map(F.lit, ("Success", "Partial", "Incomplete", "Failed"))), (F.col("id") % 4 + 1).cast("int"))
    latest = F.when(F.col("id") % 4 == 1, "2024-02-01").otherwise(F.col("date"))
    return reports.pipeline_health(t.ce.select(status.alias("status"), latest.alias("batch_date"), F.col("score").alias("events_added")))


@query("pipeline_missed", "SELECT 'missed' AS health, count(*) AS n_success, 0 AS n_partial, 0 AS n_incomplete, 0 AS n_failed, sum(score) AS events_added FROM ce")
def _(t):
    return reports.pipeline_health(t.ce.select(F.lit("Success").alias("status"), F.col("date").alias("batch_date"), F.col("score").alias("events_added")), expected="2999-01-01")


@query("failure_class", "SELECT id, CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'access' WHEN 2 THEN 'write' WHEN 3 THEN 'network' WHEN 4 THEN 'stuck' WHEN 5 THEN 'other' ELSE 'unspecified' END AS failure FROM ce")
def _(t):
    said = F.element_at(F.array(*map(F.lit, ("Token gone, write failed", "Write: FAILED", "403 from host", "rows stuck", "odd", "odd"))), F.greatest(F.col("id") % 7, F.lit(1)).cast("int"))
    status = F.when(F.col("id") % 7 == 0, "Success").when(F.col("id") % 7 == 5, "Partial").otherwise("Failed")
    return t.ce.select("id", reports.failure_class(said, status).alias("failure"))


@query("missing_runs", "SELECT d::VARCHAR AS run_date FROM (SELECT (DATE '2024-01-16' - i::INT) AS d FROM range(60) r(i)) WHERE dayofweek(d) = 2 AND d::VARCHAR NOT IN (SELECT run_date FROM ce)")
def _(t):
    return reports.missing_runs(t.ce, S.as_of, 60, 1)


@query("digest_report", f"SELECT count(*) AS n_matched, count(DISTINCT id) AS n_rows, count(*) FILTER (verdict IN ('Going', 'Maybe')) AS n_confirmed, count({_CASES}) AS n_corrections FROM {_JOINED}")
def _(t):
    c = reports.correction(F.col("pipeline_state"), F.col("verdict"), F.col("llm_tier"))
    return _matched(t).agg(F.count("*").alias("n_matched"), F.count_distinct("id").alias("n_rows"), F.count_if(F.col("verdict").isin("Going", "Maybe")).alias("n_confirmed"), F.count(c).alias("n_corrections"))


@query("taste_bootstrap", "SELECT 'venue' AS kind, lower(split_part(location, ',', 1)) AS value, count(*) AS n FROM cal GROUP BY 2 UNION ALL SELECT 'series', trim(regexp_replace(lower(title), '\\d+', '')), count(*) FROM cal GROUP BY 2 HAVING count(*) >= 2 UNION ALL SELECT 'first date', min(date), count(*) FROM cal UNION ALL SELECT 'last date', max(date), count(*) FROM cal UNION ALL SELECT 'format', 'Social meetup', count(*) FROM cal")
def _(t):
    return reports.taste(t.cal, scoring.classify_format(F.col("title"), F.lit("")))


_QA = "(SELECT * FROM ce WHERE run_date = '2024-01-16')"
_CHECKS = f"""SELECT check_name, n_bad, CASE WHEN n_bad = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
SELECT 'url_shape' AS check_name, 0 AS n_bad UNION ALL SELECT 'tracking_url', count(*) FILTER (contains(url, 'click')) FROM {_QA} UNION ALL SELECT 'name', 0 UNION ALL SELECT 'no_format', count(*) FILTER (format_type IS NULL) FROM {_QA}
UNION ALL SELECT 'vetoed_positive', count(*) FILTER (pipeline_state = 'vetoed' AND score > 0) FROM {_QA} UNION ALL SELECT 'written_without_page', 0 UNION ALL SELECT 'page_not_written', 0)"""


@query("qa_checks", _CHECKS)
def _(t):
    return reports.qa_checks(t.ce, "2024-01-16")


@query("qa_fix_plan", f"SELECT check_name, CASE WHEN check_name = 'tracking_url' THEN 'veto' WHEN check_name = 'no_format' THEN 'rescore' ELSE 'revalidate' END AS action FROM ({_CHECKS}) WHERE status = 'fail'")
def _(t):
    return reports.qa_fix_plan(reports.qa_checks(t.ce, "2024-01-16"))


_RUN = """
SELECT * REPLACE (CASE WHEN id % 37 = 0 THEN ' ' ELSE name END AS name, CASE WHEN id % 41 = 0 THEN NULL ELSE score END AS score,
    CASE WHEN source = 'Meetup' AND id % 3 > 0 THEN 'https://www.meetup.com/group/events/' || id ELSE url END AS url,
    CASE WHEN id % 29 = 0 THEN '{"name"' WHEN id % 2 = 0 THEN '{"name":"' || name || '"}' ELSE source_snapshot END AS source_snapshot,
    CASE WHEN id % 43 = 0 THEN 'manual' ELSE source END AS source),
  CASE WHEN id % 23 <> 0 THEN name END AS description, CASE WHEN id % 3 <> 0 THEN run_date END AS llm_reviewed,
  CASE WHEN id % 31 <> 0 THEN 'said' END AS llm_reasoning, CASE WHEN id % 5 = 0 THEN 'QA: url' END AS veto_reason FROM ce"""
_LIVE = "pipeline_state <> 'vetoed'"
_FETCHED = "run_date = '2024-01-16' AND source <> 'manual'"
_WRITTEN = "run_date = '2024-01-16' AND pipeline_state = 'written' AND notion_page_id IS NOT NULL"
_ROW_CHECKS = {
    "meetup_url": f"{_FETCHED} AND source = 'Meetup' AND NOT starts_with(url, 'https://www.meetup.com/group/events/')",
    "tracked": f"{_FETCHED} AND source <> 'Newsletter' AND contains(url, 'click')",
    "nameless": f"{_FETCHED} AND {_LIVE} AND trim(name) = ''",
    "undescribed": f"{_FETCHED} AND {_LIVE} AND trim(coalesce(description, '')) = ''",
    "snapshot": f"{_FETCHED} AND source IN ('Meetup', 'Luma') AND (NOT json_valid(source_snapshot) OR trim(CASE WHEN json_valid(source_snapshot) THEN json_extract_string(source_snapshot, '$.name') END) <> trim(name))",
    "unscored": f"run_date = '2024-01-16' AND {_LIVE} AND score IS NULL AND trim(coalesce(description, '')) <> ''",
    "formatless": f"run_date = '2024-01-16' AND {_LIVE} AND format_type IS NULL",
    "vetoed_with_score": "run_date = '2024-01-16' AND pipeline_state = 'vetoed' AND score > 0 AND veto_reason IS NULL",
    "waiting": "pipeline_state = 'pending_llm' AND llm_reviewed IS NULL AND date BETWEEN '2024-01-16' AND '2024-02-13'",
    "half_reviewed": "run_date = '2024-01-16' AND llm_reviewed IS NOT NULL AND (llm_tier IS NULL OR llm_reasoning IS NULL)",
    "page_missing": f"{_WRITTEN} AND page_id IS NULL",
    "page_differs": f"{_WRITTEN} AND page_id IS NOT NULL AND (b_title <> name OR b_date <> date)",
    "place_unknown": f"{_WRITTEN} AND venue_name IS NOT NULL AND lower(venue_name) NOT IN (SELECT venue_name FROM ve)",
    "hidden": f"{_WRITTEN} AND archived",
}
_FOUND = " UNION ALL ".join(f"SELECT '{k}' AS check_name, id FROM run LEFT JOIN (SELECT page_id, title AS b_title, date AS b_date, archived FROM bd) b ON page_id = notion_page_id WHERE {v}" for k, v in _ROW_CHECKS.items())
_WITH = f"WITH run AS ({_RUN}), found AS ({_FOUND})"
_REPORT = f"""{_WITH}, shares AS (
  SELECT count(*) AS n, count(*) FILTER (llm_tier = 'Borderline') AS b, count(*) FILTER (id % 6 = 0) AS c FROM run WHERE run_date = '2024-01-16' AND llm_tier <> 'Not Recommended'), report AS (
  SELECT check_name, CASE WHEN n_bad = 0 THEN 'pass' ELSE 'fail' END AS status, n_bad, n_bad || ' rows' AS detail, fixable AND n_bad > 0 AS fixable
  FROM (SELECT check_name, fixable, count(id) AS n_bad FROM (VALUES {", ".join(f"('{k}', {str(v).lower()})" for k, v in reports.QA_FIXABLE.items() if "share" not in k)}) c(check_name, fixable) LEFT JOIN found USING (check_name) GROUP BY ALL)
  UNION ALL SELECT name, CASE WHEN k * 100 // n <= most THEN 'pass' ELSE 'fail' END, k, k || ' of ' || n || ', ' || (k * 100 // n) || ' %', fixable AND k * 100 // n > most
  FROM (SELECT 'borderline_share' AS name, b AS k, n, 30 AS most, true AS fixable FROM shares UNION ALL SELECT 'corrected_share', c, n, 20, false FROM shares))"""


def _run(t):
    f, i = F.col, F.col("id")
    return t.ce.withColumns({
        "description": F.when(i % 23 != 0, f("name")),
        "source_snapshot": F.when(i % 29 == 0, '{"name"').when(i % 2 == 0, F.to_json(F.struct("name"))).otherwise(f("source_snapshot")),
        "url": F.when((f("source") == "Meetup") & (i % 3 > 0), F.concat(F.lit("https://www.meetup.com/group/events/"), i.cast("string"))).otherwise(f("url")),
    }).withColumns({
        "name": F.when(i % 37 == 0, " ").otherwise(f("name")), "score": F.when(i % 41 != 0, f("score")), "source": F.when(i % 43 == 0, "manual").otherwise(f("source")),
        "llm_reviewed": F.when(i % 3 != 0, f("run_date")), "llm_reasoning": F.when(i % 31 != 0, "said"), "veto_reason": F.when(i % 5 == 0, "QA: url"),
    })


def _found(t):
    return reports.qa_findings(_run(t), t.ve, t.bd, "2024-01-16")


def _report(t):
    return reports.qa_report(_found(t), reports.qa_shares(_run(t), t.ce.where("id % 6 = 0"), "2024-01-16"))


@query("qa_findings", f"{_WITH} SELECT * FROM found")
def _(t):
    return _found(t)


@query("qa_report", f"{_REPORT} SELECT * FROM report")
def _(t):
    return _report(t)


@query("qa_tally", f"{_REPORT} SELECT count(*) FILTER (status = 'pass') AS passed, count(*) FILTER (status = 'fail') AS failed, 0 AS warned, count(*) FILTER (fixable) AS fixable, count(*) FILTER (status = 'fail' AND NOT fixable) AS needs_attention FROM report")
def _(t):
    return reports.qa_tally(_report(t))


@query("qa_actions", f"""{_WITH}, ranked AS (
  SELECT id, min(CASE WHEN check_name IN {reports.QA_VETOED} THEN '0' WHEN check_name = 'unscored' THEN '1' WHEN check_name = 'formatless' THEN '2' WHEN check_name IN ('page_differs', 'place_unknown', 'hidden') THEN '3' END || check_name) AS top FROM found GROUP BY id)
SELECT id, CASE top[1] WHEN '0' THEN 'veto' WHEN '3' THEN 'remediate' ELSE 'rescore' END AS action, CASE WHEN top[1] = '0' THEN 'QA: ' || top[2:] END AS reason, top[1] = '0' AND notion_page_id IS NOT NULL AS flag_page
FROM ranked JOIN ce USING (id) WHERE top IS NOT NULL""")
def _(t):
    return reports.qa_actions(_found(t), t.ce)


_OURS = "(SELECT *, CASE WHEN id % 3 <> 0 THEN run_date END AS llm_reviewed FROM ce WHERE run_date = '2024-01-16')"
_SAID = "SELECT count(*) FILTER (pipeline_state = 'written') AS w, count(*) AS n, count(*) FILTER (llm_reviewed IS NOT NULL) AS r FROM " + _OURS
_STEPS = f"""steps AS (
  SELECT 'fetch_step' AS check_name, CASE WHEN n > 0 THEN 'pass' ELSE 'fail' END AS status, '' AS detail FROM said UNION ALL SELECT 'scored_step', 'pass', '' FROM said UNION ALL SELECT 'reviewed_step', CASE WHEN r > 0 THEN 'pass' ELSE 'fail' END, '' FROM said
  UNION ALL SELECT 'written_step', CASE WHEN w > 0 THEN 'pass' ELSE 'fail' END, '' FROM said UNION ALL SELECT 'summary_there', 'pass', '' UNION ALL SELECT 'run_status', 'fail', concat('failed: ', CAST(n AS VARCHAR), ' rows') FROM said
  UNION ALL SELECT 'step score-travel', 'fail', 'quota' UNION ALL SELECT 'fetchers', 'pass', concat(CAST((SELECT count(DISTINCT source) - 1 FROM ce) AS VARCHAR), ' of ', CAST((SELECT count(DISTINCT source) FROM ce) AS VARCHAR), ' sources'))"""
#: What the log of the run has; the others of the expected steps are missing.
_LOGGED = ("preflight", "newsletter-sweep", "fetch-action", "score-travel", "dedup", "llm-sense-check")


def _evidence(t):
    """Two steps are written, each counted by its own write; the counts, and what the run says of itself."""
    run = t.ce.where("run_date = '2024-01-16'").withColumn("llm_reviewed", F.when(F.col("id") % 3 != 0, F.col("run_date")))
    path = new_folder(t.spark, "run")
    found = evidence.write_step(run, f"{path}/fetch", "fetch-action")
    found += evidence.write_step(run.where("pipeline_state = 'written'"), f"{path}/written", "write-notion-action", {"pages": "notion_page_id is not null"})
    seen = {m: v for _, m, v in found}
    summary = t.spark.createDataFrame([("2024-01-16 09:00", "Failed", seen["written"] + 3, f"{seen['fetched']} rows")], "batch_date string, status string, events_added long, issues string")
    log = t.spark.createDataFrame([(s, "fail" if s == "score-travel" else "ok", "quota" if s == "score-travel" else None) for s in _LOGGED], "step string, outcome string, detail string")
    return evidence.table(t.spark, found), summary, log


def _step_checks(t, seen, summary, log):
    return evidence.step_checks(seen, summary, log, t.ce.select("source").distinct().withColumn("ok", F.col("source") != "Luma"), "2024-01-16")


@query("step_evidence", f"""SELECT * FROM (SELECT 'fetch-action' AS step, unnest(['fetched', 'scored', 'reviewed', 'written', 'rejected', 'duplicates']) AS metric, unnest([count(*), count(score), count(llm_reviewed),
  count(*) FILTER (pipeline_state = 'written'), count(*) FILTER (pipeline_state = 'llm_rejected'), count(*) FILTER (pipeline_state = 'duplicate')]) AS value FROM {_OURS})
UNION ALL SELECT 'write-notion-action', 'pages', count(notion_page_id) FROM {_OURS} WHERE pipeline_state = 'written'""")
def _(t):
    return _evidence(t)[0]


@query("step_checks", f"WITH said AS ({_SAID}), {_STEPS} SELECT * FROM steps")
def _(t):
    return _step_checks(t, *_evidence(t))


@query("run_deviations", f"""{_REPORT}, said AS ({_SAID}), {_STEPS}, checks AS (SELECT check_name, status, detail FROM report UNION ALL SELECT * FROM steps)
SELECT CASE WHEN required THEN 'deviation' ELSE 'note' END AS severity, 'missing-step-log' AS kind, step, concat('no entry for ', step) AS detail FROM (VALUES {", ".join(f"('{k}', {str(v).lower()})" for k, v in evidence.EXPECTED)}) e(step, required) WHERE step NOT IN {_LOGGED}
UNION ALL SELECT 'deviation', 'step-failed', 'score-travel', 'quota' UNION ALL SELECT 'deviation', 'qa-check-failed', check_name, detail FROM checks WHERE status = 'fail' UNION ALL SELECT 'note', 'qa-check-warned', check_name, detail FROM checks WHERE status = 'warn'
UNION ALL SELECT 'deviation', 'evidence-missing', 'newsletter-qa', 'no count of newsletter_findings' UNION ALL SELECT 'deviation', 'summary-table-drift', 'pipeline-summary', concat('summary: ', CAST(w + 3 AS VARCHAR), ' written, table: ', CAST(w AS VARCHAR)) FROM said""")
def _(t):
    """All of a run: its log, its checks of rows and of steps, its evidence, and a summary that claims three rows too many."""
    seen, summary, log = _evidence(t)
    checks = _report(t).select("check_name", "status", "detail").unionByName(_step_checks(t, seen, summary, log))
    expected = t.spark.createDataFrame(evidence.EXPECTED, "step string, required boolean")
    return evidence.deviations(expected, log, checks, seen, summary, "2024-01-16", {"newsletter_findings": "newsletter-qa", "pages": "write-notion-action"})


@query("stream_funnel", "SELECT CAST(date_trunc('day', (date || ' ' || time || ':00')::TIMESTAMP) AS VARCHAR)[1:10] AS day, pipeline_state, count(*) AS n FROM ce GROUP BY ALL")
def _(t):
    return jobs.funnel_once(t.ce.select("pipeline_state", "date", "time"))


@query("stream_ingest", "SELECT DISTINCT regexp_extract(url, '([^/]+)$', 1) AS url_key FROM ce")
def _(t):
    return jobs.ingest_once(t.ce.select("id", "name", "date", "time", "url"))


@query("stream_upsert", """
WITH r AS (SELECT *, CAST(floor(id * 3 / (SELECT max(id) + 1 FROM ce)) AS BIGINT) AS part FROM ce),
first AS (SELECT url, id, date, end_date, pipeline_state AS state, notion_page_id AS page, part FROM r QUALIFY row_number() OVER (PARTITION BY url ORDER BY id) = 1),
later AS (SELECT r.url, r.part, arg_max(r.date, r.id) AS date, arg_max(struct_pack(e := r.end_date), r.id).e AS end_date FROM r JOIN first AS f ON f.url = r.url AND r.part > f.part GROUP BY ALL),
steps AS (SELECT url, part, date, end_date FROM first UNION ALL SELECT * FROM later),
moved AS (SELECT *, date <> lag(date) OVER (PARTITION BY url ORDER BY part) AS other FROM steps),
last AS (SELECT url, arg_max(date, part) AS date, arg_max(struct_pack(e := end_date), part) FILTER (coalesce(other, true)) AS ends, bool_or(coalesce(other, false)) AS other FROM moved GROUP BY url)
SELECT f.id, f.url, l.date, l.ends.e AS end_date, CASE WHEN l.other AND f.state IN ('expired', 'llm_rejected', 'vetoed') AND f.page IS NULL THEN 'pending_llm' ELSE f.state END AS pipeline_state
FROM first AS f JOIN last AS l ON l.url = f.url
""")
def _(t):
    """By URL, in three runs of the stream."""
    return jobs.upsert_runs(t.ce.select(STORED), 3, names=False).rows().select("id", "url", "date", "end_date", "pipeline_state")


@query("stream_upsert_names")
def _(t):
    """By URL, and by name and date, in three runs of the stream."""
    return jobs.upsert_runs(t.ce.select(STORED), 3, names=True).rows().select("id", "url", "date", "end_date", "pipeline_state")


_N = "(SELECT count(*) FROM ce WHERE {})".format
_BACK = "notion_page_id IS NOT NULL AND id % 4 = 0"


@query("gated_publish", f"""
WITH c AS (SELECT {_N("run_date = '2024-01-09'")} AS one, {_N("run_date = '2024-01-16'")} AS two, {_N("true")} AS n, {_N(_BACK)} AS back, {_N(f"pipeline_state = 'pending_llm' AND {_UP}")} AS due)
SELECT 1 AS attempt, true AS accepted, '' AS reasons, one AS n_published FROM c UNION ALL SELECT 2, true, '', n FROM c
UNION ALL SELECT 3, false, concat('lost_rows: ', CAST(n - two AS VARCHAR), ', lost_run_dates: 1'), n FROM c
UNION ALL SELECT 4, back = 0, CASE WHEN back > 0 THEN concat('regressions: ', CAST(back AS VARCHAR)) ELSE '' END, n FROM c
UNION ALL SELECT 5, due <= 600, CASE WHEN due > 600 THEN concat('crowded: ', CAST(due AS VARCHAR)) ELSE '' END, n FROM c
""")
def _(t):
    """One run date, all rows, a table that lost a run date, one whose written rows went back, and one checked for volume: what was published after each."""
    versions = Versions(t.spark, new_folder(t.spark, "published"))
    back = t.ce.withColumn("pipeline_state", F.when(F.expr(_BACK), "pending_llm").otherwise(F.col("pipeline_state")))
    attempts = [t.ce.where("run_date = '2024-01-09'"), t.ce, t.ce.where("run_date = '2024-01-16'"), back, t.ce]
    rows = []
    for k, table in enumerate(attempts, 1):
        outcome = gates.publish(versions, table, gates.CHECKS | ({"crowded": gates.crowded(AS_OF)} if k == 5 else {}))
        said = ", ".join(f"{c}: {n}" for c, n in sorted(outcome.reasons.items()))
        rows.append((k, outcome.accepted, said, versions.read(t.ce.schema).count()))
    return t.spark.createDataFrame(rows, "attempt int, accepted boolean, reasons string, n_published long")
