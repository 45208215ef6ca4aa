"""Queries of the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..settings import DEFAULT as S
from .catalog import query

_HOST = "regexp_replace(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '^www\\.', '')"
_COST = "CASE WHEN contains(lower(cost), 'free') THEN 0.0 ELSE try_cast(replace(regexp_extract(lower(cost), '£?\\s*(\\d{1,3}(?:,\\d{3})+(?:\\.\\d+)?|\\d+(?:\\.\\d+)?)', 1), ',', '') AS DOUBLE) END"
_SQUEEZED = "trim(regexp_replace(lower({0}), '\\s+', ' ', 'g'))"
_ASCII = "NOT regexp_matches(name, '[^\\x00-\\x7F]')"


@query("normalise_name", f"SELECT id, CASE WHEN {_ASCII} THEN {_SQUEEZED.format('name')} END AS norm FROM cd")
def _(t):
    """SQL has no NFKD: all names are normalised, and those without other characters are shown."""
    plain = F.when(~F.col("name").rlike(r"[^\x00-\x7F]"), C.normalise_name(F.col("name")))
    return t.cd.select("id", plain.alias("norm"))


@query("normalise_name_wide")
def _(t):
    return t.cd.select("id", C.normalise_name(F.col("name")).alias("norm"))


@query("canonical_url", "SELECT page_id, replace(url, '://blog.', '://') AS given, split_part(regexp_replace(url, '^https?://[^/]*', 'https://lu.ma'), '?', 1) AS canonical FROM pg")
def _(t):
    own = F.regexp_replace("url", r"^https?://[^/]*", "https://luma.com")
    return t.pg.select("page_id", F.replace("url", F.lit("://blog."), F.lit("://")).alias("given"), C.canonical_url(own).alias("canonical"))


@query("url_key", "SELECT id, nullif(regexp_extract(url, '^https://lu\\.ma/([^/?]+)', 1), '') AS url_key FROM ce")
def _(t):
    return t.ce.select("id", C.url_key(F.concat("url", F.lit("?x=1"))).alias("url_key"))


@query("local_datetime", "SELECT id, date, strftime((date || ' 12:30:00')::TIMESTAMP + INTERVAL 2 HOUR, '%H:%M') AS local_time FROM ce")
def _(t):
    day, time = C.local_datetime(F.concat("date", F.lit("T12:30-02:00")), S.timezone)
    return t.ce.select("id", day.alias("date"), time.alias("local_time"))


@query("end_date_if_different", "SELECT id, CASE WHEN end_date <> date THEN end_date END AS end_date FROM ce")
def _(t):
    return t.ce.select("id", C.end_date_if_different(F.col("date"), F.col("end_date")).alias("end_date"))


@query("parse_cost", f"SELECT id, {_COST} AS cost_value FROM ce")
def _(t):
    return t.ce.select("id", C.parse_cost(F.col("cost")).alias("cost_value"))


@query("parse_hour", "SELECT id, try_cast(substr(time, 1, 2) AS INT) AS hour FROM ce")
def _(t):
    return t.ce.select("id", C.parse_hour(F.col("time")).alias("hour"))


@query(
    "time_bucket",
    "SELECT id, CASE WHEN id % 5 = 0 THEN 'Not extracted' WHEN id % 7 = 0 THEN 'TBC' WHEN time < '12:00' THEN 'Morning' WHEN time < '17:00' THEN 'Afternoon' ELSE 'Evening' END AS bucket, CASE WHEN id % 5 = 0 THEN 'Not extracted' WHEN id % 7 = 0 THEN 'TBC' ELSE time END AS shown FROM ce",
)
def _(t):
    time = F.when(F.col("id") % 5 == 0, F.lit(" ")).when(F.col("id") % 7 == 0, F.lit("tbc")).otherwise(F.col("time"))
    return t.ce.select("id", C.time_bucket(time).alias("bucket"), C.time_display(time).alias("shown"))


@query("date_labels", "SELECT id, strftime(date::DATE, '%-d %b') AS short, strftime(date::DATE, '%a %-d %B') AS long, strftime(date::DATE, '%B') AS month FROM ce")
def _(t):
    short, long, month = C.date_labels(F.col("date"))
    return t.ce.select("id", short.alias("short"), long.alias("long"), month.alias("month"))


@query("date_property", "SELECT id, CASE WHEN end_date IS NULL THEN date || 'T' || time || ':00+00:00' ELSE date END AS start_at, end_date AS end_at FROM ce")
def _(t):
    p = C.date_property(F.col("date"), F.col("end_date"), F.col("time"), S.timezone)
    return t.ce.select("id", p["start"].alias("start_at"), p["end"].alias("end_at"))


@query("truncate_utf16", "SELECT id, length(description) > 200 AS cut, CASE WHEN length(description) > 200 THEN substr(description, 1, 199) || '…' ELSE description END AS shown FROM cd")
def _(t):
    return t.cd.select("id", (F.length("description") > 200).alias("cut"), C.truncate_utf16(F.col("description"), 200).alias("shown"))


@query("normalise_venue", "SELECT calendar_id, lower(split_part(location, ',', 1)) AS venue, lower(split_part(location, ',', 1)) AS short FROM cal")
def _(t):
    place = F.concat("location", F.lit(", UK"))
    return t.cal.select("calendar_id", C.normalise_venue(place, S.city, S.geocode_suffix).alias("venue"), C.venue_short(place).alias("short"))


@query("title_stem", "SELECT id, organiser || ' night part' AS stem FROM ce")
def _(t):
    return t.ce.select("id", C.title_stem(F.concat("name", F.lit(" (June) #4"))).alias("stem"))


_OVERLAP = "SELECT id, round(coalesce(len(list_intersect(a, b)) / nullif(least(len(a), len(b)), 0), 0.0), 6) AS share FROM (SELECT id, list_distinct(regexp_extract_all(lower(name), '[\\p{L}\\p{N}_]+')) AS a, list_distinct(regexp_extract_all(lower(description), '[\\p{L}\\p{N}_]+')) AS b FROM cd)"


def shares(t):
    """Share of the name's words in the whole text."""
    return t.cd.select("id", F.round(C.overlap(C.words(F.lower("name")), C.words(F.lower("description"))), 6).alias("share"))


@query("word_overlap", _OVERLAP)
def _(t):
    return shares(t)


@query("word_overlap_all_texts", _OVERLAP)
def _(t):
    return shares(t)


@query("url_domain", f"SELECT page_id, {_HOST} AS domain, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) IN ('', '/') AS homepage FROM pg")
def _(t):
    return t.pg.select("page_id", C.url_host(F.col("url")).alias("domain"), C.is_homepage(F.col("url")).alias("homepage"))


@query("tracking_url", "SELECT page_id, contains(url, 'utm') OR page_id % 3 = 0 AS tracked FROM (SELECT page_id, split_part(url, '?', 2) AS url FROM pg)")
def _(t):
    named = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://x.LIST-MANAGE.com/?u="), "url")).when(F.split_part("url", F.lit("?"), F.lit(2)).contains("utm"), F.concat(F.lit("https://a.org/Click/"), "page_id")).otherwise(F.lit("https://a.org/b?click=1"))
    return t.pg.select("page_id", C.is_tracking(named).alias("tracked"))


@query("venue_address", "SELECT id, CASE WHEN venue_name IS NULL THEN CASE WHEN id % 2 = 0 THEN 'EC1A 4FF, Springfield, UK' END ELSE venue_name || CASE WHEN id % 2 = 0 THEN ', EC1A 4FF' ELSE '' END || ', Springfield, UK' END AS address FROM ce")
def _(t):
    text = F.when(F.col("id") % 2 == 0, F.lit("Doors at 7, ec1a 4ff, bring a friend"))
    return t.ce.select("id", C.venue_address(F.col("venue_name"), F.lit("tbc"), text, S.geocode_suffix).alias("address"))


@query("minutes_from_duration", "SELECT id, greatest(1, CAST(round_even(id * 10 / 60, 0) AS INT)) AS minutes FROM ce")
def _(t):
    return t.ce.select("id", C.minutes_from_duration(F.concat((F.col("id") * 10).cast("string"), F.lit("s"))).alias("minutes"))


@query(
    "travel_display",
    "SELECT id, display, CASE WHEN display IS NOT NULL THEN split_part(display, ' · ', 1) WHEN venue_name IS NULL THEN 'Venue unknown' ELSE 'Route unavailable' END AS label FROM (SELECT id, venue_name, nullif(concat_ws(' · ', CASE WHEN id % 4 > 0 THEN travel_transit_min || ' min (transit)' END, CASE WHEN id % 40 <= 25 THEN (id % 40) || ' min (cycle)' END, CASE WHEN id % 60 <= 20 THEN (id % 60) || ' min (walk)' END), '') AS display FROM ce)",
)
def _(t):
    transit, cycle, walk = F.when(F.col("id") % 4 > 0, F.col("travel_transit_min")), F.col("id") % 40, F.col("id") % 60
    shown = C.travel_display(transit, cycle, walk, S.cycle_shown, S.walk_shown)
    return t.ce.select("id", shown.alias("display"), C.travel_label(shown, F.col("venue_name")).alias("label"))


@query(
    "date_variants",
    "SELECT id, date AS iso, strftime(d, '%-d %B') AS day_month, strftime(d, '%b %-d') AS month_day, strftime(d, '%d/%m') AS slashed FROM (SELECT id, date, date::DATE AS d FROM ce)",
)
def _(t):
    v = t.ce.select("id", C.date_variants(F.col("date")).alias("v"))
    return v.select("id", F.col("v")[0].alias("iso"), F.col("v")[1].alias("day_month"), F.filter("v", lambda x: x.rlike(r"^[A-Z][a-z]{2} \d+$"))[0].alias("month_day"), F.filter("v", lambda x: x.rlike(r"^\d\d/\d\d$"))[0].alias("slashed"))


@query("strip_jargon", "SELECT id, name || '; done' AS said FROM ce")
def _(t):
    raw = F.concat("name", F.lit(" run/step.py  line 40 ;  HTTP 503 done MAX_RETRY_COUNT exit code 3 ;"))
    return t.ce.select("id", C.strip_jargon(raw).alias("said"))


def blobs(rows):
    blob, title = C.text_blob(F.col("name"), F.col("description"), F.col("organiser")), C.text_blob(F.col("name"), F.col("organiser"))
    return rows.select("id", blob.alias("blob"), title.alias("title_scope"))


@query("text_blob", "SELECT id, lower(name || ' ' || description || ' ' || organiser) AS blob, lower(name || ' ' || organiser) AS title_scope FROM cd")
def _(t):
    return blobs(t.cd)


@query("text_blob_all_texts", "SELECT id, lower(name || ' ' || description || ' ' || organiser) AS blob, lower(name || ' ' || organiser) AS title_scope FROM cd")
def _(t):
    return blobs(t.cd)


_HASHED = ["name", "date", "end_date", "time", "venue_name", "cost", "format_type", "llm_tier", "score", "url", "verdict", "organiser"]


@query("content_hash", "SELECT id, substr(sha256(CAST(json_object(" + ", ".join(f"'{c}', {c}" for c in sorted(_HASHED)) + ") AS VARCHAR)), 1, 16) AS h FROM ce")
def _(t):
    return t.ce.select("id", C.content_hash({c: F.col(c) for c in _HASHED}).alias("h"))


@query("description_or_tbc", "SELECT id, CASE WHEN id % 3 = 0 THEN 'TBC' ELSE name END AS description, CASE WHEN id % 5 = 0 THEN 'Newsletter' ELSE source END AS source FROM ce")
def _(t):
    text = F.when(F.col("id") % 3 == 0, F.lit("  ")).otherwise(F.col("name"))
    source = F.when(F.col("id") % 5 == 0, F.lit("Blog")).otherwise(F.col("source"))
    return t.ce.select("id", C.description_or_tbc(text).alias("description"), C.source_label(source).alias("source"))


@query(
    "past_connection",
    "SELECT id, nullif(concat_ws('; ', CASE WHEN id % 2 = 0 THEN 'The user has attended this event series before' END, CASE WHEN id % 3 = 0 THEN 'The user has been to events at ' || coalesce(venue_name, 'this venue') || ' before' END, CASE WHEN id % 5 = 0 THEN 'The user has been to events by ' || organiser || ' before' END), '') AS said FROM ce",
)
def _(t):
    fired = F.array_compact(F.array(F.when(F.col("id") % 2 == 0, "Signal #31: Known series"), F.when(F.col("id") % 3 == 0, "Signal #32: Known venue-as-organiser"), F.when(F.col("id") % 5 == 0, "Signal #32: Known organiser"), F.lit("Signal #4: Hands-on")))
    return t.ce.select("id", C.past_connection(fired, F.col("venue_name"), F.col("organiser")).alias("said"))
