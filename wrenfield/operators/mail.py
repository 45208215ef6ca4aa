"""Newsletter messages and their senders; tracing of what was extracted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import review


def unprocessed(messages: DataFrame, recorded: DataFrame) -> DataFrame:
    return messages.join(recorded.select("message_id"), "message_id", "left_anti")


def record(state: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert by message id: new facts win, a stored body stays unless a new one came."""
    n = new.select("message_id", *(F.col(c).alias(f"n_{c}") for c in ("sender", "body_text")), F.lit(True).alias("is_new"))
    j = state.select("message_id", "sender", "body_text").join(n, "message_id", "full_outer")
    return j.select("message_id", F.coalesce("n_sender", "sender").alias("sender"), F.coalesce("n_body_text", "body_text").alias("body_text"))


def record_batch(extracted: DataFrame, metadata: DataFrame, labelled: DataFrame, recorded: DataFrame) -> DataFrame:
    """(message_id, sender, n): metadata's own counts first, then counts of extracted rows, then bare ids."""
    counts = extracted.groupBy("message_id").agg(F.count("*").alias("n"), F.min_by("organiser", "ord").alias("sender"))
    meta = metadata.join(counts.select("message_id", F.col("n").alias("c")), "message_id", "left").select("message_id", "sender", F.coalesce("events_extracted", "c", F.lit(0)).cast("long").alias("n"), F.lit(0).alias("rank"))
    rest = counts.select("message_id", "sender", "n", F.lit(1).alias("rank")).unionByName(labelled.select("message_id", F.lit(None).cast("string").alias("sender"), F.lit(0).cast("long").alias("n"), F.lit(2).alias("rank")))
    first = meta.unionByName(rest).groupBy("message_id").agg(F.min_by(F.struct("sender", "n"), "rank").alias("r")).select("message_id", "r.*")
    return first.join(recorded.select("message_id"), "message_id", "left_anti")


def track_senders(state: DataFrame, messages: DataFrame) -> DataFrame:
    new = messages.groupBy("sender").agg(F.sum("events_extracted").alias("e"), F.count("*").alias("m"), F.max("email_date").alias("d"))
    j = state.join(new, "sender", "full_outer")
    return j.select("sender", (F.coalesce("events", F.lit(0)) + F.coalesce("e", F.lit(0))).alias("events"), (F.coalesce("emails", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("emails"), F.greatest("last_seen", "d").alias("last_seen"))


def active(senders: DataFrame, left: DataFrame) -> DataFrame:
    """Senders with ``active``: not those that ``left``."""
    gone = left.select("sender", F.lit(False).alias("active")).distinct()
    return senders.join(gone, "sender", "left").withColumn("active", F.coalesce("active", F.lit(True)))


def recent(messages: DataFrame, as_of: str, days: int) -> DataFrame:
    return messages.where(F.col("email_date") >= F.date_sub(F.lit(as_of).cast("date"), days).cast("string"))


def repair_body(state: DataFrame, fixes: DataFrame) -> DataFrame:
    j = state.join(fixes.select("message_id", F.col("body_text").alias("fixed")), "message_id", "left")
    return j.withColumn("qa_status", F.when(F.col("fixed").isNull(), F.col("qa_status"))).withColumn("body_text", F.coalesce("fixed", "body_text")).drop("fixed")


def discovery(messages: DataFrame, known: DataFrame, most: int = 15) -> DataFrame:
    """The newest message of each unknown sender, of at most ``most`` senders (a review quota)."""
    w = Window.partitionBy("sender").orderBy(F.desc("email_date"), "message_id")
    new = messages.join(known.select("sender"), "sender", "left_anti").withColumn("nth", F.row_number().over(w)).where("nth = 1")
    return new.orderBy(F.desc("email_date"), "sender").limit(most).select("sender", "message_id", "email_date")


# Venues that no text names.
NO_VENUE = ("tbc", "unknown", "online", "various")


def extraction_trace(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """(id, name_status, date_status, venue_status, row_status): whether what a row says stands in the message's text."""
    kept = rows if "venue_name" in rows.columns else rows.withColumn("venue_name", F.lit(None).cast("string"))
    j = kept.withColumn("norm", C.normalise_name(F.col("name"))).join(messages.select("message_id", C.normalise_name(F.col("body_text")).alias("body")), "message_id", "left")
    words = F.split("norm", " ")
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 2, F.lit(1))), lambda i: F.array_join(F.slice(words, i, 3), " "))
    whole = F.contains("body", "norm")
    name = F.when(C.blank(F.col("name")), "missing").when(whole | ((F.size(words) > 2) & F.exists(runs, lambda w: F.contains(F.col("body"), w))), "match").otherwise("NOT_FOUND")
    date = F.when(C.blank(F.col("date")), "missing").when(F.exists(C.date_variants(F.col("date")), lambda v: F.contains(F.col("body"), F.lower(v))), "match").otherwise("NOT_FOUND")
    place = F.coalesce("venue_name", F.lit(""))
    venue = F.when((place == "") | F.lower(place).isin(*NO_VENUE), "skipped").when(F.contains("body", C.normalise_name(place)), "match").otherwise("NOT_FOUND")
    said = j.select("id", "message_id", name.alias("name_status"), date.alias("date_status"), venue.alias("venue_status"))
    return said.withColumn("row_status", F.when(F.array_contains(F.array("name_status", "date_status", "venue_status"), "NOT_FOUND"), "mismatch").otherwise("ok"))


_DAYS = r"\b(\d{1,2})(?:st|nd|rd|th)?(?:\s+([a-z]{3,9}))?\s*(–|-|&|,|\bto\b)\s*(\d{1,2})(?:st|nd|rd|th)?\s+([a-z]{3,9})\b"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _month(c: Column) -> Column:
    """Number of a month by its first letters; null for other words."""
    at = F.instr(F.lit(_MONTHS), F.substring(c, 1, 3))
    named = F.lit("january february march april may june july august september october november december")
    return F.when((at > 0) & (at % 3 == 1) & F.concat(F.lit(" "), named).contains(F.concat(F.lit(" "), c)), F.floor((at + 2) / 3).cast("int"))


def date_spans(text: Column) -> Column:
    """Days of a month that a text joins, as array<struct<first, last, whole>> of 100 * month + day; ``whole`` where all days between are meant (``6-13 Jun``, ``28 Jan to
    3 Feb``), not only both (``9 & 11 Jun``). ``text``: lower case."""
    part = lambda k: F.regexp_extract_all(text, F.lit(_DAYS), F.lit(k))
    rows = F.arrays_zip(*(part(k).alias(f"p{k}") for k in range(1, 6)))
    last_month = lambda x: _month(x["p5"])
    first_month = lambda x: F.when(F.coalesce(x["p2"], F.lit("")) == "", last_month(x)).otherwise(_month(x["p2"]))
    day = lambda c: c.cast("int")
    made = F.transform(rows, lambda x: F.struct((100 * first_month(x) + day(x["p1"])).alias("first"), (100 * last_month(x) + day(x["p4"])).alias("last"), (~x["p3"].isin("&", ",")).alias("whole")))
    return F.filter(made, lambda x: x["first"].isNotNull() & x["last"].isNotNull())


def in_span(date: Column, spans: Column) -> Column:
    """Whether a day is one of the spans': their ends, or within, also over the turn of a year."""
    d = date.try_cast("date")
    day = 100 * F.month(d) + F.dayofmonth(d)
    within = lambda x: F.when(x["first"] <= x["last"], day.between(x["first"], x["last"])).otherwise((day >= x["first"]) | (day <= x["last"]))
    return F.coalesce(F.exists(spans, lambda x: (day == x["first"]) | (day == x["last"]) | (x["whole"] & within(x))), F.lit(False))


def trace_fields(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """(id, message_id, name, date, venue and url status, row_status): every field of a row held against the text of its message. Dates may stand as such or within
    a span of days; a row without a message is ``skipped``. The spans of a message are read once, however many rows it has."""
    read = messages.select("message_id", "body_text", date_spans(C.normalise_name(F.col("body_text"))).alias("spans"))
    fields = extraction_trace(rows, messages).drop("row_status")
    ids = rows.select("id", "date", "message_id").join(read.select("message_id", "spans", F.lit(True).alias("there")), "message_id", "left").drop("message_id")
    j = fields.join(ids, "id").join(review.url_traced(rows, messages), "id")
    date = F.when((F.col("date_status") == "NOT_FOUND") & in_span(F.col("date"), F.col("spans")), "match").otherwise(F.col("date_status"))
    j = j.withColumn("date_status", date)
    bad = F.array_contains(F.array("name_status", "date_status", "venue_status", "url_status"), "NOT_FOUND")
    status = F.when(F.col("there").isNull(), "skipped").when(bad, "mismatch").otherwise("ok")
    return j.select("id", "message_id", "name_status", "date_status", "venue_status", "url_status", status.alias("row_status"))


#: UTF-16 units of a message that a prompt shows.
PROMPT_UNITS = 8_000


def prompts(flagged: DataFrame, rows: DataFrame, messages: DataFrame, units: int = PROMPT_UNITS) -> DataFrame:
    """(message_id, n_rows, prompt): for each flagged message its rows as JSON lines, in order of id, and the beginning of its text, of which no character is split."""
    shown = F.when(F.col("description_source") == "page", "(from the page: not to be compared)").otherwise(F.substring(F.coalesce("description", F.lit("")), 1, 200)) if "description_source" in rows.columns else F.substring(F.coalesce("description", F.lit("")), 1, 200)
    line = F.to_json(F.struct("id", "name", "date", F.col("venue_name").alias("venue"), "url", shown.alias("description")), {"ignoreNullFields": "false"})
    of = rows.join(flagged.select("message_id").distinct(), "message_id", "left_semi").select("message_id", "id", line.alias("line"))
    lists = of.groupBy("message_id").agg(F.count("*").alias("n_rows"), F.expr(r"listagg(line, '\n') within group (order by id)").alias("lines"))
    j = lists.join(messages.where(~C.blank(F.col("body_text"))).select("message_id", "body_text"), "message_id")
    asked = F.lit("Which of these rows does the message support? Answer with one JSON object per row: id, and for name, date, venue, url and description whether they match.")
    prompt = F.concat(asked, F.lit("\n\nROWS\n"), "lines", F.lit("\n\nMESSAGE\n"), C.truncate_utf16(F.col("body_text"), units))
    return j.select("message_id", "n_rows", prompt.alias("prompt"))


def second_pass(trace: DataFrame, least: int = 3) -> DataFrame:
    """Messages to read again: with a mismatch, or with several rows."""
    by = trace.groupBy("message_id").agg(F.count("*").alias("n"), F.count_if(F.col("row_status") == "mismatch").alias("bad"))
    return by.where((F.col("bad") > 0) | (F.col("n") >= least))


def flags(messages: DataFrame) -> DataFrame:
    return messages.withColumn("qa_status", F.when(F.col("qa_status") == "flagged", "skipped").otherwise("flagged"))
