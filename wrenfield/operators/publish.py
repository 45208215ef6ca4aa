"""Change sets for boards and calendars; nothing is sent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .review import ARTEFACT
from ..settings import DEFAULT, Settings


def cards(cand: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """(id, card): the properties of ready rows as JSON, without those that are missing."""
    ready = cand.where("pipeline_state = 'ready_to_write'")
    card = F.struct(
        F.col("name").alias("Name"), C.date_property(F.col("date"), F.col("end_date"), F.col("time"), s.timezone).alias("Date"), F.col("llm_tier").alias("Tier"), F.col("format_type").alias("Type"),
        C.or_null(F.col("venue_name")).alias("Venue"), C.or_null(F.col("cost")).alias("Cost"), C.source_label(F.col("source")).alias("Source"), C.time_bucket(F.col("time")).alias("Time"), F.col("url").alias("URL"),
    )
    return ready.select("id", F.to_json(card).alias("card"))


def body(cand: DataFrame) -> DataFrame:
    described = F.col("description") if "description" in cand.columns else F.lit(None).cast("string")
    block = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    blocks = F.array(block("paragraph", C.description_or_tbc(described)), F.when(~C.blank(F.col("venue_name")), block("venue", F.col("venue_name"))), F.when(~C.blank(F.col("cost")), block("cost", F.col("cost"))), block("link", F.col("url")))
    return cand.where("pipeline_state = 'ready_to_write'").select("id", F.array_compact(blocks).alias("blocks"))


def publish_plan(cand: DataFrame, board: DataFrame) -> DataFrame:
    """(id, action, page_id): adopt a page of the same title and date, else create; blocked rows stay."""
    pages = board.groupBy(F.col("title").alias("name"), "date").agg(F.min("page_id").alias("page_id"))
    j = cand.where("pipeline_state = 'ready_to_write'").join(pages, ["name", "date"], "left")
    blocked = F.col("name").rlike(ARTEFACT)
    action = F.when(blocked, "blocked").when(F.col("page_id").isNotNull(), "adopt").otherwise("create")
    return j.select("id", action.alias("action"), F.when(action == "adopt", F.col("page_id")).alias("page_id"))


def calendar_diff(cand: DataFrame, synced: DataFrame, as_of: str) -> DataFrame:
    """(id, action) of rows to show against what is synced (id, content_hash)."""
    shown = cand.where((F.coalesce("end_date", "date") >= as_of) & F.col("verdict").isin("Going", "Maybe", "Undecided"))
    mine = shown.select("id", C.content_hash({c: F.col(c) for c in ("name", "date", "end_date", "time", "venue_name", "cost", "url", "verdict")}).alias("h"))
    j = mine.join(synced.select("id", F.col("content_hash").alias("s")), "id", "full_outer")
    return j.select("id", F.when(F.col("s").isNull(), "create").when(F.col("h").isNull(), "delete").when(F.col("h") != F.col("s"), "update").otherwise("unchanged").alias("action"))


def reconcile(cand: DataFrame, board: DataFrame) -> DataFrame:
    """(id, page_id, status, verdict): tracked rows against pages, and pages that no row tracks."""
    key = lambda c: F.replace(c, F.lit("-"), F.lit(""))
    rows = cand.where("notion_page_id is not null").select("id", key(F.col("notion_page_id")).alias("k"), F.col("verdict").alias("old"))
    pages = board.select(key(F.col("page_id")).alias("k"), "page_id", "archived", F.col("verdict").alias("new"))
    j = rows.join(pages, "k", "full_outer")
    status = F.when(F.col("id").isNull(), "untracked").when(F.col("page_id").isNull(), "gone").when(F.col("archived"), "archived").otherwise("active")
    return j.select("id", "page_id", status.alias("status"), F.when(~F.coalesce("new", "old").eqNullSafe(F.col("old")), F.col("new")).alias("verdict"))


def calendar_body(cand: DataFrame, hours: int = 2) -> DataFrame:
    """(id, title, start_at, end_at): timed ones last two hours, others are whole days with an exclusive end."""
    mark = F.when(F.col("verdict") == "Going", "✔ ").when(F.col("verdict") == "Maybe", "? ").otherwise("")
    timed = F.col("time").rlike(r"^\d{2}:\d{2}$") & C.blank(F.col("end_date"))
    wall = F.concat("date", F.lit(" "), "time", F.lit(":00")).try_cast("timestamp_ntz")
    start = F.when(timed, F.date_format(wall, "yyyy-MM-dd HH:mm")).otherwise(F.col("date"))
    end = F.when(timed, F.date_format(wall + F.expr(f"INTERVAL {hours} HOURS"), "yyyy-MM-dd HH:mm")).otherwise(F.date_add(F.coalesce("end_date", "date").try_cast("date"), 1).cast("string"))
    return cand.select("id", F.concat(mark, "name").alias("title"), start.alias("start_at"), end.alias("end_at"))


def verdict_sync(cand: DataFrame, board: DataFrame, as_of: str) -> DataFrame:
    """(id, outcome, new_verdict) of past rows with a page; without a verdict they stay unsynced."""
    past = cand.where(F.col("notion_page_id").isNotNull() & (F.coalesce("end_date", "date") < F.date_sub(F.lit(as_of).cast("date"), 1).cast("string")))
    j = past.join(board.select(F.col("page_id").alias("notion_page_id"), F.col("verdict").alias("new"), F.lit(True).alias("there")), "notion_page_id", "left")
    known = F.col("new").isin("Going", "Maybe", "Undecided", "Not Going")
    outcome = F.when(F.col("there").isNull(), "missing").when(F.col("new").isNull(), "unsynced").when(known, "synced").otherwise("error")
    return j.select("id", outcome.alias("outcome"), F.when(outcome == "synced", F.col("new")).alias("new_verdict"))


def archive_plan(cand: DataFrame, board: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    old = cand.where(F.col("notion_page_id").isNotNull() & (F.coalesce("end_date", "date") < F.date_sub(F.lit(as_of).cast("date"), days).cast("string")))
    j = old.join(board.select(F.col("page_id").alias("notion_page_id"), "archived"), "notion_page_id", "left")
    return j.select("id", F.when(F.col("archived").isNull(), "missing").when(F.col("archived"), "already archived").otherwise("archive").alias("action"))


def backfill_plans(cand: DataFrame) -> DataFrame:
    """(patch_kind, id): active pages that lack something that is known now."""
    live = cand.where("notion_page_id is not null")
    pick = lambda kind, cond: live.where(cond).select(F.lit(kind).alias("patch_kind"), "id")
    parts = [pick("source_detail", F.col("source") == "Newsletter"), pick("travel", F.col("travel_transit_min").isNotNull()), pick("place", F.col("venue_name").isNotNull()), pick("type", F.lit(True))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def remediation_plan(cand: DataFrame, run_date: str) -> DataFrame:
    return cand.where((F.col("run_date") == run_date) & F.col("notion_page_id").isNotNull()).select("id", F.when(F.col("llm_tier").isNull(), "skip").otherwise("patch").alias("action"))


# Names of finding types.
FINDING_TYPES = {"organiser": "Organiser", "series": "Series", "veto_exemption": "Veto exemption", "source_gap": "Source gap"}


def finding_cards(findings: DataFrame) -> DataFrame:
    """(finding_key, title, types, period, action) of findings (finding_key, type, types, dates, evidence)."""
    named = F.create_map(*(F.lit(x) for kv in FINDING_TYPES.items() for x in kv))
    types = F.array_distinct(F.concat(F.array(F.col("type")), "types"))
    low, high = F.array_min("dates"), F.array_max("dates")
    period = F.concat(low, F.when(high != low, F.concat(F.lit("–"), high)).otherwise(""))
    return findings.select("finding_key", F.initcap(F.substring_index("finding_key", ":", -1)).alias("title"), F.array_join(F.transform(types, lambda t: F.coalesce(named[t], t)), ", ").alias("types"), period.alias("period"), "evidence")
