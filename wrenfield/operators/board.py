"""Board pages in full: the properties of a card, and the changes that follow from comparing pages with rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..settings import DEFAULT, Settings
from . import linkage, travel

#: UTF-16 units of a text property.
TEXT_UNITS = 2_000
VERDICTS = ("Going", "Maybe", "Undecided", "Not Going")


def _text(kind: str, c: Column) -> Column:
    return F.when(c.isNotNull(), F.struct(F.array(F.struct(F.struct(c.alias("content")).alias("text"))).alias(kind)))


def _select(c: Column) -> Column:
    return F.when(c.isNotNull(), F.struct(F.struct(c.alias("name")).alias("select")))


def place(date: Column, venue: Column, postcode: Column, address: Column, lat: Column, lon: Column, since: str) -> Column:
    """A place of rows from ``since`` on whose venue has a name and coordinates; else null."""
    name = F.trim(F.coalesce(venue, F.lit("")))
    at = F.coalesce(C.or_null(address), C.or_null(postcode), name)
    return F.when((date >= since) & (name != "") & lat.isNotNull(), F.struct(F.struct(name.alias("name"), at.alias("address"), lat.alias("lat"), lon.alias("lon")).alias("place")))


def properties(cand: DataFrame, venues: DataFrame, today: dt.date, since: str, s: Settings = DEFAULT) -> DataFrame:
    """(id, properties) of the ready rows, a JSON object in which properties that a row doesn't have are left out.

    Coordinates come from ``venues`` (venue_name, venue_postcode, venue_lat, venue_lon, formatted_address, lookup_date) by name, else postcode. Columns that
    ``cand`` lacks count as null.
    """
    ready = cand.where("pipeline_state = 'ready_to_write'")
    ready = ready.withColumns({c: F.lit(None).cast("string") for c in ("venue_postcode", "description", "travel_display") if c not in cand.columns})
    ready = travel.in_tiers(ready, venues.where("venue_lat is not null"), {"venue_name": False, "venue_postcode": False}, ["venue_lat", "venue_lon", "formatted_address"])
    described = C.description_or_tbc(F.col("description"))
    # the names of the board's properties are fixed values
    made = {
        "Event": _text("title", C.truncate_utf16(F.col("name"), TEXT_UNITS)),
        "Date": F.struct(C.date_property(F.col("date"), F.col("end_date"), F.col("time"), s.timezone).alias("date")),
        "Time of day": _text("rich_text", C.time_display(F.col("time"))),
        "Month": _select(C.date_labels(F.col("date"))[2]),
        "Tier": _select(F.col("llm_tier")),
        "Score": F.struct(F.coalesce("score", F.lit(0)).alias("number")),
        "Type": _select(F.coalesce(C.or_null(F.col("format_type")), F.lit("Other"))),
        "Added": F.struct(F.struct(F.lit(today.isoformat()).alias("start")).alias("date")),
        "Batch": _select(F.lit(f"{today.day} {today:%b}")),
        "Venue": _text("rich_text", C.or_null(F.col("venue_name"))),
        "Cost": _text("rich_text", C.or_null(F.col("cost"))),
        "Description": _text("rich_text", F.when(described != "TBC", C.truncate_utf16(described, TEXT_UNITS))),
        "Link": F.when(C.or_null(F.col("url")).isNotNull(), F.struct("url")),
        "Source": _select(F.when(C.or_null(F.col("source")).isNotNull(), C.source_label(F.col("source")))),
        "Travel from home": _text("rich_text", C.travel_label(F.col("travel_display"), F.col("venue_name"))),
        "Verdict": _select(F.lit("Undecided")),
        "Place": place(F.col("date"), F.col("venue_name"), F.col("venue_postcode"), F.col("found.formatted_address"), F.col("found.venue_lat"), F.col("found.venue_lon"), since),
    }
    return ready.select("id", F.to_json(F.struct(*(v.alias(k) for k, v in made.items()))).alias("properties"))


def _undashed(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def reconcile_changes(cand: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, page_id, kind, status, verdict, reason, notes): ``update`` for tracked rows with what is to be set and null for what stays, ``gone`` for rows whose page is missing, and
    ``untracked`` pages.

    ``pages`` as ``ingest.board_flatten`` returns cards; ids are compared without dashes. A verdict, reason or note is copied only where the page has one and it differs; the status is
    the first that applies of deleted, archived, flagged for deletion, active.
    """
    rows = cand.where("notion_page_id is not null").select("id", _undashed(F.col("notion_page_id")).alias("k"), *(F.col(c).alias(f"old_{n}") for n, c in (("status", "notion_status"), ("verdict", "verdict"), ("reason", "verdict_reason"), ("notes", "verdict_notes"))))
    found = pages.select(_undashed(F.col("page_id")).alias("k"), "page_id", "archived", "in_trash", "to_delete", *(F.col(c).alias(f"new_{c}") for c in ("verdict", "reason", "notes")))
    j = rows.join(found, "k", "full_outer")
    status = F.when(F.col("in_trash"), "deleted").when(F.col("archived"), "archived").when(F.col("to_delete"), "flagged_delete").otherwise("active")
    there = F.col("id").isNotNull() & F.col("page_id").isNotNull()
    changed = {"status": F.when(there & ~status.eqNullSafe(F.col("old_status")), status)}
    changed |= {c: F.when(there & ~C.blank(F.col(f"new_{c}")) & ~F.col(f"new_{c}").eqNullSafe(F.col(f"old_{c}")), F.col(f"new_{c}")) for c in ("verdict", "reason", "notes")}
    kind = F.when(F.col("id").isNull(), "untracked").when(F.col("page_id").isNull(), "gone").when(F.coalesce(*changed.values()).isNotNull(), "update")
    gone = F.when(kind == "gone", "gone").otherwise(changed["status"])
    return j.select("id", "page_id", kind.alias("kind"), gone.alias("status"), *(changed[c].alias(c) for c in ("verdict", "reason", "notes"))).where("kind is not null")


def verdict_changes(cand: DataFrame, pages: DataFrame, as_of: str, now: str) -> DataFrame:
    """(id, outcome, verdict, reason, notes, synced_at) of past rows with a page that weren't synced yet. Without a verdict a row stays for the next time; an unknown one is an
    error. What is synced is copied as it is, also where the page has nothing."""
    past = F.col("notion_page_id").isNotNull() & F.col("synced_at").isNull() & (F.coalesce("end_date", "date") < F.date_sub(F.lit(as_of).cast("date"), 1).cast("string"))
    found = pages.select(F.col("page_id").alias("notion_page_id"), *(F.col(c).alias(f"new_{c}") for c in ("verdict", "reason", "notes")), F.lit(True).alias("there"))
    j = cand.where(past).select("id", "notion_page_id").join(found, "notion_page_id", "left")
    outcome = F.when(F.col("there").isNull(), "missing").when(C.blank(F.col("new_verdict")), "no_verdict").when(F.col("new_verdict").isin(*VERDICTS), "synced").otherwise("error")
    synced = outcome == "synced"
    return j.select("id", outcome.alias("outcome"), *(F.when(synced, F.col(f"new_{c}")).alias(c) for c in ("verdict", "reason", "notes")), F.when(synced, now).alias("synced_at"))


def orphan_changes(board: DataFrame, cand: DataFrame, today: str) -> DataFrame:
    """What follows from one assignment of untracked pages to rows: (op, id, page_id, and the fields to be set). ``update`` ties a row to its page, ``insert`` is a stub of a page that its user
    added, ``report`` a page that can't be recovered, with the reason."""
    paired = linkage.orphan_recovery(board, cand).join(board.select("page_id", "title", "date"), "page_id")
    is_row, is_stub = F.col("action") == "matched", F.col("action") == "stub"
    op = F.when(is_row, "update").when(is_stub, "insert").otherwise("report")
    tied = is_row | is_stub
    stub = lambda v: F.when(is_stub, v)
    return paired.select(
        op.alias("op"), "id", "page_id", stub(F.lit(today)).alias("run_date"), stub(F.col("title")).alias("name"), stub(F.col("date")).alias("date"), stub(F.lit("manual")).alias("source"),
        stub(F.lit(0)).alias("score"), stub(F.lit("Manual")).alias("tier"), F.when(tied, "written").alias("pipeline_state"), F.when(tied, "active").alias("notion_status"), stub(F.lit(1)).alias("travel_lookup_failed"),
        F.when(~tied, F.when(F.col("action") == "duplicate", "duplicate").otherwise("no title or date")).alias("reason"),
    )
