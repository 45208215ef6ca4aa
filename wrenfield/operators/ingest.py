"""From landed documents to candidates, with their guards."""

from __future__ import annotations

import datetime as dt
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..settings import DEFAULT, Settings
from .scoring import classify_format

NODE = "id string, title string, description string, dateTime string, endTime string, eventUrl string, venue struct<name:string,address:string,city:string,postalCode:string>, group struct<name:string>, feeSettings struct<amount:double,currency:string>"
DETAIL = "description_mirror string, hosts array<struct<name:string>>, event struct<name:string,location_mode:string,geo_address_info:map<string,string>>, ticket_info struct<price:struct<cents:long,currency:string>,max_price:struct<cents:long,currency:string>>, description string"
# What tells a place that is none, and business that is private.
VIRTUAL = [r"https?://", r"zoom\.us", r"meet\.google", r"teams\.microsoft", "microsoft teams", "teams meeting", r"webex\.com", "skype", "telephone", "phone call", "dial.?in", "conference call", "video call"]
PERSONAL = [r"^dr[\s\.]+\S+(\s+appointment)?$", r"\bappointment\b", r"\bcheck-?up\b", r"\bdentist\b", r"\bgp\b", r"\bphysio\b", r"\blesson\b", r"\bface to face\b"]
PERSONAL_PLACES = [r"\bclinic\b", r"\bsurgery\b"]


def ingest_nodes(raw: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Candidates of event nodes (``raw``: JSON text)."""
    n = raw.select(F.from_json("raw", NODE).alias("n"), "raw")
    day, time = C.local_datetime(F.col("n.dateTime"), s.timezone)
    end, _ = C.local_datetime(F.col("n.endTime"), s.timezone)
    amount, unit = F.bround("n.feeSettings.amount", 0).cast("long").cast("string"), F.col("n.feeSettings.currency")
    cost = F.when(F.coalesce(F.col("n.feeSettings.amount"), F.lit(0.0)) == 0, "Free").when(unit == "GBP", F.concat(F.lit("£"), amount)).otherwise(F.concat(unit, F.lit(" "), amount))
    address = F.array_join(F.filter(F.array("n.venue.name", "n.venue.address", "n.venue.city"), lambda x: F.coalesce(x, F.lit("")) != ""), ", ")
    return n.select(
        F.col("n.id").alias("id"), F.col("n.title").alias("name"), F.col("n.description").alias("description"), day.alias("date"), C.end_date_if_different(day, end).alias("end_date"), time.alias("time"),
        F.col("n.venue.name").alias("venue_name"), F.col("n.venue.postalCode").alias("venue_postcode"), address.alias("address"), F.coalesce(C.or_null(F.col("n.venue.city")), F.lit(s.city)).alias("area"),
        F.col("n.group.name").alias("organiser"), cost.alias("cost"), classify_format(F.col("n.title"), F.col("n.description")).alias("format_type"), F.lit("Meetup").alias("source"), F.col("n.eventUrl").alias("url"), F.col("raw").alias("source_snapshot"),
    )


def _flat(node: object) -> str:
    """Text of a rich-text tree: blocks end in an empty line, breaks are line feeds."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, list):
            todo.extend(reversed(x))
        elif isinstance(x, dict):
            kind = x.get("type")
            if kind == "text":
                out.append(x.get("text") or "")
            elif kind == "hardBreak":
                out.append("\n")
            else:
                if kind in ("paragraph", "heading", "blockquote", "listItem", "codeBlock"):
                    todo.append("\n\n")
                todo.append(x.get("content") or [])
    return "".join(out).strip()


@F.pandas_udf(T.StringType())
def rich_text(s: pd.Series) -> pd.Series:
    """A tree of any depth, so Python over Arrow batches."""

    def one(x):
        try:
            return _flat(json.loads(x)) if x else None
        except ValueError:
            return None

    return s.map(one)


def ingest_details(raw: DataFrame) -> DataFrame:
    """Candidates of detail documents; note, hosts and tickets stand beside the event."""
    d = raw.withColumn("d", F.from_json("raw", DETAIL))
    pounds = lambda c: F.concat(F.lit("£"), F.regexp_replace((F.col(f"{c}.cents") / 100).cast("decimal(12,2)").cast("string"), r"\.00$", ""))
    low, high = pounds("d.ticket_info.price"), pounds("d.ticket_info.max_price")
    cost = F.when(F.col("d.ticket_info.price").isNull(), None).when(F.col("d.ticket_info.max_price.cents") > F.col("d.ticket_info.price.cents"), F.concat(low, F.lit("–"), high)).when(F.col("d.ticket_info.price.cents") == 0, "Free").otherwise(low)
    geo = F.col("d.event.geo_address_info")
    rest = [c for c in raw.columns if c != "raw"]
    return d.select(*rest, F.col("d.event.name").alias("name"), rich_text(F.col("d.description_mirror")).alias("description"), F.col("d.hosts")[0]["name"].alias("organiser"), F.when(geo["mode"] == "shown", C.or_null(geo["address"])).alias("venue_name"), cost.alias("cost"))


def listing_filter(listing: DataFrame, until: str) -> DataFrame:
    return listing.where((F.col("location_type") == "offline") & F.col("id").isNotNull() & (F.col("start_at") <= until))


def physical_only(nodes: DataFrame) -> DataFrame:
    return nodes.where("eventType = 'PHYSICAL'")


def window_filter(cand: DataFrame, start: dt.date, weeks: int) -> DataFrame:
    return cand.where(F.col("date").try_cast("date").between(F.lit(start), F.lit(start + dt.timedelta(weeks=weeks))))


def priority_union(own: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    """One row per key, from ``own`` if it has it; filters come after, since a seen key stays seen."""
    both = own.withColumn("origin", F.lit("own")).unionByName(feed.withColumn("origin", F.lit("feed")))
    first = F.struct(F.col("origin") == "feed", F.col("id"))
    return both.groupBy(key).agg(F.min_by(F.struct(*both.columns), first).alias("r")).select("r.*")


def quarantine(responses: DataFrame) -> DataFrame:
    """Outcome of each response: rejected if it has errors and no data, warned if it has both."""
    failed = F.size(F.coalesce("errors", F.array().cast("array<string>"))) > 0
    outcome = F.when(failed & F.col("data").isNull(), "rejected").when(failed, "warned").otherwise("good")
    return responses.withColumn("outcome", outcome).withColumn("messages", F.when(failed, F.array_join(F.slice("errors", 1, 3), "; ")))


def source_health(log: DataFrame) -> DataFrame:
    return log.groupBy("source").agg(F.count("*").alias("n"), F.count("error").alias("n_errors")).withColumn("ok", F.col("n_errors") <= F.col("n") / 2)


def ingest_extractions(landed: DataFrame, existing: DataFrame, as_of: str) -> DataFrame:
    rows = landed.select("message_id", F.explode("candidates").alias("c")).select("c.*", F.col("message_id").alias("source_snapshot"))
    rows = rows.where(F.coalesce("end_date", "date") >= as_of).join(existing.select("name", "date").distinct(), ["name", "date"], "left_anti")
    luma = F.lower("url").rlike(r"lu\.ma|luma\.com")
    return rows.withColumn("source", F.lit("Newsletter")).withColumn("pipeline_state", F.lit("pending_llm")).withColumn("needs_enrichment", luma & C.blank(F.col("description")))


def schema_contract(df: DataFrame, required: list[str], migratable: dict[str, object], forbidden: list[str]) -> DataFrame:
    have = set(df.columns)
    rows = [(c, "ok" if c in have else "missing") for c in required] + [(c, "ok" if c in have else "migrate") for c in migratable] + [(c, "forbidden" if c in have else "ok") for c in forbidden]
    return df.sparkSession.createDataFrame(rows, "column_name string, status string")


def migrated(df: DataFrame, migratable: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in migratable.items() if c not in df.columns})


def upcoming(cand: DataFrame, as_of: str) -> DataFrame:
    """Rows that end on ``as_of`` or later."""
    return cand.where(F.coalesce("end_date", "date") >= as_of)


def as_new(cand: DataFrame) -> DataFrame:
    """Rows to append: pending, with what they were made of."""
    return cand.withColumn("pipeline_state", F.lit("pending_llm")).withColumn("source_snapshot", F.to_json(F.struct(*cand.columns)))


def append_candidates(cand: DataFrame, path: str) -> None:
    """Append new rows to the table at ``path``, a folder for each run date."""
    as_new(cand).write.partitionBy("run_date").mode("append").parquet(path)


def snapshot_guard(new: DataFrame, previous: DataFrame) -> DataFrame:
    """One row: whether a new snapshot lost rows or run dates."""
    gone = previous.select("run_date").distinct().join(new.select("run_date").distinct(), "run_date", "left_anti").agg(F.count("*").alias("lost_run_dates"))
    sizes = new.agg(F.count("*").alias("n_new")).join(F.broadcast(previous.agg(F.count("*").alias("n_old"))))
    return sizes.join(F.broadcast(gone)).withColumn("lost_rows", F.col("n_new") < F.col("n_old"))


def is_fresh(written: Column, run_start: str) -> Column:
    return F.coalesce(written.try_cast("timestamp_ntz") >= F.lit(run_start).cast("timestamp_ntz"), F.lit(False))


def _listed(v: Column, path: str, field: str) -> Column:
    """The field of each element of a list within a variant; an empty list if there is none."""
    return F.coalesce(F.transform(F.try_variant_get(v, path, "array<variant>"), lambda x: F.coalesce(F.try_variant_get(x, field, "string"), F.lit(""))), F.array().cast("array<string>"))


#: How a property of a kind is read from its variant.
PROPERTY = {
    "title": lambda v: F.array_join(_listed(v, "$.title", "$.plain_text"), ""),
    "rich_text": lambda v: F.array_join(_listed(v, "$.rich_text", "$.plain_text"), ""),
    "select": lambda v: F.try_variant_get(v, "$.select.name", "string"),
    "multi_select": lambda v: _listed(v, "$.multi_select", "$.name"),
    "checkbox": lambda v: F.coalesce(F.try_variant_get(v, "$.checkbox", "boolean"), F.lit(False)),
    "number": lambda v: F.try_variant_get(v, "$.number", "double"),
    "date": lambda v: F.substring(F.try_variant_get(v, "$.date.start", "string"), 1, 10),
}
# The properties of the three kinds of board pages, with the columns they become.
SHAPES = {
    "card": {
        "title": ("Event", "title"), "date": ("Date", "date"), "verdict": ("Verdict", "select"), "tier": ("Tier", "select"),
        "reason": ("Reason it failed", "select"), "notes": ("Notes", "rich_text"), "to_delete": ("To delete", "checkbox"),
    },
    "run": {
        "batch": ("Batch", "title"), "status": ("Status", "select"), "events_added": ("Events added", "number"), "issues": ("Issues", "rich_text"),
        "pipeline": ("Pipeline", "rich_text"), "duration": ("Duration", "rich_text"), "batch_date": ("Batch date", "date"), "trigger": ("Trigger", "select"),
    },
    "finding": {"finding_key": ("Finding key", "rich_text"), "types": ("Finding Type", "multi_select"), "type": ("Finding Type", "select"), "title": ("Month", "title")},
}


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.from_json("raw", "id string, archived boolean, in_trash boolean, properties map<string, variant>").alias("p"))


def board_flatten(pages: DataFrame, shape: str = "card") -> DataFrame:
    """Landed board pages (``raw``, JSON) as typed rows of one of the three shapes. A property that is missing or of another kind is null, an empty text or
    list, or false; text is joined from all its parts."""
    columns = {c: PROPERTY[kind](F.col("p.properties")[name]) for c, (name, kind) in SHAPES[shape].items()}
    gone = {"archived": F.coalesce("p.archived", F.lit(False)), "in_trash": F.coalesce("p.in_trash", F.lit(False))}
    if shape == "run":
        columns["events_added"] = F.coalesce(columns["events_added"], F.lit(0)).cast("long")
        columns |= {c: F.coalesce(columns[c], F.lit("")) for c in ("status", "batch_date", "trigger")}
    if shape == "finding":
        kind = F.coalesce(F.try_element_at(columns.pop("types"), F.lit(1)), columns["type"], F.lit(""))
        columns["type"] = F.translate(F.lower(kind), " -", "__")
    return _pages(pages).select(F.col("p.id").alias("page_id"), *(v.alias(k) for k, v in columns.items()), *((v.alias(k) for k, v in gone.items()) if shape == "card" else ()))


def property_kinds(pages: DataFrame) -> DataFrame:
    """(property, kind, n): what kinds of values each property has, over all pages; more than one kind tells that a board was changed."""
    one = _pages(pages).select(F.explode("p.properties").alias("property", "v"))
    kind = F.regexp_extract(F.schema_of_variant("v"), r"(title|rich_text|multi_select|select|checkbox|number|date): ", 1)
    return one.groupBy("property", kind.alias("kind")).agg(F.count("*").alias("n"))


def latest_steps(log: DataFrame) -> DataFrame:
    return log.groupBy("step").agg(F.max("at").alias("at"), F.max_by("outcome", "at").alias("outcome"))


def calendar_reason(title: Column, location: Column) -> Column:
    """Why a calendar row is no public event, or null."""
    place, said = F.lower(F.coalesce(location, F.lit(""))), F.lower(F.coalesce(title, F.lit("")))
    private = said.rlike("|".join(PERSONAL)) | place.rlike("|".join(PERSONAL_PLACES))
    return F.when(F.trim(place) == "", "empty").when(place.rlike("|".join(VIRTUAL)), "virtual").when(private, "personal")
