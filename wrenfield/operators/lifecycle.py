"""State changes of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from .linkage import told

OPEN = ("pending_llm", "pending_travel", "ready_to_write", "write_failed", "incomplete")


def expire(cand: DataFrame, as_of: str) -> DataFrame:
    over = F.col("pipeline_state").isin(*OPEN) & (F.coalesce("end_date", "date") < as_of)
    return cand.withColumn("pipeline_state", F.when(over, "expired").otherwise(F.col("pipeline_state")))


def regressions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows with a page that went back to a pending state; a publish must not follow."""
    now = after.select("id", F.col("pipeline_state").alias("now"))
    j = before.where("notion_page_id is not null").select("id", F.col("pipeline_state").alias("was")).join(now, "id")
    return j.where(F.col("now").isin("pending_llm", "pending_travel") & (F.col("now") != F.col("was")))


def retry_failed(cand: DataFrame) -> DataFrame:
    return cand.withColumn("pipeline_state", F.when(F.col("pipeline_state") == "write_failed", "ready_to_write").otherwise(F.col("pipeline_state")))


def mark_attended(cand: DataFrame, matched: DataFrame) -> DataFrame:
    """``cand`` with ``user_attended``; rows that no match can be of stay where they are."""
    hit = staged(matched.select("id").distinct())
    rows = told(cand, hit, hit.count(), "id")
    found = rows.where("told").join(hit.withColumn("__hit", F.lit(True)), "id", "left")
    rows = found.unionByName(rows.where("not told").withColumn("__hit", F.lit(None).cast("boolean")))
    return rows.withColumn("user_attended", F.col("__hit").isNotNull() & (F.coalesce("verdict", F.lit("")) != "Not Going")).drop("__hit", "told")


def record_calendar(have: DataFrame, new: DataFrame) -> DataFrame:
    """``have`` and the rows of ``new`` with other ids; rows without an id are always added."""
    keyed = new.where("calendar_id is not null").join(have.select("calendar_id"), "calendar_id", "left_anti")
    return have.unionByName(keyed).unionByName(new.where("calendar_id is null"))
