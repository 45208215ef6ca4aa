"""Streams over landed files: ingest with seen keys, upserts of a stored snapshot (``snapshot.py``), and running counts.

The ``*_once`` forms land a table as files and run the stream over what is there (``availableNow``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..staging import new_folder, staged
from .snapshot import Snapshot


def _land(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a file stream, and a new folder for a query's state."""
    spark = df.sparkSession
    path = staged(df).inputFiles()[0].rsplit("/", 1)[0]
    return spark.readStream.schema(df.schema).parquet(path), f"{path}-state-{uuid.uuid4().hex}"


def timed(stream: DataFrame, delay: str) -> DataFrame:
    at = F.concat("date", F.lit(" "), "time", F.lit(":00")).try_cast("timestamp")
    return stream.withColumn("event_ts", at).withWatermark("event_ts", delay)


def ingest(stream: DataFrame, delay: str = "60 days") -> DataFrame:
    """First row of each URL key within the watermark."""
    return timed(stream.withColumn("url_key", C.url_key(F.col("url"))), delay).dropDuplicatesWithinWatermark(["url_key"]).select("url_key", "id", "name", "event_ts")


def funnel(stream: DataFrame, every: str = "1 day", delay: str = "60 days") -> DataFrame:
    """Counts by state in tumbling windows of event time, for update mode."""
    return timed(stream, delay).groupBy(F.window("event_ts", every).alias("span"), "pipeline_state").agg(F.count("*").alias("n")).select("span.start", "pipeline_state", "n")


def ingest_once(rows: DataFrame) -> DataFrame:
    stream, state = _land(rows)
    out = f"{state}-out"
    ingest(stream).select("url_key").writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return rows.sparkSession.read.parquet(out)


def funnel_once(rows: DataFrame) -> DataFrame:
    """The counts after the stream: every batch appends what it changed, and the last change of a window and state counts."""
    stream, state = _land(rows)
    out = f"{state}-out"

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/{number}")

    funnel(stream).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    said = rows.sparkSession.read.schema("start timestamp, pipeline_state string, n long, batch int").option("recursiveFileLookup", "true").parquet(out)
    last = said.groupBy("start", "pipeline_state").agg(F.max_by("n", "batch").alias("n"))
    return last.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "pipeline_state", "n")


def upsert_runs(rows: DataFrame, runs: int, names: bool, buckets: int = 16) -> Snapshot:
    """The snapshot after a stream over ``rows``, landed in ``runs`` parts of growing ids; for each the stream is started again from its checkpoint."""
    spark = rows.sparkSession
    path = new_folder(spark, "upserts")
    rows = staged(rows)
    top = rows.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] + 1
    for k in range(runs):
        rows.where(F.floor(F.col("id") * runs / top) == k).write.mode("append").parquet(f"{path}/landed")
        Snapshot(spark, f"{path}/stored", buckets, names).run(spark.readStream.schema(rows.schema).parquet(f"{path}/landed"), f"{path}/checkpoint")
    return Snapshot(spark, f"{path}/stored", buckets, names)
