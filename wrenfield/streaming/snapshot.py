"""A stored snapshot of candidates that micro-batches are merged into.

Rows are kept in buckets of their URL key, and, for the second identity, (normalised name, date, id) in buckets of name and date. A batch reads the
buckets that its rows fall into, drops what is there already (D1), moves stored rows whose URL came with another date (D2), and writes anew only the buckets that change. Each
batch is a version named after its batch id (``versions.py``): a batch that comes again is skipped, and a restarted stream goes on from
the last manifest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import linkage
from ..staging import staged
from ..versions import Versions

STORED = ["id", "name", "url", "date", "end_date", "pipeline_state", "notion_page_id"]
ROWS = T.StructType([T.StructField(c, T.LongType() if c == "id" else T.StringType()) for c in STORED] + [T.StructField(c, T.StringType()) for c in ("url_id", "name_id")])
NAMES = T.StructType([T.StructField("name_id", T.StringType()), T.StructField("date", T.StringType()), T.StructField("id", T.LongType())])


class Snapshot:
    """``buckets`` is fixed for the life of a snapshot, so that a bucket's rows fit a task; ``names``: whether (name, date) is an identity, too."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16, names: bool = True):
        self.versions, self.buckets, self.names = Versions(spark, path), buckets, names

    def _bucket(self, *of: Column) -> Column:
        return F.pmod(F.xxhash64(*of), F.lit(self.buckets)).cast("int").alias("bucket")

    def _row_bucket(self) -> Column:
        return self._bucket(F.coalesce(F.col("url_id"), F.concat(F.lit("id:"), F.col("id").cast("string"))))

    def _read(self, table: str, buckets: list[int]) -> DataFrame:
        return self.versions.read({"rows": ROWS, "names": NAMES}[table], [f"{table}/{b}" for b in buckets])

    def rows(self, number: int | None = None) -> DataFrame:
        """All stored rows of a version, by default the last."""
        parts = [n for n in self.versions.manifest(number)["parts"] if n.startswith("rows/")]
        return self.versions.read(ROWS, parts, number)

    def _touched(self, df: DataFrame, bucket: Column) -> list[int]:
        return sorted(r[0] for r in df.select(bucket).distinct().collect())  # at most `buckets` numbers

    def apply(self, batch: DataFrame, number: int) -> None:
        """Merge a batch as the version ``number``, once."""
        if number in self.versions.numbers():
            return
        new = staged(linkage.keys(batch).select(*STORED, "url_id", "name_id"))
        stored = self._read("rows", self._touched(new, self._row_bucket()))
        changes = self._moved(new, stored)
        kept = self._fresh(new, stored)
        parts = dict(self.versions.manifest()["parts"])
        folder = self.versions.new_folder(f"batch-{number}")

        to = changes.select("url_id", F.struct("new_date", "new_end_date", "new_state").alias("to"))
        moved = F.col("to").isNotNull()
        now = stored.join(to, "url_id", "left").withColumns(
            {"date": F.when(moved, F.col("to.new_date")).otherwise(F.col("date")), "end_date": F.when(moved, F.col("to.new_end_date")).otherwise(F.col("end_date")), "pipeline_state": F.when(moved, F.col("to.new_state")).otherwise(F.col("pipeline_state"))}
        )
        both = changes.select("url_id", "id").unionByName(kept.select("url_id", "id"))
        parts |= self._write("rows", now.select(ROWS.fieldNames()).unionByName(kept), self._row_bucket(), self._touched(both, self._row_bucket()), folder)
        if self.names:
            gone = changes.select("name_id", "date", "id")
            come = kept.select(NAMES.fieldNames()).unionByName(changes.select("name_id", F.col("new_date").alias("date"), "id"))
            of = self._bucket(F.col("name_id"), F.col("date"))
            buckets = self._touched(gone.unionByName(come), of)
            held = self._read("names", buckets).join(gone, ["name_id", "date", "id"], "left_anti")
            parts |= self._write("names", held.unionByName(come), of, buckets, folder)
        self.versions.publish(number, parts)

    def _moved(self, new: DataFrame, stored: DataFrame) -> DataFrame:
        """Stored rows whose URL's newest row of the batch has another date (D2)."""
        newest = new.where("url_id is not null").groupBy("url_id").agg(F.max_by(F.struct("date", "end_date"), "id").alias("n"))
        found = stored.join(newest, "url_id").where(~F.col("n.date").eqNullSafe(F.col("date")))
        back = F.col("pipeline_state").isin("expired", "llm_rejected", "vetoed") & F.col("notion_page_id").isNull()
        state = F.when(back, "pending_llm").otherwise(F.col("pipeline_state"))
        return staged(found.select("url_id", "name_id", "date", "id", F.col("n.date").alias("new_date"), F.col("n.end_date").alias("new_end_date"), state.alias("new_state")))

    def _fresh(self, new: DataFrame, stored: DataFrame) -> DataFrame:
        """Rows of the batch that no stored row and no kept earlier row of the batch has an identity of (D1)."""
        rest = new.join(stored.where("url_id is not null").select("url_id"), "url_id", "left_anti")
        if self.names:
            taken = self._read("names", self._touched(new, self._bucket(F.col("name_id"), F.col("date"))))
            rest = staged(rest.join(taken.select("name_id", "date").distinct(), ["name_id", "date"], "left_anti").select(ROWS.fieldNames()))
            first = linkage.greedy(rest)
        else:
            first = rest.groupBy(F.coalesce("url_id", F.concat(F.lit("id:"), F.col("id").cast("string")))).agg(F.min("id").alias("id")).select("id")
        return staged(rest.join(first, "id").select(ROWS.fieldNames()))

    def _write(self, table: str, rows: DataFrame, bucket: Column, buckets: list[int], folder: str) -> dict[str, str]:
        if not buckets:
            return {}
        rows = rows.withColumn("bucket", bucket).where(F.col("bucket").isin(buckets))
        rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{folder}/{table}")
        at = {b: f"{folder}/{table}/bucket={b}" for b in buckets}
        if table == "names":  # a bucket's last name may have moved away
            for b in [b for b, p in at.items() if not self.versions.exists(p)]:
                self.versions.spark.createDataFrame([], NAMES).write.parquet(at[b])
        return {f"{table}/{b}": p for b, p in at.items()}

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Merge what the stream has; it can be stopped and started again at any time."""
        stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
