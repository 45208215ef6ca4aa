"""Shared pieces of the training-data operators: staged tables, salted joins, Arrow byte views."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on; a longer document is a step of its own.
STEP_BYTES = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); where it is unset, a temp folder in local mode and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="spark-stage-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Bytes of rows that go to a Python worker at once in a pipeline of several operators, whose executors hold what all of them have left.
BATCH_BYTES = 6_000_000


def modest_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """From now on Spark sends rows to Python workers in batches of at most ``most`` bytes, unless its batches are smaller already."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    have = spark.conf.get(name).rstrip("bB")
    if not have.isdigit() or int(have) > most:
        spark.conf.set(name, str(most))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: computed once, and no lineage before it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more; those whose results are still lazy must stay."""
    for df in staged:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def released(run):
    """``run`` over batches, after which the worker gives free memory back: Spark keeps workers for later tasks."""

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not glibc
                pass

    return tidy


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", salts: int = 16) -> DataFrame:
    """Equi-join of a large ``left`` whose keys may be hot with a ``right`` of one narrow row per key.

    Each left row is dealt to one of ``salts`` parts of its key, by its other columns and its input partition; right rows are copied to all of them, so
    that a hot key is spread, also one of equal rows. Null keys match nothing.
    """
    spread = F.pmod(F.hash(F.spark_partition_id(), *[F.col(c) for c in left.columns if c not in keys]), F.lit(salts))
    a = left.withColumn("__salt", spread.cast("int"))
    b = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, [*keys, "__salt"], how).drop("__salt")


def shielded(docs: DataFrame, *own: str):
    """``docs`` with all columns but ``own`` under names that no operator uses, and what gives them their names back."""
    names = docs.columns
    safe = [c if c in own else f"__column{i}" for i, c in enumerate(names)]
    return docs.toDF(*safe), lambda out: out.select(*safe).toDF(*names)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the row offsets into them."""
    arr = col.cast(pa.large_binary())
    if arr.null_count:
        arr = pc.fill_null(arr, b"")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def steps(off: np.ndarray, most: int = STEP_BYTES):
    """Row ranges of about ``most`` bytes each."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)

