"""Versioned tables: data folders that never change, and small manifests of which each names the folders of one version.

A version is published by the rename of its manifest, so readers see all of it or nothing; a number is published once, which makes a batch that
comes again after a restart a step without effect. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Versions:
    """The versions under a folder of any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def numbers(self) -> list[int]:
        """Published versions, oldest first."""
        at = f"{self.path}/manifests"
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path(at))] if self.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith("."))

    def manifest(self, number: int | None = None) -> dict:
        """``parts`` (folder by name) and ``facts`` of a version, by default the last; empty before the first."""
        number = max(self.numbers(), default=None) if number is None else number
        if number is None:
            return {"parts": {}, "facts": {}}
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{number:012d}.json", wholetext=True).first()[0])

    def new_folder(self, name: str) -> str:
        return f"{self.path}/data/{name}-{uuid.uuid4().hex}"

    def publish(self, number: int, parts: dict[str, str], facts: dict | None = None) -> bool:
        """Make ``parts`` the version ``number``; False, and no effect, if that is published already."""
        final = f"{self.path}/manifests/{number:012d}.json"
        if self.exists(final):
            return False
        aside = f"{self.path}/manifests/.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(aside))
        out.write(bytearray(json.dumps({"parts": parts, "facts": facts or {}}).encode()))
        out.close()
        if not self._fs.rename(self._path(aside), self._path(final)):
            self.delete(aside)
            return False
        return True

    def read(self, schema: StructType, names: list[str] | None = None, number: int | None = None) -> DataFrame:
        """The parts ``names`` (default all) of a version, without those that it doesn't have."""
        parts = self.manifest(number)["parts"]
        paths = [p for n, p in sorted(parts.items()) if names is None or n in names]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def vacuum(self, keep: int) -> int:
        """Delete the data folders that none of the last ``keep`` versions names; how many went."""
        numbers = self.numbers()
        used = {p for n in numbers[-keep:] for p in self.manifest(n)["parts"].values()}
        gone = 0
        at = f"{self.path}/data"
        for s in self._fs.listStatus(self._path(at)) if self.exists(at) else []:
            name = s.getPath().getName()
            if not any(f"/data/{name}" in p for p in used):
                self.delete(f"{at}/{name}")
                gone += 1
        for n in numbers[:-keep]:
            self.delete(f"{self.path}/manifests/{n:012d}.json")
        return gone
