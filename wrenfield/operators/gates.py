"""Two-phase publication: a table is written aside, checked as it was written against the published one, and only then takes its place."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..versions import Versions
from . import ingest, lifecycle, review

#: (published table, table to be published) to a row for each violation, or one row with a count ``n_violations``.
Check = Callable[[DataFrame, DataFrame], DataFrame]


class Refused(Exception):
    """A table failed its checks; the published one stands."""


@dataclass(frozen=True)
class Outcome:
    accepted: bool
    reasons: dict[str, int]
    version: int | None


def lost_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    return ingest.snapshot_guard(after, before).where("lost_rows").select((F.col("n_old") - F.col("n_new")).alias("n_violations"))


def lost_run_dates(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.select("run_date").distinct().join(after.select("run_date").distinct(), "run_date", "left_anti")


def crowded(as_of: str) -> Check:
    """More pending rows than a review may have."""
    return lambda before, after: review.volume(after, as_of).where("status = 'abort'").select(F.col("n").alias("n_violations"))


CHECKS: dict[str, Check] = {"lost_rows": lost_rows, "lost_run_dates": lost_run_dates, "regressions": lifecycle.regressions}


def publish(versions: Versions, new: DataFrame, checks: dict[str, Check] = CHECKS, part: str = "table") -> Outcome:
    """Publish ``new`` as the next version if no check finds a violation; else what was published stays as it is. The first version is not checked
    against another one."""
    folder = versions.new_folder(part)
    new.write.parquet(folder)
    written = versions.spark.read.schema(new.schema).parquet(folder)
    last = max(versions.numbers(), default=None)
    before = versions.read(new.schema, [part])
    reasons = {}
    for name, check in checks.items():
        found = check(before, written)
        n = found.agg(F.coalesce(F.sum("n_violations"), F.lit(0))).first()[0] if "n_violations" in found.columns else found.count()
        if n:
            reasons[name] = int(n)
    number = 0 if last is None else last + 1
    if reasons or not versions.publish(number, {part: folder}, {"checks": sorted(checks)}):
        versions.delete(folder)
        return Outcome(False, reasons or {"concurrent": 1}, last)
    return Outcome(True, {}, number)


def publish_or_refuse(versions: Versions, new: DataFrame, checks: dict[str, Check] = CHECKS) -> int:
    """The number of the new version."""
    outcome = publish(versions, new, checks)
    if not outcome.accepted:
        raise Refused(", ".join(f"{k}: {n}" for k, n in sorted(outcome.reasons.items())))
    return outcome.version
