"""What a run did, measured by the jobs that did it, and held against what the run claims.

The counts of a step are taken by ``DataFrame.observe`` while the step's table is written, so that they cost no further job and count the rows that
were written. They become rows (step, metric, value), from which the checks of steps and the deviations of a run are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The steps that a run logs, and whether one that is missing is a deviation.
EXPECTED = [
    ("preflight", True), ("newsletter-discovery", False), ("newsletter-sweep", True), ("fetch-action", True), ("apply-findings", False), ("enrich-descriptions", False),
    ("score-travel", True), ("dedup", False), ("llm-sense-check", True), ("validate-write-ready", False), ("write-notion-action", True), ("postmortem", False),
]
EVIDENCE = "step string, metric string, value long"
#: Counts of the rows of a run: metric to condition.
STEP_METRICS = {
    "fetched": "true", "scored": "score is not null", "reviewed": "llm_reviewed is not null", "written": "pipeline_state = 'written'", "rejected": "pipeline_state = 'llm_rejected'", "duplicates": "pipeline_state = 'duplicate'",
}


def write_step(rows: DataFrame, path: str, step: str, metrics: dict[str, str] = STEP_METRICS) -> list[tuple[str, str, int]]:
    """Write the table of a step; its evidence, as counted by the write itself."""
    seen = Observation(f"step-{step}")
    rows.observe(seen, *(F.count_if(F.coalesce(F.expr(c), F.lit(False))).alias(k) for k, c in metrics.items())).write.parquet(path)
    return [(step, k, int(v)) for k, v in seen.get.items()]


def table(spark: SparkSession, evidence: list[tuple[str, str, int]]) -> DataFrame:
    return spark.createDataFrame(evidence, EVIDENCE)


def _metric(evidence: DataFrame, name: str) -> Column:
    return F.max(F.when(F.col("metric") == name, F.col("value")))


def step_checks(evidence: DataFrame, summary: DataFrame, log: DataFrame, fetchers: DataFrame, run_date: str) -> DataFrame:
    """(check_name, status, detail) of a run's steps. ``summary``: batch_date, status, events_added, issues, one row or none; ``log``: step, outcome, detail;
    ``fetchers``: source, ok."""
    names = ("fetched", "scored", "reviewed", "written")
    one = evidence.agg(*(F.coalesce(_metric(evidence, n), F.lit(0)).alias(n) for n in names))
    there = F.col("fetched") > 0
    row = lambda name, good, detail, when=None: F.when(F.lit(True) if when is None else when, F.struct(F.lit(name).alias("check_name"), F.when(good, "pass").otherwise("fail").alias("status"), F.when(~good, detail).otherwise("").alias("detail")))
    steps = [row("fetch_step", there, F.lit(f"no candidates of {run_date}"))]
    steps += [row(f"{n}_step", F.col(n) > 0, F.format_string(f"none of %d rows is {n}", F.col("fetched")), there) for n in names[1:]]
    counted = one.select(F.explode(F.array_compact(F.array(*steps))).alias("r")).select("r.*")

    ours = F.col("batch_date").startswith(run_date)
    said = summary.agg(F.count("*").alias("n"), F.max(F.coalesce(ours, F.lit(False))).alias("ours"), F.max(F.when(ours, F.col("status"))).alias("status"), F.max(F.when(ours, F.coalesce("issues", F.lit("?")))).alias("issues"), F.max("batch_date").alias("batch_date"))
    other = F.struct(F.lit("summary_of_run").alias("check_name"), F.lit("warn").alias("status"), F.format_string(f"summary of %s, not {run_date}", F.col("batch_date")).alias("detail"))
    claims = F.when(F.col("n") == 0, F.array(row("summary_there", F.lit(False), F.lit("no summary")))).when(~F.col("ours"), F.array(other))
    claims = claims.otherwise(F.array(row("summary_there", F.lit(True), F.lit("")), row("run_status", ~(F.col("status") == "Failed"), F.concat(F.lit("failed: "), F.col("issues")))))
    claimed = said.select(F.explode(claims).alias("r")).select("r.*")

    failed = log.where("outcome = 'fail'").select(F.concat(F.lit("step "), "step").alias("check_name"), F.lit("fail").alias("status"), F.coalesce("detail", F.lit("no detail")).alias("detail"))
    any_ok = fetchers.agg(F.count("*").alias("n"), F.count_if(F.col("ok")).alias("n_ok")).where("n > 0")
    fetched = any_ok.select(F.lit("fetchers").alias("check_name"), F.when(F.col("n_ok") > 0, "pass").otherwise("fail").alias("status"), F.format_string("%d of %d sources", F.col("n_ok"), F.col("n")).alias("detail"))
    return counted.unionByName(claimed).unionByName(failed).unionByName(fetched)


def deviations(expected: DataFrame, log: DataFrame, checks: DataFrame, evidence: DataFrame, summary: DataFrame, run_date: str, needed: dict[str, str]) -> DataFrame:
    """(severity, kind, step, detail) of a run: ``deviation`` or ``note``.

    Expected steps (step, required) that the log hasn't, failed steps, failed and warned checks (check_name, status, detail), evidence that is missing (``needed``: metric to step), and a
    summary that claims more written rows than the table has.
    """
    row = lambda severity, kind, step, detail: (F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), F.col(step).alias("step"), detail.alias("detail"))
    missing = expected.join(log.select("step").distinct(), "step", "left_anti")
    out = missing.where("required").select(*row("deviation", "missing-step-log", "step", F.concat(F.lit("no entry for "), "step")))
    out = out.unionByName(missing.where("not required").select(*row("note", "missing-step-log", "step", F.concat(F.lit("no entry for "), "step"))))
    out = out.unionByName(log.where("outcome = 'fail'").select(*row("deviation", "step-failed", "step", F.coalesce("detail", F.lit("")))))
    for status, severity, kind in (("fail", "deviation", "qa-check-failed"), ("warn", "note", "qa-check-warned")):
        out = out.unionByName(checks.where(F.col("status") == status).select(*row(severity, kind, "check_name", F.coalesce("detail", F.lit("")))))
    wanted = expected.sparkSession.createDataFrame(list(needed.items()), "metric string, step string")
    bare = wanted.join(evidence.select("metric").distinct(), "metric", "left_anti")
    out = out.unionByName(bare.select(*row("deviation", "evidence-missing", "step", F.concat(F.lit("no count of "), "metric"))))
    claim = summary.where(F.col("batch_date").startswith(run_date)).agg(F.max("events_added").alias("claimed"))
    drift = claim.join(F.broadcast(evidence.agg(_metric(evidence, "written").alias("there")))).where("claimed > 0 and there < claimed")  # two rows of one
    said = F.format_string("summary: %d written, table: %d", F.col("claimed"), F.col("there"))
    return out.unionByName(drift.withColumn("step", F.lit("pipeline-summary")).select(*row("deviation", "summary-table-drift", "step", said)))
