"""Counts, health and feedback from attendance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

OPEN = ("pending_llm", "pending_travel", "ready_to_write", "write_failed")
DONE = ("vetoed", "llm_rejected", "written", "duplicate")
HIGH, LOW = ("Top Picks", "Recommended"), ("Borderline", "Not Recommended")


def funnel(cand: DataFrame, as_of: str) -> DataFrame:
    """Per run date: all rows, the closed states, and the open ones of upcoming rows, in one pass."""
    up = F.coalesce("end_date", "date") >= as_of
    closed = [F.count_if(F.col("pipeline_state") == s).alias(s) for s in DONE]
    open_ = [F.count_if((F.col("pipeline_state") == s) & up).alias(s) for s in OPEN]
    return cand.groupBy("run_date").agg(F.count("*").alias("total"), *closed, *open_)


def run_status(counts: DataFrame, most: int = 3) -> DataFrame:
    """Status of each run from its funnel: waiting rows count above ``most``, unwritten ones always."""
    part = lambda c, cond: F.when(cond, F.concat(F.col(c).cast("string"), F.lit(f" {c}")))
    issues = F.concat_ws("; ", *(part(c, F.col(c) > most) for c in ("pending_llm", "pending_travel")), *(part(c, F.col(c) > 0) for c in ("ready_to_write", "write_failed")))
    status = F.when(F.col("total") == 0, "Failed").when((issues != "") & (F.col("written") == 0), "Incomplete").when(issues != "", "Partial").otherwise("Success")
    return counts.select("run_date", status.alias("status"), issues.alias("issues"))


def sender_rollup(emails: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    rows = emails.where(~F.col("sender").isin(*excluded)) if excluded else emails
    return rows.groupBy("sender").agg(F.sum("events_extracted").alias("events"), F.array_join(F.array_sort(F.collect_set("email_date")), ",").alias("dates"))


def log_line(metrics: DataFrame, run_start: str) -> DataFrame:
    """Per step a phrase; what is missing or stale is said to be."""
    fresh = F.coalesce(F.col("written_at").try_cast("timestamp_ntz") >= F.lit(run_start).cast("timestamp_ntz"), F.lit(False))
    text = F.when(F.col("value").isNull(), F.concat("step", F.lit(": no data"))).otherwise(F.concat(F.when(fresh, "").otherwise("(stale) "), "step", F.lit(": "), F.col("value").cast("string")))
    return metrics.select("step", text.alias("line"))


def shown_tier(review: Column, rule: Column) -> Column:
    return F.coalesce(C.or_null(review), rule)


def verdict_class(verdict: Column) -> Column:
    return F.when(verdict.isin("Going", "Maybe"), "confirmed").when(verdict == "Not Going", "conflict").when(C.blank(verdict), "unreviewed")


def correction(state: Column, verdict: Column, tier: Column) -> Column:
    """What attendance says of the pipeline's choice: the first case that fits."""
    return (
        F.when(state == "vetoed", "false_veto")
        .when(state == "expired", "expired_but_attended")
        .when(state == "llm_rejected", "false_llm_reject")
        .when((verdict == "Going") & tier.isin(*LOW), "tier_mismatch")
        .when((verdict == "Not Going") & tier.isin(*HIGH), "over_recommended")
    )


def interest_evolution(attended: DataFrame, cand: DataFrame) -> DataFrame:
    """(kind, value, n): attended formats, venues and organisers of two or more, and declined formats."""
    rows = attended.select(F.coalesce(C.or_null(F.col("format_type")), F.lit("Other")).alias("format"), C.or_null(F.col("venue_name")).alias("venue"), C.or_null(F.col("organiser")).alias("organiser"))
    sets = rows.groupingSets([["format"], ["venue"], ["organiser"]], "format", "venue", "organiser").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 3, "format").when(F.col("g") == 5, "venue").otherwise("organiser")
    seen = sets.select(kind.alias("kind"), F.coalesce("format", "venue", "organiser").alias("value"), "n").where("value is not null and (kind = 'format' or n >= 2)")
    declined = cand.where("verdict = 'Not Going'").groupBy(F.coalesce(C.or_null(F.col("format_type")), F.lit("Other")).alias("value")).agg(F.count("*").alias("n"))
    return seen.unionByName(declined.select(F.lit("declined").alias("kind"), "value", "n"))


def suggestions(interest: DataFrame, vetoes: DataFrame) -> DataFrame:
    """Texts: vetoes to relax, then repeated venues and organisers."""
    relax = vetoes.select(F.lit(1).alias("rank"), F.concat(F.lit("Relax veto "), "veto_reason").alias("text"))
    real = ~F.lower("value").isin(*C.PLACEHOLDERS)
    again = interest.where(F.col("kind").isin("venue", "organiser") & real).select(F.when(F.col("kind") == "venue", 2).otherwise(3).alias("rank"), F.concat(F.lit("Follow "), "kind", F.lit(" "), "value", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("text"))
    return relax.unionByName(again)


def findings(corrections: DataFrame) -> DataFrame:
    """(finding_key, type, n, dates) of corrections (correction, organiser, venue_name, name, date, veto_reason).

    A correction belongs to its organiser if that has two or more, else to its venue, else to itself; vetoes to
    their key.
    """
    org, place = C.or_null(F.lower(F.col("organiser"))), C.or_null(F.lower(F.col("venue_name")))
    rows = corrections.withColumn("org", org).withColumn("place", place)
    big = lambda c: rows.where(f"{c} is not null").groupBy(c).agg(F.count("*").alias(f"n_{c}")).where(f"n_{c} >= 2")
    j = rows.join(big("org"), "org", "left").join(big("place"), "place", "left")
    key = (
        F.when(F.col("correction") == "false_veto", F.concat(F.lit("veto:"), "veto_reason"))
        .when(F.col("n_org").isNotNull(), F.concat(F.lit("organiser:"), "org"))
        .when(F.col("n_place").isNotNull(), F.concat(F.lit("series:"), "place"))
        .otherwise(F.concat_ws(":", "correction", C.normalise_ascii(F.col("name")), "date"))
    )
    keyed = j.withColumn("finding_key", key)
    return keyed.groupBy("finding_key").agg(F.count("*").alias("n"), F.min("date").alias("first_seen"), F.max("date").alias("last_seen"))


def rationale(found: DataFrame) -> DataFrame:
    kind = F.substring_index("finding_key", ":", 1)
    said = F.when(kind == "veto", "A veto keeps out events that were attended").when(kind == "organiser", "Events of this organiser were judged wrongly").when(kind == "series", "Events of this place were judged wrongly").otherwise("An event was judged wrongly")
    return found.select("finding_key", F.format_string("%s (%d)", said, F.col("n")).alias("rationale"))


def accumulate(state: DataFrame, new: DataFrame, as_of: str) -> DataFrame:
    """State (finding_key, evidence, events, last_seen) with new findings (finding_key, events): counted and appended."""
    j = state.join(new.select("finding_key", F.col("events").alias("more")), "finding_key", "full_outer")
    none = F.array().cast("array<string>")
    evidence = F.coalesce("evidence", F.lit(0)) + F.col("more").isNotNull().cast("int")
    return j.select("finding_key", evidence.alias("evidence"), F.concat(F.coalesce("events", none), F.coalesce("more", none)).alias("events"), F.when(F.col("more").isNotNull(), as_of).otherwise(F.col("last_seen")).alias("last_seen"))


def apply_findings(approved: DataFrame, state: DataFrame, overrides: DataFrame) -> DataFrame:
    """(finding_key, action): added, present, missing or manual."""
    kind, target = F.substring_index("finding_key", ":", 1), F.lower(F.substring_index("finding_key", ":", -1))
    j = approved.join(state.select("finding_key", F.lit(True).alias("known")), "finding_key", "left").withColumn("target", target)
    j = j.join(overrides.select(F.lower("target").alias("target"), F.lit(True).alias("have")).distinct(), "target", "left")
    return j.select("finding_key", F.when(~kind.isin("organiser", "series"), "manual").when(F.col("known").isNull(), "missing").when(F.col("have"), "present").otherwise("added").alias("action"))


def pipeline_health(runs: DataFrame, expected: str | None = None) -> DataFrame:
    """One row: health by the latest run, counts by status, events added. Without a run since ``expected``, a run was missed."""
    last = F.max_by("status", F.struct("batch_date", "status"))
    health = F.when(last == "Success", "healthy").when(last.isin("Partial", "Incomplete"), "degraded").when(last == "Failed", "failed").otherwise("unknown")
    health = F.when(F.coalesce(F.max("batch_date") < expected, F.lit(True)), "missed").otherwise(health) if expected else health
    return runs.agg(health.alias("health"), *(F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in ("Success", "Partial", "Incomplete", "Failed")), F.sum("events_added").alias("events_added"))


# Kinds of failure in the order in which they are looked for, with groups of words of which one each must be said.
FAILURES = {
    "access": (("token", "auth", "401"),),
    "write": (("write",), ("board", "notion", "fail")),
    "network": (("403", "host_not_allowed", "blocked"),),
    "stuck": (("stuck", "pending"),),
    "fetch": (("fetch",),),
}


def failure_class(issues: Column, status: Column) -> Column:
    """What went wrong in a run that did not succeed."""
    said = F.lower(F.coalesce(issues, F.lit("")))
    kinds = []
    for kind, groups in FAILURES.items():
        hit = F.lit(True)
        for words in groups:
            hit = hit & said.rlike("|".join(words))
        kinds.append(F.when(hit, kind))
    return F.when(status != "Success", F.coalesce(*kinds, F.when(status == "Failed", "unspecified").otherwise("other")))


def missing_runs(runs: DataFrame, as_of: dt.date, days: int, weekday: int) -> DataFrame:
    """Expected run dates in the look-back without a run. ``weekday``: 0 is Monday."""
    expected = runs.sparkSession.range(days).select(F.date_sub(F.lit(as_of), F.col("id").cast("int")).alias("d")).where(F.weekday("d") == weekday)
    return expected.select(F.col("d").cast("string").alias("run_date")).join(runs.select("run_date").distinct(), "run_date", "left_anti")


def taste(attended: DataFrame, fmt: Column | None = None) -> DataFrame:
    """(kind, value, n): venues, formats, and series of two or more, by how often; the first and last date."""
    venue = attended.groupBy(C.venue_short(F.col("location")).alias("value")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("venue"))
    series = attended.groupBy(C.title_stem(F.col("title")).alias("value")).agg(F.count("*").alias("n")).where("n >= 2").withColumn("kind", F.lit("series"))
    ends = attended.agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count("*").alias("n")).where("n > 0")
    dates = ends.select(F.explode(F.array(F.struct(F.col("first").alias("value"), "n", F.lit("first date").alias("kind")), F.struct(F.col("last").alias("value"), "n", F.lit("last date").alias("kind")))).alias("r")).select("r.*")
    out = venue.unionByName(series).unionByName(dates)
    if fmt is not None:
        out = out.unionByName(attended.groupBy(fmt.alias("value")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("format")))
    return out.where("value <> ''")


def qa_checks(cand: DataFrame, run_date: str) -> DataFrame:
    """(check_name, n_bad, status): one aggregate over the run's rows, unpivoted."""
    rows = cand.where(F.col("run_date") == run_date)
    luma = F.col("url").rlike(r"^https://(lu\.ma|luma\.com)/.+$")
    bad = {
        "url_shape": (F.col("source") == "Luma") & ~luma,
        "tracking_url": C.is_tracking(F.col("url")),
        "name": C.blank(F.col("name")),
        "no_format": F.col("format_type").isNull(),
        "vetoed_positive": (F.col("pipeline_state") == "vetoed") & (F.col("score") > 0),
        "written_without_page": (F.col("pipeline_state") == "written") & F.col("notion_page_id").isNull(),
        "page_not_written": (F.col("pipeline_state") != "written") & F.col("notion_page_id").isNotNull(),
    }
    one = rows.agg(*(F.count_if(c).alias(k) for k, c in bad.items()))
    long = one.unpivot([], list(bad), "check_name", "n_bad")
    return long.withColumn("status", F.when(F.col("n_bad") == 0, "pass").otherwise("fail"))


def qa_fix_plan(checks: DataFrame) -> DataFrame:
    action = F.when(F.col("check_name").isin("url_shape", "tracking_url"), "veto").when(F.col("check_name") == "no_format", "rescore").when(F.col("check_name") == "vetoed_positive", "revalidate").otherwise("remediate")
    return checks.where("status = 'fail'").select("check_name", action.alias("action"))


# Days of waiting that are looked at, and percentages above which a run is bad.
WAIT_DAYS, BORDERLINE_PERCENT, CORRECTED_PERCENT = 28, 30, 20
#: Checks of rows and of shares: whether a job can mend what fails (``qa_actions``) or a person must look.
QA_FIXABLE = {
    "meetup_url": True, "luma_url": True, "tracked": True, "nameless": True, "undescribed": True, "snapshot": True, "unscored": True, "formatless": True, "vetoed_with_score": False,
    "waiting": False, "half_reviewed": False, "page_missing": False, "page_differs": True, "place_unknown": True, "hidden": True, "borderline_share": True, "corrected_share": False,
}
QA_VETOED = ("meetup_url", "luma_url", "tracked", "nameless", "undescribed", "snapshot")


def qa_findings(cand: DataFrame, venues: DataFrame, board: DataFrame, run_date: str) -> DataFrame:
    """(check_name, id): what is wrong with rows of a run, and which rows of any run wait for review.

    One pass after two equi-joins; a row gets one output row for each check it fails. ``board`` has one row a page.
    Rows that were entered by hand have no source to compare with.
    """
    known = venues.select(F.lower(F.trim("venue_name")).alias("__venue")).distinct()
    pages = board.select(F.col("page_id").alias("__page"), F.col("title").alias("__title"), F.col("date").alias("__date"), F.col("archived").alias("__archived"))
    rows = cand.join(known, F.lower(F.trim("venue_name")) == F.col("__venue"), "left").join(pages, F.col("notion_page_id") == F.col("__page"), "left")
    ours, live = F.col("run_date") == run_date, F.col("pipeline_state") != "vetoed"
    fetched, written = ours & ~F.col("source").eqNullSafe("manual"), ours & (F.col("pipeline_state") == "written") & F.col("notion_page_id").isNotNull()
    listed = lambda source, pattern: fetched & (F.col("source") == source) & ~C.blank(F.col("url")) & ~F.col("url").rlike(pattern)
    kept = F.col("source_snapshot")
    said = F.get_json_object(kept, "$.name")
    last = F.date_add(F.lit(run_date).cast("date"), WAIT_DAYS).cast("string")
    there = F.col("__page").isNotNull()
    bad = {
        "meetup_url": listed("Meetup", r"^https://(www\.)?meetup\.com/[^/]+/events/\d+"),
        "luma_url": listed("Luma", r"^https://(lu\.ma|luma\.com)/.+$"),
        "tracked": fetched & (F.col("source") != "Newsletter") & C.is_tracking(F.col("url")),
        "nameless": fetched & live & C.blank(F.col("name")),
        "undescribed": fetched & live & C.blank(F.col("description")),
        "snapshot": fetched & F.col("source").isin("Meetup", "Luma") & ~C.blank(kept) & (F.try_parse_json(kept).isNull() | (F.trim(said) != F.trim("name"))),
        "unscored": ours & live & F.col("score").isNull() & ~C.blank(F.col("description")),
        "formatless": ours & live & F.col("format_type").isNull(),
        "vetoed_with_score": ours & ~live & (F.col("score") > 0) & ~F.coalesce(F.col("veto_reason"), F.lit("")).startswith("QA:"),
        "waiting": (F.col("pipeline_state") == "pending_llm") & F.col("llm_reviewed").isNull() & F.col("date").between(F.lit(run_date), last),
        "half_reviewed": ours & F.col("llm_reviewed").isNotNull() & (F.col("llm_tier").isNull() | F.col("llm_reasoning").isNull()),
        "page_missing": written & ~there,
        "page_differs": written & there & ~(F.col("__title").eqNullSafe(F.col("name")) & F.col("__date").eqNullSafe(F.col("date"))),
        "place_unknown": written & ~C.blank(F.col("venue_name")) & F.col("__venue").isNull(),
        "hidden": written & F.col("__archived"),
    }
    failed = F.array_compact(F.array(*(F.when(cond, F.lit(name)) for name, cond in bad.items())))
    return rows.select("id", F.explode(failed).alias("check_name")).select("check_name", "id")


def qa_shares(cand: DataFrame, corrected: DataFrame, run_date: str) -> DataFrame:
    """(check_name, n_bad, n_all): borderline rows, and rows that hard vetoes corrected (``corrected``: id), of the accepted ones."""
    rows = cand.where((F.col("run_date") == run_date) & F.col("llm_tier").isNotNull() & (F.col("llm_tier") != "Not Recommended"))
    rows = rows.join(corrected.select("id").distinct().withColumn("__corrected", F.lit(True)), "id", "left")
    one = rows.agg(F.count("*").alias("n"), F.count_if(F.col("llm_tier") == "Borderline").alias("b"), F.count("__corrected").alias("c"))
    share = lambda name, n: F.struct(F.lit(name).alias("check_name"), F.col(n).alias("n_bad"), F.col("n").alias("n_all"))
    return one.select(F.explode(F.array(share("borderline_share", "b"), share("corrected_share", "c"))).alias("r")).select("r.*")


def qa_report(found: DataFrame, shares: DataFrame) -> DataFrame:
    """(check_name, status, n_bad, detail, fixable) of every check; a share of nothing is a warning."""
    percent = F.expr("n_bad * 100 div n_all")
    most = F.when(F.col("check_name") == "borderline_share", BORDERLINE_PERCENT).otherwise(CORRECTED_PERCENT)
    of_rows = found.groupBy("check_name").agg(F.count("*").alias("n_bad"))
    names = found.sparkSession.createDataFrame(list(QA_FIXABLE.items()), "check_name string, fixable boolean")
    j = names.join(of_rows.withColumn("n_all", F.lit(None).cast("long")).unionByName(shares), "check_name", "left").withColumn("n_bad", F.coalesce("n_bad", F.lit(0)))
    good = F.when(F.col("n_all").isNull(), F.col("n_bad") == 0).when(F.col("n_all") > 0, percent <= most)
    status = F.when(good, "pass").when(~good, "fail").otherwise("warn")
    detail = F.when(F.col("n_all").isNull(), F.format_string("%d rows", F.col("n_bad"))).when(F.col("n_all") > 0, F.format_string("%d of %d, %d %%", F.col("n_bad"), F.col("n_all"), percent)).otherwise("nothing to count")
    return j.select("check_name", status.alias("status"), "n_bad", detail.alias("detail"), (F.col("fixable") & (status == "fail")).alias("fixable"))


def qa_tally(report: DataFrame) -> DataFrame:
    count = lambda cond, name: F.count_if(cond).alias(name)
    status = F.col("status")
    return report.agg(count(status == "pass", "passed"), count(status == "fail", "failed"), count(status == "warn", "warned"), count(F.col("fixable"), "fixable"), count((status == "fail") & ~F.col("fixable"), "needs_attention"))


def qa_actions(found: DataFrame, cand: DataFrame) -> DataFrame:
    """(id, action, reason, flag_page): one action for each row a job can mend, the first that applies; pages of vetoed rows are flagged."""
    name = F.col("check_name")
    rank = F.when(name.isin(*QA_VETOED), 0).when(name == "unscored", 1).when(name == "formatless", 2).when(name.isin("page_differs", "place_unknown", "hidden"), 3)
    first = found.withColumn("rank", rank).where("rank is not null").groupBy("id").agg(F.min(F.struct("rank", "check_name")).alias("top"))
    action = F.when(F.col("top.rank") == 0, "veto").when(F.col("top.rank") < 3, "rescore").otherwise("remediate")
    j = first.join(cand.select("id", "notion_page_id"), "id")
    return j.select("id", action.alias("action"), F.when(action == "veto", F.concat(F.lit("QA: "), "top.check_name")).alias("reason"), ((action == "veto") & F.col("notion_page_id").isNotNull()).alias("flag_page"))
