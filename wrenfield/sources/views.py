"""Candidate tables as views over the driver tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME = "concat(event_type, ' night ', cast(user_id AS string), ' part ', cast(cast(floor((day(ts) - 1) / 6) AS int) AS string))"

VIEWS = {
    "ce": f"""
SELECT event_id AS id, {_NAME} AS name, cast(cast(ts AS date) AS string) AS date,
       CASE WHEN event_id % 11 = 0 THEN cast(cast(ts AS date) + 2 AS string) END AS end_date,
       substr(cast(ts AS string), 12, 5) AS time,
       CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'Annex' ELSE concat('Venue ', cast(user_id % 4 AS string)) END AS venue_name,
       event_type AS organiser,
       CASE WHEN event_id % 6 = 0 THEN 'Free' ELSE concat('£', cast(cast(floor(value) AS bigint) AS string)) END AS cost,
       CASE event_id % 5 WHEN 0 THEN 'Workshop' WHEN 1 THEN 'Talk' WHEN 2 THEN 'Concert' WHEN 3 THEN 'Social meetup' ELSE NULL END AS format_type,
       CASE WHEN event_id % 7 < 3 THEN 'Newsletter' WHEN event_id % 7 < 5 THEN 'Meetup' ELSE 'Luma' END AS source,
       concat('https://lu.ma/', event_type, cast(event_id % 400 AS string)) AS url,
       props AS source_snapshot,
       CASE event_id % 9 WHEN 0 THEN 'vetoed' WHEN 1 THEN 'pending_llm' WHEN 2 THEN 'pending_travel' WHEN 3 THEN 'ready_to_write'
            WHEN 4 THEN 'llm_rejected' WHEN 5 THEN 'duplicate' WHEN 6 THEN 'write_failed' WHEN 7 THEN 'expired' ELSE 'written' END AS pipeline_state,
       CASE event_id % 4 WHEN 0 THEN 'Top Picks' WHEN 1 THEN 'Recommended' WHEN 2 THEN 'Borderline' ELSE 'Not Recommended' END AS llm_tier,
       CASE event_id % 11 WHEN 0 THEN 'Going' WHEN 1 THEN 'Maybe' WHEN 2 THEN 'Not Going' WHEN 3 THEN 'Undecided' ELSE NULL END AS verdict,
       cast(event_id % 12 AS int) AS score, cast(event_id % 95 AS int) AS travel_transit_min,
       CASE WHEN event_id % 9 = 8 THEN concat('page-', cast(event_id AS string)) END AS notion_page_id,
       CASE WHEN event_id % 2 = 0 THEN '2024-01-09' ELSE '2024-01-16' END AS run_date
FROM events""",
    "cd": "SELECT doc_id AS id, substr(text, 1, 40) AS name, text AS description, source AS organiser, lang, n_chars FROM documents",
    "pg": "SELECT page_id, url, html FROM pages",
    "em": """
SELECT concat('m', cast(conv_id AS string), '-', cast(turn AS string)) AS message_id, concat('sender', cast(conv_id % 7 AS string)) AS sender,
       role AS subject, text AS body_text, cast(conv_id % 4 AS int) AS events_extracted,
       cast(DATE '2024-01-01' + cast(conv_id % 30 AS int) AS string) AS email_date
FROM conversations""",
    "cal": """
SELECT event_id AS calendar_id, concat('Night ', event_type, ' ', cast(user_id AS string)) AS title,
       concat('Venue ', cast(user_id % 4 AS string), ', Springfield') AS location, cast(cast(ts AS date) AS string) AS date
FROM events WHERE event_id % 13 = 0""",
    "ve": """
SELECT concat('venue ', cast(user_id % 4 AS string)) AS venue_name, cast(max(event_id % 60) AS int) AS travel_transit_min,
       cast(cast(max(ts) AS date) AS string) AS lookup_date
FROM events WHERE user_id % 4 < 3 GROUP BY user_id % 4, user_id % 3""",
    "bd": f"""
SELECT concat('page-', cast(event_id AS string)) AS page_id, {_NAME} AS title, cast(cast(ts AS date) AS string) AS date,
       CASE event_id % 5 WHEN 0 THEN 'Going' WHEN 1 THEN 'Not Going' ELSE NULL END AS verdict, event_id % 10 = 0 AS archived
FROM events WHERE event_id % 9 = 8 AND event_id % 4 <> 3 OR event_id % 50 = 1""",
}
TABLES = "events documents pages conversations labels benchmark".split()


class Views:
    """The views of one folder of tables, as DataFrames by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        table = next(t for t in TABLES if re.search(rf"FROM {t}\b", VIEWS[name]))
        sql = re.sub(rf"FROM {table}\b", f"FROM {{{table}}}", VIEWS[name])
        made = self.spark.sql(sql, **{table: self.table(table)})
        setattr(self, name, made)
        return made


def with_views(sql: str) -> str:
    """``sql`` for DuckDB with the views that it names."""
    used = [f"{n} AS ({VIEWS[n]})" for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(used)}, {body[5:]}" if used else body
    return f"WITH {', '.join(used)} {body}" if used else body
