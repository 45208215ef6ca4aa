"""Queries of venues, travel and lifecycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lifecycle, linkage, travel
from ..settings import DEFAULT as S
from .catalog import query
from .linkage import _MATCH, _UP, AS_OF

_LATEST = "(SELECT venue_name, arg_max(travel_transit_min, lookup_date || lpad(travel_transit_min::VARCHAR, 9, '0')) AS cached_min, max(lookup_date) AS cached_date FROM ve {0} GROUP BY venue_name)"


@query("venue_geo", f"SELECT id, cached_min, CASE WHEN cached_min IS NOT NULL THEN 'venue_name' END AS cached_by FROM ce c LEFT JOIN {_LATEST.format('')} v ON lower(c.venue_name) = v.venue_name")
def _(t):
    found = travel.with_cache(t.ce, t.ve, None, ["venue_name"])
    return found.select("id", F.col("cached.travel_transit_min").alias("cached_min"), "cached_by")


@query("travel_cache_lookup", f"""
SELECT id, coalesce(a.cached_min, b.cached_min) AS cached_min, CASE WHEN a.cached_min IS NOT NULL THEN 'venue_name' WHEN b.cached_min IS NOT NULL THEN 'venue_postcode' END AS cached_by
FROM ce c LEFT JOIN {_LATEST.format("WHERE lookup_date >= '2023-10-18'")} a ON lower(c.venue_name) = a.venue_name
LEFT JOIN {_LATEST.format("WHERE lookup_date >= '2023-10-18'")} b ON b.venue_name = 'venue ' || (c.id % 3)
WHERE {_UP} AND pipeline_state NOT IN ('vetoed', 'llm_rejected', 'duplicate', 'expired')""")
def _(t):
    cand = travel.eligible(t.ce, AS_OF).withColumn("venue_postcode", F.concat(F.lit("PC"), (F.col("id") % 3).cast("string")))
    venues = t.ve.withColumn("venue_postcode", F.concat(F.lit("pc"), F.regexp_extract("venue_name", r"(\d)", 1)))
    found = travel.with_cache(cand, venues, AS_OF, ["venue_name", "venue_postcode"])
    return found.select("id", F.col("cached.travel_transit_min").alias("cached_min"), "cached_by")


@query("same_place_merge", "SELECT venue_name, min(x) OVER (PARTITION BY venue_name) AS travel_transit_min FROM (SELECT venue_name, count(*) AS x FROM ce WHERE venue_name IS NOT NULL GROUP BY venue_name)")
def _(t):
    found = t.ce.where("venue_name is not null").groupBy("venue_name").agg(F.count("*").alias("travel_transit_min"))
    return travel.same_place(found.withColumn("place_id", F.concat(F.lit("p-"), "venue_name")).withColumn("ord", F.lit(1)))


@query("cache_backfill", "SELECT lower(venue_name) AS venue_key, arg_max(venue_name, id) AS venue_name, arg_max(travel_transit_min, id) AS travel_transit_min, arg_max(run_date, id) AS lookup_date FROM ce WHERE venue_name IS NOT NULL AND lower(venue_name) NOT IN (SELECT venue_name FROM ve) GROUP BY 1")
def _(t):
    return travel.cache_backfill(t.ce, t.ve)


@query("recover_failed_travel", f"SELECT id, cached_min AS travel_transit_min FROM ce JOIN {_LATEST.format('')} v ON lower(ce.venue_name) = v.venue_name")
def _(t):
    found = travel.with_cache(t.ce, t.ve, None, ["venue_name"]).where("cached is not null")
    return found.select("id", F.col("cached.travel_transit_min").alias("travel_transit_min"))


@query("apply_travel", """
SELECT id, CASE lower(venue_name) WHEN 'venue 0' THEN '12 min (transit) · 20 min (cycle)' END AS travel_display, CASE lower(venue_name) WHEN 'venue 0' THEN false WHEN 'venue 1' THEN true WHEN 'venue 2' THEN true END AS failed,
  CASE WHEN pipeline_state = 'pending_travel' AND lower(venue_name) IN ('venue 0', 'venue 1', 'venue 2') THEN 'ready_to_write' ELSE pipeline_state END AS new_state FROM ce""")
def _(t):
    rows = [("venue 0", 12, 20, 55, False), ("venue 1", None, None, None, False), ("venue 2", None, 40, 90, False), ("venue 3", 5, 5, 5, True)]
    looked = t.spark.createDataFrame(rows, "venue_key string, transit int, cycle int, walk int, limited boolean")
    return travel.apply_travel(t.ce, looked).select("id", "travel_display", "failed", "new_state")


@query("source_detail", "SELECT id, CASE WHEN m.sender IS NULL THEN 'Newsletter' ELSE m.sender || ' Newsletter, ' || strftime(m.email_date::DATE, '%-d %b') END AS detail FROM ce LEFT JOIN em m ON m.message_id = 'm' || (id % 90) || '-0' WHERE source = 'Newsletter'")
def _(t):
    named = t.ce.withColumn("source_snapshot", F.concat(F.lit("m"), (F.col("id") % 90).cast("string"), F.lit("-0")))
    return travel.source_detail(named, t.em)


@query("expire", f"SELECT id, CASE WHEN pipeline_state IN ('pending_llm', 'pending_travel', 'ready_to_write', 'write_failed', 'incomplete') AND NOT {_UP} THEN 'expired' ELSE pipeline_state END AS pipeline_state FROM ce")
def _(t):
    return lifecycle.expire(t.ce, AS_OF).select("id", "pipeline_state")


@query("regression_guard", "SELECT id, 'written' AS was, 'pending_llm' AS now FROM ce WHERE notion_page_id IS NOT NULL AND id % 4 = 0")
def _(t):
    after = t.ce.withColumn("pipeline_state", F.when(F.col("id") % 4 == 0, "pending_llm").otherwise(F.col("pipeline_state")))
    return lifecycle.regressions(t.ce, after)


@query("retry_failed", "SELECT pipeline_state, count(*) AS n FROM (SELECT CASE pipeline_state WHEN 'write_failed' THEN 'ready_to_write' ELSE pipeline_state END AS pipeline_state FROM ce) GROUP BY ALL")
def _(t):
    return lifecycle.retry_failed(t.ce).groupBy("pipeline_state").agg(F.count("*").alias("n"))


@query("mark_attended", f"SELECT id, id IN (SELECT id FROM ({_MATCH})) AND coalesce(verdict, '') <> 'Not Going' AS user_attended FROM ce")
def _(t):
    return lifecycle.mark_attended(t.ce, linkage.calendar_match(t.cal, t.ce)).select("id", "user_attended")


@query("record_calendar", "SELECT calendar_id, CASE WHEN calendar_id % 2 = 0 THEN 'kept' ELSE 'added' END AS origin FROM cal")
def _(t):
    have = t.cal.where("calendar_id % 2 = 0").withColumn("origin", F.lit("kept"))
    return lifecycle.record_calendar(have, t.cal.withColumn("origin", F.lit("added"))).select("calendar_id", "origin")


_TC = """SELECT *, CASE WHEN id % 3 = 0 THEN 'AB' || (id % 40) END AS venue_postcode, 'Place' || (id % 90) AS place_id,
  CASE WHEN id % 5 = 0 THEN 'shown' END AS travel_display, CASE WHEN id % 7 = 0 THEN true WHEN id % 7 = 1 THEN false END AS travel_lookup_failed FROM ce"""
_TV = """SELECT name AS venue_name, 'ab' || (user_id % 60) AS venue_postcode, 'Place' || (user_id % 200) AS place_id, day AS lookup_date, t AS travel_transit_min, CASE WHEN user_id % 2 = 0 THEN user_id::DOUBLE END AS venue_lat, user_id::DOUBLE + 1 AS venue_lon
  FROM (SELECT id AS user_id, CASE WHEN id % 6 = 0 THEN 'venue 1' ELSE name END AS name, CASE WHEN id % 4 = 0 THEN '2023-06-01' ELSE date END AS day, travel_transit_min AS t FROM ce WHERE source = 'Luma')"""
_TOP = "(SELECT {0} AS k{1}, max(({2})) AS v FROM tv WHERE {3} GROUP BY 1)"


def _candidates(t):
    i = F.col("id")
    return t.ce.withColumns({
        "venue_postcode": F.when(i % 3 == 0, F.concat(F.lit("AB"), (i % 40).cast("string"))), "place_id": F.concat(F.lit("Place"), (i % 90).cast("string")),
        "travel_display": F.when(i % 5 == 0, "shown"), "travel_lookup_failed": F.when(i % 7 == 0, True).when(i % 7 == 1, False),
    })


def _venues(t):
    i, code = F.col("id"), lambda text, n: F.concat(F.lit(text), (F.col("id") % n).cast("string"))
    return t.ce.where("source = 'Luma'").select(
        F.when(i % 6 == 0, "venue 1").otherwise(F.col("name")).alias("venue_name"), code("ab", 60).alias("venue_postcode"), code("Place", 200).alias("place_id"), F.when(i % 4 == 0, "2023-06-01").otherwise(F.col("date")).alias("lookup_date"),
        "travel_transit_min", F.when(i % 2 == 0, i.cast("double")).alias("venue_lat"), (i.cast("double") + 1).alias("venue_lon"),
    )


_AGE = "lookup_date >= '2023-10-18'"
_BY_AGE = "lookup_date, travel_transit_min"


@query("travel_tiers", f"""
WITH tc AS ({_TC}), tv AS ({_TV})
SELECT id, coalesce(a.v, b.v, c.v)[2] AS cached_min, coalesce(a.v, b.v, c.v)[1] AS cached_date, CASE WHEN a.v IS NOT NULL THEN 'venue_name' WHEN b.v IS NOT NULL THEN 'venue_postcode' WHEN c.v IS NOT NULL THEN 'place_id' END AS cached_by
FROM tc LEFT JOIN {_TOP.format("lower(venue_name)", 1, _BY_AGE, _AGE)} a ON lower(tc.venue_name) = k1 LEFT JOIN {_TOP.format("lower(venue_postcode)", 2, _BY_AGE, _AGE)} b ON lower(tc.venue_postcode) = k2
LEFT JOIN {_TOP.format("place_id", 3, _BY_AGE, _AGE)} c ON tc.place_id = k3
WHERE {_UP} AND llm_tier <> 'Not Recommended' AND travel_display IS NULL AND travel_lookup_failed IS NOT TRUE AND pipeline_state NOT IN ('written', 'vetoed', 'llm_rejected', 'duplicate')""")
def _(t):
    found = travel.travel_tiers(_candidates(t), _venues(t), S.as_of)
    return found.select("id", F.col("found.travel_transit_min").alias("cached_min"), F.col("found.lookup_date").alias("cached_date"), F.col("found_by").alias("cached_by"))


@query("venue_geo_tiers", f"""
WITH tc AS ({_TC}), tv AS ({_TV})
SELECT id, coalesce(a.v, b.v)[2] AS lat, coalesce(a.v, b.v)[3] AS lon, CASE WHEN a.v IS NOT NULL THEN 'venue_name' WHEN b.v IS NOT NULL THEN 'venue_postcode' END AS found_by
FROM tc LEFT JOIN {_TOP.format("lower(venue_name)", 1, "lookup_date, venue_lat, venue_lon", "venue_lat IS NOT NULL")} a ON lower(tc.venue_name) = k1
LEFT JOIN {_TOP.format("lower(venue_postcode)", 2, "lookup_date, venue_lat, venue_lon", "venue_lat IS NOT NULL")} b ON lower(tc.venue_postcode) = k2""")
def _(t):
    found = travel.geo_tiers(_candidates(t), _venues(t))
    return found.select("id", F.col("found.venue_lat").alias("lat"), F.col("found.venue_lon").alias("lon"), "found_by")


_NEW = f"""SELECT *, lower(venue_postcode) AS code FROM (
  SELECT lower(trim(venue_name)) AS venue_key, max(id) AS id, arg_max(venue_name, id) AS venue_name, arg_max(struct_pack(c := venue_postcode), id).c AS venue_postcode, arg_max(travel_transit_min, id) AS travel_transit_min, arg_max(run_date, id) AS lookup_date
  FROM (SELECT * REPLACE (CASE WHEN id % 2 = 0 THEN name ELSE venue_name END AS venue_name, CASE WHEN id % 4 = 0 THEN '2023-10-17' ELSE run_date END AS run_date) FROM tc)
  WHERE travel_display IS NOT NULL AND venue_name IS NOT NULL AND lower(venue_name) NOT IN (SELECT lower(venue_name) FROM tv) GROUP BY 1)"""


@query("cache_fill", f"""
WITH tc AS ({_TC}), tv AS ({_TV}), new AS ({_NEW})
SELECT venue_key, venue_name, venue_postcode, travel_transit_min, CASE lookup_date WHEN '2023-10-17' THEN '2023-10-17' ELSE lookup_date END AS lookup_date FROM new
WHERE NOT EXISTS (SELECT 1 FROM tv WHERE lower(tv.venue_postcode) = new.code AND {_AGE.replace("lookup_date", "tv.lookup_date")})
  AND NOT EXISTS (SELECT 1 FROM new n WHERE n.code = new.code AND n.id > new.id AND n.lookup_date >= '2023-10-18')""")
def _(t):
    named = _candidates(t).withColumn("venue_name", F.when(F.col("id") % 2 == 0, F.col("name")).otherwise(F.col("venue_name"))).withColumn("run_date", F.when(F.col("id") % 4 > 0, F.col("run_date")))
    return travel.cache_fill(named, _venues(t), S.as_of)
