"""Linkage over whole tables: every row is on one side, and every calendar row and match counts."""

from wrenfield.operators import linkage
from wrenfield.plans.linkage import _sides
from wrenfield.registry import QUERIES
from wrenfield.sources.views import Views

DATA = "/root/testdata/sf0.001"


def test_every_row_is_on_one_side(spark):
    t = Views(spark, DATA)
    new, old = _sides(t)
    all_rows, url = t.ce.collect(), lambda r: r.url
    stored = [r for r in all_rows if r.pipeline_state != "pending_llm"]
    pending = [r for r in all_rows if r.pipeline_state == "pending_llm"]
    assert sorted(r.id for r in new.unionByName(old).collect()) == sorted(r.id for r in all_rows)
    urls, names = set(map(url, stored)), {(r.name, r.date) for r in stored}
    want = sorted(r.id for r in pending if r.url not in urls and (r.name, r.date) not in names)
    assert sorted(r.id for r in QUERIES["exact_dedup_all_rows"](spark, DATA).collect()) == want
    last = lambda rows: {r.url: r for r in sorted(rows, key=lambda r: r.id)}
    a, b = last(pending), last(stored)
    moved = {b[u].id: (a[u].date, a[u].end_date) for u in a.keys() & b.keys() if a[u].date != b[u].date}
    assert moved and {r.id: (r.date, r.end_date) for r in QUERIES["reschedule_all_rows"](spark, DATA).collect()} == moved


def test_gaps_of_all_calendar_rows(spark):
    t = Views(spark, DATA)
    matched = {r.calendar_id for r in linkage.calendar_match(t.cal, t.ce).collect()}
    assert {r.calendar_id for r in QUERIES["source_gaps_all_rows"](spark, DATA).collect()} == {r.calendar_id for r in t.cal.collect()} - matched
