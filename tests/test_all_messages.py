"""The second pass over the traces of all rows."""

from wrenfield.registry import QUERIES
from wrenfield.sources.views import Views


def test_second_pass_reads_every_row(spark):
    data = "/root/testdata/sf0.001"
    ids = [r.id for r in Views(spark, data).ce.select("id").collect()]
    assert max(ids) >= 900
    by = {}
    for i in ids:
        by.setdefault(f"m{i // 5}-{i % 5 // 3}", []).append(i % 7 == 0 or i % 11 == 0)
    want = sorted((k, len(v), sum(v)) for k, v in by.items() if any(v) or len(v) >= 3)
    assert len(want) < len(by)
    assert sorted((r.message_id, r.n, r.bad) for r in QUERIES["second_pass_emails_all_rows"](spark, data).collect()) == want
