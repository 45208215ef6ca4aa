"""The borderline cap over many ties, without an ordered limit."""

import math
import random

import pytest

from wrenfield.operators import review


@pytest.mark.parametrize("borderline,scores", [(300, [None, 0, 1, 2, 3]), (200, [5]), (150, [-3, None, 7])])
def test_lowest_go_and_no_task_takes_all(spark, borderline, scores):
    rnd = random.Random(borderline)
    rows = [(i, "Borderline", rnd.choice(scores)) for i in range(borderline)]
    rows += [(i, rnd.choice(["Recommended", "Top Picks", "Not Recommended"]), rnd.choice(scores)) for i in range(borderline, borderline + 120)]
    rnd.shuffle(rows)
    got = review.borderline_cap(spark.createDataFrame(rows, "id long, llm_tier string, score int").repartition(5))
    kept = [r for r in rows if r[1] != "Not Recommended"]
    excess = math.ceil((borderline - 0.3 * len(kept)) / 0.7 - 1e-9)
    want = {r[0] for r in sorted((r for r in kept if r[1] == "Borderline"), key=lambda r: (r[2] or 0, r[0]))[:excess]}
    out = got.collect()
    assert len(out) == len(kept) and {r.id for r in out if r.demoted} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan
