"""Spans of days in texts, and prompts that are cut between characters, on literal cases."""

from pyspark.sql import functions as F

from wrenfield.functions import columns as C
from wrenfield.operators import mail, review

CASES = [
    ("on until 6–13 jun", [(606, 613, True)]), ("9 & 11 june, doors at 8", [(609, 611, False)]), ("28 jan to 3 feb", [(128, 203, True)]), ("30 dec - 2 jan", [(1230, 102, True)]), ("1st, 2nd may", [(501, 502, False)]),
    ("19 - 21 september and 2-3 oct", [(919, 921, True), (1002, 1003, True)]), ("6 - 13 people", []), ("7 mayors to 9 marches", []), ("", []), (None, []),
]


def test_spans_of_days(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, text string").withColumn("text", C.normalise_name(F.col("text")))
    got = {r.id: [tuple(x) for x in r.s or []] for r in df.select("id", mail.date_spans(F.col("text")).alias("s")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_days_within_spans(spark):
    days = {"2024-06-06": [0], "2024-06-09": [0, 1], "2024-06-10": [0], "2024-06-11": [0, 1], "2024-06-14": [], "2024-01-31": [2], "2024-12-31": [3], "2024-01-01": [3], "2024-05-02": [4], "no date": []}
    spans = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, text string").select("id", mail.date_spans(C.normalise_name(F.col("text"))).alias("s"))
    j = spans.crossJoin(spark.createDataFrame([(d,) for d in days], "d string")).where(mail.in_span(F.col("d"), F.col("s")))
    got = {d: [] for d in days}
    for r in j.collect():
        got[r.d].append(r.id)
    assert {d: sorted(v) for d, v in got.items()} == days


def test_prompts_split_no_character(spark):
    body = "a😀" * 3000
    rows = spark.createDataFrame([(2, "m", "N", "2024-01-01", None, "u", "é" * 300), (1, "m", "M", None, "V", None, None), (3, "n", "X", None, None, None, None)], "id long, message_id string, name string, date string, venue_name string, url string, description string")
    messages = spark.createDataFrame([("m", body), ("n", " ")], "message_id string, body_text string")
    got = mail.prompts(messages, rows, messages).collect()
    assert len(got) == 1 and got[0].n_rows == 2
    shown = got[0].prompt.split("\n\nMESSAGE\n")[1]
    assert len(shown.encode("utf-16-le")) // 2 <= 8000 and body.startswith(shown[:-1]) and len(shown) > 5000
    lines = got[0].prompt.split("ROWS\n")[1].split("\n\nMESSAGE")[0].split("\n")
    assert [x[:7] for x in lines] == ['{"id":1', '{"id":2'] and '"date":null' in lines[0] and "é" * 200 in lines[1] and "é" * 201 not in lines[1]
    cards = spark.createDataFrame([(i, "😀" * (i % 3 * 40)) for i in range(45)], "id long, card string")
    made = {r.batch: r for r in review.batch_prompts(cards, "Ask", 20, 2000).collect()}
    assert {b: r.n for b, r in made.items()} == {1: 20, 2: 20, 3: 5}
    for b, r in made.items():
        parts = r.prompt.split("\n\n")[1:]
        assert parts == [(c if len(c) <= 50 else c[:49] + "…") for c in ("😀" * (i % 3 * 40) for i in range((b - 1) * 20, min(45, b * 20)))]
