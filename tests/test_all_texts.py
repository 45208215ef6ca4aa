"""The queries over all texts, against loops over texts with letters of several scripts."""

import re
from collections import Counter

import pytest

from wrenfield.operators import packs
from wrenfield.registry import QUERIES

TEXTS = [
    "that is plain", "é that à", "thaté is one word", "éthat is too", "license für alle", "Ünlicense", "der clown läuft", "clowné läuft", "über anhe inea", "ener ench où", "queque été annd",
    "the café hosts a hiking day", "hikingé día", "the ñandú walks", "thanedble für Anfänger", "un museum à Köln", "singles à Paris", "bwv 12 für Orgel", "op. 3 déjà", "idiot", "ßidiot", "reat sport ü attion", "日本 that 日本", "日本that",
    "Ä" * 45 + " trash", "", "x" * 60,
]


@pytest.fixture(scope="module")
def cd(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("texts"))
    rows = [(i, t, "de", "src é" if i % 5 == 0 else "src", len(t)) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    return at, [(i, t[:40], t, s) for i, t, _, s, _ in rows]


def has(words, text):
    return re.search(rf"\b(?:{'|'.join(map(re.escape, words))})\b", text, re.I) is not None


def first(rules, scopes, more=(), otherwise=None):
    for r in rules:
        hit = re.search(r.pattern, scopes[r.scope], re.A) if r.pattern else has(r.words, scopes[r.scope])
        if hit and not (r.exempt and has(r.exempt, scopes["blob"])):
            return r.key
    return next((k for k, p in more if re.search(p, scopes["title"], re.A)), otherwise)


def veto(name, text, organiser):
    scopes = {"blob": f"{name} {text} {organiser}".lower(), "title": f"{name} {organiser}".lower(), "name": name.lower()}
    return first(packs.VETOES, scopes, [("classical_concert", r"\b(?:op|bwv)\.?\s*\d+"), ("singles_in_title_or_group", r"\bsingles\b")])


def got(spark, name, at):
    return sorted(map(tuple, QUERIES[name](spark, at).collect()))


def test_keyword_match(spark, cd):
    assert got(spark, "keyword_match_all_texts", cd[0]) == [(i, has(["that", "license", "idiot"], t)) for i, _, t, _ in cd[1]]


def test_vetoes(spark, cd):
    at, rows = cd
    keys = [veto(*r[1:]) for r in rows]
    assert len(set(keys)) > 8
    assert got(spark, "veto_breakdown_all_texts", at) == sorted(Counter(k for k in keys if k).items())
    spared = sum(k is None and has(["queque", "ener ench", "clown"], f"{n} {t} {o}") for k, (_, n, t, o) in zip(keys, rows))
    assert got(spark, "veto_exemption_all_texts", at) == [(len(rows), spared)]


def test_formats(spark, cd):
    want = []
    for i, n, t, _ in cd[1]:
        n, t = n.replace("the", "walk"), t.replace("thanedble", "workshop")  # noqa: PLW2901
        want.append((i, first(packs.FORMATS, {"blob": f"{n} {t}".lower(), "name": n.lower()}, otherwise=packs.DEFAULT_FORMAT)))
    assert len({k for _, k in want}) > 3
    assert got(spark, "classify_format_all_texts", cd[0]) == want


def test_blobs(spark, cd):
    assert got(spark, "text_blob_all_texts", cd[0]) == [(i, f"{n} {t} {o}".lower(), f"{n} {o}".lower()) for i, n, t, o in cd[1]]
