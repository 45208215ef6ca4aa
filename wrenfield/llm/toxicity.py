"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each present or not: its words, pairs of neighbours and pairs with one word between,
hashed into ``2**BITS`` weights. The model is fitted online with per-coordinate learning rates and L1
regularisation, which leaves few weights other than 0; those are broadcast and every whole text is scored.

Fitting is done in one task of bounded size, on a bounded sample of the labelled rows: those with the smallest hash of doc_id, in
the order of that hash, ``SAMPLE`` of them at most, and no more once they hold ``SAMPLE_FEATURES`` features. Scoring
reads all documents, with no exchange. In the pipeline the model scores the rows that it learned from, too.

Nulls: a null text is empty and has the bias alone; rows whose label or doc_id is null are not learned from. A
text of several labels is learned once for each. Without labelled rows every score is 0.5. Empty tables give
empty results; other columns pass unchanged where kept, but an
older ``score`` is replaced. Very long texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import words as W
from .common import released, steps, text_bytes

BITS = 20
SAMPLE = 16_000
SAMPLE_FEATURES = 40_000_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 3.0, 1.0, 8.0, 0.0
THRESHOLD = 0.7
_KINDS = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F))


def features(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text) of every word, bigram and skip-gram of the texts."""
    _, _, h, text = W.words(data, off)
    parts = [(h, text)]
    for gap, salt in zip((1, 2), _KINDS):
        a, b = h[:-gap], h[gap:]
        same = text[:-gap] == text[gap:]
        parts.append((W.mix(a * salt + b)[same], text[:-gap][same]))
    return np.concatenate([(x >> np.uint64(64 - bits)).astype(np.int64) for x, _ in parts]), np.concatenate([t for _, t in parts])


def train(texts: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the weights that are not 0; the bias has index ``2**bits``. ``texts``: features, each once."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(i):
        x = z[i]
        w = -(x - np.sign(x) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        w[np.abs(x) <= L1] = 0
        return w

    for _ in range(epochs):
        for i, y in zip(texts, labels):
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - y
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - s * w
            n[i] += g * g
    at = np.flatnonzero(np.abs(z) > L1)
    return at, weights(at)


def _once(data: np.ndarray, off: np.ndarray, bits: int) -> list[np.ndarray]:
    """The features of each text, each once, with the bias."""
    f, text = features(data, off, bits)
    key = np.unique((text << (bits + 1)) | f)
    text, f = key >> (bits + 1), key & ((1 << (bits + 1)) - 1)
    ends = np.searchsorted(text, np.arange(len(off)))
    return [np.append(f[a:b], 1 << bits).astype(np.int32) for a, b in zip(ends[:-1], ends[1:])]


WEIGHTS = T.StructType([T.StructField("feature", T.LongType()), T.StructField("weight", T.DoubleType())])


def _fit(bits: int, most: int):
    def run(batches):
        texts, labels, held = [], [], 0
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            for i, j in steps(off):
                if held < most:
                    texts += _once(data[off[i] : off[j]], off[i : j + 1] - off[i], bits)
                    labels += batch.column("label").slice(i, j - i).to_pylist()
                    held += sum(map(len, texts[i - j :]))
        if texts:
            at, w = train(texts, np.array(labels), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w)], schema=to_arrow_schema(WEIGHTS))

    return released(run)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable: Column | None = None, sample: int = SAMPLE, most: int = SAMPLE_FEATURES, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Weights learned from the labelled rows for which ``usable`` holds: ``sample`` rows, and about ``most`` features, at most."""
    order = F.xxhash64("doc_id")
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(usable) if usable is not None else known
    # the ids come first, so that only their texts are sorted; both sides are bounded by `sample`
    picked = known.select("doc_id", F.col(label).cast("double").alias("label")).distinct().orderBy(order, "doc_id", "label").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = rows.orderBy(order, "doc_id", "label", "text").limit(sample).coalesce(1)
    found = rows.select("text", "label").mapInArrow(_fit(bits, most), WEIGHTS).collect()
    return np.array([r[0] for r in found], np.int64), np.array([r[1] for r in found], np.float64)


def _score(weights, keep: list[str], schema: T.StructType, bits: int):
    def run(batches):
        at, w = weights.value
        table = np.zeros((1 << bits) + 1, np.float32)
        table[at] = w
        bias = float(table[-1])
        used = table != 0
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            out = []
            for i, j in steps(off):
                f, text = features(data[off[i] : off[j]], off[i : j + 1] - off[i], bits)
                hit = used[f]
                key = np.unique((text[hit] << (bits + 1)) | f[hit])
                total = np.bincount(key >> (bits + 1), table[key & ((1 << (bits + 1)) - 1)], minlength=j - i) + bias
                out.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
            score = pa.array(np.concatenate(out) if out else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), score], schema=to_arrow_schema(schema))

    return released(run)


def score(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray], keep: list[str] | None = None, bits: int = BITS) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default all) and ``score``."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(_score(sent, kept, schema, bits), schema)


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    weights = fit(docs, labels, usable=~held_out())
    scored = score(docs, weights, keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
