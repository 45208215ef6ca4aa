"""Quality by compression: two zstandard dictionaries, one trained on good and one on bad labelled texts.

A whole text is cut into pieces of ``PIECE`` bytes, so that the dictionaries matter everywhere in it, and every piece is compressed with
each dictionary. The difference of the two sums of compressed sizes, normalised by the text's bytes, says which of the two the text is
like. A logistic function of it, of the share of bytes that the better dictionary leaves, and of the text's length turns it into a
probability; its weights are fitted on labelled texts that the dictionaries have not seen.

Fitting is done in one task of bounded size, on a bounded sample of the labelled rows: those with the smallest hash of doc_id, in the
order of that hash, ``SAMPLE`` of them at most, ``SAMPLE_BYTES`` at most, and without texts of more than ``SAMPLE_TEXT`` characters. Two of three make the
dictionaries, the third the calibration. Scoring reads all documents whole, with no exchange; the broadcast is two
dictionaries of ``DICTIONARY`` bytes.

Nulls: a null text is empty, and an empty text has the score that the calibration gives to no difference; rows whose label or doc_id is null are not learned from, a text of
several labels is learned once for each. With labelled rows of one class only every score is the share of label 1 (0.5 without any), as it is
where the texts are too few for a dictionary. Empty tables give empty results. Other columns pass unchanged; an older ``score`` is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import released, text_bytes
from .toxicity import held_out

PIECE = 2000
LEVEL = 3
DICTIONARY = 110_000
SAMPLE = 12_000
SAMPLE_BYTES = 40_000_000
SAMPLE_TEXT = 1_000_000
#: Bytes of one class's texts that a dictionary is trained on at most.
TRAINED_BYTES = 6_000_000
THRESHOLD = 0.5

MODEL = T.StructType([T.StructField("good", T.BinaryType()), T.StructField("bad", T.BinaryType()), T.StructField("weights", T.ArrayType(T.DoubleType(), False))])
#: Two dictionaries and the weights of the calibration, or none and a constant.
Model = tuple[bytes | None, bytes | None, list[float]]


def pieces(text: memoryview | bytes) -> list:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def dictionary(texts: list[bytes]) -> bytes | None:
    """A dictionary of the texts, or none if zstandard finds them too few."""
    samples, held = [], 0
    for t in texts:
        if held < TRAINED_BYTES:
            samples += pieces(t)
            held += len(t)
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, k=200, d=8, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return None


class Measure:
    """Features of whole texts under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.by = []
        for raw in (good, bad):
            words = zstandard.ZstdCompressionDict(raw)
            words.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(dict_data=words, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, text) -> tuple[float, float, float]:
        """(normalised difference, share left by the better dictionary, length)."""
        n = len(text)
        if not n:
            return 0.0, 0.0, 0.0
        good, bad = (sum(len(c.compress(p)) for p in pieces(text)) for c in self.by)
        # the bytes that are added keep the share of a few words near 0
        return (bad - good) / (n + 50), min(good, bad) / (n + 50), float(np.log1p(n))


def design(x: np.ndarray) -> np.ndarray:
    """Columns of the calibration."""
    diff, left, length = x[:, 0] * 10, x[:, 1] * 10, x[:, 2]
    return np.column_stack([np.ones(len(x)), diff, left, length - 6])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> np.ndarray:
    """Weights by Newton's method; ``ridge`` keeps them finite where the classes part cleanly."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(texts: list[bytes], labels: np.ndarray) -> Model:
    third = np.arange(len(texts)) % 3 == 2
    made = [dictionary([t for t, y, c in zip(texts, labels, third) if y == k and not c]) for k in (1, 0)]
    if None in made:
        share = float(np.mean(labels)) if len(labels) else 0.5
        return None, None, [min(max(share, 1e-6), 1 - 1e-6)]
    measure = Measure(*made)
    x = np.array([measure(t) for t, c in zip(texts, third) if c])
    return (*made, logistic(design(x), labels[third]).tolist())


def _fit(most: int):
    def run(batches):
        texts, labels, held = [], [], 0
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            for i, label in enumerate(batch.column("label").to_pylist()):
                if held < most:
                    texts.append(data[off[i] : off[i + 1]].tobytes())
                    labels.append(label)
                    held += int(off[i + 1] - off[i])
        good, bad, weights = learn(texts, np.array(labels))
        yield pa.RecordBatch.from_pylist([{"good": good, "bad": bad, "weights": weights}], schema=to_arrow_schema(MODEL))

    return released(run)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", usable: Column | None = None, sample: int = SAMPLE, most: int = SAMPLE_BYTES) -> Model:
    """The model learned from the labelled rows for which ``usable`` holds: ``sample`` rows and about ``most`` bytes at most."""
    order = F.xxhash64("doc_id")
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(usable) if usable is not None else known
    # the ids come first, so that only their texts are sorted; both sides are bounded by `sample`
    picked = known.select("doc_id", F.col(label).cast("double").alias("label")).distinct().orderBy(order, "doc_id", "label").limit(sample)
    rows = docs.select("doc_id", "text").where(F.coalesce(F.char_length("text"), F.lit(0)) <= SAMPLE_TEXT).join(F.broadcast(picked), "doc_id")
    rows = rows.orderBy(order, "doc_id", "label", "text").limit(sample).coalesce(1)
    found = rows.select("text", "label").mapInArrow(_fit(most), MODEL).collect()
    return tuple(found[0]) if found else (None, None, [0.5])


def _score(model, kept: list[str], schema: T.StructType):
    def run(batches):
        good, bad, weights = model.value
        measure = Measure(good, bad) if good else None
        for batch in batches:
            if measure:
                data, off = text_bytes(batch.column("text"))
                view = memoryview(np.ascontiguousarray(data))
                x = np.array([measure(view[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]).reshape(-1, 3)
                score = 1 / (1 + np.exp(-np.clip(design(x) @ np.array(weights), -35, 35)))
            else:
                score = np.full(batch.num_rows, weights[0])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(score)], schema=to_arrow_schema(schema))

    return released(run)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default all) and ``score``, the probability of label 1."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(_score(sent, kept, schema), schema)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, fit(docs, labels, usable=~held_out()), keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
