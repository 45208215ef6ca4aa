"""Periodic runs of words: passages that repeat themselves, and texts without the repetitions.

A *run* is a stretch of consecutive words with smallest period q (words q apart are identical) of ``max(least, 2 * q)`` words or more
that no neighbouring word extends keeping the period. All runs are found by a sparse dynamic program over diagonals: where a word
occurred ``lag`` words before, the match length of the diagonal ``lag`` goes up, and where a diagonal ends with a sufficient
length, it emits a run. Word by word that costs the square of a frequent word's count, so diagonals are taken by size:

* Lags under 16: each word looks at the word ``lag`` before it; matches that follow each other are one diagonal.
* Lags from ``2 * b`` to ``4 * b``, for b = 8, 16, 32 ...: a diagonal that can end as a run has ``lag`` matches or more, so it covers a whole
  block of b words that begins at a multiple of b. Only such blocks look for their earlier occurrences within these lags: at
  most 2 * b of them, so that a level has at most two for each word, however often words repeat. Matches of neighbouring blocks
  add up along their diagonal, and both ends are completed by fewer than b words.

Occurrences are compared by exact names: a stretch of 2 * b words is named by the pair of names of its halves, and only
stretches that occur twice in their text have a name. Nothing is hashed. Of several lags with the same ends the smallest is the period.
Texts are independent of each other, so there is no exchange, and a group of texts of any size or number of copies is as good as another.

Nulls: a null text has no words and no runs. Repeated rows each get their row. Empty tables give empty results. Other columns pass unchanged
under any name; input columns with the names of the added ones are replaced. A very long text is read whole, as a step of its
own; time and memory grow with its words times the logarithm of their number.
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

LEAST = 12
#: Lags below it are looked at word by word; a power of two.
DENSE = 16
#: Words are runs of ``[^\x20\x09-\x0D]``.
IS_WORD = np.ones(256, bool)
IS_WORD[9:14] = IS_WORD[32] = False
WORD = r"[^\x20\x09-\x0D]+"

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
ADDED = [T.StructField("n_words", T.LongType(), False), T.StructField("runs", T.ArrayType(RUN, False), False), T.StructField("collapsed", T.StringType(), False)]


def named(keys: np.ndarray) -> np.ndarray:
    """Numbers of the keys, equal for equal ones; -1 for a key that occurs once."""
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    return np.where(count[name] > 1, name, -1)


def _doubled(name: np.ndarray, b: int) -> np.ndarray:
    """Names of stretches of 2 * b words from those of b words."""
    out = np.full(len(name), -1, np.int64)
    if len(name) > b:
        at = np.flatnonzero((name[:-b] >= 0) & (name[b:] >= 0))
        if len(at):
            out[at] = named(name[at] * (int(name.max()) + 1) + name[at + b])
    return out


def _stretches(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def _dense(word: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the diagonals of one lag."""
    first, end = _stretches(word[lag:] == word[:-lag])
    return first + lag, end + lag


def _sparse(names: list[np.ndarray], b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, lag) of the diagonals with lags from 2 * b to 4 * b that cover a block of b words. ``names``: of 1, 2, 4 ... b words."""
    name = names[-1]
    n = len(name)
    there = np.flatnonzero(name >= 0)
    there = there[np.argsort(name[there], kind="stable")]
    key = name[there] * n + there  # occurrences by name and place
    block = np.arange(0, n, b)
    block = block[name[block] >= 0]
    low = np.searchsorted(key, name[block] * n + np.maximum(block - 4 * b + 1, 0))
    many = np.maximum(np.searchsorted(key, name[block] * n + np.maximum(block - 2 * b + 1, 0)) - low, 0)
    at = np.repeat(block, many)
    lag = at - there[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(len(at))]
    if not len(at):
        return at, at, lag
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    begins = np.flatnonzero(np.concatenate(([True], (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + b))))
    first, end, lag = at[begins].copy(), at[np.append(begins[1:], len(at)) - 1] + b, lag[begins]
    for j in range(len(names) - 2, -1, -1):
        step, part = 1 << j, names[j]
        on = np.minimum(end, n - 1)
        end += step * ((end < n) & (part[on] >= 0) & (part[on] == part[on - lag]))
        on = first - step
        fits = on - lag >= 0
        on = np.where(fits, on, lag)
        first -= step * (fits & (part[on] >= 0) & (part[on] == part[on - lag]))
    return first, end, lag


def find(word: np.ndarray, longest: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period. ``word``: numbers of words, of which no two texts share one; ``longest``: words of the longest text."""
    found = []

    def emit(first, end, lag):
        done = end - first >= np.maximum(lag, least - lag)
        found.append(np.stack([(first - lag)[done], end[done], np.broadcast_to(lag, first.shape)[done]]))

    for lag in range(1, min(DENSE, longest // 2 + 1)):
        emit(*_dense(word, lag), lag)
    b, names = 1, [named(word)]
    while 4 * b <= longest and (names[-1] >= 0).any():
        if 2 * b >= DENSE:
            emit(*_sparse(names, b))
        names.append(_doubled(names[-1], b))
        b *= 2
    start, end, period = np.concatenate(found, 1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def _texts(data: np.ndarray, off: np.ndarray, least: int) -> list[pa.Array]:
    """The added columns of the texts."""
    n = len(off) - 1
    starts, ends, text = W.cut(data, off, IS_WORD)
    bounds = np.searchsorted(text, np.arange(n + 1))
    raw = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)), pa.py_buffer(data[IS_WORD[data]])])
    code = raw.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, length, period = find(text * (int(code.max(initial=0)) + 1) + code, int(np.diff(bounds).max(initial=0)), least)

    of = text[start] if len(start) else start
    runs = pa.StructArray.from_arrays([pa.array(x) for x in (start - bounds[of], length, period)], fields=list(to_arrow_schema(RUN)))
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32()), runs)

    covered = np.zeros(len(starts) + 1, np.int64)
    np.add.at(covered, start + period, 1)
    np.add.at(covered, start + length, -1)
    keep = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    size = ends[keep] - starts[keep] + 1  # and a blank, but after a text's last word
    last = np.ones(len(keep), bool)
    last[:-1] = text[keep[1:]] != text[keep[:-1]]
    size[last] -= 1
    said = W.gathered(np.append(data, np.uint8(32)), starts[keep], size)
    at = np.cumsum(size)
    said[at[~last] - 1] = 32
    place = np.concatenate(([0], at))[np.searchsorted(text[keep], np.arange(n + 1))].astype(np.int64)
    collapsed = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(place), pa.py_buffer(said)])
    return [pa.array(np.diff(bounds)), lists, collapsed]


def _mapped(schema: T.StructType, kept: list[str], least: int):
    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            for i, j in steps(off):
                part = batch.slice(i, j - i)
                added = _texts(data[off[i] : off[j]], off[i : j + 1] - off[i], least)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *(a.cast(f.type) for a, f in zip(added, list(arrow)[len(kept) :]))], schema=arrow)

    return released(run)


def periodic_runs(docs: DataFrame, least: int = LEAST, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, default all) with ``n_words``, ``runs`` (by start and period) and ``collapsed``: the words, joined by one
    blank, without those that a run holds after its first period."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in [f.name for f in ADDED]]
    if "text" not in docs.columns:
        raise ValueError("docs has no column text")
    inner = docs.select(*[F.col(c).alias(f"__column{i}") for i, c in enumerate(kept)], "text")
    own = inner.columns[:-1]
    schema = T.StructType([inner.schema[c] for c in own] + ADDED)
    return inner.mapInArrow(_mapped(schema, own, least), schema).toDF(*kept, *(f.name for f in ADDED))


def rewritten() -> Column:
    """The query's text: of each document with a number divisible by ten, the words after some first ones repeat a period, both given by the number."""
    text = F.coalesce("text", F.lit(""))
    word = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size(word), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(word, a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.concat(F.slice(word, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", rewritten().alias("text"))
    found = periodic_runs(docs, keep=["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def brute_force(word: list, least: int = LEAST) -> list[tuple]:
    """(start, length, period) of all runs, from the definition; for tests."""
    out = []
    for q in range(1, len(word) // 2 + 1):
        a = q
        while a < len(word):
            b = a
            while b < len(word) and word[b] == word[b - q]:
                b += 1
            s = word[a - q : b]
            if len(s) >= max(least, 2 * q) and not any(s[r:] == s[:-r] for r in range(1, q)):
                out.append((a - q, len(s), q))
            a = b + 1 if b == a else b
    return sorted(out, key=lambda r: (r[0], r[2]))
