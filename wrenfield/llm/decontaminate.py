"""Benchmark decontamination: a broadcast hash set of normalised test n-grams scanned over training windows.

Words are lower-cased runs of digits, letters and non-ASCII characters (``words.py``). Every run of ten words
of a benchmark item is a window; an item of fewer words, but not none, is one window. Items are cut into parts of
``PART_WORDS`` words that overlap by nine, so that no window is lost, and the parts are read in blocks of about
``BLOCK_BYTES``. Each block is broadcast to one scan of the documents, so that what is broadcast, and the sorted arrays
that a worker makes of it, are bounded however large the benchmark and its items are; with several blocks the
documents are staged between the scans. A hash hit counts only after its words have been compared.

Nulls: a null text has no words, in either table; a null ``item_id`` marks words but is not listed. Repeated
rows each get their own result. Empty tables give empty results or no hits. A very long text is read whole, as a step of its
own. Other columns pass unchanged; where ``scan`` adds a column that was there, its own replaces it.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import released, shielded, stage, steps, text_bytes

NGRAM = 10
#: Benchmark text that one broadcast holds, about.
BLOCK_BYTES = 16_000_000
PART_WORDS = 50_000
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_words", SPANS),
    T.StructField("hit_chars", SPANS),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
]
_index_of: dict[object, "Index"] = {}


def _parts(n: int, most: int):
    """(item, words, the item's number of words) of the items' overlapping parts."""

    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column("t"))
            for i in range(len(off) - 1):
                said, _ = W.spoken(data[off[i] : off[i + 1]], np.array([0, off[i + 1] - off[i]]))
                ends = np.flatnonzero(said == 32) + 1
                first = range(0, max(1, len(ends) - n + 1), most) if len(ends) else ()
                cut = [said[(ends[k - 1] if k else 0) : ends[min(len(ends), k + most + n - 1) - 1]].tobytes().decode() for k in first]
                yield pa.RecordBatch.from_arrays([batch.column("i").take(pa.array([i] * len(cut), pa.int64())), pa.array(cut, pa.string())], names=["i", "t"])

    return released(run)


class Index:
    """Sorted window hashes, each with a place of its words and the items that have it, and a bitmap that most other windows fail."""

    BITS = 20

    def __init__(self, parts: list[tuple[str | None, str]], n: int):
        self.items = list(dict.fromkeys(i for i, _ in parts))
        number = {x: k for k, x in enumerate(self.items)}
        self.sizes = {}
        raw = [t.encode() for _, t in parts]
        off = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
        self.said = b"".join(raw)
        data = np.frombuffer(self.said, np.uint8)
        found: dict[int, list] = {}
        for i, j in steps(off):
            starts, ends, h, part = W.words(data[off[i] : off[j]], off[i : j + 1] - off[i])
            many = np.bincount(part, minlength=j - i)
            for size in np.unique(np.minimum(many[many > 0], n)).tolist():
                keys, at = W.windows(h, part, size)
                pick = np.minimum(many[part[at]], n) == size
                keys, at = keys[pick], at[pick]
                item = np.array([number[parts[i + k][0]] for k in range(j - i)], np.int32)[part[at]]
                found.setdefault(size, []).append((keys, starts[at] + off[i], ends[at + size - 1] + off[i], item))
        for size, pieces in found.items():
            keys, a, b, item = (np.concatenate(x) for x in zip(*pieces))
            order = np.lexsort((item, keys))
            keys, a, b, item = keys[order], a[order], b[order], item[order]
            fresh = np.concatenate(([True], keys[1:] != keys[:-1]))
            lead = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            # windows of one hash that are not the same words (practically none) are told apart when they are met
            mixed = {int(k) for k, x, y, p, q in zip(keys[~fresh], a[~fresh], b[~fresh], a[lead][~fresh], b[lead][~fresh]) if self.said[x:y] != self.said[p:q]}
            bits = np.zeros(1 << self.BITS, bool)
            bits[keys >> np.uint64(64 - self.BITS)] = True
            self.sizes[size] = keys, a, b, item, bits, mixed

    def items_of(self, size: int, key: int, said: bytes) -> set:
        """Numbers of the items that have the window, which is ``said``."""
        keys, a, b, item, _, mixed = self.sizes[size]
        i, j = np.searchsorted(keys, np.uint64(key), "left"), np.searchsorted(keys, np.uint64(key), "right")
        if i == j:
            return set()
        if key in mixed:
            return {int(item[k]) for k in range(i, j) if self.said[a[k] : b[k]] == said}
        return set(item[i:j].tolist()) if self.said[a[i] : b[i]] == said else set()

    def scan(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, list, list, set]]:
        """Of each text: words, merged hit word spans, their spans of code points, item ids."""
        starts, ends, h, doc = W.words(data, off)
        first = np.searchsorted(doc, np.arange(len(off)))
        hits: dict[int, tuple[list, set]] = {}
        for size, (known, _, _, _, bits, _) in self.sizes.items():
            keys, at = W.windows(h, doc, size)
            maybe = np.flatnonzero(bits[keys >> np.uint64(64 - self.BITS)])
            near = np.minimum(np.searchsorted(known, keys[maybe]), len(known) - 1)
            maybe = maybe[known[near] == keys[maybe]]
            for k, i in zip(keys[maybe].tolist(), at[maybe].tolist()):
                own = b" ".join(W.LOWER[data[a:b]].tobytes() for a, b in zip(starts[i : i + size], ends[i : i + size]))
                if got := self.items_of(size, k, own):
                    spans, items = hits.setdefault(int(doc[i]), ([], set()))
                    spans.append((i, i + size))
                    items |= got
        out = []
        for t in range(len(off) - 1):
            spans, items = hits.get(t, ((), ()))
            runs = W.merged(list(spans))
            at = int(first[t])
            chars = []
            if runs:  # code points are counted once, up to each place
                points = np.concatenate(([0], np.cumsum((data[off[t] : off[t + 1]] & 0xC0) != 0x80)))
                chars = [(int(points[starts[a] - off[t]]), int(points[ends[b - 1] - off[t]])) for a, b in runs]
            out.append((int(first[t + 1]) - at, [(a - at, b - at) for a, b in runs], chars, {self.items[x] for x in items}))
        return out


def _scanner(block, name: str, n: int, text: str, kept: list[str], schema: pa.Schema):
    def run(batches):
        index = _index_of.get(name)
        if index is None:
            _index_of.clear()  # a worker holds one block
            index = _index_of[name] = Index(block.value, n)
        for batch in batches:
            data, off = text_bytes(batch.column(text))
            rows = []
            for i, j in steps(off):
                rows += index.scan(data[off[i] : off[j]], off[i : j + 1] - off[i])
            old = [batch.column(c).to_pylist() if c in batch.schema.names else [None] * len(rows) for c in ("__hit", "__chr", "__ids")]
            merge = lambda new, was: W.merged([*new, *((x["start"], x["end"]) for x in was or ())])
            as_spans = lambda runs: [{"start": a, "end": b} for a, b in runs]
            done = [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([as_spans(merge(r[1], o)) for r, o in zip(rows, old[0])], schema.field("hit_words").type),
                pa.array([as_spans(merge(r[2], o)) for r, o in zip(rows, old[1])], schema.field("hit_chars").type),
                pa.array([sorted({str(x) for x in r[3] if x is not None} | set(o or ())) for r, o in zip(rows, old[2])], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *done], schema=schema)

    return released(run)


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, n: int = NGRAM, block_bytes: int = BLOCK_BYTES, part_words: int = PART_WORDS) -> DataFrame:
    """``docs`` (its columns ``keep``, default all) with n_words, hit_words and hit_chars (half-open spans of
    word numbers and code points) and item_ids (strings, sorted)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    kept = [c for c in (docs.columns if keep is None else keep) if c not in [f.name for f in RESULT]]
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).where("t is not null")
    # equal parts count once, so that blocks stay within their bytes whatever the benchmark repeats
    items = stage(items.distinct().mapInArrow(_parts(n, part_words), "i string, t string").distinct(), "benchmark")
    total = items.agg(F.coalesce(F.sum(F.octet_length("t") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(blocks))
    names = list(dict.fromkeys([*kept, text]))
    at = docs.select(*names)
    for b in range(blocks):
        last = b == blocks - 1
        block = spark.sparkContext.broadcast([tuple(r) for r in (items.where(part == b) if blocks > 1 else items).collect()])
        out = kept if last else names
        schema = T.StructType([docs.schema[c] for c in out] + RESULT)
        at = at.mapInArrow(_scanner(block, uuid.uuid4().hex, n, text, out, to_arrow_schema(schema)), schema)
        if not last:
            at = stage(at, "decontaminate").withColumnsRenamed({"hit_words": "__hit", "hit_chars": "__chr", "item_ids": "__ids"}).drop("n_words")
    return at


def clean(docs: DataFrame, benchmark: DataFrame, mode: str = "document", text: str = "text", **options) -> DataFrame:
    """``docs`` without contaminated documents (``mode="document"``) or without their hit spans (``"span"``)."""
    if mode not in ("document", "span"):
        raise ValueError("mode is document or span")
    safe, named = shielded(docs, text)
    hit = scan(safe, benchmark, text, **options)
    if mode == "document":
        return named(hit.where(F.size("hit_words") == 0))
    # kept pieces between the hit spans, joined as they stand
    pieces = F.expr(
        f"array_join(transform(sequence(0, size(hit_chars)), i -> substring({text}, "
        f"if(i = 0, 0, hit_chars[greatest(i, 1) - 1].end) + 1, "
        f"if(i = size(hit_chars), char_length({text}), hit_chars[least(i, size(hit_chars) - 1)].start) "
        f"- if(i = 0, 0, hit_chars[greatest(i, 1) - 1].end))), '')"
    )
    return named(hit.withColumn(text, F.when(F.size("hit_chars") > 0, pieces).otherwise(F.col(text))))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def brute_force(docs: list[tuple], items: list[tuple], n: int = NGRAM) -> list[tuple]:
    """The same result by direct comparison, for tests."""
    import re

    say = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
    wins: dict[tuple, set] = {}
    for item, text in items:
        w = say(text)
        for i in range(len(w) - min(n, len(w)) + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, ids = say(text), set(), set()
        for size in {len(k) for k in wins}:
            for i in range(len(w) - size + 1):
                if got := wins.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    ids |= got
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out
