"""Removal of repeated byte strings with suffix arrays over content-defined shards.

Every byte covered by a ``size``-byte string that also starts anywhere else in the table, same text included,
is repeated; strings are judged on the input and never cross texts. The work is dealt out by content:

1. *Anchors.* In each ``size``-byte string the leftmost smallest hash of its ``ANCHOR``-byte strings is its
   anchor, so equal strings have equal anchors. Neighbouring starts with the same anchor position form one
   *segment* (about 80 starts). A row per segment (anchor hash, segment hash, place) is all that is shuffled.
2. *Equal segments.* Anchors that occur once are done: nothing in their segments repeats. Segments that occur
   more than once repeat as a whole; groups are only counted (with map-side combining), never gathered.
3. *Induced sorting.* Distinct segments that share an anchor, typically at the rims of copied passages, are cut
   from their texts, dealt to shards by anchor, and sorted (``induced.py``): a start is repeated if it shares
   ``size`` bytes with a neighbour in the suffix array, from the permuted common prefixes.
4. *Crowded anchors*, with more than ``CROWD`` distinct segments, would make a shard as large as the crowd. There
   each start's own string is hashed (128 bits) and met by its hash instead, which is exact and spreads.

Places are keyed by the text itself (a hash of 128 bits), so equal texts, of whatever number and doc_id, share one list of places: it is made
distinct where it is collected, bytes are cut from one copy, and the rows of a text are dealt out by salt when they get their list.
Segment and anchor hashes are 64 bits each and only compared within an anchor.

Nulls: a null text is empty; a null doc_id is an id like others. Texts shorter than ``size`` bytes repeat
nothing. Empty tables give empty results. Other columns of the input pass unchanged;
where a column is added that was there, the new one replaces it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import words as W
from .common import released, salted_join, stage, steps, text_bytes
from .induced import repeats, suffix_array

SIZE = 200
ANCHOR = 40
#: Distinct segments of one anchor beyond which starts are counted one by one.
CROWD = 4000
#: Bytes of segments that one suffix array holds (the segments of one anchor stay together).
SHARD_BYTES = 500_000

LONGS = lambda *names: [T.StructField(c, T.LongType(), False) for c in names]
PLACES = T.StructType([*LONGS("k1", "k2"), T.StructField("start", T.IntegerType(), False), T.StructField("end", T.IntegerType(), False)])
#: ``known``: 1 for a place that is known to repeat and only passes through, 2 for the one of such that goes on.
SEGMENTS = T.StructType([*LONGS("anchor", "segment"), *PLACES.fields, T.StructField("known", T.ByteType(), False)])
ONES = T.StructType([*LONGS("anchor"), *PLACES.fields, T.StructField("one", T.BooleanType(), False), T.StructField("single", T.BooleanType(), False)])
CUTS = T.StructType([*LONGS("anchor"), *PLACES.fields, *(T.StructField(c, T.BooleanType(), False) for c in ("single", "crowded")), T.StructField("bytes", T.BinaryType(), False)])



def _anchored(data: np.ndarray, off: np.ndarray, size: int):
    """(text, first start within it, number of starts, anchor hash, segment hash) of all segments."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    span = size - ANCHOR + 1
    if len(data) < size:
        return none
    sums, inv = W.range_sums(W.BYTE_VALUE[data], W.BASE)
    n = len(data) - ANCHOR + 1
    gram = W.mix((sums[ANCHOR:] - sums[:n]) * inv[:n])
    # the smallest of `span` neighbours, by doubling; the position in the low bits makes the leftmost one win
    low = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    reach = 1
    while reach * 2 <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :]) if span > reach else low
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    counts = np.maximum(np.diff(off) - size + 1, 0)
    if not counts.sum():
        return none
    text = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + off[text]
    at = at[starts]
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]))))
    many = np.diff(np.append(first, len(at)))
    begin = starts[first]
    segment = W.mix((sums[begin + many + size - 1] - sums[begin]) * inv[begin])
    return text[first], begin - off[text[first]], many, gram[at[first]], segment


def _batch(schema: T.StructType, *columns) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _segments(size: int):
    """Rows of SEGMENTS. Segments that occur again within the batch repeat for certain: their places are rows
    that only pass through, dealt out by text, and one of them goes on for the rest of the table to meet."""

    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            parts = []
            for i, j in steps(off):
                text, *rest = _anchored(data[off[i] : off[j]], off[i : j + 1] - off[i], size)
                parts.append((text + i, *rest))
            text, start, many, anchor, segment = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 5
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False)[text] for c in ("k1", "k2"))
            yield from _combined(anchor.view(np.int64), segment.view(np.int64), k1, k2, start, start + many + size - 1, text)

    return released(run)


def _combined(anchor, segment, k1, k2, start, end, text):
    """Rows of SEGMENTS for a batch; places of one text come in order."""
    order = np.lexsort((segment, anchor))
    same = (anchor[order[1:]] == anchor[order[:-1]]) & (segment[order[1:]] == segment[order[:-1]])
    lead, again = np.ones(len(order), bool), np.zeros(len(order), bool)
    lead[1:] = ~same
    again[1:] |= same
    again[:-1] |= same
    known = np.sort(order[again])
    if len(known):  # neighbouring places of one text are one
        new = np.concatenate(([True], (text[known[1:]] != text[known[:-1]]) | (known[1:] != known[:-1] + 1)))
        first = np.flatnonzero(new)
        last = known[np.append(first[1:], len(known)) - 1]
        known = known[first]
        yield _batch(SEGMENTS, k2[known], np.zeros(len(known), np.int64), k1[known], k2[known], start[known].astype(np.int32), end[last].astype(np.int32), np.ones(len(known), np.int8))
    pick = order[lead]
    yield _batch(SEGMENTS, anchor[pick], segment[pick], k1[pick], k2[pick], start[pick].astype(np.int32), end[pick].astype(np.int32), np.where(again[lead], 2, 0).astype(np.int8))


def _met(batches):
    """Rows come ordered by anchor and segment. Out go the places of segments that occur again and, of anchors
    with several segments, one row for each. A row is judged by its neighbours, so one row is held over."""
    held = None  # columns of the last row; whether it is like the one before; whether its segment leads its anchor
    names = SEGMENTS.fieldNames()
    for batch in batches:
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        known = cols[-1] == 1
        if known.any():
            out = [c[known] for c in cols]
            yield _batch(ONES, out[0], *out[2:6], np.zeros(len(out[0]), bool), np.zeros(len(out[0]), bool))
        cols = [c[~known] for c in cols]
        if not len(cols[0]):
            continue
        if held:
            cols = [np.concatenate((h, c)) for h, c in zip(held[0], cols)]
        yield from _judged(cols, held, False)
        held = _tail(cols, held)
    if held:
        yield from _judged(held[0], held, True)


def _near(cols, held):
    """Per row: like the row before, of its anchor, and whether its segment is its anchor's first."""
    a, s = cols[:2]
    like, near = np.zeros(len(a), bool), np.zeros(len(a), bool)
    near[1:] = a[1:] == a[:-1]
    like[1:] = near[1:] & (s[1:] == s[:-1])
    if held:
        like[0], near[0] = held[1], held[2]
    begins = np.flatnonzero(~like)
    leads = np.zeros(len(a), bool)
    leads[begins] = ~near[begins]
    run = np.maximum.accumulate(np.where(~like, np.arange(len(a)), -1))
    first = np.where(run >= 0, leads[np.maximum(run, 0)], bool(held and held[3]))
    return like, near, first


def _tail(cols, held):
    like, near, first = _near(cols, held)
    return [c[-1:] for c in cols], bool(like[-1]), bool(near[-1]), bool(first[-1])


def _judged(cols, held, end: bool):
    like, near, first = _near(cols, held)
    n = len(like) if end else len(like) - 1  # the last row waits for its next one
    like_next, near_next = (np.append(x[1:], False)[:n] for x in (like, near))
    like, near, first = like[:n], near[:n], first[:n]
    again = like | like_next
    # the last row stands for an anchor's first segment, once another follows; the first row for each other one
    one = np.where(first, ~like_next & near_next, ~like)
    for pick, is_one in ((again, False), (one, True)):
        at = np.flatnonzero(pick)
        yield _batch(ONES, cols[0][at], *(c[at] for c in cols[2:6]), np.full(len(at), is_one), ~again[at] & (cols[6][at] == 0))


def _cut(size: int):
    """Bytes of the segments listed beside each text."""

    def run(batches):
        for batch in batches:
            lists = batch.column("__list")
            flat, ends = lists.flatten(), lists.offsets.to_numpy()
            columns = {c: flat.field(c) for c in CUTS.fieldNames()[:-1]}
            start, end = (columns[c].to_numpy(zero_copy_only=False) for c in ("start", "end"))
            data = [raw.as_buffer() for raw in batch.column("__raw")]
            of = np.repeat(np.arange(len(data)), np.diff(ends))
            for i in range(0, len(of), 4000):
                j = min(len(of), i + 4000)
                cut = [bytes(data[t][a:b]) for t, a, b in zip(of[i:j].tolist(), start[i:j].tolist(), end[i:j].tolist())]
                yield _batch(CUTS, *(c.slice(i, j - i) for c in columns.values()), cut)

    return released(run)


def _runs(hit: np.ndarray):
    edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def _shard(rows: list[tuple], size: int) -> list[tuple]:
    """Places of repeated strings in the segments (k1, k2, start, end, single, crowded, bytes) of one shard."""
    parts = [np.frombuffer(r[6], np.uint8) for r in rows]
    t = np.concatenate([x for p in parts for x in (p + np.uint8(2), np.ones(1, np.uint8))] + [np.zeros(1, np.uint8)])
    hit = repeats(t, suffix_array(t, 256), size)
    out, at = [], 0
    for (k1, k2, start, _, single, _, _), p in zip(rows, parts):
        if single:
            for a, b in zip(*_runs(hit[at : at + len(p) - size + 1])):
                out.append((k1, k2, start + int(a), start + int(b) - 1 + size))
        at += len(p) + 1
    return out


def _sorted(size: int, shard_bytes: int):
    """Rows come ordered by anchor; one anchor's stay in one shard."""

    def run(batches):
        rows, own, held, anchor = [], [], 0, None

        def done():
            places = _shard(rows, size)
            return _batch(PLACES, *(zip(*places) if places else [[]] * 4))

        for batch in batches:
            for a, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if a != anchor:
                    if any(r[4] for r in own):  # else all of them repeat as they are
                        rows += own
                        held += sum(len(r[6]) for r in own)
                    own, anchor = [], a
                    if held >= shard_bytes:
                        yield done()
                        rows, held = [], 0
                own.append(row)
        rows += own if any(r[4] for r in own) else []
        if rows:
            yield done()

    return released(run)


def _strings(size: int):
    """Rows of SEGMENTS whose anchor and segment are the two halves of a string's hash."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                _, k1, k2, start, end, _, _ = (c.to_numpy(zero_copy_only=False) for c in part.columns[:-1])
                many = end - start - size + 1
                cut = (d[x : x + size] for d, n in zip(part.column("bytes").to_pylist(), many.tolist()) for x in range(n))
                h = np.frombuffer(b"".join(hashlib.blake2b(c, digest_size=16).digest() for c in cut), np.int64).reshape(-1, 2)
                row = np.repeat(np.arange(len(many)), many)
                at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                yield from _combined(h[:, 0], h[:, 1], k1[row], k2[row], at, at + size, row)

    return released(run)


def keyed(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` with the keys of places and the text as bytes."""
    whole = F.coalesce(F.col(text), F.lit(""))
    named = docs.withColumns({"__k1": F.xxhash64(whole), "__k2": F.xxhash64(F.lit(1), whole), "__raw": F.col(text).cast("binary")})
    return named.select(*keep, "__k1", "__k2", "__raw")


def repeated_places(texts: DataFrame, size: int = SIZE, crowd: int = CROWD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(__k1, __k2, start, end): byte ranges of the repeated strings of ``keyed`` texts, not yet merged; some come several times."""
    if size % 8 or size <= ANCHOR:
        raise ValueError(f"size is a multiple of 8 above {ANCHOR}")
    source = texts.select(F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), F.col("__raw").cast("string").alias("text"))
    dealt = source.mapInArrow(_segments(size), SEGMENTS).repartition("anchor").sortWithinPartitions("anchor", "segment")
    met = stage(dealt.mapInArrow(released(_met), ONES), "segments")
    out = met.where("not one").select("k1", "k2", "start", "end")

    # one of each segment meets the others of its anchor
    ones = met.where("one").select("anchor", "k1", "k2", "start", "end", "single")
    crowds = stage(ones.groupBy("anchor").count().where(F.col("count") > crowd).select("anchor", F.lit(True).alias("crowded")), "crowds")
    crowded = bool(crowds.limit(1).count())
    ones = ones.join(crowds, "anchor", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False))) if crowded else ones.withColumn("crowded", F.lit(False))
    lists = ones.groupBy(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).agg(F.collect_list(F.struct(*CUTS.fieldNames()[:-1])).alias("__list"))
    copies = texts.where("__raw is not null").groupBy("__k1", "__k2").agg(F.first("__raw").alias("__raw"))
    cut = copies.join(lists, ["__k1", "__k2"]).mapInArrow(_cut(size), CUTS)
    out = out.unionByName(cut.where("not crowded").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sorted(size, shard_bytes), PLACES))
    if crowded:
        strings = cut.where("crowded").mapInArrow(_strings(size), SEGMENTS).repartition("anchor").sortWithinPartitions("anchor", "segment")
        out = out.unionByName(strings.mapInArrow(released(_met), ONES).where("not one").select("k1", "k2", "start", "end"))
    return out.withColumnsRenamed({"k1": "__k1", "k2": "__k2"})


def _without(schema: T.StructType, kept: list[str], text: str | None):
    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            rows, left = [], []
            for raw, spans in zip(batch.column("__raw"), batch.column("__spans").to_pylist()):
                data = memoryview(raw.as_buffer() if raw.is_valid else b"")
                runs = W.merged([(x["start"], x["end"]) for x in spans or ()])
                at, h = 0, hashlib.sha256()
                keep = []
                for a, b in [*runs, (len(data), len(data))]:
                    h.update(data[at:a])
                    keep.append(data[at:a])
                    at = b
                rows.append((len(data), sum(b - a for a, b in runs), len(runs), h.hexdigest()))
                if text:
                    left.append(b"".join(keep).decode("utf-8", "ignore") if raw.is_valid else None)
            cols = dict(zip(arrow.names[len(kept) :], zip(*rows) if rows else [[]] * 4))
            if text:
                cols[text] = left
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else batch.column(f.name) for f in arrow], schema=arrow)

    return released(run)


def remove_repeats(docs: DataFrame, text: str = "text", keep: list[str] | None = None, **options) -> DataFrame:
    """``docs`` (its columns ``keep``, default all) with n_bytes, n_removed, n_spans and kept_sha256; where ``keep``
    has the text, it is what is left of it (a character cut in two is dropped; null stays null)."""
    more = [*LONGS("n_bytes", "n_removed", "n_spans"), T.StructField("kept_sha256", T.StringType())]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in [f.name for f in more]]
    texts = keyed(docs, [c for c in kept if c != text], text)
    spans = repeated_places(keyed(docs, [], text), **options).groupBy("__k1", "__k2").agg(F.collect_set(F.struct("start", "end")).alias("__spans"))
    schema = T.StructType([docs.schema[c] for c in kept] + more)
    return salted_join(texts, spans, ["__k1", "__k2"]).mapInArrow(_without(schema, kept, text if text in kept else None), schema)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, keep=["doc_id"])


def brute_force(docs: list[tuple], size: int = SIZE) -> list[tuple]:
    """The same result by a table of all strings, for tests."""
    from collections import Counter

    raw = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i : i + size] for _, b in raw for i in range(len(b) - size + 1))
    out = []
    for d, b in raw:
        runs = W.merged([(i, i + size) for i in range(len(b) - size + 1) if seen[b[i : i + size]] > 1])
        gone, at, keep = sum(y - x for x, y in runs), 0, b""
        for x, y in [*runs, (len(b), len(b))]:
            keep, at = keep + b[at:x], y
        out.append((d, len(b), gone, len(runs), hashlib.sha256(keep).hexdigest()))
    return out
