"""Near-duplicate classes from DartMinHash signatures and banded joining.

A text is a weighted set: its shingles of five words, each weighing as often as it occurs (a text of one to
four words is one shingle). Two texts are linked if their weighted Jaccard similarity, sum of minima over sum
of maxima, is at least ``threshold``; classes are the connected components of the links.

1. *Copies.* Texts with equal word sequences form one node, by a 128-bit hash of the words. Nodes have numbers of
   their own, since a doc_id with several texts stands in several nodes.
2. *Darts.* An element's region is weight x rank: darts fall on it as a Poisson process of density one, hashed
   from the shingle and from cells of the region (weights from 0 to 1, 1 to 2, 2 to 4, ...; ranks in slabs that hold
   one dart on average), so that the work follows the darts wanted and not the weights, which may be any positive
   numbers. A text throws the darts below the rank at which about ``t (ln t + 3)`` fall into its whole weight,
   and more only if a coordinate stays empty. The earliest dart of each of ``t = bands * rows`` coordinates is the
   signature; two texts agree in a coordinate with probability equal to their similarity.
3. *Bands.* ``rows`` coordinates form a band; nodes that share a band meet in its bucket. With 24 bands of 6,
   a pair at 0.8 misses all buckets with probability 0.0007.
4. *Centres.* The centre of a bucket is its most popular node, the one whose buckets hold most nodes altogether:
   of a text and its altered copies, that is the text. Every node of a bucket is compared with the centre, so
   a group of copies costs one comparison a node and bucket, not all pairs; components of these links are found.
5. *The rest.* In buckets that still hold several components, every node is written as its differences from the centre:
   the shingles it has more or less often than the centre, once for each time. Two texts differ by the sizes of both
   differences less twice what these share. So a pair that is linked, though not both are linked with the centre, shares a known
   number of differences, at least half of the smaller side, and meets in one of those that come before, in an order
   by rarity, the last so many (a prefix filter). Texts that are all a little below the threshold from each other differ from
   the centre each in its own way and do not meet. Nothing is estimated here and no number of partners is capped; a
   difference in the texts of one component only makes no pairs.
6. *Links.* Comparison is exact, on whole texts (64-bit hashes of the shingles).

Before a text is compared with a centre, their signatures must agree as much as those of linked texts do (``SLACK`` standard
deviations below the threshold: six in 1,000 pairs at 0.8 are missed, none above 0.87); in buckets that step 5 sees, it is compared in any case.

Rows of one doc_id are versions of one document: each is compared as a node, then they share a class. The class id is the smallest doc_id of the
class. Texts without words have no shingles: equal non-empty ones are copies, null and empty ones stay alone.
A null doc_id has a null class and stays alone. Empty tables give empty results. Very long texts are read whole, in steps
of their own. Other columns, whatever their names, are not read by ``near_duplicates`` and pass through ``keep_one`` unchanged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import words as W
from .common import discard, released, salted_join, shielded, stage, steps, text_bytes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 6
SLACK = 2.5
#: Darts of one numpy step, about.
STEP_DARTS = 500_000
#: Bits of a band: its number above, the fields of its rows below.
BAND_BITS = 54
_LEVEL, _SLAB, _DART, _COORDINATE, _PLACE = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F))
#: A uniform 64-bit value has as many of these below it as a Poisson variable of mean one counts.
_POISSON = np.array([min(2**64 - 1, int(2**64 * sum(math.exp(-1) / math.factorial(i) for i in range(n + 1)))) for n in range(16)], np.uint64)


def shingles(data: np.ndarray, off: np.ndarray, size: int = SHINGLE):
    """(hash, text, weight) of each text's distinct shingles, by text and hash."""
    _, _, h, text = W.words(data, off)
    n = len(off) - 1
    begin = np.searchsorted(text, np.arange(n + 1))
    many = np.diff(begin)
    shingle, at = W.windows(h, text, size)
    of = text[at]
    short = np.flatnonzero((many > 0) & (many < size))
    if len(short):
        sums, inv = W.range_sums(h, W.WINDOW_BASE)
        whole = W.mix((sums[begin[short + 1]] - sums[begin[short]]) * inv[begin[short]])
        shingle, of = np.concatenate((shingle, whole)), np.concatenate((of, short))
    order = np.lexsort((shingle, of))
    shingle, of = shingle[order], of[order]
    first = np.flatnonzero(np.concatenate(([True], (shingle[1:] != shingle[:-1]) | (of[1:] != of[:-1])))[: len(of)])
    return shingle[first], of[first], np.diff(np.append(first, len(of)))


def _numbered(many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number within it) of the rows repeated ``many`` times."""
    row = np.repeat(np.arange(len(many)), many)
    return row, np.arange(len(row)) - (np.cumsum(many) - many)[row]


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(element: np.ndarray, of: np.ndarray, weight: np.ndarray, texts: int, t: int) -> np.ndarray:
    """Earliest dart of each coordinate (its rank's leading bits, 0 if there are no elements), texts x t."""
    total = np.bincount(of, weights=weight, minlength=texts)
    out = np.zeros((texts, t), np.uint64)
    todo = np.flatnonzero(total > 0)
    darts = t * (math.log(t) + 3)
    while len(todo):
        wanted = np.zeros(texts, bool)
        wanted[todo] = True
        pick = wanted[of]
        u, cell, w = element[pick], of[pick], weight[pick].astype(np.float64)
        limit = darts / total[cell]
        # levels of weight: 0 to 1, then doubling
        row, level = _numbered(1 + np.ceil(np.log2(np.maximum(w, 1))).astype(np.int64))
        width = 2.0 ** np.maximum(level - 1, 0)
        key = W.mix(u[row] + level.astype(np.uint64) * _LEVEL)
        # slabs of rank with one dart on average
        at, slab = _numbered(np.ceil(limit[row] * width).astype(np.int64))
        key = W.mix(key[at] + slab.astype(np.uint64) * _SLAB)
        which, nth = _numbered(np.searchsorted(_POISSON, key, "right"))
        key = W.mix(key[which] + (nth.astype(np.uint64) + np.uint64(1)) * _DART)
        at, slab = at[which], slab[which]
        row = row[at]
        rank = (slab + _uniform(key)) / width[at]
        inside = rank <= limit[row]
        tall = np.flatnonzero(w[row] != np.where(level[at] == 0, 1, 2 * width[at]))  # the region ends within the level, or above it
        place = np.where(level[at[tall]] == 0, 0, width[at[tall]]) + _uniform(W.mix(key[tall] ^ _PLACE)) * width[at[tall]]
        inside[tall] &= place < w[row[tall]]
        key, rank, row = key[inside], rank[inside], row[inside]
        column = ((W.mix(key ^ _COORDINATE) >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        # positive floats sort like their bits; the cell goes above them
        both = ((cell[row].astype(np.uint64) * np.uint64(t) + column) << np.uint64(40)) | ((rank.view(np.uint64) >> np.uint64(23)) & np.uint64((1 << 40) - 1))
        both.sort()
        where = both >> np.uint64(40)
        first = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1]))[: len(both)])
        out.reshape(-1)[where[first].astype(np.int64)] = both[first] & np.uint64((1 << 40) - 1) | np.uint64(1 << 40)
        todo = todo[(out[todo] == 0).any(axis=1)]
        darts *= 2
    return out


def band_values(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number a band: the band's own number, then some hashed bits of each of its coordinates."""
    bits = BAND_BITS // rows
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64)[None, :] << np.uint64(BAND_BITS), (len(signature), bands)).copy()
    for r in range(rows):
        out |= (W.mix(signature[:, r * bands : (r + 1) * bands]) >> np.uint64(64 - bits)) << np.uint64(bits * r)
    return out


def agreement(a: str, b: str, rows: int) -> Column:
    """In how many coordinates the band values ``a`` and ``b`` agree: fields of their difference that are zero."""
    bits = BAND_BITS // rows
    top = sum(1 << (bits * r + bits - 1) for r in range(rows))
    low = sum(((1 << bits - 1) - 1) << (bits * r) for r in range(rows))
    x = "(x ^ y)"
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> {rows} - bit_count(((({x} & {low}L) + {low}L) | {x}) & {top}L)), 0, (s, v) -> s + v)")


def alike(a: str, b: str, threshold: float, bands: int, rows: int) -> Column:
    """Whether the signatures agree as those of linked texts do, but for ``SLACK`` standard deviations."""
    t = bands * rows
    return agreement(a, b, rows) >= t * threshold - SLACK * math.sqrt(t * threshold * (1 - threshold))


SIGNED = T.StructType([T.StructField("id", T.LongType())] + [T.StructField(c, T.LongType(), False) for c in ("q1", "q2")] + [T.StructField("n", T.LongType(), False), T.StructField("bands", T.ArrayType(T.LongType(), False))])


def _digests(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """128-bit hashes of the texts' words, n x 2; of the text itself where it has none."""
    spoken, at = W.spoken(raw, off)
    said, plain = memoryview(spoken), memoryview(raw)
    cut, whole = at.tolist(), off.tolist()
    out = bytearray()
    for i in range(len(off) - 1):
        out += xxhash.xxh3_128_digest(said[cut[i] : cut[i + 1]]) if cut[i] < cut[i + 1] else xxhash.xxh3_128_digest(plain[whole[i] : whole[i + 1]], 1)
    return np.frombuffer(bytes(out), np.int64).reshape(-1, 2)


def _sign(bands: int, rows: int):
    def run(batches):
        schema, t = to_arrow_schema(SIGNED), bands * rows
        most = max(1, int(STEP_DARTS / (t * (math.log(t) + 3))))
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            ids = batch.column("id")
            for first, last in steps(off):
                for i in range(first, last, most):
                    k = min(last, i + most)
                    own, raw = off[i : k + 1] - off[i], data[off[i] : off[k]]
                    element, of, weight = shingles(raw, own)
                    q = _digests(raw, own)
                    total = np.bincount(of, weights=weight, minlength=k - i).astype(np.int64)
                    h = band_values(signatures(element, of, weight, k - i, t), bands, rows)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(total > 0, bands, 0)))).astype(np.int32)), pa.array(h[total > 0].reshape(-1).view(np.int64)))
                    # n: total weight, 0 for texts without words, -1 for empty ones
                    size = np.where(np.diff(own) == 0, -1, total)
                    columns = [ids.slice(i, k - i), pa.array(q[:, 0].copy()), pa.array(q[:, 1].copy()), pa.array(size), lists.cast(schema.field("bands").type)]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return released(run)


KEYED = T.StructType([T.StructField("doc", T.LongType()), T.StructField("q1", T.LongType(), False), T.StructField("q2", T.LongType(), False), T.StructField("text", T.StringType())])


def _keyed(batches):
    """(doc, q1, q2, text) of rows (doc, text), by the hashes that ``_sign`` gives."""
    schema = to_arrow_schema(KEYED)
    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        q = [_digests(data[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in steps(off)]
        q = np.concatenate(q) if q else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(q[:, 0].copy()), pa.array(q[:, 1].copy()), batch.column("text").cast(schema.field("text").type)], schema=schema)


DIFFERENT = T.StructType([T.StructField(c, T.LongType(), False) for c in ("id", "centre", "class", "n", "m", "d")] + [T.StructField("units", T.ArrayType(T.LongType(), False), False)])


def differences(a: pa.Array, b: pa.Array):
    """By steps of rows: (first, last, weight of each a, weight of each b, hashed differences, row of each).

    A shingle that a has w times more often than b gives w differences, one that it has less often as many of another kind.
    """
    (da, oa), (db, ob) = text_bytes(a), text_bytes(b)
    for i, j in steps(oa + ob):
        ua, fa, wa = shingles(da[oa[i] : oa[j]], oa[i : j + 1] - oa[i])
        ub, fb, wb = shingles(db[ob[i] : ob[j]], ob[i : j + 1] - ob[i])
        n, m = (np.bincount(f, weights=w, minlength=j - i).astype(np.int64) for f, w in ((fa, wa), (fb, wb)))
        u, of, w = np.concatenate((ua, ub)), np.concatenate((fa, fb)), np.concatenate((wa, -wb)).astype(np.int64)
        order = np.lexsort((u, of))
        u, of, w = u[order], of[order], w[order]
        first = np.flatnonzero(np.concatenate(([True], (u[1:] != u[:-1]) | (of[1:] != of[:-1])))[: len(u)])
        u, of, w = u[first], of[first], np.add.reduceat(w, first) if len(first) else w
        row, nth = _numbered(np.abs(w))
        unit = W.mix(W.mix(u[row] + (w[row] > 0).astype(np.uint64) * _LEVEL) + (nth.astype(np.uint64) + np.uint64(1)) * _SLAB)
        yield i, j, n, m, unit, of[row]


def _different(batches):
    schema = to_arrow_schema(DIFFERENT)
    for batch in batches:
        for i, j, n, m, unit, of in differences(batch.column("text"), batch.column("other")):
            d = np.bincount(of, minlength=j - i)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(d))).astype(np.int32)), pa.array(unit.view(np.int64)))
            columns = [batch.column(c).slice(i, j - i) for c in ("id", "centre", "class")] + [pa.array(x.astype(np.int64)) for x in (n, m, d)]
            yield pa.RecordBatch.from_arrays([*columns, lists.cast(schema.field("units").type)], schema=schema)


def similarity(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of a[i] and b[i]."""
    out = np.zeros(len(a))
    (da, oa), (db, ob) = text_bytes(a), text_bytes(b)
    for i, j in steps(oa + ob):
        ua, fa, wa = shingles(da[oa[i] : oa[j]], oa[i : j + 1] - oa[i])
        ub, fb, wb = shingles(db[ob[i] : ob[j]], ob[i : j + 1] - ob[i])
        u, of, w = np.concatenate((ua, ub)), np.concatenate((fa, fb)), np.concatenate((wa, wb))
        order = np.lexsort((u, of))
        u, of, w = u[order], of[order], w[order]
        met = np.flatnonzero((u[1:] == u[:-1]) & (of[1:] == of[:-1]))
        both = np.bincount(of[met], weights=np.minimum(w[met], w[met + 1]), minlength=j - i)
        out[i:j] = both / np.maximum(np.bincount(of, weights=w, minlength=j - i) - both, 1)
    return out


def _linked(threshold: float):
    def run(batches):
        for batch in batches:
            keep = pa.array(similarity(batch.column("ta"), batch.column("tb")) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return released(run)


def links(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose ``texts`` (id, text) are similar."""
    both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    return both.mapInArrow(_linked(threshold), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, class) for every id of ``edges`` (a, b): the smallest id connected with it.

    Large-star and small-star rounds: each id's neighbours are relinked to its smallest neighbour by one
    aggregate and one join, so that no neighbourhood is gathered, until nothing changes.
    """
    at = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        new = stage(small.where("a <> b").distinct(), "edges")
        # done when every id has one edge, to an id that has none of its own
        again = new.groupBy("a").count().where("count > 1").select("a").unionByName(new.select(F.col("b").alias("a")).distinct().join(new.select("a"), "a", "left_semi"))
        if not again.limit(1).count():
            return new.select(F.col("a").alias("id"), F.col("b").alias("class")).unionByName(new.select(F.col("b").alias("id"), F.col("b").alias("class")).distinct())
        at = new


def likely(pairs: DataFrame, nodes: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sizes and signatures allow a link."""
    own = nodes.select("id", "n", "bands")
    both = pairs.join(own.toDF("a", "na", "ba"), "a").join(own.toDF("b", "nb", "bb"), "b")
    return both.where((F.least("na", "nb") >= threshold * F.greatest("na", "nb")) & alike("ba", "bb", threshold, bands, rows)).select("a", "b")


def different(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``members`` (id, centre, class) with the weights n and m of both ``texts`` (id, text) and their d differences, hashed."""
    both = members.join(texts, "id").join(texts.toDF("centre", "other"), "centre")
    return both.select("id", "centre", "class", "text", "other").mapInArrow(released(_different), DIFFERENT)


def near_centre(apart: DataFrame, threshold: float) -> DataFrame:
    """(a, b): those of ``apart``, as ``different`` gives it, that are linked with their centre."""
    return apart.where(F.expr(f"n + m - d >= {threshold}D * (n + m + d)")).select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))


def across(apart: DataFrame, threshold: float) -> DataFrame:
    """(a, b): pairs of different classes with one centre in ``apart`` that share enough differences to be linked, once each.

    Texts of weights n and n' are linked if they differ by at most ``r (n + n')``. With d and d' differences from the centre, of which k are shared,
    they differ by d + d' - 2k. ``left`` counts a text's differences from one on; of k shared ones the first has k left on both sides.
    """
    r, within = (1 - threshold) / (1 + threshold), 1e-6
    units = apart.select("id", "centre", "class", "n", "m", "d", F.explode("units").alias("unit"))
    spread = lambda df: df.groupBy("centre", "unit").agg(F.count("*").alias("texts"), F.min("class").alias("lo"), F.max("class").alias("hi"))
    known = units.join(spread(units).where("texts > 1").select("centre", "unit", "texts"), ["centre", "unit"])
    # those of one text come first in the order and need no number
    left = F.row_number().over(Window.partitionBy("centre", "id").orderBy(F.desc("texts"), F.desc("unit")))
    # the fewest shared with any partner: one that is linked with the centre has partners that are not; others differ by at most r (n + n / threshold) from theirs
    fewest = F.when(F.col("d") <= r * (F.col("n") + F.col("m")), (F.col("d") + r * (F.col("m") - F.col("n"))) / 2).otherwise(F.col("d") - r * (1 + 1 / threshold) * F.col("n"))
    early = known.withColumn("left", left).where(F.col("left") >= F.greatest(F.lit(1.0), fewest) - within)
    early = stage(early.select("centre", "unit", "id", "class", "n", "d", "left"), "early")
    early = early.join(spread(early).where("lo <> hi").select("centre", "unit"), ["centre", "unit"], "left_semi")
    x, y = (early.select("centre", "unit", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "class", "n", "d", "left")]) for s in "ab")
    shared = (F.col("d_a") + F.col("d_b") - r * (F.col("n_a") + F.col("n_b"))) / 2
    sizes = F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")
    met = x.join(y, ["centre", "unit"]).where((F.col("class_a") != F.col("class_b")) & (F.col("id_a") < F.col("id_b")) & sizes & (F.least("left_a", "left_b") >= shared - within))
    return met.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def node_texts(named: DataFrame, nodes: DataFrame, repeated: DataFrame) -> DataFrame:
    """(id, text): one text of each of ``nodes`` (id, doc, q1, q2), from the rows ``named`` (doc, text).

    A doc_id in one row only names its node; the texts of ``repeated`` ones are hashed again to tell their nodes.
    """
    out = named.join(nodes.join(repeated, "doc", "left_anti").select("doc", "id"), "doc").select("id", "text")
    if not repeated.limit(1).count():
        return out
    own = nodes.join(repeated, "doc", "left_semi").select("doc", "q1", "q2", "id")
    versions = named.join(own.select("doc").distinct(), "doc", "left_semi").select("doc", "text").mapInArrow(_keyed, KEYED)
    return out.unionByName(versions.join(own, ["doc", "q1", "q2"]).groupBy("id").agg(F.min("text").alias("text")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, class_id)."""
    named = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = stage(named.mapInArrow(_sign(bands, rows), SIGNED), "signed")

    # copies become one node (id: its number, doc: its smallest doc_id); rows of one doc_id are tied together below
    said = signed.where("n >= 0 and id is not null")
    nodes = said.groupBy("q1", "q2").agg(F.min(F.struct(F.col("id").alias("doc"), "n", "bands")).alias("one"))
    nodes = stage(nodes.select(F.monotonically_increasing_id().alias("id"), "q1", "q2", "one.*"), "nodes")
    placed = nodes.select("id", F.explode("bands").alias("bucket"))
    crowds = placed.groupBy("bucket").agg(F.count("*").alias("crowd")).where("crowd > 1")
    shared = stage(placed.join(stage(crowds, "crowds"), "bucket"), "shared")
    popular = shared.groupBy("id").agg(F.sum("crowd").alias("popularity"))
    centres = shared.join(popular, "id").groupBy("bucket").agg(F.max(F.struct("popularity", "id"))["id"].alias("centre"))
    centres = stage(centres, "centres")
    drawn = shared.join(centres, "bucket").where("id <> centre")
    drawn = drawn.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    met = stage(shared.select("id").distinct(), "met")
    own = stage(nodes.join(met, "id", "left_semi"), "own")
    tested = stage(likely(drawn, own, threshold, bands, rows), "tested")

    key = F.struct("q1", "q2")
    repeated = said.groupBy(F.col("id").alias("doc")).agg(F.count("*").alias("many"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    repeated = stage(repeated.where("many > 1").select("doc", (F.col("lo") != F.col("hi")).alias("differ")), "repeated")
    texts = node_texts(named.where("text is not null").toDF("doc", "text"), own.select("id", "doc", "q1", "q2"), repeated.select("doc"))
    texts = stage(texts, "texts")
    found = stage(links(tested, texts, threshold), "links")
    label = components(found)
    known = shared.join(label, "id", "left").select("bucket", "id", F.coalesce("class", "id").alias("class"))
    several = known.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("bucket")
    members = known.join(stage(several, "several"), "bucket", "left_semi").join(centres, "bucket").where("id <> centre").select("id", "centre", "class").distinct()
    apart = stage(different(stage(members, "members"), texts), "apart")
    more = links(stage(across(apart, threshold), "more"), texts, threshold)
    more = stage(more.unionByName(near_centre(apart, threshold)), "links")
    # a doc_id with several texts ties their nodes together
    versions = said.join(repeated.where("differ").select(F.col("doc").alias("id")), "id", "left_semi").select(F.col("id").alias("doc"), "q1", "q2")
    versions = stage(versions.join(nodes.select("q1", "q2", F.col("id").alias("a")), ["q1", "q2"]).select("doc", "a").distinct(), "versions")
    ties = versions.join(versions.groupBy("doc").agg(F.min("a").alias("b")), "doc").select("a", "b")
    edges = found.unionByName(more).unionByName(ties.where("a <> b"))
    label = components(edges).join(nodes.select("id", "doc"), "id")
    lowest = label.groupBy("class").agg(F.min("doc").alias("class_id"))
    label = stage(label.join(lowest, "class").select("id", "class_id"), "labels")
    discard(texts, own, shared, tested, apart)
    classes = nodes.select("id", "q1", "q2", "doc").join(label, "id", "left").select("q1", "q2", F.coalesce("class_id", "doc").alias("class_id"))
    alone = (F.col("n") < 0) | F.col("id").isNull()
    return salted_join(signed.select("id", "q1", "q2", "n"), classes, ["q1", "q2"]).select(F.col("id").alias(doc_id), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id (the first text, of repeated rows)."""
    docs, named = shielded(docs, "doc_id", "text")
    classes = near_duplicates(docs, **options)
    keep = classes.where("doc_id = class_id").select("doc_id").distinct()
    w = Window.partitionBy("doc_id").orderBy("text")
    kept = docs.join(keep, "doc_id").withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*docs.columns)
    return named(kept.unionByName(docs.where("doc_id is null")))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def brute_force(docs: list[tuple], threshold: float = THRESHOLD, size: int = SHINGLE) -> list[tuple]:
    """The same classes from all pairs, for tests."""
    import re
    from collections import Counter

    say = lambda t: tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")))
    said = [(d, say(t), t) for d, t in docs if d is not None]
    bags = [Counter(w[i : i + size] for i in range(max(1, len(w) - size + 1))) if w else Counter() for _, w, _ in said]
    top = {d: d for d, _, _ in said}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (a, wa, ta) in enumerate(said):
        for j in range(i):
            b, wb, tb = said[j]
            same = wa == wb if wa and wb else (not wa and not wb and ta == tb and bool(ta))
            if not same and wa and wb:
                low, high = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
                same = low / high >= threshold
            if same:
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return sorted((d, find(d)) for d, _, _ in said)
