"""Phrases whose words stand together more often than apart, counted in quotient filters.

Texts are lower-cased (A-Z) and cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words at blanks and tabs; everything is counted for each language. A phrase
of 2 to ``LONGEST`` words that occurs ``least`` times is a candidate, scored by its weakest cut into two parts
(``1000 * a * n / (l * r)``, rounded down), and dropped where a longer candidate around it occurs as often.

1. *Shards.* About ``SHARD_BYTES`` of texts are read at once. A shard numbers its distinct words in the order of their hashes and is staged as a row: these
   words with their counts, and its texts in these numbers.
2. *Words.* Each shard's words are dealt out in buckets of hashes, a row for each, and added up by the words themselves; those with ``least`` occurrences, of which alone
   a candidate can consist, get ids, and each shard is told the ids of its words.
3. *Pairs.* Each shard counts its word pairs in counting quotient filters (``quotient.py``), a filter for each bucket of keys. Sorted filters of a bucket are merged
   across shards, and each shard is told which of its pairs are frequent.
4. *Longer phrases*, of which every pair of neighbours is frequent, are counted and merged in the same way.
5. Scores, containment and ranks are joins and windows over the frequent phrases; joins on parts and languages are salted.

Nothing is broadcast, nothing is sampled, and every count is exact. A word, pair or phrase that has a third of all occurrences is one entry of each shard's
filter. Buckets are even, as keys are permuted, and of a bounded size, as there are more of them where there are more words.

Nulls: a null text is empty; a null language is ``und``. Repeated rows count as often as they occur. Empty tables give empty results. Other columns are not
read. A very long text is read whole, as a shard of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import quotient as Q
from . import words as W
from .common import discard, released, salted_join, stage, steps, text_bytes

LONGEST = 5
LEAST = 100
MOST = 2000
SHARD_BYTES = 4_000_000
#: Rows of a shard at most: their languages are numbered in two bytes.
SHARD_ROWS = 60_000
#: Words of all shards for each bucket of words or keys, of which one is held in memory at once.
BUCKET_WORDS = 1_000_000
LEAST_BUCKET_BITS = 8
SALTS = 16

IS_BREAK = np.zeros(256, bool)
IS_BREAK[[ord(c) for c in ".,;:!?"]] = IS_BREAK[10:14] = True
IS_WORD = ~IS_BREAK
IS_WORD[[9, 32]] = False

_field = T.StructField
_binaries = lambda *names: [_field(c, T.BinaryType()) for c in names]
#: Words in the order of their hashes: number of their language, bytes, occurrences; and the texts in numbers of words, -1 after a piece.
WORDS = [_field("langs", T.ArrayType(T.StringType(), False)), *_binaries("of", "sizes", "counts", "spelt")]
SHARDS = T.StructType([_field("shard", T.LongType()), *WORDS, *_binaries("hashes", "codes"), _field("n_words", T.LongType()), _field("n_distinct", T.LongType())])
#: A shard's words of a bucket; ``first``: the number of the first.
DEALT = T.StructType([_field("shard", T.LongType()), _field("bucket", T.LongType()), _field("first", T.LongType()), *WORDS])
#: A frequent word with its id, or (``id`` null) the occurrences of a bucket's words of a language, or numbers and ids of a shard's words.
KNOWN = T.StructType([_field("lang", T.StringType()), _field("word", T.StringType()), _field("id", T.LongType()), _field("n", T.LongType()), _field("shard", T.LongType()), *_binaries("numbers", "ids")])
#: A filter of a bucket, or (``size`` 0) a shard's texts in word ids; a piece ends with 0.
FILTERS = T.StructType([_field("shard", T.LongType()), _field("size", T.IntegerType()), _field("bucket", T.LongType()), _field("data", T.BinaryType())])
#: A frequent phrase, or (``ids`` null) the keys of a shard's frequent pairs.
MERGED = T.StructType([_field("shard", T.LongType()), _field("size", T.IntegerType()), _field("ids", T.ArrayType(T.LongType(), False)), _field("n", T.LongType()), _field("keys", T.BinaryType())])


def _rows(schema: T.StructType, many: int, /, **columns) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(many, f.type) for f in arrow], schema=arrow)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text, whether a piece begins) of the words of lower-cased texts."""
    starts, ends, text = W.cut(data, off, IS_WORD)
    piece = np.concatenate(([0], np.cumsum(IS_BREAK[data])))[starts] if len(starts) else starts
    begins = np.ones(len(starts), bool)
    begins[1:] = (text[1:] != text[:-1]) | (piece[1:] != piece[:-1])
    return starts, ends, text, begins


def _shard(shard: int, data: np.ndarray, off: np.ndarray, lang: pa.Array):
    """The row of SHARDS of some texts."""
    low = W.LOWER[data]
    starts, ends, text, begins = tokens(low, off)
    if not len(starts):
        return
    coded = lang.dictionary_encode()
    of = coded.indices.to_numpy(zero_copy_only=False)[text]
    words = prefixed(of, ends - starts, low[IS_WORD[low]]).dictionary_encode()
    own, place = text_bytes(words.dictionary)
    n = len(place) - 1
    sizes = np.diff(place) - 2
    spelt = W.gathered(own, place[:-1] + 2, sizes)
    of = own[place[:-1]].astype(np.int64) | own[place[:-1] + 1].astype(np.int64) << 8
    names = coded.dictionary.to_pylist()
    sums, inv = W.range_sums(W.BYTE_VALUE[spelt], W.BASE)
    at = np.concatenate(([0], np.cumsum(sizes)))
    seeds = np.array([int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") for x in names], np.uint64)
    hashes = W.mix((sums[at[1:]] - sums[at[:-1]]) * inv[at[:-1]] + seeds[of]) >> np.uint64(32)
    order = np.argsort(hashes, kind="stable")
    number = np.empty(n, np.int32)
    number[order] = np.arange(n, dtype=np.int32)
    code = number[words.indices.to_numpy(zero_copy_only=False)]
    out = np.full(len(code) + int(begins.sum()), -1, np.int32)
    out[np.arange(len(code)) + np.cumsum(begins) - 1] = code
    columns = {"of": of[order].astype(np.uint16), "sizes": sizes[order].astype(np.uint32), "counts": np.bincount(code, minlength=n).astype(np.uint32), "spelt": W.gathered(spelt, at[:-1][order], sizes[order]), "hashes": hashes[order].astype(np.uint32), "codes": out}
    yield _rows(SHARDS, 1, shard=[shard], langs=[names], n_words=[len(code)], n_distinct=[n], **{k: [v.tobytes()] for k, v in columns.items()})


def prefixed(of: np.ndarray, sizes: np.ndarray, spelt: np.ndarray) -> pa.Array:
    """Words with the two bytes of their language's number before them."""
    size = sizes + 2
    ends = np.cumsum(size)
    at = ends - size
    named = np.empty(int(size.sum()), np.uint8)
    inner = np.ones(len(named), bool)
    inner[at] = inner[at + 1] = False
    named[at], named[at + 1], named[inner] = of & 255, of >> 8, spelt
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(np.append(at, len(named)).astype(np.int64)), pa.py_buffer(named)])


def _shards(shard_bytes: int):
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for k in range(0, batch.num_rows, SHARD_ROWS):
                part = batch.slice(k, SHARD_ROWS)
                data, off = text_bytes(part.column("text"))
                for i, j in steps(off, shard_bytes):
                    yield from _shard(number, data[off[i] : off[j]], off[i : j + 1] - off[i], part.column("lang").slice(i, j - i))
                    number += 1

    return released(run)


def _array(cell, kind) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind)


def _deal(p: int):
    """Each shard's words by bucket."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                bucket = _array(row["hashes"], np.uint32) >> np.uint32(32 - p)
                ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket))
                first = np.concatenate(([0], ends[:-1]))
                columns = {c: _array(row[c], k) for c, k in (("of", np.uint16), ("sizes", np.uint32), ("counts", np.uint32))}
                at = np.concatenate(([0], np.cumsum(columns["sizes"], dtype=np.int64)))
                spelt = row["spelt"].as_buffer()
                cut = {c: [x[a:b].tobytes() for a, b in zip(first, ends)] for c, x in columns.items()}
                cut["spelt"] = [spelt.slice(at[a], at[b] - at[a]).to_pybytes() for a, b in zip(first, ends)]
                m = len(ends)
                yield _rows(DEALT, m, shard=np.full(m, row["shard"].as_py()), bucket=bucket[first].astype(np.int64), first=first, langs=[row["langs"].as_py()] * m, **cut)

    return released(run)


def _add_words(p: int, least: int):
    """Rows come by bucket. Out go its frequent words with ids, the occurrences by language, and each shard's numbers of frequent words."""

    def done(bucket: int, rows: list[dict]):
        langs: dict[str, int] = {}
        of = np.concatenate([np.array([langs.setdefault(x, len(langs)) for x in r["langs"].as_py()])[_array(r["of"], np.uint16)] for r in rows])
        sizes, counts = (np.concatenate([_array(r[c], np.uint32) for r in rows]).astype(np.int64) for c in ("sizes", "counts"))
        words = prefixed(of, sizes, np.concatenate([_array(r["spelt"], np.uint8) for r in rows])).dictionary_encode()
        code = words.indices.to_numpy(zero_copy_only=False)
        total, by_lang = np.zeros(len(words.dictionary), np.int64), np.zeros(len(langs), np.int64)
        np.add.at(total, code, counts)
        np.add.at(by_lang, of, counts)
        names = pa.array(list(langs), pa.string())
        yield _rows(KNOWN, len(langs), lang=names, n=by_lang)
        often = np.flatnonzero(total >= least)
        ids = np.zeros(len(total), np.int64)
        ids[often] = (np.arange(len(often)) << p) + bucket + 1
        own, place = text_bytes(words.dictionary)
        at, many = place[:-1][often], np.diff(place)[often] - 2
        spelt = pa.Array.from_buffers(pa.large_string(), len(often), [None, pa.py_buffer(np.concatenate(([0], np.cumsum(many))).astype(np.int64)), pa.py_buffer(W.gathered(own, at + 2, many))])
        yield _rows(KNOWN, len(often), lang=names.take(pa.array(own[at].astype(np.int64) | own[at + 1].astype(np.int64) << 8)), word=spelt.cast(pa.string()), id=ids[often], n=total[often])
        begin, told = 0, []
        for r in rows:
            n = len(r["sizes"].as_buffer()) // 4
            mine = ids[code[begin : begin + n]]
            begin += n
            at = np.flatnonzero(mine)
            if len(at):
                told.append((r["shard"].as_py(), (at + r["first"].as_py()).astype(np.int32).tobytes(), mine[at].tobytes()))
        yield _rows(KNOWN, len(told), **{c: list(x) for c, x in zip(("shard", "numbers", "ids"), zip(*told))})

    def run(batches):
        bucket, held = None, []
        for batch in batches:
            for i, b in enumerate(batch.column("bucket").to_pylist()):
                if b != bucket:
                    if held:
                        yield from done(bucket, held)
                    bucket, held = b, []
                held.append({c: batch.column(c)[i] for c in batch.schema.names})
        if held:
            yield from done(bucket, held)

    return released(run)


def filters(shard: int, ids: np.ndarray, at: np.ndarray, n: int, bits: int, wanted: int):
    """Rows of FILTERS for the phrases of n words that begin at ``at``."""
    if not len(at):
        return
    keys, counts, _ = Q.summed(Q.packed(np.stack([ids[at + k] for k in range(n)]), bits))
    p = Q.bucket_bits(n, bits, wanted)
    bucket = Q.buckets(keys, n, bits, p)
    ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket))
    first = np.concatenate(([0], ends[:-1]))
    data = [Q.encode(keys[:, a:b], counts[a:b], n, bits, p) for a, b in zip(first.tolist(), ends.tolist())]
    yield _rows(FILTERS, len(data), shard=np.full(len(data), shard), size=np.full(len(data), n, np.int32), bucket=bucket[first], data=data)


def _by_shard(batches, small: list[str], large: str, make):
    """Rows come by shard, those with ``small`` columns first: ``make(shard, columns, content)`` for each row with ``large`` content."""
    held, shard = [], None
    for batch in batches:
        numbers = batch.column("shard").to_numpy(zero_copy_only=False)
        content = batch.column(large)
        cuts = np.flatnonzero(content.is_valid().to_numpy(zero_copy_only=False) | np.append(numbers[1:] != numbers[:-1], True)) + 1
        at = 0
        for end in cuts.tolist():
            part, at = batch.slice(at, end - at), end
            if int(numbers[end - 1]) != shard:
                held, shard = [], int(numbers[end - 1])
            last = part.column(large)[-1]
            rows = part.slice(0, part.num_rows - 1) if last.is_valid else part
            if rows.num_rows:
                held.append([rows.column(c) for c in small])
            if last.is_valid:
                yield from make(shard, [pa.chunked_array(c).combine_chunks() for c in zip(*held)] if held else None, last.as_buffer())


def _pairs(bits: int, wanted: int):
    """Each shard's texts in ids, and the filters of its pairs."""

    def make(shard, known, codes):
        codes = np.frombuffer(codes, np.int32)
        table = np.zeros(int(codes.max()) + 2, np.int64)
        for numbers, own in zip(*known or ((), ())):
            table[_array(numbers, np.int32)] = _array(own, np.int64)
        ids = table[codes]
        pair = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        used = np.zeros(len(ids), bool)
        used[pair] = used[pair + 1] = True
        used[1:] |= used[:-1] & (ids[1:] == 0)  # of every stretch the 0 after it, too
        ids = ids[used]
        if len(ids):
            yield _rows(FILTERS, 1, shard=[shard], size=np.zeros(1, np.int32), data=[ids.astype(np.int64 if bits > 31 else np.int32).tobytes()])
            yield from filters(shard, ids, np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0)), 2, bits, wanted)

    return released(lambda batches: _by_shard(batches, ["numbers", "ids"], "codes", make))


def _longer(bits: int, wanted: int, longest: int):
    """Filters of the phrases of three words and more whose pairs are all frequent."""

    def make(shard, known, data):
        if not known:
            return
        ids = np.frombuffer(data, np.int64 if bits > 31 else np.int32).astype(np.int64)
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        frequent = np.sort(np.concatenate([np.frombuffer(k.as_buffer(), np.uint64) for k in known[0]]))
        key = Q.packed(np.stack([ids[at], ids[at + 1]]), bits)
        if len(key) > 1:
            frequent = np.sort(np.concatenate([np.frombuffer(k.as_buffer(), "V16") for k in known[0]]))
            key = np.ascontiguousarray(key.T).view("V16").reshape(1, -1)
        near = np.minimum(np.searchsorted(frequent, key[0]), len(frequent) - 1) if len(key) == 1 else None
        good = np.zeros(len(ids), bool)
        good[at] = frequent[near] == key[0] if near is not None else np.isin(key[0], frequent)
        for n in range(3, longest + 1):
            at = at[good[at]] if n == 3 else at
            at = at[at + n - 2 < len(ids)]
            at = at[good[at + n - 2]]
            yield from filters(shard, ids, at, n, bits, wanted)

    return released(lambda batches: _by_shard(batches, ["keys"], "data", make))


def _merge(bits: int, wanted: int, least: int, tell: bool):
    """Rows come by size and bucket. Out go the phrases with ``least`` occurrences and, if ``tell``, each shard's keys of them."""

    def done(n: int, bucket: int, shards: list[int], data: list):
        p = Q.bucket_bits(n, bits, wanted)
        found = [Q.decode(d, n, bits, p, bucket) for d in data]
        keys, counts, number = Q.summed(np.concatenate([k for k, _ in found], 1), np.concatenate([c for _, c in found]))
        often = counts >= least
        if not often.any():
            return
        ids = Q.unpacked(keys[:, often], n, bits)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(ids.shape[1] + 1) * n, pa.int32()), pa.array(ids.T.ravel()))
        yield _rows(MERGED, ids.shape[1], size=np.full(ids.shape[1], n, np.int32), ids=lists, n=counts[often])
        if tell:
            at, out = 0, []
            for shard, (k, _) in zip(shards, found):
                mine = often[number[at : at + k.shape[1]]]
                at += k.shape[1]
                if mine.any():
                    out.append((shard, np.ascontiguousarray(k[:, mine].T).tobytes()))
            yield _rows(MERGED, len(out), shard=[s for s, _ in out], keys=[k for _, k in out])

    def run(batches):
        held, shards, data = None, [], []
        for batch in batches:
            for s, n, b, d in zip(*(batch.column(c).to_pylist() for c in ("shard", "size", "bucket")), batch.column("data")):
                if (n, b) != held:
                    if held:
                        yield from done(*held, shards, data)
                    held, shards, data = (n, b), [], []
                shards.append(s)
                data.append(d.as_buffer().to_pybytes())
        if held:
            yield from done(*held, shards, data)

    return released(run)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard_bytes: int = SHARD_BYTES, bucket_words: int = BUCKET_WORDS) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, n) of all phrases of 1 to ``longest`` words with ``least`` occurrences in their language, (lang, n) of all words). ``docs``: lang, text."""
    source = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    shards = stage(source.mapInArrow(_shards(shard_bytes), SHARDS), "shards")
    total, distinct = shards.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_distinct"), F.lit(0))).first()
    bits_for = lambda n: max(LEAST_BUCKET_BITS, int(n // bucket_words).bit_length())
    p = min(bits_for(distinct), 31)
    by_bucket = shards.select("shard", "hashes", *(f.name for f in WORDS)).mapInArrow(_deal(p), DEALT).repartition("bucket").sortWithinPartitions("bucket", "shard")
    known = stage(by_bucket.mapInArrow(_add_words(p, least), KNOWN), "words")
    vocabulary = known.where("id is not null").select("lang", "word", "id", "n")
    totals = stage(known.where("id is null and shard is null").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    bits = max(1, int(vocabulary.agg(F.coalesce(F.max("id"), F.lit(1))).first()[0]).bit_length())
    wanted = bits_for(total)

    def dealt(small: DataFrame, large: DataFrame, content: str) -> DataFrame:
        both = small.unionByName(large, allowMissingColumns=True)
        return both.repartition("shard").sortWithinPartitions("shard", F.col(content).isNotNull())

    told = known.where("shard is not null").select("shard", "numbers", "ids")
    pairs = stage(dealt(told, shards.select("shard", "codes"), "codes").mapInArrow(_pairs(bits, wanted), FILTERS), "pairs")
    dealt_out = lambda df: df.repartition("size", "bucket").sortWithinPartitions("size", "bucket")
    merged = stage(dealt_out(pairs.where("size > 0")).mapInArrow(_merge(bits, wanted, least, longest > 2), MERGED), "merged-pairs")
    found = merged.where("ids is not null").select("ids", "n")
    if longest > 2:
        told = dealt(merged.where("ids is null").select("shard", "keys"), pairs.where("size = 0").select("shard", "data"), "data")
        more = dealt_out(told.mapInArrow(_longer(bits, wanted, longest), FILTERS)).mapInArrow(_merge(bits, wanted, least, False), MERGED)
        found = found.unionByName(more.select("ids", "n"))
    spelt = salted_join(found.select("ids", "n", F.posexplode("ids").alias("at", "id")), vocabulary.select("id", "lang", "word"), ["id"], "inner", SALTS)
    phrases = spelt.groupBy("ids", "n").agg(F.first("lang").alias("lang"), F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("words"))
    single = vocabulary.select("lang", "n", F.array("word").alias("words"))
    out = stage(phrases.select("lang", "n", "words").unionByName(single).select("lang", "words", F.array_join("words", " ").alias("phrase"), "n"), "frequent")
    discard(shards, known, pairs, merged)
    return out, totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = MOST, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``most`` candidates by score, count and phrase, without those that a longer one
    around them makes redundant."""
    phrases, totals = frequent_phrases(docs, least, longest, **options)
    part = lambda of, name: phrases.select("lang", F.col("phrase").alias(of), F.col("n").alias(name))
    candidates = phrases.where(F.size("words") > 1).withColumnRenamed("n", "a")
    cuts = candidates.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.array_join(F.expr("slice(words, 1, k)"), " "), "rest": F.array_join(F.expr("slice(words, k + 1, size(words))"), " ")}).drop("words")
    cuts = salted_join(cuts, part("first", "l"), ["lang", "first"], "inner", SALTS).drop("first")
    cuts = salted_join(cuts, part("rest", "r"), ["lang", "rest"], "inner", SALTS).drop("rest")
    cuts = salted_join(cuts, totals, ["lang"], "inner", SALTS)
    score = F.expr("cast(1000 * cast(a as decimal(38, 0)) * cast(n as decimal(20, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) as bigint)")
    cuts = cuts.withColumn("score", score)
    weakest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut"))

    sizes = F.sequence(F.lit(2), F.size("words") - 1)
    inner = candidates.where(F.size("words") > 2).select("lang", "words", "a", F.explode(sizes).alias("s"))
    inner = inner.select("lang", "words", "a", "s", F.explode(F.expr("sequence(1, size(words) - s + 1)")).alias("at"))
    inner = inner.select("lang", F.array_join(F.expr("slice(words, at, s)"), " ").alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    left = weakest.join(inner, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < 100 * F.col("cut.a")))

    best = [F.col("cut.score").desc(), F.col("cut.a").desc(), F.col("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    left = left.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= most)
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= most)
    return left.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces
), counted AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0
), grams AS (
  SELECT lang, k.k AS size, array_to_string(w[i : i + k.k - 1], ' ') AS phrase
  FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS k) AS k WHERE i + k.k - 1 <= len(w)
), f AS (
  SELECT lang, size, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, k.k, string_split(c.phrase, ' ') AS w
  FROM f AS c, (SELECT unnest([1, 2, 3, 4]) AS k) AS k WHERE c.size > k.k
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, l.a AS l, r.a AS r, n.n, c.k, (1000 * c.a * n.n) // (l.a * r.a) AS score
  FROM cuts AS c JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : c.k], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1 : c.size], ' ') JOIN counted AS n ON n.lang = c.lang
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT DISTINCT c.lang, c.phrase FROM f AS c JOIN f AS b ON b.lang = c.lang AND b.size > c.size AND c.size > 1
    AND contains(concat(' ', b.phrase, ' '), concat(' ', c.phrase, ' ')) AND 100 * b.a >= 100 * c.a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank FROM weakest AS s ANTI JOIN inside AS i ON i.lang = s.lang AND i.phrase = s.phrase)
WHERE rank <= 2000
"""


def brute_force(docs: list[tuple], least: int = LEAST, longest: int = LONGEST, most: int = MOST) -> list[tuple]:
    """The same rows by a table of all phrases, for tests. ``docs``: (lang, text)."""
    import re
    from collections import Counter, defaultdict

    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, seen in f.items():
        found = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and a >= found[p[i:j]]}
        rows = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (seen[p[:k]] * seen[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), seen[p[:k]], seen[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:most])]
    return sorted(out)
