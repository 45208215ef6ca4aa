"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become token ids closed by an end id; only those longer than a sequence are cut. The pieces are dealt
to packers of about ``PIECES_A_PACKER`` pieces, however many documents there are. Each packer takes them in ``ROUNDS``
rounds, each longest first, and places each into the open sequence with the least space that still holds it: a bitset
has a bit for every amount of free space that some open sequence has, so that the fit is found with two integer
operations. At most ``OPEN`` sequences are open; beyond that the fullest one is closed, so that a packer's memory is
bounded (on the check tables this costs 2 sequences in 10,000 against one round with all of them open). Pieces are dealt by
numbers given when they were written, so that equal rows spread too and a lost task gives the same placements again.

Tokens: text between blanks and line feeds never shares a token, so ids are kept by such words (a bounded
cache) and joined.

Nulls: a null text is empty, and is the end id alone; a null doc_id is an id. Repeated rows are packed each.
Empty tables give empty results. Of other columns none is kept, so their names do not matter. A very long text is a step of
its own; its pieces leave in batches.
"""

from __future__ import annotations

import itertools
import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import released, stage, steps

LENGTH = 2048
END = 0
OPEN = 2048
PIECES_A_PACKER = 40_000
ROUNDS = 5
#: Words of a generation, of which a Python worker keeps two (about 40 MB) across its tasks.
KNOWN_WORDS = 100_000
#: Bytes of text whose words are numbered at once.
WORDS_STEP = 4_000_000
#: Marks that end a word in a token of their own.
TAIL = ".,;:!?#%*$&"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _ends_a_word(body: str) -> bool:
    """Whether the tokenizer sees a letter or digit at the end, after it has composed and lower-cased."""
    last = body[-1] if body[-1] < "\x80" else unicodedata.normalize("NFC", body).lower()[-1]
    return last.isalpha() or "0" <= last <= "9"


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit numbers, from kept ids of their words.

    Words are kept in two generations of at most ``KNOWN_WORDS``: when the younger is full it becomes the elder, whose
    words are taken over as they occur again. What is kept never changes a result.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.elder: dict[str, bytes] = {}
        # a special token cuts a text as its own start would, so that many words are encoded in one call
        self.mark = "<|startoftext|>"
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        # words of letters end in tokens that say so, and need no mark between them
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, words: list[str]) -> None:
        plain = [w for w in words if w.isalpha()]
        rest = [w for w in words if not w.isalpha()]
        groups = [plain[i : i + 500] for i in range(0, len(plain), 500)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(group):  # one end a word: letters are one word for the tokenizer too
                self._keep(group, ids.tobytes(), (ends * 4).tolist(), 0)
            else:
                rest += group
        odd = [w for w in rest if "<|" in w] if self.mark_id is not None else rest
        for w in odd:
            self.known[w] = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
        if len(odd) < len(rest):
            rest = [w for w in rest if "<|" not in w]
            groups = [rest[i : i + 500] for i in range(0, len(rest), 500)]
            for group, e in zip(groups, self.tokenizer.encode_batch_fast([self.mark.join(g) for g in groups], add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                self._keep(group, raw := ids.tobytes(), [*(np.flatnonzero(ids == self.mark_id) * 4).tolist(), len(raw)], 4)

    def _keep(self, words: list[str], raw: bytes, ends: list[int], gap: int) -> None:
        at = 0
        for w, end in zip(words, ends):
            self.known[w] = raw[at:end]
            at = end + gap

    def _learn(self, new: list[str]) -> None:
        """Make ``new`` words known; marks at a word's end are tokens of their own, so that its body is learnt once."""
        known, elder = self.known, self.elder
        split, plain = [], set()
        for w in new:
            if (ids := elder.get(w)) is not None:
                known[w] = ids
            elif w and w[-1] in TAIL and (body := w.rstrip(TAIL)) and _ends_a_word(body):
                split.append((w, body, w[len(body) :]))
                plain.update(split[-1][1:])
            else:
                plain.add(w)
        missing = []
        for w in plain:
            if w not in known:
                if (ids := elder.get(w)) is not None:
                    known[w] = ids
                else:
                    missing.append(w)
        self._encode(missing)
        for w, body, tail in split:
            known[w] = known[body] + known[tail]

    def of(self, texts: pa.Array):
        """Each text's ids. Arrow numbers a step's distinct words; only those are looked up one by one."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)))
        for i, j in steps(sizes, WORDS_STEP):
            part = texts.slice(i, j - i)
            if not pc.any(pc.match_substring(part, "<|")).as_py():  # the tokenizer lower-cases all but special tokens
                part = pc.ascii_lower(part)
            said = pc.split_pattern(pc.replace_substring(part, "\n", " "), " ")
            ends = said.offsets.to_numpy() - said.offsets[0].as_py()
            coded = said.flatten().dictionary_encode()
            words, word = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            if len(self.known) > KNOWN_WORDS:
                self.known, self.elder = {}, self.known
            ids = list(map(self.known.get, words))
            if new := [k for k, x in enumerate(ids) if x is None]:
                self._learn([words[k] for k in new])
                for k in new:
                    ids[k] = self.known[words[k]]
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            first = np.cumsum(size) - size
            many = size[word]
            at = np.concatenate(([0], np.cumsum(many)))
            take = np.arange(at[-1]) + np.repeat(first[word] - at[:-1], many)
            out = np.frombuffer(b"".join(ids), "<u4")[take]
            for x, y in zip(at[ends[:-1]].tolist(), at[ends[1:]].tolist()):
                yield out[x:y].tobytes()


_kept: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _kept:
        _kept.clear()
        _kept[path] = Ids(path)
    return _kept[path]


PIECE = [T.StructField("piece", T.IntegerType(), False), T.StructField("start", T.LongType(), False), T.StructField("length", T.LongType(), False), T.StructField("ids_crc32", T.LongType(), False)]
DEAL = T.StructField("__deal", T.LongType(), False)
PLACE = [T.StructField("sequence_id", T.LongType(), False), T.StructField("offset", T.LongType(), False)]


def _tokenise(schema: T.StructType, path: str, length: int, end: int, with_ids: bool):
    def run(batches):
        arrow, ids, close = to_arrow_schema(schema), ids_of(path), np.array([end], "<u4").tobytes()
        number = itertools.count(TaskContext.get().partitionId() << 33)
        for batch in batches:
            doc = batch.column("doc_id")
            rows, many = [], 0
            at: list[int] = []

            def done():
                cols = list(zip(*rows)) or [[]] * (len(arrow) - 1)
                return pa.RecordBatch.from_arrays([doc.take(pa.array(at, pa.int64())), *(pa.array(c, f.type) for c, f in zip(cols, list(arrow)[1:]))], schema=arrow)

            for d, raw in enumerate(ids.of(batch.column("text"))):
                raw += close
                for k, i in enumerate(range(0, len(raw), 4 * length)):
                    part = raw[i : i + 4 * length]
                    rows.append((next(number), k, i // 4, len(part) // 4, zlib.crc32(part), *([np.frombuffer(part, "<u4").astype(np.int32)] if with_ids else [])))
                    at.append(d)
                    many += len(part)
                if many > 16_000_000:
                    yield done()
                    rows, at, many = [], [], 0
            yield done()

    return released(run)


class BestFit:
    """Places lengths online; ``place`` gives (sequence, offset)."""

    def __init__(self, length: int, most_open: int):
        self.length, self.most_open, self.next, self.open = length, most_open, 0, 0
        self.space = 0  # bit f is set if an open sequence has f free
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]

    def _take(self, free: int) -> int:
        of = self.by_free[free]
        sequence = of.pop()
        if not of:
            self.space ^= 1 << free
        self.open -= 1
        return sequence

    def place(self, size: int) -> tuple[int, int]:
        fits = self.space >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.length, self.next
            self.next += 1
        left = free - size
        if left:
            if self.open >= self.most_open:
                fullest = (self.space & -self.space).bit_length() - 1
                if fullest > left:  # it is itself the fullest
                    return sequence, self.length - free
                self._take(fullest)
            self.by_free[left].append(sequence)
            self.space |= 1 << left
            self.open += 1
        return sequence, self.length - free


def _pack(schema: T.StructType, length: int, most_open: int):
    def run(batches):
        arrow, fit, part = to_arrow_schema(schema), BestFit(length, most_open), TaskContext.get().partitionId() << 36
        for batch in batches:
            got = [fit.place(n) for n in batch.column("length").to_pylist()]
            sequence, offset = np.array(got, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in schema.fields[:-2]), pa.array(part + sequence), pa.array(offset.copy())], schema=arrow)

    return released(run)


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end: int = END, most_open: int = OPEN, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    ids = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)] if with_ids else []
    schema = T.StructType([docs.schema["doc_id"], DEAL, *PIECE, *ids])
    pieces = stage(docs.select("doc_id", "text").mapInArrow(_tokenise(schema, tokenizer or tokenizer_path(), length, end, with_ids), schema), "pieces")
    packers = max(1, -(-pieces.count() // PIECES_A_PACKER))
    dealt = pieces.repartition(packers, F.xxhash64("__deal"))
    dealt = dealt.sortWithinPartitions(F.pmod(F.xxhash64("__deal", F.lit(0)), F.lit(ROUNDS)), F.desc("length"), "doc_id", "piece", "ids_crc32", "__deal")
    out = T.StructType([*(f for f in schema.fields if f is not DEAL), *PLACE])
    return dealt.mapInArrow(_pack(out, length, most_open), out)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
