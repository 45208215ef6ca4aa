"""Chat formatting with Spark expressions only: one training string per conversation, and its loss mask.

Turns are collected as structs and sorted; neighbouring turns of one role are merged into one block with an
array aggregation, their texts kept apart by a mark; blocks are joined into one string::

    <|turn|>role<|text|>text<|more|>text<|end|>

Control strings inside roles and texts, those of this template and of common others (``<s>``, ``</s>``,
``[INST]``, ``<<SYS>>``, ``<|anything|>``), get a backslash after their first bracket, one more if they have some;
``unescape`` takes one off, so any text comes back exactly. The loss mask is the list of (start, length) of the
assistant texts in the string, in code points.

Nulls: a null text or role is empty; rows of a null conv_id form one conversation. Ties in turn are ordered by
role, then text; repeated rows are repeated turns. Empty tables give empty results; other columns are dropped.
One conversation is one string, so its turns meet in one row; many copies of a conversation are many keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TURN, TEXT, MORE, END = "<|turn|>", "<|text|>", "<|more|>", "<|end|>"
#: What may follow the first bracket of a control string.
_AFTER = r"(/?s>|/?INST\]|</?SYS>>|\|[^|<>\s]*\|>)"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={_AFTER})", r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?={_AFTER})", "$1$2")


def _blocks(turns: Column) -> Column:
    """Sorted turns as blocks of one role each: array of (role, texts)."""

    def add(done: Column, t: Column) -> Column:
        last = F.element_at(done, -1)
        same = (F.size(done) > 0) & (F.when(F.size(done) > 0, last["role"]) == t["role"])
        grown = F.struct(t["role"].alias("role"), F.concat(last["texts"], F.array(t["text"])).alias("texts"))
        fresh = F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts"))
        return F.when(same, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(fresh)))

    return F.aggregate(turns, F.expr("cast(array() as array<struct<role:string,texts:array<string>>>)"), add)


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted) of ``turns`` (conv_id, turn, role, text)."""
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_ = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("turns"))
    safe = F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    block = lambda b: F.concat(F.lit(TURN), b["role"], F.lit(TEXT), F.array_join(b["texts"], MORE), F.lit(END))
    return sorted_.select("conv_id", _blocks(safe).alias("blocks")).select("conv_id", F.array_join(F.transform("blocks", block), "").alias("formatted"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (array of role, text) and ``loss_mask`` (array of start, length; from 0)."""
    raw = F.filter(F.split("formatted", r"<\|end\|>"), lambda b: b != "")
    parts = lambda b: F.split(F.substring(b, F.lit(len(TURN) + 1), F.length(b)), r"<\|text\|>")
    blocks = F.transform(raw, lambda b: F.struct(parts(b)[0].alias("role"), F.split(parts(b)[1], r"<\|more\|>").alias("texts")))
    turns = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t: F.struct(unescape(b["role"]).alias("role"), unescape(t).alias("text")))))
    # ends of the blocks, then of the texts within each, as running sums
    size = lambda b: F.lit(len(TURN) + len(TEXT) + len(END)) + F.length(b["role"]) + F.length(F.array_join(b["texts"], MORE))
    zero = F.expr("named_struct('at', 0, 'found', cast(array() as array<struct<start:int,length:int>>))")

    def texts(at: Column, b: Column) -> Column:
        begin = F.struct((at + F.lit(len(TURN) + len(TEXT)) + F.length(b["role"])).cast("int").alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("found"))
        step = lambda acc, t: F.struct((acc["at"] + F.length(t) + len(MORE)).cast("int").alias("at"), F.concat(acc["found"], F.array(F.struct(acc["at"].alias("start"), F.length(t).alias("length")))).alias("found"))
        return F.aggregate(b["texts"], begin, step)["found"]

    def walk(acc: Column, b: Column) -> Column:
        found = F.when(b["role"] == LEARNED, F.concat(acc["found"], texts(acc["at"], b))).otherwise(acc["found"])
        return F.struct((acc["at"] + size(b)).cast("int").alias("at"), found.alias("found"))

    read = formatted.withColumn("blocks", blocks)
    return read.withColumn("turns", turns).withColumn("loss_mask", F.aggregate("blocks", zero, walk)["found"]).drop("blocks")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = read_back(format_chats(given.unionByName(trap)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join(F.transform("loss_mask", lambda m: unescape(F.substring(F.col("formatted"), m["start"] + 1, m["length"]))), "")
    return back.withColumn("masked", masked).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ESCAPED = "regexp_replace({0}, '([<\\[])(\\\\*)(/?s>|/?INST\\]|</?SYS>>|\\|[^|<>\\s]*\\|>)', '\\1\\2\\\\\\3', 'g')"
SQL = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (SELECT *, row_number() OVER w AS nth, coalesce(lag(role) OVER w, chr(0)) <> role AS fresh FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
sized AS (SELECT *, length({_ESCAPED.format("text")}) + CASE WHEN fresh THEN {len(TURN + TEXT + END)} + length({_ESCAPED.format("role")}) ELSE {len(MORE)} END AS size FROM marked)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = '{LEARNED}'), '')) AS loss_sha256, sum(size)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
