"""WARC archives of pages, and transaction assembly from them.

``write_archives`` writes a request, a response or revisit, and a metadata record for each page into gzip-packed
``.warc`` text files; of equal payloads the page with the largest id has the response and the others revisit it.
``read_records`` parses such files (any WARC/1.x file, packed whole or by record) and ``assemble`` joins the
records of each capture through their concurrent-to identifiers, in whichever direction they point, into one nested row.

Files are written by Spark's text writer and read by its binary reader, so that they can be in any store; a file takes about
``ROWS_A_FILE * ROW_BYTES`` of records, however long the pages are, and is read as a stream of which a record is held. Equal payloads may be a third of
all pages, and so may be equal rows: they are counted before the exchange, of a payload one copy moves, and repetitions are dealt out.

Record ids name the page, the payload, the URL and, of equal rows, a number, so that pages whose page_id occurs again, with whatever payloads, stay apart.
Nulls: a null html is an empty payload, a null url an empty target. Of equal payloads the row with the largest page_id (then URL) is the response, once, and all
others, also other rows of that page, revisit it. A null page_id never has the response unless all have none.
Empty tables give empty archives. Other columns of the pages are not read, whatever their names. A very long page is one record of its file. A file that is cut off or damaged, a
record without an id, and a payload that does not match its digest become rows with ``error``, which ``assemble`` leaves out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import discard, released, salted_join, shared_dir, stage

SALTS = 16
ROW_BYTES, ROWS_A_FILE = 4_000_000, 16
#: Repetitions of a row that are written out together, and bytes of an archive that are unpacked together.
REPEATED, UNPACKED = 1_000, 1_000_000
DATE = "2024-01-16T00:00:00Z"
ID = "<urn:capture:{}:{}:{}:{}:{}>"


def _record(kind: str, record_id: str, block: str, *headers: tuple[str, str]) -> str:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block.encode())}"]
    return "WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n" + block


def _id(page_id, url: str | None, digest: str, nth: int, kind: str) -> str:
    """A name of a record that no other row has: by page, payload, URL and, of equal rows, number."""
    return ID.format("" if page_id is None else page_id, digest, "-" if url is None else hashlib.sha1(url.encode()).hexdigest(), nth, kind)


def _capture(page_id, nth: int, url: str | None, html: str, size: int, digest: str, first) -> str:
    """The three records of a page; ``first``: the page and URL of the response, if this row revisits it."""
    uri = re.sub(r"[\r\n]", " ", url or "")
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    ids = {k: _id(page_id, url, digest, nth, k) for k in ("request", "response", "metadata")}
    host = re.search(r"://([^/?#]*)", uri)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    same = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{sha1}")]
    of = ("WARC-Concurrent-To", ids["response"])
    if first is not None:
        to = _id(first["page_id"], first["url"], digest, 0, "response")
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        answer = _record("revisit", ids["response"], http, *same, ("WARC-Profile", profile), ("WARC-Refers-To", to), ("Content-Type", "application/http; msgtype=response"))
    else:
        answer = _record("response", ids["response"], http + html, *same, ("Content-Type", "application/http; msgtype=response"))
    asked = f"GET {uri} HTTP/1.1\r\nHost: {host[1] if host else ''}\r\n\r\n"
    request = _record("request", ids["request"], asked, ("WARC-Target-URI", uri), of, ("Content-Type", "application/http; msgtype=request"))
    note = _record("metadata", ids["metadata"], f"payload-length: {size}\r\n", ("WARC-Target-URI", uri), of, ("Content-Type", "application/warc-fields"))
    return "\r\n\r\n".join((request, answer, note))


def _captures(batches):
    """Captures, joined to rows of about ``ROW_BYTES``."""
    row = lambda parts: pa.RecordBatch.from_arrays([pa.array(["\r\n\r\n".join(parts)], pa.string())], names=["value"])
    parts, held = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            p, n, u, h, s, d, f = (batch.column(c)[i].as_py() for c in ("page_id", "nth", "url", "html", "size", "digest", "first"))
            parts.append(_capture(p, n, u, h or "", s, d, f))
            held += len(parts[-1])
            if held >= ROW_BYTES:
                yield row(parts)
                parts, held = [], 0
    if parts:
        yield row(parts)


def _repeated(rows: DataFrame, n: str, first: int) -> DataFrame:
    """``rows`` as often as ``n`` says, numbered ``nth`` from ``first``; many repetitions of a row are dealt out."""
    parts = rows.where(F.col(n) > 0).withColumn("__part", F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / REPEATED))))
    parts = parts.repartition(F.hash(*[F.col(c) for c in parts.columns if c != "html"]))
    within = F.sequence(F.col("__part") * REPEATED + first, F.least(F.col(n), (F.col("__part") + 1) * REPEATED) - 1 + first)
    return parts.withColumn("nth", F.explode(within)).drop("__part", n)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Archives of ``pages`` (page_id, url, html) under ``path``; payloads of fewer bytes are never revisited."""
    html = F.coalesce("html", F.lit(""))
    named = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    large, small = named.where(F.col("size") >= least_bytes), named.where(F.col("size") < least_bytes)
    who = F.max(F.struct("page_id", "url")).alias("first")
    columns = ["page_id", "nth", "url", "html", "size", "digest", "first"]
    none = F.lit(None).cast(T.StructType([named.schema["page_id"], named.schema["url"]]))
    answers = large.groupBy("digest").agg(who, F.first("html").alias("html"), F.first("size").alias("size"))
    answers = answers.withColumns({"page_id": F.col("first.page_id"), "url": F.col("first.url"), "nth": F.lit(0)}).withColumn("first", none)
    # rows are counted before they are dealt out, whatever a payload's or a page's number of copies
    counted = stage(large.groupBy("page_id", "url", "digest", "size").agg(F.count("*").alias("n")), "payloads")
    copied = counted.groupBy("digest").agg(who, F.sum("n").alias("all")).where("all > 1").drop("all")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    again = salted_join(counted, copied, ["digest"], "inner", SALTS).withColumn("n", F.col("n") - is_first.cast("int"))
    again = _repeated(again, "n", 1).withColumn("html", F.lit(None).cast("string"))
    alone = _repeated(small.groupBy("page_id", "url", "html", "digest", "size").agg(F.count("*").alias("n")), "n", 0).withColumn("first", none)
    rows = answers.select(columns).unionByName(again.select(columns))
    rows = rows.unionByName(alone.select(columns)) if least_bytes > 0 else rows
    rows.mapInArrow(released(_captures), "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", ROWS_A_FILE).text(path)
    discard(counted)


def unpacked(data):
    """The content of a file in parts; the file is gzip-packed, whole or record by record, or not at all."""
    data, at = memoryview(data).cast("B"), 0
    while at < len(data):
        if data[at : at + 2] != b"\x1f\x8b":
            yield bytes(data[at:])
            return
        z, rest = zlib.decompressobj(31), b""
        while not z.eof:
            if not rest:
                rest = bytes(data[at : at + UNPACKED])
                at += len(rest)
                if not rest:  # cut off: what there is has been given
                    return
            yield z.decompress(rest, UNPACKED)
            rest = z.unconsumed_tail
        at -= len(z.unused_data)


def parse(parts):
    """(headers, block) of each record of a content in bytes or in parts; names in lower case, a list of values for each. One record and one part are held."""
    parts = iter([parts] if isinstance(parts, bytes) else parts)
    held, at, gone = bytearray(), 0, 0

    def more() -> bool:
        nonlocal held, at, gone
        part = next(parts, None)
        if part is not None:
            del held[:at]
            gone, at = gone + at, 0
            held += part
        return part is not None

    while True:
        while at < len(held) and held[at] in b" \t\r\n\x0b\x0c":
            at += 1
        if at == len(held):
            if not more():
                return
            continue
        seen = 0
        while (end := held.find(b"\r\n\r\n", at + max(0, seen - 3))) < 0:
            seen = len(held) - at
            if seen >= 7 and held[at : at + 7] != b"WARC/1." or not more():
                raise ValueError(f"no record at {gone + at}")
        first, *lines = bytes(held[at:end]).split(b"\r\n")
        if first not in (b"WARC/1.0", b"WARC/1.1"):
            raise ValueError(f"no record at {gone + at}")
        headers: dict[str, list[str]] = {}
        for line in lines:
            name, _, value = line.partition(b":")
            headers.setdefault(name.strip().lower().decode("utf-8", "replace"), []).append(value.strip().decode("utf-8", "replace"))
        size = int(headers.get("content-length", ["-1"])[0])
        begin = end + 4 - at
        while size >= 0 and len(held) - at < begin + size and more():
            pass
        if size < 0 or len(held) - at < begin + size:
            raise ValueError(f"the record at {gone + at} is cut off")
        yield headers, bytes(held[at + begin : at + begin + size])
        at += begin + size


RECORD = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("type", "record_id", "refers_to", "target_uri", "date", "http_head", "payload_digest", "error")]
    + [T.StructField("concurrent_to", T.ArrayType(T.StringType())), T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType())]
)


def _row(headers: dict, block: bytes, with_payload: bool) -> dict:
    h = {k: v[0] for k, v in headers.items()}
    kind = h.get("warc-type")
    out = {"type": kind, "record_id": h.get("warc-record-id"), "concurrent_to": headers.get("warc-concurrent-to", []), "refers_to": h.get("warc-refers-to"), "target_uri": h.get("warc-target-uri"), "date": h.get("warc-date")}
    if not out["record_id"]:
        out["error"] = "no record id"
    head, payload = b"", block
    if kind in ("request", "response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
    out["http_head"] = head.decode("utf-8", "replace")
    said = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response":
        out["payload_bytes"], out["payload_digest"] = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if said not in (None, out["payload_digest"]):
            out["error"] = "the payload does not match its digest"
    elif kind == "revisit":
        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", b"\r\n" + head)
        out["payload_bytes"], out["payload_digest"] = int(length[1]) if length else None, said
    else:
        out["payload_bytes"] = len(payload)
    out["payload"] = payload if with_payload and kind != "revisit" else None
    return out


def _records(with_payload: bool):
    def run(batches):
        schema = to_arrow_schema(RECORD)
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                held = 0
                try:
                    for headers, block in parse(unpacked(content.as_buffer())):
                        rows.append(_row(headers, block, with_payload))
                        held += len(block) if with_payload else 0
                        if len(rows) == 2000 or held > 16_000_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                except (ValueError, zlib.error) as e:  # what was read before stays
                    rows.append({"error": str(e)})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return released(run)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; ``error`` tells those that are not to be used."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path)
    return files.select("content").mapInArrow(_records(with_payload), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``answer`` (response or revisit; null if only others are known) and arrays ``requests``, ``metadata``
    and ``others``, each in the order of record ids.

    A record belongs to the answer that a concurrent-to identifier links it with, whichever of the two names the
    other, else to one that is linked with a record it is linked with; the smallest id counts. A record without an answer
    is in the capture of the smallest id among its own and those that it is linked with.
    """
    sound = records.where("error is null")
    known = stage(sound.select("record_id", F.col("type").isin("response", "revisit").alias("answers"), F.coalesce("concurrent_to", F.array()).alias("to")), "records")
    named = known.select(F.col("record_id").alias("a"), F.explode("to").alias("b")).where("a <> b")
    links = named.unionByName(named.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    answers = known.where("answers").select(F.col("record_id").alias("b")).distinct()
    near = links.join(answers, "b").groupBy("a").agg(F.min("b").alias("capture"))
    far = links.join(near.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("capture").alias("capture"))
    label = answers.select(F.col("b").alias("record_id"), F.lit(0).alias("hops"), F.col("b").alias("capture"))
    for hops, found in ((1, near), (2, far), (3, links.groupBy("a").agg(F.min(F.least("a", "b")).alias("capture")))):
        label = label.unionByName(found.select(F.col("a").alias("record_id"), F.lit(hops).alias("hops"), "capture"))
    label = label.groupBy("record_id").agg(F.min(F.struct("hops", "capture"))["capture"].alias("capture"))
    one = F.struct("record_id", *(c for c in RECORD.fieldNames() if c not in ("record_id", "error")))
    kind = F.col("type")
    part = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("one"))))
    all_of = sound.join(label, "record_id", "left").select(F.coalesce("capture", "record_id").alias("capture"), "type", one.alias("one"))
    answer, asked, noted = kind.isin("response", "revisit"), kind == "request", kind == "metadata"
    return all_of.groupBy("capture").agg(F.min(F.when(answer, F.col("one"))).alias("answer"), part(asked).alias("requests"), part(noted).alias("metadata"), part(~F.coalesce(answer | asked | noted, F.lit(False))).alias("others"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    # files are unpacked and parsed once
    records = stage(read_records(spark, path, with_payload=False), "records")
    captures = assemble(records).where("answer is not null")
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:capture:(-?\d*):", 1), F.lit("")).cast("long")
    return captures.select(
        page(F.col("answer.record_id")).alias("page_id"),
        F.col("answer.payload_bytes").alias("payload_bytes"),
        F.col("answer.payload_digest").alias("payload_digest"),
        F.col("answer.type").alias("record_type"),
        page(F.col("answer.refers_to")).alias("refers_to"),
        F.col("answer.target_uri").alias("url"),
        (F.size("requests") > 0).alias("has_request"),
        (F.size("metadata") > 0).alias("has_metadata"),
    )
