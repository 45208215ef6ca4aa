"""Main text of web pages from host-wide consensus on where it stands.

1. Each page's containers (articles, sections, divisions, cells) are scored by the text they hold outside
   links and boilerplate; the best one votes for its *generalised path*: the tags and
   classes from the page's root down, digits as ``0``.
2. Spark adds up the votes per host and path and takes each host's winner. It also counts, per host and path, how many different texts the containers inside
   the article have, and how many different texts stand around them: a container that says the same within ever other articles is
   boilerplate of that host, whatever it is called.
3. Each page is read again: the text of its containers on its host's winning path without such boilerplate, or, where it has none of that path, of
   its own best container (the body if nothing scores).

Left out are menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments, told by
tag, role or state. The words of class and id are a hint only: a container with such a word is left out of articles around it, but where
it holds nearly all text of its page it may be voted for, and wins if most pages of the host say so and it doesn't repeat itself over pages that differ.
Character references are decoded, white space in a block becomes one
space, and blocks are joined by one space.

A host may have a third of all pages: votes combine before the exchange. Winners (a row per host) are broadcast if their
bytes are within ``BROADCAST_BYTES``, so that no page is shuffled. Beyond that only the winners of hot hosts are, of which
there are at most 1 / ``HOT_SHARE``; pages of other hosts, each with fewer pages than that, are joined by shuffle.
Nulls: a null html is empty; a null url has no host, and such pages go by their own best container. Repeated rows
each get their row. Empty tables give empty results. A very long page is read whole, as a step of its own. Further
columns pass unchanged under any name; an input column ``text`` is replaced.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import released, salted_join, shielded, stage, steps

#: Bytes of hosts and paths that are broadcast at most.
BROADCAST_BYTES = 64_000_000
#: Share of the pages above which a host is hot.
HOT_SHARE = 0.001

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|math|iframe|object|select|button|canvas|audio|video)\b.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>"
    r"|<[!?/a-zA-Z][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div td table blockquote center".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside caption dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr li menu nav ol option p pre summary tbody tfoot th thead tr ul".split()
)
#: Elements whose text is never part of the article; a header is, inside an article.
SKIPPED = frozenset("head nav aside footer form menu dialog label fieldset".split())
#: Words of class and id that hint at boilerplate.
SKIPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer form gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended related replies reply respond "
    "search share sharing sidebar signup skyscraper social sponsor sponsored subscribe subscription toolbar widget alert aside discussion hidden".split()
)
#: A container hinted at is voted for if it has so many characters, and so many times those that are left without it.
HINTED_CHARS, HINTED_TIMES = 200, 2
#: A text is boilerplate if so many different ones stand around it, and so many times its own number.
AROUND, AROUND_TIMES = 6, 4
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Opening one of these ends an open one of its set, as far up as the nearest container.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
ENDS |= {t: {"p"} for t in BLOCKS - set(ENDS)}
_CUT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


class Page:
    """Blocks of text in page order and the containers they stand in."""

    def __init__(self, html: str):
        self.paths = [""]  # of each container
        self.parents = [0]
        self.articles = [False]
        self.hinted = [0]  # how many containers around, and it itself, have a word that hints at boilerplate
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self._read(html)

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, bool]] = []  # tag, container, skipped
        container, skipped, links = 0, False, 0
        parts: list[str] = []
        linked = 0

        def flush():
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.blocks.append((container, text, linked))
                parts.clear()
            linked = 0

        at = 0
        for m in _MARKUP.finditer(html):
            if m.start() > at and not skipped:
                text = entities.unescape(html[at : m.start()]) if "&" in html[at : m.start()] else html[at : m.start()]
                parts.append(text)
                if links:
                    linked += len(text.strip())
            at = m.end()
            tag = m[3] or m[6]
            if not tag:
                continue
            tag, closing, rest = tag.lower(), bool(m[2] or m[5]), (m[4] if m[3] else m[7]) or ""
            block = tag in BLOCKS
            if block:
                flush()
            if tag == "br":
                parts.append(" ")
            if tag in VOID:
                continue
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        # an inline end tag doesn't close blocks around it
                        if not block and any(t in BLOCKS for t, _, _ in stack[i + 1 :]):
                            del stack[i]
                        else:
                            del stack[i:]
                        break
                    if not block and stack[i][0] in CONTAINERS:
                        break
            else:
                if block:
                    ends = ENDS[tag]
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] in ends:
                            del stack[i:]
                            break
                        if stack[i][0] in CONTAINERS or stack[i][0] in ("ul", "ol", "dl"):
                            break
                up, off = (stack[-1][1], stack[-1][2]) if stack else (0, False)
                if block:
                    name, boiler, hint = self._element(tag, rest, up)
                    off = off or boiler or hint and tag not in CONTAINERS
                    if tag in CONTAINERS:
                        self.parents.append(up)
                        self.hinted.append(self.hinted[up] + hint)
                        self.paths.append(f"{self.paths[up]}>{name}")
                        self.articles.append(tag in ("article", "main"))
                        up = len(self.paths) - 1
                elif "hidden" in rest or "none" in rest:
                    off = off or self._element(tag, rest, up)[1]
                stack.append((tag, up, off))
            container, skipped = (stack[-1][1], stack[-1][2]) if stack else (0, False)
            if tag == "a":
                links = sum(t == "a" for t, _, _ in stack)
        if at < len(html) and not skipped:
            parts.append(entities.unescape(html[at:]))
        flush()

    def _element(self, tag: str, rest: str, up: int) -> tuple[str, bool, bool]:
        """(generalised name, whether it is boilerplate, whether its words hint at that)."""
        if not rest:
            return tag, tag in SKIPPED or tag == "header" and not self._inside(up), False
        attributes = {}
        for m in _ATTRIBUTE.finditer(rest):
            attributes.setdefault((m[1] or m[5]).lower(), m[2] or m[3] or m[4] or "")
        classes = re.sub(r"[0-9]+", "0", attributes.get("class", "")).lower().split()
        words = {w for c in (attributes.get("class", ""), attributes.get("id", "")) for w in _CUT.split(c.lower()) + c.lower().split()}
        boiler = tag in SKIPPED or tag == "header" and not self._inside(up) or "hidden" in attributes or "none" in attributes.get("style", "").replace(" ", "").partition("display:")[2][:4]
        boiler = boiler or attributes.get("role", "") in SKIPPED_ROLES or attributes.get("aria-hidden") == "true"
        return ".".join([tag, *sorted(set(classes))]), bool(boiler), tag not in ("html", "body", "article", "main") and bool(words & SKIPPED_WORDS)

    def _inside(self, c: int) -> bool:
        while c:
            if self.articles[c]:
                return True
            c = self.parents[c]
        return False

    def scores(self) -> dict[int, float]:
        """Of each container: its own text outside links, and half of that of the containers within, as far as these aren't hinted at."""
        out: dict[int, float] = {}
        for c, text, linked in self.blocks:
            points = float(max(0, len(text) - 2 * linked))
            while points >= 1:
                out[c] = out.get(c, 0) + points
                if not c or self.hinted[self.parents[c]] != self.hinted[c]:
                    break
                c, points = self.parents[c], points / 2
        return out

    def best(self, hinted: bool = False) -> int:
        """The container with the most text, or the article around it; with ``hinted`` one that is hinted at, if it leaves little without it."""
        scores = self.scores()
        plain = {c: n for c, n in scores.items() if not self.hinted[c]}
        enough = max(HINTED_CHARS, HINTED_TIMES * sum(max(0, len(t) - 2 * k) for c, t, k in self.blocks if not self.hinted[c])) if hinted else 0
        for level in sorted({self.hinted[c] for c in scores} - {0}) if hinted else ():
            others = {c: n for c, n in scores.items() if self.hinted[c] == level}
            if max(others.values()) > enough:  # what is hinted at within is left out of it in turn
                plain = others
                break
        if not plain:
            return 0
        top = max(plain, key=lambda c: (plain[c], -c))
        c = found = top
        while c and self.hinted[c] == self.hinted[top]:
            if self.articles[c]:
                found = c
            c = self.parents[c]
        return found

    def _within(self, picked: set[int], drops=()) -> list[bool]:
        """Of each container: whether its text counts as that of the picked ones."""
        inside, level = [False] * len(self.paths), [0] * len(self.paths)
        for c in range(len(self.paths)):
            if c in picked:
                inside[c], level[c] = True, self.hinted[c]
            elif c and inside[self.parents[c]]:
                level[c] = level[self.parents[c]]
                inside[c] = self.hinted[c] == level[c] and self.paths[c] not in drops
        return inside

    def text(self, path: str | None, drops=()) -> str:
        picked = {c for c, p in enumerate(self.paths) if p == path} if path else set()
        inside = self._within(picked or {self.best()}, drops)
        return " ".join(t for c, t, _ in self.blocks if inside[c])

    def votes(self):
        """(path, whether it is voted for, hash of its text, hash of the text around it): the best container, with the rest of the page, and the
        containers within, if they have at most half of its text, with the rest of it. A hash is the sum of the blocks' hashes."""
        if not self.blocks:
            return
        best = self.best(hinted=True)
        inside = self._within({best})
        own, length, rest = [0] * len(self.paths), [0] * len(self.paths), 0
        for c, text, _ in self.blocks:
            if inside[c]:
                own[c] += _hash(text)
                length[c] += len(text)
            elif not self.hinted[c]:
                rest += _hash(text)
        for c in range(len(own) - 1, best, -1):  # a container comes after those around it
            if inside[c]:
                own[self.parents[c]] += own[c]
                length[self.parents[c]] += length[c]
        yield self.paths[best], True, _signed(own[best]), _signed(rest)
        for c in range(best + 1, len(own)):
            if inside[c] and 0 < 2 * length[c] <= length[best]:
                yield self.paths[c], False, _signed(own[c]), _signed(own[best] - own[c])


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")


def _signed(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def _slices(batch: pa.RecordBatch):
    """Parts of a batch by the bytes of its pages."""
    sizes = pc.fill_null(pc.binary_length(batch.column("html")), 0).to_numpy(zero_copy_only=False)
    for i, j in steps(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))):
        yield batch.slice(i, j - i)


def _votes(batches):
    for batch in batches:
        for part in _slices(batch):
            rows = []
            for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                if host and html:
                    page = Page(html)
                    rows += [(host, path, voted, bool(voted and page.hinted[page.paths.index(path)]), own, around) for path, voted, own, around in page.votes()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, _VOTE)], names=["host", "path", "voted", "hinted", "own", "around"])


_VOTE = [pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]


def _extract(schema: T.StructType, keep: list[str]):
    def run(batches):
        for batch in batches:
            for part in _slices(batch):
                texts = [Page(h or "").text(p, frozenset(d or ())) for h, p, d in zip(*(part.column(c).to_pylist() for c in ("html", "path", "drops")))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.string())], schema=to_arrow_schema(schema))

    return released(run)


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes, pages, drops): the winning path of each host of ``pages`` (host, html), how many pages voted, and the paths of boilerplate inside."""
    votes = pages.select("host", "html").mapInArrow(released(_votes), "host string, path string, voted boolean, hinted boolean, own long, around long")
    counted = votes.groupBy("host", "path", "voted", "hinted").agg(F.count("*").alias("votes"), F.approx_count_distinct("own", 0.02).alias("own"), F.approx_count_distinct("around", 0.02).alias("around"))
    repeats = (F.col("around") >= AROUND) & (F.col("around") >= AROUND_TIMES * F.col("own"))
    said = F.when(F.col("voted") & ~(F.col("hinted") & repeats), F.struct("votes", "path"))
    tops = counted.groupBy("host").agg(F.max(said).alias("top"), F.sum(F.when(F.col("voted"), F.col("votes"))).alias("pages"), F.array_sort(F.collect_set(F.when(~F.col("voted") & repeats, F.col("path")))).alias("drops"))
    return tops.where("top is not null").select("host", "top.path", "top.votes", "pages", "drops")


def with_paths(pages: DataFrame, winners: DataFrame, most: int = BROADCAST_BYTES, share: float = HOT_SHARE) -> DataFrame:
    """``pages`` (host, ...) with the ``path`` and ``drops`` of their host, or null. ``winners`` as ``host_paths`` returns them."""
    size = F.octet_length("host") + F.octet_length("path") + F.octet_length(F.array_join("drops", " "))
    total, voted = winners.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.sum("pages"), F.lit(0))).first()
    paths = winners.select("host", "path", "drops")
    if total <= most:
        return pages.join(F.broadcast(paths), "host", "left")
    hot = winners.where((F.col("pages") > share * voted) & (size <= most * share)).select("host", "path", "drops")
    met = pages.join(F.broadcast(hot), "host", "left")
    settled = F.col("path").isNotNull() | (F.col("host") == "")
    return met.where(settled).unionByName(salted_join(met.where(~settled).drop("path", "drops"), paths, ["host"]))


def extract(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``pages`` (url, html, ...; default all but html) and ``text``."""
    kept = [c for c in pages.columns if c not in ("html", "text")] if keep is None else list(keep)
    columns = dict(zip(pages.columns, shielded(pages, "url", "html")[0].columns))
    pages, own = shielded(pages, "url", "html")[0], [columns[c] for c in kept]
    host = F.lower(F.regexp_extract("url", r"^.*?://([^/?#]*)", 1))
    # pages without a host match no winner
    named = pages.withColumn("host", F.coalesce(host, F.lit("")))
    joined = with_paths(named, stage(host_paths(named), "host-paths"))
    schema = T.StructType([pages.schema[c] for c in own] + [T.StructField("text", T.StringType())])
    return joined.select(*own, "html", "path", "drops").mapInArrow(_extract(schema, own), schema).toDF(*kept, "text")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
