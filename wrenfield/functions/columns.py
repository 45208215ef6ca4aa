"""Column functions of the jobs: names, URLs, dates, costs, places and texts.

All are native expressions but two, which need Unicode tables that Spark SQL has not: ``normalise_name`` (NFKD, for
values with non-ASCII characters only) and ``decode_entities``.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Typographic characters and what they become.
CURLY = {"‘": "'", "’": "'", "“": '"', "”": '"', "—": "-", "–": "-", "\u202f": " "}
DROPPED = "\u200b\u034f\ufeff"
# Words that carry no meaning in titles.
STOP_WORDS = ["a", "an", "at", "by", "for", "in", "is", "it", "of", "on", "or", "the", "to", "and", "but", "its", "our", "we", "you", "via", "with"]
# Hosts and words of tracking links.
TRACKING_HOSTS = ["mailchimp.com", "list-manage.com", "sendgrid.net", "mailgun.org", "click.mailerlite.com", "track.customer.io", "email.mg."]
TRACKING_WORDS = ["unsubscribe", "tracking", "click", "redirect", "optout", "preferences"]
# Texts that stand for no place, and the form of postcodes.
PLACEHOLDERS = ["", "unknown", "tbc", "tba", "n/a", "none", "online", "various"]
POSTCODE = r"\b[A-Za-z]{1,2}\d{1,2}[A-Za-z]?\s*\d[A-Za-z]{2}\b"
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def blank(c: Column) -> Column:
    """Null or nothing but white space."""
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def or_null(c: Column) -> Column:
    """Null for an empty string."""
    return F.nullif(c, F.lit(""))


def any_of(words: list[str], whole: bool = True) -> str:
    """A pattern of any of ``words``, as whole words; Unicode letters count as word characters."""
    import re

    inner = "|".join(re.escape(w.strip().lower()) for w in words)
    return rf"(?iU)\b(?:{inner})\b" if whole else rf"(?i)(?:{inner})"


@F.pandas_udf(T.StringType())
def _nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def normalise_name(c: Column) -> Column:
    text = F.coalesce(c, F.lit(""))
    ascii_only = ~text.rlike(r"[^\x00-\x7F]")
    wide = F.when(~ascii_only, text)
    wide = F.translate(_nfkd(wide), "".join(CURLY) + DROPPED, "".join(CURLY.values()))
    return squeezed(F.lower(F.when(ascii_only, text).otherwise(wide)))


def normalise_ascii(c: Column) -> Column:
    """``normalise_name`` of values that are known to be ASCII, without leaving the JVM."""
    return squeezed(F.lower(F.coalesce(c, F.lit(""))))


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


@F.pandas_udf(T.StringType())
def _entities(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


def decode_entities(c: Column) -> Column:
    return F.when(c.contains("&"), _entities(F.when(c.contains("&"), c))).otherwise(c)


def canonical_url(url: Column, alias: str = "https://luma.com/", host: str = "https://lu.ma/") -> Column:
    """One host for its alias, without a query; other URLs stay."""
    own = F.when(url.startswith(alias), F.concat(F.lit(host), F.substring(url, F.lit(len(alias) + 1), F.length(url)))).otherwise(url)
    return F.when(own.startswith(host), F.split_part(own, F.lit("?"), F.lit(1))).otherwise(own)


def url_key(url: Column) -> Column:
    """The event's slug or number in its URL, or null."""
    slug = or_null(F.regexp_extract(canonical_url(url), r"^https://lu\.ma/([^/]+)$", 1))
    return F.coalesce(slug, or_null(F.regexp_extract(url, r"/events/(\d+)", 1)))


def url_host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(F.regexp_extract(url, r"://([^/?#:]*)", 1), F.lit(""))), r"^www\.", "")


def is_homepage(url: Column) -> Column:
    return F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1).isin("", "/")


def is_tracking(url: Column) -> Column:
    low = F.lower(url)
    return low.rlike("|".join(h.replace(".", r"\.") for h in TRACKING_HOSTS)) | F.split_part(low, F.lit("?"), F.lit(1)).rlike("|".join(TRACKING_WORDS))


def local_time(iso: Column, zone: str) -> Column:
    """An ISO instant as local wall time (a naive one is local already); null if it is none."""
    padded = F.regexp_replace(iso, r"(T\d{2}:\d{2})($|[Zz+-])", "$1:00$2")
    has_zone = iso.rlike(r"T.*(?:[Zz]|[+-]\d{2}:?\d{2})$")
    there = F.from_utc_timestamp(F.to_utc_timestamp(F.try_to_timestamp(padded), F.current_timezone()), zone)
    return F.when(has_zone, there.cast("timestamp_ntz")).otherwise(padded.try_cast("timestamp_ntz"))


def local_datetime(iso: Column, zone: str) -> tuple[Column, Column]:
    at = local_time(iso, zone)
    return F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit("")), F.coalesce(F.date_format(at, "HH:mm"), F.lit(""))


def end_date_if_different(start: Column, end: Column) -> Column:
    return or_null(F.nullif(end, start))


def parse_cost(c: Column) -> Column:
    low = F.lower(F.trim(c))
    number = F.regexp_extract(low, r"£?\s*(\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?)", 1)
    return F.when(low.contains("free"), 0.0).when(low.isin("unknown", "tbc", "tba", ""), None).otherwise(F.replace(number, F.lit(","), F.lit("")).try_cast("double"))


def parse_hour(time: Column) -> Column:
    return or_null(F.regexp_extract(time, r"^(\d{1,2}):\d{2}", 1)).try_cast("int")


def time_bucket(time: Column) -> Column:
    hour = F.regexp_extract(F.trim(time), r"^(\d{1,2}):\d{2}$", 1).try_cast("int")
    return F.when(blank(time), "Not extracted").when(F.upper(F.trim(time)) == "TBC", "TBC").when(hour.isNull(), "Not extracted").when(hour < 12, "Morning").when(hour < 17, "Afternoon").otherwise("Evening")


def time_display(time: Column) -> Column:
    bucket = time_bucket(time)
    return F.when(bucket.isin("TBC", "Not extracted"), bucket).otherwise(F.trim(time))


def date_labels(date: Column) -> tuple[Column, Column, Column]:
    """``30 Apr``, ``Sun 19 April`` and ``April``."""
    d = date.try_cast("date")
    return F.date_format(d, "d MMM"), F.date_format(d, "E d MMMM"), F.date_format(d, "MMMM")


def date_property(date: Column, end: Column, time: Column, zone: str) -> Column:
    """struct(start, end): with a clock time and offset only if there is one and no end date."""
    timed = time.rlike(r"^\d{2}:\d{2}$") & blank(end)
    wall = F.concat(date, F.lit(" "), time, F.lit(":00")).try_cast("timestamp_ntz")
    utc = F.to_utc_timestamp(wall.cast("timestamp"), zone)
    minutes = ((F.unix_timestamp(wall.cast("timestamp")) - F.unix_timestamp(utc)) / 60).cast("int")
    offset = F.format_string("%s%02d:%02d", F.when(minutes < 0, "-").otherwise("+"), F.abs(minutes / 60).cast("int"), F.abs(minutes % 60).cast("int"))
    start = F.when(timed & wall.isNotNull(), F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), offset)).otherwise(date)
    return F.struct(start.alias("start"), or_null(end).alias("end"))


def truncate_utf16(c: Column, units: int) -> Column:
    """At most ``units`` UTF-16 units, the last an ellipsis if something was cut; no half pair is left."""
    raw = F.encode(c, "UTF-16LE")
    keep = units - 1
    last = F.conv(F.hex(F.substring(raw, 2 * keep, 1)), 16, 10).cast("int")  # high byte of the last kept unit
    whole = F.when((last >= 0xD8) & (last <= 0xDB), F.lit(2 * keep - 2)).otherwise(F.lit(2 * keep))
    cut = F.concat(F.decode(F.substring(raw, F.lit(1), whole), "UTF-16LE"), F.lit("…"))
    return F.when(F.octet_length(raw) > 2 * units, cut).otherwise(c)


def normalise_venue(c: Column, city: str, suffix: str) -> Column:
    parts = {suffix.lower(), city.lower(), *(p.strip().lower() for p in suffix.split(","))}
    tails = "|".join([f", {p}" for p in sorted(parts, key=len, reverse=True)] + [f" {city.lower()}"])
    bare = F.regexp_replace(normalise_name(c), rf"(?:(?:{tails})[,\s]*)+$", "")
    return squeezed(F.regexp_replace(bare, r"\b[a-z]{1,2}\d{1,2}\s*\d[a-z]{2}\b", ""))


def venue_short(c: Column) -> Column:
    return F.lower(F.trim(F.split_part(F.coalesce(c, F.lit("")), F.lit(","), F.lit(1))))


def title_stem(c: Column) -> Column:
    """A series' key: without counters, dates and what stands in brackets."""
    s = F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"(?s)[#(].*$", "")
    s = F.regexp_replace(F.regexp_replace(s, r"\b\d[\d:/.-]*\b", ""), r"\s+", " ")
    return F.regexp_replace(s, r"^[ \-–—:|]+|[ \-–—:|]+$", "")


def words(c: Column) -> Column:
    """Runs of letters, digits and underscores; a combining mark is none of them."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))


def title_words(c: Column) -> Column:
    """Meaningful words of a normalised title."""
    return F.array_distinct(F.filter(F.split(c, " "), lambda w: (F.length(w) > 1) & ~w.isin(STOP_WORDS)))


def overlap(a: Column, b: Column) -> Column:
    """Shared words over the smaller set; 0 if one is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(0.0)


def venue_address(name: Column, postcode: Column, description: Column, suffix: str) -> Column:
    named, code = F.trim(F.coalesce(name, F.lit(""))), F.trim(F.coalesce(postcode, F.lit("")))
    named = F.when(~F.lower(named).isin(PLACEHOLDERS), named)
    code = F.when(~F.lower(code).isin(PLACEHOLDERS) & (F.lower(code) != F.lower(F.coalesce(named, F.lit("")))), code)
    known = F.concat_ws(" ", named, code)
    found = F.when(~known.rlike(POSTCODE), F.upper(or_null(F.regexp_extract(F.coalesce(description, F.lit("")), POSTCODE, 0))))
    parts = F.concat_ws(", ", named, code, found)
    return F.when(parts != "", F.concat(parts, F.lit(f", {suffix}")))


def minutes_from_duration(c: Column) -> Column:
    seconds = F.regexp_extract(c, r"^(\d+(?:\.\d+)?)s$", 1).try_cast("double")
    return F.greatest(F.lit(1), F.bround(seconds / 60).cast("int")) + F.lit(0) * seconds.cast("int")


def travel_display(transit: Column, cycle: Column, walk: Column, cycle_most: int, walk_most: int) -> Column:
    part = lambda m, how: F.when(m.isNotNull(), F.concat(m.cast("string"), F.lit(f" min ({how})")))
    shown = F.concat_ws(" · ", part(transit, "transit"), F.when(cycle <= cycle_most, part(cycle, "cycle")), F.when(walk <= walk_most, part(walk, "walk")))
    return or_null(shown)


def travel_label(display: Column, venue: Column) -> Column:
    unknown = F.lower(F.trim(F.coalesce(venue, F.lit("")))).isin("", "unknown", "tbc", "tba", "n/a")
    return F.when(~blank(display), F.trim(F.split_part(display, F.lit("·"), F.lit(1)))).when(unknown, "Venue unknown").otherwise("Route unavailable")


def date_variants(date: Column) -> Column:
    """All spellings of a date that a text may use."""
    d = date.try_cast("date")
    n = F.dayofmonth(d)
    ordinal = F.concat(n.cast("string"), F.when(n.isin(11, 12, 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th"))
    day, month, short = n.cast("string"), F.date_format(d, "MMMM"), F.date_format(d, "MMM")
    pairs = [(x, m) for x in (day, ordinal) for m in (month, short)]
    texts = [F.concat(x, F.lit(" "), m) for x, m in pairs] + [F.concat(m, F.lit(" "), x) for x, m in pairs]
    return F.array_distinct(F.array(F.date_format(d, "yyyy-MM-dd"), *texts, F.date_format(d, "dd/MM"), F.date_format(d, "d/M")))


# Endings of files, and words that a number belongs to, with the form of the number.
FILE_ENDINGS = ("py", "sh", "yml", "json", "md")
NUMBERED = {("line",): r"\d+", ("exit", "code"): r"\d+", ("HTTP",): r"\d{3}"}


def strip_jargon(c: Column) -> Column:
    """``c`` without what a reader of reports cannot use, word by word: files, constants, and places, exits and statuses with their numbers. Blanks become one, and
    nothing is left at the ends of what semicolons part."""
    said = F.split(F.replace(c, F.lit(";"), F.lit(" ; ")), r"\s+")
    word = lambda i: F.coalesce(F.try_element_at(said, i + 1), F.lit(""))

    def mention(i: Column, words: tuple[str, ...], number: str) -> Column:
        """Whether these words and a number begin at word ``i``."""
        same = [word(i + k) == w if w.isupper() else F.lower(word(i + k)) == w for k, w in enumerate(words)]
        hit = word(i + len(words)).rlike(f"^{number}$")
        for cond in same:
            hit = hit & cond
        return (i >= 0) & hit

    def technical(w: Column, i: Column) -> Column:
        out = (F.instr(w, ".") > 1) & F.substring_index(w, ".", -1).isin(*FILE_ENDINGS)
        out = out | (w.rlike("^[A-Z_]{4,}$") & w.contains("_"))
        for words, number in NUMBERED.items():
            for k in range(len(words) + 1):
                out = out | F.when(i >= k, mention(i - k, words, number)).otherwise(F.lit(False))
        return out

    left = F.array_join(F.filter(said, lambda w, i: ~technical(w, i)), " ")
    return F.btrim(F.regexp_replace(left, " *; *", "; "), F.lit(" ;"))


def text_blob(*columns: Column) -> Column:
    return F.lower(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in columns)))


def content_hash(columns: dict[str, Column]) -> Column:
    return F.substring(F.sha2(F.to_json(F.struct(*(columns[k].alias(k) for k in sorted(columns))), {"ignoreNullFields": "false"}), 256), 1, 16)


def description_or_tbc(c: Column) -> Column:
    return F.when(blank(c), "TBC").otherwise(c)


def source_label(c: Column) -> Column:
    return F.when(c.isin("Meetup", "Luma", "Newsletter", "Venue", "manual"), c).otherwise("Newsletter")


def past_connection(signals: Column, venue: Column, organiser: Column) -> Column:
    """What the fired signals say of earlier visits; the venue's text is told before the organiser's signal."""
    at = F.concat(F.lit("The user has been to events at "), F.coalesce(or_null(venue), F.lit("this venue")), F.lit(" before"))
    by = F.concat(F.lit("The user has been to events by "), F.coalesce(or_null(organiser), F.lit("this organiser")), F.lit(" before"))
    said = F.transform(signals, lambda s: F.when(s.contains("Signal #31"), "The user has attended this event series before").when(s.contains("Known venue-as-organiser"), at).when(s.contains("Signal #32"), by))
    return or_null(F.array_join(F.array_compact(said), "; "))
