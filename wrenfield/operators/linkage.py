"""Record linkage: exact and fuzzy duplicates, multi-day merges, calendar and board matches.

All joins are on keys. Fuzzy names meet on their rarest words, or where one is the beginning of the other; calendar rows
meet candidates on sets of words, and only where that finds nothing those of their venue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..settings import DEFAULT, Settings
from ..staging import staged


def keys(cand: DataFrame) -> DataFrame:
    """``cand`` with its two identities: canonical URL (null if empty), and normalised name with date."""
    return cand.withColumn("url_id", C.or_null(C.canonical_url(F.col("url")))).withColumn("name_id", C.normalise_name(F.col("name")))


def not_existing(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows that no existing row has by URL, or by name and date."""
    new, old = keys(incoming), keys(existing)
    urls = old.where("url_id is not null").select("url_id").distinct()
    names = old.select("name_id", "date").distinct()
    return new.join(urls, "url_id", "left_anti").join(names, ["name_id", "date"], "left_anti")


def _depends(left: DataFrame) -> DataFrame:
    """``left`` with ``root`` (the smallest id of both its groups) and ``to``: the one row whose fate decides its own, as it is
    the second of each group of which it isn't the first; null if more rows decide."""

    def firsts(of: DataFrame, columns: list[str], name: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*columns).orderBy("id"))  # Spark keeps two of a group on each side of the exchange
        two = of.select("id", *columns).withColumn("nth", nth).where("nth <= 2")
        return two.groupBy(*columns).agg(F.min("id").alias(f"{name}1"), F.max("id").alias(f"{name}2"))

    both = left.join(firsts(left.where("url_id is not null"), ["url_id"], "u"), "url_id", "left").join(firsts(left, ["name_id", "date"], "n"), ["name_id", "date"])
    i, u1, n1 = F.col("id"), F.coalesce("u1", "id"), F.col("n1")
    second = ((i == u1) | (i == F.col("u2"))) & ((i == n1) | (i == F.col("n2")))
    to = F.when(i == u1, n1).when((i == n1) | (u1 == n1), u1)
    return both.select("id", "url_id", "name_id", "date", ((i == u1) & (i == n1)).alias("root"), F.when(second & ~((i == u1) & (i == n1)), to).alias("to"))


def _followed(rows: DataFrame) -> DataFrame:
    """(id, to, odd): for rows that depend on one row, where the chain of such rows ends, and whether it has an odd number of links. Pointers are
    doubled, so a chain of n links takes log2(n) rounds."""
    at = staged(rows.where("to is not null").select("id", "to", F.lit(True).alias("odd")))
    while at.join(at.select(F.col("id").alias("to")), "to", "left_semi").limit(1).count():
        on = at.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("odd").alias("more"))
        at = staged(at.join(on, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.when(F.col("more"), ~F.col("odd")).otherwise(F.col("odd")).alias("odd")))
    return at


def greedy(new: DataFrame) -> DataFrame:
    """Rows (id, url_id, name_id, date) that no *kept* row of smaller id shares an identity with.

    In each round the smallest undecided row of both its groups is kept, and chains of rows of which each depends on one other are followed to such a
    row: every second row of a chain is kept. The rest of the groups of kept rows is dropped. The smallest undecided id is always decided, so rounds end; a
    chain of any length takes one round of as many joins as its length has binary digits.
    """
    left = staged(new.select("id", "url_id", "name_id", "date"))
    kept = None
    while left.limit(1).count():
        rows = staged(_depends(left))
        roots = rows.where("root").select("id")
        ends = _followed(rows).join(roots.withColumnRenamed("id", "to"), "to", "left_semi")
        ids = roots.unionByName(ends.where("not odd").select("id"))
        now = staged(left.join(ids, "id"))
        kept = now if kept is None else kept.unionByName(now)
        rest = left.join(now.where("url_id is not null").select("url_id").distinct(), "url_id", "left_anti")
        left = staged(rest.join(now.select("name_id", "date").distinct(), ["name_id", "date"], "left_anti").select("id", "url_id", "name_id", "date"))
    return (left if kept is None else kept).select("id")


def reschedule(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Stored rows whose URL came again with another date: new dates, and the state they fall back to."""
    old = keys(existing).where("url_id is not null").groupBy("url_id").agg(F.max_by(F.struct("id", "date", "pipeline_state", "notion_page_id"), "id").alias("old"))
    new = keys(incoming).groupBy("url_id").agg(F.max_by(F.struct("date", "end_date"), "id").alias("new"))
    found = new.join(old, "url_id").where("new.date <> old.date")
    back = F.col("old.pipeline_state").isin("expired", "llm_rejected", "vetoed") & F.col("old.notion_page_id").isNull()
    return found.select(F.col("old.id").alias("id"), F.col("new.date").alias("date"), F.col("new.end_date").alias("end_date"), F.when(back, "pending_llm").otherwise(F.col("old.pipeline_state")).alias("pipeline_state"))


#: Words of a name up to which names meet on pairs of words.
PAIRED = 16
_SHARE = 0.7


def _normalised(rows: DataFrame) -> DataFrame:
    """``rows`` (id, date, name, x, y) with normalised names; each distinct name is normalised once."""
    names = staged(rows.select("name").distinct().withColumn("norm", C.normalise_name(F.col("name"))))
    return staged(rows.join(names, "name").select("id", "date", "norm", "x", "y"))


def _ranked(looks: DataFrame) -> DataFrame:
    """``looks`` (look, date, norm, ...) with ``words``, the rarest of the date first."""
    word = looks.select("look", "date", F.explode(C.words(F.col("norm"))).alias("word"))
    counts = word.groupBy("date", "word").agg(F.count("*").alias("df"))
    ranked = word.join(counts, ["date", "word"]).groupBy("look").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "word"))), lambda w: w["word"]).alias("words"))
    return staged(looks.join(ranked, "look", "left"))


def _keys_of(words: Column, smaller: bool) -> Column:
    """Keys on which a name meets others: of the smaller of two sets that share enough, its rarest words have one of the larger one's words, and a few more have two of them."""
    n = F.size(words)
    least = F.ceil(_SHARE * n - 1e-9).cast("int")
    first = (lambda more: F.slice(words, F.lit(1), F.least(n, n - least + more))) if smaller else (lambda more: words)
    one = lambda kind: F.transform(first(1), lambda w: F.concat(F.lit(f"{kind} "), w))
    two = F.flatten(F.transform(first(2), lambda w, i: F.transform(F.slice(first(2), i + 2, n), lambda v: F.concat(F.lit("two "), F.least(w, v), F.lit(" "), F.greatest(w, v)))))
    none = F.array().cast("array<string>")
    if smaller:  # those of one word have no two, long ones would have too many
        return F.when(n == 1, F.concat(one("one"), one("long"))).when(n <= PAIRED, F.concat(two, one("long"))).when(n > PAIRED, one("long")).otherwise(none)
    return F.when((n > 0) & (n <= PAIRED), F.concat(two, one("one"))).when(n > PAIRED, one("long")).otherwise(none)


def _similar(looks: DataFrame) -> DataFrame:
    """(xs, ys, kind): ids of looks of which one begins the other, or whose words are mostly the same. Each pair of looks comes once: on the first of the keys that it
    has in common, in the order of the smaller one's words; so pairs are never gathered again."""
    size = F.size("words")
    row = lambda of: [F.col(f"{of}s"), F.col(f"{of}_id"), F.col("norm").alias(f"norm_{of}"), F.col("words").alias(f"words_{of}")]

    def side(of: str, smaller: bool) -> DataFrame:
        return looks.where(of).select("date", *row(of), size.alias(f"n_{of}"), F.explode(_keys_of(F.col("words"), smaller)).alias("key"))

    n, parts = looks.count(), int(looks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    earlier = "y_id < x_id"  # of the smallest and the largest id, so some pair of ids counts
    begins = F.startswith("norm_x", F.col("norm_y")) | F.startswith("norm_y", F.col("norm_x"))
    met = None
    for small, large, fits in (("x", "y", "n_x <= n_y"), ("y", "x", "n_y < n_x")):
        few, many = side(small, True), side(large, False)
        if large == "y":
            many = asked(many, few.select("date", "key"), n, "date", "key")
        else:
            few = asked(few, many.select("date", "key"), n, "date", "key")
        shared = F.array_intersect(F.col(f"words_{small}"), F.col(f"words_{large}"))
        few, many = (t.repartition(parts, "date", "key") for t in (few, many))  # few rows make many pairs: tasks aren't put together by size
        pairs = few.join(many, ["date", "key"]).where(fits).where(earlier).withColumn("shared", shared).where(F.size("shared") / F.col(f"n_{small}") >= _SHARE)
        one, two = F.get("shared", F.lit(0)), F.get("shared", F.lit(1))
        first = F.when(F.col(f"n_{large}") > PAIRED, F.concat(F.lit("long "), one)).when(F.col(f"n_{small}") == 1, F.concat(F.lit("one "), one))
        first = first.otherwise(F.concat(F.lit("two "), F.least(one, two), F.lit(" "), F.greatest(one, two)))
        pairs = pairs.where(F.col("key") == first).select("xs", "ys", F.when(begins, "prefix").otherwise("word_overlap").alias("kind"))
        met = pairs if met is None else met.unionByName(pairs)
    length = F.length("norm")
    for short, long, fits in (("y", "x", "at <= length(norm_x)"), ("x", "y", "at < length(norm_y)")):
        # a name is cut at the lengths only that shorter names of its date have
        lengths = looks.where(short).groupBy("date").agg(F.collect_set(length).alias("lengths"))
        cut = looks.where(long).join(lengths, "date").select("date", *row(long), F.explode("lengths").alias("at")).where(fits)
        heads = cut.withColumn("head", F.substring(F.col(f"norm_{long}"), F.lit(1), F.col("at"))).drop("at")
        begun = heads.join(looks.where(short).select("date", F.col("norm").alias("head"), *row(short)), ["date", "head"]).where(earlier)
        begun = begun.where(C.overlap(F.col("words_x"), F.col("words_y")) < _SHARE)  # the others met on words
        met = met.unionByName(begun.select("xs", "ys", F.lit("prefix").alias("kind")))
    return met


#: About as many ids of one name and date go together.
BLOCK = 500


def fuzzy_pairs(cand: DataFrame, as_of: str) -> DataFrame:
    """(id, other_id, kind): pending upcoming rows and earlier rows of the same date with a similar name.

    Distinct names of a date meet once, with blocks of their ids; what is moved grows with the names, and pairs leave where they are made. Their number is the
    square of what is similar on a date.
    """
    pending = (F.col("pipeline_state") == "pending_llm") & (F.coalesce("end_date", "date") >= as_of)
    rows = cand.where("name is not null and name <> ''").select("id", "date", "name", F.coalesce(pending, F.lit(False)).alias("x"), (~F.coalesce(F.col("pipeline_state"), F.lit("vetoed")).isin("vetoed", "expired", "duplicate")).alias("y"))
    keyed = _normalised(rows.where("date is not null and (x or y)"))
    often = keyed.groupBy("date", "norm").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1")
    block = F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).alias("block")
    of = lambda c: F.collect_list(F.when(F.col(c), F.col("id"))).alias(f"{c}s")
    looks = keyed.join(often, ["date", "norm"], "left").groupBy("date", "norm", block).agg(of("x"), of("y"), F.max(F.when(F.col("x"), F.col("id"))).alias("x_id"), F.min(F.when(F.col("y"), F.col("id"))).alias("y_id"))
    looks = looks.drop("block").withColumns({"x": F.col("x_id").isNotNull(), "y": F.col("y_id").isNotNull(), "look": F.monotonically_increasing_id()})
    pairs = _similar(_ranked(staged(looks)))
    return pairs.select(F.explode("xs").alias("id"), "ys", "kind").select("id", F.explode("ys").alias("other_id"), "kind").where("other_id < id")


def apply_duplicates(cand: DataFrame, verdicts: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Action for each verdict (new_id, duplicate_of, confidence as JSON text)."""
    raw = F.trim(F.coalesce("confidence", F.lit("0")))
    value = F.regexp_replace(raw, '^"(.*)"$', "$1").try_cast("double")
    bad = raw.isin("true", "false") | value.isNull() | (value < 0) | (value > 1)
    joined = verdicts.join(cand.select(F.col("id").alias("new_id"), "pipeline_state"), "new_id", "left")
    action = F.when(bad, "invalid").when(value < s.match_confidence, "kept").when(F.coalesce(F.col("pipeline_state") != "pending_llm", F.lit(True)), "skipped").otherwise("duplicate")
    return joined.select("new_id", "duplicate_of", action.alias("action"))


def merge_multiday(cand: DataFrame, as_of: str) -> DataFrame:
    """Rows of merged groups: (id, kept_id, end_date, description, role)."""
    rows = cand.where((F.col("source") == "Newsletter") & (F.col("pipeline_state") == "pending_llm") & (F.coalesce("end_date", "date") >= as_of))
    rows = rows.withColumn("norm", C.normalise_name(F.col("name"))).withColumn("venue", C.or_null(F.lower(F.trim("venue_name")))).withColumn("day", F.col("date").try_cast("date"))
    if "description" not in rows.columns:
        rows = rows.withColumn("description", F.lit(None).cast("string"))
    key = Window.partitionBy("norm", "run_date")
    order = key.orderBy("date", "id")
    rows = rows.withColumn("gap", F.date_diff("day", F.lag("day").over(order))).withColumn("nth", F.row_number().over(order))
    ok = (F.count("*").over(key) >= 2) & (F.coalesce(F.max("gap").over(key), F.lit(0)) <= 2) & (F.date_diff(F.max("day").over(key), F.min("day").over(key)) <= 7)
    ok = ok & (F.coalesce(F.min("venue").over(key) == F.max("venue").over(key), F.lit(True)))
    found = rows.withColumn("ok", ok).where("ok").withColumn("kept_id", F.first("id").over(order))
    longest = F.max_by("description", F.struct(F.length("description"), -F.col("nth"))).over(key)
    return found.select("id", "kept_id", F.max(F.greatest("date", F.coalesce("end_date", "date"))).over(key).alias("end_date"), longest.alias("description"), F.when(F.col("id") == F.col("kept_id"), "kept").otherwise("duplicate").alias("role"))


def calendar_dedup(cal: DataFrame) -> DataFrame:
    w = Window.partitionBy(C.normalise_name(F.col("title")), "date").orderBy(F.length(F.coalesce("location", F.lit(""))).desc(), "calendar_id")
    return cal.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def confidence(title: Column, name: Column, title_words: Column, name_words: Column, venue_match: Column) -> Column:
    """struct(rank 2 high, 1 medium, 0 low; overlap)."""
    share = C.overlap(title_words, name_words)
    same = title == name
    rank = F.when(same | (venue_match & (share >= 0.6)), 2).when(venue_match | (share >= 0.6), 1).otherwise(0)
    kept = F.when(same, 1.0).when(venue_match | (share >= 0.4), share).otherwise(0.0)
    return F.struct(rank.alias("rank"), kept.alias("overlap"))


#: Words of a title or name up to which calendar rows and candidates meet on sets of words.
SETS = 6
#: Share of the smaller set of words from which titles are alike.
ALIKE = 0.6


def calendar_match(cal: DataFrame, cand: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Best candidate of each calendar row: (calendar_id, id, confidence, overlap); only high and medium ones.

    Rows of a date meet on an equal name, or on a set of words that both have: the candidates of a set and venue are one row with the smallest id, so
    what is paired grows with the calendar and its venues, not with the candidates of a date. Sets that no calendar row asks for are left out before
    anything is shuffled. Only rows without a likely match meet the candidates of their venue. Longer titles meet on their rarest words.
    """
    place = lambda c: C.normalise_venue(F.col(c), s.city, s.geocode_suffix)
    x = cal.where("date is not null").select("calendar_id", "date", C.normalise_name(F.col("title")).alias("t"), place("location").alias("v"))
    y = cand.where("date is not null").select("id", "date", C.normalise_name(F.col("name")).alias("n"), place("venue_name").alias("w"))
    x = staged(x.withColumn("tw", C.title_words(F.col("t"))))
    y = y.withColumn("nw", C.title_words(F.col("n")))
    y_sizes = _sizes(y, "nw")
    long_y, long_x = y.where(F.size("nw") > SETS), x.where(F.size("tw") > SETS)
    same_venue = (F.col("v") != "") & (F.col("w") != "") & (F.col("v").contains(F.col("w")) | F.col("w").contains(F.col("v")))
    c = confidence(F.col("t"), F.col("n"), F.col("tw"), F.col("nw"), same_venue)
    sides = [(x, long_y)] if max(y_sizes, default=0) > SETS else []
    if long_x.limit(1).count():
        sides.append((long_x, y.where(F.size("nw") <= SETS)))
    sides = [(a, staged(b.groupBy("date", "n", "w", "nw").agg(F.min("id").alias("id")))) for a, b in sides]

    likely = _met(x, y, y_sizes, same_venue, True)
    for a, b in sides:
        likely = likely.unionByName(_alike(a, b, c, ALIKE))
    likely = staged(_top(likely))
    rest = staged(x.where("v <> ''").join(likely.select("calendar_id"), "calendar_id", "left_anti"))
    at_venue = _met(rest, y, y_sizes, same_venue, False)
    for a, b in sides:
        left = rest.where(F.size("tw") > SETS) if a is long_x else rest
        venues = left.select("date", "v").distinct().join(b.where("w <> ''").select("date", "w").distinct(), "date").where(same_venue)
        at_venue = at_venue.unionByName(_scored(left.join(venues, ["date", "v"]).join(b, ["date", "w"]), c))
    best = likely.unionByName(_top(at_venue))
    return best.select("calendar_id", F.col("top.id").alias("id"), F.when(F.col("top.rank") == 2, "high").otherwise("medium").alias("confidence"), F.col("top.overlap").alias("overlap"))


def _sizes(t: DataFrame, words: str) -> list[int]:
    """The numbers of words that rows have; larger ones than ``SETS`` count as one more."""
    return sorted(r[0] for r in t.select(F.least(F.size(words), F.lit(SETS + 1)).alias("n")).distinct().collect())


def _codes(n: int, calendar: bool, others: list[int], alike: bool) -> list[int]:
    """What a row of ``n`` words meets rows of the other side on, which have one of ``others``: 64 * level + the bits of the words in a set. A level is twice the size
    of the smaller side, and one more if that is the candidate's; -1 stands for the whole name, 0 for nothing."""
    least = {2 * n if n <= m else 2 * m + 1 for m in others if m} if calendar else {2 * m if m <= n else 2 * n + 1 for m in others if m}
    sets = [64 * level + m for level in sorted(least) for m in range(1, 1 << n) if (k := m.bit_count()) <= level // 2 and (k / (level // 2) >= ALIKE) == alike]
    return [-1 if alike else 0, *sets]


def _keyed(t: DataFrame, name: str, words: str, others: list[int], alike: bool) -> DataFrame:
    """Rows of ``t`` by ``key``: the sets of their words with the size of the smaller side, and the share that a set is of it.

    ``others``: sizes of the other side. With ``alike`` the sets of a large share, and the whole name; else the smaller ones, and the empty one.
    """
    array = lambda codes: F.expr(f"array({', '.join(map(str, codes))})")
    codes = F.when(F.size(words) == 0, array(_codes(0, name == "t", others, alike)))
    for n in range(1, SETS + 1):
        codes = codes.when(F.size(words) == n, array(_codes(n, name == "t", others, alike)))
    codes = codes.otherwise(array([-1])) if alike else codes
    rows = t.withColumn("sorted", F.array_sort(words)).withColumn("code", F.explode(codes))
    of = [F.when(F.col("code").bitwiseAND(1 << i) > 0, F.get("sorted", F.lit(i))) for i in range(SETS)]
    size = F.expr("code div 128")
    key = F.when(F.col("code") < 0, F.concat(F.lit("="), name)).otherwise(F.concat_ws(" ", F.expr("cast(code div 64 as string)"), *of))
    share = F.when(F.col("code") < 0, 1.0).when(F.col("code") == 0, 0.0).otherwise(F.bit_count(F.expr("code % 64")) / size)
    return rows.withColumn("key", key).withColumn("share", share).drop("sorted", "code")


def told(rows: DataFrame, keys: DataFrame, n: int, *on: str) -> DataFrame:
    """``rows`` with ``told``: true if their ``on`` is among ``keys`` (about ``n``), and for few others; nothing but bits that the keys set is sent around, at most 32 MB of them."""
    bits = min(1 << 28, max(1 << 15, 1 << (16 * n).bit_length()))
    h = F.pmod(F.xxhash64(*on), F.lit(bits))
    masks = keys.select(h.alias("h")).groupBy(F.floor(F.col("h") / 64).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("mask"))
    found = masks.groupBy(F.floor(F.col("at") / 512).alias("part")).agg(F.map_from_entries(F.collect_list(F.struct((F.col("at") % 512).cast("int").alias("i"), "mask"))).alias("m"))
    table = found.select("part", F.transform(F.sequence(F.lit(0), F.lit(511)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("bits"))
    met = rows.withColumn("h", h).withColumn("part", F.floor(F.col("h") / 32768)).join(F.broadcast(table), "part", "left")
    return met.select(*rows.columns, F.expr("coalesce((shiftright(bits[cast(h % 32768 div 64 as int)], cast(h % 64 as int)) & 1L) = 1, false)").alias("told"))


def asked(rows: DataFrame, keys: DataFrame, n: int, *on: str) -> DataFrame:
    """``rows`` whose ``on`` is among ``keys``, and few others: for joins that would move all rows."""
    return told(rows, keys, n, *on).where("told").drop("told")


def _met(x: DataFrame, y: DataFrame, y_sizes: list[int], same_venue: Column, alike: bool) -> DataFrame:
    """(calendar_id, rank, overlap, id) of rows that have a set of words or a name in common, with ``alike``, or else the venue."""
    x_sizes = _sizes(x, "tw")
    sizes = lambda of: [n for n in of if n <= SETS]
    mine = _keyed(x, "t", "tw", sizes(y_sizes), alike).select("calendar_id", "date", "v", "key", "share")
    theirs = _keyed(y if alike else y.where("w <> ''"), "n", "nw", sizes(x_sizes), alike).select("id", "date", "w", "key")
    theirs = asked(theirs, mine, 4 * x.count(), "date", "key").groupBy("date", "key", "w").agg(F.min("id").alias("id"))
    rank = F.when(F.col("key").startswith("=") | (same_venue & (F.col("share") >= ALIKE)), 2).otherwise(1)
    pairs = mine.join(theirs, ["date", "key"])
    return (pairs if alike else pairs.where(same_venue)).select("calendar_id", rank.alias("rank"), F.col("share").alias("overlap"), "id")


def _alike(x: DataFrame, y: DataFrame, c: Column, share: float) -> DataFrame:
    """The scores of each calendar row's candidates that have its name or share ``share`` of the words."""
    counts = y.select("date", F.explode("nw").alias("word")).groupBy("date", "word").agg(F.count("*").alias("df"))
    pairs = x.join(y.withColumnRenamed("n", "t"), ["date", "t"]).withColumn("n", F.col("t"))
    for few, many, smaller in ((x, y, F.size("tw") <= F.size("nw")), (y, x, F.size("nw") < F.size("tw"))):
        pairs = pairs.unionByName(_salted_words(_rare(few, counts, share), _words(many)).where(smaller & (C.overlap(F.col("tw"), F.col("nw")) >= share)))
    return _scored(pairs, c)


def _words(t: DataFrame) -> DataFrame:
    return t.withColumn("word", F.explode("tw" if "tw" in t.columns else "nw"))


def _rare(t: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """Rows of ``t`` by each of their rarest words: as many as any set that shares ``share`` of the row's must have one of."""
    key = ["date", *(("calendar_id", "t", "v") if "tw" in t.columns else ("id", "n", "w"))]
    found = F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "word")))
    ranked = _words(t).select(*key, "word").join(counts, ["date", "word"], "left").groupBy(*key).agg(found.alias("ranked"))
    n = F.size("ranked")
    rare = ranked.select(*key, F.explode(F.slice("ranked", 1, (n - F.ceil(share * n - 1e-9) + 1).cast("int"))["word"]).alias("word"))
    return t.join(rare, key)


def _salted_words(few: DataFrame, many: DataFrame, salts: int = 8) -> DataFrame:
    """Rows that share a word of a date; a frequent word is dealt to ``salts`` parts, and ``few`` is copied to each."""
    parts = int(few.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    b = many.withColumn("salt", F.pmod(F.xxhash64(*[c for c in many.columns if c != "word"]), F.lit(salts)).cast("int"))
    keys = ["date", "word", "salt"]
    return a.repartition(parts, *keys).join(b.repartition(parts, *keys), keys).drop("word", "salt")


def _scored(pairs: DataFrame, c: Column) -> DataFrame:
    return pairs.select("calendar_id", "id", c.alias("c")).select("calendar_id", "c.rank", "c.overlap", "id").where("rank > 0")


def _top(scored: DataFrame) -> DataFrame:
    """(calendar_id, top): the pair of the best score and, of equal ones, the smallest id."""
    few = scored.groupBy("calendar_id", "rank", "overlap").agg(F.min("id").alias("id"))
    return few.groupBy("calendar_id").agg(F.max_by(F.struct("id", "rank", "overlap"), F.struct("rank", "overlap", -F.col("id"))).alias("top"))


def source_gaps(cal: DataFrame, matched: DataFrame) -> DataFrame:
    return cal.where(~C.blank(F.col("title"))).join(matched.select("calendar_id"), "calendar_id", "left_anti")


def orphan_recovery(board: DataFrame, cand: DataFrame) -> DataFrame:
    """Board pages no row tracks: (page_id, id, action), pairing each with one untracked row of its title and date."""
    orphans = board.join(cand.select(F.col("notion_page_id").alias("page_id")).where("page_id is not null"), "page_id", "left_anti")
    orphans = orphans.withColumn("norm", C.normalise_name(F.col("title")))
    whole = (F.col("norm") != "") & ~C.blank(F.col("date"))
    named = cand.withColumn("norm", C.normalise_name(F.col("name")))
    prefer = F.when(F.col("pipeline_state") == "ready_to_write", 0).when(F.col("pipeline_state") == "write_failed", 1).otherwise(2)
    mine = Window.partitionBy("norm", "date")
    pages = orphans.withColumn("nth", F.when(whole, F.row_number().over(mine.orderBy("page_id"))))
    free = named.where("notion_page_id is null").select("id", "norm", "date", F.row_number().over(mine.orderBy(prefer, "id")).alias("nth"))
    tracked = named.where("notion_page_id is not null").select("norm", "date").distinct().withColumn("tracked", F.lit(True))
    joined = pages.join(free, ["norm", "date", "nth"], "left").join(tracked, ["norm", "date"], "left")
    # a stub made for a page tracks its title for the pages after it
    later = F.row_number().over(Window.partitionBy("norm", "date", F.col("id").isNull()).orderBy("page_id")) > 1
    action = F.when(~whole, "unrecoverable").when(F.col("id").isNotNull(), "matched").when(F.col("tracked") | later, "duplicate").otherwise("stub")
    return joined.select("page_id", "id", action.alias("action"))


def date_drift(cand: DataFrame, fresh: DataFrame, as_of: str) -> DataFrame:
    """Stored against fresh facts of upcoming rows with an open verdict: (id, status, changed)."""
    rows = cand.where((F.coalesce("end_date", "date") >= as_of) & F.col("source").isin("Meetup", "Luma") & F.col("verdict").isin("Going", "Maybe", "Undecided"))
    f = fresh.select("url_key", *(F.col(c).alias(f"f_{c}") for c in ("date", "time", "end_date")), F.lit(True).alias("found"))
    j = rows.withColumn("url_key", C.url_key(F.col("url"))).join(f, "url_key", "left")
    changed = F.array_compact(F.array(F.when(~F.col("date").eqNullSafe(F.col("f_date")), "date"), F.when(F.col("f_time").isNotNull() & ~F.col("time").eqNullSafe(F.col("f_time")), "time"), F.when(~F.col("end_date").eqNullSafe(F.col("f_end_date")), "end_date")))
    status = F.when(F.col("found").isNull(), "not found").when(C.blank(F.col("f_date")), "error").when(F.size(changed) > 0, "changed").otherwise("same")
    return j.select("id", status.alias("status"), F.when(status == "changed", F.array_join(changed, ",")).alias("changed"))


def snapshot_compare(cand: DataFrame, title: Column, url: Column) -> DataFrame:
    return cand.select("id", (F.trim("name") != F.trim(title)).alias("name_differs"), (~C.url_key(F.col("url")).eqNullSafe(C.url_key(url))).alias("url_differs"))
