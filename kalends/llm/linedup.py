"""Repeated line runs through a suffix array over line-id sequences, built by distributed prefix doubling.

Every document is a sequence of line ids; the corpus is their concatenation with a unique end after each document.
A round of prefix doubling ranks the suffixes by `BASE` times as many lines as the round before: by the ranks of i,
i + m, ... of the first m lines. Suffixes that agree so far have one rank, the left border of their interval of the
suffix array, and with their number that interval [rank, rank + n) is the one whose longest common prefix is m lines or
more. Suffixes alone in their interval have no repeat that long and leave the array of the later rounds.

A common prefix of any length between two powers is the overlap of `BASE` of these intervals, one at its start and one
that ends with it. A maximal repeated run of at least ``min_words`` words is covered by its shortest stretches of
``min_words`` words taken forward and backward from each of its lines; the prefix interval of such a stretch holds all
its copies, and all but the first are deleted. So one aggregate finds every line of every maximal run that has an
earlier copy, with no pairs of copies and no scan of an interval. Doubling stops at more than min_words lines, since
every line counted has a word.

A document's suffixes of a round meet once, where ranks ahead and behind are read off for the next round and for the
stretches of that length; these are kept with the ranks, so nothing is joined by line again.

Ranks are sums over `RANGES` ranges of the order, and the line or interval that a third of all suffixes share is met by
broadcast (:func:`join_counted`), so no task holds one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, forget, free, join_counted, materialize

MIN_WORDS = 40
SEED = 7_340_033
#: Times as many lines a round: 2 doubles, 4 doubles twice before ranks are made.
BASE = 4
#: Ranges that ranks are summed over; their totals meet in one place.
RANGES = 4096

_SOLID = r"[^\x20\x09-\x0D]"


def _powers(min_words: int) -> list[int]:
    """Numbers of lines that rounds rank by: 1, BASE, ... up to min_words."""
    out = [1]
    while out[-1] * BASE <= min_words:
        out.append(out[-1] * BASE)
    return out


def _shortest(words: Column, min_words: int) -> Column:
    """How many of the numbers ``words`` have the sum min_words, from the first on; null if all have less."""
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"))

    def add(acc: Column, x: Column) -> Column:
        return F.when(acc["sum"] >= min_words, acc).otherwise(F.struct((acc["sum"] + x).alias("sum"), (acc["n"] + 1).alias("n")))

    return F.aggregate(words, zero, add, lambda acc: F.when(acc["sum"] >= min_words, acc["n"]))


def _stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """``lines`` (d, h, seq, w and others), each once, with their shortest stretches of min_words words within
    consecutive lines: ahead, the lines of the one that starts here, and behind, for each power m those of the one that
    ends m - 1 lines below, if it has from m to BASE * m - 1 lines."""
    order = Window.partitionBy("d", "h").orderBy("seq")
    above = F.lag("seq").over(order)
    once = lines.withColumn("above", above).where("above is null or above <> seq").drop("above")  # repeated rows count once
    isles = once.withColumn("isle", F.col("seq") - F.row_number().over(order))
    inside = Window.partitionBy("d", "h", "isle").orderBy("seq")
    ahead = _shortest(F.collect_list("w").over(inside.rowsBetween(0, min_words - 1)), min_words)
    # Preceding rows arrive in text order; the stretch that ends here needs them from the last to the first.
    back = _shortest(F.reverse(F.collect_list("w").over(inside.rowsBetween(1 - min_words, 0))), min_words)
    both = isles.withColumns({"ahead": ahead, "back": back})
    ends = [F.when(F.col("back").between(m, BASE * m - 1), F.col("back")) for m in _powers(min_words)]
    behind = F.array(*[e if m == 1 else F.lead(e, m - 1).over(inside) for m, e in zip(_powers(min_words), ends, strict=True)])
    return both.withColumn("behind", behind).drop("isle", "back", "w")


def _read_off(suffixes: DataFrame, k: int, min_words: int) -> DataFrame:
    """``suffixes`` (d, h, seq, r, size, ahead, behind) that rank by m lines, m the k-th power, with next1, ... (ranks m,
    2 m, ... lines below, if there) and stretches: array of (back, span, from, p0, ...), those of this length that start
    here or end with these m lines, and the ranks of the intervals that overlap to them."""
    m = BASE**k
    order = Window.partitionBy("d", "h").orderBy("seq")
    reach = max(min((BASE - 1) * m - 1, min_words - m), 0)
    seq, r = F.col("seq"), F.col("r")

    def at(lines: int) -> Column:
        return F.first("r").over(order.rangeBetween(lines, lines))

    below = {f"next{i}": at(i * m) for i in range(1, BASE)} | {"below": F.collect_list(F.struct("seq", "r")).over(order.rangeBetween(0, reach))}
    above = {f"prior{i}": at(-i * m) for i in range(1, BASE - 1)} | {"above": F.collect_list(F.struct("seq", "r")).over(order.rangeBetween(-reach, 0))}
    seen = suffixes.withColumns(below | above)
    ahead, behind = F.when(F.col("ahead").between(m, BASE * m - 1), F.col("ahead")), F.get("behind", F.lit(k))

    def found(near: str, lines: Column) -> Column:
        return F.get(F.filter(near, lambda x: x["seq"] == seq + lines), F.lit(0))["r"]

    def stretch(back: bool, span: Column, begin: Column, far: Column, between: str) -> Column:
        mid = [F.when(i * m < span - m, F.col(f"{between}{i}")).otherwise(far) for i in range(1, BASE - 1)]
        parts = [F.lit(back).alias("back"), span.alias("span"), begin.alias("from"), *[x.alias(f"p{i}") for i, x in enumerate([r, *mid, far])]]
        whole = span.isNotNull() & far.isNotNull()
        for x in mid:
            whole &= x.isNotNull()
        return F.when(whole, F.struct(*parts))

    starts = stretch(False, ahead, seq, found("below", ahead - m), "next")
    # a stretch of one line is among those that start
    ends = stretch(True, F.when(behind > 1, behind), seq + m - behind, found("above", m - behind), "prior")
    stretches = F.filter(F.array(starts, ends), lambda x: x.isNotNull())
    return seen.withColumn("stretches", stretches).drop("below", "above", *[f"prior{i}" for i in range(1, BASE - 1)])


def _ranked(classes: DataFrame, by: list[str], part: Column) -> DataFrame:
    """``classes`` (by, n) with rank: how many suffixes are in classes before, in the order of ``by``, and members,
    which is n. ``part`` numbers the range of a class in that order, below `RANGES` of them: sums run within ranges, whose
    totals, a row for each, meet in one place."""
    parted = classes.withColumn("part", F.coalesce(part, F.lit(0)))  # never null, or one side of the join gets a filter and both count
    totals = parted.groupBy("part").agg(F.sum("n").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = Window.partitionBy("part").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    within = parted.withColumn("within", F.sum("n").over(inside) - F.col("n"))
    rank = (F.col("before") + F.col("within")).alias("rank")
    return materialize(within.join(F.broadcast(before), "part").select(*by, "n", F.col("n").alias("members"), rank), "ranks")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Lines to delete, as places (from 0) among the lines with a word: d, h (keys of the row's id and text), places
    array<int>, in no order; see :func:`dedup_lines`."""
    spark, text = docs.sparkSession, F.col("text")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).where("text is not null")
    # Blank lines do not count as lines, so that a run goes on across them.
    split = found.select(*_keys(F.col("doc_id"), text), F.posexplode(F.filter(F.split("text", "\n"), lambda x: x.rlike(_SOLID))).alias("seq", "line"))
    words = F.size(F.split(F.btrim("line", F.lit(" \t\n\x0b\x0c\r")), BLANKS))
    # two hashes of different seeds: at 1e12 lines one alone would take some unequal lines for equal
    ids = [F.xxhash64("line").alias("id"), F.xxhash64(F.lit(SEED), "line").alias("id2")]
    lines = materialize(split.select("d", "h", "seq", *ids, words.cast("long").alias("w")), "lines")
    twice = lines.groupBy("id", "id2").agg(F.count("*").alias("n")).where("n > 1")
    named = _ranked(twice, ["id", "id2"], F.shiftright("id", 64 - RANGES.bit_length() + 1))
    total = named.agg(F.sum("n")).first()[0] or 0
    first = join_counted(lines, named, ["id", "id2"]).select("d", "h", "seq", "w", F.col("rank").alias("r"), F.col("members").alias("size"))
    level = materialize(_read_off(_stretches(first, min_words), 0, min_words), "suffixes-0")
    forget(spark, lines, named)
    kept, by = [level], ["r", "size", *[f"next{i}" for i in range(1, BASE)]]
    # An interval's share of the ranges is that of its suffixes, and within it a class lies by the rank that follows.
    part = F.floor((F.col("r") + F.col("size") * F.col("next1") / F.lit(float(total or 1))) * F.lit(RANGES / (total or 1))).cast("long")
    for k in range(1, len(_powers(min_words))):
        longer = level.dropna(subset=by)
        named = _ranked(longer.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1"), by, part)
        if named.isEmpty():
            break
        joined = join_counted(longer.select("d", "h", "seq", *by, "ahead", "behind"), named, by)
        suffixes = joined.select("d", "h", "seq", F.col("rank").alias("r"), F.col("members").alias("size"), "ahead", "behind")
        level = materialize(_read_off(suffixes, k, min_words), f"suffixes-{k}")
        forget(spark, named)
        kept.append(level)
    stretches = kept[0].select("d", "h", F.inline("stretches"))
    for level in kept[1:]:
        stretches = stretches.unionByName(level.select("d", "h", F.inline("stretches")))
    by, place = ["back", "span", *[f"p{i}" for i in range(BASE)]], F.struct("d", "h", "from")
    firsts = materialize(stretches.groupBy(*by).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "intervals")
    later = join_counted(stretches, firsts, by).where(place > F.col("first"))
    gone = later.select("d", "h", F.explode(F.sequence("from", F.col("from") + F.col("span") - 1)).alias("seq"))
    return gone.groupBy("d", "h").agg(F.collect_set("seq").alias("places"))


def _keys(doc_id: F.Column, text: F.Column) -> list[F.Column]:
    """d, h of a row: its id (the last of all without one), and a hash that tells texts of one id apart."""
    return [F.coalesce(doc_id, F.lit(2**63 - 1)).alias("d"), F.xxhash64(doc_id.isNull(), text).alias("h")]


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, prefix: str = "_") -> DataFrame:
    """``docs`` (doc_id, text and any others) with later copies of repeated line runs deleted.

    A line goes if it lies in a run of consecutive lines with at least ``min_words`` words that also stands earlier:
    in a document of a smaller doc_id, or above in the same text (the two may overlap). Lines compare as they are;
    blank lines count for nothing and stay. All columns stay; text is replaced, and ``_deleted_lines`` (array<int>,
    empty if none) and ``_n_lines`` (lines with a word before) are added, under another ``prefix`` if given. Columns
    that have these two names are replaced; others may have any name.

    A null text stays null. Null doc_ids come last in the order. Rows with equal doc_id and text are one document and
    get the same result each; rows with one doc_id and other texts are ordered by a hash of the text. An empty table
    gives no rows.
    """
    deleted, n_lines = f"{prefix}deleted_lines", f"{prefix}n_lines"
    docs = docs.drop(deleted, n_lines)
    d, h, places, gone_lines, split, solid = free(docs, "d", "h", "places", "gone", "split", "solid")
    gone = repeated_lines(docs, min_words).withColumnsRenamed({"d": d, "h": h, "places": places})
    own = _keys(F.col("doc_id").cast("long"), F.col("text"))
    joined = docs.withColumns({d: own[0], h: own[1]}).join(gone, [d, h], "left").withColumn(split, F.split("text", "\n"))
    numbers = F.transform(split, lambda x, k: F.when(x.rlike(_SOLID), k))
    joined = joined.withColumn(solid, F.filter(numbers, lambda k: k.isNotNull()))
    joined = joined.withColumn(gone_lines, F.transform(F.sort_array(places), lambda k: F.get(F.col(solid), k)))
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), gone_lines)
    clean = F.array_join(F.transform(left, lambda k: F.get(F.col(split), k)), "\n")
    counted = F.when(F.col("text").isNull(), 0).otherwise(F.size(solid))
    text = F.when(F.col(gone_lines).isNull(), F.col("text")).otherwise(clean).alias("text")
    columns = [text if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, F.coalesce(gone_lines, F.array().cast("array<int>")).alias(deleted), counted.alias(n_lines))
