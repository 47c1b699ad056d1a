"""Document fingerprints by consistent weighted sampling.

The terms of a text are its two-word shingles, weighted by how often they occur. A weight is a whole number, so a term
of weight w stands for w elements (term, 0) to (term, w - 1), and two texts share the smaller weight's elements: the
generalised Jaccard similarity, sum of smaller weights / sum of larger weights, is that of the sets of elements.

Every element is drawn for every one of `BINS` samples, lazily: in layer l it has a uniform rank in [l, l + 1) in one
random bin (from layer `BINS` on in bin l - `BINS`, so that after `LAYERS` layers it has been in all). The smallest
rank in a bin wins, so layers behind the first in which all bins are taken cannot change anything and are not drawn.
Each bin's winner is equal in two texts with the probability of their similarity; no bin copies another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, materialize

BINS = 128
LAYERS = 2 * BINS
#: Points drawn at first; they leave one of the bins empty in about one text of 2,000, which is drawn to the end.
ENOUGH = 1_600
_RANK = 2**48 - 1
#: What is known of a row without its text: its key, length and how often it is there.
ROW = ("d", "h", "n", "copies")


def _drawn(e: Column, layers: Column) -> Column:
    """Points of elements ``e`` in so many layers, ascending: 7 bits of bin, 8 of layer, 48 of rank."""
    free = lambda k: F.transform(e, lambda x: F.xxhash64(x, k).bitwiseAND(F.lit(((BINS - 1) << 56) | _RANK)) + F.shiftleft(k.cast("long"), 48))
    fixed = lambda k: F.transform(e, lambda x: F.xxhash64(x, k).bitwiseAND(F.lit(_RANK)) + F.shiftleft(k.cast("long"), 48) + F.shiftleft((k - BINS).cast("long"), 56))
    first = F.flatten(F.transform(F.sequence(F.lit(0), F.least(layers, F.lit(BINS)) - 1), free))
    rest = F.flatten(F.transform(F.sequence(F.lit(BINS), layers - 1), fixed))
    return F.sort_array(F.when(layers > BINS, F.concat(first, rest)).otherwise(first))


def _winners(d: Column) -> Column:
    """The first point of each bin of sorted points."""
    return F.filter(d, lambda x, i: (i == 0) | (F.shiftright(x, 56) != F.shiftright(F.get(d, i - 1), 56)))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: array<int> of `BINS` samples; empty for a null or blank text. One word is a term of its own."""
    trimmed, words, terms, starts, drawn, won = (f"_{out}_{x}" for x in ("trimmed", "words", "terms", "starts", "drawn", "won"))
    kept = df.columns
    df = df.withColumn(trimmed, F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r")))
    df = df.select(*kept, F.when(F.col(trimmed) == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS)).alias(words))
    w = F.col(words)
    pairs = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda k: F.xxhash64(F.get(w, k), F.get(w, k + 1)))
    df = df.select(*kept, F.sort_array(F.when(F.size(w) > 1, pairs).otherwise(F.transform(w, lambda x: F.xxhash64(x)))).alias(terms))
    t = F.col(terms)
    at = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda k: (k == 0) | (F.get(t, k) != F.get(t, k - 1)))
    df = df.select(*kept, terms, F.when(F.size(t) > 0, at).otherwise(F.array().cast("array<int>")).alias(starts))
    s = F.col(starts)
    elements = F.flatten(F.transform(s, lambda k, i: F.transform(F.sequence(F.lit(0), F.coalesce(F.get(s, i + 1), F.size(t)) - k - 1), lambda c: F.xxhash64(F.get(t, k), c))))
    df = df.select(*kept, elements.alias(terms))
    layers = F.least(F.lit(LAYERS), F.ceil(F.lit(ENOUGH) / F.size(terms)).cast("int"))
    df = df.select(*kept, terms, F.when(F.size(terms) > 0, _drawn(F.col(terms), layers)).otherwise(F.array().cast("array<bigint>")).alias(drawn))
    df = df.select(*kept, terms, _winners(F.col(drawn)).alias(won))
    open_ = (F.size(won) > 0) & (F.size(won) < BINS)
    df = df.select(*kept, F.col(won), F.when(open_, _drawn(F.col(terms), F.lit(LAYERS))).alias(drawn))
    df = df.select(*kept, F.when(F.col(drawn).isNotNull(), _winners(F.col(drawn))).otherwise(F.col(won)).alias(won))
    return df.select(*kept, F.transform(won, lambda x: x.bitwiseAND(F.lit(0xFFFF)).cast("int")).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples, the estimate of the generalised Jaccard similarity; two empty ones are alike."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda acc, x: acc + x)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), ((F.size(a) == 0) & (F.size(b) == 0)).cast("double")).otherwise(same / F.lit(float(BINS)))


def as_text(a: Column) -> Column:
    """Four hexadecimal digits a sample; empty for an empty fingerprint."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 4, "0")), "")


def _predecessors(ids: DataFrame) -> DataFrame:
    """For each (d, h) of ``ids`` (with n and copies): the row before it in descending (d, h), as (before_d, before_h, before_n);
    before the first comes the last. Sorted by range, so that no task holds more than its range; the range ends, one
    row for each range, meet in a small table."""
    ranged = materialize(ids.repartitionByRange(F.desc("d"), F.desc("h")).withColumn("pid", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("pid").orderBy(F.desc("d"), F.desc("h"))
    lagged = ranged.select("d", "h", "pid", *(F.lag(c).over(within).alias(f"before_{c}") for c in ROW), F.lead("d").over(within).isNull().alias("last"), "n", "copies")
    ends = lagged.where("last").select("pid", *ROW)
    order = Window.orderBy("pid")  # a row for each range
    whole = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("pid", *(F.coalesce(F.lag(c).over(order), F.last(c).over(whole)).alias(f"end_{c}") for c in ROW))
    return lagged.join(F.broadcast(ends), "pid").select("d", "h", *(F.coalesce(f"before_{c}", f"end_{c}").alias(f"before_{c}") for c in ROW))


def _edited(docs: DataFrame) -> DataFrame:
    """Each (d, h) once with its copies, its text, its edited text and the next row's key."""
    doc_id, content = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    base = docs.select(F.coalesce(doc_id, F.lit(-(2**63))).alias("d"), F.xxhash64(doc_id.isNull(), content).alias("h"), content.alias("text"))
    ids = base.groupBy("d", "h").agg(F.first(F.char_length("text")).alias("n"), F.count("*").alias("copies"))
    before = _predecessors(ids)
    once = base.dropDuplicates(["d", "h"])
    start = F.substring("text", F.lit(1), F.expr("before_n div 3").cast("int"))
    prefix = once.join(before, ["d", "h"]).select(F.col("d").alias("next_d"), F.col("h").alias("next_h"), F.col("before_d").alias("d"), F.col("before_h").alias("h"), F.col("before_copies").alias("copies"), start.alias("prefix"))
    n = F.char_length("text")
    edited = F.concat(F.substring("text", F.lit(1), (n - F.expr("char_length(text) div 3")).cast("int")), F.col("prefix"))
    # Both sides read the same columns of `once`, so that one exchange of the texts serves both.
    is_null = (F.col("d") == -(2**63)) & (F.col("h") == F.xxhash64(F.lit(True), "text"))
    return once.join(prefix, ["d", "h"]).select(F.when(~is_null, F.col("d")).alias("doc_id"), "d", "h", "next_d", "next_h", "copies", n.cast("long").alias("n_chars"), "text", edited.alias("edited_text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint every text of ``docs`` (doc_id, text), and its edited text, and compare.

    The edited text has its last floor(n_chars / 3) code points replaced by as many of the first code points of the
    next document (all, if it has fewer). Next: in descending doc_id; after the last the first. Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint (array<int>), near_edited, near_next.

    A null text counts as empty; an empty or blank text has an empty fingerprint, like only to another such. A null
    doc_id comes after all others. Rows with equal doc_id and text count once in the order and get the same result
    each; one doc_id with other texts is ordered by a hash. Other columns are ignored.
    """
    both = with_fingerprint(with_fingerprint(_edited(docs), "text", "f"), "edited_text", "e")
    short = lambda c: F.transform(c, lambda x: (x - 32768).cast("short")).alias(c)
    sha = F.unhex(F.sha2(F.col("edited_text").cast("binary"), 256)).alias("sha")
    kept = materialize(both.select("doc_id", "d", "h", "next_d", "next_h", "copies", "n_chars", sha, short("f"), short("e")), "fingerprints")
    following = kept.select(F.col("d").alias("next_d"), F.col("h").alias("next_h"), F.col("f").alias("g"))
    wide = lambda c: F.transform(c, lambda x: x.cast("int") + 32768)
    return (
        kept.select("doc_id", "next_d", "next_h", "copies", "n_chars", "sha", "f", "e")
        .join(following, ["next_d", "next_h"])
        .select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), wide("f").alias("fingerprint"), wide("e").alias("edited_fingerprint"), likeness(F.col("f"), F.col("e")).alias("near_edited"), likeness(F.col("f"), F.col("g")).alias("near_next"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        .drop("copy")
    )
