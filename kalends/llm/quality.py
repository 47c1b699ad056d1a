"""Line-first cleaning: rules judge lines, failed lines go, and a document that loses too much text is rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS

#: A document is rejected if the lines that fail hold more than this share of its word characters.
MAX_LOST = 0.5

#: Sentence ends of Latin, Chinese, Japanese and Arabic script, with closing quotes and brackets.
ENDS = r"[.!?…:;。！？؟][\"'”’»)\]」』）]*\s*$"
#: Site furniture: two or more separators in a line.
NAVIGATION = r"^(?:(?:[^|]*+\|){2}|(?:[^»›>]*+[»›>]){2}|(?:[^·•]*+[·•]){2})"
#: Legal and interface text in English, German, French and Spanish.
BOILERPLATE = r"(?i)\b(?:all rights reserved|licen[sc]ed under|released under the|terms of (?:use|service)|privacy policy|cookie policy|uses? cookies|enable javascript|lorem ipsum|powered by|sign in|log in|subscribe to|click here|read more|alle rechte vorbehalten|datenschutzerkl[äa]rung|cookies verwenden|weiterlesen|mehr lesen|tous droits r[ée]serv[ée]s|lire la suite|en savoir plus|todos los derechos reservados|pol[íi]tica de privacidad|seguir leyendo)\b"
#: Words closed by runs of symbols or by several exclamation marks.
NOISE = r"[#*$%&<>]{2,}|[!?]{2,}"


def line_verdict(line: Column) -> Column:
    """Why a line fails: navigation, boilerplate, noise or punctuation; null if it passes."""
    words = F.size(F.split(line, BLANKS))
    return (
        F.when(line.rlike(NAVIGATION), "navigation")
        .when((words <= 20) & line.rlike(BOILERPLATE), "boilerplate")
        .when(F.regexp_count(line, F.lit(NOISE)) * 5 > words, "noise")
        .when(~line.rlike(ENDS), "punctuation")
    )


def quality(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """Judge every whole text of ``docs`` (doc_id, text).

    Returns doc_id, text (the cleaned one; null stays null), n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long), base_failed, kept, lost_chars, lines_failed. Lines that repeat an earlier line of the text
    count as failed too. The cleaned text holds the lines that passed, once each and without the empty lines between. A null, empty or blank text has zeros, fails the base (fewer than 50 words) and is not kept.
    Rows are judged one by one, so null doc_ids and repeated rows need no rule; other columns are ignored.
    """
    has_word = r"[^\x20\x09-\x0D]"
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("original"), F.coalesce("text", F.lit("")).alias("t"))
    base = base.withColumn("trimmed", F.btrim("t", F.lit(" \t\n\x0b\x0c\r")))
    base = base.select(
        "doc_id",
        "original",
        F.split("t", "\n").alias("lines"),
        F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", BLANKS)).alias("words"),
        (F.char_length("t") - F.regexp_count("t", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    base = base.withColumns({"n": F.size("words"), "worded": F.filter("lines", lambda x: x.rlike(has_word))})
    word = lambda k: F.get(F.col("words"), k)
    window = lambda k: F.struct(F.xxhash64(word(k), word(k + 1), word(k + 2)).alias("h"), k.alias("i"))
    windows = F.when(F.col("n") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.col("n") - 3), window)))
    base = base.withColumns({"sorted": windows, "distinct": F.array_distinct("worded")})
    hash_at = lambda k: F.get(F.col("sorted"), k)["h"]
    same = lambda x, k: F.coalesce(x["h"] == hash_at(k), F.lit(False))
    twice = F.filter("sorted", lambda x, k: same(x, k - 1) | same(x, k + 1))
    failed = F.filter("distinct", lambda x: line_verdict(x).isNotNull())
    base = base.withColumns({"starts": F.sort_array(F.transform(twice, lambda x: x["i"])), "failed": failed})
    length = lambda x: F.char_length(x) - F.regexp_count(x, F.lit(r"[\x20\x09-\x0D]"))
    chars = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda acc, x: acc + length(x))
    covered = F.transform("starts", lambda x, k: F.least(F.lit(3), F.coalesce(F.get(F.col("starts"), k + 1) - x, F.lit(3))))
    passed = F.array_except("distinct", "failed")
    base = base.withColumns(
        {
            "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda acc, x: acc + x), F.lit(0).cast("long")),
            "clean": F.array_join(passed, "\n"),
            "lost_chars": F.col("word_chars") - chars(passed),
        }
    )
    n_words = F.col("n").cast("long")
    base_failed = (n_words < 50) | (100 * F.col("n_repeat_words") > 50 * n_words)
    return base.select(
        "doc_id",
        F.when(F.col("original").isNotNull(), F.col("clean")).alias("text"),
        n_words.alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("worded") - F.size("distinct")).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & (F.col("lost_chars") <= max_lost * F.col("word_chars"))).alias("kept"),
        "lost_chars",
        (F.size("failed") + F.size("worded") - F.size("distinct")).cast("long").alias("lines_failed"),
    )
