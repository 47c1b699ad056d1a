"""URL filter from association rules.

FP-growth mines the token combinations of labelled urls that occur with a blocking label, on two thirds of them. Rules
are pruned by support, confidence and lift, by shorter rules that say as much, and by the third that mining has not
seen: there, too, a rule must reach the confidence, and surely block more than the share of blocked urls. What is left
forms an inverted index from each rule's rarest token to the rule. A url looks its tokens up and a rule fires if all its
tokens are there. Given rules for hosts and paths come first; they teach nothing.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, join_counted, materialize

SUPPORT, CONFIDENCE, LIFT, TOKENS = 0.002, 0.6, 1.5, 3
#: Blocked urls that a rule must hold at least, and one in how many labelled urls is kept from mining.
LEAST, HELD_OUT = 8, 3
#: Standard deviations for "surely".
SURE = 1.96
RULE = "tokens array<string>, confidence double"
BLOCKED = "\x00block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct words of a url: its host's labels as h:label, words of its path as p:word, names of its query's
    parameters as q:name. Numbers are one token."""
    labels = F.transform(F.split(host(url), r"[.\-]"), lambda x: F.concat(F.lit("h:"), x))
    words = F.transform(F.split(F.lower(path(url)), r"[^\p{L}\p{N}]+"), lambda x: F.concat(F.lit("p:"), F.when(x.rlike("^[0-9]+$"), "0").otherwise(x)))
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?]*\?([^#]*)", 1), F.lit(""))
    names = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    return F.filter(F.array_distinct(F.concat(labels, words, names)), lambda x: F.char_length(x) > 2)


def given(rules: list[tuple[str, str, str]], h: Column, p: Column) -> Column:
    """The longest of the given rules (host, path, verdict) that fits: struct(rule, verdict), or null.

    The host's suffixes are looked up in the rules' hosts, so the work for a url does not grow with the rules."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    by: dict[str, list] = {}
    for a, b, verdict in rules:
        by.setdefault(a, []).append(F.struct(F.lit(b).alias("path"), F.lit(a + b).alias("rule"), F.lit(verdict).alias("verdict")))
    index = F.create_map(*(x for a, v in by.items() for x in (F.lit(a), F.array(*v))))
    # as many of a host's suffixes as the longest rule has labels, so that a host of any length costs the same
    suffixes = F.array(*(F.substring_index(h, ".", -k) for k in range(1, 1 + max(a.count(".") + 1 for a in by))))
    fits = F.filter(F.flatten(F.filter(F.transform(F.array_distinct(suffixes), lambda s: F.try_element_at(index, s)), lambda x: x.isNotNull())), lambda r: F.startswith(p, r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(F.char_length(r["rule"]).alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def _lower(hits: Column, n: Column) -> Column:
    """The lower end of Wilson's interval for a share."""
    p, z2 = hits / n, F.lit(SURE**2)
    return (p + z2 / (2 * n) - F.lit(SURE) * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def mine_table(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT, least: int = LEAST, held_out: int = HELD_OUT) -> DataFrame:
    """Rules (tokens, confidence) that block, from (url, blocked boolean): all that support, confidence, lift and the
    held-out urls allow, but for those of which a part is a rule of at least the same confidence.

    A rule holds ``least`` blocked urls of those mined. A hash of the url holds one in ``held_out`` out (0: none, and
    rules are not confirmed). Tokens that are too rare among blocked urls to be in any rule are left out before mining.
    Rows with a null url or label are left out; without rows or without a blocked one there are no rules."""
    spark = labelled.sparkSession
    rows = labelled.where("url is not null and blocked is not null").select("url", "blocked", tokens(F.col("url")).alias("found"))
    rows = materialize(rows.select("*", F.monotonically_increasing_id().alias("row"), (F.pmod(F.xxhash64("url"), F.lit(held_out)) == 0 if held_out else F.lit(False)).alias("held")), "labelled")
    mined = rows.where("not held")
    n, n_blocked = mined.agg(F.count("*"), F.count_if("blocked")).first()
    if not n_blocked:
        return spark.createDataFrame([], RULE)
    floor = max(least, -(-support * n // 1))
    each = materialize(mined.select("row", "blocked", F.explode("found").alias("token")), "tokens")
    usual = materialize(each.groupBy("token").agg(F.count_if("blocked").alias("bad"), F.count("*").alias("n")).where(F.col("bad") >= floor).select("token", "n"), "usual")
    kept = join_counted(each, usual, ["token"]).groupBy("row").agg(F.collect_list("token").alias("items"))  # a url's tokens
    items = mined.join(kept, "row", "left").select(F.concat(F.coalesce("items", F.array().cast("array<string>")), F.when(F.col("blocked"), F.array(F.lit(BLOCKED))).otherwise(F.array().cast("array<string>"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=max(1e-12, (floor - 0.5) / n), minConfidence=confidence).fit(items)
    found = model.associationRules.where(F.element_at("consequent", 1) == BLOCKED).where((F.size("antecedent") <= TOKENS) & (F.col("lift") >= lift))
    rules = materialize(found.select(F.sort_array("antecedent").alias("tokens"), "confidence"), "rules")
    if held_out:
        hits = _matches(rules, rows.where("held").select("found", "blocked")).groupBy("tokens", "confidence").agg(F.count("*").alias("n"), F.count_if("blocked").alias("bad"))
        sure = (F.col("bad") >= confidence * F.col("n")) & (_lower(F.col("bad"), F.col("n")) > F.lit(n_blocked / n))
        rules = materialize(hits.where(sure).select("tokens", "confidence"), "confirmed")
    part = F.expr("transform(sequence(1, shiftleft(1, size(tokens)) - 2), m -> filter(tokens, (x, i) -> shiftright(m, i) % 2 = 1))")
    parts = rules.where(F.size("tokens") > 1).select("tokens", "confidence", F.explode(part).alias("part"))
    shorter = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("least"))
    said = parts.join(shorter, "part").where("least >= confidence").select("tokens").distinct()
    out = materialize(rules.join(said, "tokens", "left_anti").select("tokens", "confidence"), "pruned")
    forget(spark, each, usual, rows)
    return out


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT, least: int = LEAST, held_out: int = HELD_OUT) -> list[tuple[list[str], float]]:
    """The rules of `mine_table` as a list, the surest first."""
    rules = mine_table(labelled, support, confidence, lift, least, held_out).orderBy(F.desc("confidence"), F.size("tokens"), "tokens")
    return [(list(r["tokens"]), r["confidence"]) for r in rules.collect()]


def _matches(rules: DataFrame, rows: DataFrame) -> DataFrame:
    """Each of ``rows`` (found and others) with each rule of which it has all tokens.

    An inverted index lists each rule under its token that the fewest rules have; urls meet it by their tokens."""
    each = rules.select("tokens", "confidence", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("n"))
    index = each.join(often, "token").groupBy("tokens", "confidence").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    met = rows.withColumn("token", F.explode("found")).join(F.broadcast(index), "token")  # as many rules as support allows
    return met.where(F.size(F.array_except("tokens", "found")) == 0).drop("token")


def fired(rules: DataFrame, rows: DataFrame) -> DataFrame:
    """For each row (row, found) in which a mined rule has all its tokens: row, fired, the surest of these rules as
    struct(confidence, tokens). Rows meet the index one by one, so equal urls, however many, share no task."""
    return _matches(rules, rows.select("row", "found")).groupBy("row").agg(F.max(F.struct("confidence", "tokens")).alias("fired"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], mined: DataFrame | list[tuple[list[str], float]]) -> DataFrame:
    """page_id, host, path, rule, verdict, tokens (the mined rule that fired), confidence for every row of ``pages``.

    The verdict is the given rule's; else block if a mined rule fires, else allow. A null url, or one without ://, has
    an empty host and path and no tokens, and is allowed. Rows are judged one by one, so null page_ids and repeated
    rows need no rule; columns other than page_id and url are ignored."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.coalesce(tokens(F.col("url")), F.array().cast("array<string>")).alias("found"))
    base = base.withColumn("given", given(rules, F.col("host"), F.col("path")))
    mined = pages.sparkSession.createDataFrame(mined, RULE) if isinstance(mined, list) else mined
    base = materialize(base.withColumn("row", F.monotonically_increasing_id()), "pages")
    base = base.join(fired(mined, base), "row", "left")
    verdict = F.coalesce("given.verdict", F.when(F.col("fired").isNotNull(), "block").otherwise("allow"))
    return base.select("page_id", "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict"), F.col("fired.tokens").alias("tokens"), F.col("fired.confidence").alias("confidence"))


def training(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled urls (url, blocked): the label of the page's id, where quality 0 or toxic 1 blocks. Pages without a
    label are left out; several labels of one id block if one does."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("page_id")).agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").join(marks, "page_id").select("url", (F.col("bad") == 1).alias("blocked")).where("blocked is not null")
