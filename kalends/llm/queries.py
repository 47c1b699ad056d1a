"""The queries opN_<name>: thin digests of the operators' results, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprint, linedup, mixing, neardup, packing, pii, quality, sharding, toxicity, urlrules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


_BLANKS, _WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text; labels of held-out ids are never read by the fit."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    held_out = F.coalesce(toxicity.folded(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A uniform shuffle into 24 shards whose row counts differ by one at most."""
    out = sharding.shard(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "partition")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup deletes: doc_id, n_lines, n_deleted, deleted_lines (numbers from 0, comma-separated), text_sha256."""
    out = linedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.array_join(F.transform("_deleted_lines", lambda x: x.cast("string")), ",")
    return out.select(
        "doc_id",
        F.col("_n_lines").cast("long").alias("n_lines"),
        F.size("_deleted_lines").cast("long").alias("n_deleted"),
        gone.alias("deleted_lines"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


#: Fixed by the query's contract.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every page's url; mined rules are learnt from labels alone."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    mined = urlrules.mine_table(urlrules.training(pages, read(spark, sf_dir, "labels")))
    out = urlrules.judge(pages, URL_RULES, mined)
    return out.select("page_id", "host", "path", "rule", "verdict", F.array_join("tokens", " ").alias("mined_rule"), "confidence")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated sampling: doc_id, tokens, topic, probability, sampled."""
    out = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return out.select("doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"), F.col("_probability").alias("probability"), F.col("_sampled").alias("sampled"))


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consistent weighted sampling of texts and edited texts."""
    out = fingerprint.fingerprints(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256", fingerprint.as_text(F.col("fingerprint")).alias("fingerprint"), fingerprint.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of line-first cleaning."""
    out = quality.quality(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars", "lines_failed")


#: Makes runs repeatable; a user gives a key of their own.
PII_KEY = "kalends-demo-key"


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudonymised texts and how many of each kind were replaced."""
    out = pii.pseudonymize(read(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    count = lambda k: F.size(F.filter("_pii", lambda x: x["kind"] == k)).cast("long")
    return out.select("doc_id", "text", *(count(k).alias(f"n_{k}") for k in pii.KINDS))


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.85: doc_id, n_shingles, component_id, kept."""
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)


ORACLE["op8_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM r GROUP BY 1),
l AS (SELECT doc_id, line, len(regexp_split_to_array(line, '{_BLANKS}')) AS n, len(regexp_replace(line, '{_BLANKS}', '', 'g')) AS chars FROM (SELECT doc_id, unnest(list_distinct(lines)) AS line FROM w)),
f AS (SELECT doc_id, chars, len(regexp_extract_all(line, '\|')) >= 2 OR len(regexp_extract_all(line, '[»›>]')) >= 2 OR len(regexp_extract_all(line, '[·•]')) >= 2 OR (n <= 20 AND regexp_matches(line, '{quality.BOILERPLATE}'))
  OR len(regexp_extract_all(line, '{quality.NOISE}')) * 5 > n OR NOT regexp_matches(line, '{quality.ENDS.replace("'", "''")}') AS failed FROM l),
p AS (SELECT doc_id, coalesce(sum(chars) FILTER (NOT failed), 0) AS passed, count(*) FILTER (failed) AS failed FROM f GROUP BY 1),
o AS (SELECT w.doc_id, len(words) AS n_words, len(regexp_replace(t, '{_BLANKS}', '', 'g')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(c.n, 0) AS n_repeat_words, coalesce(p.passed, 0) AS passed, coalesce(p.failed, 0) AS failed FROM w LEFT JOIN c USING (doc_id) LEFT JOIN p USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars - passed <= {quality.MAX_LOST} * word_chars AS kept, CAST(word_chars - passed AS BIGINT) AS lost_chars, failed + n_dup_lines AS lines_failed FROM o"""

ORACLE["op10_near_duplicates"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{urlrules.UPPER}', '{urlrules.LOWER}'), '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
b AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b.v, r.root FROM r JOIN b ON b.u = r.node),
m AS (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY 1)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)"""
