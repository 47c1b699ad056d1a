"""The corpus pipeline: toxicity, line dedup, near-duplicates, mixing, packing, each on what the one before kept.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of documents. Nulls, empty tables and
repeated rows are treated as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends.llm import linedup, mixing, neardup, packing, toxicity
from kalends.llm.common import clear, forget, free, materialize, written


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is 0.5 or more go; the network is fitted on labelled documents of this input. Texts
    without words stay."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    (score,) = free(docs, "score")
    return toxicity.score(docs, model, score).where(F.col(score) < 0.5).select(*columns(docs))


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from the texts; a document that loses all its lines goes whole. n_chars is
    counted anew where lines went. Null and empty texts stay."""
    prefix = clear(docs)
    out = linedup.dedup_lines(docs, prefix=prefix)
    deleted, n_lines = F.col(f"{prefix}deleted_lines"), F.col(f"{prefix}n_lines")
    left = out.where((n_lines == 0) | (F.size(deleted) < n_lines))
    n_chars = F.when(F.size(deleted) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars").cast("long"))
    return left.select(*(n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id.

    A document without an id counts as one with a number made of its text, after all others. Rows that repeat an id
    and a text are copies of which one row stays; rows with one id and other texts are one document and stay or go
    together. Null and empty texts stay."""
    key, text_hash = free(docs, "key", "text")
    keyed = docs.withColumns({key: neardup.key(F.col("doc_id"), F.col("text")), text_hash: F.xxhash64("text")})
    gone = neardup.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), width=5, percent=80).where("not kept").select(F.col("doc_id").alias(key)).distinct()
    left = keyed.join(gone, key, "left_anti")
    times = materialize(keyed.groupBy(key, text_hash).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    if not times.isEmpty():
        once = left.join(times, [key, text_hash], "left_semi").dropDuplicates([key, text_hash])
        left = left.join(times, [key, text_hash], "left_anti").unionByName(once)
    return left.select(*columns(docs))


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by probabilities raked to source, language and topic targets."""
    prefix = clear(docs)
    return mixing.mix(docs, prefix=prefix).where(F.col(f"{prefix}sampled")).select(*columns(docs))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of at most 2048."""
    return packing.pack(docs)


def columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [
    ("toxicity", stage_toxicity),
    ("line_dedup", stage_line_dedup),
    ("near_duplicates", stage_near_duplicates),
    ("mixing", stage_mixing),
    ("packing", stage_packing),
]

#: A trained network, a tokenizer and connected components: not for SQL. The stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each stage's result is written to the shared folder and read back, and
    what the stage wrote on its way, with the result before, is deleted then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before = written()
        result = materialize(stage(spark, docs, sf_dir), name)
        forget(spark, docs, *(p for p in written()[:-1] if p not in before))
        docs = result
    return STAGES[-1][1](spark, docs, sf_dir)
