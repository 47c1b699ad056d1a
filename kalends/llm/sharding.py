"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

How many rows each input partition sends to each shard is drawn first: row i of the matrix is a multivariate
hypergeometric draw of the partition's rows from what the shards still lack. Each partition then permutes its rows
and deals them out by its row of the matrix, and each shard permutes what it got. Given the matrix, both permutations
are uniform, so every arrangement of the rows is equally likely, and shard sizes are exact by construction.

The matrix is drawn in two levels: the driver draws for groups of 1,024 partitions, and a task draws for the
partitions of one group. A shard's permutation is a sort by a random key, cut into buckets of about `BUCKET` rows, so
no task holds a whole shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SHARDS, SEED, GROUP, BUCKET = 24, 7_919, 1_024, 10_000


def _large(rng: np.random.Generator, m: int, rest: int, n: int) -> int:
    """How many of n rows drawn from m + rest are of the m, by inversion: probabilities follow from the ratios of
    neighbours, over 12 standard deviations around the mean (what lies beyond is under 1e-30)."""
    t = m + rest
    mean, sd = n * m / t, (n * m / t * (rest / t) * ((t - n) / max(t - 1, 1))) ** 0.5
    low, high = max(n - rest, 0, int(mean - 12 * sd) - 50), min(m, n, int(mean + 12 * sd) + 50)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(m - k) + np.log(n - k) - np.log(k + 1) - np.log(rest - n + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    sums = np.cumsum(np.exp(logs - logs.max()))
    return low + min(int(np.searchsorted(sums, rng.random() * sums[-1], side="right")), high - low)


def draw(rng: np.random.Generator, lacking: np.ndarray, n: int) -> np.ndarray:
    """One row of the matrix: n rows dealt over shards that lack so many, each a hypergeometric draw; from
    1e9 rows on, where numpy has none, by `_large`."""
    out = np.zeros(len(lacking), np.int64)
    rest = int(lacking.sum())
    for j, m in enumerate(map(int, lacking)):
        rest -= m
        if not n:
            break
        if m + rest < 1_000_000_000:
            got = int(rng.hypergeometric(m, rest, n)) if m and rest else min(m, n)
        else:
            got = _large(rng, m, rest, n)
        out[j] = got = min(max(got, n - rest, 0), m, n)
        n -= got
    return out


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shuffle the rows of ``docs`` (doc_id, text) over ``shards``: doc_id, size, text_crc32, partition, shard, slot.

    size is the UTF-8 length of the text plus 8; a null text counts as empty. Shards differ by one row at most, slots
    of a shard run from 0 without gaps, and the order is a uniform shuffle for ``seed``. Null doc_ids and repeated
    rows are rows like any other; an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.spark_partition_id().alias("partition"),
            F.rand(seed).alias("u"),
        ),
        "rows",
    )
    counts = materialize(rows.groupBy("partition").agg(F.count("*").alias("n")).withColumn("part", F.expr(f"partition div {GROUP}").cast("long")), "counts")
    totals = {r["part"]: r["n"] for r in counts.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # a row for 1,024 partitions
    n = sum(totals.values())
    lacking = np.array([n // shards + (j < n % shards) for j in range(shards)], np.int64)
    rng, level = np.random.default_rng(seed), {}
    for part in sorted(totals):
        level[part] = draw(rng, lacking, totals[part])
        lacking = lacking - level[part]

    def matrix(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        mine, own = level[int(key[0])], np.random.default_rng([seed, int(key[0])])
        pdf, out = pdf.sort_values("partition"), []
        for k in pdf["n"]:
            out.append(draw(own, mine, int(k)))
            mine = mine - out[-1]
        return pd.DataFrame({"partition": pdf["partition"].astype("int32"), "upto": [list(map(int, np.cumsum(x))) for x in out]})

    upto = counts.groupBy("part").applyInPandas(matrix, "partition int, upto array<long>")
    local = F.row_number().over(Window.partitionBy("partition").orderBy("u", "doc_id", "text_crc32", "size")) - 1
    dealt = (
        rows.withColumn("at", local)
        .join(upto, "partition")
        .select("doc_id", "size", "text_crc32", "partition", F.size(F.filter("upto", lambda x: x <= F.col("at"))).alias("shard"), F.xxhash64(F.lit(seed), "partition", "at").alias("v"))
    )
    buckets = max(1, -(-n // (shards * BUCKET)))
    dealt = materialize(dealt.withColumn("bucket", F.pmod(F.shiftright("v", 16), F.lit(buckets)).cast("int")), "dealt")
    sizes = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    row = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("v", "doc_id", "text_crc32", "size")) - 1
    return (
        dealt.withColumn("row", row)
        .join(before, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "partition", "shard", (F.col("before") + F.col("row")).alias("slot"))
    )
