"""Listings made from the driver's tables by rule, the same for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends.config import SOURCE_PRIORITY
from kalends.functions import dates

SOURCES = list(SOURCE_PRIORITY)[:9]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing(spark: SparkSession, sf_dir: str, *dims: str) -> DataFrame:
    """events as listings; ``dims`` adds title (part), venue (supplier), url (pages) or description (documents), each
    by the event's number modulo the dimension's size. Dimensions join on a key, so none is met with every row."""
    ev = table(spark, sf_dir, "events")
    local = F.col("ts") + F.expr("INTERVAL 1 HOUR")
    names = F.array(*map(F.lit, SOURCES))
    out = ev.select(
        "event_id",
        "user_id",
        F.get(names, (F.col("user_id") % 9).cast("int")).alias("source"),
        F.col("event_type").alias("category"),
        "value",
        F.col("ts").alias("start_utc"),
        local.alias("local"),
        dates.nightlife_date(local).alias("nightlife_date"),
        (F.col("event_id") - F.col("event_id") % 3).alias("canonical_id"),
        (52.4 + (F.col("user_id") % 1000) * 0.0005).alias("lat"),
        (13.0 + (F.col("user_id") % 1000) * 0.001).alias("lon"),
    )
    joins = {
        "title": ("part", "p_partkey", "event_id", F.concat_ws(" ", "p_name", "p_type")),
        "venue": ("supplier", "s_suppkey", "user_id", F.col("s_name")),
        "url": ("pages", "page_id", "event_id", F.col("url")),
        "description": ("documents", "doc_id", "event_id", F.col("text")),
    }
    for dim in dims:
        name, key, by, value = joins[dim]
        d = table(spark, sf_dir, name).select(F.col(key).alias(f"_{dim}"), value.alias(dim))
        size = d.agg((F.max(f"_{dim}") + 1).alias("n")).first()["n"]  # one number; keys are dense from 0
        out = out.withColumn(f"_{dim}", F.col(by) % F.lit(size)).join(d, f"_{dim}").drop(f"_{dim}")
    return out


#: The same listings for DuckDB.
LISTING_SQL = f"""
ev AS (SELECT event_id, user_id, list_extract({SOURCES!r}, 1 + CAST(user_id % 9 AS INTEGER)) AS source, event_type AS category, value,
         ts AS start_utc, ts + INTERVAL 1 HOUR AS local, CAST(ts + INTERVAL 1 HOUR - INTERVAL 6 HOUR AS DATE) AS nightlife_date,
         event_id - event_id % 3 AS canonical_id, CAST(52.4 AS DOUBLE) + (user_id % 1000) * CAST(0.0005 AS DOUBLE) AS lat, CAST(13.0 AS DOUBLE) + (user_id % 1000) * CAST(0.001 AS DOUBLE) AS lon FROM events),
listing AS (SELECT ev.*, p.p_name || ' ' || p.p_type AS title, s.s_name AS venue, g.url, d.text AS description FROM ev
  JOIN part p ON p.p_partkey = ev.event_id % (SELECT max(p_partkey) + 1 FROM part)
  JOIN supplier s ON s.s_suppkey = ev.user_id % (SELECT max(s_suppkey) + 1 FROM supplier)
  JOIN pages g ON g.page_id = ev.event_id % (SELECT max(page_id) + 1 FROM pages)
  JOIN documents d ON d.doc_id = ev.event_id % (SELECT max(doc_id) + 1 FROM documents))
"""
