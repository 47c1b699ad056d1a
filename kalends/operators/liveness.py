"""Liveness of links and images: the strike machine as one fold, and what follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.operators.resolve import priority

# Statuses that mean gone, strikes that kill, and the least time between two strikes.
DEAD, KILL, GAP_S = (404, 410), 2, 20 * 3600


def strike(strikes: Column, last: Column, status: Column, at: Column) -> tuple[Column, Column]:
    """(strikes, last strike in seconds) after a probe: gone adds a strike, but a second one only after 20 hours; an
    answer below 400 clears; anything else changes nothing."""
    gone = F.coalesce(status.isin(*DEAD), F.lit(False))
    alive = F.coalesce(status < 400, F.lit(False))
    later = (strikes == 0) | last.isNull() | (at - last >= GAP_S)
    first = (strikes == 0) | last.isNull()
    n = F.when(gone & first, 1).when(gone & later, strikes + 1).when(gone, strikes).when(alive, 0).otherwise(strikes)
    t = F.when(gone & later, at).when(gone, last).when(alive, F.lit(None).cast("long")).otherwise(last)
    return n.cast("int"), t.cast("long")


def fold_probes(state: DataFrame, probes: DataFrame) -> DataFrame:
    """State (url, strikes, last_status, last_checked_s, last_strike_s) after probes (url, checked_s, status, n), in
    order of (checked_s, n). A url's probes of one batch meet in its row; a batch holds few of each."""
    grouped = probes.groupBy("url").agg(F.sort_array(F.collect_list(F.struct("checked_s", "n", "status"))).alias("_p"))
    joined = state.join(grouped, "url", "full_outer")
    zero = F.struct(F.coalesce("strikes", F.lit(0)).alias("strikes"), F.col("last_strike_s").cast("long").alias("last"))

    def step(acc: Column, p: Column) -> Column:
        n, t = strike(acc["strikes"], acc["last"], p["status"], p["checked_s"])
        return F.struct(n.alias("strikes"), t.alias("last"))

    after = F.aggregate(F.coalesce("_p", F.array().cast("array<struct<checked_s:bigint,n:bigint,status:int>>")), zero, step)
    newest = F.element_at("_p", -1)
    return joined.withColumn("_after", after).select("url", F.col("_after.strikes").alias("strikes"), F.when(newest.isNotNull(), newest["status"]).otherwise(F.col("last_status")).alias("last_status"), F.coalesce(newest["checked_s"], "last_checked_s").alias("last_checked_s"), F.col("_after.last").alias("last_strike_s"))


def kill(events: DataFrame, state: DataFrame, now: Column) -> DataFrame:
    """All events with a url of two strikes die, in every city."""
    dead = state.where(F.col("strikes") >= KILL).select("url", F.lit(True).alias("_dead"))
    return events.join(dead, "url", "left").withColumn("link_dead_at", F.when(F.col("_dead"), F.coalesce("link_dead_at", now)).otherwise(F.col("link_dead_at"))).select(events.columns)


def kill_linkless(events: DataFrame, now: Column) -> DataFrame:
    """Living heads whose link never was one die."""
    bare = (F.col("canonical_id") == F.col("event_id")) & F.col("link_dead_at").isNull() & ~F.coalesce(F.col("url").startswith("http"), F.lit(False))
    return events.withColumn("link_dead_at", F.when(bare, now).otherwise(F.col("link_dead_at")))


def promote(events: DataFrame) -> DataFrame:
    """Clusters whose head is dead get their best living member as the head of all, dead ones included."""
    dead_heads = events.where((F.col("event_id") == F.col("canonical_id")) & F.col("link_dead_at").isNotNull()).select("canonical_id")
    living = events.where(F.col("link_dead_at").isNull()).join(dead_heads, "canonical_id", "left_semi")
    best = living.groupBy("canonical_id").agg(F.min_by("event_id", F.struct(priority(F.col("source")), "event_id")).alias("_head"))
    return events.join(best, "canonical_id", "left").withColumn("canonical_id", F.coalesce("_head", "canonical_id")).select(events.columns)


def image_verdict(status: Column, content_type: Column) -> Column:
    """Gone, or not a picture."""
    return F.coalesce(status.isin(*DEAD), F.lit(False)) | F.coalesce((status < 400) & (content_type != "") & ~F.lower(content_type).startswith("image/"), F.lit(False))
