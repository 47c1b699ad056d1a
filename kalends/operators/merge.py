"""Merging a batch into stored tables. Tables are immutable; each function returns the table's next version."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coalesce_merge(old: DataFrame, new: DataFrame, key: list[str], first_seen: str | None = None) -> DataFrame:
    """Upsert in which each column takes the new value unless it is null; ``first_seen`` keeps the old one."""
    columns = [c for c in old.columns if c not in key]
    joined = old.select(*key, F.struct(*columns).alias("_old")).join(new.select(*key, F.struct(*columns).alias("_new")), key, "full_outer")
    pick = lambda c: F.coalesce(F.col("_old")[c], F.col("_new")[c]) if c == first_seen else F.coalesce(F.col("_new")[c], F.col("_old")[c])
    return joined.select(*key, *(pick(c).alias(c) for c in columns))


# What a stored event keeps, whatever a source reports anew.
STORED = ("event_id", "canonical_id", "link_dead_at", "stock_image_url", "stock_attribution", "stock_attempted_at")
CLASSIFIED = ("category", "category_tier", "category_confidence", "tags")


def upsert_events(old: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Next version of the event table from one run's rows, with ``_change`` (new, changed, url, same, absent).

    Rows: source, source_event_id, url, title, image_url, image_credit, basis (the hash of all that counts but the
    url), first_seen_at, last_seen_at. Equal basis and url: only last_seen_at moves. Equal basis, other url: the url
    moves, too, and it counts as no change. Other basis: everything is replaced, but a missing image keeps the old
    one, and the credit follows only a new image. Category and tags follow the newest classification that decided, but
    for verdicts of the retired tier, which hold until the event changes; ids, heads and what checks have found stay.
    ``new`` has one row for each key; :func:`last_of_run` makes it so."""
    key = ["source", "source_event_id"]
    o, n = F.col("_old"), F.col("_new")
    fields = [c for c in old.columns if c not in key]
    joined = old.select(*key, F.struct(*fields).alias("_old")).join(new.select(*key, F.struct(*[c for c in new.columns if c not in key]).alias("_new")), key, "full_outer")
    same, same_url = o["basis"] == n["basis"], o["url"].eqNullSafe(n["url"])
    change = F.when(n.isNull(), "absent").when(o.isNull(), "new").when(same & same_url, "same").when(same, "url").otherwise("changed")
    joined = joined.withColumn("_change", change)
    fresh = F.col("_change").isin("new", "changed")

    def value(c: str) -> Column:
        if c == "first_seen_at":
            return F.coalesce(o[c], now)
        if c == "last_seen_at":
            return F.when(n.isNull(), o[c]).otherwise(now)
        if c == "image_url":
            return F.when(fresh, F.coalesce(n[c], o[c])).otherwise(o[c])
        if c == "image_credit":
            return F.when(fresh & n["image_url"].isNotNull(), n[c]).otherwise(o[c])
        if c == "url":
            return F.when(n.isNotNull(), n[c]).otherwise(o[c])
        if c in STORED:
            return F.when(o.isNotNull(), o[c]).otherwise(n[c])
        if c in CLASSIFIED and set(CLASSIFIED) <= set(fields):
            decided = n["category_tier"].isNotNull() & (n["category_tier"] != "fallback_other")
            return F.when(o.isNull() | (decided & ((o["category_tier"] != "llm") | fresh)), n[c]).otherwise(o[c])
        return F.when(fresh, n[c]).otherwise(o[c])

    return joined.select(*key, *(value(c).alias(c) for c in fields), "_change")


def last_of_run(new: DataFrame, key: list[str], arrival: str) -> DataFrame:
    """One row for each key: the last to arrive, with the last image that came along."""
    w = Window.partitionBy(*key).orderBy(arrival).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = Window.partitionBy(*key).orderBy(F.desc(arrival))
    image = F.last(F.when(F.col("image_url").isNotNull(), F.struct("image_url", "image_credit")), ignorenulls=True).over(w)
    out = new.withColumn("_image", image).withColumn("_n", F.row_number().over(last)).where("_n = 1")
    return out.withColumns({"image_url": F.col("_image.image_url"), "image_credit": F.col("_image.image_credit")}).drop("_n", "_image")


def reconcile(occurrences: DataFrame, reported: DataFrame, complete: bool) -> DataFrame:
    """Drop slots (event_id, starts_at_utc) that a complete run no longer reports for the events it saw."""
    if not complete:
        return occurrences
    seen = reported.select("event_id").distinct()
    kept = occurrences.join(reported.select("event_id", "starts_at_utc").distinct(), ["event_id", "starts_at_utc"], "left_semi")
    return occurrences.join(seen, "event_id", "left_anti").unionByName(kept)


def cascade(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """Delete events (event_id) and all that hangs on them: occurrences, merged sources, aliases on either side."""
    ids = gone.select("event_id").distinct()
    anti = lambda df, c: df.join(ids.withColumnRenamed("event_id", c), c, "left_anti").select(df.columns)
    keys = {"events": ["event_id"], "occurrences": ["event_id"], "merged_sources": ["canonical_id"], "aliases": ["alias_id", "canonical_id"]}
    return {name: reduce(anti, keys.get(name, []), df) for name, df in tables.items()}


def last_occurrence(events: DataFrame, occurrences: DataFrame) -> DataFrame:
    """(event_id, last_date): the last nightlife date, or the day an event was last seen if it has no occurrence."""
    last = occurrences.groupBy("event_id").agg(F.max("nightlife_date").alias("_last"))
    return events.join(last, "event_id", "left").select("event_id", F.coalesce("_last", F.to_date("last_seen_at")).alias("last_date"))


def past(events: DataFrame, occurrences: DataFrame, as_of: Column, keep_days: int = 2) -> DataFrame:
    """Events over for more than keep_days."""
    return last_occurrence(events, occurrences).where(F.col("last_date") < F.date_sub(as_of, keep_days)).select("event_id")


def heal_orphans(events: DataFrame) -> DataFrame:
    """An event whose head no longer exists is its own head again."""
    heads = events.select(F.col("event_id").alias("canonical_id"), F.lit(True).alias("_there")).distinct()
    return events.join(heads, "canonical_id", "left").withColumn("canonical_id", F.when(F.col("_there"), F.col("canonical_id")).otherwise(F.col("event_id"))).select(events.columns)


def changed_pages(pages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Pages (url, lastmod) not in the ledger (url, lastmod), or there with another lastmod, newest first."""
    joined = pages.join(ledger.select("url", F.col("lastmod").alias("_was"), F.lit(True).alias("_known")), "url", "left")
    return joined.where(F.col("_known").isNull() | ~F.col("lastmod").eqNullSafe(F.col("_was"))).select(pages.columns).orderBy(F.desc_nulls_last("lastmod"), "url")
