"""Choosing what to fetch or check: budgets, caps, breakers, due sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalends.config import NO_IMAGE_SCAN, NO_LINK_CHECK, SELF_LISTING
from kalends.functions import text


def budgeted(items: DataFrame, host: str, order: list[Column], budget: int, per_host: int | None = None) -> DataFrame:
    """The first ``budget`` items in order, at most ``per_host`` of a host. Capping hosts first and then the whole
    is what the item-by-item loop does. The host's rank is cut before rows meet in one place: what reaches the last
    sort is at most the budget, chosen by partition first."""
    if per_host is not None:
        items = items.withColumn("_rank", F.row_number().over(Window.partitionBy(host).orderBy(*order))).where(F.col("_rank") <= per_host).drop("_rank")
    return items.orderBy(*order).limit(budget)


def outcome(status: Column) -> Column:
    """ok (200 to 399), blocked (403, 405, 429, 451) or other."""
    return F.when(status.between(200, 399), "ok").when(status.isin(403, 405, 429, 451), "blocked").otherwise("other")


def trips(requests: DataFrame, host: str, order: list[Column], kind: str, limit: int = 8) -> DataFrame:
    """(host, tripped_at): the number, from 1, of the request with which a host reached ``limit`` refusals in a row;
    an ok ends a row of refusals, anything else neither counts nor ends it. Hosts that never did are left out."""
    by = Window.partitionBy(host).orderBy(*order)
    numbered = requests.withColumn("_n", F.row_number().over(by)).withColumn("_ok", F.sum(F.when(F.col(kind) == "ok", 1).otherwise(0)).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    streak = numbered.withColumn("_streak", F.sum(F.when(F.col(kind) == "blocked", 1).otherwise(0)).over(Window.partitionBy(host, "_ok").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    return streak.where((F.col(kind) == "blocked") & (F.col("_streak") >= limit)).groupBy(host).agg(F.min("_n").alias("tripped_at"))


def source_health(requests: DataFrame, source: str, kind: str) -> DataFrame:
    """Outcome counts of each source, and whether it is blocked: refused at least once and never answered."""
    count = lambda k: F.count_if(F.col(kind) == k)
    return requests.groupBy(source).agg(count("ok").alias("n_ok"), count("blocked").alias("n_blocked"), count("other").alias("n_other")).withColumn("is_blocked", (F.col("n_blocked") > 0) & (F.col("n_ok") == 0))


def due(urls: DataFrame, checks: DataFrame, before: Column) -> DataFrame:
    """Distinct urls never checked or last checked before a moment; (url, last_checked_at), never checked first."""
    joined = urls.select("url").distinct().join(checks.select("url", "last_checked_at"), "url", "left")
    return joined.where(F.col("last_checked_at").isNull() | (F.col("last_checked_at") < before)).orderBy(F.asc_nulls_first("last_checked_at"), "url")


def retry_due(attempted: Column, now: Column, days: int, inclusive: bool) -> Column:
    """Due again after so many days; unreadable or missing stamps are due."""
    age = now - F.make_dt_interval(F.lit(days))
    return F.coalesce(attempted <= age if inclusive else attempted < age, F.lit(True))


def first_of_each(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def next_starts(events: DataFrame, occurrences: DataFrame, as_of: Column) -> DataFrame:
    """(url, next_start) of pages of events with a slot from ``as_of`` on, the next first."""
    slots = occurrences.where(F.col("nightlife_date") >= as_of).select("event_id", "starts_at_utc")
    return events.where(F.col("url").startswith("http")).select("event_id", "url").join(slots, "event_id").groupBy("url").agg(F.min("starts_at_utc").alias("next_start")).orderBy("next_start", "url")


def _elsewhere(url: Column, hosts: list[str]) -> Column:
    return ~text.under(text.hostname(url), hosts)


def links_due(events: DataFrame, occurrences: DataFrame, checks: DataFrame, as_of: Column, before: Column) -> DataFrame:
    """Links of living heads with a slot to come, of sources whose listing does not tell what is gone: never checked
    first, then by their last check before a moment."""
    heads = events.where((F.col("canonical_id") == F.col("event_id")) & F.col("link_dead_at").isNull() & ~F.col("source").isin(SELF_LISTING) & F.col("url").startswith("http"))
    urls = heads.where(_elsewhere(F.col("url"), NO_LINK_CHECK)).join(occurrences.where(F.col("nightlife_date") >= as_of).select("event_id").distinct(), "event_id", "left_semi").select("url")
    return due(urls, checks, before)


def images_due(events: DataFrame, occurrences: DataFrame, checks: DataFrame, as_of: Column, before: Column) -> DataFrame:
    """The same for pictures."""
    heads = events.where((F.col("canonical_id") == F.col("event_id")) & F.col("image_url").startswith("http"))
    urls = heads.join(occurrences.where(F.col("nightlife_date") >= as_of).select("event_id").distinct(), "event_id", "left_semi").select(F.col("image_url").alias("url"))
    return due(urls, checks, before)


def scans_due(events: DataFrame, occurrences: DataFrame, ledger: DataFrame, allowed: list[str], as_of: Column, now: Column) -> DataFrame:
    """Pages to look for a picture on: of heads without one, of sources that may show them, not looked at for a week."""
    heads = events.where((F.col("canonical_id") == F.col("event_id")) & (F.coalesce("image_url", F.lit("")) == "") & F.col("source").isin(allowed))
    pages = next_starts(heads, occurrences, as_of).where(_elsewhere(F.col("url"), NO_IMAGE_SCAN))
    seen = ledger.where("source = 'imgscan'").select("url", "last_seen_at")
    return pages.join(seen, "url", "left").where(retry_due(F.col("last_seen_at"), now, 7, inclusive=True)).select("url", "next_start").orderBy("next_start", "url")


def credits_due(events: DataFrame, occurrences: DataFrame, ledger: DataFrame, allowed: list[str], as_of: Column) -> DataFrame:
    """Pages whose picture was found before credits were read: scanned, not yet visited for the credit."""
    heads = events.where((F.col("canonical_id") == F.col("event_id")) & F.col("image_url").startswith("http") & (F.coalesce("image_credit", F.lit("")) == "") & F.col("source").isin(allowed))
    pages = next_starts(heads, occurrences, as_of).where(_elsewhere(F.col("url"), NO_IMAGE_SCAN))
    of = lambda kind: ledger.where(F.col("source") == kind).select("url").distinct()
    return pages.join(of("imgscan"), "url", "left_semi").join(of("imgcredit"), "url", "left_anti").orderBy("next_start", "url")


def blocked_sources(health: DataFrame, tripped: DataFrame) -> DataFrame:
    """Sources that were only refused, and those whose host gave up."""
    return health.where("is_blocked").select("source").unionByName(tripped.select("source")).distinct()


def first_per_source(rows: DataFrame, limit: int, order: list[Column]) -> DataFrame:
    """At most ``limit`` rows of each source, for a trial run."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("source").orderBy(*order))).where(F.col("_n") <= limit).drop("_n")
