"""Stock photos for events without a picture: which queries to ask, which answers count, and who gets which photo."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.config import LABELS
from kalends.functions import text
from kalends.operators.select import retry_due
from kalends.sources.records import plain

# How many events a run looks up, after how many days it tries again, and the last resort's words.
BUDGET, RETRY_DAYS, LAST_RESORT = 1_000, 14, "party celebration event"
MIME = ["image/jpeg", "image/png", "image/webp"]
PHOTO = "struct<url:string,author:string,license:string,license_url:string,source:string>"


def candidates(events: DataFrame, now: Column, budget: int = BUDGET) -> DataFrame:
    """Events (event_id, first_seen_at, image_url, stock_image_url, stock_attempted_at) to look up: without a picture,
    due, newest first, one run's budget."""
    bare = (F.coalesce("image_url", F.lit("")) == "") & F.col("stock_image_url").isNull()
    return events.where(bare & retry_due(F.col("stock_attempted_at"), now, RETRY_DAYS, inclusive=False)).orderBy(F.desc("first_seen_at"), "event_id").limit(budget)


def queries(title: Column, category: Column, venue: Column, extra: dict[str, list[str]] | None = None) -> Column:
    """Search terms from specific to broad, each once."""
    label = F.try_element_at(F.create_map(*(F.lit(x) for kv in LABELS.items() for x in kv)), category)
    more = F.lit(None).cast("array<string>")
    if extra:
        more = F.try_element_at(F.create_map(*(x for k, v in extra.items() for x in (F.lit(k), F.array(*map(F.lit, v))))), category)
    terms = F.concat(F.array(F.concat_ws(" ", label, title), label, venue), F.coalesce(more, F.array().cast("array<string>")), F.array(category, F.lit(LAST_RESORT)))
    return F.array_distinct(F.filter(terms, lambda x: F.coalesce(x, F.lit("")) != ""))


def answers(pages: DataFrame) -> DataFrame:
    """(query, rank, photo) from landed answers: query, index, mime, thumburl, url, artist, license, license_url,
    descriptionurl. Pictures of allowed kinds, by the answer's own index, without tracking."""
    credit = lambda c: F.nullif(plain(F.col(c)), F.lit(""))
    url = text.without_query(F.coalesce(F.nullif("thumburl", F.lit("")), F.nullif("url", F.lit(""))))
    named = credit("artist").isNotNull() | credit("license").isNotNull()
    photo = F.struct(url.alias("url"), credit("artist").alias("author"), credit("license").alias("license"), F.when(named, credit("license_url")).alias("license_url"), F.when(named, F.col("descriptionurl")).alias("source")).cast(PHOTO)
    return pages.where(F.col("mime").isin(MIME)).select("query", F.coalesce("index", F.lit(99)).alias("rank"), photo.alias("photo")).where("photo.url is not null")


def ranked(events: DataFrame, found: DataFrame, extra: dict[str, list[str]] | None = None) -> DataFrame:
    """(event_id, place, photo): an event's candidates in the order of its queries and of each answer."""
    asked = events.select("event_id", F.posexplode(queries(F.col("title"), F.col("category"), F.col("venue_name"), extra)).alias("step", "query"))
    return asked.join(found, "query").select("event_id", F.struct("step", "rank", F.col("photo.url").alias("url")).alias("place"), "photo")


def assign(rows: DataFrame, claimed: DataFrame) -> DataFrame:
    """(event_id, photo): in order of event_id each takes its first candidate that nobody has; if all are taken, one of
    its candidates chosen by a hash of the id.

    Each choice depends on those before it, so this runs in one task; its input is one run's budget of lookups, at most
    1,000 events of a few dozen candidates, and the claims on these candidates only."""
    urls = rows.select(F.col("photo.url").alias("url")).distinct()
    taken = claimed.select("url").distinct().join(urls, "url", "left_semi")
    one = rows.select("event_id", "place", "photo", F.lit(None).cast("string").alias("claim")).unionByName(taken.select(F.col("url").alias("claim")), allowMissingColumns=True)

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        claims = set(pdf["claim"].dropna())
        out = []
        for event, own in pdf[pdf["claim"].isna()].sort_values("event_id").groupby("event_id", sort=False):
            order = [p for _, p in sorted(zip(own["place"], own["photo"]), key=lambda x: (x[0]["step"], x[0]["rank"], x[0]["url"]))]
            free = next((p for p in order if p["url"] not in claims), None)
            chosen = free or order[int(hashlib.sha1(event.encode()).hexdigest()[:8], 16) % len(order)]
            claims.add(chosen["url"])
            out.append((event, chosen))
        return pd.DataFrame(out, columns=["event_id", "photo"])

    return one.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(greedy, f"event_id string, photo {PHOTO}")
