"""The published feed: window, projection, list rows, details, manifest, and what a publish does to a bucket."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalends.config import LABELS, LIST_FIELDS, PLACEHOLDER_WORDS, RECORD_HOSTS, SCHEMA_VERSION, SLOT_FIELDS, Settings
from kalends.functions import ids, text

GRACE_S, KEEP = 48 * 3600, 0.5
# How long caches may keep what never changes, and the manifest; size of stand-in pictures.
FOREVER = "public, max-age=31536000, immutable"
MOMENT = "public, max-age=0, s-maxage=300, stale-while-revalidate=3600"
SIZE = (640, 360)


def window(events: DataFrame, occurrences: DataFrame, city: str, as_of: Column, days: int) -> DataFrame:
    """Slots of living heads, not online, whose night lies in the window."""
    heads = events.where((F.col("city") == city) & (F.col("canonical_id") == F.col("event_id")) & F.col("link_dead_at").isNull() & (F.coalesce("attendance_mode", F.lit("")) != "online"))
    return heads.join(occurrences.where(F.col("nightlife_date").between(as_of, F.date_add(as_of, days))), "event_id")


def placeholder(event: Column, category: Column, provider: str | None) -> Column:
    """A stand-in picture that stays the same for an event; none without a provider."""
    if provider is None:
        return F.lit(None).cast("string")
    w, h = SIZE
    if provider == "picsum":
        return F.concat(F.lit("https://picsum.photos/seed/"), event, F.lit(f"/{w}/{h}"))
    words = F.create_map(*(F.lit(x) for kv in PLACEHOLDER_WORDS.items() for x in kv))
    return F.concat(F.lit(f"https://loremflickr.com/{w}/{h}/"), F.coalesce(F.try_element_at(words, category), F.lit(PLACEHOLDER_WORDS["other"])), F.lit("?lock="), ids.placeholder_lock(event).cast("string"))


def item(rows: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The publish projection of windowed, gated rows: one row a slot. Columns that a table does not have are null.

    A picture is the source's own if its policy allows, else a stock photo if these are on; who it is by follows the
    picture. Prose needs the policy, too; prose and titles lose contacts."""
    settings = settings or Settings("1970-01-01")
    have = lambda c, kind="string": F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    labels = F.create_map(*(F.lit(x) for kv in LABELS.items() for x in kv))
    title, prose = text.redact_contacts(F.col("title")), text.redact_contacts(F.when(F.col("description_ok"), F.col("description")))
    own = F.nullif(F.when(F.col("images_ok"), F.col("image_url")), F.lit(""))
    stock = have("stock_image_url") if settings.stock_photos else F.lit(None).cast("string")
    by = "struct<author:string,licence:string,licence_url:string,source:string>"
    credit = F.when(F.coalesce(have("image_credit"), F.lit("")) != "", F.struct(have("image_credit").alias("author"), *(F.lit(None).cast("string").alias(c) for c in ("licence", "licence_url", "source"))))
    credit = F.when(own.isNotNull(), credit).when(stock.isNotNull(), F.from_json(have("stock_attribution"), by))
    picture = F.coalesce(own, stock)
    record = F.coalesce(F.col("url").startswith(f"https://{RECORD_HOSTS[0]}"), F.lit(False))
    return rows.select(
        F.concat("event_id", F.lit("::"), "starts_at_utc").alias("id"), "event_id", have("city").alias("city"), title["text"].alias("title"), "category", F.coalesce(F.try_element_at(labels, "category"), F.lit("Other")).alias("category_label"), "tags",
        "starts_at_utc", have("starts_at_local").alias("starts_at_local"), have("ends_at_utc").alias("ends_at_utc"), have("doors_at_local").alias("doors_at_local"), "nightlife_date", F.coalesce(have("time_unknown", "boolean"), F.lit(False)).alias("time_unknown"),
        F.coalesce(have("is_range", "boolean"), F.lit(False)).alias("is_range"), have("range_start", "date").alias("range_start"), have("range_end", "date").alias("range_end"), F.when(F.col("status") != "scheduled", F.col("status")).otherwise(F.col("event_status")).alias("event_status"),
        have("venue_name").alias("venue_name"), have("address", "map<string,string>").alias("address"), F.when(F.col("lat").isNotNull(), F.struct("lat", "lon")).alias("geo"), have("price", "struct<type:string>").alias("price"),
        picture.alias("image_url"), credit.alias("image_attribution"), F.when(picture.isNull(), placeholder(F.col("event_id"), F.col("category"), settings.placeholders)).alias("placeholder_url"),
        "source", F.col("url").alias("source_url"), record.alias("source_is_record"), ids.series_key(F.col("url"), F.col("event_id")).alias("series_key"), have("first_seen_at", "timestamp").alias("first_seen_at"),
        have("category_tier").alias("category_tier"), prose["text"].alias("description"),
    )


def presentable(items: DataFrame) -> DataFrame:
    return items.where((F.trim("title") != "") & F.col("source_url").startswith("http"))


def details(items: DataFrame, aliases: DataFrame) -> DataFrame:
    """One detail object an event: canonical JSON (fields in name order, nulls kept) and its hash. The slots and
    aliases of one event are few."""
    slot = F.struct(*(c for c in SLOT_FIELDS if c in items.columns))
    slots = items.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct("starts_at_utc", slot.alias("slot")))).alias("_s"), F.min_by("description", "starts_at_utc").alias("description"))
    slots = slots.withColumn("occurrences", F.transform("_s", lambda x: x["slot"]))
    names = aliases.groupBy(F.col("canonical_id").alias("event_id")).agg(F.array_sort(F.collect_list("alias_id")).alias("aliases"))
    joined = slots.join(names, "event_id", "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    body = canonical(F.struct("aliases", "description", "event_id", "occurrences"))
    return joined.select("event_id", body.alias("body"), ids.short_hash(body).alias("h"))


def canonical(value: Column) -> Column:
    """JSON with the fields as declared (declare them in name order) and nulls kept: equal content, equal text."""
    return F.to_json(value, {"ignoreNullFields": "false"})


@F.pandas_udf(T.BinaryType())
def packed(body: pd.Series) -> pd.Series:
    """Gzip without a time stamp: equal content, equal bytes."""
    return body.map(lambda x: None if x is None else gzip.compress(x.encode(), mtime=0))


def list_rows(items: DataFrame, detail: DataFrame) -> DataFrame:
    """The list's fields of every item, with the hash of its detail object, by start and id."""
    rows = items.join(detail.select("event_id", "h"), "event_id")
    return rows.select(*(c for c in LIST_FIELDS if c in rows.columns)).orderBy(F.coalesce("starts_at_utc", F.lit("")), "id")


def days(items: DataFrame) -> DataFrame:
    return items.groupBy("nightlife_date").agg(F.countDistinct("event_id").alias("n_events")).orderBy("nightlife_date")


def categories(items: DataFrame) -> DataFrame:
    return items.groupBy("category").agg(F.countDistinct("event_id").alias("n_events")).orderBy(F.desc("n_events"), "category")


def _whole(rows: DataFrame, name: str) -> DataFrame:
    """One object of all rows in order: a city's window, which holds some ten thousand rows however long the store."""
    fields = sorted(c for c in rows.columns if c not in ("starts_at_utc", "id"))
    row = canonical(F.struct(*sorted([*fields, "starts_at_utc", "id"])))
    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce("starts_at_utc", F.lit("")).alias("k"), F.col("id").alias("i"), row.alias("row"))))
    one = rows.agg(F.concat(F.lit("["), F.array_join(F.transform(ordered, lambda x: x["row"]), ","), F.lit("]")).alias("body"), F.count("*").alias("count"))
    h = ids.short_hash(F.col("body"))
    return one.select(F.concat(F.lit(f"{name}."), h, F.lit(".json.gz")).alias("key"), "body", h.alias("hash"), "count")


def objects(items: DataFrame, detail: DataFrame) -> DataFrame:
    """(key, body) of the objects of a publish but the manifest: the list, the rows with a place, a detail for each
    event. Names carry the content's hash, so equal content is never sent twice."""
    rows = list_rows(items, detail)
    lists = _whole(rows, "feed").unionByName(_whole(rows.where("geo is not null") if "geo" in rows.columns else rows.limit(0), "geo"))
    return lists.select("key", "body").unionByName(detail.select(F.concat(F.lit("events/"), "event_id", F.lit("."), "h", F.lit(".json.gz")).alias("key"), "body"))


def credits(items: DataFrame, policies: DataFrame) -> DataFrame:
    """How each source of the feed is credited; a row a source."""
    known = policies.select("source", "name", F.col("homepage").alias("url"), "access", "licence", "licence_url", "terms_url", "attribution")
    return items.select("source").distinct().join(F.broadcast(known), "source").orderBy("source")


def manifest(items: DataFrame, detail: DataFrame, aliases: DataFrame, policies: DataFrame, settings: Settings, generated_at: str) -> DataFrame:
    """(key, body) of the manifest, one row: what a publish holds, by name, day, category and source."""
    rows = list_rows(items, detail)
    entry = lambda df: df.select(F.struct(F.col("key").alias("url"), "hash", "count").alias("x"))
    pack = lambda df, key, *value: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), *value)))).alias("x"))
    day = days(rows).agg(F.array_sort(F.collect_list(F.struct(F.col("nightlife_date").alias("date"), F.col("n_events").alias("count")))).alias("x"))
    kinds = categories(rows).join(rows.groupBy("category").agg(F.min("category_label").alias("label")), "category")
    kinds = kinds.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n_events")).alias("n"), "category", "label"))), lambda x: F.struct(x["category"].alias("category"), x["label"].alias("label"), (-x["n"]).alias("count"))).alias("x"))
    source = credits(items, policies)
    credited = source.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source", "attribution"))), lambda x: x["attribution"]), "; ").alias("names"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("source").alias("k"), F.struct("name", "url", "access", "licence", "licence_url", "terms_url", "attribution").alias("v"))))).alias("sources"))
    link = "Every item links to its original listing."
    line = F.when(F.col("names") != "", F.concat("names", F.lit(f". {link}"))).otherwise(F.lit(link))
    parts = {"feed": entry(_whole(rows, "feed")), "geo": entry(_whole(rows.where("geo is not null"), "geo")), "days": day, "categories": kinds, "aliases": pack(aliases.select("alias_id", "canonical_id").distinct(), "alias_id", F.col("canonical_id").alias("v"))}
    whole = credited.select(line.alias("attribution"), "sources")
    for name, df in parts.items():
        whole = whole.join(df.select(F.col("x").alias(name)))  # one row with one row
    upto = F.date_add(F.lit(settings.as_of).cast("date"), settings.window_days)
    window_ = F.struct(F.lit(settings.as_of).alias("from"), F.date_format(upto, "yyyy-MM-dd").alias("to"))
    body = canonical(F.struct("aliases", "attribution", "categories", F.lit(settings.city).alias("city"), "days", "feed", F.lit(generated_at).alias("generated_at"), "geo", F.lit(SCHEMA_VERSION).alias("schema_version"), "sources", window_.alias("window")))
    return whole.select(F.lit("manifest.json").alias("key"), body.alias("body"))


def metadata(key: Column) -> Column:
    """struct(content_type, content_encoding, cache_control) of an object; packed ones have the type of what they hold."""
    zipped = key.endswith(".gz")
    kind = F.when(F.regexp_replace(key, r"\.gz$", "").endswith(".html"), "text/html").otherwise("application/json")
    return F.struct(kind.alias("content_type"), F.when(zipped, "gzip").alias("content_encoding"), F.when(key.endswith("manifest.json"), MOMENT).otherwise(FOREVER).alias("cache_control"))


def kind(key: Column) -> Column:
    """What an object is, by its name."""
    detail = key.contains("/events/") | key.startswith("events/")
    name = F.element_at(F.split(key, "/"), -1)
    return F.when(detail & key.endswith(".json.gz"), "event_objects").when(detail & key.endswith(".json"), "legacy_event_objects").when(name.startswith("feed."), "feeds").when(name.startswith("geo."), "geo").otherwise("other")


def to_send(named: DataFrame, existing: DataFrame) -> DataFrame:
    """Objects to upload: those whose name is not there yet; the manifest always goes, and last (``phase`` 1)."""
    manifest_ = F.col("key").endswith("manifest.json")
    fresh = named.where(~manifest_).join(existing.select("key"), "key", "left_anti").unionByName(named.where(manifest_))
    return fresh.withColumn("phase", F.when(manifest_, 1).otherwise(0))


def superseded(local: DataFrame, named: DataFrame) -> DataFrame:
    """Objects of earlier exports that the new one no longer names."""
    hashed = F.col("key").rlike(r"(^|/)(feed|geo)\.[^/]*\.json\.gz$") | F.col("key").rlike(r"(^|/)events/[^/]*\.json\.gz$")
    return local.where(hashed).join(named.select("key"), "key", "left_anti")


def taken_down(existing: DataFrame, events: DataFrame) -> DataFrame:
    """Detail objects of events (event_id) that may not be published any more; they go at once."""
    own = existing.withColumn("event_id", F.regexp_extract("key", r"(?:^|/)events/([^./]+)\.", 1))
    return own.join(events.select("event_id").distinct(), "event_id", "left_semi").select(existing.columns)


def to_purge(existing: DataFrame, named: DataFrame) -> DataFrame:
    """(refused, live, missing, then counts by kind): what a purge of all unnamed objects would delete, in one row. It is
    refused if a named object is missing or the feed is empty."""
    there, want = existing.select("key").distinct(), named.select("key").distinct()
    doomed = there.join(want, "key", "left_anti").agg(*(F.count_if(kind(F.col("key")) == k).alias(k) for k in ("event_objects", "legacy_event_objects", "feeds", "geo", "other")))
    missing = want.join(there, "key", "left_anti").agg(F.count("*").alias("missing"))
    live = want.agg(F.count("*").alias("live"))
    refused = F.when(F.col("missing") > 0, "named objects are missing").when(F.col("live") <= 3, "the feed is empty")
    return live.join(missing).join(doomed).select(refused.alias("refused"), "*")  # three single rows


def delisted(ledger: DataFrame, existing: DataFrame, keep: DataFrame, now_s: Column) -> DataFrame:
    """Next ledger (key, since_s) with ``expired``: keys there but no longer named, stamped when first missing; keys
    that came back or are gone leave it; unreadable stamps start anew; 48 hours later a key may be deleted."""
    missing = existing.select("key").join(keep.select("key"), "key", "left_anti")
    since = F.coalesce("since_s", now_s)
    return missing.join(ledger, "key", "left").select("key", since.alias("since_s"), (since < now_s - GRACE_S).alias("expired"))


def unsafe(count: int | None, previous: int | None, local: int, existing: int) -> str | None:
    """Why nothing may be deleted now, or None."""
    if count is None:
        return "the manifest has no count"
    if not count:
        return "the feed is empty"
    if previous:
        return f"the feed holds {count} events against {previous} before" if count < previous * KEEP else None
    return f"{local} objects against {existing} in the bucket" if existing and local < existing * KEEP else None


def audit(published: DataFrame, claimed: int, objects: DataFrame | None = None, examples: int = 5) -> DataFrame:
    """One row: rows claimed and found, rows whose text still holds a contact and the first of them by id, and how many
    ``objects`` (key, body) there are, of what kind, and with a contact."""
    held = text.contains_contact(F.col("title")) | F.coalesce(text.contains_contact(F.col("description")), F.lit(False))
    marked = published.select("id" if "id" in published.columns else F.col("title").alias("id"), held.alias("held"))
    rows = marked.agg(F.lit(claimed).alias("claimed"), F.count("*").alias("found"), F.count_if("held").alias("with_contact"))
    first = marked.where("held").orderBy("id").limit(examples).agg(F.array_sort(F.collect_list("id")).alias("examples"))
    rows = rows.join(first)
    if objects is None:
        return rows
    texts = F.concat_ws("\n", F.get_json_object("body", "$.title"), F.get_json_object("body", "$.description"))
    kinds = objects.select(kind(F.col("key")).alias("k"), text.contains_contact(texts).alias("held"))
    return rows.join(kinds.agg(F.count("*").alias("objects"), F.count_if("held").alias("objects_with_contact"), F.count_if(F.col("k") == "event_objects").alias("event_objects")))


def redacted(rows: DataFrame) -> DataFrame:
    """How many gated rows held a contact in title or description, whether or not the description is published."""
    held = text.contains_contact(F.col("title")) | F.coalesce(text.contains_contact(F.col("description")), F.lit(False))
    return rows.agg(F.count_if(held).alias("n_redacted"))
