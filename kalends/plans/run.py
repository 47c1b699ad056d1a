"""One run: raw records to the published feed, stage by stage. Tables come in and go out as DataFrames; a caller writes
each new version beside the old one and then moves a pointer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.config import SOURCE_PRIORS, Settings
from kalends.operators import classify, feed, gates, liveness, merge, resolve, select, upkeep, venues
from kalends.operators.graph import cut
from kalends.sources import events as canonical
from kalends.sources import records as readers

# Categories of the open lists.
OPEN_LISTS = {"strassen-volksfeste": "festivals", "weihnachtsmaerkte": "markets_fairs"}


def adapter_category(source: Column, raw: Column, url: Column) -> Column:
    """What a source's own category says, by the mapping of that source; null if it says nothing."""
    return (
        F.when(source == "kulturdaten", readers.looked_up(readers.CALENDAR_TAGS, raw))
        .when(source == "berlin_de", readers.looked_up(OPEN_LISTS, raw))
        .when(source == "vhs", readers.course_category(raw))
        .when(source == "ticketmaster", readers.ticket_category(F.substring_index(raw, "|", 1), F.regexp_extract(raw, r"^[^|]*\|(.*)$", 1)))
        .when(source == "eventbrite", readers.market_category(raw))
        .when(source == "rausgegangen", readers.path_category(url))
    )


def classified(events: DataFrame, schema_type: Column, source_prior: Column, mapped: Column, venue_prior: Column) -> DataFrame:
    """Category, tier, confidence and tags replaced where the cascade decides; else as stored."""
    found = classify.classify(F.col("title"), F.col("description"), schema_type, source_prior, mapped, venue_prior)
    df = events.withColumn("_c", found)
    new = {"category": "category", "category_tier": "tier", "category_confidence": "confidence", "tags": "tags"}
    return df.withColumns({c: F.when(F.col("_c").isNotNull(), F.col(f"_c.{f}")).otherwise(F.col(c)) for c, f in new.items()}).drop("_c")


def ingest(records: DataFrame, venue_index: DataFrame, settings: Settings, arrival: str = "arrival") -> tuple[DataFrame, DataFrame]:
    """(events, occurrences) of one run's raw records: normalised, one row a key (the last in the order of the column
    ``arrival``), venues resolved, classified."""
    if arrival not in records.columns:
        raise ValueError(f"records need a column {arrival!r} that orders them")
    events = cut(canonical.to_events(records.withColumn("_arrival", F.col(arrival)), settings))
    events = merge.last_of_run(events, ["source", "source_event_id"], "_arrival").drop("_arrival")
    found = venues.resolve(events.select("venue_name"), venue_index)
    events = events.join(found.withColumnRenamed("prior", "venue_prior"), "venue_name", "left")
    mapped = adapter_category(F.col("source"), F.col("category_raw"), F.col("url"))
    prior = readers.looked_up(SOURCE_PRIORS, F.col("source"))
    # written once here: all later stages read the table and not the parsing behind it
    events = cut(classified(events, F.col("schema_type"), prior, mapped, F.col("venue_prior")).withColumn("link_dead_at", F.lit(None).cast("timestamp")))
    return events.drop("occurrences", "venue_prior", "schema_type"), canonical.occurrences(events)


def propagate_images(events: DataFrame) -> DataFrame:
    """Events without a picture take that of another event with the same link, by source priority and id."""
    rank = F.struct(resolve.priority(F.col("source")), "event_id")
    given = events.where(F.coalesce("image_url", F.lit("")) != "").groupBy("url").agg(F.min_by(F.struct("image_url", "image_credit"), rank).alias("_i"))
    bare = F.coalesce("image_url", F.lit("")) == ""
    df = events.join(given, "url", "left")
    credit = F.when(bare & F.col("_i").isNotNull(), F.col("_i.image_credit")).otherwise(F.col("image_credit"))
    return df.withColumns({"image_credit": credit, "image_url": F.when(bare, F.col("_i.image_url")).otherwise(F.col("image_url"))}).select(events.columns)


def release_duplicate_photos(events: DataFrame) -> DataFrame:
    """A stock photo stays with the first event that has it."""
    first = select.first_of_each(events.where("stock_image_url is not null").select("event_id", "stock_image_url"), ["stock_image_url"], [F.col("event_id")])
    keep = first.select("event_id", F.lit(True).alias("_keep"))
    df = events.join(keep, "event_id", "left")
    return df.withColumn("stock_image_url", F.when(F.col("_keep"), F.col("stock_image_url"))).select(events.columns)


def store(old: dict[str, DataFrame], events: DataFrame, slots: DataFrame, settings: Settings, now: Column, complete: bool) -> dict[str, DataFrame]:
    """The store after a run's events and slots: events merged, slots of new and changed events entered, slots that a
    complete run no longer reports dropped, payloads of new and changed events appended. ``changes`` says what came of
    each event. Tables that ``old`` lacks start empty."""
    spark = events.sparkSession
    rows = events.withColumns({"first_seen_at": now, "last_seen_at": now, "stock_image_url": F.lit(None).cast("string")})
    kept = rows.drop("payload")
    changes = cut(merge.upsert_events(old["events"] if "events" in old else kept.limit(0), kept, now))
    fresh = changes.where("_change in ('new', 'changed')").select("event_id")
    stored = old["occurrences"] if "occurrences" in old else slots.limit(0)
    entered = slots.join(fresh, "event_id", "left_semi").select(stored.columns)
    merged = stored.join(entered.select("event_id", "starts_at_utc"), ["event_id", "starts_at_utc"], "left_anti").select(stored.columns).unionByName(entered)
    told = changes.join(rows.select("source", "source_event_id", "description", "description_public", "payload").withColumnsRenamed({"description": "_d", "description_public": "_p"}), ["source", "source_event_id"])
    appended = upkeep.snapshot(told.drop("description", "description_public").withColumnsRenamed({"_d": "description", "_p": "description_public"}), now)
    snapshots = old["snapshots"].unionByName(appended) if "snapshots" in old else appended
    aliases = old["aliases"] if "aliases" in old else spark.createDataFrame([], "alias_id string, canonical_id string, noted_at timestamp")
    merged_sources = old["merged_sources"] if "merged_sources" in old else spark.createDataFrame([], "canonical_id string, source string, url string")
    new = {"events": changes.drop("_change"), "occurrences": merge.reconcile(merged, slots, complete), "snapshots": snapshots, "aliases": aliases, "merged_sources": merged_sources}
    return old | new | {"changes": changes.select("event_id", "source", "_change")}


def whole(old: dict[str, DataFrame], records: DataFrame, venue_index: DataFrame, settings: Settings, now: str, probes: DataFrame | None = None, takedowns: dict[str, list] | None = None, complete: bool = True) -> dict[str, DataFrame]:
    """One day's run over a store ``old`` (events, occurrences, aliases, merged_sources, snapshots, link_checks; none at
    first): ingest, merge, drop what is not permitted, resolve duplicates, spread pictures, judge links by ``probes``
    (url, checked_s, n, status), drop what is over, publish.

    Returns the store's next version and, beside it, ``feed_*`` tables, ``changes`` and ``near_misses``."""
    moment, as_of = F.lit(now).cast("timestamp"), F.lit(settings.as_of).cast("date")
    tables = store(old, *ingest(records, venue_index, settings), settings, moment, complete)
    changes = tables.pop("changes")
    policies = gates.policy_table(records.sparkSession, settings)
    tables = upkeep.purge_unpermitted(tables, settings)
    tables["events"] = cut(gates.sane(gates.strip_unpublishable(tables["events"], policies), settings.city))
    tables["snapshots"] = upkeep.strip_snapshots(tables["snapshots"], policies)
    resolved = resolve.resolve(tables["events"], tables["occurrences"], tables["aliases"], as_of, moment)
    tables |= {"aliases": resolved["aliases"], "merged_sources": tables["merged_sources"].unionByName(resolved["merged_sources"]).distinct()}
    events = liveness.kill_linkless(propagate_images(resolved["events"]), moment)
    if probes is not None:
        state = old["link_checks"] if "link_checks" in old else records.sparkSession.createDataFrame([], "url string, strikes int, last_status int, last_checked_s long, last_strike_s long")
        tables["link_checks"] = cut(liveness.fold_probes(state, probes))
        events = liveness.kill(events, tables["link_checks"], moment)
    tables["events"] = cut(liveness.promote(events))
    tables = upkeep.prune_past(upkeep.prune_linkless(tables, settings), settings)
    tables = {name: cut(df) for name, df in tables.items()}
    out = publish(tables["events"], tables["occurrences"], tables["aliases"], settings, takedowns or {}, now)
    return tables | {f"feed_{name}": df for name, df in out.items()} | {"changes": changes, "near_misses": resolved["near_misses"]}


def publish(events: DataFrame, occurrences: DataFrame, aliases: DataFrame, settings: Settings, takedowns: dict[str, list], generated_at: str = "") -> dict[str, DataFrame]:
    """The feed of a city: items, details, objects by content-addressed name, the manifest, days, categories, credits,
    what was withheld, events taken down and rows that held a contact.

    Gates come before everything else; takedowns reach an event through its aliases, too."""
    as_of = F.lit(settings.as_of).cast("date")
    rows = feed.window(gates.sane(events, settings.city), occurrences, settings.city, as_of, settings.window_days)
    names = aliases.groupBy(F.col("canonical_id").alias("event_id")).agg(F.collect_set("alias_id").alias("_aliases"))
    rows = rows.join(names, "event_id", "left")
    everything = F.concat(F.array("event_id"), F.coalesce("_aliases", F.array().cast("array<string>")))
    reason = gates.suppressed_by(gates.rules(takedowns), everything, F.col("url"), F.col("venue_name"), F.col("title"))
    policies = gates.policy_table(events.sparkSession, settings)
    judged = cut(gates.gated(rows, policies, reason), "judged")
    kept = judged.where("_withheld is null")
    items = cut(feed.presentable(feed.item(kept, settings)), "items")
    own = aliases.join(events.where(F.col("city") == settings.city).select(F.col("event_id").alias("canonical_id")), "canonical_id", "left_semi")
    detail = cut(feed.details(items, own), "details")
    return {
        "items": items,
        "details": detail,
        "objects": feed.objects(items, detail),
        "manifest": feed.manifest(items, detail, own, policies, settings, generated_at),
        "days": feed.days(items),
        "categories": feed.categories(items),
        "credits": feed.credits(items, policies),
        "withheld": judged.where("_withheld is not null").groupBy("source", "_withheld").agg(F.countDistinct("event_id").alias("n_events")),
        "taken_down": judged.where("_withheld not in ('policy')").select("event_id").distinct(),
        "redacted": feed.redacted(kept),
    }
