"""Raw records to canonical events and occurrences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.config import MODES, RECORD_HOSTS, STATUSES, Settings
from kalends.functions import dates, ids, prices, text
from kalends.operators.gates import policy_table


def to_events(records: DataFrame, settings: Settings, fuzzy: bool = True) -> DataFrame:
    """Canonical events with their occurrences as an array. Rows without an external link or a readable start go.

    Dates that no other rule reads go through the lenient last step, which runs on these only, unless ``fuzzy`` is
    false. Tags set here (sold-out, free-entry) hold until a classification replaces them all."""
    linked = records.where(text.has_external_link(F.col("source_url"), RECORD_HOSTS))
    status = text.schema_enum(F.col("event_status"), STATUSES, F.coalesce(F.nullif("event_status", F.lit("")), F.lit("scheduled")))
    mode = text.schema_enum(F.col("attendance_mode"), MODES, F.coalesce(F.nullif("attendance_mode", F.lit("")), F.lit("offline")))
    occurrence = lambda s, e, d: dates.make_occurrence(s, e, d, settings.zone, settings.as_of, F.col("_status"), fuzzy)
    none = F.lit(None).cast("string")
    df = linked.withColumns({"_status": status, "_mode": mode}).withColumn("_first", occurrence(F.col("start"), F.col("end"), F.col("doors"))).where("_first is not null")
    extra = F.coalesce("extra_starts", F.array().cast("array<string>"))
    df = df.withColumn("_extra", dates.read_leniently(extra, settings.as_of) if fuzzy else extra)
    more = F.filter(F.transform("_extra", lambda s: dates.make_occurrence(s, none, none, settings.zone, settings.as_of, F.col("_status"))), lambda x: x.isNotNull())
    df = df.withColumns({"_all": F.concat(F.array("_first"), more), "price": prices.parse_price(F.col("price_text"), F.col("price_value"), F.col("is_free"))})
    policy = F.broadcast(policy_table(records.sparkSession, settings).select("source", "description_ok"))  # a row for each source
    df = df.join(policy, "source", "left")
    pairs = F.filter(F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in (("street", F.col("street")), ("postal_code", F.col("postal_code")), ("city", F.coalesce("city", F.lit(settings.city.title()))), ("country", F.lit("DE"))))), lambda x: F.coalesce(x["value"], F.lit("")) != "")
    tags = F.filter(F.array(F.when(F.col("price.sold_out"), "sold-out"), F.when(F.col("price.is_free"), "free-entry")), lambda x: x.isNotNull())
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    basis = ids.content_hash(F.col("title"), F.to_json(F.transform("_all", lambda o: F.struct(o["starts_at_utc"], o["ends_at_utc"], o["status"]))), F.col("venue_name"), F.to_json("price"), F.col("image_url"), F.col("_status"), F.col("_first.range_start"), F.col("_first.range_end"), F.col("image_credit"))
    return df.select(
        ids.event_id(F.col("source"), F.col("source_event_id")).alias("event_id"), ids.event_id(F.col("source"), F.col("source_event_id")).alias("canonical_id"), F.lit(settings.city).alias("city"), "source", "source_event_id", F.col("source_url").alias("url"),
        F.trim("title").alias("title"), F.coalesce(F.nullif("category_raw", F.lit("")), F.col("schema_type")).alias("category_raw"), F.lit("other").alias("category"), F.lit("fallback_other").alias("category_tier"), F.lit(0.0).alias("category_confidence"), tags.alias("tags"),
        F.col("_first.is_range").alias("is_range"), F.col("_first.range_start").alias("range_start"), F.col("_first.range_end").alias("range_end"), F.col("_status").alias("event_status"), F.col("_mode").alias("attendance_mode"),
        blank(F.col("venue_name")).alias("venue_name"), F.map_from_entries(pairs).alias("address"), "lat", "lon", F.col("price"), "image_url", blank(F.col("image_credit")).alias("image_credit"),
        F.nullif(F.substring("description", 1, 2000), F.lit("")).alias("description"), (F.coalesce("description_public", F.lit(False)) & F.coalesce("description_ok", F.lit(False))).alias("description_public"), basis.alias("basis"), F.filter("_all", lambda o: ~o["is_range"] | (o["starts_at_utc"] == F.col("_first.starts_at_utc"))).alias("occurrences"),
        "schema_type", "payload", *(c for c in ("_arrival",) if c in records.columns),
    )


def occurrences(events: DataFrame) -> DataFrame:
    """One row for each slot of each event."""
    slot = F.explode("occurrences").alias("o")
    rows = events.select("event_id", slot).select("event_id", "o.*").drop("is_range", "range_start", "range_end")  # those are the event's
    return rows.withColumn("id", ids.occurrence_id(F.col("event_id"), F.col("starts_at_utc")))
