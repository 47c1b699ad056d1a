"""What leaves the store: events that are over, not permitted or without a link, and all that hangs on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.config import RECORD_HOSTS, Settings
from kalends.functions import text
from kalends.operators import merge
from kalends.operators.gates import policy_table
from kalends.operators.graph import cut

#: Letters of prose that a snapshot keeps.
PROSE = 1500


def delete(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """Tables of the store without events ``gone`` (event_id): the cascade, snapshots by (source, source_event_id), and
    checks of links and images that no event refers to any more. Tables that are not there are not needed."""
    gone = cut(gone.select("event_id").distinct(), "gone")  # asked of every table
    out = merge.cascade(tables, gone)
    if "snapshots" in tables:
        keys = tables["events"].join(gone, "event_id", "left_semi").select("source", "source_event_id").distinct()
        out["snapshots"] = tables["snapshots"].join(keys, ["source", "source_event_id"], "left_anti").select(tables["snapshots"].columns)
    for name, column in (("link_checks", "url"), ("image_checks", "image_url")):
        if name in tables:
            held = out["events"].select(F.col(column).alias("url")).where("url is not null").distinct()
            out[name] = tables[name].join(held, "url", "left_semi").select(tables[name].columns)
    return out


def unpermitted(events: DataFrame, settings: Settings) -> DataFrame:
    """Sources of the city's events that are not permitted."""
    known = policy_table(events.sparkSession, settings).where("permitted").select("source")
    return events.where(F.col("city") == settings.city).select("source").distinct().join(F.broadcast(known), "source", "left_anti")


def purge_unpermitted(tables: dict[str, DataFrame], settings: Settings) -> dict[str, DataFrame]:
    """All of a source that is not permitted goes: events and what hangs on them, snapshots and ledger rows; members
    that lose their head are their own."""
    off = unpermitted(tables["events"], settings)
    gone = tables["events"].where(F.col("city") == settings.city).join(off, "source", "left_semi").select("event_id")
    out = delete(tables, gone)
    for name in ("snapshots", "ledger"):
        if name in out:
            out[name] = out[name].join(off, "source", "left_anti").select(out[name].columns)
    return out | {"events": cut(merge.heal_orphans(out["events"]), "events")}


def prune_linkless(tables: dict[str, DataFrame], settings: Settings) -> dict[str, DataFrame]:
    """Events of the city without a page to send readers to go."""
    gone = tables["events"].where((F.col("city") == settings.city) & ~text.has_external_link(F.col("url"), RECORD_HOSTS)).select("event_id")
    out = delete(tables, gone)
    return out | {"events": cut(merge.heal_orphans(out["events"]), "events")}


def prune_past(tables: dict[str, DataFrame], settings: Settings, keep_days: int = 2) -> dict[str, DataFrame]:
    """Events of the city that are over for more than ``keep_days`` go."""
    own = tables["events"].where(F.col("city") == settings.city)
    return delete(tables, merge.past(own, tables["occurrences"], F.lit(settings.as_of).cast("date"), keep_days))


def strip_snapshots(snapshots: DataFrame, policies: DataFrame) -> DataFrame:
    """Prose in the payloads of sources whose policy does not cover it becomes empty; other fields stay as they are.
    Payloads that are no JSON objects stay."""
    ok = F.broadcast(policies.select("source", "description_ok"))
    fields = F.from_json("payload", "map<string,string>")
    told = F.coalesce(F.get_json_object("payload", "$.description"), F.lit("")) != ""
    # the value's own text, quoted as JSON, is what is replaced
    quoted = F.regexp_extract(F.to_json(F.struct(F.get_json_object("payload", "$.description").alias("d"))), r'(?s)^\{"d":(.*)\}$', 1)
    blank = F.replace(F.col("payload"), F.concat(F.lit('"description":'), quoted), F.lit('"description":""'))
    blank = F.replace(blank, F.concat(F.lit('"description": '), quoted), F.lit('"description": ""'))
    strip = ~F.coalesce("description_ok", F.lit(False)) & F.coalesce(told, F.lit(False)) & fields.isNotNull()
    return snapshots.join(ok, "source", "left").withColumn("payload", F.when(strip, blank).otherwise(F.col("payload"))).select(snapshots.columns)


def snapshot(changes: DataFrame, now: F.Column) -> DataFrame:
    """Rows to append to the snapshots: the payload of events that are new or changed, with the prose that may be kept,
    without contacts and cut, as its description."""
    fresh = changes.where(F.col("_change").isin("new", "changed"))
    prose = F.when(F.col("description_public"), text.redact_contacts(F.col("description"))["text"])
    kept = F.substring(F.coalesce(prose, F.lit("")), 1, PROSE)
    fields = F.map_concat(F.map_filter(F.coalesce(F.from_json("payload", "map<string,string>"), F.create_map().cast("map<string,string>")), lambda k, _: k != "description"), F.create_map(F.lit("description"), kept))
    return fresh.select("source", "source_event_id", F.to_json(fields).alias("payload"), now.alias("fetched_at"))


def counts(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """(tbl, n_before, n_after) of each table, for a run's record."""
    rows = [b.agg(F.count("*").alias("n_before")).join(after[name].agg(F.count("*").alias("n_after"))).select(F.lit(name).alias("tbl"), "n_before", "n_after") for name, b in before.items()]
    return reduce(DataFrame.unionByName, rows)
