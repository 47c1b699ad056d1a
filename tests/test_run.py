"""A whole run on a few records."""

import json

from pyspark.sql import functions as F

from kalends.config import LIST_FIELDS, Policy, Settings
from kalends.operators import resolve, venues
from kalends.plans import run
from kalends.sources import records


def test_run(spark):
    settings = Settings("2026-01-15", policies=(Policy("ra", images=True), Policy("vhs", description=True), Policy("shut", "stop")))
    names = list(records.RAW)
    ddl = ", ".join(f"`{k}` {v}" for k, v in records.RAW.items())
    row = lambda **x: tuple(x.get(k) for k in names)
    base = {"start": "2026-02-01T20:00", "venue_name": "Lido", "city": "Berlin"}
    raw = spark.createDataFrame(
        [
            row(**base, source="ra", source_event_id="1", source_url="https://x.de/1", title="Die Band live", image_url="https://x.de/i.jpg"),
            row(**base, source="vhs", source_event_id="2", source_url="https://x.de/2", title="Die Band (live)", description="Konzert, Fragen an a@b.de", description_public=True, price_text="12 €"),
            row(**base, source="shut", source_event_id="3", source_url="https://x.de/3", title="Lesung"),
            row(**base | {"start": "2026-05-01T20:00"}, source="ra", source_event_id="4", source_url="https://x.de/4", title="Party"),
            row(**base, source="vhs", source_event_id="5", source_url="https://bad.de/5", title="Vortrag", description="x", description_public=True),
        ],
        ddl,
    ).withColumn("arrival", F.monotonically_increasing_id())
    index = venues.index(spark.createDataFrame([(1, "v1", "Lido", [], "live_music")], "ordinal int, venue_id string, name string, aliases array<string>, prior string"))
    events, slots = run.ingest(raw, index, settings)
    assert {r.source_event_id: (r.venue_id, r.category) for r in events.collect()}["1"] == ("v1", "club_nightlife") and slots.count() == 5
    none = spark.createDataFrame([], "alias_id string, canonical_id string, noted_at int")
    out = resolve.resolve(events.where("source_event_id <> '5'"), slots, none, F.lit("2026-01-15").cast("date"), F.lit(1))
    merged = out["events"].unionByName(events.where("source_event_id = '5'"))
    feed = run.publish(run.propagate_images(merged), slots, out["aliases"], settings, {"domains": ["bad.de"]})
    items = feed["items"].collect()
    assert len(items) == 1 and items[0].image_url == "https://x.de/i.jpg" and items[0].category_label == "Club & Nightlife" and items[0].description is None
    assert {(r.source, r["_withheld"]): r.n_events for r in feed["withheld"].collect()}.get(("vhs", "domains")) == 1
    assert feed["objects"].count() == 3 and [r.n_events for r in feed["days"].collect()] == [1]
    assert set(feed["items"].columns) == set(LIST_FIELDS) - {"h"} | {"category_tier", "description"}
    body = json.loads(feed["manifest"].first().body)
    assert list(body) == sorted(body) and body["feed"]["count"] == 1 and body["days"] == [{"date": "2026-02-01", "count": 1}] and body["categories"] == [{"category": "club_nightlife", "label": "Club & Nightlife", "count": 1}]
    assert body["window"] == {"from": "2026-01-15", "to": "2026-02-14"} and list(body["sources"]) == ["ra"] and body["attribution"].endswith("link to its original listing.") is False
    assert body["feed"]["url"] in {r.key for r in feed["objects"].collect()}


def test_ingest_reads_lenient_dates(spark):
    """Start, end, doors and further starts in a form that only the lenient last step reads."""
    names = list(records.RAW)
    ddl = ", ".join(f"`{k}` {v}" for k, v in records.RAW.items())
    row = lambda **x: tuple(x.get(k) for k in names)
    base = {"source": "ra", "venue_name": "Lido", "city": "Berlin", "title": "Konzert", "source_url": "https://x.de/1"}
    raw = spark.createDataFrame([row(**base, source_event_id="1", start="June 14 at 8pm", end="June 14 at 11pm", doors="June 14 at 7pm", extra_starts=["June 15 at 8pm", "2026-06-16T20:00"])], ddl).withColumn("arrival", F.lit(1))
    index = venues.index(spark.createDataFrame([(1, "v1", "Lido", [], "live_music")], "ordinal int, venue_id string, name string, aliases array<string>, prior string"))
    events, slots = run.ingest(raw, index, Settings("2026-01-15", policies=(Policy("ra"),)))
    got = sorted((r.starts_at_utc, r.ends_at_utc, r.doors_at_local) for r in slots.collect())
    assert events.count() == 1 and [str(s)[:13] for s, _, _ in got] == ["2026-06-14T18", "2026-06-15T18", "2026-06-16T18"]
    assert str(got[0][1])[:13] == "2026-06-14T21" and "19:00" in str(got[0][2])


def test_photos_stay_with_one_event(spark):
    df = spark.createDataFrame([("b", "p"), ("a", "p"), ("c", None), ("d", "q")], "event_id string, stock_image_url string")
    assert {r.event_id: r.stock_image_url for r in run.release_duplicate_photos(df).collect()} == {"a": "p", "b": None, "c": None, "d": "q"}


def test_two_days(spark):
    """A store from nothing, then a day with a change, a vanished slot, a dead head, a past event and a source switched off."""
    names = list(records.RAW)
    ddl = ", ".join(f"`{k}` {v}" for k, v in records.RAW.items())
    row = lambda **x: tuple(x.get(k) for k in names)
    policies = (Policy("ra", images=True), Policy("vhs", description=True), Policy("livegigs"))
    base = {"start": "2026-02-01T20:00", "venue_name": "Lido", "city": "Berlin"}
    first = [
        row(**base, source="ra", source_event_id="1", source_url="https://x.de/1", title="Die Band live", image_url="https://x.de/i.jpg"),
        row(**base, source="vhs", source_event_id="2", source_url="https://x.de/2", title="Die Band (live)", description="Konzert, Fragen an a@b.de", description_public=True, extra_starts=["2026-02-03T20:00"], payload='{"k": 1, "description": "raw a@b.de"}'),
        row(**base | {"start": "2026-01-16T20:00"}, source="vhs", source_event_id="3", source_url="https://x.de/3", title="Yoga am Morgen"),
        row(**base | {"start": "2026-02-05T20:00"}, source="livegigs", source_event_id="4", source_url="https://x.de/4", title="Ganz andere Sache"),
    ]
    index = venues.index(spark.createDataFrame([(1, "v1", "Lido", [], "live_music")], "ordinal int, venue_id string, name string, aliases array<string>, prior string"))
    frame = lambda rows: spark.createDataFrame(rows, ddl).withColumn("arrival", F.monotonically_increasing_id())
    day1 = run.whole({}, frame(first), index, Settings("2026-01-15", policies=policies), "2026-01-15 06:00:00")
    one = {r.source_event_id: r for r in day1["events"].collect()}
    assert set(one) == set("1234") and one["2"].canonical_id == one["1"].event_id == one["1"].canonical_id and one["1"].category == "club_nightlife"
    assert {(r.alias_id, r.canonical_id) for r in day1["aliases"].collect()} == {(one["2"].event_id, one["1"].event_id)} and day1["occurrences"].count() == 5
    payloads = {r.source_event_id: json.loads(r.payload) for r in day1["snapshots"].collect()}
    assert payloads["2"]["description"] == "Konzert, Fragen" and payloads["2"]["k"] == "1" and payloads["1"]["description"] == ""
    assert {r["_change"] for r in day1["changes"].collect()} == {"new"} and len(json.loads(day1["feed_manifest"].first().body)["aliases"]) == 1
    second = [first[0], row(**base, source="vhs", source_event_id="2", source_url="https://x.de/2", title="Die Band (live)", description="Konzert", description_public=True), row(**base | {"start": "2026-02-05T20:00"}, source="livegigs", source_event_id="4", source_url="https://x.de/4", title="Ganz andere Sache")]
    state = {k: v for k, v in day1.items() if not k.startswith("feed_") and k not in ("changes", "near_misses")}
    gone = (Policy("ra", images=True), Policy("vhs", description=True), Policy("livegigs", "stop"))
    probes = spark.createDataFrame([("https://x.de/1", 0, 1, 404), ("https://x.de/1", 90_000, 2, 410), ("https://x.de/2", 0, 3, 200)], "url string, checked_s long, n long, status int")
    day2 = run.whole(state, frame(second), index, Settings("2026-01-20", policies=gone), "2026-01-20 06:00:00", probes)
    two = {r.source_event_id: r for r in day2["events"].collect()}
    assert set(two) == {"1", "2"} and two["1"].link_dead_at is not None and {r.canonical_id for r in two.values()} == {two["2"].event_id}
    assert str(two["1"].first_seen_at) == "2026-01-15 06:00:00" and str(two["2"].last_seen_at) == "2026-01-20 06:00:00"
    assert {r.source_event_id for r in day2["snapshots"].collect()} == {"1", "2"} and {r.url: r.strikes for r in day2["link_checks"].collect()} == {"https://x.de/1": 2, "https://x.de/2": 0}
    assert sorted(r.starts_at_utc[:10] for r in day2["occurrences"].collect()) == ["2026-02-01", "2026-02-01"]
    assert {(r.source, r["_change"]) for r in day2["changes"].collect()} >= {("ra", "same"), ("vhs", "changed")}
    items = day2["feed_items"].collect()
    assert [r.event_id for r in items] == [two["2"].event_id] and items[0].description == "Konzert"
