"""Stock photos and points of interest."""

import hashlib

from pyspark.sql import functions as F

from kalends.operators import photos
from kalends.sources import places


def test_queries(spark):
    q = spark.range(1).select(photos.queries(F.lit("T"), F.lit("comedy"), F.lit(None).cast("string"), {"comedy": ["stage", "Comedy"]}).alias("q")).first().q
    assert q == ["Comedy T", "Comedy", "stage", "comedy", photos.LAST_RESORT]


def test_answers_and_assignment(spark):
    ddl = "query string, index int, mime string, thumburl string, url string, artist string, license string, license_url string, descriptionurl string"
    pages = spark.createDataFrame([("Comedy", 2, "image/jpeg", "https://w/b?utm=1", "u", "<a>Max &amp; M</a>", "CC", "l", "d"), ("Comedy", 1, "image/png", None, "https://w/a", None, None, "l", "d"), ("Comedy", 0, "image/svg+xml", "https://w/c", "u", None, None, None, None)], ddl)
    found = photos.answers(pages)
    got = {r.rank: r.photo for r in found.collect()}
    assert got[2].url == "https://w/b" and got[2].author == "Max & M" and got[1].url == "https://w/a" and got[1].source is None and set(got) == {1, 2}
    events = spark.createDataFrame([(e, "T", "comedy", None) for e in ("e1", "e2", "e3")], "event_id string, title string, category string, venue_name string")
    out = {r.event_id: r.photo.url for r in photos.assign(photos.ranked(events, found), spark.createDataFrame([("https://w/a",)], "url string")).collect()}
    assert out["e1"] == "https://w/b" and out["e2"] == ["https://w/a", "https://w/b"][int(hashlib.sha1(b"e2").hexdigest()[:8], 16) % 2]


def test_candidates(spark):
    rows = [("a", 1, None, None, None), ("b", 2, "", None, "2026-01-01 00:00:00"), ("c", 3, None, None, "2026-01-20 00:00:00"), ("d", 4, "i", None, None), ("e", 5, None, "s", None)]
    df = spark.createDataFrame(rows, "event_id string, first_seen_at int, image_url string, stock_image_url string, t string").withColumn("stock_attempted_at", F.to_timestamp("t"))
    assert [r.event_id for r in photos.candidates(df, F.lit("2026-01-25").cast("timestamp")).collect()] == ["b", "a"]


def test_places(spark):
    rows = [("node", 1, 52.5, 13.4, None, {"name": "Kino", "amenity": "cinema"}), ("way", 2, None, None, (52.1, 13.1), {"name": "Haus", "tourism": "museum"}), ("node", 3, 1.0, 1.0, None, {"name": "Lido"}), ("node", 4, 1.0, 1.0, None, {"amenity": "cinema"}), ("node", 5, 9.0, 9.0, None, {"name": "Kino"})]
    got = {r.name: r for r in places.venues(spark.createDataFrame(rows, places.SCHEMA), spark.createDataFrame([("Lido",)], "name string")).collect()}
    assert set(got) == {"Kino", "Haus"} and got["Kino"].prior == "film_cinema" and got["Kino"].lat == 52.5 and (got["Haus"].lat, got["Haus"].prior, got["Haus"].osm_id) == (52.1, "art_exhibitions", "way/2")
