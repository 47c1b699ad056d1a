"""Readers and extraction on small literals."""

import datetime
import gzip
import json

import pytest
from pyspark.sql import functions as F

from kalends.config import Policy, Settings
from kalends.sources import events, records, web

PAGE = """<html><head><meta property="og:image" content="/img/logo.png"><meta name="twitter:image" content="/img/tw.jpg">
<script type="application/ld+json">{"@graph": [{"@type": "Organization"}, {"@type": ["Thing", "https://schema.org/MusicEvent"], "name": "Konzert", "startDate": "2026-06-14T20:00", "url": "/e/1",
"location": {"name": "Lido", "address": {"streetAddress": "Weg 1", "postalCode": "10115", "addressLocality": "Berlin"}, "geo": {"latitude": "52.5", "longitude": 13.4}}, "offers": [{"price": "0"}, {"price": "10,0"}], "image": [{"url": "/a.jpg"}]}]}</script>
<script type="application/ld+json">{"itemListElement": [{"item": {"@type": "Event", "name": "Zwei", "startDate": ["2026-06-15"],}}, // rest
{"item": {'@type': 'Event', name: 'Drei'}}]}</script>
<script type="application/ld+json">{kaputt vent</script></head>
<body><article><img src="/icons/x.png"><img src="small.jpg" width="100"><img src="big.jpg" width="800" height="600"><img data-src="wide.jpg" width="900px" height="700"></article>
<div class="image__copyright">Foto: Div</div><p class="caption image__copyright"> Foto:  Max
Muster </p></body></html>"""


def test_jsonld(spark):
    pages = spark.createDataFrame([("https://x.de/p", PAGE), ("https://x.de/q", "<p>nothing</p>"), (None, None)], "url string, html string")
    got = web.jsonld_records(pages, "src").collect()
    assert len(got) == 2 and set(got[0].asDict()) == set(records.RAW)
    a, b = sorted(got, key=lambda r: r.title)
    assert (a.title, a.source_url, a.venue_name, a.lat, a.lon, a.city, a.schema_type) == ("Konzert", "https://x.de/e/1", "Lido", 52.5, 13.4, "Berlin", "Thing")
    assert (a.price_value, a.price_text, a.is_free) == (None, "0–10 €", True)
    assert (b.title, b.start, b.source_url) == ("Zwei", "2026-06-15", "https://x.de/p")
    assert web.jsonld_records(pages, "src", city="berlin").count() == 1


def test_lenient():
    assert web.lenient("{a: 'it\\'s', \"b\": [1, 2,], /* x */ c: \"http://x\"}") == {"a": "it's", "b": [1, 2], "c": "http://x"}
    assert web.lenient("{nope") is None and web.event_type(["Thing", "schema:Event"]) == "Event" and web.event_type("Thing") is None


def test_pictures(spark):
    pages = spark.createDataFrame([("https://x.de/p", PAGE), ("https://x.de/q", PAGE.replace('"image"', '"none"')), ("https://x.de/r", PAGE[PAGE.index("<body>") :]), ("https://x.de/s", '<div role="main"><img src="r.jpg"></div>'), ("https://x.de/t", '<img src="z.jpg">')], "url string, html string")
    got = pages.select(web.page_picture("html", "url").alias("p")).collect()
    assert [r.p.image for r in got] == ["https://x.de/a.jpg", "https://x.de/img/tw.jpg", "https://x.de/wide.jpg", "https://x.de/r.jpg", None]
    assert got[0].p.credit == "Max Muster" and got[4].p.credit is None


def test_embedded_json(spark):
    cut = web.embedded_json("window.DATA =")
    df = spark.createDataFrame([('x window.DATA = {"a": "}{\\"", "b": {"c": 1}}; y',), ("window.DATA = {broken",), ("none",), (None,)], "h string")
    got = [r.x for r in df.select(cut(F.col("h")).alias("x")).collect()]
    assert json.loads(got[0]) == {"a": '}{"', "b": {"c": 1}} and got[1:] == [None, None, None]


def test_sitemaps(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    index = f"<sitemapindex {ns}><sitemap><loc> https://x/a.xml </loc></sitemap></sitemapindex>".encode()
    urls = gzip.compress(f"<urlset {ns}><url><loc>https://x/1</loc><lastmod>2026-01-01</lastmod></url><url><loc>https://x/2</loc></url></urlset>".encode())
    df = spark.createDataFrame([(index,), (urls,), (b"<broken",), (None,)], "c binary")
    got = [r.s for r in df.select(web.parse_sitemap("c").alias("s")).collect()]
    assert got[0].children == ["https://x/a.xml"] and [(p.url, p.lastmod) for p in got[1].pages] == [("https://x/1", "2026-01-01"), ("https://x/2", None)] and got[2].pages == got[3].pages == []


def landed(spark, tmp_path, schema, rows):
    (tmp_path / "in.json").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
    return spark.read.schema(schema).json(str(tmp_path / "in.json"))


def test_courses(spark, tmp_path):
    base = {
        "guid": "g1", "nummer": "N", "name": " Kurs ", "untertitel": "Unter", "bezirk": "Mitte", "veranstaltungsart": "Kurs", "dvv_kategorie": {"@version": "1", "#text": "3.05"}, "aktuelle_teilnehmerzahl": "3", "maximale_teilnehmerzahl": "10",
        "beginn_datum": "2026-02-01", "schlagwort": ["a"], "text": [{"eigenschaft": "Beschreibung", "text": "<b>Viel</b> &amp; mehr"}], "ortetermine": {"adresse": {"lehrstaette": "Haus", "strasse": "Weg 1, Hof", "plz": "10115", "breitengrad": "52,5", "laengengrad": "13.4"}, "termin": [{"beginn_datum": "2026-02-08"}, {"beginn_datum": "2026-02-01", "beginn_uhrzeit": "18:00", "ende_uhrzeit": "20:00"}]},
        "preis": {"betrag": "12,50", "zusatz": "pro Person"}, "webadresse": {"uri": "http://www.vhsit.berlin.de/k/1"},
    }
    rows = [base, base | {"guid": "g2", "schlagwort": "Prüfungstermin"}, base | {"guid": "g3", "aktuelle_teilnehmerzahl": "10"}, base | {"guid": "g4", "beginn_datum": "2027-01-01"}, base | {"guid": "g5", "ortetermine": base["ortetermine"] | {"adresse": [{"lehrstaette": "Online-Raum"}]}}, base | {"guid": "g6", "preis": {"betrag": "0"}, "ortetermine": base["ortetermine"] | {"termin": {"beginn_datum": "2026-02-03"}}}]
    got = {r.source_event_id: r for r in records.courses(landed(spark, tmp_path, records.COURSE_SCHEMA, rows), "2026-01-20", 30).collect()}
    assert set(got) == {"g1", "g6"}
    r = got["g1"]
    assert (r.start, r.end, r.street, r.lat, r.price_text, r.price_value) == ("2026-02-01T18:00:00", "2026-02-01T20:00:00", "Weg 1", 52.5, "12.5 € (pro Person)", 12.5)
    assert r.description == "Kurs mit 2 Terminen, 01.02.2026 bis 08.02.2026. Unter. Viel & mehr" and r.source_url.startswith("https://") and r.category_raw == "3.05|Kurs"
    assert got["g6"].is_free and got["g6"].start == "2026-02-03" and got["g6"].price_text == "0 €"
    cats = spark.createDataFrame([("3.05|Kurs",), ("x|Einzelveranstaltung/Vortrag",), ("3.01|",), ("9|x",)], "c string").select(records.course_category(F.col("c")).alias("x")).collect()
    assert [r.x for r in cats] == ["food_drink", "talks_literature", "sports_fitness", None]


def test_calendar(spark, tmp_path):
    entry = lambda i, ref, **s: {"identifier": i, "schedule": {"startDate": "2026-02-01"} | s, "attractions": [{"referenceId": ref, "referenceLabel": {"de": "", "en": "Title"}}], "locations": [{"referenceId": "L", "referenceLabel": {"de": "Ort"}}], "admission": {"ticketType": "ticketType.freeOfCharge"}, "scheduleStatus": "event.cancelled"}
    rows = [entry("1", "A", startTime="19:00:00", endTime="21:00:00"), entry("2", "B", startTime="00:00:00", endDate="2026-02-03"), entry("3", "C")]
    a = spark.createDataFrame([("A", "www.own.de", [("https://ext.de",)], ["x", "attraction.category.Concerts"], ("Text",), ("bezirkskalender", "77")), ("B", "www.own.de", None, None, None, ("else", "77")), ("C", None, None, None, None, None)], records.ATTRACTION)
    loc = spark.createDataFrame([("L", ("Weg", "1", None))], records.LOCATION)
    got = {r.source_event_id: r for r in records.calendar(landed(spark, tmp_path, records.CALENDAR_SCHEMA, rows), a, loc).collect()}
    assert set(got) == {"1", "2"} and got["1"].source_url.endswith("detail=77") and (got["1"].start, got["1"].end) == ("2026-02-01T19:00:00", "2026-02-01T21:00:00")
    assert got["1"].category_raw == "Concerts" and got["1"].is_free and got["1"].event_status == "cancelled" and got["1"].title == "Title"
    assert got["2"].source_url == "https://www.own.de" and (got["2"].start, got["2"].end) == ("2026-02-01", "2026-02-03T00:00:00")
    assert records.misses(landed(spark, tmp_path, records.CALENDAR_SCHEMA, rows), a.where("id <> 'C'"), 5).count() == 1


def test_other_readers(spark, tmp_path):
    t = {"id": "1", "name": "N", "url": "https://t", "dates": {"start": {"localDate": "2026-02-01", "dateTBD": False}, "status": {"code": "cancelled"}}, "classifications": [{"segment": {"name": "Music"}, "genre": {"name": "Dance/Electronic"}}], "priceRanges": [{"min": 10.0, "max": 20.5}, {"min": 8.0, "max": 9.0}], "images": [{"url": "a", "width": 10}, {"url": "b", "width": 99, "attribution": "C"}], "_embedded": {"venues": [{"name": "V", "location": {"latitude": "x", "longitude": "13"}}]}}
    r = records.tickets(landed(spark, tmp_path, records.TICKET_SCHEMA, [t, {"id": "2"}])).collect()
    assert len(r) == 1 and (r[0].price_text, r[0].image_url, r[0].image_credit, r[0].lat, r[0].lon, r[0].event_status) == ("8–20.5 €", "b", "C", None, 13.0, "cancelled")
    assert spark.range(1).select(records.ticket_category(F.lit("Music"), F.lit("Dance")).alias("x")).first().x == "club_nightlife"
    c = {"event": {"id": "5", "title": "T", "startTime": "2026-02-01T23:00", "contentUrl": "/events/5", "cost": " 12,5 ", "images": [{"filename": "f.jpg", "type": "X"}, {"filename": "https://g", "type": "FLYERFRONT"}]}}
    r = records.clubs(landed(spark, tmp_path, records.CLUB_SCHEMA, [c])).first()
    assert (r.source_url, r.price_value, r.image_url) == ("https://ra.co/events/5", 12.5, "https://g")
    p = {"id": "7", "title": "Teacher&#8217;s <i>Pet</i>", "url": "https://p", "start_date": "2026-02-01 20:00:00", "end_date": "2026-02-01 22:00:00", "cost_details": {"values": ["12", "8"]}, "description": "<p>A &amp; B</p>"}
    r = records.plugin(landed(spark, tmp_path, records.PLUGIN_SCHEMA, [p, p | {"id": "8", "all_day": True, "cost_details": {"values": ["5"]}}]), "house", "Home").orderBy("source_event_id").collect()
    assert (r[0].title, r[0].start, r[0].end, r[0].price_text, r[0].venue_name, r[0].description) == ("Teacher’s Pet", "2026-02-01T20:00:00", "2026-02-01T22:00:00", "8–12 €", "Home", "A & B")
    assert (r[1].start, r[1].end, r[1].price_value, r[1].price_text) == ("2026-02-01", None, 5.0, None)
    m = {"id": "9", "name": "M", "url": "https://m", "start_date": "2026-02-01", "start_time": "19:00", "end_date": "2026-02-02", "is_free": True, "tags": [{"prefix": "EventbriteCategory", "tag": "EventbriteCategory/103"}, {"prefix": "EventbriteSubCategory", "display_name": "Techno"}]}
    r = records.market(landed(spark, tmp_path, records.MARKET_SCHEMA, [m, m | {"id": "10", "is_online_event": True}])).collect()
    assert len(r) == 1 and (r[0].start, r[0].end, r[0].category_raw, r[0].is_free) == ("2026-02-01T19:00", "2026-02-02", "103|Techno", True)
    assert spark.range(1).select(records.market_category(F.lit("103|Techno")).alias("x")).first().x == "club_nightlife"
    items = spark.createDataFrame([({"id": "3", "bezeichnung": "Fest", "von": "01.02.2026", "www": "fest.de", "plz": "10115 B", "mail": "a@b", "zeit": "10 Uhr", "bemerkungen": "viel"},), ({"id": "4"},)], "item map<string,string>")
    r = records.open_list(items, "strassen-volksfeste").collect()
    assert len(r) == 1 and (r[0].source_event_id, r[0].source_url, r[0].postal_code, r[0].description) == ("strassen-volksfeste-3", "https://fest.de", "10115", "10 Uhr viel") and "a@b" not in r[0].payload
    assert spark.range(1).select(records.path_category(F.lit("https://x/event/abc-buehne-1")).alias("x")).first().x == "theatre_performance"


@pytest.fixture(scope="module")
def settings():
    return Settings("2026-01-15", policies=(Policy("open", description=True), Policy("shut")))


def test_to_events(spark, settings):
    names = list(records.RAW)
    ddl = ", ".join(f"`{k}` {v}" for k, v in records.RAW.items())
    row = lambda **x: tuple(x.get(k) for k in names)
    raw = spark.createDataFrame(
        [
            row(source="open", source_event_id="1", source_url="https://x.de/1", title=" A ", start="2026-02-01T20:00", price_text="Eintritt frei", description="Prosa", description_public=True, event_status="https://schema.org/EventCancelled", attendance_mode="https://schema.org/OnlineEventAttendanceMode", extra_starts=["2026-02-02T20:00", "x"], venue_name=" "),
            row(source="shut", source_event_id="2", source_url="https://x.de/2", title="B", start="2026-02-01", end="2026-03-01", price_text="10 € ausverkauft", description="Prosa", description_public=True),
            row(source="open", source_event_id="3", source_url="mailto:x", title="C", start="2026-02-01"),
            row(source="open", source_event_id="4", source_url="https://x.de/4", title="D", start="kaputt"),
        ],
        ddl,
    )
    out = events.to_events(raw, settings)
    got = {r.source_event_id: r for r in out.collect()}
    assert set(got) == {"1", "2"}
    a, b = got["1"], got["2"]
    assert (a.title, a.event_status, a.attendance_mode, a.tags, a.description_public, a.venue_name) == ("A", "cancelled", "online", ["free-entry"], True, None) and len(a.occurrences) == 2
    assert b.is_range and b.range_end == datetime.date(2026, 3, 1) and b.tags == ["sold-out"] and not b.description_public and b.address == {"city": "Berlin", "country": "DE"}
    slots = events.occurrences(out).collect()
    assert len(slots) == 3 and all(s.id.startswith("occ_") for s in slots)
    moved = out.where("source_event_id = '1'").select("basis").first()
    again = events.to_events(raw.withColumn("source_url", F.lit("https://y.de/1")).withColumn("description", F.lit("anders")), settings).where("source_event_id = '1'").select("basis").first()
    assert moved == again
