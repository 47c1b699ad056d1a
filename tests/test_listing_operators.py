"""Merging, resolution, venues, gates, liveness, feed and the stream."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from kalends.config import FAMILIES, Policy, Settings
from kalends.functions import text
from kalends.operators import classify, feed, gates, links, liveness, merge, resolve, select, venues
from kalends.streaming import strikes

DAY = datetime.date(2199, 6, 13)
EVENT = "event_id string, canonical_id string, source string, url string, title string, venue_id string, venue_name string, lat double, lon double, is_range boolean, image_url string, image_credit string, price struct<type:string>"


def ev(i, source="ra", title="t", venue="V", canonical=None, lat=None, lon=None, venue_id=None, image=None, price="unknown"):
    return (i, canonical or i, source, f"https://x.de/{i}", title, venue_id, venue, lat, lon, False, image, image and f"c-{i}", (price,))


def run(spark, events, starts=None, aliases=()):
    e = spark.createDataFrame(events, EVENT)
    o = spark.createDataFrame([(x[0], DAY, (starts or {}).get(x[0], "2199-06-13T20:00:00Z")) for x in events], "event_id string, nightlife_date date, starts_at_utc string")
    a = spark.createDataFrame(list(aliases), "alias_id string, canonical_id string, noted_at int")
    out = resolve.resolve(e, o, a, F.lit("2199-01-01").cast("date"), F.lit(2))
    return {r.event_id: r for r in out["events"].collect()}, {r.alias_id: r.canonical_id for r in out["aliases"].collect()}, out


def test_resolution(spark):
    events, aliases, out = run(
        spark,
        [
            ev("a", "tip_berlin", "Die Band live", "Lido", image="i"),
            ev("b", "ra", "Ausverkauft: Band, die (live)", "Lido Berlin", price="fixed"),
            ev("c", "ra", "Die Band live", "Anderswo"),
            ev("d", "ra", "Lecture on owls", None, lat=52.5, lon=13.4),
            ev("e", "tip_berlin", "Vortrag über Eulen", None, lat=52.5005, lon=13.4),
            ev("f", "ra", "Vortrag über Eulen", None, lat=0.0, lon=13.4),
            ev("g", "ra", "Solo", "X", canonical="b"),
        ],
        {"e": "2199-06-13T20:05:00Z"},
        [("old", "a", 1)],
    )
    assert events["a"].canonical_id == events["b"].canonical_id == "b"  # b heads g already
    assert events["b"].image_url == "i" and events["b"].image_credit == "c-a" and events["b"].price["type"] == "fixed"
    assert events["c"].canonical_id == "c" and events["d"].canonical_id == events["e"].canonical_id == "d" and events["f"].canonical_id == "f"
    assert events["g"].canonical_id == "b"  # sticky
    assert aliases == {"old": "b", "a": "b", "e": "d"}
    assert out["merged_sources"].count() == 4


def test_near_miss_and_orphan(spark):
    events, _, out = run(spark, [ev("a", "ra", "great band tonight alpha", "V"), ev("b", "vhs", "great bend tonight alpho", "V"), ev("z", canonical="gone", title="zzz")])
    near = out["near_misses"].collect()
    assert len(near) <= 1 and events["z"].canonical_id == "z"


def test_upsert(spark):
    ddl = "source string, source_event_id string, url string, title string, image_url string, image_credit string, basis string, first_seen_at int, last_seen_at int"
    old = spark.createDataFrame([("s", k, "u", "t", "i", "c", "b", 1, 1) for k in "12345"], ddl)
    new = spark.createDataFrame([("s", "1", "u", "t", "i", "c", "b", None, None), ("s", "2", "u2", "t", "i", "c", "b", None, None), ("s", "3", "u", "T", None, "x", "B", None, None), ("s", "4", "u", "T", "j", None, "B", None, None), ("s", "9", "u", "t", None, None, "b", None, None)], ddl)
    got = {r.source_event_id: r for r in merge.upsert_events(old, new, F.lit(7)).collect()}
    assert {k: r["_change"] for k, r in got.items()} == {"1": "same", "2": "url", "3": "changed", "4": "changed", "5": "absent", "9": "new"}
    assert got["2"].url == "u2" and got["3"].image_url == "i" and got["3"].image_credit == "c" and got["3"].title == "T"
    assert got["4"].image_url == "j" and got["4"].image_credit is None and got["5"].last_seen_at == 1 and got["1"].last_seen_at == 7 and got["9"].first_seen_at == 7 and got["1"].first_seen_at == 1


def test_reconcile_and_heal(spark):
    o = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], "event_id string, starts_at_utc string")
    r = spark.createDataFrame([("a", "2")], o.schema)
    assert {tuple(x) for x in merge.reconcile(o, r, True).collect()} == {("a", "2"), ("b", "1")} and merge.reconcile(o, r, False).count() == 3
    e = spark.createDataFrame([("a", "x"), ("b", "a")], "event_id string, canonical_id string")
    assert {x.event_id: x.canonical_id for x in merge.heal_orphans(e).collect()} == {"a": "a", "b": "a"}


def test_venues(spark):
    v = spark.createDataFrame([(1, "v1", "Lido", ["Lido Club"], "live_music"), (2, "v2", "Großes Haus am Park", [], None), (3, "v3", "Berghain", None, "club_nightlife"), (4, "v4", "lido", [], None)], "ordinal int, venue_id string, name string, aliases array<string>, prior string")
    names = spark.createDataFrame([("LIDO",), ("Berghain / Panorama Bar",), ("grosses haus",), ("Haus",), ("Nirgends",), (None,), ("",)], "venue_name string")
    got = {r.venue_name: r.venue_id for r in venues.resolve(names, venues.index(v)).collect()}
    assert got == {"LIDO": "v4", "Berghain / Panorama Bar": "v3", "grosses haus": "v2", "Haus": "v2", "Nirgends": None}
    assert venues.seed(v.where("ordinal < 3"), v).count() == 4


@pytest.mark.parametrize(
    "title, schema, source, mapped, venue, want",
    [
        ("x", None, "comedy", None, None, ("comedy", "source_prior")),
        ("x", "MusicEvent", None, "festivals", None, ("festivals", "source_field")),
        ("x", "https://schema.org/DanceEvent", None, None, "club_nightlife", ("club_nightlife", "source_field")),
        ("x", "DanceEvent", None, None, None, ("theatre_performance", "source_field")),
        ("x", "Event", None, None, "live_music", ("live_music", "venue_prior")),
        ("Große BÜHNE", None, None, None, None, ("theatre_performance", "keyword")),
        ("Konzert Konzert Party", None, None, None, None, ("live_music", "keyword_multi")),
        ("Lesung und Konzert", None, None, None, None, ("talks_literature", "keyword_multi")),
        ("Theaterhaus", None, None, None, None, None),
    ],
)
def test_classify(spark, title, schema, source, mapped, venue, want):
    df = spark.createDataFrame([(title, "", schema, source, mapped, venue)], "t string, d string, s string, p string, m string, v string")
    got = df.select(classify.classify(*(F.col(c) for c in "tdspmv")).alias("c")).first()["c"]
    assert (got and (got["category"], got["tier"])) == want and len(FAMILIES) == 14


def test_takedowns(spark):
    lists = gates.rules({"events": ["e1::x"], "urls": ["https://bad.de/a/", "https://worse.de/*"], "domains": [".evil.de"], "venues": ["Café X"], "titles": ["Böse"]})
    rows = [(["e1"], "https://q.de", None, "t", "events"), (["z", "e1::y"], None, None, "t", "events"), (["z"], "HTTPS://BAD.de/a", None, "t", "urls"), (["z"], "https://worse.de/q", None, "t", "urls"), (["z"], "https://a.evil.de/", None, "t", "domains"), (["z"], "https://notevil.de/", "CAFE x", "t", "venues"), (["z"], "https://q.de", None, "So boese? BÖSE!", "titles"), (["z"], "https://q.de", "V", "t", None)]
    df = spark.createDataFrame(rows, "i array<string>, u string, v string, t string, want string")
    got = df.select("want", gates.suppressed_by(lists, F.col("i"), F.col("u"), F.col("v"), F.col("t")).alias("got")).collect()
    assert all(r.got == r.want for r in got)
    for bad in ([], {"else": []}, {"urls": "x"}, {"urls": [{}]}, {"urls": [" "]}):
        with pytest.raises(ValueError):
            gates.rules(bad)


def test_policies(spark):
    s = Settings("2026-01-01", policies=(Policy("a", description=True), Policy("b", "needs_permission", ("b.de",)), Policy("c", "stop", ("c.de",))), permitted=("b",))
    table = gates.policy_table(spark, s)
    e = spark.createDataFrame([(x,) for x in "abcd"], "source string")
    assert {r.source: r["_withheld"] for r in gates.gated(e, table, F.lit(None).cast("string")).collect()} == {"a": None, "b": None, "c": "policy", "d": "policy"}
    assert gates.denied_domains(s.policies, s.permitted, ("z.de",)) == ["c.de", "z.de"]


def test_strikes_batch_and_stream(spark, tmp_path):
    hour = 3600
    probes = [("a", 0, 404), ("a", 5 * hour, 404), ("a", 21 * hour, 410), ("b", 0, 404), ("b", hour, 200), ("c", 0, 404), ("c", hour, 500), ("c", 25 * hour, None), ("d", 0, None)]
    df = spark.createDataFrame([(u, t, k, s) for k, (u, t, s) in enumerate(probes)], "url string, checked_s long, n long, status int")
    empty = spark.createDataFrame([], "url string, strikes int, last_status int, last_checked_s long, last_strike_s long")
    got = {r.url: (r.strikes, r.last_strike_s) for r in liveness.fold_probes(empty, df).collect()}
    assert got == {"a": (2, 21 * hour), "b": (0, None), "c": (1, 0), "d": (0, None)}
    half = liveness.fold_probes(liveness.fold_probes(empty, df.where("n < 2 or n in (3, 5)")), df.where("not (n < 2 or n in (3, 5))"))
    assert {r.url: (r.strikes, r.last_strike_s) for r in half.collect()} == got
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    q = strikes.strikes(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("strike_out").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination(120)
    assert {r.url: (r.strikes, r.last_strike_s) for r in spark.table("strike_out").collect()} == got


def test_kill_and_promote(spark):
    e = spark.createDataFrame([("h", "h", "ra", "u1", None), ("m", "h", "vhs", "u2", None), ("n", "h", "berlin_de", "u3", None), ("x", "x", "ra", "u1", None)], "event_id string, canonical_id string, source string, url string, link_dead_at timestamp")
    state = spark.createDataFrame([("u1", 2)], "url string, strikes int")
    dead = liveness.kill(e, state, F.lit("2026-01-01").cast("timestamp"))
    assert {r.event_id for r in dead.where("link_dead_at is not null").collect()} == {"h", "x"}
    assert {r.event_id: r.canonical_id for r in liveness.promote(dead).collect()} == {"h": "n", "m": "n", "n": "n", "x": "x"}


def test_sanity(spark):
    p = "struct<min:double,max:double,presale:double,door:double,reduced:double,type:string,text:string>"
    e = spark.createDataFrame([("ok", 52.5, 13.4, (5.0, 9.0, None, None, None, "range", "x")), ("out", 48.1, 11.5, (5.0, 900.0, 1.0, 1.0, 1.0, "range", "x")), ("bad�", None, None, (None, None, None, None, None, "unknown", None))], f"title string, lat double, lon double, price {p}")
    got = {r.title: r for r in gates.sane(e, "berlin").collect()}
    assert got["ok"].lat == 52.5 and got["ok"].price["type"] == "range" and got["out"].lat is None and got["out"].price["type"] == "unknown" and got["out"].price["max"] is None and got["out"].price["text"] == "x"
    assert gates.mojibake(e).first()["n_mojibake"] == 1


def test_feed_objects(spark):
    items = spark.createDataFrame([("e::1", "e", "T", "1", DAY, "d", "live_music", "https://x"), ("e::2", "e", "T", "2", DAY, "d", "live_music", "https://x"), ("f::1", "f", " ", "1", DAY, None, "other", "https://x")], "id string, event_id string, title string, starts_at_utc string, nightlife_date date, description string, category string, source_url string").withColumn("event_status", F.lit("scheduled"))
    aliases = spark.createDataFrame([("b", "e"), ("a", "e")], "alias_id string, canonical_id string")
    d = feed.details(items, aliases)
    body = {r.event_id: r.body for r in d.collect()}["e"]
    assert body.startswith('{"aliases":["a","b"],"description":"d","event_id":"e","occurrences":[{"event_status":"scheduled","id":"e::1"') and feed.presentable(items).count() == 2
    rows = feed.list_rows(items, d).collect()
    assert [r.id for r in rows] == ["e::1", "f::1", "e::2"] and len(rows[0].h) == 8
    objects = feed.objects(items, d)
    assert objects.count() == 4 and feed.to_send(objects, objects.where("key like 'events/%'")).count() == 2
    assert len(feed.packed.func(__import__("pandas").Series(["x", None]))[0]) > 0
    assert feed.days(items).first()["n_events"] == 2 and [r.category for r in feed.categories(items).collect()] == ["live_music", "other"]
    assert feed.unsafe(None, 1, 1, 1) and feed.unsafe(0, 1, 1, 1) and feed.unsafe(4, 10, 1, 1) and not feed.unsafe(5, 10, 1, 1) and feed.unsafe(5, None, 4, 10) and not feed.unsafe(5, 0, 5, 10)


def test_breaker_resets_on_ok_only(spark):
    kinds = ["blocked"] * 3 + ["other"] + ["blocked"] * 2 + ["ok"] + ["blocked"] * 4
    df = spark.createDataFrame([("h", k, x) for k, x in enumerate(kinds)], "host string, n int, kind string")
    assert select.trips(df, "host", [F.col("n")], "kind", 5).first()["tripped_at"] == 6 and select.trips(df, "host", [F.col("n")], "kind", 6).count() == 0


def test_titles_alike_by_letters_alone_are_compared(spark):
    """All pairs of a night that score 80 or more are found, without a common word, venue id or place."""
    rng = random.Random(3)
    titles = ["technonacht", "technonachts", "abcd", "abcdef", "abcde"]
    for _ in range(40):
        word = "".join(rng.choice("aet") for _ in range(rng.randint(3, 14)))
        titles += [word, word[:2] + "x" + word[2:], word[1:] + " " + word[:3]]
    rows = [(f"e{k:03d}", f"s{k % 2}", None, None, None, t, "club", "2026-01-01" if k < 5 else f"2026-01-0{k % 2 + 1}", 3600 * k) for k, t in enumerate(titles)]
    slots = spark.createDataFrame(rows, "event_id string, source string, venue_id string, lat double, lon double, t string, v string, nightlife_date string, start_s long")
    got = {(r.u, r.v): r for r in resolve.pairs(slots).collect()}
    want = {(a[0], b[0]): text.token_set(a[5], b[5]) for a in rows for b in rows if a[0] < b[0] and a[7] == b[7]}
    assert {p for p, score in want.items() if score >= 80} <= got.keys() and any(score == 80 for score in want.values())
    assert got[("e000", "e001")].matched and all(r.matched == (want[p] >= 90) and r.title_score == want[p] for p, r in got.items())


def test_links_are_counted_without_listing_pairs(spark, monkeypatch):
    """Counts by classes are those of all pairs of a night: copies, several slots an event, none of a thing, blocks."""
    rng = random.Random(5)
    titles = ["big night", "big night open", "night big", "technonacht", "technonachts", "", "open air", "open airs", "jazz", None, "abcd", "abcdef"]
    places = [("v1", 52.5, 13.4, "club one"), ("v1", None, None, ""), (None, 52.5004, 13.4004, "club ona"), (None, 52.502, 13.4, "club two"), ("", 0.0, 13.4, "hall"), (None, None, None, "halls"), (None, None, None, ""), ("v2", 52.6, 13.5, "bar")]
    rows = []
    for k in range(220):
        source, t, (venue, lat, lon, v) = rng.choice(["a", "b", "c", None]), rng.choice(titles), rng.choice(places)
        for night in rng.choice([(1,), (2,), (1, 1), (1, 2)]):
            rows.append((f"e{k:03d}", source, venue, lat, lon, t, v, f"2026-01-0{night}", 86_400 * night + 600 * rng.randrange(30)))
    rows += rows[:5]
    slots = spark.createDataFrame(rows, "event_id string, source string, venue_id string, lat double, lon double, t string, v string, nightlife_date string, start_s long")
    want = {}
    every = sorted({r for r in rows if r[5] is not None}, key=str)
    for a in every:
        n = want.setdefault((a[0], a[7]), [0, 0])
        for b in every:
            if a[0] != b[0] and a[7] == b[7]:
                placed = all(x for x in (a[3], a[4], b[3], b[4]))
                metres = 111_195 * ((a[3] - b[3]) ** 2 + ((a[4] - b[4]) * 0.6087) ** 2) ** 0.5 if placed else 1e9
                title, same = text.token_set(a[5], b[5]), bool(a[2]) and a[2] == b[2]
                if (title >= 90 and (text.token_set(a[6], b[6]) >= 85 or same or metres <= 250)) or ((same or metres <= 100) and abs(a[8] - b[8]) <= 900):
                    n[0] += 1
                elif 80 <= title < 90 and a[1] and b[1] and a[1] != b[1]:
                    n[1] += 1
    assert all(sum(x[k] for x in want.values()) for k in (0, 1))
    for block in (1024, 3):
        monkeypatch.setattr(links, "BLOCK", block)
        got = links.links(slots).collect()
        assert {(r.event_id, r.nightlife_date): [r.n_matched, r.n_near] for r in got} == want and len(got) == len(want)
    first = {}
    for a in every:
        first[(a[5], a[2:5], a[6], a[7])] = min(a[0], first.get((a[5], a[2:5], a[6], a[7]), a[0]))
    assert {(r.event_id, r.nightlife_date): r.class_id for r in got} == {(a[0], a[7]): first[(a[5], a[2:5], a[6], a[7])] for a in every}
    pairs = resolve.pairs(slots).collect()  # each once
    assert 2 * sum(r.matched for r in pairs) == sum(r.n_matched for r in got) and 2 * sum(bool(r.near_miss) for r in pairs) == sum(r.n_near for r in got)


def test_names_are_compared_along_with_others():
    """Thousands of names that share words and pieces are not scored pair by pair; each is told as the score tells it."""
    rng = random.Random(3)
    words = ["club", "bar", "am", "see", "lido", "lidos", "kultur", "kulturhaus", "ä", "supplier", *map(str, range(30))]
    names = [
        *(" ".join(rng.choices(words, k=rng.choice([0, 1, 2, 2, 3, 4, 12]))) for _ in range(90)),
        *(f"supplier {rng.randrange(600):09d}" for _ in range(90)),
        *("".join(rng.choices("ab", k=rng.choice([3, 8, 20, 70]))) for _ in range(30)),
    ]
    one, two = list(dict.fromkeys(names[::2])), list(dict.fromkeys(names[1::2] + names[:40]))
    got = links._alike_names(one, two)
    assert got.tolist() == [[text.token_set(x, y) >= 85 for y in two] for x in one] and 0 < got.mean() < 1
    many = [f"supplier {k:09d}" for k in range(3000)]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(links, "token_set", lambda a, b: pytest.fail("scored one by one"))
        all_ = links._alike_names(many, many)
    assert all_.diagonal().all() and (all_ == all_.T).all()
    assert all(all_[x, y] == (text.token_set(many[x], many[y]) >= 85) for x, y in (rng.choices(range(3000), k=2) for _ in range(2000)))


def test_many_names_at_few_places(spark, monkeypatch):
    """Names that are alike by the hundred are counted as listed pairs are, and make no place of their own."""
    rng = random.Random(7)
    rows = [(f"e{k:03d}", rng.choice("ab"), rng.choice([None, None, "x"]), 52.4 + 0.0005 * (k % 9), 13.0 + 0.001 * (k % 9), rng.choice(["big ring", "big ring open", "old nut", "old nuts"]), f"supplier {k % 110:09d}", "2026-01-01", 600 * rng.randrange(9)) for k in range(260)]
    slots = spark.createDataFrame(rows, "event_id string, source string, venue_id string, lat double, lon double, t string, v string, nightlife_date string, start_s long")
    want = {r[0]: [0, 0] for r in rows}
    for r in resolve.pairs(slots).collect():
        for x in (r.u, r.v):
            want[x][0] += r.matched
            want[x][1] += bool(r.near_miss)
    monkeypatch.setattr(links, "BLOCK", 50)
    got = links.links(slots).collect()
    assert {r.event_id: [r.n_matched, r.n_near] for r in got} == want and sum(x for x, _ in want.values()) > 1000
    coded = slots.select(F.xxhash64("v", "venue_id", "lat", "lon").alias("pid"), F.xxhash64("venue_id", "lat", "lon").alias("sid"), "v", "venue_id", "lat", "lon").distinct()
    assert links._tight(coded).count() == len({r[2:5] for r in rows})
