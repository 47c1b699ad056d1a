"""Scalar functions, table by table."""

import datetime

import pytest
from pyspark.sql import functions as F

from kalends.config import RECORD_HOSTS, STATUSES
from kalends.functions import dates, geo, ids, prices, text

AS_OF = "2026-01-15"


def one(spark, column, **values):
    kinds = {str: "string", float: "double", bool: "boolean"}
    schema = ", ".join(f"`{k}` {kinds.get(type(v), 'string')}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def occurrence(spark, start, end=None, doors=None):
    return one(spark, dates.make_occurrence(F.col("a"), F.col("b"), F.col("c"), "Europe/Berlin", AS_OF), a=start, b=end, c=doors)


@pytest.mark.parametrize(
    "given, local, offset, date_only",
    [
        ("2026-06-14T20:00:00+02:00", "2026-06-14 20:00", 7200, False),
        ("2026-06-14T20:00:00Z", "2026-06-14 20:00", 0, False),
        ("2026-06-14T20:00", "2026-06-14 20:00", None, False),
        ("2026-06-14", "2026-06-14 00:00", None, True),
        ("Sa., 14.06.2026, 20 Uhr", "2026-06-14 20:00", None, False),
        ("14.06.2026 20.30 Uhr", "2026-06-14 20:30", None, False),
        ("14.6.26", "2026-06-14 00:00", None, True),
        ("14. Juni 2026, 19:30", "2026-06-14 19:30", None, False),
        ("3. März", "2026-03-03 00:00", None, True),
        (" 5. MÄRZ 2027 ", "2027-03-05 00:00", None, True),
    ],
)
def test_parse_dt(spark, given, local, offset, date_only):
    x = one(spark, dates.parse_dt(F.col("a"), AS_OF), a=given)
    assert x["local"].strftime("%Y-%m-%d %H:%M") == local and x["offset_s"] == offset and x["date_only"] == date_only


@pytest.mark.parametrize("given", ["31.02.2026", "", "bald", None, "2026-13-01", "2026-01-01T25:00"])
def test_parse_dt_reads_nothing(spark, given):
    assert one(spark, dates.parse_dt(F.col("a"), AS_OF), a=given) is None


def test_parse_dt_fuzzy_takes_as_of(spark):
    x = one(spark, dates.parse_dt(F.col("a"), AS_OF, fuzzy=True), a="June 14 at 8pm")
    assert x["local"] == datetime.datetime(2026, 6, 14, 20)


@pytest.mark.parametrize("start, utc", [("2026-06-14T20:00", "2026-06-14T18:00:00Z"), ("2026-01-14T20:00", "2026-01-14T19:00:00Z"), ("2026-03-29T21:00", "2026-03-29T19:00:00Z"), ("2026-10-25T21:00", "2026-10-25T20:00:00Z")])
def test_zone(spark, start, utc):
    assert occurrence(spark, start)["starts_at_utc"] == utc


def test_occurrences(spark):
    late = occurrence(spark, "2026-06-14T23:00", "2026-06-14T05:00", "2026-06-14T22:00")
    assert late["ends_at_utc"] == "2026-06-15T03:00:00Z" and not late["is_range"] and late["doors_at_local"] == "2026-06-14T22:00:00+02:00"
    show = occurrence(spark, "2026-06-14", "2026-08-01", "2026-06-14T10:00")
    assert show["is_range"] and show["range_end"] == datetime.date(2026, 8, 1) and show["doors_at_local"] is None and show["time_unknown"]
    assert occurrence(spark, "2026-06-14T20:00", "2026-06-01T20:00")["ends_at_utc"] is None
    assert occurrence(spark, "2026-06-15T01:00")["nightlife_date"] == datetime.date(2026, 6, 14)
    assert occurrence(spark, "2026-06-14T23:30:00Z")["nightlife_date"] == datetime.date(2026, 6, 14)
    assert occurrence(spark, "kaputt") is None
    # a day by the wall clock across the change of clocks
    assert occurrence(spark, "2026-03-28T12:00", "2026-03-29T12:30")["is_range"]
    assert not occurrence(spark, "2026-03-28T12:00:00+01:00", "2026-03-29T12:30:00+02:00")["is_range"]


@pytest.mark.parametrize(
    "words, value, hint, want",
    [
        ("Eintritt frei", None, None, ("free", 0, 0, None, None, None, True, False)),
        ("auf Spendenbasis", None, None, ("donation", 0, None, None, None, None, False, False)),
        ("VVK 12 € / AK 15,50 €", None, None, ("range", 12, 15.5, 12, 15.5, None, False, False)),
        ("ab 9,90 €", None, None, ("from", 9.9, None, None, None, None, False, False)),
        ("20 – 10 €", None, None, ("range", 10, 20, None, None, None, False, False)),
        ("15,- 12 Euro, ermäßigt 8", None, None, ("fixed", 12, 12, None, None, 8, False, False)),
        ("€ 7", None, None, ("fixed", 7, 7, None, None, None, False, False)),
        ("0 €", None, None, ("free", 0, 0, None, None, None, True, False)),
        ("18 € ausverkauft", None, None, ("fixed", 18, 18, None, None, None, False, True)),
        ("ab 15€ / Eintritt frei für Mitglieder", None, None, ("from", 15, None, None, None, None, False, False)),
        ("siehe Website", None, None, ("unknown", None, None, None, None, None, False, False)),
        (None, None, None, ("unknown", None, None, None, None, None, False, False)),
        ("ausverkauft", 12.5, None, ("fixed", 12.5, 12.5, None, None, None, False, False)),
        ("x", 0.0, None, ("free", 0, 0, None, None, None, True, False)),
        ("0–10 €", None, True, ("free", 0, 0, None, None, None, True, False)),
        ("Spende 5 €", None, None, ("fixed", 5, 5, None, None, None, False, False)),
    ],
)
def test_prices(spark, words, value, hint, want):
    df = spark.createDataFrame([(words, value, hint)], "t string, v double, h boolean")
    p = df.select(prices.parse_price(F.col("t"), F.col("v"), F.col("h")).alias("p")).first()["p"]
    assert (p["type"], p["min"], p["max"], p["presale"], p["door"], p["reduced"], p["is_free"], p["sold_out"]) == want and p["text"] == words and p["currency"] == "EUR"


@pytest.mark.parametrize(
    "given, gone",
    [
        ("Infos: max@example.de", 1),
        ("max.muster (at) mail (dot) example (dot) de", 1),
        ("Tel.: 030 / 123 45 67", 1),
        ("Anmeldung unter +49 30 1234567", 1),
        ("(030) 55501 234", 1),
        ("Einlass 19.30 - 20.30 Uhr, 20.03.2024, 12,50 €, 10115 Berlin, 2024/2025", 0),
        ("@kanal und 12345", 0),
    ],
)
def test_redaction(spark, given, gone):
    cleaned, n = text.redact(given)
    assert n == gone and (cleaned == given) == (not gone) and not any(c in (cleaned or "") for c in ("example", "123 45", "55501"))
    again = text.redact(cleaned)
    assert again[0] == cleaned or again[1] == 0


def test_redaction_tidies_and_leaves_the_rest(spark):
    assert text.redact("Schön.\r\nE-Mail: a@b.de\r\nTelefon: 030 123 456 7\r\n") == ("Schön.", 2)
    assert text.redact("Anmeldung erwünscht unter a@b.de") == ("Anmeldung erwünscht", 1)
    assert text.redact("Kontakt:\nFrau X\n\n\n\nTel. 030 1234567\nEnde") == ("Kontakt:\nFrau X\n\nEnde", 1)
    assert text.redact(None) == (None, 0) and text.redact("a@b.de") == (None, 1)
    df = spark.createDataFrame([("a@b.de hallo",), ("ohne",), (None,)], "t string")
    rows = df.select(text.redact_contacts(F.col("t")).alias("r"), text.contains_contact(F.col("t")).alias("c")).collect()
    assert [(r.r.text, r.r.removals) for r in rows] == [("hallo", 1), ("ohne", 0), (None, 0)] and rows[0].c


@pytest.mark.parametrize(
    "given, want",
    [
        ("Der Kurs ist frei.\nAnmeldung erwünscht unter : 030 / 55 50 12 34", "Der Kurs ist frei.\nAnmeldung erwünscht"),
        ("Ein Abend.\nFührungen buchbar: bildung@example.de / 030 5550 123 45", "Ein Abend.\nFührungen buchbar"),
        ("Das Angebot ist kostenlos.\nE-Mail: lich@example.de\nBis bald.", "Das Angebot ist kostenlos.\nBis bald."),
        ("Tel. 030 55501 234.\nKostenfrei | Ab 12 Jahren", ".\nKostenfrei | Ab 12 Jahren"),
        ("Bei Fragen (030) 55501 234 anrufen.", "Bei Fragen anrufen."),
        ("Frau Muster Tel. 55 50 12 34 anrufen", "Frau Muster anrufen"),
        ("Kontakt:\nUnser Team hilft gern.\nTel. 030 55501 234 anrufen.", "Kontakt:\nUnser Team hilft gern.\n anrufen."),
        ("Karten: a@b.de , c@d.de – heute", "Karten: – heute"),
        ("Eintritt 12,50 € — Karten 030 555 01 23.", "Eintritt 12,50 € — Karten."),
        ("Ort [a@b.de] frei", "Ort frei"),
        ("Treffpunkt ist Raum 0 12, Grabungen 2023/24, 8.30 - 9.30 Uhr, am 20.03.2024.", "Treffpunkt ist Raum 0 12, Grabungen 2023/24, 8.30 - 9.30 Uhr, am 20.03.2024."),
    ],
)
def test_redaction_leaves_sentences(given, want):
    assert text.redact(given)[0] == want


def test_long_texts_do_not_hold_up(spark):
    dotted, run = "a." * 100_000 + "com", "0123456789abcdef" * 65_536
    assert text.redact(run) == (run, 0) and text.redact("mail x@" + dotted)[1] <= 1 and text.redact("1234 " * 200_000)[1] >= 0
    df = spark.createDataFrame([(dotted,), (run,)], "t string")
    got = df.select(text.ensure_scheme(F.col("t")).alias("u"), text.contains_contact(F.col("t")).alias("c"), text.has_external_link(F.col("t"), RECORD_HOSTS).alias("e")).collect()
    assert got[0].u == "https://" + dotted and got[1].u == run and not got[1].c


def test_bit_rows_give_the_longest_common_subsequence():
    import random

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for k, y in enumerate(b, 1):
                last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
        return row[-1]

    r = random.Random(3)
    for _ in range(2000):
        a, b = ("".join(r.choice("abcäß ") for _ in range(r.randint(0, 40))) for _ in range(2))
        assert text.common_length(a, b) == plain(a, b)


def test_names_and_similarity(spark):
    assert one(spark, text.norm_name(F.col("a")), a="  Café  STRASSE — Görli!") == "cafe strasse gorli"
    assert one(spark, text.norm_title(F.col("a")), a="Ausverkauft: Die Ärzte") == "die arzte"
    assert one(spark, text.norm_title(F.col("a")), a="Loft presents: Band") == "band"
    assert one(spark, text.norm_ascii(F.col("a")), a="Café STRASSE") == one(spark, text.norm_name(F.col("a")), a="Café STRASSE")
    assert text.token_set("a b c", "c b a x") == 100 and text.token_set("", "a") == 0 and text.token_set("abc", "xyz") == 0
    assert 80 < text.token_set("great band live", "great bend live") < 100


@pytest.mark.parametrize("url, want", [("https://x.de/a", True), ("http://x.de", True), ("ftp://x.de", False), ("mailto:a@x.de", False), ("https://localhost/a", False), ("", False), (None, False), ("https://api-v2.kulturdaten.berlin/x", False), ("https://a.api-v2.kulturdaten.berlin/x", False), (" https://x.de ", True), ("https://notapi-v2.kulturdaten.berlin", True)])
def test_external_link(spark, url, want):
    assert one(spark, text.has_external_link(F.col("a"), RECORD_HOSTS), a=url) is want


def test_small_texts(spark):
    for given, want in [("www.x.de", "https://www.x.de"), ("x.de/a?b", "https://x.de/a?b"), ("http://x.de", "http://x.de"), ("mailto:a@b.de", "mailto:a@b.de"), (" x.de ", "https://x.de"), ("wort", "wort"), ("", "")]:
        assert one(spark, text.ensure_scheme(F.col("a")), a=given) == want
    assert one(spark, text.norm_url(F.col("a")), a=" HTTP://X.de/A// ") == "http://x.de/a"
    assert one(spark, text.schema_enum(F.col("a"), STATUSES, F.lit("scheduled")), a="https://schema.org/EventCancelled") == "cancelled"
    assert one(spark, text.schema_enum(F.col("a"), STATUSES, F.lit("d")), a="weird") == "d"


def test_ids_and_places(spark):
    import hashlib

    number = int.from_bytes(hashlib.sha256(b"src\x0042").digest()[:16], "big")
    letters = "".join(ids.ALPHABET[(number >> 5 * k) & 31] for k in reversed(range(26)))
    assert one(spark, ids.event_id(F.col("a"), F.col("b")), a="src", b="42") == f"evt_{letters}"
    assert one(spark, ids.series_key(F.col("a"), F.col("b")), a="", b="e") == hashlib.sha1(b"e").hexdigest()[:12]
    metres = spark.range(1).select(geo.haversine_m(F.lit(52.5), F.lit(13.4), F.lit(52.501), F.lit(13.4)).alias("m")).first()["m"]
    assert abs(metres - 111.19) < 0.1
