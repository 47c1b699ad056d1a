"""Readers of landed API records: schema on read, then one select to the raw-event columns.

Each function takes a DataFrame of records (``spark.read.schema(X_SCHEMA).json(landing)``) and returns `RAW` columns.
Fetching is not part of a plan; what was fetched is a landing table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.config import RECORD_HOSTS
from kalends.functions import text

RAW = {
    "source": "string", "source_event_id": "string", "source_url": "string", "title": "string", "start": "string", "end": "string", "doors": "string",
    "venue_name": "string", "street": "string", "postal_code": "string", "city": "string", "lat": "double", "lon": "double",
    "price_text": "string", "price_value": "double", "is_free": "boolean", "image_url": "string", "image_credit": "string",
    "category_raw": "string", "schema_type": "string", "description": "string", "description_public": "boolean", "event_status": "string", "attendance_mode": "string",
    "extra_starts": "array<string>", "payload": "string",
}


def raw(df: DataFrame, **columns: Column) -> DataFrame:
    """All raw columns in order; those not given are null."""
    return df.select(*(F.coalesce(columns[c], F.lit(None)).cast(kind).alias(c) if c in columns else F.lit(None).cast(kind).alias(c) for c, kind in RAW.items()))


def blank(c: Column) -> Column:
    """Trimmed; empty is null."""
    return F.nullif(F.trim(c), F.lit(""))


def plain(c: Column) -> Column:
    """Text of HTML: tags and broken links go, the common entities are decoded, blanks collapse."""
    s = F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), 'href="[^"]*"?', " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#8217;", "’"), ("&#8211;", "–"), ("&#039;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def number(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def general(x: Column) -> Column:
    """A number without needless zeros."""
    return F.regexp_replace(F.regexp_replace(F.round(x, 4).cast("decimal(18,4)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def euros(low: Column, high: Column) -> Column:
    return F.when(low.isNull(), None).when(high.isNotNull() & (high != 0) & (high != low), F.concat(general(low), F.lit("–"), general(high), F.lit(" €"))).otherwise(F.concat(general(low), F.lit(" €")))


def looked_up(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


# The open calendar: events that point at attractions and locations, which come from cached dimensions.

CALENDAR_SCHEMA = "identifier string, schedule struct<startDate:string,startTime:string,endDate:string,endTime:string>, attractions array<struct<referenceId:string,referenceLabel:struct<de:string,en:string>>>, locations array<struct<referenceId:string,referenceLabel:struct<de:string,en:string>>>, admission struct<ticketType:string>, scheduleStatus string"
ATTRACTION = "id string, website string, externalLinks array<struct<url:string>>, tags array<string>, description struct<de:string>, metadata struct<origin:string,originObjectID:string>"
LOCATION = "id string, address struct<streetAddress:string,postalCode:string,addressLocality:string>"
# Tags of attractions.
CALENDAR_TAGS = {
    "Exhibitions": "art_exhibitions", "Art": "art_exhibitions", "Concerts": "live_music", "Music": "live_music", "Theatre": "theatre_performance", "Theater": "theatre_performance",
    "Dance": "theatre_performance", "Opera": "theatre_performance", "Stage": "theatre_performance", "Comedy": "comedy", "Film": "film_cinema", "Cinema": "film_cinema",
    "Literature": "talks_literature", "Readings": "talks_literature", "Lectures": "talks_literature", "Talks": "talks_literature", "Education": "workshops_classes", "Workshops": "workshops_classes",
    "Courses": "workshops_classes", "Markets": "markets_fairs", "Festivals": "festivals", "Children": "family_kids", "Family": "family_kids", "Youth": "family_kids", "Sports": "sports_fitness",
    "Food": "food_drink", "Stages": "theatre_performance", "Politics": "community_causes", "InformationEvents": "community_causes", "Health": "community_causes", "Police": "community_causes",
}
CALENDAR_PAGE = "https://www.berlin.de/land/kalender/index.php?detail="


def misses(records: DataFrame, attractions: DataFrame, budget: int) -> DataFrame:
    """Attractions not cached yet, a run's budget of them."""
    wanted = records.select(F.get("attractions", F.lit(0))["referenceId"].alias("id")).where("id is not null").distinct()
    return wanted.join(attractions, "id", "left_anti").orderBy("id").limit(budget)


def calendar(records: DataFrame, attractions: DataFrame, locations: DataFrame) -> DataFrame:
    first = lambda c: F.get(c, F.lit(0))
    label = lambda c: F.coalesce(blank(c["referenceLabel"]["de"]), blank(c["referenceLabel"]["en"]))
    a = attractions.select(F.col("id").alias("_aid"), F.struct(*[c for c in attractions.columns if c != "id"]).alias("_a"))
    b = locations.select(F.col("id").alias("_lid"), F.col("address").alias("_adr"))
    df = records.withColumns({"_aid": first("attractions")["referenceId"], "_lid": first("locations")["referenceId"]}).join(a, "_aid", "left").join(b, "_lid", "left")
    origin = F.trim(F.col("_a.metadata.originObjectID"))
    page = F.when((F.col("_a.metadata.origin") == "bezirkskalender") & origin.rlike(r"^\d+$"), F.concat(F.lit(CALENDAR_PAGE), origin))
    external = F.get(F.filter("_a.externalLinks", lambda x: F.coalesce(x["url"], F.lit("")) != ""), F.lit(0))["url"]
    link = F.coalesce(page, F.nullif(text.ensure_scheme(F.col("_a.website")), F.lit("")), text.ensure_scheme(external))
    s = F.col("schedule")
    none = F.lit("00:00:00")
    begins = F.coalesce(F.nullif(s["startTime"], F.lit("")), none)
    later_day = (F.coalesce(s["endDate"], F.lit("")) != "") & (s["endDate"] != s["startDate"])
    same_day = (F.coalesce(s["endTime"], F.lit("")) != "") & (s["endTime"] != none) & (s["endTime"] != begins)
    end = F.when(later_day, F.concat(s["endDate"], F.lit("T"), F.coalesce(F.nullif(s["endTime"], F.lit("")), none))).when(same_day, F.concat(s["startDate"], F.lit("T"), s["endTime"]))
    tag = F.get(F.filter("_a.tags", lambda t: t.startswith("attraction.category.")), F.lit(0))
    df = df.withColumn("_url", link).where((F.coalesce("identifier", F.lit("")) != "") & (F.coalesce(s["startDate"], F.lit("")) != "") & (F.size("attractions") > 0))
    df = df.where(label(first("attractions")).isNotNull() & text.has_external_link(F.col("_url"), RECORD_HOSTS))
    return raw(
        df,
        source=F.lit("kulturdaten"), source_event_id=F.col("identifier"), source_url=F.col("_url"), title=label(first("attractions")),
        start=F.when(begins == none, s["startDate"]).otherwise(F.concat(s["startDate"], F.lit("T"), begins)), end=end, venue_name=label(first("locations")),
        street=F.col("_adr.streetAddress"), postal_code=F.col("_adr.postalCode"), city=F.coalesce(F.nullif("_adr.addressLocality", F.lit("")), F.lit("Berlin")),
        is_free=F.when(F.col("admission.ticketType") == "ticketType.freeOfCharge", True), category_raw=F.substring_index(tag, ".", -1), description=F.col("_a.description.de"),
        description_public=F.lit(True), event_status=F.when(F.col("scheduleStatus") == "event.cancelled", "cancelled").otherwise("scheduled"),
    )


# Open lists of street fairs and Christmas markets: maps of strings, with names of their own.

LISTS = {"strassen-volksfeste": ("festivals", "bezeichnung", "plz"), "weihnachtsmaerkte": ("markets_fairs", "name", "plz_ort")}
CONTACT_KEYS = ["mail", "email", "veranstalter", "telefon", "tel", "fax"]


def open_list(items: DataFrame, endpoint: str) -> DataFrame:
    """items: (item map<string,string>). Rows without title, start or link go; contacts never reach the payload."""
    _, title, postal = LISTS[endpoint]
    v = lambda k: F.trim(F.coalesce(F.try_element_at("item", F.lit(k)), F.lit("")))
    df = items.where((v(title) != "") & (v("von") != "") & (v("www") != ""))
    kept = F.map_filter("item", lambda k, x: ~k.isin(CONTACT_KEYS))
    street = F.nullif(v("strasse"), F.lit(""))
    return raw(
        df,
        source=F.lit("berlin_de"), source_event_id=F.concat(F.lit(f"{endpoint}-"), F.try_element_at("item", F.lit("id"))), source_url=text.ensure_scheme(v("www")), title=v(title), start=v("von"), end=F.nullif(v("bis"), F.lit("")),
        venue_name=street, street=street, postal_code=F.nullif(F.substring(v(postal), 1, 5), F.lit("")), city=F.lit("Berlin"), category_raw=F.lit(endpoint),
        description=F.nullif(F.concat_ws(" ", F.nullif(v("zeit"), F.lit("")), F.nullif(v("bemerkungen"), F.lit(""))), F.lit("")), description_public=F.lit(True), event_status=F.lit("scheduled"), payload=F.to_json(kept),
    )


# Courses: one big nested file, in which single objects and lists of objects take turns.

COURSE_SCHEMA = "guid string, nummer string, name string, untertitel string, bezirk string, veranstaltungsart string, dvv_kategorie struct<`@version`:string,`#text`:string>, aktuelle_teilnehmerzahl string, maximale_teilnehmerzahl string, beginn_datum string, ende_datum string, schlagwort string, text string, ortetermine struct<adresse:string,termin:string>, preis struct<betrag:string,rabatt_moeglich:string,zusatz:string>, webadresse struct<typ:string,name:string,uri:string>"
SKIP_KINDS, SKIP_WORDS = ["Beratung", "Prüfungsbezogener Kurs"], ["Prüfungstermin"]


def as_list(c: Column, item: str) -> Column:
    """A field read as text, which holds an object or a list of objects, as a list."""
    return F.when(F.ltrim(c).startswith("["), F.from_json(c, f"array<{item}>")).when(c.isNotNull(), F.array(F.from_json(c, item)))


def words_list(c: Column) -> Column:
    return F.when(F.ltrim(c).startswith("["), F.from_json(c, "array<string>")).when(c.isNotNull(), F.array(c))


def courses(records: DataFrame, as_of: str, days: int) -> DataFrame:
    horizon = F.date_add(F.lit(as_of).cast("date"), days).cast("string")
    inside = lambda c: (c >= as_of) & (c <= horizon)
    df = records.where(inside(F.col("beginn_datum")))  # most courses lie outside
    sessions = F.array_sort(F.transform(F.filter(as_list(F.col("ortetermine.termin"), "struct<beginn_datum:string,beginn_uhrzeit:string,ende_uhrzeit:string>"), lambda s: F.coalesce(s["beginn_datum"], F.lit("")) != ""), lambda s: F.struct(s["beginn_datum"].alias("day"), F.coalesce(s["beginn_uhrzeit"], F.lit("")).alias("begins"), F.coalesce(s["ende_uhrzeit"], F.lit("")).alias("ends"))))
    address = F.get(as_list(F.col("ortetermine.adresse"), "struct<lehrstaette:string,raum:string,strasse:string,plz:string,ort:string,breitengrad:string,laengengrad:string>"), F.lit(0))
    prose = F.get(F.filter(as_list(F.col("text"), "struct<eigenschaft:string,text:string>"), lambda t: t["eigenschaft"] == "Beschreibung"), F.lit(0))["text"]
    df = df.withColumns({"_s": sessions, "_adr": address, "_body": plain(F.coalesce(prose, F.lit(""))), "_link": F.trim("webadresse.uri")})
    now, most = F.col("aktuelle_teilnehmerzahl").try_cast("int"), F.col("maximale_teilnehmerzahl").try_cast("int")
    full = F.coalesce((now >= most) & (most > 0), F.lit(False))
    blob = F.lower(F.concat_ws(" ", "_adr.lehrstaette", "_adr.raum", "_adr.strasse"))
    skipped = F.coalesce(F.col("veranstaltungsart").isin(SKIP_KINDS), F.lit(False)) | full | F.coalesce(F.arrays_overlap(words_list(F.col("schlagwort")), F.array(*map(F.lit, SKIP_WORDS))), F.lit(False)) | blob.contains("online") | blob.contains("digital")
    df = df.where((F.coalesce(F.trim("name"), F.lit("")) != "") & (F.coalesce(F.trim("guid"), F.lit("")) != "") & text.has_external_link(F.col("_link"), RECORD_HOSTS) & ~skipped & (F.size("_s") > 0))
    one, last = F.get("_s", F.lit(0)), F.element_at("_s", -1)
    df = df.where(inside(one["day"]))
    german = lambda c: F.date_format(c.cast("date"), "dd.MM.yyyy")
    lead = F.when(F.size("_s") > 1, F.concat(F.lit("Kurs mit "), F.size("_s").cast("string"), F.lit(" Terminen, "), german(one["day"]), F.lit(" bis "), german(last["day"]), F.lit(".")))
    sub = blank(F.col("untertitel"))
    sub = F.when(sub.rlike(r"[.!?]$"), sub).otherwise(F.concat(sub, F.lit(".")))
    amount, extra = number(F.col("preis.betrag")), blank(F.col("preis.zusatz"))
    return raw(
        df,
        source=F.lit("vhs"), source_event_id=F.trim("guid"), source_url=F.regexp_replace("_link", r"^http://www\.vhsit\.berlin\.de/", "https://www.vhsit.berlin.de/"), title=F.trim("name"),
        start=F.when(one["begins"] != "", F.concat(one["day"], F.lit("T"), one["begins"], F.lit(":00"))).otherwise(one["day"]), end=F.when((one["begins"] != "") & (one["ends"] > one["begins"]), F.concat(one["day"], F.lit("T"), one["ends"], F.lit(":00"))),
        venue_name=blank(F.col("_adr.lehrstaette")), street=blank(F.substring_index("_adr.strasse", ",", 1)), postal_code=blank(F.col("_adr.plz")), city=F.coalesce(blank(F.col("_adr.ort")), F.lit("Berlin")), lat=number(F.col("_adr.breitengrad")), lon=number(F.col("_adr.laengengrad")),
        price_value=amount, price_text=F.concat(general(amount), F.lit(" €"), F.coalesce(F.concat(F.lit(" ("), extra, F.lit(")")), F.lit(""))), is_free=F.when(amount == 0, True),
        category_raw=F.concat(F.coalesce(F.col("dvv_kategorie.`#text`"), F.lit("")), F.lit("|"), F.coalesce("veranstaltungsart", F.lit(""))), description=F.nullif(F.substring(F.concat_ws(" ", lead, sub, F.nullif("_body", F.lit(""))), 1, 1500), F.lit("")), description_public=F.lit(True), event_status=F.lit("scheduled"),
        payload=F.to_json(F.struct("guid", "nummer", "bezirk", F.size("_s").alias("sessions"))),
    )


def course_category(category_raw: Column) -> Column:
    code, kind = F.substring_index(category_raw, "|", 1), F.regexp_extract(category_raw, r"^[^|]*\|(.*)$", 1)
    return F.when(kind == "Einzelveranstaltung/Vortrag", "talks_literature").when(code == "3.05", "food_drink").when(code.isin("3.01", "3.02"), "sports_fitness")


# The ticket seller's API.

TICKET_SCHEMA = "id string, name string, url string, dates struct<start:struct<dateTime:string,localDate:string,dateTBD:boolean>,status:struct<code:string>>, classifications array<struct<segment:struct<name:string>,genre:struct<name:string>>>, priceRanges array<struct<min:double,max:double>>, images array<struct<url:string,width:int,attribution:string>>, _embedded struct<venues:array<struct<name:string,postalCode:string,address:struct<line1:string>,city:struct<name:string>,location:struct<latitude:string,longitude:string>>>>"


def tickets(records: DataFrame) -> DataFrame:
    start = F.coalesce(F.nullif("dates.start.dateTime", F.lit("")), F.nullif("dates.start.localDate", F.lit("")))
    df = records.where((F.coalesce(F.trim("name"), F.lit("")) != "") & start.isNotNull() & (F.coalesce("url", F.lit("")) != ""))
    venue, kind = F.get("_embedded.venues", F.lit(0)), F.get("classifications", F.lit(0))
    low, high = F.array_min(F.transform("priceRanges", lambda p: p["min"])), F.array_max(F.transform("priceRanges", lambda p: p["max"]))
    widest = F.get(F.array_sort(F.transform("images", lambda x, k: F.struct((-F.coalesce(x["width"], F.lit(0))).alias("w"), k.alias("k"), x["url"].alias("url"), x["attribution"].alias("credit")))), F.lit(0))
    return raw(
        df,
        source=F.lit("ticketmaster"), source_event_id=F.col("id"), source_url=F.col("url"), title=F.trim("name"), start=start, venue_name=venue["name"], street=venue["address"]["line1"], postal_code=venue["postalCode"],
        city=F.coalesce(F.nullif(venue["city"]["name"], F.lit("")), F.lit("Berlin")), lat=venue["location"]["latitude"].try_cast("double"), lon=venue["location"]["longitude"].try_cast("double"),
        price_text=euros(low, high), price_value=F.when(low == high, low), image_url=widest["url"], image_credit=F.when(widest["url"].isNotNull(), widest["credit"]),
        category_raw=F.concat(kind["segment"]["name"], F.lit("|"), F.coalesce(kind["genre"]["name"], F.lit("None"))), event_status=F.when((F.col("dates.status.code") == "cancelled") & ~F.col("dates.start.dateTBD"), "cancelled").otherwise("scheduled"),
    )


def ticket_category(segment: Column, genre: Column) -> Column:
    g = F.lower(F.coalesce(genre, F.lit("")))
    return (
        F.when(segment == "Sports", "sports_fitness")
        .when(segment == "Film", "film_cinema")
        .when((segment == "Music") & (g.contains("dance") | g.contains("electronic")), "club_nightlife")
        .when(segment == "Music", "live_music")
        .when((segment == "Arts & Theatre") & g.contains("comedy"), "comedy")
        .when((segment == "Arts & Theatre") & (g.contains("fine art") | (g == "art")), "art_exhibitions")
        .when(segment == "Arts & Theatre", "theatre_performance")
    )


# Club listings.

CLUB_SCHEMA = "event struct<id:string,title:string,startTime:string,endTime:string,contentUrl:string,cost:string,flyerFront:string,images:array<struct<filename:string,type:string>>,venue:struct<name:string,location:struct<latitude:double,longitude:double>>>"


def clubs(records: DataFrame) -> DataFrame:
    e = F.col("event")
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    df = records.where(some(e["id"]) & some(e["title"]) & some(e["startTime"]) & some(e["contentUrl"]))
    front = F.get(F.filter(e["images"], lambda x: x["type"] == "FLYERFRONT"), F.lit(0))["filename"]
    flyer = F.coalesce(F.nullif(front, F.lit("")), F.nullif(F.get(e["images"], F.lit(0))["filename"], F.lit("")), e["flyerFront"])
    cost = blank(e["cost"])
    return raw(
        df,
        source=F.lit("ra"), source_event_id=e["id"], source_url=F.concat(F.lit("https://ra.co"), e["contentUrl"]), title=e["title"], start=e["startTime"], end=e["endTime"], venue_name=e["venue"]["name"], city=F.lit("Berlin"),
        lat=e["venue"]["location"]["latitude"], lon=e["venue"]["location"]["longitude"], price_value=number(cost), price_text=cost, event_status=F.lit("scheduled"),
        image_url=F.when(flyer.startswith("http"), flyer).otherwise(F.concat(F.lit("https://imgproxy.ra.co/_/quality:66/"), flyer)), payload=F.to_json(F.struct("event")),
    )


# Venues that run the common calendar plug-in.

PLUGIN_SCHEMA = "id string, title string, url string, start_date string, end_date string, all_day boolean, description string, excerpt string, cost string, cost_details struct<values:array<string>>, image struct<url:string>, venue struct<venue:string,address:string,zip:string,city:string,geo_lat:string,geo_lng:string>"


def plugin(records: DataFrame, source: str, house: str | None = None) -> DataFrame:
    title, whole = plain(F.coalesce("title", F.lit(""))), F.coalesce("all_day", F.lit(False))
    df = records.where((title != "") & (F.coalesce("start_date", F.lit("")) != "") & F.col("id").isNotNull() & (F.coalesce("url", F.lit("")) != ""))
    nums = F.array_sort(F.array_distinct(F.filter(F.transform("cost_details.values", number), lambda x: x.isNotNull())))
    many, one = F.coalesce(F.size(nums) >= 2, F.lit(False)), F.coalesce(F.size(nums) == 1, F.lit(False))
    iso = lambda c: F.replace(c, F.lit(" "), F.lit("T"))
    return raw(
        df,
        source=F.lit(source), source_event_id=F.col("id"), source_url=F.col("url"), title=title, start=F.when(whole, F.substring("start_date", 1, 10)).otherwise(iso(F.col("start_date"))), end=F.when(~whole, iso(F.nullif("end_date", F.lit("")))),
        venue_name=F.coalesce(plain(F.nullif("venue.venue", F.lit(""))), F.lit(house)), street=F.col("venue.address"), postal_code=F.col("venue.zip"), city=F.coalesce(F.nullif("venue.city", F.lit("")), F.lit("Berlin")), lat=F.col("venue.geo_lat").try_cast("double"), lon=F.col("venue.geo_lng").try_cast("double"),
        price_value=F.when(one, F.get(nums, F.lit(0))), price_text=F.when(many, euros(F.array_min(nums), F.array_max(nums))).when(~one, blank(F.col("cost"))), image_url=F.col("image.url"), event_status=F.lit("scheduled"),
        description=F.nullif(F.substring(plain(F.coalesce(F.nullif("description", F.lit("")), F.col("excerpt"), F.lit(""))), 1, 1500), F.lit("")),
    )


# The ticket marketplace's listing pages (objects cut out of the page by sources.web.embedded_json).

MARKET_SCHEMA = "id string, name string, url string, start_date string, start_time string, end_date string, end_time string, hide_end_date boolean, is_online_event boolean, is_free boolean, is_cancelled boolean, summary string, image struct<url:string>, primary_venue struct<name:string,address:struct<address_1:string,postal_code:string,city:string,latitude:string,longitude:string>>, tags array<struct<prefix:string,tag:string,display_name:string>>"
# Category numbers and words of subcategories.
MARKET_CATEGORIES = {"104": "film_cinema", "108": "sports_fitness", "110": "food_drink", "115": "family_kids", "101": "community_causes", "102": "community_causes", "111": "community_causes", "112": "community_causes", "113": "community_causes", "114": "community_causes"}
CLUB_WORDS, ART_WORDS = ["edm", "electronic", "dance", "dj", "techno", "house", "club"], ["fine art", "kunst", "design", "photograph", "sculpt", "paint"]


def market(records: DataFrame) -> DataFrame:
    some = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    df = records.where(some("name") & some("start_date") & ~F.coalesce("is_online_event", F.lit(False)) & some("url"))
    at = lambda d, t: F.when(some(t), F.concat(F.col(d), F.lit("T"), F.col(t))).otherwise(F.col(d))
    tag = lambda p, f: F.try_element_at(F.filter("tags", lambda x: x["prefix"] == p), F.lit(-1))[f]
    a = F.col("primary_venue.address")
    return raw(
        df,
        source=F.lit("eventbrite"), source_event_id=F.col("id"), source_url=F.col("url"), title=F.trim("name"), start=at("start_date", "start_time"), end=F.when(some("end_date") & ~F.coalesce("hide_end_date", F.lit(False)), at("end_date", "end_time")),
        venue_name=F.col("primary_venue.name"), street=a["address_1"], postal_code=a["postal_code"], city=F.coalesce(F.nullif(a["city"], F.lit("")), F.lit("Berlin")), lat=a["latitude"].try_cast("double"), lon=a["longitude"].try_cast("double"),
        is_free=F.when(F.col("is_free"), True), image_url=F.col("image.url"), category_raw=F.concat(F.substring_index(tag("EventbriteCategory", "tag"), "/", -1), F.lit("|"), F.coalesce(tag("EventbriteSubCategory", "display_name"), F.lit(""))),
        description=F.nullif(F.substring("summary", 1, 1500), F.lit("")), event_status=F.when(F.col("is_cancelled"), "cancelled").otherwise("scheduled"),
    )


def market_category(category_raw: Column) -> Column:
    number_, sub = F.substring_index(category_raw, "|", 1), F.lower(F.regexp_extract(category_raw, r"^[^|]*\|(.*)$", 1))
    club, art = (sub.rlike("|".join(w)) for w in (CLUB_WORDS, ART_WORDS))
    return F.when(number_ == "103", F.when(club, "club_nightlife").otherwise("live_music")).when(number_ == "105", F.when(art, "art_exhibitions").otherwise("theatre_performance")).otherwise(looked_up(MARKET_CATEGORIES, number_))


# Parts of addresses that tell a category, in order.
PATH_CATEGORIES = {
    "konzert": "live_music", "party": "club_nightlife", "buehne": "theatre_performance", "kabarett": "comedy", "comedy": "comedy", "ausstellung": "art_exhibitions", "kunst": "art_exhibitions", "film": "film_cinema", "kino": "film_cinema",
    "lesung": "talks_literature", "literatur": "talks_literature", "vortrag": "talks_literature", "workshop": "workshops_classes", "markt": "markets_fairs", "festival": "festivals", "sport": "sports_fitness", "kinder": "family_kids", "familie": "family_kids",
}


def path_category(url: Column) -> Column:
    out, low = None, F.lower(url)
    for part, category in PATH_CATEGORIES.items():
        hit = low.contains(f"/{part}") | low.contains(f"-{part}")
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return out
