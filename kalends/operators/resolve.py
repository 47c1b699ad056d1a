"""Entity resolution: date-blocked fuzzy matching, clusters, heads, aliases, filled fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalends.config import LAST_PRIORITY, SOURCE_PRIORITY
from kalends.functions import geo, text
from kalends.operators.graph import components, cut

# Thresholds of the match rule.
TITLE, VENUE, NEAR = 90, 85, 80
CLOSE_M, TIGHT_M, CLOSE_S = 250, 100, 15 * 60


def priority(source: Column, table: dict[str, int] = SOURCE_PRIORITY) -> Column:
    ranks = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.coalesce(F.try_element_at(ranks, source), F.lit(LAST_PRIORITY))


def candidates(events: DataFrame, occurrences: DataFrame, as_of: Column) -> DataFrame:
    """One row for each future slot of events that are no ranges, with normalised names and the block (the night)."""
    slots = occurrences.where(F.col("nightlife_date") >= as_of).select("event_id", "nightlife_date", F.unix_seconds(F.to_timestamp("starts_at_utc")).alias("start_s"))
    named = events.where(~F.col("is_range")).select("event_id", "source", "venue_id", "lat", "lon", text.norm_title(F.col("title")).alias("t"), F.coalesce(text.norm_name(F.col("venue_name")), F.lit("")).alias("v"))
    return named.join(slots, "event_id")


def pairs(slots: DataFrame) -> DataFrame:
    """(u, v, title_score, venue_score, matched, near_miss) of slots of one night that could match or nearly do.

    Pairs meet on (night, token of the title), (night, venue) or (night, square of the map), and by titles of one night
    that are alike by their letters alone. Built-in predicates then drop pairs whose titles cannot reach the near-miss
    band and that share no place; Python scores the rest. Returns these pairs only. Where only their number is asked
    for, :func:`kalends.operators.links.links` counts them without listing any."""
    met = _met(slots)
    side = lambda p: slots.dropDuplicates(["event_id"]).select(F.col("event_id").alias(p), *(F.col(c).alias(f"{p}_{c}") for c in ("source", "venue_id", "lat", "lon", "t", "v")))
    full = met.join(side("u"), "u").join(side("v"), "v")
    return _scored(full)


def _met(slots: DataFrame) -> DataFrame:
    """(u, v, us, vs): the pairs that :func:`pairs` looks at, with their starts."""
    tokens = slots.withColumn("_keys", F.array_distinct(F.concat(F.transform(F.split("t", " "), lambda x: F.concat(F.lit("t:"), x)), F.when(F.col("venue_id").isNotNull(), F.array(F.concat(F.lit("v:"), F.col("venue_id")))).otherwise(F.array().cast("array<string>")), _cells())))
    keyed = tokens.select("event_id", "nightlife_date", "start_s", F.explode("_keys").alias("_key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    near = (F.col("a.nightlife_date") == F.col("b.nightlife_date")) & (F.col("a._key") == F.col("b._key")) & (F.col("a.event_id") < F.col("b.event_id"))
    met = a.join(b, near).select(F.col("a.event_id").alias("u"), F.col("b.event_id").alias("v"), F.col("a.start_s").alias("us"), F.col("b.start_s").alias("vs"))
    return met.unionByName(_by_letters(slots)).distinct()


def _by_letters(slots: DataFrame) -> DataFrame:
    """(u, v, us, vs) of slots of one night whose titles could reach the near-miss band without a common token.

    Without one the score is 200 * lcs / (n + m) of the sorted titles' lengths. So the longer has at most 1.5 times the
    shorter's length, which keeps pairs within neighbouring bands of length, and edits with replacement, never more
    than the n + m - 2 * lcs insertions and deletions, are at most a fifth of n + m. Each title of a night is compared
    once, however many slots have it."""
    words = F.array_sort(F.filter(F.array_distinct(F.split("t", " ")), lambda x: x != ""))
    named = slots.select("event_id", "nightlife_date", "start_s", F.array_join(words, " ").alias("line")).where("line <> ''")
    longest = (200 - NEAR) / NEAR
    lines = named.select("nightlife_date", "line", F.char_length("line").alias("n")).distinct().withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(longest))))
    b = lines.select("nightlife_date", F.col("line").alias("other"), F.col("n").alias("m"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    edits = f"levenshtein(line, other, cast(floor((n + m) * {1 - NEAR / 100!r} + 1e-6) as int)) >= 0"
    alike = lines.join(b, ["nightlife_date", "band"]).where("line < other and not arrays_overlap(split(line, ' '), split(other, ' '))").where(F.expr(edits)).select("nightlife_date", "line", "other")
    one = named.select("nightlife_date", "line", F.col("event_id").alias("x"), F.col("start_s").alias("xs"))
    two = named.select("nightlife_date", F.col("line").alias("other"), F.col("event_id").alias("y"), F.col("start_s").alias("ys"))
    rows = alike.join(one, ["nightlife_date", "line"]).join(two, ["nightlife_date", "other"]).where("x <> y")
    side = lambda a, b: F.when(F.col("x") < F.col("y"), F.col(a)).otherwise(F.col(b))
    return rows.select(side("x", "y").alias("u"), side("y", "x").alias("v"), side("xs", "ys").alias("us"), side("ys", "xs").alias("vs"))


def _cells() -> Column:
    """Keys of the 0.005-degree squares around a place, so that places within 250 m share one."""
    there = (F.coalesce(F.col("lat"), F.lit(0.0)) != 0) & (F.coalesce(F.col("lon"), F.lit(0.0)) != 0)
    cell = lambda dx, dy: F.concat_ws(":", F.lit("g"), F.floor(F.col("lat") * 200) + dx, F.floor(F.col("lon") * 100) + dy)
    return F.when(there, F.array(*(cell(dx, dy) for dx in (0, 1) for dy in (0, 1)))).otherwise(F.array().cast("array<string>"))


def _title_bound() -> Column:
    """What the titles' similarity cannot exceed, by built-in functions: edits with replacement are never more than
    insertions and deletions."""
    words = lambda c: F.filter(F.array_distinct(F.split(c, " ")), lambda x: x != "")
    u, v = words("u_t"), words("v_t")
    shared, left, right = F.array_intersect(u, v), F.array_except(u, v), F.array_except(v, u)
    line = lambda *xs: F.array_join(F.concat(*map(F.array_sort, xs)), " ")
    s, one, two = line(shared), line(shared, left), line(shared, right)
    n = F.char_length
    whole = 100 - 100 * F.levenshtein(one, two) / F.greatest(n(one) + n(two), F.lit(1))
    part = lambda x: F.when(n(s) > 0, 200 * n(s) / (n(s) + n(x))).otherwise(0.0)
    return F.when((F.size(shared) > 0) & ((F.size(left) == 0) | (F.size(right) == 0)), 100.0).otherwise(F.greatest(whole, part(one), part(two)))


def _scored(full: DataFrame) -> DataFrame:
    placed = F.lit(True)
    for c in ("u_lat", "u_lon", "v_lat", "v_lon"):
        placed = placed & (F.coalesce(F.col(c), F.lit(0.0)) != 0)  # zero counts as missing
    metres = F.when(placed, geo.haversine_m(F.col("u_lat"), F.col("u_lon"), F.col("v_lat"), F.col("v_lon")))
    same_venue = F.coalesce((F.col("u_venue_id") != "") & (F.col("u_venue_id") == F.col("v_venue_id")), F.lit(False))
    close = lambda m: F.coalesce(F.col("metres") <= m, F.lit(False))
    full = full.withColumns({"metres": metres, "same_venue": same_venue}).where((_title_bound() >= NEAR) | F.col("same_venue") | close(TIGHT_M))
    scored = full.withColumns({"title_score": text.token_set_similarity(F.col("u_t"), F.col("v_t")), "venue_score": text.token_set_similarity(F.col("u_v"), F.col("v_v"))})
    matched = ((F.col("title_score") >= TITLE) & ((F.col("venue_score") >= VENUE) | F.col("same_venue") | close(CLOSE_M))) | ((F.col("same_venue") | close(TIGHT_M)) & (F.abs(F.col("us") - F.col("vs")) <= CLOSE_S))
    near_miss = ~F.col("matched") & (F.col("title_score") >= NEAR) & (F.col("title_score") < TITLE) & (F.col("u_source") != F.col("v_source"))
    return scored.withColumn("matched", matched).withColumn("near_miss", near_miss).select("u", "v", "title_score", "venue_score", "matched", "near_miss")


def incumbents(events: DataFrame) -> DataFrame:
    """(event_id, n): for how many other events an id is the head now."""
    return events.where(F.col("canonical_id") != F.col("event_id")).groupBy(F.col("canonical_id").alias("event_id")).agg(F.count("*").alias("n"))


def heads(events: DataFrame, edges: DataFrame) -> DataFrame:
    """(event_id, head) of all members of clusters of two or more: incumbents first, then the source's priority, then the id."""
    parts = components(edges).select(F.col("node").alias("event_id"), "component")
    ranked = parts.join(events.select("event_id", "source"), "event_id").join(incumbents(events), "event_id", "left")
    best = ranked.groupBy("component").agg(F.min_by("event_id", F.struct(-F.coalesce("n", F.lit(0)), priority(F.col("source")), "event_id")).alias("head"))
    return ranked.join(best, "component").select("event_id", "head")


def fill_heads(events: DataFrame, members: DataFrame, order: list[Column]) -> DataFrame:
    """Heads with missing image (with its credit), latitude, longitude and venue taken from the first member that has
    one, each on its own, and an unknown price from the first member that knows it. Others stay as they are."""
    w = Window.partitionBy("head").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = members.where("event_id <> head").join(events, "event_id")
    first = lambda c: F.first(c, ignorenulls=True).over(w)
    image = F.when(F.coalesce("image_url", F.lit("")) != "", F.struct("image_url", "image_credit"))
    price = F.when(F.col("price.type") != "unknown", F.col("price"))
    gifts = rows.select("head", first(image).alias("_image"), first(F.col("lat")).alias("_lat"), first(F.col("lon")).alias("_lon"), first(F.nullif("venue_id", F.lit(""))).alias("_venue"), first(price).alias("_price")).distinct()
    joined = events.join(gifts.withColumnRenamed("head", "event_id"), "event_id", "left")
    bare = F.coalesce("image_url", F.lit("")) == ""
    filled = {
        "image_credit": F.when(bare & F.col("_image").isNotNull(), F.col("_image.image_credit")).otherwise(F.col("image_credit")),
        "image_url": F.when(bare, F.coalesce("_image.image_url", "image_url")).otherwise(F.col("image_url")),
        "lat": F.coalesce("lat", "_lat"),
        "lon": F.coalesce("lon", "_lon"),
        "venue_id": F.coalesce(F.nullif("venue_id", F.lit("")), "_venue"),
        "price": F.when((F.col("price.type") == "unknown") & F.col("_price").isNotNull(), F.col("_price")).otherwise(F.col("price")),
    }
    return joined.withColumns(filled).select(events.columns)


def repoint_aliases(aliases: DataFrame, members: DataFrame, now: Column) -> DataFrame:
    """Aliases (alias_id, canonical_id, noted_at) after a merge: each loser points at its head, what pointed at a
    loser points at the head, too, and the first note of an alias stays. One hop is always enough."""
    losers = members.where("event_id <> head").select(F.col("event_id").alias("alias_id"), F.col("head").alias("_to"))
    moved = aliases.join(losers.select(F.col("alias_id").alias("canonical_id"), "_to"), "canonical_id", "left").select("alias_id", F.coalesce("_to", "canonical_id").alias("canonical_id"), "noted_at")
    joined = moved.join(losers, "alias_id", "full_outer")
    return joined.select("alias_id", F.coalesce("_to", "canonical_id").alias("canonical_id"), F.coalesce("noted_at", now).alias("noted_at"))


def resolve(events: DataFrame, occurrences: DataFrame, aliases: DataFrame, as_of: Column, now: Column) -> dict[str, DataFrame]:
    """One run: events with new heads and filled fields, aliases, merged sources, near misses. A member whose cluster
    no longer forms keeps its head; only heads that are gone are healed."""
    found = cut(pairs(candidates(events, occurrences, as_of)))
    members = cut(heads(events, found.where("matched").select("u", "v")))
    headed = events.join(members, "event_id", "left").withColumn("canonical_id", F.coalesce("head", "canonical_id")).select(events.columns)
    filled = fill_heads(headed, members, [priority(F.col("source")), F.col("event_id")])
    there = filled.select(F.col("event_id").alias("canonical_id"), F.lit(True).alias("_there"))
    healed = filled.join(there, "canonical_id", "left").withColumn("canonical_id", F.when(F.col("_there"), F.col("canonical_id")).otherwise(F.col("event_id"))).select(events.columns)
    sources = members.join(events.select("event_id", "source", "url"), "event_id").select(F.col("head").alias("canonical_id"), "source", "url").distinct()
    return {"events": healed, "aliases": repoint_aliases(aliases, members, now), "merged_sources": sources, "near_misses": found.where("near_miss").select("u", "v", "title_score", "venue_score")}
