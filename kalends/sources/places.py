"""Points of interest as venues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.functions import ids

SCHEMA = "type string, id long, lat double, lon double, center struct<lat:double,lon:double>, tags map<string,string>"
# Kinds of places that tell a category.
PRIORS = {"nightclub": "club_nightlife", "theatre": "theatre_performance", "cinema": "film_cinema", "arts_centre": "art_exhibitions", "gallery": "art_exhibitions", "museum": "art_exhibitions"}


def venues(elements: DataFrame, known: DataFrame) -> DataFrame:
    """New venues (venue_id, name, lat, lon, osm_id, prior) of landed elements; names already known are left out, and of
    several elements of one name the first counts. Ids follow from the name, so a second run makes the same."""
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    prior = F.try_element_at(F.create_map(*(F.lit(x) for kv in PRIORS.items() for x in kv)), F.coalesce(F.nullif(tag("amenity"), F.lit("")), tag("tourism")))
    named = elements.select(F.nullif(tag("name"), F.lit("")).alias("name"), F.coalesce("lat", "center.lat").alias("lat"), F.coalesce("lon", "center.lon").alias("lon"), F.concat_ws("/", F.coalesce("type", F.lit("n")), F.col("id").cast("string")).alias("osm_id"), prior.alias("prior"))
    fresh = named.where("name is not null").join(known.select("name").distinct(), "name", "left_anti")
    first = fresh.groupBy("name").agg(F.min_by(F.struct("lat", "lon", "osm_id", "prior"), "osm_id").alias("e"))
    return first.select(ids.derived("ven", F.col("name")).alias("venue_id"), "name", "e.lat", "e.lon", "e.osm_id", "e.prior")
