"""Venue resolution against an index of names and aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalends.functions import text

LEAST = 5


def index(venues: DataFrame) -> DataFrame:
    """(name_key, ordinal, venue_id, prior) from venues (ordinal, venue_id, name, aliases, prior). A repeated key keeps
    its first place and its last entry."""
    names = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = venues.select("ordinal", "venue_id", "prior", F.posexplode(names).alias("_k", "name")).withColumn("name_key", text.norm_name(F.col("name")))
    place = F.struct("ordinal", "_k")
    return rows.groupBy("name_key").agg(F.min(place).alias("at"), F.max_by(F.struct("venue_id", "prior"), place).alias("entry")).select("name_key", F.col("at").alias("ordinal"), "entry.venue_id", "entry.prior")


def resolve(names: DataFrame, indexed: DataFrame) -> DataFrame:
    """(venue_name, venue_id, prior) of each distinct name: an equal key, else the first key in index order of five
    letters or more that contains the name's key or is contained in it.

    Containment is looked up through shared pieces of five letters, so names meet only the keys they overlap; a key
    contained in a name shares its first piece with it, and the other way round. Names of fewer letters than a piece
    are met with the keys that hold them, which only such short names need."""
    keyed = names.select("venue_name").where("venue_name is not null and trim(venue_name) <> ''").distinct().withColumn("_key", text.norm_name(F.col("venue_name")))
    exact = keyed.join(indexed, keyed["_key"] == indexed["name_key"], "left").select("venue_name", "_key", F.col("venue_id").alias("_id"), F.col("prior").alias("_prior"), F.col("ordinal").isNotNull().alias("_hit"))
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(c) - (LEAST - 1), F.lit(1))), lambda k: F.substring(c, k, F.lit(LEAST))))
    open_ = exact.where("not _hit")
    longer = indexed.where(F.char_length("name_key") >= LEAST)
    pieces = open_.where(F.char_length("_key") >= LEAST).withColumn("_g", F.explode(grams(F.col("_key"))))
    # either side's first piece occurs in the other one
    ours = pieces.join(longer.withColumn("_g", F.substring("name_key", 1, LEAST)), "_g").where(F.col("_key").contains(F.col("name_key")))
    firsts = open_.where(F.char_length("_key") >= LEAST).withColumn("_g", F.substring("_key", 1, LEAST))
    theirs = firsts.join(longer.withColumn("_g", F.explode(grams(F.col("name_key")))), "_g").where(F.col("name_key").contains(F.col("_key")))
    small = open_.where(F.char_length("_key") < LEAST)
    bits = longer.withColumn("_g", F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEAST - 1)), lambda n: F.transform(F.sequence(F.lit(1), F.char_length("name_key")), lambda k: F.substring("name_key", k, n)))))))
    shorts = small.join(bits.where("_g <> ''"), small["_key"] == F.col("_g")).unionByName(small.where("_key = ''").join(longer.orderBy("ordinal").limit(1), F.lit(True)), allowMissingColumns=True)
    found = [x.select("venue_name", "ordinal", "venue_id", "prior") for x in (ours, theirs, shorts)]
    best = found[0].unionByName(found[1]).unionByName(found[2]).groupBy("venue_name").agg(F.min_by(F.struct("venue_id", "prior"), "ordinal").alias("_best"))
    return exact.join(best, "venue_name", "left").select("venue_name", F.when(F.col("_hit"), F.col("_id")).otherwise(F.col("_best.venue_id")).alias("venue_id"), F.when(F.col("_hit"), F.col("_prior")).otherwise(F.col("_best.prior")).alias("prior"))


def seed(known: DataFrame, curated: DataFrame) -> DataFrame:
    """Curated venues are added where their id is not known yet."""
    return known.unionByName(curated.join(known.select("venue_id"), "venue_id", "left_anti").select(known.columns))


def first_session(sessions: DataFrame, key: str) -> DataFrame:
    """The first session of each course by date and time."""
    w = Window.partitionBy(key).orderBy(F.asc_nulls_last("date"), F.asc_nulls_last("time"))
    return sessions.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
