"""The classification cascade."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalends.config import CATEGORIES, FAMILIES, FAMILY_PRIORITY, SCHEMA_TYPES, TAG_FAMILIES

NONE = "struct<category:string,confidence:double,tier:string,tags:array<string>>"


def pattern(parts: list[str]) -> str:
    return "(?iuU)" + "|".join(parts)


def tags(text: Column, families: dict[str, list[str]] = TAG_FAMILIES) -> Column:
    """Tags whose family occurs; additive, never deciding the category."""
    return F.filter(F.array(*(F.when(text.rlike(pattern(p)), t) for t, p in families.items())), lambda x: x.isNotNull())


def family_counts(text: Column, families: dict[str, list[str]] = FAMILIES) -> Column:
    """array of struct(n, rank, category) with n over 0; rank grows with preference."""
    entry = lambda c, p: F.struct(F.regexp_count(text, F.lit(pattern(p))).alias("n"), F.lit(-FAMILY_PRIORITY.index(c) if c in FAMILY_PRIORITY else -99).alias("rank"), F.lit(c).alias("category"))
    return F.filter(F.array(*(entry(c, p) for c, p in families.items())), lambda x: x["n"] > 0)


def classify(title: Column, description: Column, schema_type: Column, source_prior: Column, mapped: Column, venue_prior: Column, best_effort: bool = True, families: dict[str, list[str]] = FAMILIES, tag_families: dict[str, list[str]] = TAG_FAMILIES) -> Column:
    """struct(category, confidence, tier, tags), null if nothing decides. In order: the source's prior, the adapter's
    mapping, the schema.org type (dance events are club nights in clubs, else theatre), the venue's prior, a single keyword family, and, with
    best_effort, the family with the most matches, ties by preference."""
    text = F.concat(title, F.lit(" "), F.coalesce(description, F.lit("")))
    found = tags(text, tag_families)
    hits = family_counts(text, families)
    types = F.create_map(*(F.lit(x) for kv in SCHEMA_TYPES.items() for x in kv))
    known = lambda c: F.coalesce(c.isin(CATEGORIES), F.lit(False))
    out = lambda c, conf, tier: F.struct(c.alias("category"), F.lit(conf).alias("confidence"), F.lit(tier).alias("tier"), found.alias("tags")).cast(NONE)
    kind = F.substring_index(schema_type, "/", -1)
    by_type = F.try_element_at(types, kind)
    chain = (
        F.when(known(source_prior), out(source_prior, 1.0, "source_prior"))
        .when(known(mapped), out(mapped, 0.95, "source_field"))
        .when(kind == "DanceEvent", out(F.when(venue_prior == "club_nightlife", venue_prior).otherwise(F.lit("theatre_performance")), 0.85, "source_field"))
        .when(by_type.isNotNull(), out(by_type, 0.9, "source_field"))
        .when(known(venue_prior), out(venue_prior, 0.8, "venue_prior"))
        .when(F.size(hits) == 1, out(hits[0]["category"], 0.7, "keyword"))
    )
    return chain.when(F.size(hits) > 1, out(F.array_max(hits)["category"], 0.5, "keyword_multi")) if best_effort else chain
