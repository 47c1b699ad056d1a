"""Publication gates: source policy, takedowns, sanity."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.config import BOXES, Policy, Settings
from kalends.functions import geo, text

# Fixed order of the takedown kinds, and the price above which a number is a mistake.
KINDS = ("events", "urls", "domains", "venues", "titles")
MAX_PRICE = 500


def rules(sections: dict[str, list]) -> dict[str, list[str]]:
    """A takedown list, checked; anything odd stops the run, for a list half read would publish what must not be."""
    if not isinstance(sections, dict) or set(sections) - set(KINDS):
        raise ValueError(f"takedowns: sections must be among {KINDS}")
    out: dict[str, list[str]] = {}
    for kind in KINDS:
        entries = sections.get(kind) or []
        if not isinstance(entries, list):
            raise ValueError(f"takedowns: {kind} must be a list")
        values = [e.get("value") if isinstance(e, dict) else e for e in entries]
        if any(v is None or not str(v).strip() for v in values):
            raise ValueError(f"takedowns: an entry under {kind} has no value")
        out[kind] = [str(v).strip() for v in values]
    return out


def takedowns(path: str | None, inline: str | None) -> dict[str, list[str]]:
    """The lists of a file and of an inline text (JSON, or YAML where a parser is there) together, each checked."""
    parts = [rules(_parsed(text)) for text in ((Path(path).read_text() if path and Path(path).exists() else None), inline) if text and text.strip()]
    return {kind: list(dict.fromkeys(v for part in parts for v in part[kind])) for kind in KINDS}


def _parsed(text: str) -> dict:
    try:
        return json.loads(text)
    except ValueError:
        pass
    try:
        import yaml
    except ImportError as e:
        raise ValueError("takedowns: not JSON, and there is no YAML parser here") from e
    try:
        return yaml.safe_load(text) or {}
    except yaml.YAMLError as e:
        raise ValueError("takedowns: neither JSON nor YAML") from e


def suppressed_by(lists: dict[str, list[str]], ids: Column, url: Column, venue: Column, title: Column) -> Column:
    """The first kind that hits, in fixed order, or null. ``ids`` is an array: the event's id and its aliases."""
    lit = lambda xs: F.array(*map(F.lit, xs)) if xs else F.array().cast("array<string>")
    events = lit(sorted({v.split("::")[0] for v in lists["events"]}))
    cleaned = [v.strip().lower().rstrip("/") for v in lists["urls"]]
    u = text.norm_url(url)
    by_url = u.isin([v for v in cleaned if not v.endswith("*")]) if any(not v.endswith("*") for v in cleaned) else F.lit(False)
    for v in cleaned:
        if v.endswith("*"):
            by_url = by_url | u.startswith(v[:-1])
    domains = [v.lower().lstrip(".") for v in lists["domains"]]
    names = [text.fold(v) for v in lists["venues"]]
    needles = [x for x in (text.fold(v) for v in lists["titles"]) if x]
    by_title = F.lit(False)
    for v in needles:
        by_title = by_title | text.norm_name(title).contains(v)
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(yes(F.arrays_overlap(F.transform(ids, lambda x: F.substring_index(x, "::", 1)), events)), "events")
        .when(yes((F.coalesce(url, F.lit("")) != "") & by_url), "urls")
        .when(yes(text.under(text.hostname(url), domains)), "domains")
        .when(yes(text.norm_name(venue).isin(names)) if names else F.lit(False), "venues")
        .when(yes(by_title), "titles")
    )


def policy_table(spark, settings: Settings) -> DataFrame:
    """A row a source; one that is permitted by hand and has no policy is permitted and nothing else."""
    rows = [(p.slug, settings.permits(p.slug), p.description, p.images, p.name, p.homepage, p.access, p.licence, p.licence_url, p.terms_url, p.attribution) for p in settings.policies]
    rows += [(slug, True, False, False, *[None] * 7) for slug in settings.permitted if all(p.slug != slug for p in settings.policies)]
    return spark.createDataFrame(rows, "source string, permitted boolean, description_ok boolean, images_ok boolean, name string, homepage string, access string, licence string, licence_url string, terms_url string, attribution string")


def gated(events: DataFrame, policies: DataFrame, reason: Column) -> DataFrame:
    """Events with _withheld: policy, the takedown kind, or null. An unregistered source is not permitted."""
    joined = events.join(F.broadcast(policies), "source", "left")  # a row for each configured source
    return joined.withColumn("_withheld", F.when(~F.coalesce("permitted", F.lit(False)), "policy").otherwise(reason))


def strip_unpublishable(events: DataFrame, policies: DataFrame) -> DataFrame:
    """Prose and pictures the policy does not cover become null."""
    joined = events.join(F.broadcast(policies.select("source", "description_ok", "images_ok")), "source", "left")
    null = lambda c, ok: F.when(F.coalesce(ok, F.lit(False)), F.col(c))
    return joined.withColumns({"description": null("description", "description_ok"), "image_url": null("image_url", "images_ok"), "image_credit": null("image_credit", "images_ok")}).select(events.columns)


def denied_domains(policies: tuple[Policy, ...], permitted: tuple[str, ...], always: tuple[str, ...]) -> list[str]:
    return sorted({d for p in policies if p.status != "active" and p.slug not in permitted for d in p.domains} | set(always))


def sane(events: DataFrame, city: str) -> DataFrame:
    """Places outside the city's box lose both coordinates; prices over 500 lose their numbers and keep their text."""
    inside = geo.inside(F.col("lat"), F.col("lon"), BOXES[city])
    too_much = F.coalesce(F.greatest("price.min", "price.max") > MAX_PRICE, F.lit(False))
    nothing = F.lit(None).cast("double")
    price = F.col("price")
    for name in ("min", "max", "presale", "door", "reduced"):
        price = price.withField(name, F.when(too_much, nothing).otherwise(F.col(f"price.{name}")))
    price = price.withField("type", F.when(too_much, "unknown").otherwise(F.col("price.type")))
    keep = lambda c: F.when(inside, F.col(c))
    return events.withColumns({"lat": keep("lat"), "lon": keep("lon"), "price": price})


def mojibake(events: DataFrame) -> DataFrame:
    return events.agg(F.count_if(F.col("title").contains("�")).alias("n_mojibake"))
