"""Identifiers and hashes as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Crockford's alphabet.
ALPHABET = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def base32(hex128: Column) -> Column:
    """32 hexadecimal digits as 26 letters of five bits."""
    nibbles = F.transform(F.split(hex128, ""), lambda c: F.lpad(F.conv(c, 16, 2), 4, "0"))
    bits = F.concat(F.lit("00"), F.array_join(nibbles, ""))
    five = F.transform(F.sequence(F.lit(0), F.lit(25)), lambda k: F.substring(F.lit(ALPHABET), F.conv(F.substring(bits, k * 5 + 1, F.lit(5)), 2, 10).cast("int") + 1, F.lit(1)))
    return F.array_join(five, "")


def derived(prefix: str, *parts: Column) -> Column:
    """prefix_ and the base-32 form of the first 128 bits of the SHA-256 of the parts, apart by NUL."""
    digest = F.sha2(F.concat_ws("\x00", *parts).cast("binary"), 256)
    return F.concat(F.lit(f"{prefix}_"), base32(F.substring(digest, 1, 32)))


def event_id(source: Column, source_event_id: Column) -> Column:
    return derived("evt", source, source_event_id)


def occurrence_id(event: Column, starts_at_utc: Column) -> Column:
    return derived("occ", event, starts_at_utc)


def short_hash(s: Column, n: int = 8) -> Column:
    return F.substring(F.sha1(s.cast("binary")), 1, n)


def series_key(url: Column, event: Column) -> Column:
    """Twelve digits of the url's hash, or of the id's where there is no url."""
    return short_hash(F.coalesce(F.nullif(url, F.lit("")), event), 12)


def placeholder_lock(key: Column) -> Column:
    """A stable number below 99,991."""
    return F.conv(short_hash(key), 16, 10).cast("long") % 99991


def content_hash(*columns: Column) -> Column:
    """SHA-256 over the columns as text, nulls marked, apart by the unit separator."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns)).cast("binary"), 256)
