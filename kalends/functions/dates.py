"""Date parsing and occurrences. A parsed time is struct(local timestamp_ntz, offset_s int, date_only boolean):
offset_s is null where the value had no offset and stands in the city's zone. Nothing reads the clock."""

from __future__ import annotations

import datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# German months.
MONTHS = {"januar": 1, "februar": 2, "märz": 3, "maerz": 3, "april": 4, "mai": 5, "juni": 6, "juli": 7, "august": 8, "september": 9, "oktober": 10, "november": 11, "dezember": 12}
ISO = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,6})\d*)?)?\s*(Z|[+-]\d{2}(?::?\d{2})?)?$"
NUMERIC = r"(?U)(\d{1,2})\.(\d{1,2})\.(\d{2,4})"
NAMED = r"(?iuU)(\d{1,2})\.?\s*(" + "|".join(MONTHS) + r")\w*\s*(\d{4})?"
TIME = r"(?iuU)(\d{1,2}):(\d{2})(?:\s*uhr)?|(\d{1,2})\.(\d{2})\s*uhr|(\d{1,2})\s*uhr"
KIND = "struct<local:timestamp_ntz,offset_s:int,date_only:boolean>"


def _int(s: Column) -> Column:
    return F.nullif(s, F.lit("")).try_cast("int")


def _date(y: Column, m: Column, d: Column) -> Column:
    """A date, null if there is none such."""
    return F.try_to_timestamp(F.format_string("%04d-%02d-%02d", y, m, d), F.lit("yyyy-MM-dd")).cast("date")


def _group(s: Column, pattern: str, k: int) -> Column:
    return F.regexp_extract(s, pattern, k)


def _midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def _parsed(local: Column, offset: Column, date_only: Column) -> Column:
    return F.when(local.isNotNull(), F.struct(local.alias("local"), offset.cast("int").alias("offset_s"), date_only.alias("date_only")))


def _lenient(x: str | None, day: str) -> datetime.datetime | None:
    from dateutil import parser

    try:
        return None if not x else parser.parse(x, dayfirst=True, fuzzy=True, default=datetime.datetime.fromisoformat(day)).replace(tzinfo=None)
    except (ValueError, OverflowError):
        return None


@F.pandas_udf(T.TimestampNTZType())
def _fuzzy(s: pd.Series, as_of: pd.Series) -> pd.Series:
    return pd.Series([_lenient(x, d) for x, d in zip(s, as_of)], dtype="datetime64[ns]")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _fuzzy_all(s: pd.Series, as_of: pd.Series) -> pd.Series:
    read = lambda x, d: (v := _lenient(x, d)) and v.isoformat(timespec="seconds")
    return pd.Series([None if xs is None else [read(x, d) for x in xs] for xs, d in zip(s, as_of)], dtype=object)


def parse_dt(value: Column, as_of: str, fuzzy: bool = False) -> Column:
    """Parse a listing's time: date-only ISO, ISO with or without offset, German numeric or month-name dates with an
    optional time, and, if ``fuzzy``, whatever a lenient parser makes of the rest. Missing years are those of as_of.
    A numeric German date that does not exist gives null and is not read any other way but the fuzzy one."""
    s = F.regexp_replace(value, r"(?U)^\s+|\s+$", "")
    iso_day = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(s, F.lit("yyyy-MM-dd")).cast("date"))
    g = lambda k: _group(s, ISO, k)
    iso_date = F.try_to_timestamp(g(1), F.lit("yyyy-MM-dd")).cast("date")
    clock_ok = (_int(g(2)) <= 23) & (_int(g(3)) <= 59) & (F.coalesce(_int(g(4)), F.lit(0)) <= 59)
    seconds = _int(g(2)) * 3600 + _int(g(3)) * 60 + F.coalesce(_int(g(4)), F.lit(0))
    iso_local = F.when(clock_ok, _midnight(iso_date) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")))
    zone = g(6)
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(zone, r"\D", "")
    offset = F.when(zone == "Z", 0).when(zone != "", sign * (F.substring(digits, 1, 2).try_cast("int") * 3600 + F.coalesce(_int(F.substring(digits, 3, 2)), F.lit(0)) * 60))
    n = lambda k: _group(s, NUMERIC, k)
    year = _int(n(3))
    numeric = _date(F.when(year < 100, year + 2000).otherwise(year), _int(n(2)), _int(n(1)))
    m = lambda k: _group(s, NAMED, k)
    months = F.create_map(*(F.lit(x) for kv in MONTHS.items() for x in kv))
    named = _date(F.coalesce(_int(m(3)), F.year(F.lit(as_of).cast("date"))), F.try_element_at(months, F.lower(m(2))), _int(m(1)))
    german = F.when(s.rlike(NUMERIC), numeric).when(s.rlike(NAMED), named)
    t = lambda k: _int(_group(s, TIME, k))
    hour, minute = F.coalesce(t(1), t(3), t(5)), F.coalesce(t(2), t(4), F.lit(0))
    has_time = F.coalesce((hour <= 23) & (minute <= 59), F.lit(False))
    clock = F.when(has_time, hour * 3600 + minute * 60).otherwise(0)
    german_local = _midnight(german) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), clock.cast("decimal(18,6)"))
    no, none = F.lit(False), F.lit(None)
    out = F.coalesce(_parsed(_midnight(iso_day), none, F.lit(True)), F.when(s.rlike(ISO), _parsed(iso_local, offset, no)), _parsed(german_local, none, ~has_time))
    if fuzzy:
        rest = F.when(out.isNull() & (s != ""), s)
        out = F.coalesce(out, _parsed(_fuzzy(rest, F.lit(as_of)), none, no))
    return out


def read_leniently(values: Column, as_of: str) -> Column:
    """An array of times, those that only the lenient step reads replaced by their ISO form: Python cannot run inside
    a lambda, so arrays go through it whole, and only where something is left to read."""
    trimmed = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    rest = F.transform(values, lambda x: F.when(parse_dt(x, as_of).isNull() & (trimmed(x) != ""), trimmed(x)))
    read = _fuzzy_all(F.when(F.exists(rest, lambda x: x.isNotNull()), rest), F.lit(as_of))
    return F.when(read.isNull(), values).otherwise(F.zip_with(values, read, lambda x, y: F.coalesce(y, x)))


def instant(parsed: Column, zone: str) -> Column:
    """The moment of a parsed time as a timestamp."""
    utc = F.when(parsed["offset_s"].isNotNull(), parsed["local"] - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), parsed["offset_s"].cast("decimal(18,6)")))
    return F.coalesce(utc.cast("timestamp"), F.to_utc_timestamp(parsed["local"].cast("timestamp"), zone))


def utc_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def nightlife_date(local: Column) -> Column:
    """The evening a start belongs to: the local wall clock less six hours."""
    return F.to_date(local - F.expr("INTERVAL 6 HOURS"))


def _gap(a: Column, b: Column, zone: str) -> Column:
    """Seconds from a to b: by the wall clock if both stand in the city's zone, else by the moments."""
    wall = F.unix_micros(b["local"].cast("timestamp")) - F.unix_micros(a["local"].cast("timestamp"))
    real = F.unix_micros(instant(b, zone)) - F.unix_micros(instant(a, zone))
    return F.when(a["offset_s"].isNull() & b["offset_s"].isNull(), wall).otherwise(real) / 1_000_000


def local_text(parsed: Column, zone: str) -> Column:
    """Local ISO text with the offset."""
    moment = instant(parsed, zone)
    by_zone = (F.unix_seconds(F.from_utc_timestamp(moment, zone)) - F.unix_seconds(moment)).cast("int")
    offset = F.coalesce(parsed["offset_s"], by_zone)
    text = F.format_string("%s%02d:%02d", F.when(offset < 0, "-").otherwise("+"), F.floor(F.abs(offset) / 3600), F.floor(F.abs(offset) / 60) % 60)
    return F.concat(F.date_format(parsed["local"], "yyyy-MM-dd'T'HH:mm:ss"), text)


def make_occurrence(start: Column, end: Column, doors: Column, zone: str, as_of: str, status: Column | None = None, fuzzy: bool = False) -> Column:
    """struct(starts_at_utc, ends_at_utc, starts_at_local, doors_at_local, nightlife_date, time_unknown, status,
    is_range, range_start, range_end); null without a readable start.

    An end before the start by less than a day moves to the next day, any other such end is dropped. More than a day
    makes a range, which has no doors. An end is never invented."""
    a, e, d = (parse_dt(x, as_of, fuzzy) for x in (start, end, doors))

    def build(v: Column) -> Column:
        s, x, door = v["s"], v["e"], v["d"]
        gap = _gap(s, x, zone)
        moved = F.struct((x["local"] + F.expr("INTERVAL 1 DAY")).alias("local"), x["offset_s"].alias("offset_s"), x["date_only"].alias("date_only"))
        stop = F.when(x.isNull(), None).when(gap >= 0, x).when(gap > -86400, moved)
        return F.transform(F.array(F.struct(s.alias("s"), stop.alias("e"), door.alias("d"))), finish)[0]

    def finish(v: Column) -> Column:
        s, x, door = v["s"], v["e"], v["d"]
        is_range = F.coalesce(_gap(s, x, zone) > 86400, F.lit(False))
        return F.struct(
            utc_text(instant(s, zone)).alias("starts_at_utc"),
            F.when(x.isNotNull(), utc_text(instant(x, zone))).alias("ends_at_utc"),
            local_text(s, zone).alias("starts_at_local"),
            F.when(~is_range & door.isNotNull(), local_text(door, zone)).alias("doors_at_local"),
            nightlife_date(s["local"]).alias("nightlife_date"),
            s["date_only"].alias("time_unknown"),
            (status if status is not None else F.lit("scheduled")).alias("status"),
            is_range.alias("is_range"),
            F.when(is_range, F.to_date(s["local"])).alias("range_start"),
            F.when(is_range, F.to_date(x["local"])).alias("range_end"),
        )

    return F.when(a.isNotNull(), F.transform(F.array(F.struct(a.alias("s"), e.alias("e"), d.alias("d"))), build)[0])
