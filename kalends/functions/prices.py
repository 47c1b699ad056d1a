"""Prices from German listing texts as one expression. The text is always kept; the currency is always EUR."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of the cascade.
NUMBER = r"(\d{1,4}(?:[.,]\d{1,2})?)"
FREE = r"(?iu)eintritt\s*frei|freier\s*eintritt|kostenlos|kostenfrei|\bgratis\b|free\s+(?:entry|admission)"
DONATION = r"(?iu)spendenbasis|auf\s+spende|spendenempfehlung|\bspende\b|pay\s+what\s+you\s+(?:want|can)|donation"
PRESALE_DOOR = rf"(?ius)vvk\.?:?\s*{NUMBER}\s*€?.{{0,16}}?\bak\.?:?\s*{NUMBER}"
FROM = rf"(?iu)\bab\s*{NUMBER}\s*(?:€|euro)"
RANGE = rf"(?iu){NUMBER}\s*(?:€\s*)?[–\-—/]\s*{NUMBER}\s*€"
REDUCED = rf"(?iu)erm(?:äßigt|aessigt|\.)\s*:?\s*{NUMBER}"
SINGLE = rf"(?iu){NUMBER}\s*(?:€|euro)|€\s*{NUMBER}"
SOLD_OUT = r"(?iu)ausverkauft|sold\s*out"

PRICE = "struct<min:double,max:double,presale:double,door:double,reduced:double,currency:string,is_free:boolean,type:string,text:string,sold_out:boolean>"


def number(s: Column) -> Column:
    return F.nullif(F.replace(s, F.lit(","), F.lit(".")), F.lit("")).try_cast("double")


def parse_price(text: Column, structured: Column | None = None, free_hint: Column | None = None) -> Column:
    """The first rule that fits: free hint; structured value (0 is free); no text; presale and door; without a digit
    free, donation or unknown; donation without an amount; from; range; single amount, with a reduced one; free."""
    structured = F.lit(None).cast("double") if structured is None else structured
    free_hint = F.lit(None).cast("boolean") if free_hint is None else free_hint
    s = F.trim(F.replace(text, F.lit("\u00a0"), F.lit(" ")))
    none = F.lit(None).cast("double")

    def price(kind: str, low: Column = none, high: Column = none, presale: Column = none, door: Column = none, reduced: Column = none, free: Column | bool = False) -> Column:
        sold = F.coalesce(s.rlike(SOLD_OUT), F.lit(False))
        free = F.lit(free) if isinstance(free, bool) else free
        return F.struct(
            low.alias("min"), high.alias("max"), presale.alias("presale"), door.alias("door"), reduced.alias("reduced"), F.lit("EUR").alias("currency"), free.alias("is_free"),
            F.lit(kind).alias("type"), text.alias("text"), sold.alias("sold_out"),
        )

    g = lambda p, k: number(F.regexp_extract(s, p, k))
    zero, reduced = F.lit(0.0), g(REDUCED, 1)
    value = F.coalesce(g(SINGLE, 1), g(SINGLE, 2))
    hinted = F.struct(zero.alias("min"), zero.alias("max"), none.alias("presale"), none.alias("door"), none.alias("reduced"), F.lit("EUR").alias("currency"), F.lit(True).alias("is_free"), F.lit("free").alias("type"), text.alias("text"), F.lit(False).alias("sold_out"))
    given = F.struct(structured.alias("min"), structured.alias("max"), none.alias("presale"), none.alias("door"), none.alias("reduced"), F.lit("EUR").alias("currency"), F.lit(False).alias("is_free"), F.lit("fixed").alias("type"), text.alias("text"), F.lit(False).alias("sold_out"))
    low, high = F.least(g(RANGE, 1), g(RANGE, 2)), F.greatest(g(RANGE, 1), g(RANGE, 2))
    single = F.when(value == 0, price("free", value, value, reduced=F.when(reduced != value, reduced), free=True)).otherwise(price("fixed", value, value, reduced=F.when(reduced != value, reduced)))
    free = price("free", zero, zero, free=True)
    out = (
        F.when(F.coalesce(free_hint, F.lit(False)), hinted)
        .when(structured == 0, hinted)
        .when(structured.isNotNull(), given)
        .when(F.coalesce(text, F.lit("")) == "", price("unknown"))
        .when(s.rlike(PRESALE_DOOR), price("range", g(PRESALE_DOOR, 1), g(PRESALE_DOOR, 2), g(PRESALE_DOOR, 1), g(PRESALE_DOOR, 2), reduced))
        .when(~s.rlike(r"(?U)\d") & s.rlike(FREE), free)
        .when(~s.rlike(r"(?U)\d") & s.rlike(DONATION), price("donation", zero))
        .when(~s.rlike(r"(?U)\d"), price("unknown"))
        .when(s.rlike(DONATION) & ~s.rlike(SINGLE), price("donation", zero))
        .when(s.rlike(FROM), price("from", g(FROM, 1), reduced=reduced))
        .when(s.rlike(RANGE), price("range", low, high, reduced=reduced))
        .when(s.rlike(SINGLE), single)
        .when(s.rlike(FREE), free)
        .otherwise(price("unknown"))
    )
    return out.cast(PRICE)
