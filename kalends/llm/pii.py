"""Format-preserving pseudonyms for personal data.

A match is validated (Luhn, mod 97, octets, calendar, number plan), turned into a point of Z_a x Z_b for its format,
permuted by a keyed Feistel network, and written back in the same format with its check digits set anew. The network
alternates x += F(y) mod a and y += F(x) mod b, which permutes Z_a x Z_b for any a and b, so no value leaves its format
and equal values get equal pseudonyms in every document. Everything is SQL expressions on the matches of a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free

ROUNDS = 8

#: A match starts where a run of its letters starts, and labels are as many as a name can have: so a text of any length
#: is read once, and no pattern recurses deeply.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,63}"
SECRET = r"\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[0-9A-Za-z]{36}\b|\bsk-[0-9A-Za-z]{20,}\b|(?i:\b(?:password|passwd|secret|api_?key|token)\s?[=:]\s?)[^\s,;\"']{4,}"
IBAN = r"\b[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?\b"
CARD = r"(?<![0-9.+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9]|[.-][0-9])"
PHONE = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,5}(?:[ .-]?[0-9]{2,5}){1,4}(?![0-9])|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9.-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9]|-[0-9])"
SSN = r"(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9]|[./-][0-9])"
#: In this order; the first that fits at a place wins.
KINDS = {"email": EMAIL, "secret": SECRET, "iban": IBAN, "date": DATE, "ssn": SSN, "ip": IPV4, "phone": PHONE, "card": CARD}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: Rows without any of these need no search.
HINT = r"@|[0-9][^A-Za-z]{0,3}[0-9][^A-Za-z]{0,3}[0-9]|AKIA|gh[pousr]_|sk-|(?i:password|passwd|secret|key|token)"
#: 1,461 days of four years, fifty times, from here: a leap year every fourth, 2000 included.
EPOCH = "1900-03-01"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hash(key: str, *parts: Column) -> Column:
    """A keyed 60-bit number."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *parts), 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, x: Column, y: Column, a: Column, b: Column) -> Column:
    """Permute (x, y) of Z_a x Z_b; struct(x, y)."""

    def step(acc: Column, k: Column) -> Column:
        even = k % 2 == 0
        return F.struct(
            F.when(even, F.pmod(acc["x"] + F.pmod(_hash(key, F.lit(kind), k, a, b, acc["y"]), a), a)).otherwise(acc["x"]).alias("x"),
            F.when(even, acc["y"]).otherwise(F.pmod(acc["y"] + F.pmod(_hash(key, F.lit(kind), k, a, b, acc["x"]), b), b)).alias("y"),
        )

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(n: Column) -> Column:
    """10**n as a whole number, n from 0 to 18."""
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n.cast("int"))).cast("long")


def digits_permuted(key: str, kind: str, digits: Column) -> Column:
    """Permute a string of 1 to 36 digits among those of its length."""
    n = F.char_length(digits)
    half = (F.floor(n / 2)).cast("int")
    x, y = F.coalesce(F.try_to_number(F.nullif(F.substring(digits, F.lit(1), half), F.lit("")), F.lit("9" * 18)), F.lit(0)).cast("long"), F.substring(digits, half + 1, n).cast("long")
    out = feistel(key, kind, x, y, _power(half), _power(n - half))
    return let(out, lambda o: F.concat(F.when(half > 0, F.lpad(o["x"].cast("string"), half, F.lit("0"))).otherwise(""), F.lpad(o["y"].cast("string"), n - half, F.lit("0"))))


def refill(form: Column, digits: Column) -> Column:
    """Write ``digits`` into the places of the digits of ``form``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(acc["out"], F.when(is_digit, F.substring(digits, acc["k"], F.lit(1))).otherwise(c)).alias("out"), (acc["k"] + F.when(is_digit, 1).otherwise(0)).alias("k"))

    return F.aggregate(F.split(form, ""), start, step, lambda acc: acc["out"])


def _only_digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn_digit(payload: Column) -> Column:
    """The check digit that makes payload || digit pass Luhn."""
    n = F.char_length(payload)
    each = F.transform(F.split(payload, ""), lambda c, i: let(c.cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return ((10 - F.aggregate(each, F.lit(0), lambda acc, v: acc + v) % 10) % 10).cast("string")


def luhn(digits: Column) -> Column:
    n = F.char_length(digits)
    return luhn_digit(F.substring(digits, F.lit(1), n - 1)) == F.substring(digits, n, F.lit(1))


def mod97(text: Column) -> Column:
    """ISO 7064 remainder of letters and digits."""
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda acc, c: let(value(c), lambda v: (F.when(v > 9, acc * 100 + v).otherwise(acc * 10 + v) % 97).cast("int")))


def _email(key: str, m: Column) -> Column:
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    fill = F.lower(F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 15), 16, 36))
    return F.concat(F.lit("u"), F.lpad(fill, F.greatest(F.char_length(local) - 1, F.lit(9)), F.lit("0")), F.lit("@"), domain)


def _secret(key: str, m: Column) -> Column:
    """Keeps the prefix and the length; letters and digits come from a keyed hash."""
    head = F.regexp_extract(m, r"(?i)^(AKIA|gh[pousr]_|sk-|(?:password|passwd|secret|api_?key|token)\s?[=:]\s?)", 1)
    fill = F.sha2(F.concat_ws("|", F.lit(key), F.lit("secret"), m), 512)
    fill = F.when(head == "AKIA", F.upper(F.translate(fill, "0189", "GHJK"))).otherwise(fill)
    n = F.char_length(m) - F.char_length(head)
    return F.concat(head, F.substring(F.repeat(fill, F.ceil(n / 128).cast("int")), F.lit(1), n))


def _iban(key: str, m: Column) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.char_length(plain))
    valid = mod97(F.concat(account, country, F.substring(plain, 3, 2))) == 1
    fresh = refill(account, digits_permuted(key, "iban", _only_digits(account)))
    check = let(fresh, lambda x: F.concat(F.lpad((98 - mod97(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0"), x))
    both = F.concat(country, check)
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    spaced = let(both, lambda p: F.aggregate(F.split(m, ""), start, lambda acc, c: F.struct(F.concat(acc["out"], F.when(c == " ", c).otherwise(F.substring(p, acc["k"], F.lit(1)))).alias("out"), (acc["k"] + F.when(c == " ", 0).otherwise(1)).alias("k")), lambda acc: acc["out"]))
    return F.when(valid, spaced)


def _card(key: str, m: Column) -> Column:
    digits = _only_digits(m)
    n = F.char_length(digits)
    payload = F.concat(F.substring(digits, 1, 1), digits_permuted(key, "card", F.substring(digits, F.lit(2), n - 2)))
    return F.when(luhn(digits), let(payload, lambda p: refill(m, F.concat(p, luhn_digit(p)))))


def _phone(key: str, m: Column) -> Column:
    """Keeps the country code (+1, or what stands before the first separator) and the first national digit."""
    digits = _only_digits(m)
    code = F.when(m.startswith("+1"), 1).when(m.startswith("+"), F.char_length(F.regexp_extract(m, r"^\+([0-9]{1,3})", 1))).otherwise(0)
    keep = code + 1
    n = F.char_length(digits)
    return F.when((n >= 7) & (n <= 15), refill(m, F.concat(F.substring(digits, F.lit(1), keep), digits_permuted(key, "phone", F.substring(digits, keep + 1, n)))))


def _ssn(key: str, m: Column) -> Column:
    area, group, serial = (F.substring(m, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    x = area - 1 - F.when(area > 666, 1).otherwise(0)
    out = feistel(key, "ssn", x, (group - 1) * 9999 + serial - 1, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"))
    write = let(out, lambda o: F.format_string("%03d-%02d-%04d", o["x"] + 1 + F.when(o["x"] >= 665, 1).otherwise(0), F.expr("1L") + F.floor(o["y"] / 9999), o["y"] % 9999 + 1))
    return F.when(valid, write)


def _ip(key: str, m: Column) -> Column:
    part = lambda k: F.get(F.split(m, r"\."), F.lit(k)).cast("long")
    valid = (part(0) >= 1) & (part(0) <= 223) & (part(1) <= 255) & (part(2) <= 255) & (part(3) <= 255)
    out = feistel(key, "ip", (part(0) - 1) * 256 + part(1), part(2) * 256 + part(3), F.lit(223 * 256).cast("long"), F.lit(65536).cast("long"))
    write = let(out, lambda o: F.format_string("%d.%d.%d.%d", F.floor(o["x"] / 256) + 1, o["x"] % 256, F.floor(o["y"] / 256), o["y"] % 256))
    return F.when(valid, write)


def _date(key: str, m: Column) -> Column:
    """ISO, day.month.year and month/day/year (day/month/year where the first number cannot be a month)."""
    ddmm = m.contains("/") & (F.substring(m, 1, 2).cast("int") > 12)
    form = F.when(m.contains("-"), "yyyy-MM-dd").when(m.contains("."), "dd.MM.yyyy").when(ddmm, "dd/MM/yyyy").otherwise("MM/dd/yyyy")
    day = F.try_to_timestamp(m, form).cast("date")
    n = F.datediff(day, F.lit(EPOCH).cast("date")).cast("long")
    out = feistel(key, "date", n % 1461, F.floor(n / 1461), F.lit(1461).cast("long"), F.lit(50).cast("long"))
    fresh = let(out, lambda o: F.date_add(F.lit(EPOCH).cast("date"), (o["y"] * 1461 + o["x"]).cast("int")))
    write = let(
        fresh,
        lambda d: F.when(m.contains("-"), F.date_format(d, "yyyy-MM-dd"))
        .when(m.contains("."), F.date_format(d, "dd.MM.yyyy"))
        .when(ddmm, F.date_format(d, "dd/MM/yyyy"))
        .otherwise(F.date_format(d, "MM/dd/yyyy")),
    )
    return F.when((n >= 0) & (n < 73050), write)


_MAKE = {"email": _email, "secret": _secret, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "phone": _phone, "card": _card}


def _kind(m: Column) -> Column:
    out = None
    for name, pattern in KINDS.items():
        # The match is whole, so a kind fits if it fits all of it; look-arounds see only its ends.
        test = m.rlike(f"^(?:{pattern})$")
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def pseudonymize(docs: DataFrame, key: str, prefix: str = "_") -> DataFrame:
    """``docs`` (text and any others) with the personal data in text replaced, and ``_pii`` added:
    array<struct<kind, found, pseudonym>> in text order, for audit. ``key`` is the secret that all pseudonyms hang on.

    E-mail addresses and secrets get keyed names of the same form; card numbers, IBANs, phone numbers, social security
    numbers, IPv4 addresses and dates get Feistel pseudonyms of their format. The domain of an address and the letters
    of an IBAN stay; IPv6 addresses are not looked for. What fails validation is left as it is.

    A null text stays null with an empty array, an empty one empty; rows are treated one by one, so nulls elsewhere and
    repeated rows need no rule, and an empty table gives no rows. All other columns stay, whatever their names, but for
    one of the name ``_pii`` (under ``prefix``), which is replaced.
    """
    out = f"{prefix}pii"
    docs = docs.drop(out)
    hit, places, judged_, gaps = free(docs, "hit", "places", "judged", "gaps")
    base = docs.withColumn(hit, F.coalesce(F.col("text").rlike(HINT), F.lit(False)))
    found = F.when(F.col(hit), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    base = base.withColumn(places, found)

    def judged(m: Column) -> Column:
        def made(k: Column) -> Column:
            out = None
            for name, make in _MAKE.items():
                out = F.when(k == name, make(key, m)) if out is None else out.when(k == name, make(key, m))
            return out

        return let(_kind(m), lambda k: F.struct(k.alias("kind"), m.alias("found"), made(k).alias("pseudonym")))

    some = F.size(places) > 0
    base = base.withColumn(judged_, F.transform(places, judged)).withColumn(gaps, F.when(some, F.split("text", PATTERN)))
    pieces = F.transform(judged_, lambda x, i: F.concat(F.coalesce(x["pseudonym"], x["found"]), F.get(F.col(gaps), i + 1)))
    text = F.when(some, F.concat(F.get(gaps, F.lit(0)), F.array_join(pieces, ""))).otherwise(F.col("text"))
    return base.select(*(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns), F.filter(judged_, lambda x: x["pseudonym"].isNotNull()).alias(out))
