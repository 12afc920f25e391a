"""Scalar expressions: local time, money, text, hashes, deterministic ids.

Instants are ``timestamp`` columns in a session pinned to UTC; a local civil
time is a ``timestamp_ntz``.
"""

from __future__ import annotations

import unicodedata
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(9,4)"

def _accent_table() -> tuple[str, str]:
    """Lower-case Latin letters that decompose to one base letter plus marks."""
    folded = {}
    for point in [*range(0xE0, 0x250), *range(0x1E00, 0x1F00)]:
        base, *marks = unicodedata.normalize("NFD", chr(point))
        if marks and base.isascii() and base.islower() and all(map(unicodedata.combining, marks)):
            folded[chr(point)] = base
    return "".join(folded), "".join(folded.values())


ACCENTED, BASE = _accent_table()


def local_datetime(ts: Column, zone: Column | str) -> Column:
    """Instant to civil time in ``zone`` (a zone name or a column of them)."""
    return F.from_utc_timestamp(ts, zone).cast("timestamp_ntz")


def local_date(ts: Column, zone: Column | str) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def local_day_bounds(day: Column, zone: Column | str) -> tuple[Column, Column]:
    """The instants [start, end) of one local day; a range filter on the raw
    instant that a Parquet scan can use."""
    midnight = day.cast("timestamp")
    return (
        F.to_utc_timestamp(midnight, zone),
        F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), zone),
    )


def period_start(day: Column, cadence: str) -> Column:
    """Start of the day, Monday week or month that holds ``day``."""
    units = {"daily": None, "weekly": "week", "monthly": "month"}
    unit = units[cadence]
    return day if unit is None else F.trunc(day, unit)


def add_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_interval(mins=minutes.cast("int"))


def sha256_hex(value: Column) -> Column:
    return F.sha2(value.cast("string"), 256)


def sha1_upper(value: Column) -> Column:
    return F.upper(F.sha1(value.cast("string")))


def matches(value: Column, pattern: Column | str) -> Column:
    """Whether ``pattern`` occurs in ``value``; the pattern may be a column."""
    return F.regexp_like(value, F.lit(pattern) if isinstance(pattern, str) else pattern)


def normalise_text(value: Column) -> Column:
    """Lower case, accents folded, dots and commas dropped, spaces collapsed, trimmed."""
    folded = F.translate(F.lower(value), ACCENTED, BASE)
    bare = F.regexp_replace(folded, r"[.,]|\p{M}", "")
    spaced = F.regexp_replace(bare, r"\s+", " ")
    return F.trim(spaced)


def money(value: Column) -> Column:
    """Two decimals, half away from zero."""
    return F.round(value, 2).cast(MONEY)


def cents(value: Column) -> Column:
    """Whole minor units to a money amount, exact."""
    return (value.cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def age_years(born: Column, at: Column) -> Column:
    return F.floor(F.datediff(at, born) / F.lit(365.2425)).cast("int")


def least_present(*values: Column) -> Column:
    """Smallest of the values that are not NULL."""
    return F.least(*values)


def render_event_name(template: Column, home: Column, away: Column) -> Column:
    return F.replace(F.replace(template, F.lit("{home}"), home), F.lit("{away}"), away)


def totals_json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def text_join(sep: str, *parts: Column) -> Column:
    return F.concat_ws(sep, *[p.cast("string") for p in parts])


def uuid5(namespace: str, key: Column) -> Column:
    """Name-based UUID (version 5) of ``key`` under a namespace UUID."""
    raw = F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(key, "UTF-8"))
    digest = F.sha1(raw)
    variant = F.element_at(
        F.array(*[F.lit(c) for c in "89ab"]),
        F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1,
    )
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def crc_id(key: Column, modulus: int | None = None) -> Column:
    value = F.crc32(F.encode(key, "UTF-8"))
    return value if modulus is None else value % modulus


# Lexical formats of regulator documents. Every one takes a column and gives text.
CODECS = {
    "text": lambda c: c.cast("string"),
    "datetime": lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    "offset": lambda c: F.concat(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.date_format(c, "SSSSSS") == "000000", "").otherwise(F.date_format(c, ".SSSSSS")),
        F.lit("+00:00")),
    "date": lambda c: F.date_format(c, "yyyy-MM-dd"),
    "date-compact": lambda c: F.date_format(c, "yyyyMMdd"),
    "money": lambda c: c.cast("decimal(38,2)").cast("string"),
    "money4": lambda c: c.cast("decimal(38,4)").cast("string"),
    "flag-positive": lambda c: F.when(c > 0, "1").otherwise("0"),
    "digits14": lambda c: F.date_format(c, "yyyyMMddHHmmss"),
    "digits14tz": lambda c: F.concat(F.date_format(c, "yyyyMMddHHmmss"), F.lit("+0000")),
    "digits8": lambda c: F.date_format(c, "yyyyMMdd"),
    "digits6": lambda c: F.date_format(c, "yyyyMM"),
    "digits12-yy": lambda c: F.date_format(c, "yyMMddHHmmss"),
    "digits14-fftz": lambda c: F.concat(
        F.date_format(c, "yyyyMMddHHmmss"), F.lit(".00 +00:00")),
    "sha1-upper": sha1_upper,
    "fr-canonique": lambda c: F.regexp_replace(F.upper(c), "[^0-9A-Z' -]", ""),
}
