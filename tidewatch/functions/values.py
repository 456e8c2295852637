"""Numbers, times and nulls as feeds write them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once: the optimizer can't copy it to each mention."""
    return F.transform(F.array(value), body)[0]


def trimmed(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def present(text: Column) -> Column:
    """An empty string counts as absent."""
    return F.nullif(text, F.lit(""))


def number(text: Column) -> Column:
    """A finite decimal number, else null (also for blanks)."""
    t = trimmed(text)
    n = F.when(t.rlike(_NUMBER), t.try_cast("double"))
    return F.when(F.abs(n) < F.lit(float("inf")), n)


def count(text: Column) -> Column:
    """A number of things, 0 if absent."""
    return F.coalesce(number(text), F.lit(0.0)).cast("bigint")


def day_iso(digits: Column) -> Column:
    """YYYYMMDD to midnight UTC in ISO form, null for any other shape."""
    return F.when(digits.rlike(r"^\d{8}$"), F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3T00:00:00Z"))


def moment_iso(digits: Column) -> Column:
    """YYYYMMDDHHMMSS to ISO form, null for any other shape."""
    return F.when(digits.rlike(r"^\d{14}$"), F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3T$4:$5:$6Z"))


def seen_iso(text: Column) -> Column:
    """YYYYMMDDTHHMMSSZ to ISO form, null for any other shape."""
    return F.when(text.rlike(r"^\d{8}T\d{6}Z$"), F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})Z$", "$1-$2-$3T$4:$5:$6Z"))


def moment(iso: Column) -> Column:
    """ISO text to a timestamp, null if it names no moment."""
    return F.try_to_timestamp(iso)


def hours_between(a: Column, b: Column) -> Column:
    """Hours from ``a`` to ``b``; the two may be timestamps of either kind."""
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / F.lit(3.6e9)


def interval_start(ts: Column, minutes: int = 15) -> Column:
    """Start of the interval that holds ``ts``, as 14 digits."""
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return F.date_format(F.timestamp_seconds(seconds - seconds % (minutes * 60)), "yyyyMMddHHmmss")


def interval_moment(digits: Column) -> Column:
    return F.to_timestamp(digits, "yyyyMMddHHmmss")


def is_ingest_tick(ts: Column) -> Column:
    """True in the first five minutes of each quarter of an hour."""
    return F.minute(ts) % 15 < 5


def clamped_days(text: Column) -> Column:
    """Days asked for: 7 if absent, zero or no number, then within 1 and 30."""
    n = number(text)
    return F.least(F.lit(30.0), F.greatest(F.lit(1.0), F.coalesce(F.when(n != 0, n), F.lit(7.0))))


def units(text: Column) -> Column:
    """UTF-16 code units: characters beyond the first plane count as two, as in the published hashes."""
    # Splitting on nothing leaves the characters; an empty text leaves one empty string.
    codes = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ""), lambda c: F.ascii(c).cast("bigint")), lambda c: c > 0)
    high = lambda c: F.shiftright(c - 0x10000, 10) + 0xD800
    low = lambda c: (c - 0x10000).bitwiseAND(F.lit(0x3FF).cast("bigint")) + 0xDC00
    return F.flatten(F.transform(codes, lambda c: F.when(c >= 0x10000, F.array(high(c), low(c))).otherwise(F.array(c))))


def fnv32(text: Column) -> Column:
    """32-bit FNV-1a over the UTF-16 units of ``text``, as a number."""
    return F.aggregate(units(text), F.lit(2166136261).cast("bigint"), lambda h, c: (h.bitwiseXOR(c) * F.lit(16777619).cast("bigint")).bitwiseAND(F.lit(4294967295)))


def hex_digits(n: Column, width: int | None = None) -> Column:
    """Small hexadecimal digits, padded to ``width`` where one is given."""
    out = F.lower(F.hex(n))
    return out if width is None else F.lpad(out, width, "0")


def etag(body: Column) -> Column:
    return F.concat(F.lit('"'), hex_digits(fnv32(body)), F.lit('"'))


def percent_change(latest: Column, previous: Column) -> Column:
    return F.when(previous != 0, (latest - previous) / previous * 100)
