"""Column helpers shared by the operators. All times are UTC instants; all arithmetic on them is in whole microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """The value as a double, NaN as NULL: a NaN compares above every number in Spark and poisons averages."""
    c = col(c).cast("double")
    return F.when(~F.isnan(c), c)


def micros(c: Column | str) -> Column:
    return F.unix_micros(col(c).cast("timestamp"))


def int_floor_div(a: Column, n: int) -> Column:
    """Floor division of whole numbers, also beyond 2**53: Spark's ``div`` truncates towards zero and ``/`` passes through a double."""
    x = a - F.pmod(a, F.lit(n).cast("long"))
    return F.call_function("div", x, F.lit(n).cast("long"))


def lead_day(lead_hours: Column | str) -> Column:
    """Day of the lead: hours 1..24 are day 1. Floored, so hour 0 and below give 0 and below."""
    return F.floor((col(lead_hours) + 23) / 24).cast("smallint")


def half_even_hour(c: Column | str) -> Column:
    """The nearest full hour; an exact half goes to the even hour."""
    t = micros(c)
    low = t - F.pmod(t, F.lit(HOUR_US))
    rest = t - low
    up = (rest > HOUR_US // 2) | ((rest == HOUR_US // 2) & (F.pmod(int_floor_div(low, HOUR_US), F.lit(2)) == 1))
    return F.timestamp_micros(F.when(up, low + HOUR_US).otherwise(low))


def iso_text(c: Column | str) -> Column:
    """ISO text of an instant with ``+00:00``, and a fraction only where there is one."""
    t = col(c).cast("timestamp")
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    part = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.when(F.pmod(micros(t), F.lit(1_000_000)) == 0, whole).otherwise(part)


def event_key(*parts: Column | str) -> Column:
    """SHA-256 over the parts joined by ``|``. NULL counts as empty text, so positions never shift."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]), 256)


def hex_id(c: Column | str) -> Column:
    """The 64 hexadecimal digits of an identifier however written (case, blanks, separators, a leading 0x)."""
    c = col(c)
    bare = F.regexp_replace(F.lower(c), "[^0-9a-f]", "")
    return F.when(F.length(c) == 64, F.lower(c)).when(F.length(bare) >= 64, F.right(bare, F.lit(64))).otherwise(F.lower(F.trim(c)))


def key128(*cols: Column | str) -> list[Column]:
    """Two independent 64-bit hashes of a composite key; NULL is a value of its own in each position."""
    parts: list[Column] = []
    for c in cols:
        parts += [F.isnull(col(c)), col(c)]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(0x5EED), *reversed(parts))]
