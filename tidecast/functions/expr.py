"""Column-expression helpers shared by all operators (JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(num, den)


def warm(count: Column, n: int, value: Column) -> Column:
    """NULL until ``count`` (rows seen in the frame) reaches ``n``."""
    return F.when(count >= F.lit(n), value)


def rnd(c: Column | str, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits)


def md5_uniform(*parts: Column) -> Column:
    """Deterministic uniform draw in [0, 1) from md5 of the parts.

    The first 13 hex digits (52 bits) of md5('p1|p2|...') divided by 16**13.
    The same digits are reproducible in SQL engines, which keeps random
    operators checkable.
    """
    key = F.concat_ws("|", *[p.cast("string") for p in parts])
    digits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double")
    return digits / F.lit(float(16 ** 13))


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_micros(ts: Column) -> Column:
    """Microseconds of a TIMESTAMP_NTZ wall-clock value since 1970-01-01 00:00,
    independent of the session time zone (no TIMESTAMP cast)."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts)


def ntz_from_micros(us: Column) -> Column:
    """Inverse of ``ntz_micros``: a TIMESTAMP_NTZ, zone-free."""
    return F.timestamp_add("MICROSECOND", us, _epoch_ntz())
