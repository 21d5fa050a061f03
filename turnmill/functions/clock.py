"""Message clocks that count from 2001-01-01 UTC in an unknown unit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_2001 = 978307200.0
_UNITS = {"s": 1e0, "ms": 1e3, "us": 1e6, "ns": 1e9}


def to_unix(raw: Column, unit: str | None = None) -> Column:
    """Unix seconds as DOUBLE; null or blank gives 0.0.

    Without ``unit`` it is guessed from the magnitude (strictly above 1e14,
    1e11, 1e9), which takes present-day milliseconds for microseconds; pass
    ``unit`` (s, ms, us, ns) where it is known.
    """
    v = raw.cast("double")
    if unit is not None:
        return F.when(v.isNull(), F.lit(0.0)).otherwise(v / F.lit(_UNITS[unit]) + F.lit(EPOCH_2001))
    m = F.abs(v)
    scaled = F.when(m > 1e14, v / F.lit(1e9)).when(m > 1e11, v / F.lit(1e6)).when(m > 1e9, v / F.lit(1e3)).otherwise(v)
    return F.when(v.isNull(), F.lit(0.0)).otherwise(scaled + F.lit(EPOCH_2001))


def to_nanos(raw: Column) -> Column:
    """Nanoseconds since 2001 as LONG, of nanoseconds (above 1e14) or seconds."""
    v = raw.cast("long")
    return F.when(F.abs(v) > 100_000_000_000_000, v).otherwise(v * 1_000_000_000)
