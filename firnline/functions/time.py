"""Column expressions on dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Month/day/year, optionally with hour:minute[:second] and AM or PM.
_SLASHED = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})(?:[ T]+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([AaPp][Mm])?)?\s*$"


def _slashed_as_iso(c: Column) -> Column:
    """Month/day/year text put in ISO order; null for any other text or an hour the clock lacks."""
    def part(i: int, default: str = "00") -> Column:
        return F.lpad(F.coalesce(F.nullif(F.regexp_extract(c, _SLASHED, i), F.lit("")), F.lit(default)), 2, "0")

    hour, half = part(4).cast("int"), F.upper(F.regexp_extract(c, _SLASHED, 7))
    clock = F.when(half == "", hour).when(
        hour.between(1, 12), hour % 12 + F.when(half == "PM", 12).otherwise(0)
    )
    text = F.concat(
        F.regexp_extract(c, _SLASHED, 3), F.lit("-"), part(1), F.lit("-"), part(2), F.lit(" "),
        F.lpad(clock.cast("string"), 2, "0"), F.lit(":"), part(5), F.lit(":"), part(6),
    )
    return F.when(c.rlike(_SLASHED), text)


def to_time(c: Column, strict: bool = True, formats: Sequence[str] = ()) -> Column:
    """Text to a zone-less timestamp: ISO, month/day/year, then each of ``formats`` in turn.

    Null passes; text that no form fits raises, unless lenient.
    """
    parsed = F.coalesce(
        c.try_cast("timestamp_ntz"), _slashed_as_iso(c).try_cast("timestamp_ntz"),
        *[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats],
    )
    if not strict:
        return parsed
    bad = F.raise_error(F.concat(F.lit("not a date: "), c)).cast("timestamp_ntz")
    return F.coalesce(parsed, F.when(c.isNotNull(), bad))


def plus_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days=days)


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")
