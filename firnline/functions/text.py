"""Column expressions on text and on values parsed from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firnline import fixed_values as fv

# Every character that counts as white space in Unicode text.
_SPACES = "".join(
    chr(c) for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends; ``trim`` alone would leave tabs."""
    return F.btrim(c, F.lit(_SPACES))


def null_if_in(c: Column, tokens: list[str]) -> Column:
    return F.when(~c.isin(tokens), c)


def cell(c: Column, placeholders: list[str] = fv.PLACEHOLDERS) -> Column:
    """Stripped text, null for a placeholder: ``null_if_in`` of ``strip`` in one step."""
    value = strip(c)
    for token in placeholders:
        value = F.nullif(value, F.lit(token))
    return value


def to_number(c: Column) -> Column:
    """Text to double, null when it is no finite decimal number.

    Java also reads ``12d``, ``0x1p3``, ``NaN`` and ``Infinity``; each holds a letter other than
    the exponent's.
    """
    return F.when(~c.rlike("[a-df-zA-DF-Z]"), strip(c).try_cast("double"))


def destructive_size(c: Column) -> Column:
    """The first size code in a text as a double, null when there is none."""
    return F.regexp_extract(c, fv.SIZE_PATTERN, 1).try_cast("double")


def fixed(c: Column, decimals: int) -> Column:
    """Decimal text, half-even like C's ``%.nf`` up to binary rounding of the scaled value."""
    scale = float(10**decimals)
    return F.format_string(f"%.{decimals}f", F.rint(c * scale) / scale)


def signed(c: Column, decimals: int) -> Column:
    scale = float(10**decimals)
    return F.format_string(f"%+.{decimals}f", F.rint(c * scale) / scale)


def title_case(c: Column) -> Column:
    """``new_snow_24h`` becomes ``New Snow 24H``: a letter after a non-letter is a capital, any other is small."""
    pieces = F.split(F.replace(c, F.lit("_"), F.lit(" ")), r"(?<=\P{L})(?=\p{L})", -1)
    raised = F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30))))
    return F.array_join(raised, "")


def degrees_text(c: Column) -> Column:
    """Degrees with six decimals, put together from whole micro-degrees.

    Several times cheaper per row than ``format_string``, which interprets its format each time.
    """
    micro = F.abs(F.rint(c * 1e6)).cast("long")
    sign = F.when(c < 0, "-").otherwise("")
    whole, rest = F.floor(micro / 1_000_000), micro % 1_000_000
    return F.concat(
        sign, whole.cast("string"), F.lit("."), F.lpad(rest.cast("string"), 6, "0")
    )


def event_id(lon: Column, lat: Column, ts: Column) -> Column:
    """Identifier of a place and a minute: degrees with six decimals, then yyyymmdd_HHMM."""
    return F.concat_ws(
        "_", degrees_text(lon), degrees_text(lat), F.date_format(ts, "yyyyMMdd_HHmm")
    )


def event_key(lon: Column, lat: Column, ts: Column) -> dict[str, Column]:
    """The same identity as numbers: cheaper to sort and shuffle than the text."""
    return {
        "__lon": F.rint(lon * 1e6).cast("long"),
        "__lat": F.rint(lat * 1e6).cast("long"),
        "__day": F.to_date(ts),
        "__minute": F.hour(ts) * 60 + F.minute(ts),
    }


def station_number(triplet: Column) -> Column:
    """First part of a three-part station code, null for any other shape."""
    parts = F.split(triplet, ":")
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(0)))
