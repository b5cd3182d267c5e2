"""Numeric column expressions: units, rounding, distances, angles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline import fixed_values as fv


def inches_to_cm(c: Column) -> Column:
    return c * F.lit(fv.CM_PER_INCH)


def fahrenheit_to_celsius(c: Column) -> Column:
    return (c - 32.0) * 5.0 / 9.0


def feet_to_metres(c: Column) -> Column:
    """An elevation of zero counts as unknown."""
    return F.when(c != 0, c * F.lit(fv.METRES_PER_FOOT))


def round_half_even(c: Column, decimals: int) -> Column:
    """Scale, round half to even, scale back; ``round`` would go half up."""
    scale = float(10**decimals)
    return F.rint(c * scale) / scale


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def nans_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing in every floating column."""
    floats = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floats})


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, zero when the denominator is zero."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance of two points in degrees."""
    return haversine_km_radians(
        F.radians(lon1), F.radians(lat1), F.radians(lon2), F.radians(lat2)
    )


def haversine_km_radians(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    half_lat = F.sin((lat2 - lat1) / 2.0)
    half_lon = F.sin((lon2 - lon1) / 2.0)
    a = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    return F.asin(F.sqrt(F.least(F.lit(1.0), a))) * (2.0 * fv.EARTH_RADIUS_KM)


def cell_size_m(lat: Column, degrees: float) -> Column:
    """Edge of a grid cell in metres at a latitude: the mean of its two directions."""
    lon_metres = F.cos(F.radians(lat)) * float(fv.METRES_PER_DEGREE)
    return (lon_metres + float(fv.METRES_PER_DEGREE)) / 2.0 * abs(degrees)


def slope_degrees(dz_dx: Column, dz_dy: Column) -> Column:
    return F.degrees(F.atan(F.sqrt(dz_dx * dz_dx + dz_dy * dz_dy)))


def bearing_of_gradient(dz_dx: Column, dz_dy: Column) -> Column:
    """Compass bearing a slope faces.

    A flat cell faces west: the angle of (0, -0) is a half turn in IEEE arithmetic, while
    Spark's ``atan2`` drops the sign of zero, so that case is written out.
    """
    flat = (dz_dx == 0) & (dz_dy == 0)
    return F.when(flat, F.lit(270.0)).otherwise(
        bearing_of_angle(F.degrees(F.atan2(dz_dy, -dz_dx)))
    )


def bearing_of_angle(angle: Column) -> Column:
    """Angle from east, anticlockwise, to a bearing from north, clockwise, within 0..360."""
    return F.when(angle > 90, 450.0 - angle).otherwise(90.0 - angle)


def compass_name(bearing: Column) -> Column:
    """One of eight names, each a sector of 45 degrees round its direction."""
    sector = F.floor((F.pmod(bearing, F.lit(360.0)) + 22.5) / 45.0).cast("int") % 8
    # The strict element_at takes a null index for one that exists.
    return F.try_element_at(F.array(*[F.lit(n) for n in fv.COMPASS]), sector + 1)


def miss_rate_rating(rate: Column, ratings=fv.SWEEP_RATINGS) -> Column:
    """The first rating whose bound the miss rate stays under."""
    rated = F.lit(ratings[-1][1])
    for bound, text in reversed(ratings[:-1]):
        rated = F.when(rate < bound, F.lit(text)).otherwise(rated)
    return rated


def risk_level(probability: Column, threshold: Column, levels: int = 3) -> Column:
    """HIGH at or above the threshold, LOW below; three levels add a band just under it."""
    chain = F.when(probability >= threshold, F.lit(fv.RISK_HIGH))
    if levels == 3:
        chain = chain.when(probability >= threshold - fv.MODERATE_BAND, F.lit(fv.RISK_MODERATE))
    return chain.otherwise(F.lit(fv.RISK_LOW))
