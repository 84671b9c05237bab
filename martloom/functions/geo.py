"""Distances and local time as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def decimal_comma(col) -> Column:
    """Text with a decimal comma to double; unreadable text becomes NULL."""
    return F.regexp_replace(col, ",", ".").try_cast("double")


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    lat1, lng1, lat2, lng2 = (
        F.radians((F.col(c) if isinstance(c, str) else c).cast("double"))
        for c in (lat1, lng1, lat2, lng2)
    )
    half = (
        F.pow(F.sin((lat2 - lat1) / 2), 2)
        + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lng2 - lng1) / 2), 2)
    )
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(half, F.lit(1.0))))


def position_km(lat, lng) -> dict[str, Column]:
    """Place of a point in earth-centred axes, in km; NULL coordinates give NULLs.

    The straight line between two places grows with the great-circle distance
    and is never longer, so it can stand in for it in comparisons.
    """
    phi, theta = F.radians(lat), F.radians(lng)
    return {
        "x": F.cos(phi) * F.cos(theta) * EARTH_RADIUS_KM,
        "y": F.cos(phi) * F.sin(theta) * EARTH_RADIUS_KM,
        "z": F.sin(phi) * EARTH_RADIUS_KM,
    }


def local_time(ts, timezone) -> Column:
    """UTC time shown on a wall clock in ``timezone``, without a zone."""
    return F.convert_timezone(F.lit("UTC"), timezone, ts)
