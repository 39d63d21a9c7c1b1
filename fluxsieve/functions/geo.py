"""Spherical distance expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fluxsieve import fixed


def half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Squared half chord of the unit sphere: grows with distance, needs no inverse sine."""
    a, b = F.radians(lat1), F.radians(lat2)
    return (
        F.pow(F.sin((b - a) / 2), 2)
        + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )


def chord_metres(h: Column) -> Column:
    return F.lit(2 * fixed.EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return chord_metres(half_chord(lat1, lon1, lat2, lon2))


def path_m(points: Column) -> Column:
    """Length of an array of (lat, lon) structs."""
    legs = F.zip_with(
        F.slice(points, F.lit(1), F.greatest(F.size(points) - 1, F.lit(0))),
        F.slice(points, F.lit(2), F.greatest(F.size(points) - 1, F.lit(0))),
        lambda p, q: haversine_m(p["lat"], p["lon"], q["lat"], q["lon"]),
    )
    return F.aggregate(legs, F.lit(0.0), lambda total, leg: total + leg)


def box_bounds(lat: Column, lon: Column, box: Column) -> tuple[Column, Column]:
    """Lower and upper bound of the half chord from a point to any point of a box.

    ``box`` holds lat_lo, lat_hi, lon_lo, lon_hi in degrees. The bounds use the nearest and
    farthest latitude and longitude offsets separately, so they always enclose the truth.
    """
    def clear(x, lo, hi):
        return F.greatest(F.lit(0.0), lo - x, x - hi)

    def reach(x, lo, hi):
        return F.greatest(F.abs(x - lo), F.abs(x - hi))

    near_lon = F.least(
        clear(lon, box["lon_lo"], box["lon_hi"]),
        clear(lon, box["lon_lo"] - 360, box["lon_hi"] - 360),
        clear(lon, box["lon_lo"] + 360, box["lon_hi"] + 360),
    )
    far_lon = F.least(F.lit(180.0), reach(lon, box["lon_lo"], box["lon_hi"]))
    cos_point = F.cos(F.radians(lat))
    cos_lo, cos_hi = F.cos(F.radians(box["lat_lo"])), F.cos(F.radians(box["lat_hi"]))
    cos_max = F.when((box["lat_lo"] <= 0) & (box["lat_hi"] >= 0), F.lit(1.0)).otherwise(
        F.greatest(cos_lo, cos_hi))

    def square(deg):
        return F.pow(F.sin(F.radians(deg) / 2), 2)

    lower = (square(clear(lat, box["lat_lo"], box["lat_hi"]))
             + cos_point * F.least(cos_lo, cos_hi) * square(near_lon))
    upper = (square(reach(lat, box["lat_lo"], box["lat_hi"]))
             + cos_point * cos_max * square(far_lon))
    return lower, upper
