"""Scalar number functions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def half_up(x: Column) -> Column:
    """Rounded, halves upwards."""
    return F.floor(x + 0.5)


def half_even(x: Column, digits: int = 0) -> Column:
    return F.bround(x, digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """part / whole in per cent, halves to even; 0 of nothing."""
    return F.when(whole == 0, 0.0).otherwise(F.bround(part / whole * 100, digits))


def capped_percent(n: Column, expected: int = 60) -> Column:
    return F.least(F.lit(100), F.bround(n / expected * 100).cast("int"))


def marker_size(votes: Column) -> Column:
    return F.floor(12 + F.least(votes / 4, F.lit(16.0)) + 0.5)


def stand_in_page(file_name: Column) -> Column:
    """A page number from 1000 to 9999 for a file without one."""
    return F.pmod(F.xxhash64(file_name), F.lit(9000)) + 1000


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))
