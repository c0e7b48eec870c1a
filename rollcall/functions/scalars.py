"""Numeric, text and geographic expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hospital location (degrees) and earth radius (km).
HOSPITAL_LAT = 52.08593762444437
HOSPITAL_LON = 5.179600848939784
EARTH_RADIUS_KM = 6373.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pseudonymize(value: Column | str, salt: str) -> Column:
    """Salted SHA-256 as upper-case hex; a missing value hashes the salt alone."""
    text = F.coalesce(_col(value).cast("string"), F.lit(""))
    return F.upper(F.sha2(F.concat(text, F.lit(salt)), 256))


def haversine_km(
    lat: Column | str,
    lon: Column | str,
    to_lat: float = HOSPITAL_LAT,
    to_lon: float = HOSPITAL_LON,
) -> Column:
    """Great-circle distance to a fixed point."""
    phi = F.radians(_col(lat))
    target = F.radians(F.lit(to_lat))
    half_lat = F.sin((target - phi) / 2)
    half_lon = F.sin((F.radians(F.lit(to_lon)) - F.radians(_col(lon))) / 2)
    chord = half_lat * half_lat + F.cos(phi) * F.cos(target) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def share(part: Column, whole: Column) -> Column:
    """Ratio that is 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def clamp(value: Column, low: Column, high: Column) -> Column:
    """Limit to [low, high]; missing stays missing."""
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def not_in(value: Column | str, items: Sequence) -> Column:
    """Row filter that keeps missing values, unlike SQL ``NOT IN``."""
    if not items:
        return F.lit(True)
    return ~F.coalesce(_col(value).isin(list(items)), F.lit(False))


def differs_from(value: Column | str, other) -> Column:
    """Null-safe inequality: missing differs from every value."""
    other = other if isinstance(other, Column) else F.lit(other)
    return ~_col(value).eqNullSafe(other)


def right_closed_bin(value: Column | str, inner_edges: Sequence[float]) -> Column:
    """Index of the ``(a, b]`` bin: how many of the sorted inner edges lie below."""
    value = _col(value)
    terms = [F.when(value > F.lit(float(e)), 1).otherwise(0) for e in inner_edges]
    if not terms:
        return F.when(value.isNotNull(), F.lit(0))
    return F.when(value.isNotNull(), reduce(add, terms))


def uniform_edges(n_bins: int) -> list[float]:
    """``n_bins + 1`` evenly spaced edges on [0, 1]."""
    return [i * (1.0 / n_bins) for i in range(n_bins)] + [1.0]


def blank_to_null(value: Column | str) -> Column:
    value = _col(value)
    return F.when(value != "", value)
