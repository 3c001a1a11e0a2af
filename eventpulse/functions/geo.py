"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import ColumnLike, as_column

# Earth radius in miles and kilometres per mile.
RADIUS_MILES = 3961
UNITS = {"mi": 1.0, "km": 1.60934}


def degrees_to_radians(degrees: ColumnLike) -> Column:
    return F.radians(as_column(degrees))


def haversine_distance(
    lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike, unit: str = "mi"
) -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}, got {unit!r}")
    phi1, lam1, phi2, lam2 = (degrees_to_radians(c) for c in (lat1, lon1, lat2, lon2))
    half_chord = F.pow(F.sin((phi2 - phi1) / 2), F.lit(2.0)) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin((lam2 - lam1) / 2), F.lit(2.0)
    )
    # Rounding can push antipodal points a hair over one, where asin is NaN.
    return F.asin(F.sqrt(F.least(half_chord, F.lit(1.0)))) * F.lit(2.0 * RADIUS_MILES * UNITS[unit])
