"""Distances and a latitude band / longitude cell grid for radius joins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                 radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = p2 - p1
    dlmb = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


class Grid:
    """Bands of height R/111 degrees; each band cut into cells at least R wide.

    A point within R km of another lies in the same band or a neighbouring
    one, and in that band in the same cell or a neighbouring one (cells wrap
    at +-180).  Bands near the poles are one cell.
    """

    def __init__(self, radius_km: float):
        self.radius_km = radius_km
        self.h = radius_km / 111.0
        self.n_bands = int(math.floor(180.0 / self.h)) + 1
        self.ang = radius_km / EARTH_RADIUS_KM

    def band(self, lat: Column) -> Column:
        b = F.floor((lat + F.lit(90.0)) / F.lit(self.h))
        return F.least(F.greatest(b, F.lit(0)), F.lit(self.n_bands - 1)).cast("long")

    def cells_in_band(self, band: Column) -> Column:
        """Number of cells of a band (1 near the poles or for huge radii)."""
        lo = band * F.lit(self.h) - F.lit(90.0)
        hi = lo + F.lit(self.h)
        edge = F.least(F.greatest(F.abs(lo), F.abs(hi)), F.lit(90.0))
        ratio = F.lit(math.sin(self.ang)) / F.cos(F.radians(edge))
        n = F.floor(F.lit(360.0) / F.degrees(F.asin(F.least(ratio, F.lit(1.0)))))
        one = (edge >= F.lit(90.0 - self.h)) | (ratio >= F.lit(1.0)) | (n < F.lit(3))
        return F.when(one, F.lit(1)).otherwise(n).cast("long")

    def cell(self, lon: Column, n_cells: Column) -> Column:
        pos = F.pmod(lon + F.lit(180.0), F.lit(360.0))
        return F.least(n_cells - F.lit(1), F.floor(pos / F.lit(360.0) * n_cells)).cast("long")
