"""Transverse Mercator as closed column expressions, forward and back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TransverseMercator:
    """An ellipsoid's axes, the scale on the central meridian, the true origin and its false coordinates."""

    a: float
    b: float
    scale: float
    lat0: float
    lon0: float
    e0: float
    n0: float

    def _arc(self, lat: Column) -> Column:
        n = (self.a - self.b) / (self.a + self.b)
        d, s = lat - F.radians(F.lit(self.lat0)), lat + F.radians(F.lit(self.lat0))
        return (self.b * self.scale) * (
            (1 + n + 5 / 4 * n**2 + 5 / 4 * n**3) * d
            - (3 * n + 3 * n**2 + 21 / 8 * n**3) * F.sin(d) * F.cos(s)
            + (15 / 8 * n**2 + 15 / 8 * n**3) * F.sin(2 * d) * F.cos(2 * s)
            - (35 / 24 * n**3) * F.sin(3 * d) * F.cos(3 * s)
        )

    def _radii(self, lat: Column) -> tuple[Column, Column, Column]:
        e2 = 1 - (self.b / self.a) ** 2
        w = 1 - e2 * F.sin(lat) * F.sin(lat)
        nu = self.a * self.scale / F.sqrt(w)
        rho = self.a * self.scale * (1 - e2) / F.pow(w, 1.5)
        return nu, rho, nu / rho - 1

    def forward(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """Degrees to easting and northing."""
        p, d = F.radians(lat), F.radians(lon - self.lon0)
        nu, rho, eta = self._radii(p)
        s, c, t = F.sin(p), F.cos(p), F.tan(p)
        north = (
            self._arc(p) + self.n0 + nu / 2 * s * c * d**2
            + nu / 24 * s * c**3 * (5 - t**2 + 9 * eta) * d**4
            + nu / 720 * s * c**5 * (61 - 58 * t**2 + t**4) * d**6
        )
        east = (
            self.e0 + nu * c * d + nu / 6 * c**3 * (nu / rho - t**2) * d**3
            + nu / 120 * c**5 * (5 - 18 * t**2 + t**4 + 14 * eta - 58 * t**2 * eta) * d**5
        )
        return east, north

    def backward(self, east: Column, north: Column) -> tuple[Column, Column]:
        """Easting and northing to degrees."""
        step = lambda p: p + (north - self.n0 - self._arc(p)) / (self.a * self.scale)
        start = F.radians(F.lit(self.lat0)) + (north - self.n0) / (self.a * self.scale)
        # lambdas bind each value once, so that nested formulas don't multiply
        foot = F.aggregate(F.sequence(F.lit(1), F.lit(4)), start, lambda p, _: step(p))
        found = F.transform(F.array(foot), lambda p: self._from_foot(p, east - self.e0))[0]
        return F.degrees(found["lat"]), F.degrees(found["lon"])

    def _from_foot(self, p: Column, x: Column) -> Column:
        nu, rho, eta = self._radii(p)
        t, sec = F.tan(p), 1 / F.cos(p)
        lat = (
            p - t / (2 * rho * nu) * x**2 + t / (24 * rho * nu**3) * (5 + 3 * t**2 + eta - 9 * t**2 * eta) * x**4
            - t / (720 * rho * nu**5) * (61 + 90 * t**2 + 45 * t**4) * x**6
        )
        lon = (
            F.radians(F.lit(self.lon0)) + sec / nu * x - sec / (6 * nu**3) * (nu / rho + 2 * t**2) * x**3
            + sec / (120 * nu**5) * (5 + 28 * t**2 + 24 * t**4) * x**5
            - sec / (5040 * nu**7) * (61 + 662 * t**2 + 1320 * t**4 + 720 * t**6) * x**7
        )
        return F.struct(lat.alias("lat"), lon.alias("lon"))


#: The British National Grid on the Airy 1830 ellipsoid.
NATIONAL_GRID = TransverseMercator(6_377_563.396, 6_356_256.909, 0.9996012717, 49.0, -2.0, 400_000.0, -100_000.0)
#: UTM zone 30 north on WGS 84.
UTM_30N = TransverseMercator(6_378_137.0, 6_356_752.314245, 0.9996, 0.0, -3.0, 500_000.0, 0.0)
