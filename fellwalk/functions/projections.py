"""Map projections as column expressions: forward, inverse and point scale on the WGS 84 ellipsoid.

Three projections are conformal: the scale at a point is the same in every direction.  Albers'
conic is equal-area: its scales along meridian and parallel are inverse to each other.  Formulas: J. P. Snyder, *Map Projections: A Working Manual*
(1987), and L. Krueger's series for the transverse Mercator projection in the third flattening.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# WGS 84.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)
N3 = FLATTENING / (2 - FLATTENING)

HALF_PI = math.pi / 2


def _series(*rows: tuple[float, ...]) -> tuple[float, ...]:
    """Coefficient j from its polynomial in the third flattening; row j starts at power j."""
    return tuple(sum(c * N3 ** (j + i) for i, c in enumerate(row)) for j, row in enumerate(rows, 1))


# Series coefficients to the fourth power of the third flattening.
ALPHA = _series((1 / 2, -2 / 3, 5 / 16, 41 / 180), (13 / 48, -3 / 5, 557 / 1440), (61 / 240, -103 / 140), (49561 / 161280,))
BETA = _series((1 / 2, -2 / 3, 37 / 96, -1 / 360), (1 / 48, 1 / 15, -437 / 1440), (17 / 480, -37 / 840), (4397 / 161280,))
DELTA = _series((2, -2 / 3, -2, 116 / 45), (7 / 3, -8 / 5, -227 / 45), (56 / 15, -136 / 35), (4279 / 630,))
RECTIFYING = SEMI_MAJOR / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64)


def _t(phi: float) -> float:
    s = E * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (E / 2)


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - E2 * math.sin(phi) ** 2)


def _t_column(phi: Column) -> Column:
    s = F.sin(phi) * E
    return F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(E / 2))


def _from_conformal(chi: Column) -> Column:
    """Latitude from conformal latitude."""
    return sum((F.sin(chi * (2 * j)) * d for j, d in enumerate(DELTA, 1)), chi)


Steps = list[dict[str, Column]]


def _step(name: str) -> Column:
    return F.col(f"_step_{name}")


def with_scales(df: DataFrame, projection: "Projection", along: str, across: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``df`` with the scales of a projection along the meridian and along the parallel, which meet at right angles.

    The formula is laid out in steps that use each other's columns, because one expression
    would repeat its parts until the generated code is too long to compile.
    """
    columns = df.columns
    steps = projection.scale_steps(F.col(lon), F.col(lat))
    for step in steps:
        df = df.select("*", *[c.alias(f"_step_{n}") for n, c in step.items()])
    return df.select(*columns, _step("h" if "h" in steps[-1] else "k").alias(along), _step("k").alias(across))


@dataclass(frozen=True)
class TransverseMercator:
    """Transverse Mercator; ``lon0`` may be a column, so that each row has its own zone."""

    lon0: float | Column
    k0: float = 0.9996
    false_easting: float = 500000.0
    false_northing: float | Column = 0.0

    @classmethod
    def utm(cls, zone: int, north: bool = True) -> "TransverseMercator":
        return cls(zone * 6.0 - 183.0, false_northing=0.0 if north else 10000000.0)

    def _sphere(self, lon: Column, lat: Column) -> tuple[Column, Column, Column]:
        """Tangent of the conformal latitude, and the two angles the series run over."""
        sin_lat = F.sin(F.radians(lat))
        tau = F.sinh(F.atanh(sin_lat) - F.atanh(sin_lat * E) * E)
        away = F.radians(lon - self.lon0)
        return tau, F.atan2(tau, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(tau * tau + 1.0))

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        _, xi, eta = self._sphere(lon, lat)
        y = sum((F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a for j, a in enumerate(ALPHA, 1)), xi)
        x = sum((F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a for j, a in enumerate(ALPHA, 1)), eta)
        size = self.k0 * RECTIFYING
        return x * size + self.false_easting, y * size + self.false_northing

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        size = self.k0 * RECTIFYING
        xi, eta = (y - self.false_northing) / size, (x - self.false_easting) / size
        down = sum((F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * -b for j, b in enumerate(BETA, 1)), xi)
        over = sum((F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * -b for j, b in enumerate(BETA, 1)), eta)
        chi = F.asin(F.sin(down) / F.cosh(over))
        return F.degrees(F.atan2(F.sinh(over), F.cos(down))) + self.lon0, F.degrees(_from_conformal(chi))

    def scale_steps(self, lon: Column, lat: Column) -> Steps:
        tau, xi, eta = self._sphere(lon, lat)
        angle, bend = _step("xi"), _step("eta")
        sums = [
            {"tau": tau, "xi": xi, "eta": eta, "away": F.cos(F.radians(lon - self.lon0)), "tan": F.tan(F.radians(lat))},
            {
                "p": sum((F.cos(angle * (2 * j)) * F.cosh(bend * (2 * j)) * (2 * j * a) for j, a in enumerate(ALPHA, 1)), F.lit(1.0)),
                "q": sum((F.sin(angle * (2 * j)) * F.sinh(bend * (2 * j)) * (2 * j * a) for j, a in enumerate(ALPHA, 1)), F.lit(0.0)),
                "flat": _step("tan") * ((1 - N3) / (1 + N3)),
            },
        ]
        tau, away, flat, p, q = (_step(n) for n in ("tau", "away", "flat", "p", "q"))
        spread = (flat * flat + 1.0) * (p * p + q * q) / (tau * tau + away * away)
        return [*sums, {"k": F.sqrt(spread) * (self.k0 * RECTIFYING / SEMI_MAJOR)}]


@dataclass(frozen=True)
class LambertConformalConic:
    """Lambert conformal conic with two standard parallels."""

    lat1: float
    lat2: float
    lat0: float
    lon0: float

    def _cone(self) -> tuple[float, float, float]:
        a, b = math.radians(self.lat1), math.radians(self.lat2)
        n = math.sin(a) if a == b else math.log(_m(a) / _m(b)) / math.log(_t(a) / _t(b))
        f = _m(a) / (n * _t(a) ** n)
        return n, f, SEMI_MAJOR * f * _t(math.radians(self.lat0)) ** n

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        n, f, rho0 = self._cone()
        rho = F.pow(_t_column(F.radians(lat)), F.lit(n)) * (SEMI_MAJOR * f)
        theta = F.radians(lon - self.lon0) * n
        return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        n, f, rho0 = self._cone()
        sign = math.copysign(1.0, n)
        up = F.lit(rho0) - y
        t = F.pow(F.sqrt(x * x + up * up) / (SEMI_MAJOR * abs(f)), F.lit(1 / n))
        theta = F.atan2(x * sign, up * sign)
        return F.degrees(theta / n) + self.lon0, F.degrees(_from_conformal(F.lit(HALF_PI) - F.atan(t) * 2))

    def scale_steps(self, lon: Column, lat: Column) -> Steps:
        n, f, _ = self._cone()
        phi = F.radians(lat)
        s = F.sin(phi)
        return [{"k": F.pow(_t_column(phi), F.lit(n)) * (f * n) * F.sqrt(F.lit(1.0) - s * s * E2) / F.cos(phi)}]


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - E2) * (s / (1 - E2 * s * s) + math.atanh(E * s) / E)


@dataclass(frozen=True)
class AlbersEqualArea:
    """Albers' equal-area conic with two standard parallels."""

    lat1: float
    lat2: float
    lat0: float
    lon0: float

    def _cone(self) -> tuple[float, float, float]:
        a, b = math.radians(self.lat1), math.radians(self.lat2)
        n = math.sin(a) if a == b else (_m(a) ** 2 - _m(b) ** 2) / (_q(b) - _q(a))
        c = _m(a) ** 2 + n * _q(a)
        return n, c, SEMI_MAJOR * math.sqrt(c - n * _q(math.radians(self.lat0))) / n

    def _radius(self, lat: Column) -> Column:
        """Distance from the cone's tip in semi-major axes, times n."""
        n, c, _ = self._cone()
        s = F.sin(F.radians(lat))
        q = (s / (F.lit(1.0) - s * s * E2) + F.atanh(s * E) / E) * (1 - E2)
        return F.sqrt(F.lit(c) - q * n)

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        n, _, rho0 = self._cone()
        rho = self._radius(lat) * (SEMI_MAJOR / n)
        theta = F.radians(lon - self.lon0) * n
        return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)

    def scale_steps(self, lon: Column, lat: Column) -> Steps:
        s = F.sin(F.radians(lat))
        k = self._radius(lat) * F.sqrt(F.lit(1.0) - s * s * E2) / F.cos(F.radians(lat))
        return [{"k_": k}, {"h": F.lit(1.0) / _step("k_"), "k": _step("k_")}]


@dataclass(frozen=True)
class ObliqueMercator:
    """Oblique Mercator whose centre line goes through two points."""

    lon1: float
    lat1: float
    lon2: float
    lat2: float
    k0: float = 1.0
    lat0: float = 0.0

    def _constants(self) -> tuple[float, float, float, float, float, float]:
        phi0 = math.radians(self.lat0)
        squash = 1 - E2 * math.sin(phi0) ** 2
        b = math.sqrt(1 + E2 * math.cos(phi0) ** 4 / (1 - E2))
        a = SEMI_MAJOR * b * self.k0 * math.sqrt(1 - E2) / squash
        d = b * math.sqrt(1 - E2) / (math.cos(phi0) * math.sqrt(squash))
        lift = math.sqrt(max(d * d - 1, 0.0))
        e = (d + math.copysign(lift, phi0)) * _t(phi0) ** b
        h, l = _t(math.radians(self.lat1)) ** b, _t(math.radians(self.lat2)) ** b
        first, second = math.radians(self.lon1), math.radians(self.lon2)
        second += 2 * math.pi * round((first - second) / (2 * math.pi))
        j = (e * e - l * h) / (e * e + l * h)
        p = (l - h) / (l + h)
        lam0 = (first + second) / 2 - math.atan(j * math.tan(b * (first - second) / 2) / p) / b
        ratio = e / h
        gamma0 = math.atan(2 * math.sin(b * (first - lam0)) / (ratio - 1 / ratio))
        gamma = math.asin(d * math.sin(gamma0))
        return a, b, e, lam0, gamma0, gamma

    def _oblique(self, lon: Column, lat: Column) -> tuple[Column, Column, Column]:
        """Distance along and across the centre line, and the longitude angle."""
        a, b, e, lam0, gamma0, _ = self._constants()
        q = F.lit(e) / F.pow(_t_column(F.radians(lat)), F.lit(b))
        s, t = (q - 1 / q) / 2, (q + 1 / q) / 2
        angle = (F.radians(lon) - lam0) * b
        v = F.sin(angle)
        u = (s * math.sin(gamma0) - v * math.cos(gamma0)) / t
        across = F.log((1 - u) / (1 + u)) * (a / (2 * b))
        along = F.atan2(s * math.cos(gamma0) + v * math.sin(gamma0), F.cos(angle)) * (a / b)
        return along, across, angle

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        along, across, _ = self._oblique(lon, lat)
        gamma = self._constants()[-1]
        sin, cos = math.sin(gamma), math.cos(gamma)
        return across * cos + along * sin, along * cos - across * sin

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        a, b, e, lam0, gamma0, gamma = self._constants()
        across = x * math.cos(gamma) - y * math.sin(gamma)
        along = y * math.cos(gamma) + x * math.sin(gamma)
        q = F.exp(across * (-b / a))
        s, t = (q - 1 / q) / 2, (q + 1 / q) / 2
        v = F.sin(along * (b / a))
        u = (v * math.cos(gamma0) + s * math.sin(gamma0)) / t
        small_t = F.pow(F.lit(e) / F.sqrt((1 + u) / (1 - u)), F.lit(1 / b))
        chi = F.lit(HALF_PI) - F.atan(small_t) * 2
        lam = F.lit(lam0) - F.atan2(s * math.cos(gamma0) - v * math.sin(gamma0), F.cos(along * (b / a))) / b
        return F.degrees(lam), F.degrees(_from_conformal(chi))

    def scale_steps(self, lon: Column, lat: Column) -> Steps:
        a, b, *_ = self._constants()
        along, _, angle = self._oblique(lon, lat)
        phi = F.radians(lat)
        s = F.sin(phi)
        k = F.cos(_step("along") * (b / a)) * F.sqrt(F.lit(1.0) - s * s * E2) * (a / SEMI_MAJOR)
        return [{"along": along, "angle": angle}, {"k": k / (F.cos(phi) * F.cos(_step("angle")))}]


Projection = TransverseMercator | LambertConformalConic | ObliqueMercator | AlbersEqualArea


def utm_zone(lon: Column) -> Column:
    """UTM zone number of a longitude by the plain six-degree rule."""
    return (F.pmod(F.floor((lon + 180.0) / 6.0), F.lit(60)) + 1).cast("int")


def utm_epsg(lon: Column, lat: Column) -> Column:
    """EPSG code of the WGS 84 UTM zone that holds a point."""
    return (F.when(lat >= 0, 32600).otherwise(32700) + utm_zone(lon)).cast("int")


def own_utm(lon: Column, lat: Column) -> TransverseMercator:
    """The UTM projection of the zone that holds the given point, row by row."""
    south = F.when(lat >= 0, 0.0).otherwise(10000000.0)
    return TransverseMercator(utm_zone(lon) * 6.0 - 183.0, false_northing=south)


FACTORS = ("k_mer", "k_par", "k_dist", "anisotropy", "angular_distortion", "k_areal")


def distortion_factors(h: Column, k: Column) -> dict[str, Column]:
    """Distortion factors by name, from the scales along meridian and parallel, which meet at right angles.

    The half axes of the indicatrix are half the sum and half the difference of two roots; the largest turn of an
    angle follows from their ratio.
    """
    total, apart = F.sqrt(h * h + k * k + 2 * h * k), F.sqrt(F.greatest(h * h + k * k - 2 * h * k, F.lit(0.0)))
    angular = F.degrees(F.asin(apart / total) * 2)
    return dict(zip(FACTORS, (h, k, F.sqrt(h * k), (total + apart) / (total - apart), angular, h * k)))
