"""The projection formulas as SQL text, for the oracle side only."""

from __future__ import annotations

from fellwalk.functions.projections import (
    ALPHA, BETA, DELTA, E, E2, N3, RECTIFYING, SEMI_MAJOR, AlbersEqualArea, LambertConformalConic, ObliqueMercator,
)


def num(value: float) -> str:
    """A double literal."""
    return f"({value!r})::DOUBLE"


def _sum(first: str, terms: list[str]) -> str:
    return "(" + " + ".join([first, *terms]) + ")"


def small_t(phi: str) -> str:
    s = f"{num(E)} * sin({phi})"
    return f"(tan(pi() / 4 - ({phi}) / 2) / pow((1 - {s}) / (1 + {s}), {num(E / 2)}))"


def latitude(chi: str) -> str:
    return _sum(chi, [f"{num(d)} * sin({2 * j} * {chi})" for j, d in enumerate(DELTA, 1)])


def tm_sphere(source: str, lon0: str) -> str:
    """``source`` (with lon, lat) plus tau, xi, eta, away."""
    return f"""SELECT *, atan2(tau, cos(away)) AS xi, atanh(sin(away) / sqrt(1 + tau * tau)) AS eta FROM (
  SELECT *, sinh(atanh(sin(radians(lat))) - {num(E)} * atanh({num(E)} * sin(radians(lat)))) AS tau,
    radians(lon - {lon0}) AS away FROM ({source}))"""


def tm_xy(south: str = "0") -> tuple[str, str]:
    """Easting and northing over :func:`tm_sphere`."""
    size = num(0.9996 * RECTIFYING)
    x = _sum("eta", [f"{num(a)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(ALPHA, 1)])
    y = _sum("xi", [f"{num(a)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(ALPHA, 1)])
    return f"500000.0::DOUBLE + {size} * {x}", f"{south} + {size} * {y}"


def tm_scale() -> str:
    """Point scale over :func:`tm_sphere`."""
    p = _sum("1", [f"{num(2 * j * a)} * cos({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(ALPHA, 1)])
    q = _sum("0", [f"{num(2 * j * a)} * sin({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(ALPHA, 1)])
    head = f"{num(0.9996 * RECTIFYING / SEMI_MAJOR)}"
    return f"""({head} * sqrt((1 + pow({num((1 - N3) / (1 + N3))} * tan(radians(lat)), 2)) * (pow({p}, 2) + pow({q}, 2))
  / (tau * tau + pow(cos(away), 2))))"""


def tm_inverse(source: str, lon0: str) -> str:
    """``source`` (with x, y) plus lon, lat."""
    size = num(0.9996 * RECTIFYING)
    down = _sum("u", [f"{num(-b)} * sin({2 * j} * u) * cosh({2 * j} * v)" for j, b in enumerate(BETA, 1)])
    over = _sum("v", [f"{num(-b)} * cos({2 * j} * u) * sinh({2 * j} * v)" for j, b in enumerate(BETA, 1)])
    return f"""SELECT *, degrees(atan2(sinh(over_), cos(down_))) + {lon0} AS lon, degrees({latitude('chi')}) AS lat FROM (
  SELECT *, asin(sin(down_) / cosh(over_)) AS chi FROM (
    SELECT *, {down} AS down_, {over} AS over_ FROM (
      SELECT *, y / {size} AS u, (x - 500000.0::DOUBLE) / {size} AS v FROM ({source}))))"""


def lcc_scale(p: LambertConformalConic) -> str:
    n, f, _ = p._cone()
    phi = "radians(lat)"
    return f"({num(f * n)} * pow({small_t(phi)}, {num(n)}) * sqrt(1 - {num(E2)} * pow(sin({phi}), 2)) / cos({phi}))"


def albers_scale(p: AlbersEqualArea) -> str:
    """Scale along the parallel, with the cone's constants worked out in SQL."""
    m2 = lambda phi: f"(pow(cos({phi}), 2) / (1 - {num(E2)} * pow(sin({phi}), 2)))"
    q = lambda phi: f"({num(1 - E2)} * (sin({phi}) / (1 - {num(E2)} * pow(sin({phi}), 2)) - ln((1 - {num(E)} * sin({phi})) / (1 + {num(E)} * sin({phi}))) / {num(2 * E)}))"
    a, b, phi = f"radians({num(p.lat1)})", f"radians({num(p.lat2)})", "radians(lat)"
    n = f"(({m2(a)} - {m2(b)}) / ({q(b)} - {q(a)}))"
    return f"sqrt(({m2(a)} + {n} * {q(a)} - {n} * {q(phi)}) / {m2(phi)})"


def omerc_scale(p: ObliqueMercator) -> str:
    import math

    a, b, e, lam0, gamma0, _ = p._constants()
    q = f"({num(e)} / pow({small_t('radians(lat)')}, {num(b)}))"
    s = f"(({q} - 1 / {q}) / 2)"
    angle = f"({num(b)} * (radians(lon) - {num(lam0)}))"
    along = f"atan2({s} * {num(math.cos(gamma0))} + sin({angle}) * {num(math.sin(gamma0))}, cos({angle}))"
    return f"""({num(a / SEMI_MAJOR)} * cos({along}) * sqrt(1 - {num(E2)} * pow(sin(radians(lat)), 2))
  / (cos(radians(lat)) * cos({angle})))"""
