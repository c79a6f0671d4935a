"""Geodesy as column expressions: WGS84, local frames, refraction, ellipses.

Vectors are structs of x, y and z in metres; angles are degrees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyweft.functions.let import col, let
from skyweft.functions.scalar import FEET

#: WGS84 (fixed values).
A, FLATTENING = 6378137.0, 1 / 298.257223563
B = A * (1 - FLATTENING)
E2 = 1 - (B / A) ** 2
EP2 = (A * A - B * B) / (B * B)
#: Speed of light in vacuum and near the ground, m/s (fixed values).
C_VACUUM, C_AIR = 299792458.0, 299702547.0
#: Refractivity at the ground and its decay per metre (fixed values).
REFRACTIVITY, DECAY = 315e-6, 0.1361e-3
KNOTS, FPM = 1.9438444924406, 196.85039370079
DEFAULT_ALT_M = 10_000.0


def vec(x, y, z) -> Column:
    return F.struct(col(x).alias("x"), col(y).alias("y"), col(z).alias("z"))


def norm(v: Column) -> Column:
    return F.sqrt(v["x"] * v["x"] + v["y"] * v["y"] + v["z"] * v["z"])


def minus(a: Column, b: Column) -> Column:
    return vec(a["x"] - b["x"], a["y"] - b["y"], a["z"] - b["z"])


def distance(a: Column, b: Column) -> Column:
    dx, dy, dz = a["x"] - b["x"], a["y"] - b["y"], a["z"] - b["z"]
    return F.sqrt(dx * dx + dy * dy + dz * dz)


def lla_to_ecef(lat, lon, alt_m) -> Column:
    phi, lam, h = F.radians(col(lat)), F.radians(col(lon)), col(alt_m)
    n = A / F.sqrt(1 - F.sin(phi) * F.sin(phi) * E2)
    return vec((n + h) * F.cos(phi) * F.cos(lam), (n + h) * F.cos(phi) * F.sin(lam), (n * (1 - E2) + h) * F.sin(phi))


def position_to_ecef(lat, lon, alt_ft) -> Column:
    """With 10 km where the altitude is unknown."""
    return lla_to_ecef(lat, lon, F.coalesce(col(alt_ft) * FEET, F.lit(DEFAULT_ALT_M)))


def ecef_to_lla(x, y, z) -> Column:
    """struct<lat, lon, alt>: Bowring's formula with one refinement."""
    x, y, z = col(x), col(y), col(z)
    p = F.sqrt(x * x + y * y)
    theta = F.atan2(z * A, p * B)
    s, c = F.sin(theta), F.cos(theta)
    first = F.atan2(z + s * s * s * (EP2 * B), p - c * c * c * (E2 * A))
    n1 = A / F.sqrt(1 - F.sin(first) * F.sin(first) * E2)
    lat = F.atan2(z + n1 * E2 * F.sin(first), p)
    n2 = A / F.sqrt(1 - F.sin(lat) * F.sin(lat) * E2)
    alt = F.when(F.abs(F.cos(lat)) > 1e-10, p / F.cos(lat) - n2).otherwise(F.abs(z) - B)
    return F.struct(F.degrees(lat).alias("lat"), F.degrees(F.atan2(y, x)).alias("lon"), alt.alias("alt"))


def effective_velocity(sensor_alt_m, aircraft_alt_m) -> Column:
    """Light's mean speed between two altitudes in an exponential atmosphere."""
    lo, hi = col(sensor_alt_m), col(aircraft_alt_m)
    dh = hi - lo
    level = F.exp(lo * -DECAY) * REFRACTIVITY
    slant = (F.exp(lo * -DECAY) - F.exp(hi * -DECAY)) * REFRACTIVITY / (dh * DECAY)
    return F.lit(C_VACUUM) / (F.when(F.abs(dh) < 1.0, level).otherwise(slant) + 1)


def enu_axes(lat, lon) -> dict[str, tuple]:
    """East, north and up unit vectors at a place, as (x, y, z) columns."""
    phi, lam = F.radians(col(lat)), F.radians(col(lon))
    sp, cp, sl, cl = F.sin(phi), F.cos(phi), F.sin(lam), F.cos(lam)
    return {"e": (-sl, cl, F.lit(0.0)), "n": (-sp * cl, -sp * sl, cp), "u": (cp * cl, cp * sl, sp)}


def ecef_to_enu_velocity(lat, lon, vx, vy, vz) -> Column:
    axes, v = enu_axes(lat, lon), (col(vx), col(vy), col(vz))
    dot = lambda a: a[0] * v[0] + a[1] * v[1] + a[2] * v[2]
    return F.struct(dot(axes["e"]).alias("e"), dot(axes["n"]).alias("n"), dot(axes["u"]).alias("u"))


def enu_to_ecef_velocity(lat, lon, e, n, u) -> Column:
    a = enu_axes(lat, lon)
    parts = [a["e"][i] * col(e) + a["n"][i] * col(n) + a["u"][i] * col(u) for i in range(3)]
    return vec(*parts)


def motion(lat, lon, vx, vy, vz) -> Column:
    """struct<heading_deg, speed_kts, vrate_fpm>; heading 0 below 1 m/s."""
    v = ecef_to_enu_velocity(lat, lon, vx, vy, vz)
    speed = F.sqrt(v["e"] * v["e"] + v["n"] * v["n"])
    heading = F.degrees(F.atan2(v["e"], v["n"]))
    heading = F.when(heading < 0, heading + 360).otherwise(heading)
    return F.struct(
        F.when(speed < 1.0, F.lit(0.0)).otherwise(heading).alias("heading_deg"), (speed * KNOTS).alias("speed_kts"), (v["u"] * FPM).alias("vrate_fpm")
    )


#: Points of a drawn ellipse and its scale in standard deviations.
ELLIPSE_POINTS, ELLIPSE_SCALE = 32, 3.03
#: An ellipse is drawn if the first variance is under this.
ELLIPSE_MOST = 1e5
#: Metres in a degree of latitude and around the equator, as drawn.
DEGREE_M, EQUATOR_M = 111320.0, 40075000.0


def covariance_ellipse(lat, lon, a, b, d) -> Column:
    """array<array<double>>: [lon, lat] points of the ellipse of ((a, b), (b, d))."""
    lat, lon, a, b, d = map(col, (lat, lon, a, b, d))
    half, gap = (a + d) / 2, F.sqrt((a - d) * (a - d) / 4 + b * b)
    turn = F.atan2(b * 2, a - d) / 2
    # what all points share is worked out once a row, not in each point
    whole = F.struct(
        lat.alias("lat"), lon.alias("lon"), (F.sqrt(F.greatest(half + gap, F.lit(0.0))) * ELLIPSE_SCALE).alias("major"), (F.sqrt(F.greatest(half - gap, F.lit(0.0))) * ELLIPSE_SCALE).alias("minor"),
        F.cos(turn).alias("cos"), F.sin(turn).alias("sin"), (F.cos(F.radians(lat)) * (EQUATOR_M / 360)).alias("degree_m"),
    )
    angles = [i * (2 * math.pi / ELLIPSE_POINTS) for i in range(ELLIPSE_POINTS)]
    circle = F.array(*[F.struct(F.cos(F.lit(t)).alias("x"), F.sin(F.lit(t)).alias("y")) for t in angles])

    def point(e, on):
        x, y = e["major"] * on["x"], e["minor"] * on["y"]
        east, north = x * e["cos"] - y * e["sin"], x * e["sin"] + y * e["cos"]
        return F.array(e["lon"] + east / e["degree_m"], e["lat"] + north / DEGREE_M)

    return F.when(a < ELLIPSE_MOST, let(whole, lambda e: F.transform(circle, lambda on: point(e, on))))
