"""Compact position reporting as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyweft.functions.let import col, let
from skyweft.functions.scalar import positive_mod

SCALE = float(1 << 17)
ZONES = 15
#: A local decode that moves further than this from its reference is dropped, degrees.
LOCAL_GUARD = 5.0


def longitude_zones(lat) -> Column:
    """NL: the number of longitude zones at a latitude."""
    lat = F.abs(col(lat))
    c = F.cos(F.radians(lat))
    inner = 1 - (1 - math.cos(math.pi / (2 * ZONES))) / (c * c)
    zones = F.floor(F.lit(2 * math.pi) / F.acos(clamp_unit(inner)))
    return F.when(lat >= 87.0, F.lit(1)).otherwise(F.greatest(F.lit(1), zones)).cast("int")


def clamp_unit(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(-1.0)), F.lit(1.0))


def _wrapped(x: Column, above: float) -> Column:
    return F.when(x >= above, x - 360.0).otherwise(x)


def global_position(lat_even, lon_even, lat_odd, lon_odd, even_is_newer) -> Column:
    """struct<lat, lon> of an even and odd pair of raw 17-bit values; null if they are
    of different zones. The newer of the pair decides the latitude."""

    def latitudes(v):
        j = F.floor(v["ye"] * 59 - v["yo"] * 60 + 0.5)
        even = _wrapped((positive_mod(j, F.lit(60)) + v["ye"]) * 6.0, 270.0)
        odd = _wrapped((positive_mod(j, F.lit(59)) + v["yo"]) * (360.0 / 59), 270.0)
        return F.struct(v["xe"].alias("xe"), v["xo"].alias("xo"), v["newer"].alias("newer"), even.alias("even"), odd.alias("odd"))

    def zones(v):
        lat = F.when(v["newer"], v["even"]).otherwise(v["odd"])
        return F.struct(v["xe"].alias("xe"), v["xo"].alias("xo"), v["newer"].alias("newer"), lat.alias("lat"), longitude_zones(v["even"]).alias("nle"), longitude_zones(v["odd"]).alias("nlo"))

    def place(v):
        nl = F.when(v["newer"], v["nle"]).otherwise(v["nlo"])
        ni = F.greatest(F.when(v["newer"], nl).otherwise(nl - 1), F.lit(1))
        m = F.floor(v["xe"] * (nl - 1) - v["xo"] * nl + 0.5)
        lon = (positive_mod(m, ni) + F.when(v["newer"], v["xe"]).otherwise(v["xo"])) * (F.lit(360.0) / ni)
        ok = (v["nle"] == v["nlo"]) & v["lat"].between(-90, 90)
        return F.when(ok, F.struct(v["lat"].alias("lat"), _wrapped(lon, 180.0).alias("lon")))

    raw = F.struct(
        (col(lat_even) / SCALE).alias("ye"),
        (col(lon_even) / SCALE).alias("xe"),
        (col(lat_odd) / SCALE).alias("yo"),
        (col(lon_odd) / SCALE).alias("xo"),
        col(even_is_newer).alias("newer"),
    )
    return let(let(let(raw, latitudes), zones), place)


def local_position(odd, lat_cpr, lon_cpr, ref_lat, ref_lon) -> Column:
    """struct<lat, lon> of one frame near a reference; null if it moved over 5 degrees."""

    def nearest(ref, d, x):
        return (F.floor(ref / d) + F.floor(positive_mod(ref, d) / d - x + 0.5) + x) * d

    def latitude(v):
        d = F.when(v["odd"] == 1, 360.0 / 59).otherwise(6.0)
        return F.struct(v["odd"].alias("odd"), v["x"].alias("x"), v["rlat"].alias("rlat"), v["rlon"].alias("rlon"), nearest(v["rlat"], d, v["y"]).alias("lat"))

    def place(v):
        d = F.lit(360.0) / F.greatest(longitude_zones(v["lat"]) - v["odd"], F.lit(1))
        lon = nearest(v["rlon"], d, v["x"])
        ok = (F.abs(v["lat"] - v["rlat"]) <= LOCAL_GUARD) & (F.abs(lon - v["rlon"]) <= LOCAL_GUARD)
        return F.when(ok, F.struct(v["lat"].alias("lat"), lon.alias("lon")))

    raw = F.struct(
        col(odd).alias("odd"), (col(lat_cpr) / SCALE).alias("y"), (col(lon_cpr) / SCALE).alias("x"), col(ref_lat).alias("rlat"), col(ref_lon).alias("rlon")
    )
    return let(let(raw, latitude), place)
