"""Positions of airborne position messages: pair decodes, then local ones."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyweft.functions import cpr, modes
from skyweft.operators.joins import even_odd

PAIR_NS = 10_000_000_000


def decoded_positions(groups: DataFrame) -> DataFrame:
    """``groups`` with cpr_lat, cpr_lon, cpr_alt_ft and vel_e, vel_n, vel_u (m/s).

    An even and odd frame within 10 s decode globally; any other frame is decoded near
    the aircraft's last global position. All windows share one sort by aircraft.
    """
    f = modes.position_fields("raw_msg")
    v = modes.velocity_fields("raw_msg")
    df = groups.withColumn("__f", F.when(F.col("df_type") == 17, f)).withColumn("__v", F.when(F.col("df_type") == 17, v))
    df = df.withColumns({"__lat": F.col("__f.lat_cpr"), "__lon": F.col("__f.lon_cpr")})
    df = even_odd(df, "icao", "t_ns", ["raw_msg"], F.col("__f.odd") == 1, ["__lat", "__lon"], F.lit(PAIR_NS))
    both = F.col("even_t").isNotNull() & F.col("odd_t").isNotNull() & F.col("__f").isNotNull()
    place = cpr.global_position("even___lat", "even___lon", "odd___lat", "odd___lon", F.col("even_t") >= F.col("odd_t"))
    df = df.withColumn("__g", F.when(both, place))
    w = Window.partitionBy("icao").orderBy("t_ns", "raw_msg").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("__ref", F.last("__g", ignorenulls=True).over(w))
    near = cpr.local_position(F.col("__f.odd"), F.col("__f.lat_cpr"), F.col("__f.lon_cpr"), F.col("__ref.lat"), F.col("__ref.lon"))
    df = df.withColumn("__p", F.coalesce("__g", F.when(F.col("__ref").isNotNull() & F.col("__f").isNotNull(), near)))
    return df.select(
        *groups.columns,
        F.col("__p.lat").alias("cpr_lat"),
        F.col("__p.lon").alias("cpr_lon"),
        F.col("__f.alt_ft").cast("double").alias("cpr_alt_ft"),
        (F.col("__v.ew_knots") * 0.514444).alias("vel_e"),
        (F.col("__v.ns_knots") * 0.514444).alias("vel_n"),
        (F.col("__v.vrate_fpm") * 0.00508).alias("vel_u"),
    )


def with_fields(groups: DataFrame) -> DataFrame:
    """``groups`` with what a message itself tells of position and velocity: FIELDS."""
    own = F.col("df_type") == 17
    df = groups.withColumn("__f", F.when(own, modes.position_fields("raw_msg"))).withColumn("__v", F.when(own, modes.velocity_fields("raw_msg")))
    return df.select(
        *groups.columns,
        F.col("__f.odd").cast("int").alias("cpr_odd"),
        F.col("__f.lat_cpr").cast("int").alias("cpr_y"),
        F.col("__f.lon_cpr").cast("int").alias("cpr_x"),
        F.col("__f.alt_ft").cast("double").alias("cpr_alt_ft"),
        (F.col("__v.ew_knots") * 0.514444).alias("vel_e"),
        (F.col("__v.ns_knots") * 0.514444).alias("vel_n"),
        (F.col("__v.vrate_fpm") * 0.00508).alias("vel_u"),
    )


#: Columns that :func:`with_fields` adds.
FIELDS = {"cpr_odd": "int", "cpr_y": "int", "cpr_x": "int", "cpr_alt_ft": "double", "vel_e": "double", "vel_n": "double", "vel_u": "double"}


@dataclass
class Buffer:
    """One aircraft's latest even and odd frame and its last decoded position.

    Frames are (time in ns, raw latitude, raw longitude). What a stream keeps of an
    aircraft between its micro-batches: frames come one at a time, in time order.
    """

    even: tuple[int, int, int] | None = None
    odd: tuple[int, int, int] | None = None
    lat: float | None = None
    lon: float | None = None

    def add(self, t_ns: int, odd: int, y: int, x: int) -> tuple[float, float] | None:
        """The frame's position, or None: by its pair, else near the last position."""
        if odd:
            self.odd = (t_ns, y, x)
        else:
            self.even = (t_ns, y, x)
        found = None
        if self.even and self.odd and abs(self.even[0] - self.odd[0]) < PAIR_NS:
            found = pair_position(*self.even[1:], *self.odd[1:], self.even[0] >= self.odd[0])
        if found is None and self.lat is not None:
            found = near_position(odd, y, x, self.lat, self.lon)
        if found is not None:
            self.lat, self.lon = found
        return found


def zones_at(lat: float) -> int:
    """NL of a latitude, as :func:`skyweft.functions.cpr.longitude_zones` has it."""
    if abs(lat) >= 87.0:
        return 1
    inner = 1 - (1 - math.cos(math.pi / (2 * cpr.ZONES))) / math.cos(math.radians(abs(lat))) ** 2
    return max(1, math.floor(2 * math.pi / math.acos(max(-1.0, min(1.0, inner)))))


def pair_position(ye: int, xe: int, yo: int, xo: int, even_is_newer: bool) -> tuple[float, float] | None:
    """Latitude and longitude of an even and an odd frame; None if they straddle zones."""
    ye, xe, yo, xo = (v / cpr.SCALE for v in (ye, xe, yo, xo))
    j = math.floor(59 * ye - 60 * yo + 0.5)
    lats = [(j % 60 + ye) * 6.0, (j % 59 + yo) * (360.0 / 59)]
    even, odd = (v - 360.0 if v >= 270.0 else v for v in lats)
    lat, zones = (even if even_is_newer else odd), zones_at(even)
    if zones != zones_at(odd) or not -90 <= lat <= 90:
        return None
    width = max(zones if even_is_newer else zones - 1, 1)
    lon = (math.floor(xe * (zones - 1) - xo * zones + 0.5) % width + (xe if even_is_newer else xo)) * (360.0 / width)
    return lat, lon - 360.0 if lon >= 180.0 else lon


def near_position(odd: int, y: int, x: int, near_lat: float, near_lon: float) -> tuple[float, float] | None:
    """Latitude and longitude of one frame near a place; None if that is too far off."""

    def nearest(at: float, width: float, part: float) -> float:
        return (math.floor(at / width) + math.floor(at % width / width - part + 0.5) + part) * width

    lat = nearest(near_lat, 360.0 / 59 if odd else 6.0, y / cpr.SCALE)
    lon = nearest(near_lon, 360.0 / max(zones_at(lat) - odd, 1), x / cpr.SCALE)
    far = abs(lat - near_lat) > cpr.LOCAL_GUARD or abs(lon - near_lon) > cpr.LOCAL_GUARD
    return None if far else (lat, lon)
