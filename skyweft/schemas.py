"""Spark schemas of the pipeline's records."""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {"BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(), "BOOLEAN": T.BooleanType()}


def struct(text: str, **more: T.DataType) -> T.StructType:
    """A schema of "name TYPE, ..." and further fields; needs no session."""
    fields = [T.StructField(n, _KINDS[k]) for n, k in (f.split() for f in text.split(","))]
    return T.StructType([*fields, *[T.StructField(n, k) for n, k in more.items()]])


_RECEPTION = "sensor_id BIGINT, lat DOUBLE, lon DOUBLE, alt DOUBLE, timestamp_s BIGINT, timestamp_ns BIGINT"
_FIX = (
    "icao STRING, lat DOUBLE, lon DOUBLE, alt_ft DOUBLE, residual_m DOUBLE, quality_residual_m DOUBLE, gdop DOUBLE, num_sensors INT, "
    "solve_method STRING, timestamp_s BIGINT, timestamp_ns BIGINT, df_type INT, squawk STRING, raw_msg STRING, t0_s DOUBLE"
)
_MOTION = "heading_deg DOUBLE, speed_kts DOUBLE, vrate_fpm DOUBLE, track_quality INT, positions_count INT"

PACKET = struct(_RECEPTION + ", raw_msg STRING")
DECODED = struct(_RECEPTION + ", raw_msg STRING, icao STRING, df_type INT, altitude_ft INT, squawk STRING")
RECEPTION = struct(_RECEPTION)
GROUP = struct("icao STRING, df_type INT, altitude_ft DOUBLE, squawk STRING, raw_msg STRING, num_sensors INT", receptions=T.ArrayType(RECEPTION))
FIX = struct(_FIX)
TRACK = struct(f"{_FIX}, {_MOTION}", cov_matrix=T.ArrayType(T.ArrayType(T.DoubleType())))
OVERRIDE = struct("public_key STRING, lat DOUBLE, lon DOUBLE, alt DOUBLE, name STRING")
LAYER4_RECORD = T.StructType([*FIX.fields, T.StructField("unsolved_group", GROUP)])

#: Fields without which a record is malformed.
REQUIRED_GROUP = ("icao", "df_type", "raw_msg", "num_sensors", "receptions")
REQUIRED_FIX = ("icao", "lat", "lon", "alt_ft", "residual_m", "quality_residual_m", "gdop", "num_sensors", "solve_method", "timestamp_s", "timestamp_ns", "df_type", "raw_msg", "t0_s")
