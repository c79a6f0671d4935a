"""What the map is served: latest states with trails, and the GDOP grid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweft.functions import geo
from skyweft.functions.scalar import FEET, altitude_band, round_to
from skyweft.operators import solver_np as S
from skyweft.operators.solve import numbers
from skyweft.operators.windows import latest_with_trail

STALE_NS = 300_000_000_000
#: Extent, cells a side and altitude of the served grid (fixed values).
GRID = {"lat": (49.8, 50.8), "lon": (-6.5, -4.5), "cells": 20, "alt_ft": 30_000.0}
#: Products of a sensor's unit vector (x, y, z) and a one (n).
SUMS = ("xx", "xy", "xz", "yy", "yz", "zz", "xn", "yn", "zn", "nn")


def snapshot(tracks: DataFrame, now_ns=None) -> DataFrame:
    """One row an aircraft: its latest track row, trail, colour band and ellipse."""
    t = tracks.withColumn("t_ns", F.col("timestamp_s") * F.lit(1_000_000_000).cast("long") + F.col("timestamp_ns"))
    if now_ns is not None:
        t = t.where(F.lit(now_ns) - F.col("t_ns") <= STALE_NS)
    rows = latest_with_trail(t, "icao", ["t_ns", "raw_msg"], F.array("lon", "lat"))
    c = F.col("cov_matrix")
    entry = lambda i, j: F.get(F.get(c, i), j)
    return rows.withColumn("band", altitude_band("alt_ft")).withColumn("ellipse", geo.covariance_ellipse("lat", "lon", entry(0, 0), entry(0, 1), entry(1, 1)))


def summary(tracks: DataFrame) -> DataFrame:
    """Rounded latest rows with the last 20 positions."""
    t = tracks.withColumn("t_ns", F.col("timestamp_s") * F.lit(1_000_000_000).cast("long") + F.col("timestamp_ns"))
    rows = latest_with_trail(t, "icao", ["t_ns", "raw_msg"], F.array(round_to("lat", 6), round_to("lon", 6)), 20)
    return rows.select("icao", *[round_to(c, d).alias(c) for c, d in (("lat", 6), ("lon", 6), ("alt_ft", 0), ("heading_deg", 1), ("speed_kts", 1), ("vrate_fpm", 0))], "track_quality", F.col("trail").alias("positions"))


def grid(spark: SparkSession, spec: dict = GRID) -> DataFrame:
    """lat and lon of the grid's cells, bounds included."""
    n = spec["cells"]
    step = lambda i, k: F.lit(spec[k][0]) + F.col(i) * ((spec[k][1] - spec[k][0]) / (n - 1))
    i, j = F.floor(F.col("id") / n).alias("i"), (F.col("id") % n).alias("j")
    return spark.range(n * n).select(i, j).select(step("i", "lat").alias("lat"), step("j", "lon").alias("lon"))


def direction_sums(cells: DataFrame, sensors: DataFrame, alt_ft: float = GRID["alt_ft"]) -> DataFrame:
    """What the dilution of all sensors in each cell follows from: lat, lon, ``known`` (whether
    every sensor's place is), ``nearest`` (metres) and the sums SUMS over the sensors.

    The cells are broadcast, a grid of fixed size; the sensors, however many, are dealt out and
    added up where they are, so that no row holds them.
    """
    at = cells.select(F.monotonically_increasing_id().alias("cell"), "lat", "lon", geo.lla_to_ecef("lat", "lon", F.lit(alt_ft * FEET)).alias("x"))
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = sensors.select(geo.lla_to_ecef("lat", "lon", "alt").alias("s")).repartition(parts)
    d = places.join(F.broadcast(at)).select("cell", "lat", "lon", geo.minus(F.col("x"), F.col("s")).alias("d"))
    d = d.select("cell", "lat", "lon", "d", geo.norm(F.col("d")).alias("r"))
    safe = F.greatest("r", F.lit(1e-9))
    u = d.select("cell", "lat", "lon", "r", *[(F.col(f"d.{k}") / safe).alias(k) for k in "xyz"], F.lit(1.0).alias("n"))
    sums = u.groupBy("cell", "lat", "lon").agg((F.count("r") == F.count("*")).alias("known"), F.min("r").alias("nearest"), *[F.sum(F.col(k[0]) * F.col(k[1])).alias(k) for k in SUMS])
    return sums.drop("cell")


def gdop_of_sums(sums: DataFrame, dilution) -> DataFrame:
    """lat, lon and gdop of :func:`direction_sums`; ``dilution`` has it of lat, lon, matrices and
    distances of the nearest sensor."""

    def run(batches):
        for b in batches:
            v = {k: numbers(b.column(k)) for k in ("lat", "lon", "nearest", *SUMS)}
            m = np.stack([np.stack([v[i + j if i + j in v else j + i] for j in "xyzn"], axis=1) for i in "xyzn"], axis=1)
            m[~b.column("known").to_numpy(zero_copy_only=False).astype(bool)] = np.nan
            yield pa.RecordBatch.from_arrays([b.column("lat"), b.column("lon"), pa.array(dilution(v["lat"], v["lon"], m, v["nearest"]))], names=["lat", "lon", "gdop"])

    return sums.mapInArrow(run, "lat double, lon double, gdop double")


def gdop_grid(cells: DataFrame, sensors: DataFrame, alt_ft: float = GRID["alt_ft"]) -> DataFrame:
    """lat, lon (4 places) and 3D gdop (2 places; null if infinite) of each cell."""
    raw = gdop_of_sums(direction_sums(cells, sensors, alt_ft), lambda lat, lon, m, nearest: S.gdop_3d_of_sums(m, nearest))
    return raw.select(round_to("lat", 4).alias("lat"), round_to("lon", 4).alias("lon"), round_to("gdop", 2).alias("gdop"))
