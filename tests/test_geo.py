import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweft.functions import geo, scalar
from skyweft.operators import solver_np as S


def test_round_trip(spark):
    pts = [(0.0, 0.0, 0.0), (89.9, 10.0, 5000.0), (-45.3, 179.9, -100.0), (50.1, -5.5, 12000.0)]
    df = spark.createDataFrame(pts, "lat double, lon double, alt double").withColumn("p", geo.lla_to_ecef("lat", "lon", "alt"))
    for r in df.withColumn("q", geo.ecef_to_lla("p.x", "p.y", "p.z")).collect():
        assert r["q"]["lat"] == pytest.approx(r["lat"], abs=1e-9) and r["q"]["lon"] == pytest.approx(r["lon"], abs=1e-9) and r["q"]["alt"] == pytest.approx(r["alt"], abs=1e-5)
        x = S.lla_to_ecef(r["lat"], r["lon"], r["alt"])
        assert np.allclose(x, [r["p"]["x"], r["p"]["y"], r["p"]["z"]], atol=1e-6)


def test_velocity_there_and_back(spark):
    v = geo.enu_to_ecef_velocity(F.lit(50.0), F.lit(-5.0), F.lit(100.0), F.lit(-40.0), F.lit(3.0))
    r = spark.range(1).select(v.alias("v")).select(geo.ecef_to_enu_velocity(F.lit(50.0), F.lit(-5.0), "v.x", "v.y", "v.z").alias("e"), geo.motion(F.lit(50.0), F.lit(-5.0), "v.x", "v.y", "v.z").alias("m")).first()
    assert (r["e"]["e"], r["e"]["n"], r["e"]["u"]) == pytest.approx((100.0, -40.0, 3.0))
    assert r["m"]["heading_deg"] == pytest.approx(math.degrees(math.atan2(100, -40)))


def test_rounding_and_clamps(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(scalar.round_to("x", 0)).collect()] == [3.0, -3.0, None, None, None]
    r = spark.range(1).select(scalar.positive_mod(F.lit(-7.0), F.lit(3.0)), scalar.clamp(F.lit(9.0), F.lit(1.0), F.lit(5.0))).first()
    assert tuple(r) == (2.0, 5.0)


def test_ellipse(spark):
    r = spark.range(1).select(geo.covariance_ellipse(F.lit(0.0), F.lit(0.0), F.lit(100.0), F.lit(0.0), F.lit(25.0)).alias("e"), geo.covariance_ellipse(F.lit(0.0), F.lit(0.0), F.lit(2e5), F.lit(0.0), F.lit(25.0)).alias("n")).first()
    assert len(r["e"]) == 32 and r["n"] is None
    assert r["e"][0][0] == pytest.approx(30.3 * 360 / 40075000) and r["e"][0][1] == pytest.approx(0.0)
