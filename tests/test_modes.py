"""Message decoding against published examples and plain bit arithmetic."""

import random

import pytest
from pyspark.sql import functions as F

from skyweft.functions import cpr, modes


def rows(spark, msgs, **cols):
    df = spark.createDataFrame([(m,) for m in msgs], "m string")
    return [r.asDict() for r in df.select("m", *[c.alias(n) for n, c in cols.items()]).collect()]


def long_division(msg: str) -> int:
    n = 4 * len(msg)
    v = int(msg, 16)
    for i in range(n - 24):
        if v >> (n - 1 - i) & 1:
            v ^= modes.GENERATOR << (n - 25 - i)
    return v


def test_parity_is_long_division(spark):
    rng = random.Random(3)
    msgs = ["%0*X" % (n, rng.getrandbits(4 * n)) for n in (14, 28) for _ in range(40)]
    for r in rows(spark, msgs, p=modes.parity("m")):
        assert r["p"] == long_division(r["m"])


def test_known_messages(spark):
    got = {
        r["m"]: r
        for r in rows(
            spark,
            ["8D4840D6202CC371C32CE0576098", "8D40621D58C382D690C8AC2863A7", "8D485020994409940838175B284F", "A02014B400000000000000F9D514"],
            df=modes.downlink_format("m"), icao=modes.icao("m"), alt=modes.altitude_ft("m"), tc=modes.type_code("m"), v=modes.velocity_fields("m"), p=modes.position_fields("m"),
        )
    }
    assert got["8D4840D6202CC371C32CE0576098"]["icao"] == "4840D6"
    pos = got["8D40621D58C382D690C8AC2863A7"]
    assert (pos["icao"], pos["alt"], pos["tc"]) == ("40621D", 38000, 11)
    assert (pos["p"]["odd"], pos["p"]["lat_cpr"], pos["p"]["lon_cpr"], pos["p"]["alt_ft"]) == (0, 93000, 51372, 38000)
    v = got["8D485020994409940838175B284F"]["v"]
    assert round(v["speed_kts"]) == 159 and abs(v["heading_deg"] - 182.88) < 0.01 and v["vrate_fpm"] == -832
    assert got["A02014B400000000000000F9D514"]["alt"] == 32300


def test_cpr_global_and_local(spark):
    df = spark.range(1).select(
        cpr.global_position(F.lit(93000), F.lit(51372), F.lit(74158), F.lit(50194), F.lit(True)).alias("g"),
        cpr.local_position(F.lit(0), F.lit(93000), F.lit(51372), F.lit(52.258), F.lit(3.918)).alias("l"),
        cpr.local_position(F.lit(0), F.lit(93000), F.lit(51372), F.lit(20.0), F.lit(3.918)).alias("far"),
        cpr.longitude_zones(F.lit(0.0)).alias("nl0"), cpr.longitude_zones(F.lit(87.5)).alias("nl87"), cpr.longitude_zones(F.lit(52.2572)).alias("nl52"),
    )
    r = df.first()
    for p in (r["g"], r["l"]):
        assert p["lat"] == pytest.approx(52.2572021484375, abs=1e-9)
        assert p["lon"] == pytest.approx(3.91937255859375, abs=1e-9)
    assert (r["nl0"], r["nl87"], r["nl52"]) == (59, 1, 36)


def test_squawk_and_bad_messages(spark):
    got = rows(spark, ["2A00516D492B80", "zz", "8d4840d6202cc371c32ce0576098 ", "", "ABC"], n=modes.normalised("m"), s=modes.squawk("m"))
    assert got[0]["s"] == "0356"
    assert [r["n"] is None for r in got] == [False, True, False, True, True]


def test_gillham_is_a_bijection_of_valid_codes(spark):
    df = spark.range(8192).select(F.col("id").cast("int").alias("c"))
    got = df.where("c & 80 = 0").select(modes.gillham_altitude("c").alias("a")).where("a is not null and a >= -1200")
    r = got.agg(F.count("*").alias("n"), F.countDistinct("a").alias("d"), F.min("a").alias("lo"), F.max("a").alias("hi")).first()
    assert r["n"] == r["d"] and r["lo"] == -1200 and r["hi"] >= 62700
