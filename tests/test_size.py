"""Operators on tables whose every step must grow no faster than the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweft.functions import geo
from skyweft.operators import joins, snapshot, windows
from skyweft.operators import solver_np as S
from skyweft.plans import registry, synthetic


def sensors_of(spark, n):
    i = F.col("id")
    return spark.range(n).select((i * 37 % 1009 / 250.0 + 49.0).alias("lat"), (i * 53 % 997 / 200.0 - 8.0).alias("lon"), (i % 50 * 20.0).alias("alt"))


def test_dilution_of_more_sensors_than_a_row_holds(spark):
    sensors = sensors_of(spark, 120_000)
    cells = snapshot.grid(spark, snapshot.GRID | {"cells": 2})
    p = sensors.toPandas().to_numpy()
    s = S.lla_to_ecef(p[:, 0], p[:, 1], p[:, 2])[None]
    at = lambda lat, lon: S.lla_to_ecef(np.array([lat]), np.array([lon]), np.array([snapshot.GRID["alt_ft"] * 0.3048]))
    rows = snapshot.gdop_grid(cells, sensors).collect()
    assert len(rows) == 4
    assert all(r["gdop"] == round(float(S.gdop_3d(at(r["lat"], r["lon"]), s)[0]), 2) for r in rows)
    flat = snapshot.gdop_of_sums(snapshot.direction_sums(cells, sensors), lambda lat, lon, m, near: S.gdop_2d_of_sums(S.lla_to_ecef(lat, lon, snapshot.GRID["alt_ft"] * 0.3048), m, near)).collect()
    assert [r["gdop"] for r in flat] == pytest.approx([float(S.gdop_2d(at(r["lat"], r["lon"]), s)[0]) for r in flat], rel=1e-9)


def test_dilution_of_odd_sensors(spark):
    cells = spark.createDataFrame([(50.0, -5.0), (50.0, -5.0), (51.0, -4.0)], "lat double, lon double")
    few = [(49.5, -5.5, 10.0), (50.5, -4.0, 20.0), (49.0, -3.0, 500.0), (51.0, -6.0, 90.0)]
    grid = lambda rows: sorted((r["lat"], r["gdop"]) for r in snapshot.gdop_grid(cells, spark.createDataFrame(rows, "lat double, lon double, alt double")).collect())
    whole = grid(few)
    assert [r[0] for r in whole] == [50.0, 50.0, 51.0] and whole[0] == whole[1] and all(r[1] > 0 for r in whole)
    none = [(50.0, None), (50.0, None), (51.0, None)]
    for rows in (few[:2], [*few, (None, -5.0, 10.0)], [*few, (float("nan"), -5.0, 10.0)]):
        assert sorted((r["lat"], r["gdop"]) for r in snapshot.gdop_grid(cells, spark.createDataFrame(rows, "lat double, lon double, alt double")).collect()) == none


def test_no_two_aircraft_have_one_address(spark, tmp_path):
    users, legs = [0, 1, 0x1000, 0xFFFF, 0x10000, 0x10001, 0x100000, 0x1000000], [0, 1, 16, 255, 256, 257, 4096]
    rows = spark.createDataFrame([(u, g) for u in users for g in legs], "u long, g long").select(synthetic.address(F.col("u"), F.col("g")).alias("a")).collect()
    assert len({r["a"] for r in rows}) == len(users) * len(legs)
    # 17 users whose numbers begin alike are flights of their own
    i = F.col("id")
    spark.range(17 * 6).select(i.alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"), F.when(i % 17 == 16, 0x1000).otherwise(i % 17 + 0x10000).alias("user_id")).write.parquet(f"{tmp_path}/events.parquet")
    flights = synthetic.flights(spark, str(tmp_path), 2)
    assert flights.select("icao").distinct().count() == 17
    assert flights.groupBy("icao", "t_ns").count().where("count > 1").count() == 0


def made_by(df, ending):
    """Rows that each such node of a collected frame's plan made."""
    out = []

    def walk(p):
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(p.executedPlan())
        if "QueryStage" in name:
            return walk(p.plan())
        if name.endswith(ending):
            out.append(p.metrics().apply("numOutputRows").value())
        for k in range(p.children().size()):
            walk(p.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_nearest_of_many_rows_of_one_place(spark):
    """2,000 keys of 40 places and as many dimension rows of 20: places meet, not rows."""
    i = F.col("id")
    places = spark.range(2000).select(i.alias("key"), (i % 40 * 0.03).alias("lat"), F.lit(0.0).alias("lon"))
    dim = spark.range(2000).select((2000 - i).alias("no"), (i % 20 * 0.061).alias("lat"), F.lit(0.1).alias("lon"))
    near = joins.nearest_place(places, "key", dim, "no")
    got = {r["key"]: (r["no"], r["distance"]) for r in near.collect()}
    spots = [(k * 0.061, 2000 - max(range(k, 2000, 20))) for k in range(20)]
    best = [min((((k * 0.03 - lat) ** 2 + 0.01) ** 0.5, no) for lat, no in spots) for k in range(40)]
    assert {k: n for k, (n, _) in got.items()} == {k: best[k % 40][1] for k in range(2000)}
    assert [got[k][1] for k in range(40)] == pytest.approx([b[0] for b in best])
    made = made_by(near, "Join")
    assert len(made) == 2 and max(made) <= 2000


@pytest.mark.parametrize("ranked", [1, 20])
@pytest.mark.parametrize("of", ["id", "id * 7919 % 1000", "id % 3", "0", "if(id % 10 < 9, 5, id)", "if(id % 2 = 0, 1, 9)", "if(id % 10 < 9, null, id)", "1700000000000000000 + id % 100"])
def test_evicted_half_whatever_ties(spark, monkeypatch, of, ranked):
    monkeypatch.setattr(windows, "RANKED_ROWS", ranked)
    df = spark.range(1001).selectExpr("id", f"cast({of} as bigint) as t")
    rows = sorted(((r["t"] is not None, r["t"] or 0, r["id"]) for r in df.collect()), reverse=True)
    got = windows.evicted(df, ["t", "id"], 100)
    assert sorted(r["id"] for r in got.collect()) == sorted(i for _, _, i in rows[:501])


def test_evicted_ranks_few_rows_of_one_time(spark, monkeypatch):
    """Where all rows have one time the next column narrows them, so that the window ranks a few."""
    monkeypatch.setattr(windows, "RANKED_ROWS", 100)
    got = windows.evicted(spark.range(5000).selectExpr("id", "7L as t"), ["t", "id"], 100)
    assert sorted(r["id"] for r in got.collect()) == list(range(2500, 5000))
    # the filters that read the table: what is newer as a whole, and what is ranked
    assert sorted(made_by(got, "Filter"))[0] <= 100


def test_ellipse_works_out_once_what_its_points_share(spark):
    """The angle and the axes are no part of the expression that each point repeats."""
    e = spark.range(3).select(F.col("id"), geo.covariance_ellipse(F.lit(50.0) + F.col("id"), F.lit(-5.0), F.lit(100.0) + F.col("id"), F.lit(20.0) * F.col("id"), F.lit(250.0)).alias("e"))
    plan = e._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ATAN2") <= 2
    for r in e.collect():
        i = r["id"]
        axes, turn = np.linalg.eigvalsh([[100.0 + i, 20.0 * i], [20.0 * i, 250.0]]), np.arctan2(40.0 * i, 100.0 + i - 250.0) / 2
        a, b = geo.ELLIPSE_SCALE * np.sqrt(axes[::-1])
        t = np.arange(geo.ELLIPSE_POINTS) * 2 * np.pi / geo.ELLIPSE_POINTS
        x, y = a * np.cos(t) * np.cos(turn) - b * np.sin(t) * np.sin(turn), a * np.cos(t) * np.sin(turn) + b * np.sin(t) * np.cos(turn)
        want = np.stack([-5.0 + x / (geo.EQUATOR_M / 360 * np.cos(np.radians(50.0 + i))), 50.0 + i + y / geo.DEGREE_M], 1)
        assert np.allclose(r["e"], want, rtol=0, atol=1e-9)


def test_truth_of_the_solver_solves_once(spark):
    plan = registry.queries()["solver_truth"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
