"""A stream's groups and tracks are the batch's, but for windows still open at its end."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.operators import correlate, solve, track
from skyweft.plans import synthetic
from skyweft.schemas import DECODED, FIX, GROUP, TRACK, struct
from skyweft.streaming import serve
from skyweft.streaming.serve import LatestState, aircraft
from skyweft.streaming.state import correlate_stream, solve_stream, track_stream


def run(stream, name, tmp_path, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return stream.sparkSession.table(name)


def test_correlation(spark, tmp_path):
    rows = [(s, 50.0, -5.0, 10.0, t + 1, 1000 * s, f"{t:014X}", "ABCDEF", 17, 30000, None) for t in range(20) for s in range(3)]
    spark.createDataFrame(rows, DECODED).coalesce(1).write.json(str(tmp_path / "in"))
    batch = {r["raw_msg"] for r in correlate.correlate(spark.createDataFrame(rows, DECODED)).collect()}
    spark.createDataFrame([(9, 50.0, -5.0, 10.0, 100, 0, "F" * 14, "ABCDEF", 17, 30000, None)], DECODED).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(DECODED).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    got = run(correlate_stream(stream), "groups", tmp_path)
    assert {r["raw_msg"] for r in got.collect()} == batch and {r["num_sensors"] for r in got.collect()} == {3}


def test_tracks_and_latest_state(spark, tmp_path):
    records = solve.solve_groups(synthetic.flights(spark, "/root/testdata/sf0.001")).select("t_ns", "icao", "fix", "unsolved_group").where("icao < '0008'")
    records.coalesce(1).write.parquet(str(tmp_path / "r"))
    rows = spark.read.parquet(str(tmp_path / "r"))
    batch = {(r["icao"], r["raw_msg"]): r["track_quality"] for r in track.tracks(rows).collect()}
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "r"))
    got = run(track_stream(stream, delay=None), "tracks", tmp_path)
    assert {(r["icao"], r["raw_msg"]): r["track_quality"] for r in got.collect()} == batch
    state = LatestState(spark, str(tmp_path / "latest"))
    state.upsert(got.where(F.col("track_quality") <= 1), 0)
    state.upsert(got.where(F.col("track_quality") > 1), 1)
    out = aircraft(state)
    assert out["count"] == len({k[0] for k in batch})


def test_solving(spark, tmp_path):
    flights = synthetic.flights(spark, "/root/testdata/sf0.001").where("icao < '0006'").drop("true_lat", "true_lon", "ecef")
    flights.repartitionByRange(2, "t_ns").sortWithinPartitions("t_ns").write.parquet(str(tmp_path / "g"))
    rows = spark.read.parquet(str(tmp_path / "g"))
    batch = {(r["icao"], r["t_ns"], r["kind"], r["fix"] and round(r["fix"]["lat"], 9)) for r in solve.solve_groups(rows).collect()}
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "g"))
    got = run(solve_stream(stream, delay=None), "solved", tmp_path)
    assert {(r["icao"], r["t_ns"], r["kind"], r["fix"] and round(r["fix"]["lat"], 9)) for r in got.collect()} == batch


def fix(icao, t, lat=50.0):
    f = (icao, lat, -5.0, 30000.0, 10.0, 10.0, 2.0, 4, "frisch_toa", t, 0, 20, None, f"{icao}{t:08d}", 0.0)
    return (t * 10**9, icao, f, None)


def test_tracks_expire_and_late_rows_go(spark, tmp_path):
    """A track ends with the watermark 300 s past it; rows behind the watermark are dropped."""
    schema = T.StructType([*struct("t_ns BIGINT, icao STRING").fields, T.StructField("fix", FIX), T.StructField("unsolved_group", GROUP)])
    batches = [[fix("A", 100), fix("A", 102), fix("B", 101)], [fix("B", 600)], [fix("B", 601)], [fix("A", 104), fix("A", 700), fix("B", 602)]]  # A at 104 is late by then
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        for f in sorted((tmp_path / "in").glob("part-*")):
            f.rename(tmp_path / "in" / f"{i}.json")
            os.utime(tmp_path / "in" / f"{i}.json", (i + 1, i + 1))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    got = run(track_stream(stream), "expiring", tmp_path)
    rows = {(r["icao"], r["timestamp_s"]): r["track_quality"] for r in got.collect()}
    assert rows == {("A", 100): 1, ("A", 102): 2, ("B", 101): 1, ("B", 600): 1, ("B", 601): 2, ("A", 700): 1, ("B", 602): 3}


def test_latest_state_goes_on_after_a_restart(spark, tmp_path):
    row = lambda icao, t: (*fix(icao, t)[2], 1.0, 1.0, 1.0, 1, 1, [[1.0]])
    first = LatestState(spark, str(tmp_path))
    first.upsert(spark.createDataFrame([row("A", 1), row("B", 1)], TRACK), 0)
    first.upsert(spark.createDataFrame([row("A", 2)], TRACK), 1)
    second = LatestState(spark, str(tmp_path))
    assert aircraft(second)["count"] == 2
    for _ in range(2):  # a batch that is run again gives the same version
        second.upsert(spark.createDataFrame([row("A", 2), row("C", 3)], TRACK), 1)
    got = {r["icao"]: (r["timestamp_s"], r["trail"]) for r in second.current().collect()}
    assert {k: v[0] for k, v in got.items()} == {"A": 2, "B": 1, "C": 3} and len(got["A"][1]) == 2
    for i in range(2, 7):
        second.upsert(spark.createDataFrame([row("D", i)], TRACK), i)
    assert sorted(p.name for p in tmp_path.glob("v*")) == ["v5", "v6"]
    assert {r["icao"] for r in second.current(least_ns=2 * 10**9).collect()} == {"A", "C", "D"}


def test_statistics_of_a_stream(spark, tmp_path):
    import time

    from skyweft.plans.pipeline import observed

    spark.range(10).selectExpr("id", "id % 2 = 0 AS even").repartition(2).write.parquet(f"{tmp_path}/in")
    said = []
    listener = serve.Statistics(lambda name, totals: said.append((name, totals)))
    spark.streams.addListener(listener)
    try:
        src = spark.readStream.schema("id long, even boolean").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        q = observed(src, "input", even=F.col("even")).writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        q.awaitTermination()
        until = time.time() + 20
        while not said and time.time() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert said == [("input", {"rows": 10, "even": 5})]


def test_connections(spark):
    rows = [("a", 1, True, 1), ("a", 5, False, 2), ("b", 2, False, 3), ("b", 2, True, 4), ("c", 3, True, 5), ("c", 4, None, 6)]
    events = spark.createDataFrame(rows, "peer string, t long, connected boolean, n long")
    assert [(r["peer"], r["n"]) for r in serve.connections(events, "peer", "t", ["n"]).collect()] == [("b", 4)]
    assert serve.connections(events.limit(0), "peer", "t", ["n"]).count() == 0
