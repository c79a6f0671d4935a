"""The live pipeline: packets in several files, through one query, as the batch has them."""

import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweft.operators import cprframes, solve, track
from skyweft.operators import solver_np as S
from skyweft.plans import live, pipeline, synthetic
from skyweft.schemas import PACKET
from skyweft.sources import packets
from skyweft.streaming import state


def position_message(icao, lat, lon, odd, alt_ft=30000):
    zones = 59 if odd else 60
    dlat = 360 / zones
    yz = int(np.floor(131072 * (lat % dlat) / dlat + 0.5))
    rlat = dlat * (yz / 131072 + np.floor(lat / dlat))
    dlon = 360 / max(cprframes.zones_at(rlat) - odd, 1)
    xz = int(np.floor(131072 * (lon % dlon) / dlon + 0.5))
    n = (alt_ft + 1000) // 25
    me = 11 << 51 | ((n >> 4) << 5 | 0x10 | (n & 0xF)) << 36 | odd << 34 | (yz % 131072) << 17 | xz % 131072
    return f"8D{icao:06X}{me:014X}000000"


def air(n_aircraft=3, steps=30, sensors=5):
    """Packets of aircraft that tell their position, with gaps over 10 s, seen by clocks that are off."""
    rows = []
    for a in range(n_aircraft):
        for k in range(steps):
            t = 2.0 * k + 0.1 * a + (14.0 if k > 12 else 0.0) + (70.0 if k > 20 else 0.0)
            lat, lon = 50.2 + 0.05 * a + k * 1e-4, -5.6 + k * 2e-4
            x = S.lla_to_ecef(lat, lon, 30000 * 0.3048)
            heard = 2 if k % 7 == 6 else sensors
            for i, la, lo, h in synthetic.SENSORS[:heard]:
                v = S.speeds(np.array([[h]]), np.array([30000 * 0.3048]))[0, 0]
                ns = round(np.linalg.norm(x - S.lla_to_ecef(la, lo, h)) / v * 1e9 + t * 1e9) + 3000 * i
                odd = 1 if k % 5 == 4 else k % 2 if k < 13 or k > 16 else 0
                rows.append((i, la, lo, h, ns // 10**9, ns % 10**9, position_message(0xABC000 + a, lat, lon, odd)))
    return rows


def frames(rows):
    out = []
    for s, lat, lon, alt, sec, ns, m in rows:
        p = packets.HEAD.pack(s, lat, lon, alt, sec, ns) + bytes.fromhex(m)
        out.append(bytes([len(p)]) + p)
    return b"".join(out)


@pytest.fixture(autouse=True)
def one_partition(spark):
    """State stores and workers of one partition for each operator: enough for these rows."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", was)


def drain(df, name, tmp_path):
    q = df.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-c")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    if q.exception():
        raise q.exception()
    return q


def test_live_is_the_batch(spark, tmp_path):
    """A query that is started twice; the closing packet lets the last windows out."""
    spark.dataSource.register(packets.PacketSource)
    rows = air()
    rows.sort(key=lambda r: (r[4], r[5]))
    (tmp_path / "in").mkdir()
    third, last = len(rows) // 3, rows[-1][4] * 10**9 + rows[-1][5]
    for files in ([("9", frames(rows[:third][::-1]))], [("5", frames(rows[third : 2 * third])), ("7", frames(rows[2 * third :][::-1])), ("1-end", packets.closing_packet(last + 5 * 10**9))]):
        for name, data in files:
            (tmp_path / "in" / name).write_bytes(data)
        stream = spark.readStream.format("packets").option("path", str(tmp_path / "in")).option("range_bytes", 5000).load()
        drain(live.live(stream), "out", tmp_path)
    got = spark.read.schema(state.LIVE).parquet(str(tmp_path / "out")).collect()

    layers = pipeline.build(spark.createDataFrame(rows, PACKET), write=True)
    records = layers.records.collect()
    place = lambda f: f and (f["raw_msg"], f["solve_method"], round(f["lat"], 7), round(f["lon"], 7), round(f["residual_m"], 3))
    key = lambda r: (r["icao"], r["t_ns"], r["kind"] or "", r["reason"] or "", place(r["fix"]) or ())
    assert sorted(map(key, got)) == sorted(map(key, records)) and len(records) == 90
    assert {r["kind"] for r in records} >= {"fix"}
    moved = lambda r: (r["icao"], r["raw_msg"], r["track_quality"], round(r["lat"], 6), round(r["speed_kts"], 2), round(r["cov_matrix"][0][0], 2))
    tracks = [r["track"] for r in got if r["track"]]
    assert sorted(map(moved, tracks)) == sorted(map(moved, layers.tracks.collect())) and len(tracks) >= 10


def test_frames_of_a_stream_decode_as_columns_do(spark):
    """Buffer against the column expressions: pairs, gaps over 10 s with local decodes, zone changes."""
    rng = np.random.default_rng(3)
    rows = []
    for a in range(12):
        lat, lon, t = rng.uniform(-85, 85), rng.uniform(-180, 180), 0
        for k in range(40):
            t += int(rng.integers(1, 15) * 10**9)
            lat, lon = lat + rng.normal() * 0.01, lon + rng.normal() * 0.01
            rows.append((f"A{a}", 17, None, None, position_message(a + 1, lat, lon, int(rng.integers(0, 2))), t))
    df = spark.createDataFrame(rows, "icao string, df_type int, altitude_ft double, squawk string, raw_msg string, t_ns long")
    want = {(r["icao"], r["t_ns"]): (r["cpr_lat"], r["cpr_lon"]) for r in cprframes.decoded_positions(df).collect()}
    buffers: dict = {}
    for r in sorted(cprframes.with_fields(df).collect(), key=lambda r: (r["icao"], r["t_ns"])):
        got = buffers.setdefault(r["icao"], cprframes.Buffer()).add(r["t_ns"], r["cpr_odd"], r["cpr_y"], r["cpr_x"])
        w = want[r["icao"], r["t_ns"]]
        assert (got is None) == (w[0] is None)
        if got:
            assert got == pytest.approx(w, abs=1e-9)
    assert sum(v[0] is not None for v in want.values()) > 350 and len(buffers) == 12


def test_solving_and_tracking_in_a_chain(spark, tmp_path):
    """track_stream takes on solve_stream's rows under one watermark, over several micro-batches."""
    flights = synthetic.flights(spark, "/root/testdata/sf0.001").where("icao < '0004'").drop("true_lat", "true_lon", "ecef")
    flights = flights.withColumn("t_ns", F.col("t_ns") + 10**9)  # what is not after the first watermark, 0, is late
    flights.repartitionByRange(3, "t_ns").sortWithinPartitions("t_ns").write.parquet(str(tmp_path / "g"))
    for i, f in enumerate(sorted((tmp_path / "g").glob("part-*"))):
        os.utime(f, (i + 1, i + 1))
    rows = spark.read.parquet(str(tmp_path / "g"))
    key = lambda r: (r["icao"], r["raw_msg"], r["track_quality"], round(r["lat"], 7))
    want = sorted(key(r) for r in track.tracks(solve.solve_groups(rows)).collect())
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "g"))
    drain(state.track_stream(state.solve_stream(stream)), "chain", tmp_path)
    assert sorted(key(r) for r in spark.read.parquet(str(tmp_path / "chain")).collect()) == want and want


def put(folder, name, *sensors, at=None):
    (folder / name).write_bytes(frames([(s, 50.0, -5.0, 1.0, 2, 3, "00" * 7) for s in sensors]))
    if at is not None:
        os.utime(folder / name, (at, at))


def test_packet_files_are_read_once(spark, tmp_path):
    """Older times, equal times, names that sort before, hidden files that are renamed, restarts."""
    spark.dataSource.register(packets.PacketSource)
    folder = tmp_path / "in"
    folder.mkdir()
    read = lambda: sorted(r["sensor_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    stream = lambda **o: spark.readStream.format("packets").options(path=str(folder), **o).load()
    put(folder, "m", 1, 2, at=2000)
    drain(stream(), "out", tmp_path)
    put(folder, "a", 3, at=1000)  # older, and its name comes first
    put(folder, "z", 4, at=2000)  # as old
    put(folder, ".hidden", 5)
    drain(stream(), "out", tmp_path)
    assert read() == [1, 2, 3, 4]
    (folder / ".hidden").rename(folder / "b")
    drain(stream(), "out", tmp_path)
    drain(stream(), "out", tmp_path)
    assert read() == [1, 2, 3, 4, 5]
    drain(stream(), "other", tmp_path)  # another query of the same log begins at its start
    assert sorted(r["sensor_id"] for r in spark.read.parquet(str(tmp_path / "other")).collect()) == [1, 2, 3, 4, 5]
    log = packets.FileLog(str(folder / "_packets"))
    log.append([(str(folder / "m"), 1)])
    assert log.last() == 4 and len(log.entry(2)) == 2


@pytest.mark.parametrize("most", [1, 57, 100, 1000, 10**6])
def test_ranges_have_each_frame_once(tmp_path, most):
    """However a file is cut, with frames of length 0, short ones and a last one that is cut off."""
    rng = np.random.default_rng(1)
    rows = [(int(i), 50.0, -5.0, 1.0, int(rng.integers(0, 2**33)), int(rng.integers(0, 10**9)), rng.bytes(int(rng.choice([7, 14]))).hex().upper()) for i in range(200)]
    sound = frames(rows)
    odd = frames(rows[:50]) + b"\x00" * 5 + bytes([9]) + bytes(9) + frames(rows[50:120]) + bytes([200]) + rng.bytes(200) + frames(rows[120:]) + frames(rows[:1])[:20]
    for data in (sound, odd):
        p = tmp_path / f"{len(data)}"
        p.write_bytes(data)
        got = [r for part in packets._ranges(str(p), len(data), most) for b in packets._batches(part) for r in b.to_pylist()]
        want = [packets.unpack(f) for f in packets.frames(data)]
        assert [tuple(r.values())[0::6] for r in got if len(r["raw_msg"]) <= 28] == [(w[0], w[6]) for w in want if w and len(w[6]) <= 28]


def test_large_file_is_many_tasks(spark, tmp_path):
    spark.dataSource.register(packets.PacketSource)
    (tmp_path / "f").write_bytes(frames([(i, 50.0, -5.0, 1.0, i, 3, "0102030405060708090A0B0C0D0E") for i in range(20_000)]))
    df = spark.read.format("packets").option("path", str(tmp_path / "f")).option("range_bytes", 100_000).load()
    assert df.rdd.getNumPartitions() == 13
    assert df.agg(F.count("*"), F.countDistinct("sensor_id"), F.sum("timestamp_s")).first() == (20_000, 20_000, 20_000 * 19_999 // 2)
    assert struct.calcsize(">qdddQQ") == packets.HEAD.size
