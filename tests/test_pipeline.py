"""Correlation, solving, tracks and streams on made-up receptions."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweft.config import Config
from skyweft.operators import aggregates, clock, correlate, joins, solve, track, windows
from skyweft.operators import solver_np as S
from skyweft.schemas import DECODED
from skyweft.sources import jsonl, packets

MS = 1_000_000


def decoded(spark, rows):
    """(sensor, t_ns, message) rows."""
    return spark.createDataFrame([(s, 50.0, -5.0, 10.0, t // 10**9, t % 10**9, m, "ABCDEF", 17, 30000, None) for s, t, m in rows], DECODED)


def test_anchored_windows(spark):
    rows = [(1, 0, "A"), (2, 2 * MS, "A"), (3, 2 * MS + 1, "A")]  # exactly 2 ms is in, 1 ns more begins anew
    rows += [(s, 10**9 + int(1.5 * MS) * s, "B") for s in range(5)]  # a chain of short gaps is cut at anchors
    rows += [(1, 0, "C"), (1, 5, "C"), (2, 9, "C"), (7, 0, "D")]  # a sensor counts once; one sensor is no group
    got = {(r["raw_msg"], r["t_ns"]): [x["sensor_id"] for x in r["receptions"]] for r in correlate.correlate(decoded(spark, rows)).collect()}
    assert got == {("A", 0): [1, 2], ("B", 10**9): [0, 1], ("B", 10**9 + 3 * MS): [2, 3], ("C", 0): [1, 2]}


@pytest.mark.parametrize("span", [None, 1, 2, 5, 1024])
@pytest.mark.parametrize("window", [1, 25])
def test_anchored_is_the_plain_fold(spark, monkeypatch, span, window):
    """Runs over many batches or spans, ties, negative times, string and null keys, in small batches."""
    monkeypatch.setattr(correlate, "SPAN_WINDOWS", span)
    rng = np.random.default_rng(5 + (span or 0))
    rows = [(int(i), int(k), None if k == 3 else f"k{k % 2}", int(t)) for i, (k, t) in enumerate(zip(rng.integers(0, 4, 900), rng.integers(-500, 2500, 900)))]
    rows += [(i + 1000, 9, "regular", 10 * i) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k long, name string, t long")
    anchor, want = {}, {}
    for i, k, n, t in sorted(rows, key=lambda r: (r[1], r[3], r[0])):
        if k not in anchor or t - anchor[k] > window:
            anchor[k] = t
        want[i] = anchor[k]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = [(r["id"], r["anchor"]) for r in correlate.anchored(df, ["k", "name"], "t", ["id"], window, split=span is not None).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got) == sorted(want.items())


def test_anchored_batches_of_any_cut():
    """Keys that hold null, not-a-number and equal times go over batch edges as within them."""
    import pyarrow as pa

    kind = pa.schema([("k", pa.float64()), ("t", pa.int64()), ("anchor", pa.int64())])
    keys = [None] * 4 + [1.0] * 5 + [float("nan")] * 4
    times = [None, 0, 2, 3, -4, -4, -1, 2**60, 2**60 + 3, None, None, 2**60, 2**60 + 1]
    want = [None, 0, 0, 3, -4, -4, -1, 2**60, 2**60 + 3, None, None, 2**60, 2**60]
    whole = pa.record_batch([pa.array(keys, pa.float64()), pa.array(times, pa.int64())], names=["k", "t"])
    for n in range(1, 14):
        cut = [whole.slice(i, n) for i in range(0, 13, n)]
        got = pa.Table.from_batches(correlate._chained(iter([whole.slice(0, 0), *cut]), ["k"], "t", 2, kind))
        assert got.column("anchor").to_pylist() == want


@pytest.mark.parametrize("split", [False, True])
def test_anchored_null_times(spark, split):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 6)], "k long, t long").withColumn("id", F.monotonically_increasing_id())
    assert sorted((r["t"] or -1, r["anchor"]) for r in correlate.anchored(df, ["k"], "t", ["id"], 2, split).collect()) == [(-1, None), (5, 5), (6, 5)]


def test_as_of_by_spans(spark):
    """Spans give what one pass gives and what a plain search does; ties, nulls and keys of one side too."""
    rng = np.random.default_rng(8)
    left = [(i, int(k), int(t)) for i, (k, t) in enumerate(zip(rng.integers(0, 4, 300), rng.integers(-50, 2000, 300)))]
    right = [(int(k), int(t), float(v)) for k, t, v in zip(rng.integers(1, 5, 60), rng.integers(-50, 2000, 60), rng.integers(0, 9, 60))]
    right += right[:5] + [(1, 700, 1.0), (1, 700, 2.0)]
    l, r = spark.createDataFrame(left, "id long, k long, t long"), spark.createDataFrame(right, "k long, t long, v double")
    want = {}
    for i, k, t in left:
        seen = [(u, v) for m, u, v in right if m == k and u <= t]
        near = max(seen) if seen and t - max(seen)[0] <= 400 else None
        want[i] = (near[1], t - near[0]) if near else (None, None)
    for span in (None, 1, 37, 5000):
        got = joins.as_of(l, r, "k", "t", ["id"], ["v"], F.lit(400), span)
        assert {x["id"]: (x["prior_v"], x["age"]) for x in got.collect()} == want
    assert joins.as_of(l, r.limit(0), "k", "t", ["id"], ["v"], F.lit(400), 37).where("prior_v is not null").count() == 0


def sky(n, groups, seed=0, noise=2e-8):
    rng = np.random.default_rng(seed)
    s = S.lla_to_ecef(rng.uniform(49.8, 50.8, (groups, n)), rng.uniform(-6.5, -4.5, (groups, n)), np.full((groups, n), 100.0))
    alt = rng.uniform(5000, 11000, groups)
    x = S.lla_to_ecef(rng.uniform(50, 50.6, groups), rng.uniform(-6.2, -4.8, groups), alt)
    t = np.linalg.norm(x[:, None] - s, axis=2) / S.speeds(np.full((groups, n), 100.0), alt) + rng.normal(0, noise, (groups, n))
    return s, t - t.min(1, keepdims=True), np.full((groups, n), 100.0), alt, x


@pytest.mark.parametrize(("n", "most_m"), [(3, 500), (5, 60), (6, 60)])
def test_solver_recovers_positions(n, most_m):
    s, t, salt, alt, x = sky(n, 80)
    prior = x + 100.0 if n == 3 else np.full_like(x, np.nan)
    out = S.solve(s, t, salt, alt, prior, np.full(len(t), 300.0))
    ok = np.array([f is None for f in out["fail"]])
    errors = np.linalg.norm(out["x"] - x, axis=1)[ok]
    assert len(errors) > 30 and np.median(errors) < most_m
    assert set(out["fail"]) <= {None, "gdop_exceeded", "gdop_2d_exceeded", "range_exceeded", "residual_exceeded"}


def plain_rejection(s, t, salt, alt, prior, least):
    """One group, one sensor dropped at a time while the worst residual is 3 km or more."""
    keep, found = list(range(len(t))), None
    while True:
        a = [np.array(x)[None, keep] for x in (s, t, salt)]
        fallback = prior[None] if np.isfinite(prior).all() else S.centroid(a[0], np.array([alt]))
        x0, name = (fallback, ["constrained_3sensor"]) if len(keep) == 3 else S._starts(*a[:2], np.array([alt]), fallback)
        r = S.toa(x0, *a, np.array([alt]), np.full((1, 3), np.nan), np.zeros(1), 50 if len(keep) == 3 else 1000)
        if not r["ok"][0]:
            return found, keep
        found = r["x"][0], r["residual"][0], name[0]
        off = np.abs(S.timing(r["x"], a[0], a[1], S.speeds(a[2], np.array([alt])))[0][0])
        if len(keep) <= least or off.max() < 3000:
            return found, keep
        keep.pop(int(off.argmax()))


@pytest.mark.parametrize("n", [4, 5, 6, 8])
@pytest.mark.parametrize("told", [True, False])
def test_outliers_are_dropped_by_the_worst_residual(n, told):
    """Single late sensors of 3 to 20 km, in one batch, against a loop over single groups."""
    late = [3, 5, 6, 7, 8, 9, 12, 15, 20]
    s, t, salt, alt, x = sky(n, 60, seed=n)
    k = np.arange(60)
    t[k, k % n] += np.array(late)[k % len(late)] * 1e3 / 3e8 * (k % 4 > 0)
    t -= t.min(1, keepdims=True)
    prior = np.where((k % 2 == 0)[:, None], x + 200.0, np.nan)
    alt = alt if told else np.full(60, np.nan)
    need = np.where(told & np.isfinite(prior).all(1), 2, 3 if told else 4)
    r, method, used = S._with_outliers(s, t, salt, alt, prior, np.where(np.isfinite(prior), prior, S.centroid(s, alt)), need)
    dropped = 0
    for g in range(60):
        found, keep = plain_rejection(s[g], t[g], salt[g], alt[g], prior[g], max(3, need[g]))
        assert (found is not None) == r["ok"][g]
        assert used[g].nonzero()[0].tolist() == keep
        if found:
            assert np.linalg.norm(r["x"][g] - found[0]) < 1 and abs(r["residual"][g] - found[1]) < 0.1
            gone = n - len(keep)
            assert method[g] == (f"{found[2]}_drop{gone}" if gone else found[2])
            dropped += gone > 0
    assert dropped >= (6 if n > 4 else 0)


def test_a_late_sensor_does_not_move_the_fix():
    """Six sensors, one late by 6 to 9 km: what is accepted lies near the truth."""
    s, t, salt, alt, x = sky(6, 120, seed=2)
    t[:, 3] += np.linspace(6e3, 9e3, 120) / 3e8
    out = S.solve(s, t - t.min(1, keepdims=True), salt, alt, np.full_like(x, np.nan), np.full(120, 300.0))
    dropped = np.array([f is None and "_drop" in m for f, m in zip(out["fail"], np.where(out["method"] == None, "", out["method"]))])  # noqa: E711
    assert dropped.sum() > 30 and (out["n"][dropped] < 6).all()
    assert np.median(np.linalg.norm(out["x"] - x, axis=1)[dropped]) < 100


def test_too_few_sensors():
    s, t, salt, alt, x = sky(3, 2)
    nan = np.full_like(x, np.nan)
    assert S.solve(s, t, salt, np.full(2, np.nan), nan, np.full(2, 1.0))["fail"].tolist() == ["too_few_sensors"] * 2


def flights(spark):
    from skyweft.plans import synthetic

    return synthetic.flights(spark, "/root/testdata/sf0.001")


def test_flights_are_solved_and_tracked(spark):
    groups = flights(spark)
    records = solve.solve_groups(groups).cache()
    truth = groups.select("raw_msg", "true_lat", "true_lon")
    err = F.sqrt(F.pow((F.col("lat") - F.col("true_lat")) * 111320, 2) + F.pow((F.col("lon") - F.col("true_lon")) * 71000, 2))
    r = solve.fixes(records).join(truth, "raw_msg").agg(F.count("*").alias("n"), F.percentile_approx(err, 0.9).alias("p90")).first()
    assert r["n"] > 100 and r["p90"] < 400
    t = track.tracks(records).collect()
    assert t and all(np.all(np.linalg.eigvalsh(np.array(x["cov_matrix"])) > 0) for x in t)
    stats = aggregates.solve_stats(records).first()
    assert stats["groups"] == groups.count() and stats["solved"] == r["n"]


def test_one_pass_is_solving_then_tracking(spark):
    groups = flights(spark)
    key = lambda r: (r["icao"], r["raw_msg"], r["track_quality"], round(r["lat"], 7), round(r["speed_kts"], 4))
    assert {key(r) for r in track.solved_tracks(groups).collect()} == {key(r) for r in track.tracks(solve.solve_groups(groups)).collect()}


def test_rotated_starts():
    """Five sensors of which the first order has no closed form, as two are in one place."""
    s, t, salt, alt, x = sky(6, 30, seed=9)
    s[:, 1], t[:, 1] = s[:, 0], t[:, 0]
    _, names = S._starts(s, t, alt, S.centroid(s, alt))
    assert "inamdar_5sensor" in names


def test_order_of_rows_does_not_matter(spark):
    groups = flights(spark)
    one = {(r["raw_msg"], round(r["lat"], 9)) for r in solve.fixes(solve.solve_groups(groups)).collect()}
    two = {(r["raw_msg"], round(r["lat"], 9)) for r in solve.fixes(solve.solve_groups(groups.orderBy(F.rand(3)))).collect()}
    assert one == two


def test_clock_offsets_are_found(spark):
    groups = flights(spark)
    shift = lambda r: F.struct(r["sensor_id"], r["lat"], r["lon"], r["alt"], r["timestamp_s"], (r["timestamp_ns"] + r["sensor_id"] * 5000).alias("timestamp_ns"))
    off = groups.withColumn("receptions", F.transform("receptions", shift))
    history = clock.offsets(clock.measurements(off)).cache()
    last = history.groupBy("sensor_a", "sensor_b").agg(F.max_by(F.struct("offset", "n"), "t_ns").alias("s")).where("s.n >= 10").collect()
    assert last and all(abs(r["s"]["offset"] - (r["sensor_a"] - r["sensor_b"]) * 5e-6) < 1e-6 for r in last)
    assert clock.pair_table(history).count() == 10
    fixed = clock.corrected(off.drop("true_lat", "true_lon", "ecef"), history)
    assert "pair_variance" in fixed.columns
    # each reception is 5 us a sensor number late; of a corrected group all are late alike, to the filters' noise
    late = lambda r: r["timestamp_s"] * 10**9 + r["timestamp_ns"]
    true = {r["raw_msg"]: [late(x) for x in r["receptions"]] for r in groups.collect()}
    spread = [np.ptp(np.array([late(x) for x in r["receptions"]]) - true[r["raw_msg"]]) for r in fixed.collect()]
    assert len(spread) == len(true) and np.mean(np.array(spread) < 200) > 0.9


def pairs(n, known):
    """Variances and offsets of one group's pairs of receptions: {(i, j): (offset, variance)}."""
    v, o = np.full((1, n, n), np.inf), np.zeros((1, n, n))
    for (i, j), (off, var) in known.items():
        v[0, i, j] = v[0, j, i] = var
        o[0, i, j], o[0, j, i] = off, -off
    return v, o


@pytest.mark.parametrize("warm", [0, 700, 1500])
def test_clock_filters_split_in_time(spark, warm):
    """Spans with warm-ups, or refiltered where those don't fit, against one run through each pair:
    drifts, outliers, jumps that reset filters, gaps over whole spans, ties."""
    from skyweft.operators import clockspans

    rng = np.random.default_rng(4)
    rows = []
    for a, b, n in ((1, 2, 9000), (1, 3, 4000), (2, 3, 3), (5, 6, 1)):
        for k in range(n):
            t = (k + (8000 if k > 2500 else 0)) * 10**9 + int(rng.integers(0, 3)) * 10**8
            z = 1e-4 * a + k * 1e-9 + rng.normal() * 4e-6 + (1e-3 if k % 97 == 5 else 0) + (3e-3 if b == 2 and k > 5200 else 0)
            rows.append((a, b, t, float(z)))
    rows += [(1, 2, 10**9, 1e-4), (1, 2, 10**9, 1e-4)]
    df = spark.createDataFrame(rows, "sensor_a long, sensor_b long, t_ns long, measured double")
    key = lambda r: (r["sensor_a"], r["sensor_b"], r["k"])
    want = sorted(clock.offsets(df).collect(), key=key)
    got = sorted(clockspans.offsets(df, 1500 * 10**9, warm * 10**9).collect(), key=key)
    assert [(key(r), r["t_ns"], r["n"], r["valid"], r["accepted"]) for r in got] == [(key(r), r["t_ns"], r["n"], r["valid"], r["accepted"]) for r in want]
    assert {r["accepted"] for r in got} == {True, False} and sum(r["n"] == 1 for r in got) > 4
    for name, most in (("offset", 1e-12), ("drift", 1e-14), ("variance", 1e-17)):
        assert np.abs(np.array([r[name] for r in got]) - np.array([r[name] for r in want])).max() < most
    assert clockspans.offsets(df.where("false"), 10, 5).count() == 0


def test_correction_tree():
    # from the node of most pairs
    got = clock.corrections(*pairs(3, {(1, 0): (1e-6, 1e-12), (0, 2): (-2e-6, 1e-12)}))[0]
    assert got == pytest.approx([0.0, -1e-6, -2e-6], abs=1e-15)
    # of a ring the edge of most variance is left out
    got = clock.corrections(*pairs(3, {(0, 1): (1e-6, 1e-12), (1, 2): (1e-6, 1e-12), (0, 2): (9e-6, 5e-12)}))[0]
    assert got[0] == 0.0 and got[1] == pytest.approx(1e-6) and got[2] == pytest.approx(2e-6)
    # what is not joined to the tree and what is over half a second stays
    assert clock.corrections(*pairs(4, {(0, 1): (0.7, 1e-12), (2, 3): (1e-6, 1e-12)})).tolist() == [[0.0] * 4]
    assert clock.corrections(*pairs(2, {})).tolist() == [[0.0, 0.0]]


def test_correction_trees_are_plain_ones():
    """Against a heap over one group at a time."""
    import heapq

    rng = np.random.default_rng(12)
    for n in (2, 3, 5, 8):
        v, o = np.full((60, n, n), np.inf), np.zeros((60, n, n))
        for g in range(60):
            for i in range(n):
                for j in range(i + 1, n):
                    if rng.random() < 0.6:
                        v[g, i, j] = v[g, j, i] = rng.integers(1, 4) * 1e-12
                        o[g, i, j] = rng.normal() * 0.2
                        o[g, j, i] = -o[g, i, j]
        got = clock.corrections(v, o)
        for g in range(60):
            edges = [[(v[g, i, j], i, j, o[g, i, j]) for j in range(n) if np.isfinite(v[g, i, j])] for i in range(n)]
            root = max(range(n), key=lambda i: (len(edges[i]), -i))
            want, seen, heap = [0.0] * n, {root}, list(edges[root])
            heapq.heapify(heap)
            while heap:
                _, i, j, c = heapq.heappop(heap)
                if j not in seen:
                    seen.add(j)
                    want[j] = want[i] + c
                    for e in edges[j]:
                        heapq.heappush(heap, e)
            assert got[g] == pytest.approx([c if abs(c) <= 0.5 else 0.0 for c in want], abs=1e-12)


def test_invalid_pairs_correct_nothing(spark):
    """After a jump a pair's filter begins anew: until it is valid its earlier states don't count."""
    told = [(1, 2, t * 10**9, 1e-6) for t in range(20)] + [(1, 2, t * 10**9, 5e-3) for t in range(20, 30)]
    history = clock.offsets(spark.createDataFrame(told, "sensor_a long, sensor_b long, t_ns long, measured double"))
    at = {r["t_ns"] // 10**9: (r["n"], r["valid"]) for r in history.collect()}
    assert at[23] == (20, True) and at[24] == (1, False) and at[25] == (2, False) and at[26] == (3, True)
    one = lambda s, t: (s, 50.0, -5.0, 10.0, t // 10**9, t % 10**9)
    times = [0, 500_000_000, 19_500_000_000, 23_500_000_000, 24_500_000_000, 25_500_000_000, 26_500_000_000, 29_999_999_999, 10**12]
    rows = [("A", 17, None, None, f"{k}", 2, [one(2, t), one(1, t)], t) for k, t in enumerate(times)]
    rows += [("A", 17, None, None, "none", 2, [one(7, 5), one(8, 6)], 20 * 10**9), ("A", 17, None, None, "empty", 0, [], 10**9), ("A", 17, None, None, "null", 0, None, 10**9)]
    groups = spark.createDataFrame(rows, "icao string, df_type int, altitude_ft double, squawk string, raw_msg string, num_sensors int, receptions array<struct<sensor_id:long,lat:double,lon:double,alt:double,timestamp_s:long,timestamp_ns:long>>, t_ns long")
    got = {r["raw_msg"]: r for r in clock.corrected(groups, history).collect()}
    assert len(got) == len(rows) and got["null"]["receptions"] is None and got["empty"]["receptions"] == []
    moved = {k: got[str(k)]["receptions"][1]["timestamp_s"] * 10**9 + got[str(k)]["receptions"][1]["timestamp_ns"] - t for k, t in enumerate(times)}
    # the first reception is sensor 2's: sensor 1's clock, ahead by the offset, is put back
    assert moved[0] == moved[1] == moved[4] == moved[5] == 0
    assert all(abs(moved[k] + 1000) <= 1 for k in (2, 3)) and all(abs(moved[k] + 5_000_000) <= 1 for k in (6, 7))
    assert [got[str(k)]["pair_variance"] is None for k in range(7)] == [True, True, False, False, True, True, False]
    assert all(got[str(k)]["receptions"][0]["timestamp_s"] * 10**9 + got[str(k)]["receptions"][0]["timestamp_ns"] == t for k, t in enumerate(times))
    assert got["none"]["receptions"][1]["timestamp_ns"] == 6


def test_overrides(spark):
    rec = spark.createDataFrame([(1, 50.0, -5.0, 1.0, 0, 0), (1, 51.9, -5.0, 1.0, 1, 0), (2, 10.0, 10.0, 1.0, 0, 0), (3, 50.4999, -5.0, 1.0, 0, 0)], "sensor_id long, lat double, lon double, alt double, timestamp_s long, timestamp_ns long")
    dim = spark.createDataFrame([("k1", 50.1, -5.0, 70.0, "a"), ("k2", 50.1, -5.0, 80.0, "b")], "public_key string, lat double, lon double, alt double, name string")
    got = {(r["sensor_id"], r["timestamp_s"]): r["alt"] for r in joins.with_overrides(rec, dim).collect()}
    assert got == {(1, 0): 70.0, (1, 1): 70.0, (3, 0): 70.0}


def test_groups_at_overrides(spark):
    """Groups are formed first: a sensor without a place anchors its window, then goes."""
    rows = [(7, 0, "A"), (1, MS, "A"), (2, 2 * MS, "A"), (1, 2 * MS + 1, "B"), (7, 2 * MS + 2, "B"), (7, 5, "C"), (8, 6, "C")]
    d = decoded(spark, rows).withColumn("lon", F.when(F.col("sensor_id") >= 7, 90.0).otherwise(F.col("lon")))
    dim = spark.createDataFrame([("k", 50.1, -5.0, 70.0, "a")], "public_key string, lat double, lon double, alt double, name string")
    places = joins.surveyed(d, dim)
    got = {r["raw_msg"]: r for r in joins.groups_at_overrides(correlate.correlate(d), places).collect()}
    assert {k: [x["sensor_id"] for x in r["receptions"]] for k, r in got.items()} == {"A": [1, 2], "B": [1], "C": []}
    assert got["A"]["t_ns"] == 0 and got["A"]["num_sensors"] == 2 and {(x["lat"], x["alt"]) for x in got["A"]["receptions"]} == {(50.1, 70.0)}
    assert got["A"]["df_type"] == 17 and got["A"]["altitude_ft"] == 30000.0
    records = {r["t_ns"]: (r["kind"], r["reason"]) for r in solve.solve_groups(joins.groups_at_overrides(correlate.correlate(d), places)).collect()}
    assert records[5] == records[2 * MS + 1] == ("skipped", "too_few_sensors")


def test_own_fixes_train_the_clocks(spark):
    """Clocks drift after the last told position: the solver's own fixes keep them known."""
    late = lambda r: F.struct(r["sensor_id"], r["lat"], r["lon"], r["alt"], r["timestamp_s"], (r["timestamp_ns"] + r["sensor_id"] * (2000 + (r["timestamp_s"] * r["timestamp_s"] / 20).cast("long"))).alias("timestamp_ns"))
    from skyweft.operators.kept import kept
    from skyweft.plans import synthetic

    groups = kept(synthetic.flights(spark, "/root/testdata/sf0.001", 5).withColumn("receptions", F.transform("receptions", late)))
    told = groups.drop("true_lat", "true_lon", "ecef")
    base = clock.measurements(groups.where("cpr_lat is not null").select("t_ns", "ecef", "receptions"))
    off = F.sqrt(F.pow((F.col("fix.lat") - F.col("true_lat")) * 111320, 2) + F.pow((F.col("fix.lon") - F.col("true_lon")) * 71000, 2))
    measured, errors = base, []
    for _ in range(2):
        corrected = kept(clock.corrected(told, kept(clock.offsets(measured))))
        records = kept(solve.solve_groups(corrected))
        both = records.where("kind = 'fix' and t_ns > 40000000000").join(groups.select("icao", "t_ns", "true_lat", "true_lon"), ["icao", "t_ns"])
        errors.append(both.agg(F.percentile_approx(off, 0.9)).first()[0])
        own = clock.own_references(records, told, corrected)
        good = records.where("fix.quality_residual_m < 200").join(corrected.where("calibrated").select("icao", "t_ns"), ["icao", "t_ns"])
        assert own.count() == good.count() > 0
        raw = {(r["t_ns"], tuple(x["timestamp_ns"] for x in r["receptions"])) for r in told.collect()}
        assert all((r["t_ns"], tuple(x["timestamp_ns"] for x in r["receptions"])) in raw for r in own.collect())  # as heard, not as corrected
        measured = kept(base.unionByName(clock.measurements(own)))
    assert errors[1] < errors[0]
    from skyweft.plans import pipeline

    rows = [(s, 50.0, -5.0, 10.0, 1, s * 100, "8D" + "AB" * 13) for s in range(3)]
    layers = pipeline.build(spark.createDataFrame(rows, "sensor_id long, lat double, lon double, alt double, timestamp_s long, timestamp_ns long, raw_msg string"), own_passes=1)
    assert layers.is_written and layers.written() is layers and layers.records.count() == layers.groups.count()


def test_eviction_at_an_exact_rank(spark, monkeypatch):
    """However narrow the range that is ranked; ties by the second order, nulls oldest."""
    monkeypatch.setattr(windows, "RANKED_ROWS", 20)
    rng = np.random.default_rng(6)
    rows = [(int(i), int(t)) for i, t in enumerate(rng.integers(0, 150, 2001))] + [(9000, None), (9001, None)]
    df = spark.createDataFrame(rows, "id long, t long")
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]), reverse=True)[: len(rows) - len(rows) // 2]
    assert sorted(r["id"] for r in windows.evicted(df, ["t", "id"], 100).collect()) == sorted(r[0] for r in want)
    same = spark.range(500).select("id", F.lit(3).alias("t"))
    assert {r["id"] for r in windows.evicted(same, ["t", "id"], 100).collect()} == set(range(250, 500))


@pytest.mark.parametrize("least", [0, 1_000_000])
def test_statistics_of_groups(spark, monkeypatch, least):
    """Ranked in ranges or in one go; a hot group, a null one and nulls in the values."""
    monkeypatch.setattr(aggregates, "RANKED_ROWS", least)
    rng = np.random.default_rng(4)
    rows = [(k, float(v)) for k, n in (("hot", 3000), ("few", 7), (None, 200)) for v in rng.integers(0, 90, n)] + [("hot", None), ("none", None)]
    got = {r["k"]: (r["n"], r["median"], r["p95"]) for r in aggregates.order_statistics(spark.createDataFrame(rows, "k string, v double"), "v", ["k"]).collect()}
    want = {}
    for k in ("hot", "few", None):
        v = sorted(x for g, x in rows if g == k and x is not None)
        want[k] = (len(v), v[len(v) // 2], v[int(len(v) * 0.95) if len(v) > 20 else -1])
    assert got == want


def test_eviction_and_statistics(spark):
    df = spark.range(11).select("id", (F.col("id") * 2).alias("v"))
    assert {r["id"] for r in windows.evicted(df, ["id"], 10).collect()} == {5, 6, 7, 8, 9, 10}
    r = aggregates.order_statistics(df, "v").first()
    assert (r["n"], r["median"], r["p95"]) == (11, 10, 20)
    v = np.sort(np.random.default_rng(2).integers(0, 300, 5000) / 7)
    r = aggregates.order_statistics(spark.createDataFrame([(float(x),) for x in v], "v double"), "v").first()
    assert (r["n"], r["median"], r["p95"]) == (5000, v[2500], v[4750])
    assert aggregates.order_statistics(df.where("false"), "v").first()["n"] is None


def test_packets(spark, tmp_path):
    def frame(lat, n=7):
        p = struct.pack(">qdddQQ", 7, lat, -5.0, 10.0, 3, 4) + bytes(range(n))
        return bytes([len(p)]) + p

    data = frame(50.0) + b"\x00" + frame(90.0001) + frame(float("nan")) + frame(51.0, 6) + frame(52.0, 14) + frame(53.0)[:20]
    (tmp_path / "a.bin").write_bytes(data)
    got = packets.read_packets(spark, str(tmp_path / "a.bin")).orderBy("lat").collect()
    assert [(r["lat"], len(r["raw_msg"])) for r in got] == [(50.0, 14), (52.0, 28)]
    spark.dataSource.register(packets.PacketSource)
    assert spark.read.format("packets").option("path", str(tmp_path)).load().count() == 4


def test_jsonl(spark, tmp_path):
    g = {"icao": "A", "df_type": 17, "altitude_ft": None, "squawk": None, "raw_msg": "8D", "num_sensors": 1, "receptions": [{"sensor_id": 1, "lat": 1.0, "lon": 2.0, "alt": 3.0, "timestamp_s": 1, "timestamp_ns": 2}]}
    bad = dict(g, receptions=[{"sensor_id": 1}])
    lines = [json.dumps(g), "", "{oops", json.dumps(bad), json.dumps(g | {"extra": 1}), json.dumps({k: v for k, v in g.items() if k != "icao"})]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = jsonl.parse_groups(df)
    assert jsonl.good(parsed).count() == 2 and tuple(jsonl.counts(parsed).first()) == (5, 3)
    r = jsonl.parse_records(spark.createDataFrame([(json.dumps({"unsolved_group": g}),), (json.dumps({"icao": "x"}),)], "value string")).collect()
    assert [x["kind"] for x in r] == ["unsolved_group", None]
    out = jsonl.lines(jsonl.writable(spark.createDataFrame([(float("inf"), 1.005)], "gdop double, t0_s double"), jsonl.FIX_DIGITS)).first()[0]
    assert json.loads(out) == {"gdop": None, "t0_s": 1.005}
    assert jsonl.read_overrides(spark, ["/nowhere/x.json"]).count() == 0


def test_config():
    c = Config.from_env({"MLAT_WINDOW_MS": "3", "MLAT_MIN_RECEPTIONS": "x"})
    assert (c.window_ns, c.min_receptions) == (3 * MS, 2)


def test_packets_to_tracks(spark):
    """Binary truth: an aircraft that tells its position by CPR is solved near it."""
    from skyweft.plans import pipeline, synthetic

    def message(lat, lon, odd):
        zones = 59 if odd else 60
        dlat = 360 / zones
        yz = int(np.floor(131072 * (lat % dlat) / dlat + 0.5))
        rlat = dlat * (yz / 131072 + np.floor(lat / dlat))
        nl = 1 if abs(rlat) >= 87 else int(2 * np.pi / np.arccos(1 - (1 - np.cos(np.pi / 30)) / np.cos(np.radians(rlat)) ** 2))
        dlon = 360 / max(nl - odd, 1)
        xz = int(np.floor(131072 * (lon % dlon) / dlon + 0.5))
        n = (30000 + 1000) // 25
        alt = (n >> 4) << 5 | 0x10 | (n & 0xF)
        me = 11 << 51 | alt << 36 | odd << 34 | (yz % 131072) << 17 | xz % 131072
        return f"8DABCDEF{me:014X}000000"

    rows = []
    for k in range(40):
        lat, lon = 50.2 + k * 1e-4, -5.6 + k * 2e-4
        x = S.lla_to_ecef(lat, lon, 30000 * 0.3048)
        for i, a, b, h in synthetic.SENSORS[:5]:
            v = S.speeds(np.array([[h]]), np.array([30000 * 0.3048]))[0, 0]
            ns = round(np.linalg.norm(x - S.lla_to_ecef(a, b, h)) / v * 1e9)
            rows.append((i, a, b, h, 2 * k, int(ns), message(lat, lon, k % 2)))
    packets = spark.createDataFrame(rows, "sensor_id long, lat double, lon double, alt double, timestamp_s long, timestamp_ns long, raw_msg string")
    layers = pipeline.build(packets, write=True)
    got = layers.tracks.orderBy("timestamp_s").collect()
    assert len(got) > 20 and {r["icao"] for r in got} == {"ABCDEF"}
    last = got[-1]
    k = last["timestamp_s"] / 2
    assert abs(last["lat"] - (50.2 + k * 1e-4)) < 2e-3 and abs(last["lon"] - (-5.6 + k * 2e-4)) < 3e-3 and last["alt_ft"] == 30000
    assert layers.statistics()["tracks"].first()["aircraft"] == 1
    assert layers.snapshot().first()["band"] == "high"
