"""Registered queries over the functions that the solver, tracker and clocks call.

Each feeds made-up cases from ``events`` to the same numpy or column code that a run
uses; the SQL beside it works the cases out in closed form or, for filters, by a
recursive query.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.functions import geo, modes, scalar
from skyweft.operators import aggregates, clock, joins, solve, track, union
from skyweft.operators import solver_np as S
from skyweft.plans import synthetic as syn
from skyweft.plans.registry import _SENSOR_ROWS, _ecef, query, rounded
from skyweft.plans.synthetic import SENSORS, events, sql
from skyweft.schemas import FIX, GROUP, TRACK
from skyweft.sources import jsonl, packets


def each(df: DataFrame, work, schema: str) -> DataFrame:
    """``schema`` columns of what ``work`` makes of a batch's columns as numpy arrays."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                out = work({n: b.column(n).to_numpy(zero_copy_only=False) for n in b.schema.names})
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in out.values()], names=list(out))

    return df.mapInArrow(run, schema)


# ---- messages ----------------------------------------------------------------------

#: Messages of 28 digits: the format, then two numbers of events' bits.
_LONG = "((event_id * 2654435761 + 97) % 4503599627370496)"


def _long_messages(spark, sf) -> DataFrame:
    i = F.col("event_id")
    n = (i * F.lit(2654435761).cast("long") + 97) % F.lit(1 << 52)
    # DF 17, type code in turn; 51 bits of the rest
    me = F.shiftleft((i % 32).cast("long"), 51).bitwiseOR(F.col("n") % F.lit(1 << 51))
    return events(spark, sf, "event_id").select("event_id", n.alias("n")).select("event_id", F.concat(F.lit("8DABCDEF"), F.lpad(F.hex(me), 14, "0"), F.lit("000000")).alias("m"))


_ME = f"SELECT event_id, event_id % 32 AS tc, {_LONG} % 2251799813685248 AS b FROM events"


@query(f"""SELECT event_id, tc::INT AS tc, CASE WHEN tc BETWEEN 9 AND 18 THEN ((b >> 34) & 1)::INT END AS odd, CASE WHEN tc BETWEEN 9 AND 18 THEN ((b >> 17) & 131071)::INT END AS lat_cpr,
  CASE WHEN tc BETWEEN 9 AND 18 THEN (b & 131071)::INT END AS lon_cpr,
  CASE WHEN tc BETWEEN 9 AND 18 AND (c & 16) <> 0 AND f BETWEEN -1000 AND 100000 THEN f END::INT AS alt_ft
FROM (SELECT *, (((c & 4064) >> 1) | (c & 15)) * 25 - 1000 AS f FROM (SELECT *, (b >> 36) & 4095 AS c FROM ({_ME})))""")
def df17_position(spark, sf):
    p = _long_messages(spark, sf).select("event_id", modes.type_code("m").alias("tc"), modes.position_fields("m").alias("p"))
    return p.select("event_id", "tc", "p.odd", "p.lat_cpr", "p.lon_cpr", "p.alt_ft")


@query(f"""WITH v AS (SELECT event_id, tc = 19 AND ((b >> 48) & 7) = 1 AS ok, ((b >> 42) & 1) AS se, ((b >> 32) & 1023) AS ew, ((b >> 31) & 1) AS sn, ((b >> 21) & 1023) AS ns, ((b >> 19) & 1) AS sv, ((b >> 10) & 511) AS vr
  FROM (SELECT event_id, 19 AS tc, (1::BIGINT << 48) | ({_LONG} % 281474976710656) AS b FROM events)),
w AS (SELECT event_id, ((ew - 1) * (1 - 2 * se))::DOUBLE AS e, ((ns - 1) * (1 - 2 * sn))::DOUBLE AS n, CASE WHEN vr = 0 THEN 0 ELSE (vr - 1) * 64 * (1 - 2 * sv) END::INT AS r FROM v WHERE ok AND ew <> 0 AND ns <> 0)
SELECT event_id, e AS ew_knots, n AS ns_knots, round(sqrt(e * e + n * n), 6) AS speed_kts, round(CASE WHEN degrees(atan2(e, n)) < 0 THEN degrees(atan2(e, n)) + 360 ELSE degrees(atan2(e, n)) END, 6) AS heading_deg, r AS vrate_fpm FROM w""")
def df17_velocity(spark, sf):
    n = (F.col("event_id") * F.lit(2654435761).cast("long") + 97) % F.lit(1 << 52) % F.lit(1 << 48)
    me = F.lit(19 << 51).bitwiseOR(F.lit(1 << 48)).bitwiseOR(n)
    m = events(spark, sf, "event_id").select("event_id", F.concat(F.lit("8DABCDEF"), F.lpad(F.hex(me), 14, "0"), F.lit("000000")).alias("m"))
    v = m.select("event_id", modes.velocity_fields("m").alias("v")).where("v is not null")
    return v.select("event_id", "v.ew_knots", "v.ns_knots", *rounded(6, speed_kts=F.col("v.speed_kts"), heading_deg=F.col("v.heading_deg")), "v.vrate_fpm")


@query("""WITH c AS (SELECT event_id, (event_id * 37) % 8192 AS c FROM events),
r AS (SELECT *, [(c >> (12 - b)) & 1 FOR b IN range(13)] AS x FROM c),
b AS (SELECT event_id, c, x,
  x[11] AS g0, xor(x[11], x[13]) AS g1, xor(xor(x[11], x[13]), x[2]) AS g2, xor(xor(xor(x[11], x[13]), x[2]), x[4]) AS g3,
  x[1] AS k0, xor(x[1], x[3]) AS k1, xor(xor(x[1], x[3]), x[5]) AS k2 FROM r),
f AS (SELECT *, xor(g3, x[6]) AS g4, xor(xor(g3, x[6]), x[8]) AS g5, xor(xor(xor(g3, x[6]), x[8]), x[10]) AS g6, xor(xor(xor(xor(g3, x[6]), x[8]), x[10]), x[12]) AS g7, k0 * 4 + k1 * 2 + k2 AS raw FROM b),
h AS (SELECT *, g0 * 128 + g1 * 64 + g2 * 32 + g3 * 16 + g4 * 8 + g5 * 4 + g6 * 2 + g7 AS fives, CASE WHEN raw = 7 THEN 5 ELSE raw END AS ones FROM f)
SELECT event_id, CASE WHEN c = 0 THEN NULL WHEN x[7] = 1 THEN floor((((c >> 1) & 4032) | (c & 63)) * 3.28084::DOUBLE)::INT
  WHEN x[9] = 1 THEN ((((c >> 2) & 2016) | ((c >> 1) & 16) | (c & 15)) * 25 - 1000)::INT
  WHEN raw IN (1, 2, 3, 4, 7) THEN (fives * 500 + CASE WHEN fives % 2 = 1 THEN 6 - ones ELSE ones END * 100 - 1300)::INT END AS alt_ft FROM h""")
def altitude_codes(spark, sf):
    """Altitude fields in 25-foot, Gillham and metric code."""
    c = (F.col("event_id") * 37 % 8192).cast("int")
    return events(spark, sf, "event_id").select("event_id", modes.altitude_code(c).alias("alt_ft"))


# ---- scalars -----------------------------------------------------------------------


@query("""SELECT event_id, round(value * 0.3048::DOUBLE, 6) AS metres, round(value / 0.3048::DOUBLE, 6) AS feet, sign(value - 50) * floor(abs(value - 50) * 100 + 0.5) / 100 AS rounded,
  least(greatest(value, 20::DOUBLE), 80::DOUBLE) AS clamped, round((event_id % 50 - 25) - 7 * floor((event_id % 50 - 25) / 7.0::DOUBLE), 6) AS floor_mod FROM events""")
def units_and_rounding(spark, sf):
    v, k = F.col("value"), (F.col("event_id") % 50 - 25).cast("double")
    return events(spark, sf, "event_id", "value").select(
        "event_id", *rounded(6, metres=scalar.ft_to_m(v), feet=scalar.m_to_ft(v)), scalar.round_to(v - 50, 2).alias("rounded"), scalar.clamp(v, F.lit(20.0), F.lit(80.0)).alias("clamped"), *rounded(6, floor_mod=scalar.positive_mod(k, F.lit(7.0)))
    )


@query(f"""SELECT event_id, round(x, 3) AS x, round(y, 3) AS y, round(z, 3) AS z FROM (SELECT event_id, {_ecef(alt='h')} FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 10000::DOUBLE ELSE (event_id % 400) * 100 * 0.3048::DOUBLE END AS h FROM ({sql('event_id', 'lat', 'lon')})))""")
def default_altitude(spark, sf):
    i = F.col("event_id")
    p = geo.position_to_ecef("lat", "lon", F.when(i % 3 != 0, (i % 400) * 100.0))
    return events(spark, sf, "event_id", "lat", "lon").select("event_id", p.alias("p")).select("event_id", *rounded(3, x=F.col("p.x"), y=F.col("p.y"), z=F.col("p.z")))


@query(f"""WITH v AS (SELECT event_id, radians(lat) AS p, radians(lon) AS l, (event_id % 301) - 150.0::DOUBLE AS e, (event_id % 211) - 105.0::DOUBLE AS n, (event_id % 97) - 48.0::DOUBLE AS u FROM ({sql('event_id', 'lat', 'lon')}))
SELECT event_id, round(-sin(l) * e - sin(p) * cos(l) * n + cos(p) * cos(l) * u, 6) AS vx, round(cos(l) * e - sin(p) * sin(l) * n + cos(p) * sin(l) * u, 6) AS vy, round(cos(p) * n + sin(p) * u, 6) AS vz FROM v""")
def enu_to_ecef(spark, sf):
    """Told velocities as the position cache takes them."""

    def work(c):
        i = c["event_id"]
        v = solve.enu_vectors(c["lat"], c["lon"], i % 301 - 150.0, i % 211 - 105.0, i % 97 - 48.0)
        return {"event_id": i, **{k: v[:, j] for j, k in enumerate(("vx", "vy", "vz"))}}

    e = each(events(spark, sf, "event_id", "lat", "lon"), work, "event_id long, vx double, vy double, vz double")
    return e.select("event_id", *[F.round(k, 6).alias(k) for k in ("vx", "vy", "vz")])


@query(f"""WITH v AS (SELECT event_id, radians(lat) AS p, radians(lon) AS l, 100.0::DOUBLE + event_id % 50 AS a, (event_id % 9)::DOUBLE AS b, 200.0::DOUBLE + event_id % 70 AS d, 300.0::DOUBLE AS f FROM ({sql('event_id', 'lat', 'lon')})),
r AS (SELECT event_id, a, b, d, f, -sin(l) AS e1, cos(l) AS e2, -sin(p) * cos(l) AS n1, -sin(p) * sin(l) AS n2, cos(p) AS n3 FROM v)
SELECT event_id, round(e1 * e1 * a + 2 * e1 * e2 * b + e2 * e2 * d, 6) AS ee, round(e1 * n1 * a + (e1 * n2 + e2 * n1) * b + e2 * n2 * d, 6) AS en, round(n1 * n1 * a + 2 * n1 * n2 * b + n2 * n2 * d + n3 * n3 * f, 6) AS nn FROM r""")
def enu_covariance(spark, sf):
    """Covariances turned to east and north as the tracker writes them."""

    def work(c):
        i = c["event_id"]
        p = np.zeros((len(i), 3, 3))
        p[:, 0, 0], p[:, 1, 1], p[:, 2, 2] = 100.0 + i % 50, 200.0 + i % 70, 300.0
        p[:, 0, 1] = p[:, 1, 0] = i % 9
        _, cov = track.local_motion(c["lat"], c["lon"], np.zeros((len(i), 3)), p)
        return {"event_id": i, "ee": cov[:, 0, 0], "en": cov[:, 0, 1], "nn": cov[:, 1, 1]}

    e = each(events(spark, sf, "event_id", "lat", "lon"), work, "event_id long, ee double, en double, nn double")
    return e.select("event_id", *[F.round(k, 6).alias(k) for k in ("ee", "en", "nn")])


# ---- the solver's parts ------------------------------------------------------------

_FOUR = f"""s AS (SELECT id, salt, {_ecef('slat', 'slon', 'salt', 's')} FROM (VALUES {_SENSOR_ROWS}) v(id, slat, slon, salt)),
a AS (SELECT event_id, alt_m + 3000 AS h, lat, lon, {_ecef(alt='(alt_m + 3000)')} FROM ({sql('event_id', 'lat', 'lon', 'alt_m')})),
r AS (SELECT event_id, id, h, x, y, z, lat, lon, ((event_id * 7 + id * 13) % 1000) * 1e-6::DOUBLE AS t, sx - x AS dx, sy - y AS dy, sz - z AS dz, sqrt(pow(sx - x, 2) + pow(sy - y, 2) + pow(sz - z, 2)) AS d,
  {geo.C_VACUUM} / (1 + {geo.REFRACTIVITY} / ({geo.DECAY} * (h - salt)) * (exp(-{geo.DECAY} * salt) - exp(-{geo.DECAY} * h))) AS v FROM a, s WHERE id < 4)"""


def _four(c) -> tuple[np.ndarray, ...]:
    """Places, times and positions of the first four sensors and the events' aircraft."""
    n = len(c["event_id"])
    place = np.array([[a, b, h] for _, a, b, h in SENSORS[:4]])
    s = np.broadcast_to(S.lla_to_ecef(place[:, 0], place[:, 1], place[:, 2]), (n, 4, 3))
    alt = c["alt_m"] + 3000
    t = ((c["event_id"][:, None] * 7 + np.arange(4) * 13) % 1000) * 1e-6
    return S.lla_to_ecef(c["lat"], c["lon"], alt), s, t, np.broadcast_to(place[:, 2], (n, 4)), alt


@query(f"""WITH {_FOUR}, m AS (SELECT *, avg(t - d / v) OVER (PARTITION BY event_id) AS t0 FROM r)
SELECT event_id, id::INT AS sensor, round((t - t0) * v - d, 3) AS residual_m, round(t0 * 1e9, 2) AS t0_ns, round(v, 3) AS speed FROM m""")
def timing_residuals(spark, sf):
    """Residuals, emission time and mean speeds of light at a position."""

    def work(c):
        x, s, t, salt, alt = _four(c)
        v = S.speeds(salt, alt)
        r, _, t0 = S.timing(x, s, t, v)
        n = len(alt)
        return {"event_id": np.repeat(c["event_id"], 4), "sensor": np.tile(np.arange(4, dtype=np.int32), n), "residual_m": r.reshape(-1), "t0_ns": np.repeat(t0 * 1e9, 4), "speed": v.reshape(-1)}

    e = each(events(spark, sf, "event_id", "lat", "lon", "alt_m"), work, "event_id long, sensor int, residual_m double, t0_ns double, speed double")
    return e.select("event_id", "sensor", *[F.round(k, d).alias(k) for k, d in (("residual_m", 3), ("t0_ns", 2), ("speed", 3))])


@query(f"""WITH {_FOUR}, m AS (SELECT *, (t - avg(t - d / v) OVER (PARTITION BY event_id)) * v - d AS q FROM r),
k AS (SELECT event_id, sum(q * q) AS qq, sum(500000 * (sqrt(1 + q * q / 250000) - 1)) AS c FROM m GROUP BY event_id)
SELECT event_id, round(qq / 1e6 + (10 * 150.0::DOUBLE) * (10 * 150.0::DOUBLE) / 1e6 + 3 * 4 * 4 * 20.0::DOUBLE * 20 / 1e6, 4) AS squares_km2,
  round((c + 500000 * (sqrt(1 + 1500.0::DOUBLE * 1500 / 250000) - 1) + 3 * 500000 * (sqrt(1 + 80.0::DOUBLE * 80 / 250000) - 1)) / 1e6, 4) AS cost_km2 FROM k""")
def objective_rows(spark, sf):
    """Timing, altitude and prior rows of the objective, and its robust cost: altitude
    150 m off at weight 10, the prior 20 m off on each axis at weight 4."""

    def work(c):
        x, s, t, salt, alt = _four(c)
        r, _ = S.rows(x, s, t, S.speeds(salt, alt), alt + 150, x - 20, np.full(len(alt), 4.0))
        return {"event_id": c["event_id"], "squares_km2": (r**2).sum(1) / 1e6, "cost_km2": S.cost(r) / 1e6}

    e = each(events(spark, sf, "event_id", "lat", "lon", "alt_m"), work, "event_id long, squares_km2 double, cost_km2 double")
    return e.select("event_id", *rounded(4, squares_km2=F.col("squares_km2"), cost_km2=F.col("cost_km2")))


def _gdop3_sql(rows: str, keys: str) -> str:
    """GDOP of unit vectors ux, uy, uz by the Schur complement of the clock's row."""
    return f"""n AS (SELECT {keys}, count(*) AS n, sum(ux * ux) AS a, sum(ux * uy) AS b, sum(ux * uz) AS c, sum(uy * uy) AS d, sum(uy * uz) AS e, sum(uz * uz) AS f, sum(ux) AS p, sum(uy) AS q, sum(uz) AS w FROM {rows} GROUP BY {keys}),
m AS (SELECT {keys}, n, p, q, w, a, b, c, d, e, f, a - p * p / n AS ma, b - p * q / n AS mb, c - p * w / n AS mc, d - q * q / n AS md, e - q * w / n AS me, f - w * w / n AS mf FROM n),
i AS (SELECT *, ma * (md * mf - me * me) - mb * (mb * mf - mc * me) + mc * (mb * me - mc * md) AS det FROM m),
j AS (SELECT *, ((md * mf - me * me) + (ma * mf - mc * mc) + (ma * md - mb * mb)) / det AS spread,
  (p * p * (md * mf - me * me) + q * q * (ma * mf - mc * mc) + w * w * (ma * md - mb * mb) + 2 * p * q * (mc * me - mb * mf) + 2 * p * w * (mb * me - mc * md) + 2 * q * w * (mb * mc - ma * me)) / det AS bent FROM i),
g AS (SELECT {keys}, sqrt(spread + 1.0::DOUBLE / n + bent / (n * n)) AS gdop FROM j)"""


@query(f"""WITH s AS (SELECT id, {_ecef('slat', 'slon', 'salt', 's')} FROM (VALUES {_SENSOR_ROWS}) v(id, slat, slon, salt)),
a AS (SELECT event_id, {_ecef(alt='(alt_m + 3000)')} FROM ({sql('event_id', 'lat', 'lon', 'alt_m')})),
u AS (SELECT event_id, (x - sx) / sqrt(pow(sx - x, 2) + pow(sy - y, 2) + pow(sz - z, 2)) AS ux, (y - sy) / sqrt(pow(sx - x, 2) + pow(sy - y, 2) + pow(sz - z, 2)) AS uy, (z - sz) / sqrt(pow(sx - x, 2) + pow(sy - y, 2) + pow(sz - z, 2)) AS uz FROM a, s),
{_gdop3_sql('u', 'event_id')} SELECT event_id, round(gdop, 5) AS gdop FROM g""")
def gdop3d_events(spark, sf):
    """3D dilution of the whole network at the events' aircraft."""

    def work(c):
        place = np.array([[a, b, h] for _, a, b, h in SENSORS])
        s = S.lla_to_ecef(place[:, 0], place[:, 1], place[:, 2])
        x = S.lla_to_ecef(c["lat"], c["lon"], c["alt_m"] + 3000)
        return {"event_id": c["event_id"], "gdop": S.gdop_3d(x, np.broadcast_to(s, (len(x), *s.shape)))}

    return each(events(spark, sf, "event_id", "lat", "lon", "alt_m"), work, "event_id long, gdop double").select("event_id", F.round("gdop", 5).alias("gdop"))


#: Cases of checked solutions: how many sensors, residual and offset from the prior.
_CHECKED = """c AS (SELECT event_id, 2 + event_id % 3 AS n, CASE WHEN event_id % 4 = 0 THEN value ELSE value * 40 END AS res, (event_id % 7) * 2500.0::DOUBLE AS off FROM events)"""


@query(f"""WITH {_CHECKED}, k AS (SELECT *, (CASE WHEN n = 2 THEN 5000 ELSE 30000 END) * least(3.0::DOUBLE, greatest(1.0::DOUBLE, 200 / greatest(res, 10.0::DOUBLE))) AS drift, CASE n WHEN 2 THEN 200.0::DOUBLE WHEN 3 THEN 2000 ELSE 5000 END AS cap FROM c)
SELECT event_id, round(CASE WHEN n = 2 THEN greatest(res, off) ELSE res END, 3) AS quality,
  CASE WHEN res > cap THEN 'residual_exceeded' WHEN n <= 3 AND off > drift THEN 'prior_drift_exceeded' END AS fail FROM k""")
def solution_limits(spark, sf):
    """Quality and the first limit that a solution breaks: residual, drift from the
    prior; sensors around the aircraft, so that the geometry passes."""

    def work(c):
        i, value = c["event_id"], c["value"]
        res, off = np.where(i % 4 == 0, value, value * 40), (i % 7) * 2500.0
        quality, fail = np.zeros(len(i)), np.full(len(i), None, object)
        for n in (2, 3, 4):
            j = np.flatnonzero(2 + i % 3 == n)
            if not len(j):
                continue
            around = np.array([(50.3, -5.5, 8000.0), (49.9, -6.4, 60.0), (49.9, -4.6, 95.0), (50.8, -5.5, 130.0), (50.3, -5.4, 200.0)])
            p = S.lla_to_ecef(around[:, 0], around[:, 1], around[:, 2])
            x = np.broadcast_to(p[0], (len(j), 3))
            s = np.broadcast_to(p[1 : n + 1], (len(j), n, 3))
            prior = x + np.stack([off[j], 0 * off[j], 0 * off[j]], axis=1)
            q, _, f = S._checked({"x": x, "residual": res[j], "ok": np.ones(len(j), bool)}, np.ones((len(j), n), bool), s, np.full(len(j), 8000.0), prior)
            quality[j], fail[j] = q, f
        return {"event_id": i, "quality": quality, "fail": pa.array(fail, pa.string())}

    e = each(events(spark, sf, "event_id", "value"), work, "event_id long, quality double, fail string")
    return e.select("event_id", F.round("quality", 3).alias("quality"), "fail")


@query("""WITH c AS (SELECT event_id, (event_id % 90) * 1.37::DOUBLE AS dt, value AS res, event_id % 3 AS v, (event_id % 11) * 900.0::DOUBLE AS moved, 1 + event_id % 8 AS solves FROM events),
k AS (SELECT *, v = 1 AS moving, 100.0::DOUBLE AS speed, 2 * (res + 20) AS slack FROM c)
SELECT event_id, dt <= 120 AS seen, round(CASE WHEN dt > 120 THEN 500 WHEN moving THEN greatest(50, 25 * dt * dt + res) ELSE greatest(100, 300 * dt + res) END, 3) AS uncertainty,
  round(CASE WHEN moving AND dt > 0 AND dt < 60 THEN speed * dt ELSE 0 END, 3) AS ahead,
  dt < 1e-3 OR (greatest(0, moved - slack) / greatest(dt, 1e-3) <= 1030 AND (NOT moving OR dt <= 0.1 OR abs(moved - speed * dt) <= greatest(25 * dt * dt + slack, CASE WHEN solves < 5 THEN 10000 ELSE 5000 END, 1.5 * slack))) AS possible FROM k""")
def cache_rules(spark, sf):
    """Cached positions by age: whether they count, how sure they are, where they predict,
    and whether a move from them is possible."""

    def work(c):
        i, n = c["event_id"], len(c["event_id"])
        cache = solve.Cache()
        k = cache.of(np.array([str(x) for x in i], object))
        cache.live[k], cache.t[k], cache.residual[k], cache.solves[k] = True, 0, c["value"], 1 + i % 8
        cache.velocity[k] = np.nan
        cache.velocity[k[i % 3 == 1]] = (100.0, 0.0, 0.0)
        t = (i % 90) * 1_370_000_000
        seen, moving, dt = cache.seen(k, t), cache.moving(k), cache.age(k, t)
        x = np.stack([(i % 11) * 900.0, np.zeros(n), np.zeros(n)], axis=1)
        return {"event_id": i, "seen": seen, "uncertainty": solve.uncertainty(seen, moving, dt, c["value"]), "ahead": cache.predict(k, t)[:, 0], "possible": cache.consistent(k, x, t, np.full(n, 20.0))}

    e = each(events(spark, sf, "event_id", "value"), work, "event_id long, seen boolean, uncertainty double, ahead double, possible boolean")
    return e.select("event_id", "seen", *rounded(3, uncertainty=F.col("uncertainty"), ahead=F.col("ahead")), "possible")


# ---- filters -----------------------------------------------------------------------

_NOISE = """CASE WHEN n = 2 THEN least(3000.0::DOUBLE, greatest(500.0::DOUBLE, CASE WHEN g > 0 THEN q * g * 3 ELSE q * 8 END))
  WHEN q > 0 THEN least(2000.0::DOUBLE, greatest(50.0::DOUBLE, CASE WHEN g > 0 THEN q * g ELSE q * 2 END)) ELSE 200.0::DOUBLE END"""
#: Fixes of flights with gaps over 60 s and over 300 s, and every 13th a degree off.
_FIXES = f"""k AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY t_us, event_id) - 1 AS k, value FROM ({sql('event_id', 'user_id', 't_us', 'value')})),
f AS (SELECT event_id, user_id, (k * 7 + (k // 3) * 100 + (k // 6) * 400)::BIGINT AS t, 2 + event_id % 3 AS n, value AS q, (event_id % 4)::DOUBLE AS g,
  50 + (user_id % 11) * 0.05::DOUBLE + k * 0.001::DOUBLE + CASE WHEN event_id % 13 = 0 THEN 1.0::DOUBLE ELSE 0 END AS lat FROM k),
z AS (SELECT *, {_NOISE} AS s, {_ecef('lat', '(-5.5::DOUBLE)', '9144.0::DOUBLE')}, row_number() OVER (PARTITION BY user_id ORDER BY t) AS rn FROM f WHERE NOT (n = 2 AND q > 50))"""


@query(f"""WITH RECURSIVE {_FIXES},
r AS (SELECT user_id, rn, event_id, t, 1::BIGINT AS c, true AS ok, x, y, z, 0.0::DOUBLE AS vx, 0.0::DOUBLE AS vy, 0.0::DOUBLE AS vz, 40000.0::DOUBLE AS a, 0.0::DOUBLE AS b, 1e6::DOUBLE AS d FROM z WHERE rn = 1
UNION ALL
SELECT user_id, rn, event_id, t, CASE WHEN stale THEN 1 WHEN ok THEN c + 1 ELSE c END, stale OR ok,
  CASE WHEN stale THEN zx WHEN ok THEN x + k * (zx - x) ELSE x END, CASE WHEN stale THEN zy WHEN ok THEN y + k * (zy - y) ELSE y END, CASE WHEN stale THEN zz WHEN ok THEN z + k * (zz - z) ELSE z END,
  CASE WHEN stale THEN 0 WHEN ok THEN vx + h * (zx - x) ELSE vx END, CASE WHEN stale THEN 0 WHEN ok THEN vy + h * (zy - y) ELSE vy END, CASE WHEN stale THEN 0 WHEN ok THEN vz + h * (zz - z) ELSE vz END,
  CASE WHEN stale THEN 40000.0::DOUBLE WHEN ok THEN (1 - k) * (1 - k) * a + k * k * s * s ELSE a END, CASE WHEN stale THEN 0 WHEN ok THEN (1 - k) * (b - h * a) + k * h * s * s ELSE b END,
  CASE WHEN stale THEN 1e6::DOUBLE WHEN ok THEN d - 2 * h * b + h * h * (a + s * s) ELSE d END
FROM (SELECT *, a / (a + s * s) AS k, b / (a + s * s) AS h, (pow(zx - x, 2) + pow(zy - y, 2) + pow(zz - z, 2)) / (a + s * s) <= {track.GATE} AS ok
  FROM (SELECT user_id, rn, event_id, t, c, stale, s, zx, zy, zz, x + vx * u AS x, y + vy * u AS y, z + vz * u AS z, vx, vy, vz,
    a + 2 * u * b + u * u * d + 25 * pow(u, 4) / 4 + wide AS a, b + u * d + 25 * pow(u, 3) / 2 AS b, d + 25 * u * u + wide AS d
    FROM (SELECT z.user_id, z.rn, z.event_id, z.t, r.c, z.t - r.t > 300 AS stale, z.s, z.x AS zx, z.y AS zy, z.z AS zz, r.x, r.y, r.z, r.vx, r.vy, r.vz, r.a, r.b, r.d,
      CASE WHEN z.t - r.t > {track.MAX_PREDICT_S} THEN 0 ELSE z.t - r.t END AS u, CASE WHEN z.t - r.t > {track.MAX_PREDICT_S} THEN 1e6 ELSE 0 END AS wide FROM r JOIN z ON z.user_id = r.user_id AND z.rn = r.rn + 1))))
SELECT event_id, c::INT AS track_quality, round(a, 2) AS variance_m2, round({geo.KNOTS} * sqrt(pow(-sin(radians(l)) * vx + cos(radians(l)) * vy, 2)), 2) AS east_kts FROM (SELECT *, degrees(atan2(y, x)) AS l FROM r) WHERE ok""")
def kalman_tracks(spark, sf):
    """The tracker on fixes of its own: gates, restarts, variances and speeds."""
    from pyspark.sql import Window

    e = events(spark, sf, "event_id", "user_id", "t_us", "value")
    i, u, k = F.col("event_id"), F.col("user_id"), F.col("k")
    e = e.withColumn("k", (F.row_number().over(Window.partitionBy("user_id").orderBy("t_us", "event_id")) - 1).cast("long"))
    t = (k * 7 + F.floor(k / 3) * 100 + F.floor(k / 6) * 400).cast("long")
    lat = F.lit(50.0) + (u % 11) * 0.05 + k * 0.001 + F.when(i % 13 == 0, 1.0).otherwise(0.0)
    value = {"icao": u.cast("string"), "lat": lat, "lon": F.lit(-5.5), "alt_ft": F.lit(30_000.0), "residual_m": F.col("value"), "quality_residual_m": F.col("value"), "gdop": (i % 4).cast("double"), "num_sensors": (i % 3 + 2).cast("int"),
             "solve_method": F.lit("frisch_toa"), "timestamp_s": t, "timestamp_ns": F.lit(0).cast("long"), "df_type": F.lit(20), "squawk": F.lit(None).cast("string"), "raw_msg": i.cast("string"), "t0_s": F.lit(0.0)}
    fix = F.struct(*[value[f.name].cast(f.dataType).alias(f.name) for f in FIX.fields])
    records = e.select((t * 1_000_000_000).alias("t_ns"), u.cast("string").alias("icao"), fix.alias("fix"), F.lit(None).cast(GROUP).alias("unsolved_group"))
    out = track.tracks(records)
    east = F.abs(F.sin(F.radians("heading_deg")) * F.col("speed_kts"))
    return out.select(F.col("raw_msg").cast("long").alias("event_id"), "track_quality", F.round(F.col("cov_matrix")[0][0], 2).alias("variance_m2"), F.round(east, 2).alias("east_kts"))


#: Clock differences of 15 pairs: drift, noise, single outliers and a jump of seven.
_CLOCKS = f"""m AS (SELECT *, row_number() OVER (PARTITION BY sa, sb ORDER BY t_us, event_id) AS rn FROM (SELECT event_id, t_us, user_id % 5 AS sa, 10 + user_id % 3 AS sb FROM ({sql('event_id', 'user_id', 't_us')}))),
z AS (SELECT event_id, sa, sb, rn, rn + 30 * (rn // 40) AS t, rn * 1e-8::DOUBLE + (event_id % 7 - 3) * 2e-6::DOUBLE + CASE WHEN event_id % 11 = 0 THEN 1e-3::DOUBLE ELSE 0 END + CASE WHEN rn % 100 BETWEEN 60 AND 66 THEN 2e-3::DOUBLE ELSE 0 END AS q FROM m)"""


def _filter_sql(clocks: str) -> str:
    """Filters of pairs' measurements: sa, sb, rn, event_id, seconds t and differences q in ``z``."""
    return f"""WITH RECURSIVE {clocks},
r AS (SELECT sa, sb, rn, event_id, t, q AS o, 0.0::DOUBLE AS w, 100 * {clock.R!r}::DOUBLE AS a, 0.0::DOUBLE AS b, 1e-12::DOUBLE AS d, 1 AS n, 0 AS run, true AS ok, NULL::DOUBLE AS y FROM z WHERE rn = 1
UNION ALL
SELECT sa, sb, rn, event_id, t, CASE WHEN reset THEN q WHEN gated THEN o ELSE o + a / s * y END, CASE WHEN reset THEN 0 WHEN gated THEN w ELSE w + b / s * y END,
  CASE WHEN reset THEN 100 * {clock.R!r}::DOUBLE WHEN gated THEN a ELSE (1 - a / s) * (1 - a / s) * a + (a / s) * (a / s) * {clock.R!r}::DOUBLE END,
  CASE WHEN reset THEN 0 WHEN gated THEN b ELSE (1 - a / s) * (b - b / s * a) + (a / s) * (b / s) * {clock.R!r}::DOUBLE END,
  CASE WHEN reset THEN 1e-12::DOUBLE WHEN gated THEN d ELSE d + (b / s) * (b / s) * s - 2 * (b / s) * b END,
  CASE WHEN reset THEN 1 WHEN gated THEN n ELSE n + 1 END, CASE WHEN reset OR NOT gated THEN 0 ELSE run + 1 END, reset OR NOT gated, CASE WHEN reset THEN NULL ELSE y END
FROM (SELECT *, gated AND run + 1 >= {clock.RESET_AFTER} AS reset FROM (SELECT *, n >= {clock.VALID_AFTER} AND y * y > {clock.GATE_SIGMA ** 2!r}::DOUBLE * s AS gated FROM (SELECT *, q - o AS y, a + {clock.R!r}::DOUBLE AS s FROM
  (SELECT z.sa, z.sb, z.rn, z.event_id, z.t, z.q, r.o + r.w * (z.t - r.t) AS o, r.w, r.a + 2 * (z.t - r.t) * r.b + pow(z.t - r.t, 2) * r.d + {clock.Q_DRIFT!r}::DOUBLE * pow(z.t - r.t, 3) / 3 AS a,
    r.b + (z.t - r.t) * r.d + {clock.Q_DRIFT!r}::DOUBLE * pow(z.t - r.t, 2) / 2 AS b, r.d + {clock.Q_DRIFT!r}::DOUBLE * (z.t - r.t) AS d, r.n, r.run FROM r JOIN z ON z.sa = r.sa AND z.sb = r.sb AND z.rn = r.rn + 1)))))"""


_CLOCK_FILTER = _filter_sql(_CLOCKS)


def _clock_history(spark, sf) -> DataFrame:
    from pyspark.sql import Window

    e = events(spark, sf, "event_id", "user_id", "t_us").select("event_id", "t_us", (F.col("user_id") % 5).alias("sensor_a"), (F.col("user_id") % 3 + 10).alias("sensor_b"))
    rn, i = F.col("rn"), F.col("event_id")
    e = e.withColumn("rn", F.row_number().over(Window.partitionBy("sensor_a", "sensor_b").orderBy("t_us", "event_id")).cast("long"))
    q = rn * 1e-8 + (i % 7 - 3) * 2e-6 + F.when(i % 11 == 0, 1e-3).otherwise(0.0) + F.when((rn % 100).between(60, 66), 2e-3).otherwise(0.0)
    return clock.offsets(e.select("sensor_a", "sensor_b", ((rn + F.floor(rn / 40) * 30) * 1_000_000_000).alias("t_ns"), q.alias("measured")))


@query(f"""{_CLOCK_FILTER} SELECT sa AS sensor_a, sb AS sensor_b, t AS t_s, round(o * 1e9, 1) AS offset_ns, round(w * 1e9, 2) AS drift_ns, round(a * 1e15, 1) AS variance, n::INT AS n, n >= {clock.VALID_AFTER} AS valid, ok AS accepted FROM r""")
def clock_filter(spark, sf):
    """Offset and drift filters of sensor pairs after each measurement."""
    h = _clock_history(spark, sf)
    return h.select("sensor_a", "sensor_b", (F.col("t_ns") / 1_000_000_000).cast("long").alias("t_s"), F.round(F.col("offset") * 1e9, 1).alias("offset_ns"), F.round(F.col("drift") * 1e9, 2).alias("drift_ns"), F.round(F.col("variance") * 1e15, 1).alias("variance"), "n", "valid", "accepted")


@query(f"""{_CLOCK_FILTER}, k AS (SELECT sa, sb, y, row_number() OVER (PARTITION BY sa, sb ORDER BY y) - 1 AS i, count(*) OVER (PARTITION BY sa, sb) AS n FROM r WHERE y IS NOT NULL)
SELECT sa AS sensor_a, sb AS sensor_b, n, round(max(CASE WHEN i = n // 2 THEN y END) * 1e9, 1) AS median_ns FROM k GROUP BY sa, sb, n""")
def clock_innovations(spark, sf):
    return clock.innovations(_clock_history(spark, sf)).select("sensor_a", "sensor_b", "n", F.round(F.col("median") * 1e9, 1).alias("median_ns"))


#: Two rings of three sensors, 0 to 2 and 3 to 5: each pair of a ring with measurements at its
#: own pace, noise, outliers and a jump, so that filters are reset and their variances differ.
_RINGS = f"""m AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY t_us, event_id) AS rn FROM (SELECT event_id, t_us, user_id % 6 AS u FROM ({sql('event_id', 'user_id', 't_us')}))),
z AS (SELECT event_id, rn, u // 3 * 3 + CASE u % 3 WHEN 1 THEN 1 ELSE 0 END AS sa, u // 3 * 3 + CASE u % 3 WHEN 0 THEN 1 ELSE 2 END AS sb, rn * (1000 + 137 * u) * 1000000 AS tn, rn * (1000 + 137 * u) / 1000.0::DOUBLE AS t,
  rn * 1e-8::DOUBLE + u * 1e-4::DOUBLE + (event_id % 7 - 3) * 2e-6::DOUBLE + CASE WHEN event_id % 11 = 0 THEN 1e-3::DOUBLE ELSE 0 END + CASE WHEN rn % 40 BETWEEN 20 AND 26 THEN 2e-3::DOUBLE ELSE 0 END AS q FROM m)"""
#: Of three nodes: p and q besides the root, in order, and the edges between them.
_TREE = """CASE WHEN d0 >= d1 AND d0 >= d2 THEN 0 WHEN d1 >= d2 THEN 1 ELSE 2 END AS root"""


@query(f"""{_filter_sql(_RINGS)},
h AS (SELECT r.sa, r.sb, z.tn, r.o, r.w, r.a AS v, r.n >= {clock.VALID_AFTER} AS valid FROM r JOIN z USING (sa, sb, rn)),
g AS (SELECT event_id, tn, CASE WHEN event_id % 3 = 0 THEN [x, x + 1] WHEN event_id % 3 = 1 THEN [x, x + 1, x + 2] ELSE [x + 2, x, x + 1] END AS ids FROM (SELECT event_id, (event_id * 977 % 300000) * 1000000 + 13 AS tn, event_id // 3 % 2 * 3 AS x FROM events)),
e AS (SELECT event_id, tn, i, j, least(ids[i + 1], ids[j + 1]) AS sa, greatest(ids[i + 1], ids[j + 1]) AS sb, CASE WHEN ids[i + 1] < ids[j + 1] THEN 1 ELSE -1 END AS way FROM g, (VALUES (0, 1), (0, 2), (1, 2)) AS ij(i, j) WHERE j < len(ids)),
f AS (SELECT e.event_id, i, j, CASE WHEN h.valid THEN h.v END AS v, CASE WHEN h.valid THEN way * (h.o + h.w * ((e.tn - h.tn) * 1e-9::DOUBLE)) END AS c FROM e ASOF LEFT JOIN h ON e.sa = h.sa AND e.sb = h.sb AND e.tn >= h.tn),
k AS (SELECT event_id, max(CASE WHEN i = 0 AND j = 1 THEN v END) AS v01, max(CASE WHEN i = 0 AND j = 1 THEN c END) AS c01, max(CASE WHEN i = 0 AND j = 2 THEN v END) AS v02, max(CASE WHEN i = 0 AND j = 2 THEN c END) AS c02, max(CASE WHEN i = 1 THEN v END) AS v12, max(CASE WHEN i = 1 THEN c END) AS c12 FROM f GROUP BY event_id),
d AS (SELECT *, {_TREE} FROM (SELECT *, (v01 IS NOT NULL)::INT + (v02 IS NOT NULL)::INT AS d0, (v01 IS NOT NULL)::INT + (v12 IS NOT NULL)::INT AS d1, (v02 IS NOT NULL)::INT + (v12 IS NOT NULL)::INT AS d2 FROM k)),
t AS (SELECT event_id, root, v01, CASE root WHEN 0 THEN v01 WHEN 1 THEN v01 ELSE v02 END AS vp, CASE root WHEN 0 THEN c01 WHEN 1 THEN -c01 ELSE -c02 END AS cp, CASE root WHEN 0 THEN v02 ELSE v12 END AS vq, CASE root WHEN 0 THEN c02 WHEN 1 THEN c12 ELSE -c12 END AS cq,
  CASE root WHEN 0 THEN v12 WHEN 1 THEN v02 ELSE v01 END AS vx, CASE root WHEN 0 THEN c12 WHEN 1 THEN c02 ELSE c01 END AS cx FROM d),
w AS (SELECT *, vp IS NOT NULL AND (vq IS NULL OR vp <= vq) AS pf FROM t),
y AS (SELECT *, CASE WHEN pf THEN cp WHEN vq IS NULL THEN NULL WHEN vp IS NOT NULL AND (vx IS NULL OR vp <= vx) THEN cp ELSE cq - cx END AS p, CASE WHEN NOT pf THEN cq WHEN vq IS NOT NULL AND (vx IS NULL OR vq <= vx) THEN cq ELSE cp + cx END AS q FROM w)
SELECT event_id, (CASE WHEN root = 0 THEN 0 ELSE x0 END)::BIGINT AS moved_0, (CASE WHEN root = 1 THEN 0 WHEN root = 0 THEN x0 ELSE x1 END)::BIGINT AS moved_1, (CASE WHEN event_id % 3 = 0 THEN NULL WHEN root = 2 THEN 0 ELSE x1 END)::BIGINT AS moved_2, CASE WHEN event_id % 3 = 0 THEN round(v01 * 1e15, 1) END AS pair_variance
FROM (SELECT *, coalesce(round(CASE WHEN abs(p) <= 0.5 THEN p END * 1e9), 0) AS x0, coalesce(round(CASE WHEN abs(q) <= 0.5 THEN q END * 1e9), 0) AS x1 FROM y)""")
def clock_corrections(spark, sf):
    """Nanoseconds by which each reception of groups of two and three sensors is corrected,
    with filters that are reset, pairs that are not valid and rings with a worst edge."""
    from pyspark.sql import Window

    u, rn, i = F.col("u"), F.col("rn"), F.col("event_id")
    e = events(spark, sf, "event_id", "user_id", "t_us").select("event_id", "t_us", (F.col("user_id") % 6).alias("u"))
    e = e.withColumn("rn", F.row_number().over(Window.partitionBy("u").orderBy("t_us", "event_id")).cast("long"))
    ring = F.floor(u / 3) * 3
    q = rn * 1e-8 + u * 1e-4 + (i % 7 - 3) * 2e-6 + F.when(i % 11 == 0, 1e-3).otherwise(0.0) + F.when((rn % 40).between(20, 26), 2e-3).otherwise(0.0)
    told = e.select((ring + (u % 3 == 1).cast("long")).alias("sensor_a"), (ring + F.when(u % 3 == 0, 1).otherwise(2)).alias("sensor_b"), (rn * (u * 137 + 1000) * 1_000_000).alias("t_ns"), q.alias("measured"))
    at, x = (i * 977 % 300_000) * 1_000_000 + 13, F.floor(i / 3) % 2 * 3
    heard = lambda k: F.struct(k.cast("long").alias("sensor_id"), F.lit(50.0).alias("lat"), F.lit(-5.0).alias("lon"), F.lit(1.0).alias("alt"), F.floor(at / 1_000_000_000).alias("timestamp_s"), (at % 1_000_000_000).alias("timestamp_ns"))
    some = lambda *ks: F.array(*[heard(x + k) for k in ks])
    groups = events(spark, sf, "event_id").select(F.lit("A").alias("icao"), i.cast("string").alias("raw_msg"), at.alias("t_ns"), F.when(i % 3 == 0, some(0, 1)).when(i % 3 == 1, some(0, 1, 2)).otherwise(some(2, 0, 1)).alias("receptions"))
    out = clock.corrected(groups, clock.offsets(told))
    moved = lambda r: F.when(r["sensor_id"].isNotNull(), r["timestamp_s"] * 1_000_000_000 + r["timestamp_ns"] - F.col("t_ns"))
    three = [moved(F.get("receptions", F.lit(k))).alias(f"moved_{k}") for k in range(3)]
    return out.select(F.col("raw_msg").cast("long").alias("event_id"), *three, F.round(F.col("pair_variance") * 1e15, 1).alias("pair_variance"))


@query("""SELECT a AS sensor_a, b AS sensor_b, round(max_by(value, event_id) * 1e6, 3) AS offset_us, round(max_by(value * 2, event_id) * 1e6, 3) AS drift_ppm, max(event_id) % 100 >= 3 AS valid FROM (SELECT *, user_id % 3 AS a, 5 + user_id % 4 AS b FROM events) GROUP BY a, b ORDER BY a, b LIMIT 10""")
def clock_table(spark, sf):
    i = F.col("event_id")
    h = events(spark, sf, "event_id", "user_id", "value").select((F.col("user_id") % 3).alias("sensor_a"), (F.col("user_id") % 4 + 5).alias("sensor_b"), i.alias("t_ns"), F.col("value").alias("offset"), (F.col("value") * 2).alias("drift"), F.lit(1.0).alias("variance"), (i % 100).cast("int").alias("n"), (i % 100 >= 3).alias("valid"))
    return clock.pair_table(h).select("sensor_a", "sensor_b", *rounded(3, offset_us=F.col("offset_us"), drift_ppm=F.col("drift_ppm")), "valid")


# ---- sources, sinks and records ----------------------------------------------------


@query("""SELECT event_id AS sensor_id, (event_id % 200 - 100)::DOUBLE AS lat, (event_id % 360 - 180)::DOUBLE AS lon, value AS alt, event_id * 2 AS timestamp_s, event_id % 1000 AS timestamp_ns, upper(printf('%014x', event_id)) AS raw_msg
FROM events WHERE event_id % 200 - 100 BETWEEN -90 AND 90 AND event_id % 17 <> 0""")
def packet_decode(spark, sf):
    """Binary payloads; every 17th is short and some are out of bounds."""

    def work(c):
        i = c["event_id"].tolist()
        return {"payload": pa.array([packets.HEAD.pack(k, k % 200 - 100, k % 360 - 180, v, k * 2, k % 1000) + struct.pack(">Q", k)[1 : 7 if k % 17 == 0 else 8] for k, v in zip(i, c["value"].tolist())], pa.binary())}

    return packets.parse_payloads(each(events(spark, sf, "event_id", "value"), work, "payload binary"))


def _group_lines(spark, sf) -> DataFrame:
    """Groups as JSON lines: good, without an address, cut off, with a bad reception,
    blank, and with keys that are not known."""
    i = F.col("event_id")
    head = F.when(i % 6 == 1, F.lit("{")).when(i % 6 == 5, F.lit('{"more":[1,{"a":null}],"icao":"A1",')).otherwise(F.lit('{"icao":"A1",'))
    lat = F.when(i % 6 == 3, F.lit("")).otherwise(F.lit('"lat":50.5,'))
    body = F.concat(head, F.lit('"df_type":17,"altitude_ft":null,"squawk":"1200","raw_msg":"'), i.cast("string"), F.lit('","num_sensors":1,"receptions":[{"sensor_id":7,'), lat, F.lit('"lon":-5.25,"alt":10.0,"timestamp_s":'), i.cast("string"), F.lit(',"timestamp_ns":5}]}'))
    text = F.when(i % 6 == 2, F.expr("substring(body, 1, 40)")).when(i % 6 == 4, F.lit("  ")).otherwise(F.col("body"))
    return events(spark, sf, "event_id").withColumn("body", body).select(text.alias("value"))


@query("SELECT event_id::VARCHAR AS raw_msg, 'A1' AS icao, '1200' AS squawk, 50.5::DOUBLE AS lat, event_id AS timestamp_s FROM events WHERE event_id % 6 IN (0, 5)")
def group_lines(spark, sf):
    g = jsonl.good(jsonl.parse_groups(_group_lines(spark, sf)))
    return g.select("raw_msg", "icao", "squawk", F.col("receptions")[0]["lat"].alias("lat"), F.col("receptions")[0]["timestamp_s"].alias("timestamp_s"))


@query("SELECT count(*) FILTER (event_id % 6 <> 4) AS records, count(*) FILTER (event_id % 6 IN (1, 2, 3)) AS malformed FROM events")
def malformed_lines(spark, sf):
    return jsonl.counts(jsonl.parse_groups(_group_lines(spark, sf)))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'fix' WHEN 1 THEN 'unsolved_group' END AS kind, CASE WHEN event_id % 3 = 0 THEN event_id * 0.5::DOUBLE END AS residual_m, CASE WHEN event_id % 3 = 1 THEN 2::INT END AS num_sensors, event_id % 3 = 2 AS malformed FROM events""")
def record_lines(spark, sf):
    """Tagged records: fixes, wrapped groups, and fixes that lack a field."""
    i = F.col("event_id").cast("string")
    rest = F.lit('"lat":1.0,"lon":2.0,"alt_ft":3.0,"quality_residual_m":1.0,"gdop":1.0,"num_sensors":4,"solve_method":"m","timestamp_s":1,"timestamp_ns":2,"df_type":17,"raw_msg":"')
    fix = F.concat(F.lit('{"icao":"A","residual_m":'), (F.col("event_id") * 0.5).cast("string"), F.lit(","), rest, i, F.lit('","t0_s":0.5}'))
    group = F.concat(F.lit('{"unsolved_group":{"icao":"A","df_type":17,"raw_msg":"'), i, F.lit('","num_sensors":2,"receptions":[]}}'))
    k = F.col("event_id") % 3
    lines = events(spark, sf, "event_id").select("event_id", F.when(k == 0, fix).when(k == 1, group).otherwise(F.concat(F.lit('{"icao":"A",'), rest, i, F.lit('"}'))).alias("value"))
    r = lines.select("event_id", F.from_json("value", T.StructType([*FIX.fields, T.StructField("unsolved_group", GROUP)])).alias("j"))
    parsed = jsonl.parse_records(lines.select("value"))
    ids = F.coalesce("fix.raw_msg", "unsolved_group.raw_msg").cast("long")
    out = parsed.where("kind is not null").select(ids.alias("event_id"), "kind", "fix.residual_m", "unsolved_group.num_sensors", F.col(jsonl.BAD).isNotNull().alias("malformed"))
    bad = r.where(k == 2).join(parsed.where("kind is null").agg(F.min(F.col(jsonl.BAD).isNotNull()).alias("malformed")))
    return out.unionByName(bad.select("event_id", "malformed"), allowMissingColumns=True)


@query("""SELECT '{"event_id":' || event_id || ',"gdop":' || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE (floor((event_id % 500) / 7.0::DOUBLE * 100 + 0.5) / 100)::VARCHAR END || ',"squawk":' || CASE WHEN event_id % 2 = 0 THEN 'null' ELSE '"a\\"b\\\\c"' END || '}' AS line FROM events""")
def written_lines(spark, sf):
    """JSON lines: rounded numbers, nulls kept, non-finite ones null, text escaped."""
    i = F.col("event_id")
    e = events(spark, sf, "event_id").select("event_id", F.when(i % 5 == 0, F.lit(float("inf"))).otherwise((i % 500) / 7.0).alias("gdop"), F.when(i % 2 == 1, F.lit('a"b\\c')).alias("squawk"))
    return jsonl.lines(jsonl.writable(e, jsonl.FIX_DIGITS)).select(F.col("value").alias("line"))


def _records(spark, sf) -> DataFrame:
    i = F.col("event_id")
    reasons = F.array(*[F.lit(r) for r in ("too_few_sensors", "no_prior_2sensor", "gdop_exceeded", "residual_exceeded", "physically_inconsistent")])
    reason = F.when(i % 2 == 1, F.get(reasons, (i % 5).cast("int")))
    return events(spark, sf, "event_id").select(F.when(reason.isNull(), "fix").otherwise("failed").alias("kind"), reason.alias("reason"))


_REASON = "CASE WHEN event_id % 2 = 1 THEN (['too_few_sensors', 'no_prior_2sensor', 'gdop_exceeded', 'residual_exceeded', 'physically_inconsistent'])[event_id % 5 + 1] END"


@query(f"SELECT reason, count(*) AS n FROM (SELECT {_REASON} AS reason FROM events) WHERE reason IS NOT NULL GROUP BY reason")
def failure_counts(spark, sf):
    return aggregates.failure_counts(_records(spark, sf))


@query(f"""SELECT count(*) AS groups, count(*) FILTER (reason IS NULL) AS solved, count(*) FILTER (reason IS NOT NULL AND reason NOT IN ('too_few_sensors', 'no_prior_2sensor')) AS failed,
  count(*) FILTER (reason IN ('too_few_sensors', 'no_prior_2sensor')) AS skipped, printf('%.1f%%', round(100.0::DOUBLE * count(*) FILTER (reason IS NULL) / count(*), 1)) AS solve_rate FROM (SELECT {_REASON} AS reason FROM events)""")
def record_stats(spark, sf):
    return aggregates.solve_stats(_records(spark, sf))


@query("SELECT sum(c)::BIGINT AS updates, count(*) AS aircraft, count(*) FILTER (q >= 2) AS established FROM (SELECT user_id, count(*) AS c, max(event_id % 3) AS q FROM events GROUP BY user_id)")
def track_counts(spark, sf):
    return aggregates.track_stats(events(spark, sf, "event_id", "user_id").select(F.col("user_id").cast("string").alias("icao"), (F.col("event_id") % 3).alias("track_quality")))


@query("""SELECT event_id, ([0, 1, 2])[k]::BIGINT AS sensor_id, t[k] AS reference_ns FROM (SELECT event_id, t, CASE WHEN t[1] <= t[2] AND t[1] <= t[3] THEN 1 WHEN t[2] <= t[3] THEN 2 ELSE 3 END AS k
FROM (SELECT event_id, [1000000000 + event_id % 5, 1000000000 + event_id % 3, 1000000000 + event_id % 4] AS t FROM events))""")
def reference_reception(spark, sf):
    i = F.col("event_id")
    one = lambda k, d: F.struct(F.lit(k).cast("long").alias("sensor_id"), F.lit(1).cast("long").alias("timestamp_s"), (i % d).alias("timestamp_ns"))
    g = events(spark, sf, "event_id").select("event_id", F.array(one(0, 5), one(1, 3), one(2, 4)).alias("receptions"))
    return aggregates.reference_reception(g, ["event_id"]).select("event_id", "reference.sensor_id", "reference_ns")


@query("""SELECT 'fix' AS kind, event_id * 1000000000 + event_id % 10 AS t_ns, user_id::VARCHAR AS icao FROM events WHERE event_type = 'view'
UNION ALL SELECT 'unsolved_group', event_id * 1000000000 + 3, user_id::VARCHAR FROM events WHERE event_type <> 'view'""")
def tagged_records(spark, sf):
    """Fixes and groups in one stream and apart again."""
    i, u = F.col("event_id"), F.col("user_id").cast("string").alias("icao")
    null = lambda fields, **known: [known[f.name].cast(f.dataType).alias(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    e = events(spark, sf, "event_id", "user_id", "event_type")
    heard = F.array(*[F.struct(F.lit(s).cast("long").alias("sensor_id"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"), F.lit(1.0).alias("alt"), i.alias("timestamp_s"), F.lit(ns).cast("long").alias("timestamp_ns")) for s, ns in ((1, 9), (2, 3))])
    fixes = e.where("event_type = 'view'").select(*null(FIX.fields, icao=u, timestamp_s=i, timestamp_ns=i % 10))
    groups = e.where("event_type <> 'view'").select(*null(GROUP.fields, icao=u, receptions=heard))
    both = union.tagged(fixes, groups)
    return both.select("kind", "t_ns", "icao")


@query(f"""WITH d AS (SELECT s_suppkey AS no, 49.0::DOUBLE + (s_suppkey * 37 % 100) / 25.0::DOUBLE AS dlat, -8.0::DOUBLE + (s_suppkey * 53 % 100) / 20.0::DOUBLE AS dlon FROM supplier),
p AS (SELECT user_id, 48.0::DOUBLE + (user_id * 61 % 1000) / 150.0::DOUBLE AS lat, -8.0::DOUBLE + (user_id * 89 % 1000) / 200.0::DOUBLE AS lon FROM (SELECT DISTINCT user_id FROM events)),
n AS (SELECT user_id, no, dlat, dlon, row_number() OVER (PARTITION BY user_id ORDER BY sqrt(pow(lat - dlat, 2) + pow(lon - dlon, 2)), no) AS k FROM p, d WHERE sqrt(pow(lat - dlat, 2) + pow(lon - dlon, 2)) < 0.5)
SELECT event_id, round(dlat, 6) AS lat, round(dlon, 6) AS lon, no * 1.0::DOUBLE AS alt FROM events JOIN n USING (user_id) WHERE k = 1""")
def override_places(spark, sf):
    """Receptions at their sensors' surveyed places; sensors without one go."""
    u, k = F.col("user_id"), F.col("s_suppkey")
    dim = syn.table(spark, sf, "supplier").select(k.alias("no"), ((k * 37 % 100) / 25 + 49.0).alias("lat"), ((k * 53 % 100) / 20 - 8.0).alias("lon"), k.cast("double").alias("alt"), F.lit("x").alias("name"), F.lit("k").alias("public_key"))
    rec = events(spark, sf, "event_id", "user_id").select("event_id", u.alias("sensor_id"), ((u * 61 % 1000) / 150 + 48.0).alias("lat"), ((u * 89 % 1000) / 200 - 8.0).alias("lon"), F.lit(0.0).alias("alt"), F.col("event_id").alias("timestamp_s"), F.lit(0).cast("long").alias("timestamp_ns"))
    return joins.with_overrides(rec, dim).select("event_id", *rounded(6, lat=F.col("lat"), lon=F.col("lon")), "alt")


# ---- the whole solver --------------------------------------------------------------


@query("SELECT count(*) AS groups, true AS each_has_a_record, true AS some_are_solved, true AS nine_in_ten_within_400_m FROM events")
def solver_truth(spark, sf):
    """Every group of four sensors has one record; some are fixes, and those are near
    where the aircraft was."""
    groups = syn.flights(spark, sf)
    records = solve.solve_groups(groups)
    # one row a message of both, so that the groups are solved once
    g = groups.select("raw_msg", "true_lat", "true_lon", F.lit(1).alias("g"))
    r = records.select(F.coalesce("fix.raw_msg", "unsolved_group.raw_msg").alias("raw_msg"), F.col("fix.lat").alias("lat"), F.col("fix.lon").alias("lon"), (F.col("kind") == "fix").alias("fixed"), F.lit(1).alias("r"))
    both = g.unionByName(r, allowMissingColumns=True).groupBy("raw_msg")
    both = both.agg(F.count("g").alias("g"), F.count("r").alias("r"), F.count_if("fixed").alias("fixes"), *[F.max(c).alias(c) for c in ("true_lat", "true_lon", "lat", "lon")])
    off = F.sqrt(F.pow((F.col("lat") - F.col("true_lat")) * 111_320, 2) + F.pow((F.col("lon") - F.col("true_lon")) * 71_000, 2))
    counted = both.agg(F.coalesce(F.sum("g"), F.lit(0)).alias("groups"), F.coalesce(F.sum("r"), F.lit(0)).alias("all"), F.coalesce(F.sum("fixes"), F.lit(0)).alias("fixes"), (F.sum((off <= 400).cast("int")) >= 0.9 * F.count(off)).alias("near"))
    return counted.select("groups", (F.col("groups") == F.col("all")).alias("each_has_a_record"), (F.col("fixes") * 20 > F.col("groups")).alias("some_are_solved"), F.col("near").alias("nine_in_ten_within_400_m"))


from skyweft.plans import solving  # noqa: E402, F401  registers its queries, which use this module
