"""Registered queries over the whole solver, tracker and served results.

Aircraft of known place, derived from ``events``, are heard without noise by sensors around
them, so that the SQL can say what must come out: where the aircraft is, and by the
rules of geometry, range, priors and clocks, which groups are no fixes and why. Places are
whole thousandths of a degree; solutions are within metres, so rounding to thousandths gives
them back.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweft.config import Config
from skyweft.functions import geo
from skyweft.operators import clock, snapshot, solve, track
from skyweft.operators import solver_np as S
from skyweft.plans import synthetic as syn
from skyweft.plans.production import _gdop3_sql, _long_messages, each
from skyweft.plans.registry import ORACLES, QUERIES, _ecef, query, rounded
from skyweft.plans.synthetic import events, sql
from skyweft.schemas import FIX, GROUP, TRACK

#: Sensors around an aircraft: degrees north and east of it, and metres above the ground.
AROUND = ((0.3, 0.0, 60.0), (-0.2, 0.35, 95.0), (-0.25, -0.3, 130.0), (0.1, 0.5, 165.0), (0.35, -0.4, 200.0), (-0.4, 0.1, 235.0))
FAR_AWAY = (6.0, 0.0, 60.0)
_PLACE = "50 + (event_id % 700) / 1000.0::DOUBLE AS lat, -6 + (event_id % 1300) / 1000.0::DOUBLE AS lon, (15000 + event_id % 200 * 100)::DOUBLE AS alt_ft"
_FEET = repr(geo.FEET)


def placed(spark, sf, *more: str) -> DataFrame:
    """event_id, lat, lon and alt_ft of an aircraft for each event."""
    i = F.col("event_id")
    return events(spark, sf, "event_id", *more).select("event_id", *more, (F.lit(50.0) + (i % 700) / 1000).alias("lat"), (F.lit(-6.0) + (i % 1300) / 1000).alias("lon"), (F.lit(15_000.0) + i % 200 * 100).alias("alt_ft"))


def heard_at(lat: Column, lon: Column, alt_ft: Column, t_s: Column, sensors, late_m: Column | None = None) -> Column:
    """Receptions by sensors of an aircraft at ``lat``, ``lon``: ranges over light's mean speed.

    ``late_m`` puts the last sensor's time behind by so many metres.
    """
    x = geo.lla_to_ecef(lat, lon, alt_ft * geo.FEET)
    out = []
    for k, (north, east, up) in enumerate(sensors):
        a, b = lat + north, lon + east
        v = geo.effective_velocity(F.lit(up), alt_ft * geo.FEET)
        far = geo.distance(x, geo.lla_to_ecef(a, b, F.lit(up)))
        if late_m is not None and k == len(sensors) - 1:
            far = far + late_m
        ns = F.round(far / v * 1e9).cast("long")
        out.append(F.struct(F.lit(k).cast("long").alias("sensor_id"), a.alias("lat"), b.alias("lon"), F.lit(up).alias("alt"), t_s.cast("long").alias("timestamp_s"), ns.alias("timestamp_ns")))
    return F.array(*out)


def group_of(df: DataFrame, receptions: Column, t_s: Column, altitude: Column, **extra: Column) -> DataFrame:
    """Groups as the solver reads them; the message is the event's number and its second."""
    none = F.lit(None).cast("string")
    return df.select(
        F.col("event_id").cast("string").alias("icao"), F.lit(20).alias("df_type"), altitude.cast("double").alias("altitude_ft"), none.alias("squawk"),
        F.concat_ws("/", F.col("event_id"), t_s.cast("long")).alias("raw_msg"), F.size(receptions).alias("num_sensors"), receptions.alias("receptions"), (t_s.cast("long") * 1_000_000_000).alias("t_ns"), *[c.alias(n) for n, c in extra.items()],
    )


def outcome(records: DataFrame) -> DataFrame:
    """What became of each group: kind, reason, and a fix's place and sensors."""
    return records.select(F.col("icao").cast("long").alias("event_id"), F.floor(F.col("t_ns") / 1_000_000_000).alias("t"), "kind", "reason", F.round("fix.lat", 3).alias("lat"), F.round("fix.lon", 3).alias("lon"), "fix.num_sensors")


def _around_sql(n: str) -> str:
    """Unit vectors from the first ``n`` sensors to the aircraft of ``a``."""
    rows = ", ".join(f"({k}, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for k, (a, b, c) in enumerate(AROUND))
    return f"""x AS (SELECT *, {_ecef('lat', 'lon', f'(alt_ft * {_FEET})')} FROM a),
s AS (SELECT x.*, k, {_ecef('(lat + dlat)', '(lon + dlon)', 'up', 's')} FROM x, (VALUES {rows}) v(k, dlat, dlon, up) WHERE k < {n}),
u AS (SELECT event_id, (x - sx) / r AS ux, (y - sy) / r AS uy, (z - sz) / r AS uz FROM (SELECT *, sqrt(pow(sx - x, 2) + pow(sy - y, 2) + pow(sz - z, 2)) AS r FROM s)), {_gdop3_sql('u', 'event_id')}"""


@query(f"""WITH a AS (SELECT event_id, {_PLACE}, 4 + event_id % 3 AS n FROM events), {_around_sql('n')}
SELECT event_id, 0::BIGINT AS t, CASE WHEN gdop > {S.MAX_GDOP} THEN 'unsolved_group' ELSE 'fix' END AS kind, CASE WHEN gdop > {S.MAX_GDOP} THEN 'gdop_exceeded' END AS reason,
  CASE WHEN gdop <= {S.MAX_GDOP} THEN round(lat, 3) END AS lat, CASE WHEN gdop <= {S.MAX_GDOP} THEN round(lon, 3) END AS lon, CASE WHEN gdop <= {S.MAX_GDOP} THEN n END::INT AS num_sensors FROM a JOIN g USING (event_id)""")
def solved_places(spark, sf):
    """Four to six sensors: the aircraft's place, unless the geometry is too poor."""
    p = placed(spark, sf)
    n = F.col("event_id") % 3 + 4
    every = heard_at(F.col("lat"), F.col("lon"), F.col("alt_ft"), F.lit(0), AROUND)
    return outcome(solve.solve_groups(group_of(p, F.slice(every, F.lit(1), n.cast("int")), F.lit(0), F.col("alt_ft"))))


@query(f"""SELECT event_id, 0::BIGINT AS t, CASE WHEN far THEN 'unsolved_group' ELSE 'fix' END AS kind, CASE WHEN far THEN 'range_exceeded' END AS reason,
  CASE WHEN NOT far THEN round(lat, 3) END AS lat, CASE WHEN NOT far THEN round(lon, 3) END AS lon, CASE WHEN NOT far THEN 3 END::INT AS num_sensors FROM (SELECT event_id, {_PLACE}, event_id % 4 = 3 AS far FROM events)""")
def solved_by_three(spark, sf):
    """Three sensors and an altitude; one of them over 500 km off is too far."""
    p = placed(spark, sf)
    at = lambda sensors: heard_at(F.col("lat"), F.col("lon"), F.col("alt_ft"), F.lit(0), sensors)
    receptions = F.when(F.col("event_id") % 4 == 3, at((*AROUND[:2], FAR_AWAY))).otherwise(at(AROUND[:3]))
    return outcome(solve.solve_groups(group_of(p, receptions, F.lit(0), F.col("alt_ft"))))


_PAIR_CASE = f"""SELECT event_id, t, c, lat, lon FROM (SELECT event_id, {_PLACE}, event_id % 6 AS c FROM events), (VALUES (0), (2)) v(t)"""


@query(f"""SELECT event_id, t::BIGINT AS t, kind, reason, CASE WHEN kind = 'fix' THEN round(lat, 3) END AS lat, CASE WHEN kind = 'fix' THEN round(lon, 3) END AS lon, CASE WHEN kind = 'fix' THEN CASE WHEN t = 0 THEN 3 ELSE 2 END END::INT AS num_sensors
FROM (SELECT *, CASE WHEN c = 0 AND t = 0 THEN 'skipped' WHEN c IN (0, 3) AND t = 2 THEN 'unsolved_group' WHEN c = 4 AND t = 0 THEN 'failed' WHEN c IN (1, 4) AND t = 2 THEN 'unsolved_group' ELSE 'fix' END AS kind,
  CASE WHEN c = 0 AND t = 0 THEN 'too_few_sensors' WHEN c IN (0, 4) AND t = 2 THEN 'no_prior_2sensor' WHEN c = 4 AND t = 0 THEN 'too_few_sensors' WHEN c = 1 AND t = 2 THEN 'pair_variance_exceeded' WHEN c = 3 AND t = 2 THEN 'residual_exceeded' END AS reason
  FROM ({_PAIR_CASE}))""")
def solved_by_two(spark, sf):
    """Three sensors, then two: by the prior that the first fix gives. One sensor is too few,
    and so are three without an altitude; two need a prior that their times bear out, and sure clocks."""
    c = F.col("event_id") % 6
    p = placed(spark, sf)
    at = lambda t, sensors, lat=F.col("lat"): heard_at(lat, F.col("lon"), F.col("alt_ft"), F.lit(t), sensors)
    first = group_of(p, F.when(c == 0, at(0, AROUND[:1])).otherwise(at(0, AROUND[:3])), F.lit(0), F.when(c != 4, F.col("alt_ft")), pair_variance=F.lit(None).cast("double"))
    # a told position 18 km off is the prior of case 3, which its two sensors do not bear out
    told = {"cpr_lat": F.when(c == 3, F.col("lat") + 0.16), "cpr_lon": F.when(c == 3, F.col("lon") + 0.16), "cpr_alt_ft": F.when(c == 3, F.col("alt_ft"))}
    second = group_of(p, at(2, AROUND[:2]), F.lit(2), F.col("alt_ft"), pair_variance=F.when(c == 1, 60e-12).otherwise(40e-12), **told)
    return outcome(solve.solve_groups(first.unionByName(second, allowMissingColumns=True)))


@query(f"""SELECT event_id, t::BIGINT AS t, CASE WHEN t = 4 AND told = 0 THEN 'unsolved_group' ELSE 'fix' END AS kind, CASE WHEN t = 4 AND told = 0 THEN 'delegated_2sensor_prediction' END AS reason,
  CASE WHEN t < 4 OR told > 0 THEN round(lat, 3) END AS lat, CASE WHEN t < 4 OR told > 0 THEN round(lon, 3) END AS lon, CASE WHEN t < 4 THEN 3 WHEN told > 0 THEN 2 END::INT AS num_sensors
FROM (SELECT event_id, {_PLACE}, event_id % 2 AS told FROM events), (VALUES (0), (2), (4)) v(t)""")
def delegated_pairs(spark, sf):
    """After two solutions two-sensor groups are left to the tracker, unless the last position
    was told by the aircraft and so has no residual."""
    p = placed(spark, sf)
    at = lambda t, sensors: heard_at(F.col("lat"), F.col("lon"), F.col("alt_ft"), F.lit(t), sensors)
    groups = [group_of(p, at(t, AROUND[:3] if t < 4 else AROUND[:2]), F.lit(t), F.col("alt_ft")) for t in (0, 2, 4)]
    told = F.when((F.col("t_ns") == 4_000_000_000) & (F.col("event_id") % 2 == 1), 1.0)
    both = groups[0].unionByName(groups[1]).unionByName(groups[2]).withColumn("event_id", F.col("icao").cast("long"))
    both = both.join(p.select("event_id", F.col("lat").alias("la"), F.col("lon").alias("lo"), "alt_ft"), "event_id")
    both = both.withColumns({"cpr_lat": told * F.col("la"), "cpr_lon": told * F.col("lo"), "cpr_alt_ft": told * F.col("alt_ft")})
    return outcome(solve.solve_groups(both, Config(delegate_2sensor_min_solves=2)))


@query(f"""SELECT event_id, t::BIGINT AS t, round(CASE WHEN t = 0 AND event_id % 3 = 1 THEN alt_ft + 25 ELSE alt_ft END, 1) AS alt_ft FROM (SELECT event_id, {_PLACE} FROM events), (VALUES (0), (2)) v(t)""")
def effective_altitudes(spark, sf):
    """A fix's altitude: the group's own; else its position message's; else, to the foot, the one of
    the aircraft's last position."""
    c = F.col("event_id") % 3
    p = placed(spark, sf)
    own = F.when(c == 0, F.col("alt_ft")).when(c == 1, F.col("alt_ft") + 25)
    at = lambda t, alt: heard_at(F.col("lat"), F.col("lon"), alt, F.lit(t), AROUND[:3])
    told = {"cpr_lat": F.col("lat"), "cpr_lon": F.col("lon"), "cpr_alt_ft": F.when(c == 2, F.col("alt_ft"))}
    first = group_of(p, at(0, F.coalesce(own, F.col("alt_ft"))), F.lit(0), own, **told)
    # the second of case 1 brings its own again, so that what was cached 25 feet higher does not matter
    second = group_of(p, at(2, F.col("alt_ft")), F.lit(2), F.when(c == 1, F.col("alt_ft")), cpr_lat=F.lit(None).cast("double"), cpr_lon=F.lit(None).cast("double"), cpr_alt_ft=F.lit(None).cast("double"))
    r = solve.solve_groups(first.unionByName(second))
    return r.select(F.col("icao").cast("long").alias("event_id"), F.floor(F.col("t_ns") / 1_000_000_000).alias("t"), F.round("fix.alt_ft", 1).alias("alt_ft"))


@query(f"""WITH a AS (SELECT event_id, {_PLACE}, 6 - event_id % 2 AS n FROM events), {_around_sql('n')}
SELECT event_id, CASE WHEN gdop <= {S.MAX_GDOP} THEN n END::INT AS num_sensors, CASE WHEN gdop <= {S.MAX_GDOP} THEN n = 5 END AS dropped, CASE WHEN gdop <= {S.MAX_GDOP} THEN round(lat, 3) END AS lat, CASE WHEN gdop <= {S.MAX_GDOP} THEN round(lon, 3) END AS lon FROM a JOIN g USING (event_id)""")
def late_sensors(spark, sf):
    """Six sensors, of which one is late by 20 to 40 km in every other group: it is dropped. The
    geometry of those that stay decides on the fix."""
    p = placed(spark, sf)
    i = F.col("event_id")
    at = heard_at(F.col("lat"), F.col("lon"), F.col("alt_ft"), F.lit(0), AROUND, F.when(i % 2 == 1, F.lit(20_000.0) + i % 20 * 1000).otherwise(0.0))
    r = solve.solve_groups(group_of(p, at, F.lit(0), F.col("alt_ft")))
    return r.select(F.col("icao").cast("long").alias("event_id"), "fix.num_sensors", F.col("fix.solve_method").endswith("_drop1").alias("dropped"), F.round("fix.lat", 3).alias("lat"), F.round("fix.lon", 3).alias("lon"))


@query(f"""SELECT event_id, t::BIGINT AS t, CASE WHEN t = 6 THEN 'prediction_aided_2sensor' ELSE 'frisch_toa' END AS solve_method, (1 + t / 2)::INT AS track_quality, round(lat, 3) AS lat, round(lon, 3) AS lon
FROM (SELECT event_id, {_PLACE} FROM events), (VALUES (0), (2), (4), (6)) v(t) WHERE t < 6 OR event_id % 3 = 0""")
def aided_tracks(spark, sf):
    """Three fixes of one place establish a track; a group of two sensors that was not solved is
    solved around its prediction, if it is near that (not 60 km off), and if it tells an altitude."""
    p = placed(spark, sf)
    i = F.col("event_id")
    value = lambda t: {"icao": i.cast("string"), "lat": F.col("lat"), "lon": F.col("lon"), "alt_ft": F.col("alt_ft"), "residual_m": F.lit(10.0), "quality_residual_m": F.lit(10.0), "gdop": F.lit(2.0), "num_sensors": F.lit(4), "solve_method": F.lit("frisch_toa"), "timestamp_s": F.lit(t), "timestamp_ns": F.lit(0), "df_type": F.lit(20), "squawk": F.lit(None), "raw_msg": F.concat_ws("/", i, F.lit(t)), "t0_s": F.lit(0.0)}
    fix = lambda t: F.struct(*[value(t)[f.name].cast(f.dataType).alias(f.name) for f in FIX.fields])
    null = lambda kind: F.lit(None).cast(kind)
    fixes = [p.select(F.lit(t * 1_000_000_000).cast("long").alias("t_ns"), i.cast("string").alias("icao"), fix(t).alias("fix"), null(GROUP).alias("unsolved_group")) for t in (0, 2, 4)]
    off = F.when(i % 3 == 1, 0.5).otherwise(0.0)
    x = geo.lla_to_ecef(F.col("lat") + off, F.col("lon") + off, F.col("alt_ft") * geo.FEET)
    heard = []
    for k, (north, east, up) in enumerate(AROUND[:2]):
        a, b = F.col("lat") + north, F.col("lon") + east
        ns = F.round(geo.distance(x, geo.lla_to_ecef(a, b, F.lit(up))) / geo.effective_velocity(F.lit(up), F.col("alt_ft") * geo.FEET) * 1e9).cast("long")
        heard.append(F.struct(F.lit(k).cast("long").alias("sensor_id"), a.alias("lat"), b.alias("lon"), F.lit(up).alias("alt"), F.lit(6).cast("long").alias("timestamp_s"), ns.alias("timestamp_ns")))
    g = {"icao": i.cast("string"), "df_type": F.lit(20), "altitude_ft": F.when(i % 3 != 2, F.col("alt_ft")), "squawk": F.lit(None), "raw_msg": F.concat_ws("/", i, F.lit(6)), "num_sensors": F.lit(2), "receptions": F.array(*heard)}
    group = F.struct(*[g[f.name].cast(f.dataType).alias(f.name) for f in GROUP.fields])
    last = p.select(F.lit(6_000_000_000).cast("long").alias("t_ns"), i.cast("string").alias("icao"), null(FIX).alias("fix"), group.alias("unsolved_group"))
    records = fixes[0].unionByName(fixes[1]).unionByName(fixes[2]).unionByName(last)
    out = track.tracks(records)
    return out.select(F.col("icao").cast("long").alias("event_id"), F.col("timestamp_s").alias("t"), "solve_method", "track_quality", F.round("lat", 3).alias("lat"), F.round("lon", 3).alias("lon"))


@query("""SELECT event_id % 50 AS n, count(*) AS groups FROM events WHERE event_id % 5 <> 4 AND event_id % 3 <> 0 AND event_id % 40 * 10 < 200 GROUP BY n""")
def own_training(spark, sf):
    """Groups whose fix may train the clocks: it is good and a pair's clocks were known."""
    i = F.col("event_id")
    value = {"lat": F.lit(50.0), "lon": F.lit(-5.0), "alt_ft": F.lit(0.0), "quality_residual_m": (i % 40 * 10).cast("double"), "raw_msg": i.cast("string")}
    fix = F.struct(*[value.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FIX.fields])
    key = {"icao": F.lit("A"), "raw_msg": i.cast("string"), "t_ns": i}
    e = events(spark, sf, "event_id")
    records = e.select(F.lit("A").alias("icao"), i.alias("t_ns"), F.when(i % 5 != 4, fix).alias("fix"))
    groups = e.select(*[c.alias(n) for n, c in key.items()], F.array().cast(GROUP["receptions"].dataType).alias("receptions"))
    known = e.select(*[c.alias(n) for n, c in key.items()], (i % 3 != 0).alias("calibrated"))
    return clock.own_references(records, groups, known).groupBy((F.col("t_ns") % 50).alias("n")).agg(F.count("*").alias("groups"))


# ---- messages and what is served ---------------------------------------------------


@query("""SELECT event_id, tc::INT AS tc, CASE WHEN tc BETWEEN 9 AND 18 AND (c & 16) <> 0 THEN ((((c & 4064) >> 1) | (c & 15)) * 25 - 1000)::INT END AS alt_ft
FROM (SELECT event_id, event_id % 32 AS tc, ((event_id * 2654435761 + 97) % 4503599627370496 % 2251799813685248 >> 36) & 4095 AS c FROM events) WHERE tc NOT BETWEEN 9 AND 18 OR (c & 16) <> 0""")
def df17_altitude(spark, sf):
    """The altitude that a decoded position message carries, in its 25-foot code."""
    from skyweft.operators.decode import decode

    me = F.col("raw_msg").substr(9, 14)
    # a generator in between: what makes the message would else stand wherever a field is read
    m = decode(_long_messages(spark, sf).select("event_id", F.explode(F.array("m")).alias("raw_msg"))).select("event_id", F.col("altitude_ft").alias("alt_ft"), F.conv(me.substr(1, 2), 16, 10).cast("int").alias("head"), F.conv(me.substr(3, 3), 16, 10).cast("int").alias("c"))
    tc = F.shiftright("head", 3)
    return m.where(~tc.between(9, 18) | (F.col("c").bitwiseAND(F.lit(16)) != 0)).select("event_id", tc.alias("tc"), "alt_ft")


def _track_rows(spark, sf) -> DataFrame:
    """A table of track rows of the events' users."""
    i = F.col("event_id")
    e = events(spark, sf, "event_id", "user_id", "t_us", "value")
    value = {"icao": F.col("user_id").cast("string"), "lat": F.lit(50.0) + i % 1000 * 0.001234567, "lon": F.lit(-5.0) - i % 1000 * 0.00123456, "alt_ft": i % 400 * 100 + 0.4, "timestamp_s": F.floor(F.col("t_us") / 1_000_000), "timestamp_ns": F.col("t_us") % 1_000_000 * 1000, "raw_msg": F.lpad(i.cast("string"), 12, "0"),
             "heading_deg": i % 3600 * 0.1 + 0.04, "speed_kts": i % 500 + 0.26, "vrate_fpm": i % 50 * 64 - 1600, "track_quality": i % 9, "positions_count": i % 9, "cov_matrix": F.array(F.array(i % 90 + 100.0, F.lit(20.0)), F.array(F.lit(20.0), i % 70 + 50.0))}
    return e.select(*[value.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TRACK.fields])


_TRACKS = f"""t AS (SELECT user_id, event_id, t_us, 50 + event_id % 1000 * 0.001234567::DOUBLE AS lat, -5 - event_id % 1000 * 0.00123456::DOUBLE AS lon, row_number() OVER (PARTITION BY user_id ORDER BY t_us DESC, event_id DESC) AS k FROM ({sql('user_id', 'event_id', 't_us')}))"""


@query(f"""WITH {_TRACKS}, p AS (SELECT user_id, count(*) AS n, sum(round(lat, 6)) AS lats, sum(round(lon, 6)) AS lons FROM t WHERE k <= 20 GROUP BY user_id)
SELECT user_id::VARCHAR AS icao, round(lat, 6) AS lat, round(lon, 6) AS lon, (event_id % 400 * 100)::DOUBLE AS alt_ft, round(event_id % 3600 * 0.1::DOUBLE, 1) AS heading_deg, round(event_id % 500 + 0.3::DOUBLE, 1) AS speed_kts, (event_id % 50 * 64 - 1600)::DOUBLE AS vrate_fpm, (event_id % 9)::INT AS track_quality,
  CASE WHEN n >= 2 THEN n END AS points, CASE WHEN n >= 2 THEN round(lats, 6) END AS lats, CASE WHEN n >= 2 THEN round(lons, 6) END AS lons FROM t JOIN p USING (user_id) WHERE k = 1""")
def track_summaries(spark, sf):
    """Each aircraft's latest row in round numbers, with its last 20 positions."""
    s = snapshot.summary(_track_rows(spark, sf))
    total = lambda k: F.round(F.aggregate("positions", F.lit(0.0), lambda a, p: a + F.get(p, F.lit(k))), 6)
    points = F.when(F.col("positions").isNotNull(), F.size("positions")).cast("long")
    return s.select("icao", "lat", "lon", "alt_ft", "heading_deg", "speed_kts", "vrate_fpm", "track_quality", points.alias("points"), total(0).alias("lats"), total(1).alias("lons"))


@query(f"""WITH {_TRACKS}, p AS (SELECT user_id, count(*) AS n, sum(lat) AS lats FROM t WHERE k <= 50 GROUP BY user_id), a AS (SELECT *, event_id % 400 * 100 + 0.4 AS alt FROM t JOIN p USING (user_id) WHERE k = 1)
SELECT user_id::VARCHAR AS icao, event_id::BIGINT AS event_id, CASE WHEN alt < 10000 THEN 'low' WHEN alt < 25000 THEN 'mid' WHEN alt < 35000 THEN 'high' ELSE 'top' END AS band, CASE WHEN n >= 2 THEN n END AS points, CASE WHEN n >= 2 THEN round(lats, 4) END AS lats FROM a""")
def served_snapshot(spark, sf):
    """Each aircraft's latest row, colour band and trail of 50; no trail of one point."""
    s = snapshot.snapshot(_track_rows(spark, sf))
    points = F.when(F.col("trail").isNotNull(), F.size("trail")).cast("long")
    return s.select("icao", F.col("raw_msg").cast("long").alias("event_id"), "band", points.alias("points"), F.round(F.aggregate("trail", F.lit(0.0), lambda a, p: a + F.get(p, F.lit(1))), 4).alias("lats"))


#: Sensors of the suppliers, and cells over their extent.
_NETWORK = """net AS (SELECT s_suppkey AS id, 49.0::DOUBLE + (s_suppkey * 37 % 100) / 25.0::DOUBLE AS slat, -8.0::DOUBLE + (s_suppkey * 53 % 100) / 20.0::DOUBLE AS slon, s_suppkey % 50 * 20.0::DOUBLE AS salt FROM supplier)"""
_CELLS = """e AS (SELECT min(slat) AS la, max(slat) AS lb, min(slon) AS oa, max(slon) AS ob FROM net), c AS (SELECT i AS event_id, la + (i // 20) * ((lb - la) / 19) AS glat, oa + (i % 20) * ((ob - oa) / 19) AS glon FROM e, (SELECT unnest(range(400)) AS i))"""


def network(spark, sf) -> tuple[DataFrame, dict]:
    """The suppliers as sensors, and a grid over their extent: one row of four numbers."""
    k = F.col("s_suppkey")
    sensors = syn.table(spark, sf, "supplier").select(k.alias("sensor_id"), ((k * 37 % 100) / 25 + 49.0).alias("lat"), ((k * 53 % 100) / 20 - 8.0).alias("lon"), (k % 50 * 20.0).alias("alt"))
    a = sensors.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    return sensors, snapshot.GRID | {"lat": (a[0], a[1]), "lon": (a[2], a[3])}


def gdop3d_grid(spark, sf):
    """3D dilution of all sensors over the grid of their extent, as it is served."""
    sensors, spec = network(spark, sf)
    return snapshot.gdop_grid(snapshot.grid(spark, spec), sensors)


QUERIES["gdop3d_grid"] = gdop3d_grid
ORACLES["gdop3d_grid"] = f"""WITH {_NETWORK}, {_CELLS}, s AS (SELECT id, {_ecef('slat', 'slon', 'salt', 's')} FROM net), x AS (SELECT event_id, glat, glon, {_ecef('glat', 'glon', '9144.0::DOUBLE')} FROM c),
u AS (SELECT event_id, (x - sx) / r AS ux, (y - sy) / r AS uy, (z - sz) / r AS uz FROM (SELECT *, sqrt(pow(sx - x, 2) + pow(sy - y, 2) + pow(sz - z, 2)) AS r FROM x, s)),
{_gdop3_sql('u', 'event_id')} SELECT round(glat, 4) AS lat, round(glon, 4) AS lon, round(gdop, 2) AS gdop FROM g JOIN c USING (event_id)"""


def gdop2d_grid(spark, sf):
    """The solver's 2D dilution of all sensors over the same grid."""
    sensors, spec = network(spark, sf)

    def dilution(lat, lon, m, nearest):
        return S.gdop_2d_of_sums(S.lla_to_ecef(lat, lon, snapshot.GRID["alt_ft"] * geo.FEET), m, nearest)

    raw = snapshot.gdop_of_sums(snapshot.direction_sums(snapshot.grid(spark, spec), sensors), dilution)
    return raw.select(*rounded(4, lat=F.col("lat"), lon=F.col("lon"), gdop=F.col("gdop")))


QUERIES["gdop2d_grid"] = gdop2d_grid
#: In the plane across the position vector, as the solver has it.
ORACLES["gdop2d_grid"] = f"""WITH {_NETWORK}, {_CELLS}, s AS (SELECT id, {_ecef('slat', 'slon', 'salt', 's')} FROM net), x AS (SELECT event_id, glat, glon, {_ecef('glat', 'glon', '9144.0::DOUBLE')} FROM c),
v AS (SELECT *, sqrt(x * x + y * y + z * z) AS r, sqrt(x * x + y * y) AS h FROM x),
d AS (SELECT event_id, (-y * (x - sx) + x * (y - sy)) / h / far AS e, (-x * z * (x - sx) - y * z * (y - sy) + h * h * (z - sz)) / (h * r) / far AS n FROM (SELECT *, sqrt(pow(sx - x, 2) + pow(sy - y, 2) + pow(sz - z, 2)) AS far FROM v, s)),
m AS (SELECT event_id, sum(e * e) AS ee, sum(n * n) AS nn, sum(e * n) AS en FROM d GROUP BY event_id)
SELECT round(glat, 4) AS lat, round(glon, 4) AS lon, round(sqrt((ee + nn) / (ee * nn - en * en)), 4) AS gdop FROM m JOIN c USING (event_id)"""


@query("""SELECT event_id, round(least(12.0::DOUBLE, greatest(1.0::DOUBLE, 500.0::DOUBLE / greatest(value, 1.0::DOUBLE))), 6) AS w FROM events""")
def pred_weight(spark, sf):
    """Weight of a prior by its uncertainty, of solver and tracker."""
    return each(events(spark, sf, "event_id", "value"), lambda c: {"event_id": c["event_id"], "w": S.prior_weight(c["value"])}, "event_id long, w double").select("event_id", F.round("w", 6).alias("w"))


@query("""SELECT event_id, round(CASE WHEN event_id % 3 = 0 THEN 500.0::DOUBLE WHEN event_id % 3 = 1 THEN greatest(50.0::DOUBLE, 25 * dt * dt + value) ELSE greatest(100.0::DOUBLE, 300 * dt + value) END, 6) AS u
FROM (SELECT event_id, value, (event_id % 120) / 10.0::DOUBLE AS dt FROM events)""")
def prior_unc(spark, sf):
    """Uncertainty of a prior by its age, residual and velocity."""
    work = lambda c: {"event_id": c["event_id"], "u": solve.uncertainty(c["event_id"] % 3 != 0, c["event_id"] % 3 == 1, c["event_id"] % 120 / 10.0, c["value"])}
    return each(events(spark, sf, "event_id", "value"), work, "event_id long, u double").select("event_id", F.round("u", 6).alias("u"))


@query("""SELECT event_id, round(CASE WHEN n = 2 THEN least(3000.0::DOUBLE, greatest(500.0::DOUBLE, CASE WHEN g > 0 THEN q * g * 3 ELSE q * 8 END))
  WHEN q > 0 THEN least(2000.0::DOUBLE, greatest(50.0::DOUBLE, CASE WHEN g > 0 THEN q * g ELSE q * 2 END)) ELSE 200.0::DOUBLE END, 6) AS noise_m
FROM (SELECT event_id, 2 + event_id % 4 AS n, CASE WHEN event_id % 10 = 0 THEN 0.0::DOUBLE ELSE value END AS q, (event_id % 6) * 1.5::DOUBLE AS g FROM events)""")
def meas_noise(spark, sf):
    """The tracker's measurement noise by sensors, quality and geometry."""
    work = lambda c: {"event_id": c["event_id"], "noise_m": track.noise(2 + c["event_id"] % 4, np.where(c["event_id"] % 10 == 0, 0.0, c["value"]), c["event_id"] % 6 * 1.5)}
    return each(events(spark, sf, "event_id", "value"), work, "event_id long, noise_m double").select("event_id", F.round("noise_m", 6).alias("noise_m"))
