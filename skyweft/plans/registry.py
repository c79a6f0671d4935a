"""Registered queries, each with the SQL that must give the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweft.functions import cpr, geo, modes, scalar
from skyweft.operators import aggregates, clock, correlate, joins, snapshot, solve, track, union, windows
from skyweft.plans import synthetic as syn
from skyweft.plans.synthetic import SENSORS, events, sql, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Six hours in microseconds: the correlation window on the events' time scale.
WINDOW_US = 21_600_000_000
#: Two days: how old a prior may be.
TOLERANCE_US = 172_800_000_000


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)


def rounded(digits: int, **cols) -> list:
    return [F.round(c, digits).alias(n) for n, c in cols.items()]


# ---- sources and filters -----------------------------------------------------------


@query("SELECT event_id, user_id, event_type FROM events WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL AND event_type <> ''")
def scan_required(spark, sf):
    from skyweft.operators.decode import required

    return required(events(spark, sf, "event_id", "user_id", "event_type"), "event_id", "user_id", "event_type")


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def json_field(spark, sf):
    return events(spark, sf, "event_id", "props").select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query("SELECT event_id, lat, lon FROM (SELECT event_id, (event_id % 2000) / 10.0::DOUBLE - 100 AS lat, (event_id % 4001) / 10.0::DOUBLE - 200 AS lon FROM events) WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180")
def bounds_filter(spark, sf):
    from skyweft.operators.decode import valid_packets

    e = events(spark, sf, "event_id").select("event_id", ((F.col("event_id") % 2000) / 10 - 100).alias("lat"), ((F.col("event_id") % 4001) / 10 - 200).alias("lon"), F.lit(0.0).alias("alt"))
    return valid_packets(e).drop("alt")


@query(f"SELECT event_id, (event_id % 32)::INT AS df_type FROM events WHERE event_id % 32 IN {modes.KNOWN_DF}")
def df_filter(spark, sf):
    return events(spark, sf, "event_id").select("event_id", (F.col("event_id") % 32).cast("int").alias("df_type")).where(F.col("df_type").isin(*modes.KNOWN_DF))


# ---- Mode-S fields -----------------------------------------------------------------


def _message():
    return F.lpad(F.hex("x56"), 14, "0")


@query(f"SELECT event_id, least(x56 >> 51, 24)::INT AS df, ((x56 >> 24) & 8191)::BIGINT AS code, (x56 & 16777215)::BIGINT AS last FROM ({sql('event_id', 'x56')})")
def hex_bits(spark, sf):
    e = events(spark, sf, "event_id", "x56").select("event_id", _message().alias("m"))
    return e.select("event_id", modes.downlink_format("m").alias("df"), modes.bits("m", 19, 13).alias("code"), modes.bits("m", 32, 24).alias("last"))


@query("""SELECT event_id, CASE WHEN (c & 16) <> 0 AND f BETWEEN -1000 AND 100000 THEN f END::INT AS alt_ft
FROM (SELECT event_id, c, (((c & 4064) >> 1) | (c & 15)) * 25 - 1000 AS f FROM (SELECT event_id, event_id % 4096 AS c FROM events))""")
def altitude_q(spark, sf):
    return events(spark, sf, "event_id").select("event_id", modes.altitude_q((F.col("event_id") % 4096).cast("int")).alias("alt_ft"))


def _octal(*bits: int) -> str:
    return "(" + " + ".join(f"((c >> {12 - b}) & 1) * {2 ** (2 - k)}" for k, b in enumerate(bits)) + ")::INT::VARCHAR"


@query(f"SELECT event_id, {_octal(5, 3, 1)} || {_octal(11, 9, 7)} || {_octal(4, 2, 0)} || {_octal(12, 10, 8)} AS squawk FROM (SELECT event_id, event_id % 8192 AS c FROM events)")
def squawk_digits(spark, sf):
    return events(spark, sf, "event_id").select("event_id", modes.squawk_code((F.col("event_id") % 8192).cast("int")).alias("squawk"))


@query(f"""SELECT event_id, xor(list_reduce(list_transform(range(32), lambda i: CASE WHEN (x56 >> (55 - i)) & 1 = 1 THEN ({modes.crc_constants(32)})[i + 1] ELSE 0 END), lambda a, b: xor(a, b)), x56 & 16777215)::BIGINT AS parity
FROM ({sql('event_id', 'x56')})""")
def crc24(spark, sf):
    return events(spark, sf, "event_id", "x56").select("event_id", modes.parity(_message()).cast("long").alias("parity"))


def _nl(lat: str) -> str:
    import math

    return f"CASE WHEN abs({lat}) >= 87 THEN 1 ELSE greatest(1, floor(2 * pi() / acos(greatest(-1, least(1, 1 - {1 - math.cos(math.pi / 30)!r} / (cos(radians({lat})) * cos(radians({lat})))))))) END"


@query(f"""WITH r AS (SELECT event_id, (event_id * 7919 % 131072) / 131072.0::DOUBLE AS ye, (event_id * 104729 % 131072) / 131072.0::DOUBLE AS xe,
  ((event_id * 7919 + event_id % 64) % 131072) / 131072.0::DOUBLE AS yo, ((event_id * 104729 + event_id % 97) % 131072) / 131072.0::DOUBLE AS xo, event_id % 2 = 0 AS newer FROM events),
j AS (SELECT *, floor(59 * ye - 60 * yo + 0.5) AS j FROM r),
l AS (SELECT *, (j - 60 * floor(j / 60) + ye) * 6 AS e0, (j - 59 * floor(j / 59) + yo) * (360.0::DOUBLE / 59) AS o0 FROM j),
z AS (SELECT *, CASE WHEN e0 >= 270 THEN e0 - 360 ELSE e0 END AS e, CASE WHEN o0 >= 270 THEN o0 - 360 ELSE o0 END AS o FROM l),
n AS (SELECT *, {_nl('e')} AS nle, {_nl('o')} AS nlo, CASE WHEN newer THEN e ELSE o END AS lat FROM z),
m AS (SELECT *, floor(xe * (nle - 1) - xo * nle + 0.5) AS m, greatest(CASE WHEN newer THEN nle ELSE nlo - 1 END, 1) AS ni FROM n WHERE nle = nlo AND lat BETWEEN -90 AND 90),
f AS (SELECT *, (360.0::DOUBLE / ni) * (m - ni * floor(m / ni) + CASE WHEN newer THEN xe ELSE xo END) AS lon FROM m)
SELECT event_id, round(lat, 6) AS lat, round(CASE WHEN lon >= 180 THEN lon - 360 ELSE lon END, 6) AS lon FROM f""")
def cpr_global(spark, sf):
    i = F.col("event_id")
    raw = lambda k, d: (i * k + (i % d if d else 0)) % 131072
    place = cpr.global_position(raw(7919, 0), raw(104729, 0), raw(7919, 64), raw(104729, 97), i % 2 == 0)
    out = events(spark, sf, "event_id").select("event_id", place.alias("p")).where("p is not null")
    return out.select("event_id", *rounded(6, lat=F.col("p.lat"), lon=F.col("p.lon")))


# ---- geodesy and error models ------------------------------------------------------

_E2, _EP2 = repr(geo.E2), repr(geo.EP2)


def _ecef(lat: str = "lat", lon: str = "lon", alt: str = "alt_m", p: str = "") -> str:
    n = f"({geo.A} / sqrt(1 - {_E2} * sin(radians({lat})) * sin(radians({lat}))))"
    return (
        f"({n} + {alt}) * cos(radians({lat})) * cos(radians({lon})) AS {p}x, ({n} + {alt}) * cos(radians({lat})) * sin(radians({lon})) AS {p}y, "
        f"({n} * (1 - {_E2}) + {alt}) * sin(radians({lat})) AS {p}z"
    )


@query(f"SELECT event_id, round(x, 3) AS x, round(y, 3) AS y, round(z, 3) AS z FROM (SELECT event_id, {_ecef()} FROM ({sql('event_id', 'lat', 'lon', 'alt_m')}))")
def ecef(spark, sf):
    e = events(spark, sf, "event_id", "lat", "lon", "alt_m").select("event_id", geo.lla_to_ecef("lat", "lon", "alt_m").alias("p"))
    return e.select("event_id", *rounded(3, x=F.col("p.x"), y=F.col("p.y"), z=F.col("p.z")))


_LLA = f"""WITH q AS (SELECT event_id, {_ecef()} FROM ({sql('event_id', 'lat', 'lon', 'alt_m')})),
a AS (SELECT *, sqrt(x * x + y * y) AS p, atan2(z * {geo.A}, sqrt(x * x + y * y) * {geo.B!r}) AS th FROM q),
b AS (SELECT *, atan2(z + {_EP2} * {geo.B!r} * pow(sin(th), 3), p - {_E2} * {geo.A} * pow(cos(th), 3)) AS f FROM a),
c AS (SELECT *, atan2(z + {_E2} * ({geo.A} / sqrt(1 - {_E2} * sin(f) * sin(f))) * sin(f), p) AS g FROM b)
SELECT event_id, round(degrees(g), 6) AS lat, round(degrees(atan2(y, x)), 6) AS lon, round(p / cos(g) - {geo.A} / sqrt(1 - {_E2} * sin(g) * sin(g)), 3) AS alt FROM c"""


@query(_LLA)
def ecef_lla(spark, sf):
    e = events(spark, sf, "event_id", "lat", "lon", "alt_m").select("event_id", geo.lla_to_ecef("lat", "lon", "alt_m").alias("p"))
    e = e.select("event_id", geo.ecef_to_lla("p.x", "p.y", "p.z").alias("q"))
    return e.select("event_id", *rounded(6, lat=F.col("q.lat"), lon=F.col("q.lon")), *rounded(3, alt=F.col("q.alt")))


@query(f"SELECT event_id, round(lat, 6) AS lat, round(lon, 6) AS lon, round(alt_m, 3) AS alt FROM ({sql('event_id', 'lat', 'lon', 'alt_m')})")
def roundtrip(spark, sf):
    return ecef_lla(spark, sf)


@query(f"""SELECT event_id, round({geo.C_VACUUM} / (1 + CASE WHEN abs(alt_m - s) < 1 THEN {geo.REFRACTIVITY} * exp(-{geo.DECAY} * s)
  ELSE {geo.REFRACTIVITY} / ({geo.DECAY} * (alt_m - s)) * (exp(-{geo.DECAY} * s) - exp(-{geo.DECAY} * alt_m)) END), 3) AS v
FROM (SELECT event_id, alt_m, (event_id % 9) * 30.0::DOUBLE AS s FROM ({sql('event_id', 'alt_m')}))""")
def eff_velocity(spark, sf):
    e = events(spark, sf, "event_id", "alt_m")
    return e.select("event_id", *rounded(3, v=geo.effective_velocity((F.col("event_id") % 9) * 30.0, "alt_m")))


@query("""SELECT event_id, CASE WHEN a IS NULL THEN 'grey' WHEN a < 10000 THEN 'low' WHEN a < 25000 THEN 'mid' WHEN a < 35000 THEN 'high' ELSE 'top' END AS band
FROM (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN (event_id % 450) * 100.0::DOUBLE END AS a FROM events)""")
def alt_band(spark, sf):
    i = F.col("event_id")
    return events(spark, sf, "event_id").select("event_id", scalar.altitude_band(F.when(i % 11 != 0, (i % 450) * 100.0)).alias("band"))


@query(f"""WITH v AS (SELECT event_id, radians(lat) AS p, radians(lon) AS l, (event_id % 301) - 150.0::DOUBLE AS vx, (event_id % 211) - 105.0::DOUBLE AS vy, (event_id % 97) - 48.0::DOUBLE AS vz FROM ({sql('event_id', 'lat', 'lon')})),
w AS (SELECT event_id, -sin(l) * vx + cos(l) * vy AS e, -sin(p) * cos(l) * vx - sin(p) * sin(l) * vy + cos(p) * vz AS n, cos(p) * cos(l) * vx + cos(p) * sin(l) * vy + sin(p) * vz AS u FROM v)
SELECT event_id, round(CASE WHEN sqrt(e * e + n * n) < 1 THEN 0 WHEN atan2(e, n) < 0 THEN degrees(atan2(e, n)) + 360 ELSE degrees(atan2(e, n)) END, 5) AS heading_deg,
  round(sqrt(e * e + n * n) * {geo.KNOTS}, 5) AS speed_kts, round(u * {geo.FPM}, 5) AS vrate_fpm FROM w""")
def enu_velocity(spark, sf):
    i = F.col("event_id")
    m = geo.motion("lat", "lon", i % 301 - 150.0, i % 211 - 105.0, i % 97 - 48.0)
    return events(spark, sf, "event_id", "lat", "lon").select("event_id", m.alias("m")).select("event_id", *rounded(5, heading_deg=F.col("m.heading_deg"), speed_kts=F.col("m.speed_kts"), vrate_fpm=F.col("m.vrate_fpm")))


@query(f"""WITH c AS (SELECT event_id, lat, lon, 100.0::DOUBLE + value AS a, (event_id % 50)::DOUBLE AS b, 200.0::DOUBLE + (event_id % 70) AS d FROM ({sql('event_id', 'lat', 'lon', 'value')})),
e AS (SELECT *, {geo.ELLIPSE_SCALE} * sqrt(greatest(0, (a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b))) AS s1, {geo.ELLIPSE_SCALE} * sqrt(greatest(0, (a + d) / 2 - sqrt((a - d) * (a - d) / 4 + b * b))) AS s2, atan2(2 * b, a - d) / 2 AS th, unnest(range({geo.ELLIPSE_POINTS})) AS i FROM c),
p AS (SELECT *, s1 * cos(i * 2 * pi() / {geo.ELLIPSE_POINTS}) AS x, s2 * sin(i * 2 * pi() / {geo.ELLIPSE_POINTS}) AS y FROM e)
SELECT event_id, i::INT AS i, round(lon + (x * cos(th) - y * sin(th)) / ({geo.EQUATOR_M} * cos(radians(lat)) / 360), 7) AS lon, round(lat + (x * sin(th) + y * cos(th)) / {geo.DEGREE_M}, 7) AS lat FROM p""")
def cov_ellipse(spark, sf):
    i = F.col("event_id")
    e = events(spark, sf, "event_id", "lat", "lon", "value")
    pts = geo.covariance_ellipse("lat", "lon", F.col("value") + 100.0, (i % 50).cast("double"), i % 70 + 200.0)
    return e.select("event_id", F.posexplode(pts).alias("i", "p")).select("event_id", "i", *rounded(7, lon=F.get("p", F.lit(0)), lat=F.get("p", F.lit(1))))


# ---- correlation -------------------------------------------------------------------

_FOLD = f"""e AS (SELECT user_id, event_type, event_id, sensor, t_us, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t_us, event_id) AS rn FROM ({sql('user_id', 'event_type', 'event_id', 'sensor', 't_us')})),
f AS (SELECT user_id, event_type, event_id, sensor, t_us, rn, t_us AS anchor FROM e WHERE rn = 1
  UNION ALL SELECT e.user_id, e.event_type, e.event_id, e.sensor, e.t_us, e.rn, CASE WHEN e.t_us - f.anchor <= {WINDOW_US}::BIGINT THEN f.anchor ELSE e.t_us END
  FROM f JOIN e ON e.user_id = f.user_id AND e.event_type = f.event_type AND e.rn = f.rn + 1)"""


def _anchored(spark, sf):
    rows = events(spark, sf, "user_id", "event_type", "event_id", "sensor", "t_us")
    return correlate.anchored(rows, ["user_id", "event_type"], "t_us", ["event_id"], WINDOW_US)


@query(f"WITH RECURSIVE {_FOLD} SELECT user_id, event_type, anchor, count(DISTINCT sensor) AS num_sensors, count(*) AS receptions FROM f GROUP BY ALL HAVING count(DISTINCT sensor) >= 2")
def anchored_groups(spark, sf):
    g = _anchored(spark, sf).groupBy("user_id", "event_type", "anchor").agg(F.countDistinct("sensor").alias("num_sensors"), F.count("*").alias("receptions"))
    return g.where("num_sensors >= 2")


@query(f"""WITH RECURSIVE {_FOLD}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, anchor, sensor ORDER BY t_us, event_id) AS k FROM f)
SELECT user_id, event_type, anchor, sensor, event_id, t_us FROM n WHERE k = 1""")
def first_per_sensor(spark, sf):
    return correlate.first_per(_anchored(spark, sf), ["user_id", "event_type", "anchor"], "sensor", ["t_us", "event_id"])


@query(f"""WITH RECURSIVE {_FOLD}, g AS (SELECT count(*) AS groups, count(*) FILTER (n >= 2) AS kept, sum(c) AS receptions FROM (SELECT count(DISTINCT sensor) AS n, count(*) AS c FROM f GROUP BY user_id, event_type, anchor))
SELECT groups, kept, receptions::BIGINT AS receptions, printf('%.1f%%', round(100.0::DOUBLE * kept / groups, 1)) AS kept_rate FROM g""")
def rates(spark, sf):
    g = _anchored(spark, sf).groupBy("user_id", "event_type", "anchor").agg(F.countDistinct("sensor").alias("n"), F.count("*").alias("c"))
    kept = F.count_if(F.col("n") >= 2)
    return g.agg(F.count("*").alias("groups"), kept.alias("kept"), F.sum("c").alias("receptions"), aggregates.rate(kept, F.count("*")).alias("kept_rate"))


# ---- joins -------------------------------------------------------------------------

_PLACES = "SELECT s_suppkey, 49.0::DOUBLE + (s_suppkey * 37 % 100) / 25.0::DOUBLE AS lat, -8.0::DOUBLE + (s_suppkey * 53 % 100) / 20.0::DOUBLE AS lon FROM supplier"
_USERS = "SELECT DISTINCT user_id, 49.0::DOUBLE + (user_id * 61 % 1000) / 250.0::DOUBLE AS ulat, -8.0::DOUBLE + (user_id * 89 % 1000) / 200.0::DOUBLE AS ulon FROM events"


@query(f"""SELECT user_id, s_suppkey, round(d, 6) AS distance FROM (SELECT user_id, s_suppkey, d, row_number() OVER (PARTITION BY user_id ORDER BY d, s_suppkey) AS n
FROM (SELECT user_id, s_suppkey, sqrt(pow(ulat - lat, 2) + pow(ulon - lon, 2)) AS d FROM ({_USERS}), ({_PLACES})) WHERE d < 0.5) WHERE n = 1""")
def nearest_sensor(spark, sf):
    k, u = F.col("s_suppkey"), F.col("user_id")
    dim = table(spark, sf, "supplier").select("s_suppkey", ((k * 37 % 100) / 25 + 49.0).alias("lat"), ((k * 53 % 100) / 20 - 8.0).alias("lon"))
    users = events(spark, sf, "user_id").distinct().select("user_id", ((u * 61 % 1000) / 250 + 49.0).alias("lat"), ((u * 89 % 1000) / 200 - 8.0).alias("lon"))
    return joins.nearest_place(users, "user_id", dim, "s_suppkey").select("user_id", "s_suppkey", *rounded(6, distance=F.col("distance")))


@query(f"""WITH e AS ({sql('event_id', 'user_id', 'event_type', 'value', 't_us')}),
l AS (SELECT event_id, user_id, t_us FROM e WHERE event_type <> 'purchase'), r AS (SELECT user_id, t_us, max_by(value, event_id) AS value FROM e WHERE event_type = 'purchase' GROUP BY user_id, t_us)
SELECT l.event_id, l.user_id, CASE WHEN l.t_us - r.t_us <= {TOLERANCE_US} THEN r.value END AS prior_value, CASE WHEN l.t_us - r.t_us <= {TOLERANCE_US} THEN l.t_us - r.t_us END AS age
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.t_us >= r.t_us""")
def asof_prior(spark, sf):
    e = events(spark, sf, "event_id", "user_id", "event_type", "value", "t_us")
    right = e.where("event_type = 'purchase'").groupBy("user_id", "t_us").agg(F.max_by("value", "event_id").alias("value"))
    left = e.where("event_type <> 'purchase'").select("event_id", "user_id", "t_us")
    return joins.as_of(left, right, "user_id", "t_us", ["event_id"], ["value"], F.lit(TOLERANCE_US)).drop("t_us")


@query(f"""WITH RECURSIVE {_FOLD}, s AS (SELECT user_id, event_type, anchor, sensor, min(t_us) AS t FROM f GROUP BY ALL)
SELECT a.user_id, a.event_type, a.anchor, a.sensor AS sensor_a, b.sensor AS sensor_b, a.t - b.t AS offset_us FROM s a JOIN s b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.anchor = b.anchor AND a.sensor < b.sensor""")
def pair_offsets(spark, sf):
    keys = ["user_id", "event_type", "anchor"]
    one = _anchored(spark, sf).groupBy(*keys, "sensor").agg(F.min("t_us").alias("t"))
    g = one.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("sensor", "t"))).alias("rs"))
    p = joins.reception_pairs(g, keys, "rs", "sensor")
    return p.select(*keys, F.col("a.sensor").alias("sensor_a"), F.col("b.sensor").alias("sensor_b"), (F.col("a.t") - F.col("b.t")).alias("offset_us"))


@query(f"""WITH e AS ({sql('event_id', 'user_id', 't_us')}),
w AS (SELECT event_id, user_id, last_value(CASE WHEN event_id % 2 = 0 THEN t_us END IGNORE NULLS) OVER h AS et, last_value(CASE WHEN event_id % 2 = 0 THEN event_id END IGNORE NULLS) OVER h AS ei,
  last_value(CASE WHEN event_id % 2 = 1 THEN t_us END IGNORE NULLS) OVER h AS ot, last_value(CASE WHEN event_id % 2 = 1 THEN event_id END IGNORE NULLS) OVER h AS oi
  FROM e WINDOW h AS (PARTITION BY user_id ORDER BY t_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, ei AS even_id, oi AS odd_id, ot - et AS apart_us FROM w WHERE abs(et - ot) < {TOLERANCE_US}""")
def even_odd_pair(spark, sf):
    e = events(spark, sf, "event_id", "user_id", "t_us")
    p = joins.even_odd(e, "user_id", "t_us", ["event_id"], F.col("event_id") % 2 == 1, ["event_id"], F.lit(TOLERANCE_US))
    return p.where("even_t is not null and odd_t is not null").select("event_id", "user_id", F.col("even_event_id").alias("even_id"), F.col("odd_event_id").alias("odd_id"), (F.col("odd_t") - F.col("even_t")).alias("apart_us"))


# ---- windows -----------------------------------------------------------------------


@query(f"""WITH e AS ({sql('event_id', 'user_id', 'value', 't_us')}), w AS (SELECT event_id, value, (t_us - lag(t_us) OVER h) / 1e6::DOUBLE AS dt, lag(value) OVER h AS before FROM e WINDOW h AS (PARTITION BY user_id ORDER BY t_us, event_id))
SELECT event_id, round(dt, 6) AS dt, CASE WHEN dt > 0.1 AND dt < 86400 THEN round((value - before) / dt, 9) END AS rate FROM w""")
def lag_velocity(spark, sf):
    e = events(spark, sf, "event_id", "user_id", "value", "t_us")
    w = windows.lag_rate(e, "user_id", ["t_us", "event_id"], "t_us", 1e6, ["value"], 0.1, 86400.0)
    return w.select("event_id", *rounded(6, dt=F.col("dt")), *rounded(9, rate=F.col("rate_value")))


@query(f"SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY t_us, event_id)::INT AS track_quality FROM ({sql('event_id', 'user_id', 't_us')})")
def running_quality(spark, sf):
    return events(spark, sf, "event_id", "user_id", "t_us").select("event_id", windows.running_count("user_id", ["t_us", "event_id"]).alias("track_quality"))


@query(f"""SELECT event_id, last_value(CASE WHEN event_id % 5 = 0 THEN lpad((event_id % 10000)::VARCHAR, 4, '0') END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS squawk
FROM ({sql('event_id', 'user_id', 't_us')})""")
def squawk_carry(spark, sf):
    i = F.col("event_id")
    e = events(spark, sf, "event_id", "user_id", "t_us").withColumn("s", F.when(i % 5 == 0, F.lpad((i % 10000).cast("string"), 4, "0")))
    return e.select("event_id", windows.carried("s", "user_id", ["t_us", "event_id"]).alias("squawk"))


def _trail_sql(n: int) -> str:
    return f"SELECT event_id, array_to_string(list(event_id) OVER (PARTITION BY user_id ORDER BY t_us, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), ',') AS trail FROM ({sql('event_id', 'user_id', 't_us')})"


def _trail(spark, sf, n):
    t = windows.trail(F.col("event_id"), "user_id", ["t_us", "event_id"], n)
    return events(spark, sf, "event_id", "user_id", "t_us").select("event_id", t.alias("t")).select("event_id", F.array_join(F.transform("t", lambda x: x.cast("string")), ",").alias("trail"))


@query(_trail_sql(50))
def trail50(spark, sf):
    return _trail(spark, sf, 50)


@query(_trail_sql(100))
def history100(spark, sf):
    return _trail(spark, sf, 100)


_LATEST = f"SELECT user_id, event_id, event_type, value, t_us FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t_us DESC, event_id DESC) AS n FROM ({sql('user_id', 'event_id', 'event_type', 'value', 't_us')})) WHERE n = 1"


@query(_LATEST)
def latest_state(spark, sf):
    return windows.latest(events(spark, sf, "user_id", "event_id", "event_type", "value", "t_us"), "user_id", ["t_us", "event_id"])


@query(f"WITH l AS ({_LATEST}) SELECT user_id, event_id, t_us FROM l WHERE (SELECT max(t_us) FROM l) - t_us <= {6 * WINDOW_US}")
def prune_stale(spark, sf):
    last = windows.latest(events(spark, sf, "user_id", "event_id", "t_us"), "user_id", ["t_us", "event_id"])
    now = events(spark, sf, "t_us").agg(F.max("t_us").alias("now"))  # one row
    return windows.pruned(last.join(F.broadcast(now)), "t_us", F.col("now"), F.lit(6 * WINDOW_US)).drop("now")


@query(f"""SELECT sensor, round(avg(value), 6) AS bias, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY t_us DESC, event_id DESC) AS k FROM ({sql('sensor', 'value', 't_us', 'event_id')})) WHERE k <= 100 GROUP BY sensor HAVING count(*) >= 10""")
def rolling_bias(spark, sf):
    b = aggregates.recent_mean(events(spark, sf, "sensor", "value", "t_us", "event_id"), "sensor", ["t_us", "event_id"], "value")
    return b.select("sensor", *rounded(6, bias=F.col("mean")), "n")


@query("""WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, n, max(CASE WHEN i = n // 2 THEN value END) AS median, max(CASE WHEN i = CASE WHEN n > 20 THEN floor(n * 0.95::DOUBLE)::BIGINT ELSE n - 1 END THEN value END) AS p95 FROM r GROUP BY event_type, n""")
def median_p95(spark, sf):
    return aggregates.order_statistics(events(spark, sf, "event_type", "value"), "value", ["event_type"])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def method_counts(spark, sf):
    return aggregates.histogram(events(spark, sf, "event_type"), "event_type")


@query(f"WITH e AS ({sql('event_id', 't_us')}) SELECT event_id, t_us FROM (SELECT *, row_number() OVER (ORDER BY t_us DESC, event_id DESC) AS k, count(*) OVER () AS n FROM e) WHERE n <= 5000 OR k <= n - n // 2")
def lru_half(spark, sf):
    return windows.evicted(events(spark, sf, "event_id", "t_us"), ["t_us", "event_id"], 5000)


# ---- group geometry ----------------------------------------------------------------


@query(f"""WITH RECURSIVE {_FOLD} SELECT user_id, event_type, anchor, min_by(sensor, (t_us, event_id)) AS sensor, min(t_us) AS t_us FROM f GROUP BY user_id, event_type, anchor""")
def ref_reception(spark, sf):
    g = _anchored(spark, sf).groupBy("user_id", "event_type", "anchor")
    return g.agg(F.min_by("sensor", F.struct("t_us", "event_id")).alias("sensor"), F.min("t_us").alias("t_us"))


@query(f"""WITH p AS (SELECT user_id, {_ecef()} FROM ({sql('user_id', 'lat', 'lon', 'alt_m')})) SELECT user_id, round(avg(x), 3) AS x, round(avg(y), 3) AS y, round(avg(z), 3) AS z FROM p GROUP BY user_id""")
def centroid(spark, sf):
    e = events(spark, sf, "user_id", "lat", "lon", "alt_m").select("user_id", geo.lla_to_ecef("lat", "lon", "alt_m").alias("p"))
    return e.groupBy("user_id").agg(*rounded(3, x=F.avg("p.x"), y=F.avg("p.y"), z=F.avg("p.z")))


_SENSOR_ROWS = ", ".join(f"({i}, {a!r}::DOUBLE, {b!r}::DOUBLE, {h}::DOUBLE)" for i, a, b, h in SENSORS)


@query("""SELECT 'fix' AS kind, event_id AS id, value AS residual_m, NULL::INT AS num_sensors FROM events WHERE event_type = 'view'
UNION ALL SELECT 'unsolved_group', event_id, NULL, (event_id % 3 + 2)::INT FROM events WHERE event_type <> 'view'""")
def tagged_union(spark, sf):
    e = events(spark, sf, "event_id", "event_type", "value")
    one = e.where("event_type = 'view'").select(F.lit("fix").alias("kind"), F.col("event_id").alias("id"), F.col("value").alias("residual_m"))
    two = e.where("event_type <> 'view'").select(F.lit("unsolved_group").alias("kind"), F.col("event_id").alias("id"), (F.col("event_id") % 3 + 2).cast("int").alias("num_sensors"))
    return one.unionByName(two, allowMissingColumns=True)


# ---- solving and tracking ----------------------------------------------------------


@query()
def toa_solve(spark, sf):
    """Fixes of synthetic flights heard by four sensors."""
    return solve.fixes(solve.solve_groups(syn.flights(spark, sf)))


@query()
def ekf_tracks(spark, sf):
    """Tracks of flights heard by two sensors: prior-aided fixes and aided solutions."""
    return track.solved_tracks(syn.flights(spark, sf, 2))


@query()
def clock_pairs(spark, sf):
    """Offsets of the sensors' clocks, as filtered from flights of known position."""
    return clock.offsets(clock.measurements(syn.flights(spark, sf)))


@query()
def solve_stats(spark, sf):
    return aggregates.solve_stats(solve.solve_groups(syn.flights(spark, sf, 3)))


@query(f"""WITH g AS (SELECT user_id, coalesce(t_us - lag(t_us) OVER (PARTITION BY user_id ORDER BY t_us) <= {TOLERANCE_US}, false) AS hit FROM ({sql('user_id', 't_us')})),
b AS (SELECT user_id, count(*) FILTER (hit) AS h, count(*) AS c FROM g GROUP BY user_id)
SELECT sum(h)::BIGINT AS hits, sum(c - h)::BIGINT AS misses, printf('%.1f%%', round(100.0::DOUBLE * sum(h) / sum(c), 1)) AS hit_rate, count(*) FILTER (c > 1) AS multi FROM b""")
def cache_stats(spark, sf):
    return aggregates.cache_stats(events(spark, sf, "user_id", "t_us"), "user_id", "t_us", TOLERANCE_US)


@query()
def track_stats(spark, sf):
    return aggregates.track_stats(track.solved_tracks(syn.flights(spark, sf, 3)))


@query(f"""WITH m AS (SELECT event_id, x56, least(x56 >> 51, 24) AS df FROM ({sql('event_id', 'x56')})),
p AS (SELECT *, xor(list_reduce(list_transform(range(32), lambda i: CASE WHEN (x56 >> (55 - i)) & 1 = 1 THEN ({modes.crc_constants(32)})[i + 1] ELSE 0 END), lambda a, b: xor(a, b)), x56 & 16777215) AS par FROM m)
SELECT event_id, df::INT AS df_type, CASE WHEN df IN (11, 17, 18) THEN upper(printf('%06x', (x56 >> 24) & 16777215)) ELSE upper(printf('%06x', par)) END AS icao,
  CASE WHEN df IN (5, 21) THEN {_octal(5, 3, 1)} || {_octal(11, 9, 7)} || {_octal(4, 2, 0)} || {_octal(12, 10, 8)} END AS squawk
FROM (SELECT *, (x56 >> 24) & 8191 AS c FROM p) WHERE df IN {modes.KNOWN_DF} AND (df IN {modes.CLEAR_DF} OR par <> 0)""")
def decoded_messages(spark, sf):
    """Format, address and squawk of messages made of the events' bits."""
    from skyweft.operators.decode import decode

    e = events(spark, sf, "event_id", "x56").select("event_id", F.lower(_message()).alias("raw_msg"))
    return decode(e).select("event_id", "df_type", "icao", "squawk")


@query()
def live_snapshot(spark, sf):
    """Latest state, trail, colour band and ellipse of each aircraft."""
    return snapshot.snapshot(track.solved_tracks(syn.flights(spark, sf)))


@query()
def union_split(spark, sf):
    records = solve.solve_groups(syn.flights(spark, sf, 2))
    return union.tagged(union.fixes_of(records), union.groups_of(records)).select("t_ns", "icao", "kind")


from skyweft.plans import production  # noqa: E402, F401  registers its queries
