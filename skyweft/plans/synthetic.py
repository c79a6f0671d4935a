"""The driver's tables read as a surveillance feed.

``events`` plays the receptions: ``user_id`` the aircraft, ``event_type`` the message,
``event_id`` the sensor and sequence. Positions and motions follow from ids by fixed
rules, so every engine derives the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweft.functions import geo

#: Sensors of the synthetic network: id, latitude, longitude, altitude in metres.
SENSORS = [(i, round(49.8 + 0.14 * (4 * i % 9), 4), -6.5 + 0.25 * i, 60.0 + 35.0 * i) for i in range(9)]
MESSAGE_BITS = 1 << 56


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Chosen columns of events; t_us (microseconds) and the derived ones by name."""
    e = table(spark, sf_dir, "events")
    derived = {
        "t_us": F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"),
        "sensor": F.col("event_id") % 7,
        "lat": F.lit(49.8) + (F.col("event_id") % 1000) / 1000,
        "lon": F.lit(-6.5) + (F.col("event_id") % 1999) / 1000,
        "alt_m": (F.col("event_id") % 400) * 30.0,
        "x56": (F.col("event_id") * F.lit(73856093).cast("long") * 9973 + F.lit(12345678901)) % F.lit(MESSAGE_BITS),
    }
    return e.select(*[derived[n].alias(n) if n in derived else F.col(n) for n in names])


#: The same, as SQL expressions over the events view.
SQL = {
    "t_us": "epoch_us(ts)",
    "sensor": "event_id % 7",
    "lat": "49.8 + (event_id % 1000) / 1000.0::DOUBLE",
    "lon": "-6.5 + (event_id % 1999) / 1000.0::DOUBLE",
    "alt_m": "(event_id % 400) * 30.0::DOUBLE",
    "x56": f"(event_id * 73856093::BIGINT * 9973 + 12345678901) % {MESSAGE_BITS}",
}


def sql(*names: str) -> str:
    return "SELECT " + ", ".join(f"({SQL[n]}) AS {n}" if n in SQL else n for n in names) + " FROM events"


def sensors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SENSORS, "sensor_id BIGINT, lat DOUBLE, lon DOUBLE, alt DOUBLE")


def address(user: Column, leg: Column) -> Column:
    """The aircraft of a user's leg: four hexadecimal digits or more of the user and two of the
    leg, or a dash and more of these; two of them never have the same."""
    padded = lambda n, digits: F.lpad(n, F.greatest(F.length(n), F.lit(digits)), F.lit("0"))  # noqa: E731  lpad alone would cut longer ones
    dash = F.when(F.length(F.hex(leg)) > 2, "-").otherwise("")
    return F.concat(padded(F.hex(user), 4), dash, padded(F.hex(leg), 2))


def flights(spark: SparkSession, sf_dir: str, per_group: int = 4) -> DataFrame:
    """Groups of ``per_group`` receptions of each event's aircraft on a straight course.

    A flight's k-th event is at 2 k seconds; arrival times are ranges over the mean
    speed of light, to the nanosecond. ``true_lat`` and ``true_lon`` come along. The
    first five positions of each flight are also told by the aircraft (cpr_*).
    """
    from pyspark.sql import Window

    e = events(spark, sf_dir, "event_id", "user_id", "t_us")
    k = F.row_number().over(Window.partitionBy("user_id").orderBy("t_us", "event_id")) - 1
    t = (k % 200) * 2
    u = F.col("user_id")
    e = e.withColumn("k", k).withColumn("t", t).withColumn("leg", F.floor(k / 200))
    lat = F.lit(50.0) + (u % 11) * 0.05 + F.col("t") * (((u % 7) - 3) * 2e-4)
    lon = F.lit(-6.0) + (u % 13) * 0.08 + F.col("t") * (((u % 5) - 2) * 3e-4)
    alt_ft = F.lit(20_000.0) + (u % 15) * 1000
    e = e.select("event_id", address(u, F.col("leg")).alias("icao"), "k", F.col("t"), lat.alias("true_lat"), lon.alias("true_lon"), alt_ft.alias("altitude_ft"))
    e = e.withColumn("ecef", geo.lla_to_ecef("true_lat", "true_lon", F.col("altitude_ft") * 0.3048))
    places = F.array(*[F.struct(F.lit(i).cast("long").alias("sensor_id"), F.lit(a).alias("lat"), F.lit(b).alias("lon"), F.lit(h).alias("alt")) for i, a, b, h in SENSORS])
    own = F.filter(places, lambda s: F.pmod(s["sensor_id"] - F.col("event_id"), F.lit(len(SENSORS))) < per_group)

    def heard(s):
        far = geo.distance(F.col("ecef"), geo.lla_to_ecef(s["lat"], s["lon"], s["alt"]))
        ns = F.round(far / geo.effective_velocity(s["alt"], F.col("altitude_ft") * 0.3048) * 1e9).cast("long")
        return F.struct(s["sensor_id"], s["lat"], s["lon"], s["alt"], F.col("t").cast("long").alias("timestamp_s"), ns.alias("timestamp_ns"))

    rec = F.transform(own, heard)
    told = (F.col("k") % 200) < 5
    return e.select(
        "icao", F.lit(20).alias("df_type"), "altitude_ft", F.lit(None).cast("string").alias("squawk"), F.lpad(F.hex("event_id"), 14, "0").alias("raw_msg"), F.size(own).alias("num_sensors"), rec.alias("receptions"),
        (F.col("t").cast("long") * 1_000_000_000).alias("t_ns"), F.when(told, F.col("true_lat")).alias("cpr_lat"), F.when(told, F.col("true_lon")).alias("cpr_lon"), F.when(told, F.col("altitude_ft")).alias("cpr_alt_ft"),
        "true_lat", "true_lon", "ecef",
    )
