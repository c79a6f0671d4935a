"""Keyed and ranked look-ups: nearest place, as-of, pairs, even and odd frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweft.functions.let import col

MAX_OFFSET_DEG = 0.5
CPR_PAIR_S = 10.0


def nearest_place(places: DataFrame, key: str, dimension: DataFrame, dim_order: str, most: float = MAX_OFFSET_DEG) -> DataFrame:
    """``key`` of each place and the nearest dimension row within ``most`` degrees.

    ``places`` has key, lat and lon, one row a key; ``dimension`` has lat, lon and more,
    ties going to the smallest ``dim_order``. Both are cut into cells of ``most``
    degrees and meet by cell and its neighbours, so no pair of far rows is formed. Rows of one
    place are one row before they meet: keys have the same nearest, and of dimension rows
    only the first can be it.
    """
    cell = lambda c: F.floor(F.col(c) / most).cast("long")
    around = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    keys = places.select(F.col(key), F.col("lat").alias("plat"), F.col("lon").alias("plon"))
    p = keys.select("plat", "plon").distinct().withColumn("di", F.explode(around)).withColumn("dj", F.explode(around))
    p = p.withColumn("ci", F.floor(F.col("plat") / most).cast("long") + F.col("di")).withColumn("cj", F.floor(F.col("plon") / most).cast("long") + F.col("dj"))
    first = dimension.groupBy(F.col("lat").alias("dlat"), F.col("lon").alias("dlon")).agg(F.min_by(F.struct(*dimension.columns), F.struct(dim_order)).alias("place"))
    d = first.select("place", cell("dlat").alias("ci"), cell("dlon").alias("cj"))
    both = p.join(d, ["ci", "cj"])
    dist = F.sqrt(F.pow(F.col("plat") - F.col("place.lat"), 2) + F.pow(F.col("plon") - F.col("place.lon"), 2))
    near = both.withColumn("distance", dist).where(F.col("distance") < most)
    best = near.groupBy("plat", "plon").agg(F.min_by(F.struct("place", "distance"), F.struct(F.col("distance"), F.col(f"place.{dim_order}"))).alias("b"))
    return keys.join(best, ["plat", "plon"]).select(key, "b.place.*", "b.distance")


def surveyed(receptions: DataFrame, overrides: DataFrame) -> DataFrame:
    """sensor_id and the surveyed lat, lon and alt of the sensors that have one.

    A sensor is matched once, by its first position, and keeps the match; ties go to
    the first in the file (``no``, as :func:`read_overrides` numbers them).
    """
    first = receptions.groupBy("sensor_id").agg(F.min_by(F.struct("lat", "lon"), F.struct("timestamp_s", "timestamp_ns")).alias("p")).select("sensor_id", "p.lat", "p.lon")
    numbered = overrides
    if "no" not in overrides.columns:  # without the order of the file, that of names
        h = F.xxhash64("public_key", "lat", "lon", "alt", "name")
        numbered = overrides.withColumn("no", F.struct("name", h))
    numbered = numbered.select("lat", "lon", "alt", "no")
    return nearest_place(first, "sensor_id", numbered, "no").select("sensor_id", "lat", "lon", "alt")


def with_overrides(receptions: DataFrame, overrides: DataFrame) -> DataFrame:
    """Receptions at their sensor's surveyed place; sensors without one go."""
    found = surveyed(receptions, overrides).select("sensor_id", F.col("lat").alias("olat"), F.col("lon").alias("olon"), F.col("alt").alias("oalt"))
    rest = [c for c in receptions.columns if c not in ("lat", "lon", "alt")]
    out = receptions.join(found, "sensor_id")
    return out.select(*rest, F.col("olat").alias("lat"), F.col("olon").alias("lon"), F.col("oalt").alias("alt"))


def groups_at_overrides(groups: DataFrame, places: DataFrame) -> DataFrame:
    """Groups with their receptions at surveyed ``places``; receptions of other sensors go.

    As groups are formed before, a sensor without a place may still be a window's first. A
    group stays, and is found to be too small, if none of its sensors has a place.
    """
    key, rest = ["icao", "raw_msg", "t_ns"], ["df_type", "altitude_ft", "squawk"]
    each = groups.select(*key, *rest, F.posexplode_outer("receptions").alias("i", "r"))
    at = places.select(F.col("sensor_id").alias("__sensor"), F.struct("lat", "lon", "alt").alias("__at"))
    both = each.join(at, F.col("r.sensor_id") == F.col("__sensor"), "left")
    put = F.struct("i", F.struct("r.sensor_id", *[F.col(f"__at.{c}").alias(c) for c in ("lat", "lon", "alt")], "r.timestamp_s", "r.timestamp_ns").alias("r"))
    by = both.groupBy(*key).agg(F.array_sort(F.collect_list(F.when(F.col("__at").isNotNull(), put))).alias("rs"), F.first(F.struct(*rest)).alias("__rest"))
    receptions = F.transform("rs", lambda x: x["r"])
    return by.select("icao", *[f"__rest.{c}" for c in rest], "raw_msg", F.size("rs").alias("num_sensors"), receptions.alias("receptions"), "t_ns")


def as_of(left: DataFrame, right: DataFrame, key: str, t: str, ties: list[str], take: list[str], tolerance, span: int | None = None) -> DataFrame:
    """``left`` with the latest earlier ``right`` row of its key: columns ``take`` and ``age``.

    Both sides are put in one stream, sorted once by key and time, and the last right
    row is carried forward; a match older than ``tolerance`` is null. No range join.
    Right rows of the same time come first; of right rows of one time, the one greatest
    by ``take``. With ``span``, for few keys of many rows, a key's time is cut into spans of
    that length that are worked through apart: the last right row before each span, found
    among the spans' last rows, is put in front of it.
    """
    l = left.withColumn("__side", F.lit(1)).withColumn("__r", F.lit(None).cast(_struct(right, t, take)))
    r = right.select(key, t, F.lit(0).alias("__side"), F.struct(F.col(t).alias("t"), *take).alias("__r"))
    by = [key]
    if span is not None:
        by = [key, "__span"]
        l, r = (x.withColumn("__span", F.floor(F.col(t) / F.lit(span)).cast("long")) for x in (l, r))
        lasts = l.select(*by, "__r").unionByName(r.select(*by, "__r")).groupBy(*by).agg(F.max("__r").alias("__r"))
        before = Window.partitionBy(key).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
        carried = lasts.withColumn("__r", F.last("__r", ignorenulls=True).over(before)).where("__r is not null")
        r = r.unionByName(carried.select(key, F.col("__r.t").alias(t), F.lit(0).alias("__side"), "__r", "__span"))
    both = l.unionByName(r, allowMissingColumns=True)
    ties = ["__r", *ties]
    w = Window.partitionBy(*by).orderBy(t, "__side", *ties).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("__m", F.last("__r", ignorenulls=True).over(w)).where("__side = 1")
    age = F.col(t) - F.col("__m.t")
    ok = age <= col(tolerance)
    return seen.select(*left.columns, *[F.when(ok, F.col(f"__m.{c}")).alias(f"prior_{c}") for c in take], F.when(ok, age).alias("age"))


def _struct(df: DataFrame, t: str, take: list[str]) -> str:
    kinds = dict(df.dtypes)
    return f"struct<t:{kinds[t]}," + ",".join(f"{c}:{kinds[c]}" for c in take) + ">"


def reception_pairs(groups: DataFrame, keep: list[str], items: str = "receptions", by: str = "sensor_id") -> DataFrame:
    """Pairs i < j of each group's items, the one of the smaller ``by`` first: a, b.

    Pairs are formed within the row's array (a dozen sensors), without a join. The array
    passes a generator first: an expression that makes it would otherwise be moved into
    the pairs and worked out for each.
    """
    groups = groups.select(*keep, F.explode(F.array(items)).alias("__items"))
    xs = F.col("__items")
    index = lambda n: F.sequence(F.lit(0), n - 1)
    pairs = F.flatten(
        F.transform(index(F.size(xs)), lambda i: F.transform(F.filter(index(F.size(xs)), lambda j: j > i), lambda j: F.struct(F.get(xs, i).alias("x"), F.get(xs, j).alias("y"))))
    )
    out = groups.where(F.size(xs) >= 2).select(*keep, F.inline(pairs))
    first = F.col(f"x.{by}") <= F.col(f"y.{by}")
    return out.select(*keep, F.when(first, F.col("x")).otherwise(F.col("y")).alias("a"), F.when(first, F.col("y")).otherwise(F.col("x")).alias("b"))


def even_odd(frames: DataFrame, key: str, t: str, ties: list[str], odd: Column, values: list[str], most) -> DataFrame:
    """``frames`` with the latest even and odd values up to each: even_*, odd_*, *_t.

    Null unless both are there and within ``most`` of each other.
    """
    w = Window.partitionBy(key).orderBy(t, *ties).rowsBetween(Window.unboundedPreceding, 0)
    item = F.struct(F.col(t).alias("t"), *values)
    e, o = F.last(F.when(~odd, item), ignorenulls=True).over(w), F.last(F.when(odd, item), ignorenulls=True).over(w)
    out = frames.withColumn("__e", e).withColumn("__o", o)
    ok = F.abs(F.col("__e.t") - F.col("__o.t")) < col(most)
    cols = [F.when(ok, F.col(f"__{p}.{v}")).alias(f"{n}_{v}") for n, p in (("even", "e"), ("odd", "o")) for v in ("t", *values)]
    return out.select(*frames.columns, *cols)
