"""Statistics of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, by: str, name: str = "n") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias(name))


def rate(part: Column, whole: Column, digits: int = 1) -> Column:
    """A share as text with a percent sign; 0 of nothing."""
    share = F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))
    return F.concat(F.format_string(f"%.{digits}f", F.round(share, digits)), F.lit("%"))


#: Ranges that values are ranked in, and rows that are ranked without.
RANGES, RANKED_ROWS = 64, 1_000_000


def order_statistics(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """n, median (the element n / 2 in order) and p95 (element 0.95 n; the largest of 20
    or fewer), exact, of each group or of all rows.

    Values are counted before they are ranked, so equal ones travel once. They are
    ranked within ranges, cut at approximate quantiles of all rows and offset by what
    lies below in the group, so that no task orders a whole group, however large; up to
    RANKED_ROWS rows are one range.
    """
    by = by or []
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(*by, value).agg(F.count("*").alias("c"))
    mid, high = F.floor(F.col("n") / 2), F.when(F.col("n") > 20, F.floor(F.col("n") * 0.95)).otherwise(F.col("n") - 1)
    at = lambda k: F.min(F.when(F.col("upto") > k, F.col(value)))  # noqa: E731  the first value that reaches past element k
    result = [F.max("n").alias("n"), at(mid).alias("median"), at(high).alias("p95")]
    if known.count() <= RANKED_ROWS:
        group = Window.partitionBy(*by)
        upto = F.sum("c").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        return counts.withColumn("upto", upto).withColumn("n", F.sum("c").over(group)).groupBy(*by).agg(*result)
    cuts = sorted(set(known.approxQuantile(value, [i / RANGES for i in range(1, RANGES)], 0.5 / RANGES)))
    ranged = counts.withColumn("r", sum(((F.col(value) >= c).cast("int") for c in cuts), F.lit(0)))
    sums = ranged.groupBy(*by, "r").agg(F.sum("c").alias("s"))  # at most RANGES rows a group
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("s").over(group.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*[F.col(k).alias(f"__{k}") for k in by], F.col("r").alias("__r"), before.alias("base"), F.sum("s").over(group).alias("n"))
    w = Window.partitionBy(*by, "r").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("r") == F.col("__r")
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    ranked = ranged.withColumn("within", F.sum("c").over(w)).join(sums, same).withColumn("upto", F.col("base") + F.col("within"))
    return ranked.groupBy(*by).agg(*result)


def recent_mean(df: DataFrame, key: str, order: list[str], value: str, most: int = 100, least: int = 10) -> DataFrame:
    """Mean of each key's last ``most`` values, of keys that have ``least`` or more."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in order]))
    last = df.where(F.col(value).isNotNull()).withColumn("__n", n).where(F.col("__n") <= most)
    return last.groupBy(key).agg(F.avg(value).alias("mean"), F.count("*").alias("n")).where(F.col("n") >= least)


def sensor_bias(records: DataFrame) -> DataFrame:
    """Per sensor, the mean of its last 100 timing residuals in solved groups."""
    each = records.where("kind = 'fix'").select("t_ns", "icao", F.arrays_zip("sensor_ids", "sensor_residuals").alias("z")).select("t_ns", "icao", F.inline("z"))
    return recent_mean(each, "sensor_ids", ["t_ns", "icao"], "sensor_residuals").withColumnRenamed("sensor_ids", "sensor_id")


def solve_stats(records: DataFrame) -> DataFrame:
    """One row of counts: groups, solved, failed, skipped and the solve rate."""
    skipped = F.col("reason").isin("too_few_sensors", "no_prior_2sensor", "pair_variance_exceeded")
    solved = F.count_if(F.col("kind") == "fix")
    return records.agg(
        F.count("*").alias("groups"),
        solved.alias("solved"),
        F.count_if(F.col("reason").isNotNull() & ~skipped).alias("failed"),
        F.count_if(F.col("reason").isNotNull() & skipped).alias("skipped"),
        rate(solved, F.count("*")).alias("solve_rate"),
    )


def method_counts(records: DataFrame) -> DataFrame:
    return histogram(records.where("kind = 'fix'").select(F.col("fix.solve_method").alias("solve_method")), "solve_method")


def failure_counts(records: DataFrame) -> DataFrame:
    return histogram(records.where("reason is not null"), "reason")


def reference_reception(groups: DataFrame, keep: list[str]) -> DataFrame:
    """The earliest reception of each group, the first of those that tie."""
    at = F.transform("receptions", lambda r, i: F.struct((r["timestamp_s"] * F.lit(1_000_000_000).cast("long") + r["timestamp_ns"]).alias("t"), i.alias("i")))
    first = F.array_min(at)
    return groups.select(*keep, F.get("receptions", first["i"]).alias("reference"), first["t"].alias("reference_ns"))


def track_stats(tracks: DataFrame, established: int = 2) -> DataFrame:
    """One row: updates, aircraft, and those with ``established`` updates or more."""
    by = tracks.groupBy("icao").agg(F.count("*").alias("c"), F.max("track_quality").alias("q"))
    return by.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("updates"), F.count("*").alias("aircraft"), F.count_if(F.col("q") >= established).alias("established"))


def cache_stats(groups: DataFrame, key: str, t: str, most) -> DataFrame:
    """How often a key's earlier row was no older than ``most``: hits, misses, hit rate,
    and how many keys came more than once."""
    gap = F.col(t) - F.lag(t).over(Window.partitionBy(key).orderBy(t))
    hit = F.coalesce(gap <= F.lit(most), F.lit(False))
    by = groups.select(key, hit.alias("hit")).groupBy(key).agg(F.count_if("hit").alias("h"), F.count("*").alias("c"))
    hits, whole = F.coalesce(F.sum("h"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0))
    return by.agg(hits.alias("hits"), (whole - hits).alias("misses"), rate(hits, whole).alias("hit_rate"), F.count_if(F.col("c") > 1).alias("multi"))
