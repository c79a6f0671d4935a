"""Windows over an aircraft's or sensor's history, and latest state."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.functions.let import col


def history(key: str, order: list, before: int | None = None):
    """The window of a key's rows up to the present one, ``before`` earlier at most."""
    start = Window.unboundedPreceding if before is None else -before
    return Window.partitionBy(key).orderBy(*order).rowsBetween(start, 0)


def lag_rate(df: DataFrame, key: str, order: list, t: str, unit: float, values: list[str], low: float = 0.1, high: float = 60.0) -> DataFrame:
    """Adds ``dt`` (seconds since the key's last row) and ``rate_*``: change per second,
    if low < dt < high. ``t`` is an integer of ``unit`` a second, subtracted as such."""
    w = Window.partitionBy(key).orderBy(*order)
    df = df.withColumns({"dt": (F.col(t) - F.lag(t).over(w)) / unit, **{f"__{v}": F.lag(v).over(w) for v in values}})
    ok = (F.col("dt") > low) & (F.col("dt") < high)
    return df.withColumns({f"rate_{v}": F.when(ok, (F.col(v) - F.col(f"__{v}")) / F.col("dt")) for v in values}).drop(*[f"__{v}" for v in values])


def running_count(key: str, order: list) -> Column:
    return F.row_number().over(Window.partitionBy(key).orderBy(*order))


def carried(value: str, key: str, order: list) -> Column:
    """The key's last value that wasn't null."""
    return F.last(value, ignorenulls=True).over(history(key, order))


def trail(item: Column, key: str, order: list, points: int = 50) -> Column:
    """The key's last ``points`` items, oldest first."""
    return F.collect_list(item).over(history(key, order, points - 1))


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key, that of the largest ``order``; pre-aggregated, no sort."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def latest_with_trail(df: DataFrame, key: str, order: list[str], item: Column, points: int = 50) -> DataFrame:
    """Latest rows with their trail, null if it has under two points."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    last = df.withColumn("__item", item).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= points)
    by = last.groupBy(key).agg(F.min_by(F.struct(*df.columns), "__n").alias("r"), F.array_sort(F.collect_list(F.struct((-F.col("__n")).alias("n"), F.col("__item").alias("p")))).alias("t"))
    return by.select("r.*", F.when(F.size("t") >= 2, F.transform("t", lambda x: x["p"])).alias("trail"))


def pruned(latest_rows: DataFrame, t: str, now, most) -> DataFrame:
    """Rows no older than ``most`` before ``now``."""
    return latest_rows.where(col(now) - F.col(t) <= col(most))


#: Share of the rows by which an approximate quantile may be off, and rows of one range that a task may rank.
QUANTILE_ERROR, RANKED_ROWS = 1 / 128, 1_000_000


def evicted(df: DataFrame, order: list[str], most: int) -> DataFrame:
    """If there are over ``most`` rows, the newer half (the older half is evicted).

    The half is cut at its exact rank: rows are counted in the ranges that two approximate
    quantiles on either side of the cut leave; the range with the cut is narrowed until
    it is small, by ``order[0]``, a number, and where that is one value by the next, and only
    its rows are ranked. All newer ranges stay whole.
    """
    n = df.count()
    if n <= most:
        return df
    keep, size = n - n // 2, n
    inside, newer = F.lit(True), F.lit(False)
    numbers = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    for name in order:
        t, alike = F.col(name), False
        while size > RANKED_ROWS and not alike and name in numbers:
            part, at = df.where(inside), 1 - keep / size
            near = part.approxQuantile(name, [max(0.0, at - 2 * QUANTILE_ERROR), min(1.0, at + 2 * QUANTILE_ERROR)], QUANTILE_ERROR)
            if not near:
                break
            # nulls come last, so below all; the quantiles are ranges of their own, so that a range gets smaller or has one value
            above = [(c(t, F.lit(q))).cast("int") for q in near for c in (operator.ge, operator.gt)]
            r = F.coalesce(sum(above[1:], above[0]), F.lit(-1))
            counts = {x["r"]: x for x in part.groupBy(r.alias("r")).agg(F.count("*").alias("n"), F.min(t).alias("low"), F.max(t).alias("high")).collect()}  # at most six rows
            for cut in sorted(counts, reverse=True):
                if counts[cut]["n"] >= keep:
                    break
                keep -= counts[cut]["n"]
            newer, inside = newer | (inside & (r > cut)), inside & (r == cut)
            alike, before, size = counts[cut]["low"] == counts[cut]["high"], size, counts[cut]["n"]
            if size == before:
                break
        if not alike:
            break
    rank = F.row_number().over(Window.orderBy(*[F.desc(c) for c in order]))
    edge = df.where(inside).withColumn("__n", rank).where(F.col("__n") <= keep).drop("__n")
    return df.where(newer).union(edge)
