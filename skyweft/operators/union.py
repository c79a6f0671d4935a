"""Fixes and unsolved groups in one tagged stream, and apart again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweft.schemas import FIX, GROUP


def tagged(fixes: DataFrame, groups: DataFrame) -> DataFrame:
    """t_ns, icao, kind, fix and unsolved_group: the other one null."""
    f = F.struct(*[c.name for c in FIX.fields])
    g = F.struct(*[c.name for c in GROUP.fields])
    first = F.array_min(F.transform("receptions", lambda r: r["timestamp_s"] * F.lit(1_000_000_000).cast("long") + r["timestamp_ns"]))
    t = F.col("timestamp_s") * F.lit(1_000_000_000).cast("long") + F.col("timestamp_ns")
    one = fixes.select(t.alias("t_ns"), "icao", F.lit("fix").alias("kind"), f.alias("fix"))
    two = groups.select(first.alias("t_ns"), "icao", F.lit("unsolved_group").alias("kind"), g.alias("unsolved_group"))
    return one.unionByName(two, allowMissingColumns=True)


def fixes_of(records: DataFrame) -> DataFrame:
    return records.where("kind = 'fix'").select("fix.*")


def groups_of(records: DataFrame) -> DataFrame:
    return records.where("kind = 'unsolved_group'").select("unsolved_group.*")
