"""Packets to decoded messages, all in column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweft.functions import modes
from skyweft.functions.scalar import finite


def valid_packets(packets: DataFrame) -> DataFrame:
    """Positions within bounds; NaN and null positions go."""
    ok = finite("lat") & finite("lon") & finite("alt") & F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    return packets.where(F.coalesce(ok, F.lit(False)))


def required(df: DataFrame, *names: str) -> DataFrame:
    """Rows in which the named columns are neither null nor empty."""
    kinds = dict(df.dtypes)
    for n in names:
        df = df.where(F.col(n).isNotNull())
        if kinds[n] == "string":
            df = df.where(F.col(n) != "")
    return df


def decode(packets: DataFrame) -> DataFrame:
    """Adds icao, df_type, altitude_ft and squawk; undecodable messages go.

    Cheap tests come first: text shape, then format, then the address.
    """
    df = packets.withColumn("raw_msg", modes.normalised("raw_msg")).where(F.col("raw_msg").isNotNull())
    df = df.withColumn("df_type", modes.downlink_format("raw_msg")).where(F.col("df_type").isin(*modes.KNOWN_DF))
    df = df.withColumn("icao", modes.icao("raw_msg")).where(F.col("icao").isNotNull())
    return df.select(*packets.columns, "icao", "df_type", modes.altitude_ft("raw_msg").alias("altitude_ft"), modes.squawk("raw_msg").alias("squawk"))
