"""JSON-lines readers and writers of all records.

Readers are schema-driven: a wrong type is null, unknown keys are ignored, blank lines
go, and records that are not JSON or lack a required field are kept apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft import schemas
from skyweft.functions.scalar import finite, round_to

BAD = "_corrupt"


def parse(lines: DataFrame, schema: T.StructType, required: tuple = (), col: str = "value") -> DataFrame:
    """Fields of JSON lines and ``_corrupt``: the line, where it is malformed."""
    kind = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    df = lines.where(F.trim(F.col(col)) != "").select(F.from_json(col, kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}).alias("r"), F.col(col).alias("line"))
    bad = F.col(f"r.{BAD}").isNotNull()
    for n in required:
        bad = bad | F.col(f"r.{n}").isNull()
    return df.select(*[F.col(f"r.{f.name}") for f in schema.fields], F.when(bad, F.col("line")).alias(BAD))


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(BAD).isNull()).drop(BAD)


def counts(parsed: DataFrame) -> DataFrame:
    """How many lines were read and how many of them were malformed."""
    return parsed.agg(F.count("*").alias("records"), F.count(BAD).alias("malformed"))


def _lines(spark: SparkSession, path: str, stream: bool) -> DataFrame:
    return (spark.readStream if stream else spark.read).text(path)


def read_packets(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return good(parse(_lines(spark, path, stream), schemas.PACKET, ("sensor_id", "raw_msg")))


def read_decoded(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return good(parse(_lines(spark, path, stream), schemas.DECODED, ("sensor_id", "raw_msg", "icao", "df_type")))


def parse_groups(lines: DataFrame) -> DataFrame:
    """Groups; one with a bad reception is malformed as a whole."""
    df = parse(lines, schemas.GROUP, schemas.REQUIRED_GROUP)
    fine = F.forall("receptions", lambda r: r["sensor_id"].isNotNull() & r["lat"].isNotNull() & r["lon"].isNotNull() & r["alt"].isNotNull() & r["timestamp_s"].isNotNull() & r["timestamp_ns"].isNotNull())
    return df.withColumn(BAD, F.coalesce(F.col(BAD), F.when(~F.coalesce(fine, F.lit(False)), F.to_json(F.struct(*[f.name for f in schemas.GROUP.fields])))))


def read_groups(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return good(parse_groups(_lines(spark, path, stream)))


def parse_records(lines: DataFrame) -> DataFrame:
    """Tagged records: kind, fix, unsolved_group, told apart by the key of the latter."""
    df = parse(lines, schemas.LAYER4_RECORD)
    is_group = F.col("unsolved_group").isNotNull()
    lacking = F.lit(False)
    for n in schemas.REQUIRED_FIX:
        lacking = lacking | F.col(n).isNull()
    kind = F.when(is_group, "unsolved_group").when(~lacking, "fix")
    return df.select(
        kind.alias("kind"), F.when(kind == "fix", F.struct(*[f.name for f in schemas.FIX.fields])).alias("fix"), F.when(is_group, F.col("unsolved_group")).alias("unsolved_group"), F.coalesce(F.col(BAD), F.when(kind.isNull(), F.lit("missing fields"))).alias(BAD)
    )


def read_fixes(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return good(parse(_lines(spark, path, stream), schemas.FIX, schemas.REQUIRED_FIX))


def read_tracks(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return good(parse(_lines(spark, path, stream), schemas.TRACK, ("icao", "lat", "lon")))


def read_overrides(spark: SparkSession, candidates: list[str]) -> DataFrame:
    """Surveyed sensor places of the first candidate path that is there.

    Rows that lack one of the five fields go; with no file there are none.
    """
    jvm = spark._jvm
    for path in candidates:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            rows = spark.read.schema(schemas.OVERRIDE).option("multiLine", True).json(path)
            return rows.withColumn("no", F.monotonically_increasing_id()).dropna()  # one file, one partition: its order
    return spark.createDataFrame([], schemas.OVERRIDE).withColumn("no", F.lit(0).cast("long"))


#: Decimals of a written fix's fields.
FIX_DIGITS = {"residual_m": 2, "quality_residual_m": 2, "gdop": 2, "t0_s": 9}


def writable(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Doubles rounded where told, and null where not finite."""
    digits = digits or {}

    def clean(c: str, kind: str) -> Column:
        if kind != "double":
            return F.col(c)
        return round_to(c, digits[c]).alias(c) if c in digits else F.when(finite(c), F.col(c)).alias(c)

    return df.select(*[clean(c, k) for c, k in df.dtypes])


def lines(df: DataFrame) -> DataFrame:
    """One compact JSON text a row, null fields included."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write(df: DataFrame, path: str, digits: dict[str, int] | None = None, mode: str = "error") -> None:
    lines(writable(df, digits)).write.mode(mode).text(path)
