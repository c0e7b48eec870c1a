"""Appointment files and the postal-code file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.config import UNKNOWN_LOCATION
from rollcall.functions.scalars import blank_to_null
from rollcall.schema import APPOINTMENT, APPOINTMENT_CSV, POSTAL_FILE


def file_order() -> Column:
    """Position of a row in the input: file, block, row within the block."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_appointments_csv(
    spark: SparkSession, path: str, schema: T.StructType = APPOINTMENT_CSV, order: bool = False
) -> DataFrame:
    """Appointment extract with a header row; ``order`` adds ``_seq``."""
    df = spark.read.schema(schema).csv(path, header=True)
    return df.withColumn("_seq", file_order()) if order else df


def parse_moment(value: Column) -> Column:
    """Timestamp from epoch milliseconds (may be negative) or ISO text."""
    number = F.when(value.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), value.cast("double"))
    iso = F.when(number.isNull(), F.try_to_timestamp(value))
    return F.coalesce(F.timestamp_micros((number * 1000).cast("long")), iso)


def coerce_appointments(raw: DataFrame) -> DataFrame:
    """Text records to typed appointments: blanks are missing, places get a name."""
    columns = []
    for field in APPOINTMENT.fields:
        value = blank_to_null(F.col(field.name).cast("string"))
        if isinstance(field.dataType, T.TimestampType):
            value = parse_moment(value)
        elif isinstance(field.dataType, T.DateType):
            value = F.to_date(parse_moment(value))
        elif isinstance(field.dataType, T.IntegerType):
            value = value.cast("int")
        elif field.name in ("name", "description"):
            value = F.coalesce(value, F.lit(UNKNOWN_LOCATION))
        columns.append(value.alias(field.name))
    return raw.select(*columns, *[c for c in raw.columns if c.startswith("_")])


def read_appointments_json(
    spark: SparkSession, path: str, multi_line: bool = True, order: bool = False
) -> DataFrame:
    """Request bodies (JSON arrays) or, for bulk loads, one record per line.

    Every value is read as text first, because the same field may hold a number
    or a string.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in APPOINTMENT.fields])
    raw = spark.read.schema(text).json(path, multiLine=multi_line)
    if order:
        raw = raw.withColumn("_seq", file_order())
    return coerce_appointments(raw)


def read_postal_codes(spark: SparkSession, path: str) -> DataFrame:
    """Postal code -> location; the first line of a repeated code counts."""
    raw = spark.read.schema(POSTAL_FILE).csv(path, sep="\t").withColumn("_seq", file_order())
    return first_per_code(raw, "_seq")


def first_per_code(df: DataFrame, order: str) -> DataFrame:
    place = F.min_by(F.struct("latitude", "longitude"), order)
    return df.groupBy("postalcode").agg(place.alias("_place")).select("postalcode", "_place.*")
