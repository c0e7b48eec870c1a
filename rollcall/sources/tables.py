"""Sinks, feature and bin files, database access."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.schema import REQUEST


def write_csv(df: DataFrame, path: str) -> None:
    """Export with a header in every part file."""
    df.write.csv(path, header=True)


def write_features(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bins(edges: DataFrame, path: str) -> None:
    """One JSON object per agenda, the edges as a nested array."""
    edges.write.json(path)


def read_bins(spark: SparkSession, path: str, by: str = "hoofdagenda") -> DataFrame:
    schema = T.StructType(
        [
            T.StructField(by, T.StringType(), False),
            T.StructField("edges", T.ArrayType(T.DoubleType()), False),
        ]
    )
    return spark.read.schema(schema).json(path)


def read_bins_object(spark: SparkSession, path: str, by: str = "hoofdagenda") -> DataFrame:
    """Edges from a single JSON object ``{agenda: {quantile: edge}}``."""
    kind = T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("bins"))
    agendas = whole.select(F.explode("bins").alias(by, "quantiles"))
    ordered = F.array_sort(
        F.transform(
            F.map_entries("quantiles"),
            lambda e: F.struct(e["key"].cast("double").alias("q"), e["value"].alias("edge")),
        )
    )
    return agendas.select(by, F.transform(ordered, lambda e: e["edge"]).alias("edges"))


def log_run(
    spark: SparkSession,
    path: str,
    request_id: int,
    started: dt.datetime,
    runtime: float,
    version: str,
    code: int = 200,
    message: str = "success",
    endpoint: str = "predict",
) -> None:
    """Append one run record; a repeated run id replaces its own folder only."""
    row = [(request_id, started, code, message, endpoint, float(runtime), version)]
    record = spark.createDataFrame(row, REQUEST)
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={request_id}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REQUEST).parquet(f"{path}/run=*")


def jdbc_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    fetchsize: int = 10_000,
    partition: tuple[str, str, str, int] | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read: a query or a table, streamed in batches.

    ``partition`` (column, lower, upper, parts) reads in parallel.  Spark only
    splits table reads, so a partitioned query becomes a derived table.
    """
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    options = {"url": url, "fetchsize": str(fetchsize), **(extra or {})}
    if partition is None:
        options["query" if query else "dbtable"] = query or table
        return options
    column, lower, upper, parts = partition
    options["dbtable"] = f"({query}) AS source" if query else table
    options.update(
        partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=str(parts)
    )
    return options


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    reader: DataFrameReader = spark.read.format("jdbc")
    return reader.options(**jdbc_options(**kwargs)).load()
