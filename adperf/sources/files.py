"""File sources and sinks with explicit schemas (ops A3, A4, A6-A8, A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def csv_dropmalformed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV with a typed schema; rows that do not parse are dropped (op A3)."""
    return spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED").csv(path)


def tsv_parts(spark: SparkSession, path: str, names: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """Header-less, unquoted TSV parts with column names from a config list (op A4).

    Markers such as ``_SUCCESS`` are skipped by the reader itself; parts are
    read in parallel as ordinary input splits.
    """
    types = types or {}
    schema = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names)
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").option("header", False).csv(path)


def write_tsv_parts(df: DataFrame, path: str, parts: int) -> None:
    df.repartition(parts).write.mode("overwrite").option("sep", "\t").option("quote", "").option("header", False).csv(path)


def stage_partitioned(df: DataFrame, path: str, partition_cols: list[str], append: bool = False) -> None:
    """Overwrite (or append to) a partitioned Parquet stage (ops A6, A11)."""
    w = df.write.mode("append" if append else "overwrite").partitionBy(*partition_cols)
    if not append:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def csv_write(df: DataFrame, path: str) -> None:
    """Header CSV sink (op A8)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_signal(spark: SparkSession, path: str, snapshot: str, signal: str, windows: list[str], columns: list[str]) -> DataFrame:
    """Rows of one signal, snapshot day and some windows of a dataset partitioned by those three (op A5).

    The conditions are on partition columns, so only those folders are listed and read.
    """
    rows = spark.read.parquet(path).where((F.col("snapshot_date") == F.lit(snapshot).cast("date")) & (F.col("signal") == signal) & F.col("window").isin(windows))
    return rows.select("snapshot_date", "window", *columns)


def literal(value) -> str:
    """A value as a string literal of SQL."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_partitioned(spark: SparkSession, table: str, schema: str, partition_cols: list[str], path: str) -> None:
    """A catalog table over ``path`` whose partitions the catalog lists, if it is not there yet."""
    spark.sql(f"create table if not exists {table} ({schema}) using parquet partitioned by ({', '.join(partition_cols)}) location {literal(path)}")
