"""Readers of the two raw tables, and the contract on their columns."""

from pyspark.sql import DataFrame, SparkSession, types as T

from claimwright import vocabulary as V


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table from Parquet, or from CSV with a header (all columns as text)."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def read_frequency(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, V.RAW_FREQUENCY_SCHEMA)


def read_severity(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, V.RAW_SEVERITY_SCHEMA)
