"""Prepared tables, reports and predictions in a folder of Parquet or CSV tables."""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

PREPARED = [
    "frequency_clean", "severity_clean", "severity_by_policy", "claim_count_audit",
    "policy_analytics", "data_preparation_summary", "claim_count_audit_summary",
]
RELATIONAL = ["policies", "claims", "orphan_claims", "claim_count_issues", "database_metadata"]


# Texts keep their spaces, and quotes inside a text are doubled.
CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}


def _schema_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/schemas/{name}"


def write_table(df: DataFrame, folder: str, name: str, kind: str = "parquet") -> str:
    """Writes (or replaces) one table; all executors write in parallel.

    A CSV table has its schema written beside it, so that it is read back with its types; an
    empty text comes back as NULL, which CSV does not tell apart.
    """
    path = f"{folder.rstrip('/')}/{name}"
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.options(**CSV).csv(path)
        df.sparkSession.createDataFrame([(df.schema.json(),)], "value string").coalesce(
            1).write.mode("overwrite").text(_schema_path(folder, name))
    else:
        writer.parquet(path)
    return path


def _csv(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A CSV table by the schema beside it; types are inferred only where there is none."""
    reader = spark.read.options(**CSV)
    try:
        written = spark.read.text(_schema_path(folder, name)).first()["value"]
    except AnalysisException:
        return reader.option("inferSchema", True).csv(f"{folder.rstrip('/')}/{name}")
    return reader.schema(StructType.fromJson(json.loads(written))).csv(f"{folder.rstrip('/')}/{name}")


def write_tables(tables: dict[str, DataFrame], folder: str, kind: str = "parquet") -> list[str]:
    return [write_table(df, folder, name, kind) for name, df in tables.items()]


def read_tables(
    spark: SparkSession, folder: str, names: list[str], kind: str = "parquet"
) -> dict[str, DataFrame]:
    """The named tables; a missing one is reported with all other missing ones."""
    found, absent = {}, []
    for name in names:
        path = f"{folder.rstrip('/')}/{name}"
        try:
            found[name] = _csv(spark, folder, name) if kind == "csv" else spark.read.parquet(path)
        except AnalysisException:
            absent.append(path)
    if absent:
        raise FileNotFoundError("Missing tables: " + ", ".join(absent))
    return found


def write_if_any(df: DataFrame, folder: str, name: str, kind: str = "parquet") -> str | None:
    """Writes the table only when it has rows."""
    return None if df.isEmpty() else write_table(df, folder, name, kind)
