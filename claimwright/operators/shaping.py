"""Wide one-row aggregates turned into long reports."""

from pyspark.sql import Column, DataFrame, functions as F


def long_report(row: DataFrame, names: tuple[str, str], measures: list[tuple]) -> DataFrame:
    """One output row per (label, column, ...) of a one-row table, in order."""
    structs = [
        F.struct(F.lit(label).alias(names[0]), column.alias(names[1]))
        for label, column in measures
    ]
    return row.select(F.explode(F.array(*structs)).alias("_m")).select("_m.*")


def stacked(reports: list[DataFrame]) -> DataFrame:
    """Row concatenation by column name."""
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def unpivoted(df: DataFrame, columns: list[str], kind: str, value: str, text: Column | None = None):
    """Each row once per named column, with the column's name and its text value.

    `text` may replace missing values; it is a function of a column.
    """
    text = text or (lambda c: c.cast("string"))
    pairs = [
        F.struct(F.lit(c).alias(kind), text(F.col(c)).alias(value)) for c in columns
    ]
    return df.withColumn("_pair", F.explode(F.array(*pairs))).select(
        "*", f"_pair.{kind}", f"_pair.{value}"
    ).drop("_pair")


def previewed(df: DataFrame, order: list, rows: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)
