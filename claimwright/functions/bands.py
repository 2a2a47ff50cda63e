"""Banding of a number by left-closed edges, in two flavours.

`cut` leaves what lies outside every band missing. `case_band` sends what is
missing to the last band and what is negative to the first, as a CASE ... ELSE
chain does. They differ on purpose: reports are built on either.
"""

from pyspark.sql import Column, DataFrame, functions as F

from claimwright import vocabulary as V


def cut(column: Column, edges: list, labels: list) -> Column:
    band = F.when(column >= edges[-1], labels[-1])
    for low, high, name in zip(edges[:-1], edges[1:], labels[:-1]):
        band = band.when((column >= low) & (column < high), name)
    return band


def case_band(column: Column, edges: list, labels: list) -> Column:
    chain = F.when(column < edges[1], labels[0])
    for high, name in zip(edges[2:], labels[1:-1]):
        chain = chain.when(column < high, name)
    return chain.otherwise(labels[-1])


def with_bands(df: DataFrame, names=tuple(V.BANDS)) -> DataFrame:
    """The rows with the named bands added."""
    return df.withColumns({n: cut(F.col(V.BANDS[n][0]), *V.BANDS[n][1:]) for n in names})


def claim_count_group(column: Column) -> Column:
    """0, 1, 2, 3 and 4+ as text."""
    return F.when(column >= 4, "4+").otherwise(column.cast("string"))


def claim_count_stratum(column: Column) -> Column:
    return (
        F.when(column == 0, "0 claims").when(column == 1, "1 claim").otherwise("2+ claims")
    )
