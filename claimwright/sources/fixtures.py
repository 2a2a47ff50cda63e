"""The two raw tables derived from the test tables (an order is a policy).

All columns are text, and some values are bad on purpose, so that every rule of
the cleaning and reconciliation steps has rows to act on.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_frequency(spark: SparkSession, folder: str) -> DataFrame:
    # Claims are counted before the join, so a hot order is one row on either side.
    returned = (
        _table(spark, folder, "lineitem")
        .filter("l_returnflag = 'R'")
        .groupBy("l_orderkey")
        .agg(F.count("*").alias("returned"))
    )
    return (
        _table(spark, folder, "orders")
        .join(_table(spark, folder, "customer"), F.expr("c_custkey = o_custkey"))
        .join(_table(spark, folder, "nation"), F.expr("n_nationkey = c_nationkey"))
        .join(returned, F.expr("l_orderkey = o_orderkey"), "left")
        .selectExpr(
            "CAST(o_orderkey AS STRING) AS IDpol",
            """CASE WHEN o_orderkey % 1009 = 0 THEN 'n/a'
                    WHEN o_orderkey % 1013 = 0 THEN '-1'
                    WHEN o_orderkey % 1019 = 0 THEN '1.5'
                    ELSE CAST(COALESCE(returned, 0) AS STRING) END AS ClaimNb""",
            """CASE WHEN o_orderkey % 1021 = 0 THEN '0'
                    ELSE CAST(CAST(1 + o_orderkey % 12 AS DOUBLE) / 12 AS STRING) END AS Exposure""",
            """CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE '' END
               || substr('ABCDEF', CAST(1 + o_custkey % 6 AS INT), 1) || ' ' AS Area""",
            "CAST(4 + o_custkey % 12 AS STRING) AS VehPower",
            """CASE WHEN o_orderkey % 211 = 0 THEN NULL
                    WHEN o_orderkey % 223 = 0 THEN '-1'
                    ELSE CAST(o_orderkey % 25 AS STRING) END AS VehAge""",
            """CASE WHEN o_orderkey % 227 = 0 THEN NULL
                    ELSE CAST(18 + o_custkey % 70 AS STRING) END AS DrivAge""",
            "CAST(50 + (o_orderkey * 7) % 111 AS STRING) AS BonusMalus",
            "'B' || CAST(1 + o_custkey % 14 AS STRING) AS VehBrand",
            "CASE WHEN o_orderstatus = 'F' THEN 'Diesel' ELSE 'Regular' END AS VehGas",
            """CASE WHEN o_orderkey % 229 = 0 THEN '0'
                    ELSE CAST(1 + (o_custkey * 37) % 27000 AS STRING) END AS Density""",
            "n_name AS Region",
        )
    )


def raw_severity(spark: SparkSession, folder: str) -> DataFrame:
    """Every returned line is a claim, and so is a first line kept at the highest tax.

    The latter are claims no policy reports. Some ids name no order, and some amounts
    are not valid, so that claims are missing.
    """
    return (
        _table(spark, folder, "lineitem")
        .filter("l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linenumber = 1 AND l_tax >= 0.08)")
        .selectExpr(
            """CAST(CASE WHEN l_orderkey % 97 = 0 THEN l_orderkey + 1000000000000
                    ELSE l_orderkey END AS STRING) AS IDpol""",
            """CASE WHEN l_orderkey % 499 = 0 THEN '0'
                    WHEN l_orderkey % 7 = 0 AND l_linenumber % 4 = 0 THEN '-1'
                    ELSE CAST(l_extendedprice AS STRING) END AS ClaimAmount""",
        )
    )
