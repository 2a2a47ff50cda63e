"""Cleaning: text to values, validity flags, selection of usable rows."""

from pyspark.sql import DataFrame, functions as F

from claimwright import vocabulary as V
from claimwright.functions.casting import (
    holds, lenient_double, lenient_long, missing_or, whole,
)


def clean_frequency(raw: DataFrame) -> DataFrame:
    """Raw policies with typed columns and nine validity flags.

    The claim-count flag looks at the number as given; the column itself becomes a
    long, so a fractional count ends up missing and its row invalid.
    """
    counts = lenient_double(raw, "ClaimNb")
    typed = raw.select(
        *[
            F.trim(F.col(c)).alias(c) if c in V.FREQUENCY_TEXTS
            else lenient_long(raw, c).alias(c) if c in ("IDpol", "ClaimNb")
            else lenient_double(raw, c).alias(c)
            for c in V.FREQUENCY_COLUMNS
        ],
        (holds(counts >= 0) & whole(counts)).alias("ValidClaimCount"),
    )
    flags = {
        "ValidPolicyID": holds(F.col("IDpol") > 0),
        "ValidClaimCount": F.col("ValidClaimCount"),
        "ValidExposure": holds(F.col("Exposure") > 0),
        "ValidVehicleAge": missing_or(F.col("VehAge"), F.col("VehAge") >= 0),
        "ValidDriverAge": missing_or(F.col("DrivAge"), F.col("DrivAge") >= 0),
        "ValidBonusMalus": missing_or(F.col("BonusMalus"), F.col("BonusMalus") >= 0),
        "ValidDensity": missing_or(F.col("Density"), F.col("Density") > 0),
    }
    flagged = typed.select(*V.FREQUENCY_COLUMNS, *[c.alias(n) for n, c in flags.items()])
    return flagged.withColumns(
        {
            "CorePolicyRecordValid": F.expr("ValidPolicyID AND ValidClaimCount AND ValidExposure"),
            "AnyPredictorValidityIssue": F.expr(
                "NOT (ValidVehicleAge AND ValidDriverAge AND ValidBonusMalus AND ValidDensity)"
            ),
        }
    )


def clean_severity(raw: DataFrame) -> DataFrame:
    """Raw claims with typed columns and three validity flags. Duplicates stay."""
    typed = raw.select(
        lenient_long(raw, "IDpol").alias("IDpol"),
        lenient_double(raw, "ClaimAmount").alias("ClaimAmount"),
    )
    return typed.withColumns(
        {
            "ValidPolicyID": holds(F.col("IDpol") > 0),
            "ValidClaimAmount": holds(F.col("ClaimAmount") > 0),
            "SeverityRecordValid": holds(F.col("IDpol") > 0) & holds(F.col("ClaimAmount") > 0),
        }
    )


def valid_frequency(cleaned: DataFrame) -> DataFrame:
    """Policies fit for analysis. Uniqueness of ids is a contract, see contracts."""
    return cleaned.filter("CorePolicyRecordValid")


def valid_severity(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter("SeverityRecordValid")
