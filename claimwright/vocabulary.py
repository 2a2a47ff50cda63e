"""Column names, labels, band edges and parameters.

Everything here is a constant of the data model. Results only agree with the
published reports when these agree, so they are stated plainly and together.
"""

from pyspark.sql import types as T

# --- columns of the two raw tables (fixed values) -------------------------
FREQUENCY_NUMBERS = [
    "IDpol", "ClaimNb", "Exposure", "VehPower", "VehAge", "DrivAge", "BonusMalus", "Density",
]
FREQUENCY_TEXTS = ["Area", "VehBrand", "VehGas", "Region"]
FREQUENCY_COLUMNS = [
    "IDpol", "ClaimNb", "Exposure", "Area", "VehPower", "VehAge", "DrivAge", "BonusMalus",
    "VehBrand", "VehGas", "Density", "Region",
]
SEVERITY_COLUMNS = ["IDpol", "ClaimAmount"]

# --- columns of the policy-level fact (fixed values) ----------------------
POLICY_COLUMNS = [
    "IDpol", "ClaimNb", "Exposure", "Area", "VehPower", "VehAge", "DrivAge", "BonusMalus",
    "VehBrand", "VehGas", "Density", "Region",
    "HasClaim", "HasSeverityRecord", "SeverityRowCount",
    "SeverityTotalClaimAmount", "SeverityAverageClaimAmount",
    "SeverityMinimumClaimAmount", "SeverityMaximumClaimAmount",
    "ClaimCountDifference", "ClaimCountMatch", "SeverityCompletenessStatus",
    "AnnualizedClaimFrequency", "ObservedAverageClaimAmount",
    "CompleteTotalClaimAmount", "CompleteAverageClaimAmount", "CompletePurePremium",
    "FrequencyModelEligible", "SeverityModelEligible", "PurePremiumModelEligible",
    "AnyPredictorValidityIssue",
]
POLICY_FLAGS = [
    "HasClaim", "HasSeverityRecord", "ClaimCountMatch", "FrequencyModelEligible",
    "SeverityModelEligible", "PurePremiumModelEligible", "AnyPredictorValidityIssue",
]
POLICY_COUNTS = ["IDpol", "ClaimNb", "SeverityRowCount", "ClaimCountDifference"]
ISSUE_COLUMNS = [
    "IDpol", "ClaimNb", "SeverityRowCount", "ClaimCountDifference", "ClaimCountMatch",
    "AuditStatus", "SourceStatus",
]
LOSS_COLUMNS = [
    "IDpol", "ClaimNb", "Exposure", "Area", "VehPower", "VehAge", "DrivAge", "BonusMalus",
    "VehBrand", "VehGas", "Region", "CompleteTotalClaimAmount", "CompletePurePremium",
]

# --- reconciliation statuses (fixed values) -------------------------------
NO_CLAIM = "no_claim_no_severity"
NO_SEVERITY = "claim_without_severity"
MATCHED = "matched_positive_claims"
FEWER = "fewer_severity_rows_than_claimnb"
MORE = "more_severity_rows_than_claimnb"
ORPHAN = "severity_without_frequency"
UNCLASSIFIED = "unclassified"

# --- bands: left-closed edges, the last one open above (fixed values) -----
DRIVER_AGE_EDGES = [0, 21, 25, 30, 40, 50, 60, 70, 80]
DRIVER_AGE_LABELS = [
    "Under 21", "21-24", "25-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80+",
]
VEHICLE_AGE_EDGES = [0, 1, 3, 6, 11, 16, 21]
VEHICLE_AGE_LABELS = ["0", "1-2", "3-5", "6-10", "11-15", "16-20", "21+"]
BONUS_MALUS_EDGES = [0, 60, 70, 80, 90, 100, 110, 130, 150]
BONUS_MALUS_LABELS = [
    "Below 60", "60-69", "70-79", "80-89", "90-99", "100-109", "110-129", "130-149", "150+",
]
BANDS = {
    "DrivAgeBand": ("DrivAge", DRIVER_AGE_EDGES, DRIVER_AGE_LABELS),
    "VehAgeBand": ("VehAge", VEHICLE_AGE_EDGES, VEHICLE_AGE_LABELS),
    "BonusMalusBand": ("BonusMalus", BONUS_MALUS_EDGES, BONUS_MALUS_LABELS),
}

# --- segmentations (fixed values) -----------------------------------------
RISK_SEGMENTS = [
    "Area", "VehGas", "Region", "VehBrand", "DrivAgeBand", "VehAgeBand", "BonusMalusBand",
]
FREQUENCY_SEGMENTS = ["Area", "VehGas", "DrivAgeBand", "BonusMalusBand"]
SEVERITY_SEGMENTS = [
    "Area", "VehGas", "VehBrand", "DrivAgeBand", "VehAgeBand", "BonusMalusBand",
]
SUBGROUPS = ["Area", "VehGas", "DrivAgeBand"]

# --- percentile points and their labels (fixed values) --------------------
REVIEW_POINTS = [
    (0.0, "Minimum"), (0.01, "1st percentile"), (0.05, "5th percentile"),
    (0.25, "25th percentile"), (0.50, "Median"), (0.75, "75th percentile"),
    (0.95, "95th percentile"), (0.99, "99th percentile"), (1.0, "Maximum"),
]
AMOUNT_POINTS = [
    (0.0, "Minimum"), (0.25, "25th percentile"), (0.50, "Median"), (0.75, "75th percentile"),
    (0.90, "90th percentile"), (0.95, "95th percentile"), (0.99, "99th percentile"),
    (0.995, "99.5th percentile"), (0.999, "99.9th percentile"), (1.0, "Maximum"),
]

# --- model inputs and parameters (fixed values) ---------------------------
OCCURRENCE_NUMBERS = ["LogExposure", "VehPower", "VehAge", "DrivAge", "BonusMalus", "LogDensity"]
RATE_NUMBERS = ["VehPower", "VehAge", "DrivAge", "BonusMalus", "LogDensity"]
MODEL_TEXTS = ["Area", "VehBrand", "VehGas", "Region"]
SEED = 42
EPSILON = 1e-12
CAPACITIES = [0.05, 0.10, 0.20, 0.30, 0.40, 0.50]
TAIL_SHARES = [0.01, 0.05, 0.10]
SUBGROUP_ROWS = 1_000
SUBGROUP_CLAIMS = 30
SEGMENT_EXPOSURE = 500
SEGMENT_POLICIES = 100
SEGMENT_CLAIMS = 100
REGION_EXPOSURE = 1_000
IMPORTANCE_REPEATS = 5
PREVIEW_ROWS = 2_000

BASELINE_OCCURRENCE = "No-claim baseline"
LOGISTIC = "Logistic regression"
BOOSTING = "Histogram gradient boosting"
BASELINE_FREQUENCY = "Constant frequency baseline"
POISSON = "Poisson regression"
BASELINE_SEVERITY = "Constant severity baseline"
GAMMA = "Gamma regression"

# --- raw schemas: text first, typed later ---------------------------------
RAW_FREQUENCY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FREQUENCY_COLUMNS])
RAW_SEVERITY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SEVERITY_COLUMNS])
