"""The same results as one SQL statement each, for an independent engine.

Common table expressions are kept by name and pulled in with what they need. Doubles
are rounded as `verification.base.shown` does.
"""

import re

CTES: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def _needs(sql: str, known) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql))
    return [n for n in known if n in words]


def sql(body: str) -> str:
    """The statement with the common tables it names, in dependency order."""
    wanted, queue = set(), _needs(body, CTES)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += [n for n in _needs(CTES[name], CTES) if n != name]
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in wanted]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def r(expression: str, name: str) -> str:
    """A double, rounded like the query's output."""
    x = f"({expression})"
    return (f"CASE WHEN abs({x}) >= 1e5 THEN round({x} + 1.3e-5, 2)"
            f" ELSE round({x} + 1.3e-9, 6) END + 0e0 AS {name}")


def rounded(inner: str, *doubles: str, order: str = "") -> str:
    """`inner` with the named double columns rounded."""
    swaps = ", ".join(r(f"q.{c}", c) for c in doubles)
    return sql(f"SELECT * REPLACE ({swaps}) FROM ({inner}) q {order}")


def share(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0)"


# --- inputs ------------------------------------------------------------------

CTES["raw_frequency"] = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS IDpol,
       CASE WHEN o.o_orderkey % 1009 = 0 THEN 'n/a'
            WHEN o.o_orderkey % 1013 = 0 THEN '-1'
            WHEN o.o_orderkey % 1019 = 0 THEN '1.5'
            ELSE CAST(COALESCE(k.n, 0) AS VARCHAR) END AS ClaimNb,
       CASE WHEN o.o_orderkey % 1021 = 0 THEN '0'
            ELSE CAST(CAST(1 + o.o_orderkey % 12 AS DOUBLE) / 12 AS VARCHAR) END AS Exposure,
       CASE WHEN o.o_orderkey % 5 = 0 THEN ' ' ELSE '' END
         || substr('ABCDEF', CAST(1 + o.o_custkey % 6 AS INT), 1) || ' ' AS Area,
       CAST(4 + o.o_custkey % 12 AS VARCHAR) AS VehPower,
       CASE WHEN o.o_orderkey % 211 = 0 THEN NULL
            WHEN o.o_orderkey % 223 = 0 THEN '-1'
            ELSE CAST(o.o_orderkey % 25 AS VARCHAR) END AS VehAge,
       CASE WHEN o.o_orderkey % 227 = 0 THEN NULL
            ELSE CAST(18 + o.o_custkey % 70 AS VARCHAR) END AS DrivAge,
       CAST(50 + (o.o_orderkey * 7) % 111 AS VARCHAR) AS BonusMalus,
       'B' || CAST(1 + o.o_custkey % 14 AS VARCHAR) AS VehBrand,
       CASE WHEN o.o_orderstatus = 'F' THEN 'Diesel' ELSE 'Regular' END AS VehGas,
       CASE WHEN o.o_orderkey % 229 = 0 THEN '0'
            ELSE CAST(1 + (o.o_custkey * 37) % 27000 AS VARCHAR) END AS Density,
       n.n_name AS Region
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem
           WHERE l_returnflag = 'R' GROUP BY l_orderkey) k
  ON k.l_orderkey = o.o_orderkey"""

CTES["raw_severity"] = """
SELECT CAST(CASE WHEN l_orderkey % 97 = 0 THEN l_orderkey + 1000000000000
            ELSE l_orderkey END AS VARCHAR) AS IDpol,
       CASE WHEN l_orderkey % 499 = 0 THEN '0'
            WHEN l_orderkey % 7 = 0 AND l_linenumber % 4 = 0 THEN '-1'
            ELSE CAST(l_extendedprice AS VARCHAR) END AS ClaimAmount
FROM lineitem
WHERE l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linenumber = 1 AND l_tax >= 0.08)"""

_NUMBERS = ["IDpol", "ClaimNb", "Exposure", "VehPower", "VehAge", "DrivAge", "BonusMalus",
            "Density"]

CTES["typed_frequency"] = "SELECT * REPLACE (" + ", ".join(
    f"TRY_CAST({c} AS {'BIGINT' if c == 'IDpol' else 'DOUBLE'}) AS {c}" for c in _NUMBERS
) + ") FROM raw_frequency"
CTES["typed_severity"] = """SELECT TRY_CAST(IDpol AS BIGINT) AS IDpol,
    TRY_CAST(ClaimAmount AS DOUBLE) AS ClaimAmount FROM raw_severity"""

CTES["frequency_clean"] = """
SELECT CAST(t.IDpol AS BIGINT) AS IDpol,
       CASE WHEN t.ClaimNb = floor(t.ClaimNb) THEN CAST(t.ClaimNb AS BIGINT) END AS ClaimNb,
       t.Exposure, trim(t.Area) AS Area, t.VehPower, t.VehAge, t.DrivAge, t.BonusMalus,
       trim(t.VehBrand) AS VehBrand, trim(t.VehGas) AS VehGas, t.Density,
       trim(t.Region) AS Region,
       COALESCE(t.IDpol > 0, false) AS ValidPolicyID,
       COALESCE(t.ClaimNb >= 0 AND t.ClaimNb = floor(t.ClaimNb), false) AS ValidClaimCount,
       COALESCE(t.Exposure > 0, false) AS ValidExposure,
       COALESCE(t.VehAge >= 0, true) AS ValidVehicleAge,
       COALESCE(t.DrivAge >= 0, true) AS ValidDriverAge,
       COALESCE(t.BonusMalus >= 0, true) AS ValidBonusMalus,
       COALESCE(t.Density > 0, true) AS ValidDensity,
       ValidPolicyID AND ValidClaimCount AND ValidExposure AS CorePolicyRecordValid,
       NOT (ValidVehicleAge AND ValidDriverAge AND ValidBonusMalus AND ValidDensity)
         AS AnyPredictorValidityIssue
FROM typed_frequency t"""

CTES["severity_clean"] = """
SELECT CAST(t.IDpol AS BIGINT) AS IDpol, t.ClaimAmount,
       COALESCE(t.IDpol > 0, false) AS ValidPolicyID,
       COALESCE(t.ClaimAmount > 0, false) AS ValidClaimAmount,
       ValidPolicyID AND ValidClaimAmount AS SeverityRecordValid
FROM typed_severity t"""

CTES["valid_policy"] = "SELECT * FROM frequency_clean WHERE CorePolicyRecordValid"
CTES["valid_claim"] = "SELECT IDpol, ClaimAmount FROM severity_clean WHERE SeverityRecordValid"

CTES["by_policy"] = """
SELECT IDpol, count(*) AS SeverityRowCount, sum(ClaimAmount) AS SeverityTotalClaimAmount,
       avg(ClaimAmount) AS SeverityAverageClaimAmount,
       min(ClaimAmount) AS SeverityMinimumClaimAmount,
       max(ClaimAmount) AS SeverityMaximumClaimAmount
FROM valid_claim GROUP BY IDpol"""

CTES["status_rules"] = """
SELECT * FROM (VALUES (1, 'no_claim_no_severity'), (2, 'claim_without_severity'),
  (3, 'matched_positive_claims'), (4, 'fewer_severity_rows_than_claimnb'),
  (5, 'more_severity_rows_than_claimnb'), (6, 'severity_without_frequency')) t(rule, status)"""

_RULE = """CASE WHEN a.nb = 0 AND a.rows = 0 THEN 1 WHEN a.rows = 0 THEN 2
  WHEN a.nb = a.rows THEN 3 WHEN a.rows < a.nb THEN 4 ELSE 5 END"""

CTES["audit"] = f"""
SELECT a.id AS IDpol, a.nb AS ClaimNb, a.rows AS SeverityRowCount, a.side AS _merge,
       a.nb - a.rows AS ClaimCountDifference, a.nb = a.rows AS ClaimCountMatch,
       s.status AS AuditStatus
FROM (SELECT COALESCE(p.IDpol, b.IDpol) AS id, COALESCE(p.ClaimNb, 0) AS nb,
             COALESCE(b.SeverityRowCount, 0) AS rows,
             CASE WHEN p.IDpol IS NULL THEN 'right_only' WHEN b.IDpol IS NULL THEN 'left_only'
                  ELSE 'both' END AS side
      FROM valid_policy p FULL JOIN by_policy b ON b.IDpol = p.IDpol) a
JOIN status_rules s ON s.rule = CASE WHEN a.side = 'right_only' THEN 6 ELSE {_RULE} END"""

CTES["policy_fact"] = f"""
SELECT a.IDpol, a.ClaimNb, a.Exposure, a.Area, a.VehPower, a.VehAge, a.DrivAge, a.BonusMalus,
       a.VehBrand, a.VehGas, a.Density, a.Region,
       CAST(a.nb > 0 AS INT) AS HasClaim, CAST(a.rows > 0 AS INT) AS HasSeverityRecord,
       a.rows AS SeverityRowCount, a.total AS SeverityTotalClaimAmount,
       a.SeverityAverageClaimAmount, a.SeverityMinimumClaimAmount, a.SeverityMaximumClaimAmount,
       a.nb - a.rows AS ClaimCountDifference, a.nb = a.rows AS ClaimCountMatch,
       s.status AS SeverityCompletenessStatus,
       a.nb / a.Exposure AS AnnualizedClaimFrequency,
       a.total / NULLIF(a.rows, 0) AS ObservedAverageClaimAmount,
       CASE WHEN a.nb = a.rows THEN a.total END AS CompleteTotalClaimAmount,
       CASE WHEN a.nb = a.rows AND a.nb > 0 THEN a.total / a.nb END
         AS CompleteAverageClaimAmount,
       CASE WHEN a.nb = a.rows THEN a.total / a.Exposure END AS CompletePurePremium,
       true AS FrequencyModelEligible, a.nb = a.rows AND a.nb > 0 AS SeverityModelEligible,
       a.nb = a.rows AS PurePremiumModelEligible, a.AnyPredictorValidityIssue
FROM (SELECT p.*, b.* EXCLUDE (IDpol), p.ClaimNb AS nb,
             COALESCE(b.SeverityRowCount, 0) AS rows,
             COALESCE(b.SeverityTotalClaimAmount, 0e0) AS total
      FROM valid_policy p LEFT JOIN by_policy b ON b.IDpol = p.IDpol) a
JOIN status_rules s ON s.rule = {_RULE}"""

FLAGS = ["ClaimCountMatch", "FrequencyModelEligible", "SeverityModelEligible",
         "PurePremiumModelEligible", "AnyPredictorValidityIssue"]
CTES["typed_policies"] = "SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS INT) AS {c}" for c in FLAGS) + ") FROM policy_fact"
CTES["matched"] = "SELECT c.* FROM valid_claim c WHERE c.IDpol IN (SELECT IDpol FROM valid_policy)"
CTES["orphaned"] = (
    "SELECT c.* FROM valid_claim c WHERE c.IDpol NOT IN (SELECT IDpol FROM valid_policy)")
CTES["issues"] = """
SELECT IDpol, ClaimNb, SeverityRowCount, ClaimCountDifference,
       CAST(ClaimCountMatch AS INT) AS ClaimCountMatch, AuditStatus, _merge AS SourceStatus
FROM audit WHERE NOT ClaimCountMatch"""

POLICY_DOUBLES = [
    "Exposure", "VehPower", "VehAge", "DrivAge", "BonusMalus", "Density",
    "SeverityTotalClaimAmount", "SeverityAverageClaimAmount", "SeverityMinimumClaimAmount",
    "SeverityMaximumClaimAmount", "AnnualizedClaimFrequency", "ObservedAverageClaimAmount",
    "CompleteTotalClaimAmount", "CompleteAverageClaimAmount", "CompletePurePremium",
]
_RAW_DOUBLES = ["Exposure", "VehPower", "VehAge", "DrivAge", "BonusMalus", "Density"]

# --- cleaning and preparation -------------------------------------------------

ORACLE["clean_frequency"] = rounded("SELECT * FROM frequency_clean", *_RAW_DOUBLES)
ORACLE["clean_severity"] = rounded("SELECT * FROM severity_clean", "ClaimAmount")
_COLUMNS = ["IDpol", "ClaimNb", "Exposure", "Area", "VehPower", "VehAge", "DrivAge",
            "BonusMalus", "VehBrand", "VehGas", "Density", "Region"]
ORACLE["column_contract"] = sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "Column", 'string' AS DataType, 'expected' AS Status,
        count({c}) AS Present, count(*) AS "Rows" FROM raw_frequency""" for c in _COLUMNS))
ORACLE["boolean_words"] = """
WITH words AS (SELECT CASE o_orderkey % 6 WHEN 0 THEN ' True ' WHEN 1 THEN 'FALSE'
    WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN o_orderstatus END AS w FROM orders),
  known AS (SELECT CASE WHEN lower(trim(w)) IN ('true', '1') THEN true
    WHEN lower(trim(w)) IN ('false', '0') THEN false END AS Known FROM words)
SELECT Known, COALESCE(Known, false) AS Lenient, count(*) AS Words FROM known GROUP BY 1, 2"""
_SEVERITY_DOUBLES = ["SeverityTotalClaimAmount", "SeverityAverageClaimAmount",
                     "SeverityMinimumClaimAmount", "SeverityMaximumClaimAmount"]
ORACLE["severity_by_policy"] = rounded("SELECT * FROM by_policy", *_SEVERITY_DOUBLES)
ORACLE["claim_count_audit"] = sql("SELECT * FROM audit")


def _shares(table: str, column: str, name: str, count: str, percentage: str) -> str:
    return rounded(
        f"""SELECT {column} AS {name}, count(*) AS {count},
            100e0 * count(*) / (SELECT count(*) FROM {table}) AS {percentage}
            FROM {table} GROUP BY 1""", percentage)


ORACLE["audit_summary"] = _shares("audit", "AuditStatus", "AuditStatus", "PolicyCount",
                                  "Percentage")
ORACLE["policy_analytics"] = rounded("SELECT * FROM policy_fact", *POLICY_DOUBLES)
ORACLE["stored_policies"] = ORACLE["policy_analytics"]
ORACLE["policies_table"] = rounded("SELECT * FROM typed_policies", *POLICY_DOUBLES)
ORACLE["policy_preview"] = rounded(
    "SELECT * FROM policy_fact ORDER BY IDpol LIMIT 5", *POLICY_DOUBLES)


def _missing(table: str, columns: list[str]) -> str:
    return "(SELECT " + " + ".join(
        f"count(*) - count({c})" for c in columns) + f" FROM {table})"


_CLEAN_COLUMNS = _COLUMNS


def _measures(pairs: list[tuple[str, str]], first: str, second: str, kind: str) -> str:
    return sql(" UNION ALL ".join(
        f"SELECT '{n}' AS {first}, CAST({e} AS {kind}) AS {second}" for n, e in pairs))


ORACLE["preparation_summary"] = _measures([
    ("Raw frequency rows", "(SELECT count(*) FROM raw_frequency)"),
    ("Raw severity rows", "(SELECT count(*) FROM raw_severity)"),
    ("Valid frequency rows", "(SELECT count(*) FROM valid_policy)"),
    ("Invalid core frequency rows",
     "(SELECT count(*) FROM frequency_clean WHERE NOT CorePolicyRecordValid)"),
    ("Valid severity rows", "(SELECT count(*) FROM valid_claim)"),
    ("Invalid severity rows",
     "(SELECT count(*) FROM severity_clean WHERE NOT SeverityRecordValid)"),
    ("Cleaned frequency missing values", _missing("frequency_clean", _CLEAN_COLUMNS)),
    ("Cleaned severity missing values", _missing("severity_clean", ["IDpol", "ClaimAmount"])),
    ("Cross-table mismatched policy IDs", "(SELECT count(*) FROM issues)"),
    ("Severity IDs without frequency record",
     "(SELECT count(*) FROM audit WHERE _merge = 'right_only')"),
    ("Frequency policies with count mismatch",
     "(SELECT count(*) FROM policy_fact WHERE NOT ClaimCountMatch)"),
    ("Final policy analytics rows", "(SELECT count(*) FROM policy_fact)"),
    ("Frequency-model eligible policies",
     "(SELECT count(*) FROM policy_fact WHERE FrequencyModelEligible)"),
    ("Severity-model eligible policies",
     "(SELECT count(*) FROM policy_fact WHERE SeverityModelEligible)"),
    ("Pure-premium-model eligible policies",
     "(SELECT count(*) FROM policy_fact WHERE PurePremiumModelEligible)"),
    ("Claims reported by ClaimNb", "(SELECT sum(ClaimNb) FROM valid_policy)"),
    ("Valid severity claim rows", "(SELECT count(*) FROM valid_claim)"),
], "Measure", "Value", "BIGINT")

_UNIQUE = "(SELECT count(*) = count(DISTINCT IDpol) FROM policy_fact)"


def _checks(pairs: list[tuple[str, str]]) -> str:
    return _measures(pairs, "Validation", "Passed", "BOOLEAN")


def _none(table: str, condition: str) -> str:
    return f"(SELECT count(*) = 0 FROM {table} WHERE {condition})"


ORACLE["preparation_checks"] = _checks([
    ("Policy IDs are unique", _UNIQUE),
    ("All exposure values are positive", _none("policy_fact", "NOT (Exposure > 0)")),
    ("All claim counts are non-negative", _none("policy_fact", "ClaimNb < 0")),
    ("Annualized frequency is non-negative",
     _none("policy_fact", "AnnualizedClaimFrequency < 0")),
    ("No audit rows are unclassified", _none("audit", "AuditStatus = 'unclassified'")),
])
ORACLE["output_checks"] = _checks([
    ("Policy IDs are unique", _UNIQUE),
    ("Exposure is positive", _none("policy_fact", "Exposure <= 0")),
    ("Incomplete policies carry no complete amount",
     _none("policy_fact", "NOT ClaimCountMatch AND CompleteTotalClaimAmount IS NOT NULL")),
    ("Complete zero-claim policies have amount zero",
     _none("policy_fact", "ClaimNb = 0 AND ClaimCountMatch AND "
           "CompleteTotalClaimAmount IS DISTINCT FROM 0")),
    ("No audit rows are unclassified", _none("audit", "AuditStatus = 'unclassified'")),
])
ORACLE["analysis_checks"] = _checks([
    ("Policy IDs are unique", _UNIQUE),
    ("Exposure is positive", _none("policy_fact", "NOT (Exposure > 0)")),
    ("Claim counts are non-negative", _none("policy_fact", "ClaimNb < 0")),
    ("HasClaim contains only zero and one", _none("policy_fact", "HasClaim NOT IN (0, 1)")),
    ("Frequency model eligibility is complete",
     _none("policy_fact", "NOT FrequencyModelEligible")),
    ("Severity model sample is non-empty",
     "(SELECT count(*) > 0 FROM policy_fact WHERE SeverityModelEligible)"),
    ("Pure premium model sample is non-empty",
     "(SELECT count(*) > 0 FROM policy_fact WHERE PurePremiumModelEligible)"),
])

# --- relational layer -----------------------------------------------------------

_NUMBERED = """SELECT row_number() OVER (ORDER BY IDpol, ClaimAmount) AS {0}, IDpol, ClaimAmount
FROM {1}"""
ORACLE["claims_table"] = rounded(_NUMBERED.format("ClaimID", "matched"), "ClaimAmount")
ORACLE["orphan_claims_table"] = rounded(
    _NUMBERED.format("OrphanClaimID", "orphaned"), "ClaimAmount")
ORACLE["claim_count_issues"] = sql("SELECT * FROM issues")
ORACLE["foreign_key_violations"] = sql(
    "SELECT IDpol, count(*) AS ClaimRows FROM orphaned GROUP BY IDpol")
ORACLE["unknown_claim_ids"] = sql("SELECT DISTINCT IDpol FROM orphaned")
ORACLE["duplicate_claim_ids"] = sql(
    "SELECT IDpol, count(*) AS RowCount FROM valid_claim GROUP BY IDpol HAVING count(*) > 1")


def _broken(table: str, source: str, rules: list[tuple[str, str]]) -> list[str]:
    return [
        f"SELECT '{table}' AS TableName, '{n}' AS Rule, count(*) AS Violations FROM {source}"
        f" WHERE NOT COALESCE({rule}, true)" for n, rule in rules]


_PRESENT = ["IDpol", "ClaimNb", "Exposure", "HasClaim", "HasSeverityRecord", "SeverityRowCount",
            "SeverityTotalClaimAmount", "ClaimCountDifference", "ClaimCountMatch",
            "SeverityCompletenessStatus", "AnnualizedClaimFrequency", "FrequencyModelEligible",
            "SeverityModelEligible", "PurePremiumModelEligible", "AnyPredictorValidityIssue"]
_ISSUE_PRESENT = ["IDpol", "ClaimNb", "SeverityRowCount", "ClaimCountDifference",
                  "ClaimCountMatch", "AuditStatus", "SourceStatus"]
_CLAIM_RULES = [("IDpol is present", "IDpol IS NOT NULL"),
                ("ClaimAmount is present", "ClaimAmount IS NOT NULL"),
                ("ClaimAmount is positive", "ClaimAmount > 0")]
CTES["matched_ids"] = """SELECT IDpol, ClaimAmount, row_number() OVER (ORDER BY IDpol, ClaimAmount) AS ClaimID
    FROM matched"""
CTES["orphaned_ids"] = """SELECT IDpol, ClaimAmount,
    row_number() OVER (ORDER BY IDpol, ClaimAmount) AS OrphanClaimID FROM orphaned"""
CTES["metadata_rows"] = " UNION ALL ".join([
    "SELECT 'database_build_timestamp_utc' AS MetadataKey, 'fixed' AS MetadataValue",
    "SELECT 'source_dataset', 'fixture'",
    *[f"SELECT '{k}', CAST(count(*) AS VARCHAR) FROM {t}" for k, t in [
        ("policy_rows", "typed_policies"), ("matched_claim_rows", "matched"),
        ("orphan_claim_rows", "orphaned"), ("claim_count_issue_rows", "issues")]]])


def _repeated(table: str, key: str, keys: str) -> str:
    return f"""SELECT '{table}' AS TableName, '{key} is unique' AS Rule, count(*) AS Violations
        FROM (SELECT {key} FROM ({keys}) GROUP BY 1 HAVING count(*) > 1)"""


ORACLE["constraint_violations"] = sql(" UNION ALL ".join(
    _broken("policies", "typed_policies", [
        *[(f"{c} is present", f"{c} IS NOT NULL") for c in _PRESENT],
        *[(f"{c} is not negative", f"{c} >= 0") for c in [
            "ClaimNb", "SeverityRowCount", "SeverityTotalClaimAmount",
            "AnnualizedClaimFrequency"]],
        ("Exposure is positive", "Exposure > 0"),
        *[(f"{c} is zero or one", f"{c} IN (0, 1)") for c in
          ["HasClaim", "HasSeverityRecord", *FLAGS]],
    ])
    + _broken("claims", "matched_ids", [("ClaimID is present", "ClaimID IS NOT NULL"), *_CLAIM_RULES])
    + _broken("orphan_claims", "orphaned_ids",
              [("OrphanClaimID is present", "OrphanClaimID IS NOT NULL"), *_CLAIM_RULES])
    + _broken("database_metadata", "metadata_rows", [
        (f"{c} is present", f"{c} IS NOT NULL") for c in ("MetadataKey", "MetadataValue")])
    + [_repeated("policies", "IDpol", "SELECT IDpol FROM typed_policies"),
       _repeated("claims", "ClaimID", "SELECT ClaimID FROM matched_ids"),
       _repeated("orphan_claims", "OrphanClaimID", "SELECT OrphanClaimID FROM orphaned_ids"),
       _repeated("claim_count_issues", "IDpol", "SELECT IDpol FROM issues"),
       _repeated("database_metadata", "MetadataKey", "SELECT MetadataKey FROM metadata_rows")]
    + _broken("claim_count_issues", "issues", [
        *[(f"{c} is present", f"{c} IS NOT NULL") for c in _ISSUE_PRESENT],
        *[(f"{c} is not negative", f"{c} >= 0") for c in ["ClaimNb", "SeverityRowCount"]],
        ("ClaimCountMatch is zero or one", "ClaimCountMatch IN (0, 1)"),
    ])))
ORACLE["repeated_key_violations"] = sql(" UNION ALL ".join([
    _repeated("policies", "IDpol", "SELECT IDpol FROM matched"),
    _repeated("claims", "ClaimID", "SELECT ClaimID FROM matched_ids"),
    _repeated("orphan_claims", "OrphanClaimID", "SELECT OrphanClaimID FROM orphaned_ids"),
    _repeated("claim_count_issues", "IDpol", "SELECT IDpol FROM orphaned"),
    _repeated("database_metadata", "MetadataKey", """SELECT MetadataKey FROM metadata_rows UNION ALL
        SELECT MetadataKey FROM metadata_rows WHERE MetadataKey LIKE '%rows'""")]))
ORACLE["raw_constraint_violations"] = sql(
    " UNION ALL ".join(_broken("claims", "severity_clean", _CLAIM_RULES)))
_TABLES = [("policies", "typed_policies"), ("claims", "matched"), ("orphan_claims", "orphaned"),
           ("claim_count_issues", "issues")]
ORACLE["table_counts"] = sql(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in _TABLES))
ORACLE["build_metadata"] = sql("SELECT * FROM metadata_rows")

# --- portfolio reports ------------------------------------------------------------

_SEV = "FILTER (WHERE SeverityModelEligible)"
_PP = "FILTER (WHERE PurePremiumModelEligible)"
COST = "CompleteTotalClaimAmount"
TOTALS = f"""count(*) AS Policies, sum(Exposure) AS Exposure,
  CAST(sum(ClaimNb) AS BIGINT) AS Claims, CAST(sum(HasClaim) AS BIGINT) AS PoliciesWithClaim,
  count(*) {_PP} AS CompleteLossPolicies,
  COALESCE(sum(Exposure) {_PP}, 0e0) AS CompleteLossExposure,
  COALESCE(sum({COST}) {_PP}, 0e0) AS CompleteClaimCost,
  count(*) {_SEV} AS CompletePositivePolicies,
  CAST(COALESCE(sum(ClaimNb) {_SEV}, 0) AS BIGINT) AS CompletePositiveClaims,
  COALESCE(sum({COST}) {_SEV}, 0e0) AS CompletePositiveClaimCost"""
RATIOS = f"""{share('PoliciesWithClaim', 'Policies')} AS ClaimOccurrenceRate,
  {share('Claims', 'Exposure')} AS ClaimFrequency,
  100 * {share('Claims', 'Exposure')} AS ClaimsPer100ExposureYears,
  {share('CompletePositiveClaimCost', 'CompletePositiveClaims')} AS AverageClaimSeverity,
  {share('CompleteClaimCost', 'CompleteLossExposure')} AS PurePremium,
  100 * {share('CompleteLossPolicies', 'Policies')} AS CompleteLossPercentage"""


def segments(by: str, source: str = "policy_fact") -> str:
    """Totals and ratios per group of `by` (a select list, or empty)."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return (f"SELECT t.*, {RATIOS} FROM (SELECT {keys}{TOTALS} FROM {source} {group}) t")


CTES["kpis"] = f"""SELECT Policies AS total_policies, Exposure AS total_exposure_years,
  Claims AS total_reported_claims, PoliciesWithClaim AS policies_with_claims,
  ClaimOccurrenceRate AS claim_occurrence_rate, ClaimFrequency AS claim_frequency,
  ClaimsPer100ExposureYears AS claims_per_100_exposure_years,
  CompleteLossPolicies AS complete_loss_policies, CompleteClaimCost AS complete_claim_cost,
  AverageClaimSeverity AS average_claim_severity, PurePremium AS pure_premium
FROM ({segments('')})"""
_KPI_DOUBLES = ["total_exposure_years", "claim_occurrence_rate", "claim_frequency",
                "claims_per_100_exposure_years", "complete_claim_cost",
                "average_claim_severity", "pure_premium"]
ORACLE["portfolio_kpis"] = rounded("SELECT * FROM kpis", *_KPI_DOUBLES)
_KPI_TEXTS = [
    ("total_policies", "Total policies", "Number of policies"),
    ("total_exposure_years", "Total exposure years", "Combined observed coverage period"),
    ("total_reported_claims", "Total reported claims", "Sum of ClaimNb"),
    ("policies_with_claims", "Policies with at least one claim",
     "Policies where ClaimNb is greater than zero"),
    ("claim_occurrence_rate", "Claim occurrence rate",
     "Policies with claims divided by all policies"),
    ("claim_frequency", "Claim frequency", "Claims divided by exposure"),
    ("claims_per_100_exposure_years", "Claims per 100 exposure-years",
     "Claim frequency multiplied by 100"),
    ("complete_loss_policies", "Complete loss policies",
     "Policies with complete frequency and severity outcomes"),
    ("complete_claim_cost", "Complete claim cost", "Claim cost among complete policies"),
    ("average_claim_severity", "Average claim severity",
     "Complete positive claim cost divided by complete claims"),
    ("pure_premium", "Pure premium", "Complete claim cost divided by complete exposure"),
]
ORACLE["portfolio_summary"] = rounded(" UNION ALL ".join(
    f"SELECT '{m}' AS Metric, CAST({k} AS DOUBLE) AS Value, '{d}' AS Definition FROM kpis"
    for k, m, d in _KPI_TEXTS), "Value")
# The second side is computed on its own, from the rows and not from the totals.
CTES["kpis_again"] = """SELECT count(*) AS total_policies, sum(Exposure) AS total_exposure_years,
  sum(ClaimNb) AS total_reported_claims, sum(HasClaim) AS policies_with_claims,
  avg(CAST(HasClaim AS DOUBLE)) AS claim_occurrence_rate,
  sum(ClaimNb) / sum(Exposure) AS claim_frequency,
  sum(100 * ClaimNb) / sum(Exposure) AS claims_per_100_exposure_years,
  sum(CASE WHEN PurePremiumModelEligible THEN 1 ELSE 0 END) AS complete_loss_policies,
  sum(CASE WHEN PurePremiumModelEligible THEN CompleteTotalClaimAmount END) AS complete_claim_cost,
  sum(CASE WHEN SeverityModelEligible THEN CompleteTotalClaimAmount END)
    / sum(CASE WHEN SeverityModelEligible THEN ClaimNb END) AS average_claim_severity,
  sum(CASE WHEN PurePremiumModelEligible THEN CompleteTotalClaimAmount END)
    / sum(CASE WHEN PurePremiumModelEligible THEN Exposure END) AS pure_premium
FROM policy_fact"""
ORACLE["kpi_reconciliation"] = rounded("""SELECT *, abs(DataFrameValue - SQLValue) AS AbsoluteDifference,
  abs(DataFrameValue - SQLValue) <= 1e-6 + 1e-9 * abs(SQLValue) AS Passed FROM (""" + " UNION ALL ".join(
    f"SELECT '{k}' AS Metric, CAST(a.{k} AS DOUBLE) AS DataFrameValue,"
    f" CAST(b.{k} AS DOUBLE) AS SQLValue FROM kpis a, kpis_again b"
    for k, _, _ in _KPI_TEXTS) + ")", "DataFrameValue", "SQLValue", "AbsoluteDifference")
CTES["areas"] = f"""SELECT Area, Policies AS policies, Exposure AS exposure, Claims AS claims,
  PoliciesWithClaim AS policies_with_claim, ClaimOccurrenceRate AS claim_occurrence_rate,
  ClaimFrequency AS claim_frequency,
  ClaimsPer100ExposureYears AS claims_per_100_exposure_years,
  AverageClaimSeverity AS average_claim_severity, PurePremium AS pure_premium,
  CompleteLossPercentage AS complete_loss_percentage FROM ({segments('Area')})"""
ORACLE["area_metrics"] = rounded(
    "SELECT * FROM areas", "exposure", "claim_occurrence_rate", "claim_frequency",
    "claims_per_100_exposure_years", "average_claim_severity", "pure_premium",
    "complete_loss_percentage")
ORACLE["area_ranking"] = rounded(
    "SELECT Area, policies, exposure, claims, claims_per_100_exposure_years FROM areas",
    "exposure", "claims_per_100_exposure_years")
ORACLE["sql_on_views"] = rounded(
    """SELECT a.Area, a.claims, a.pure_premium, k.pure_premium AS portfolio_pure_premium
       FROM areas a, kpis k WHERE a.claims > 0""", "pure_premium", "portfolio_pure_premium")

DRIVER_EDGES = [0, 21, 25, 30, 40, 50, 60, 70, 80]
DRIVER_LABELS = ["Under 21", "21-24", "25-29", "30-39", "40-49", "50-59", "60-69", "70-79",
                 "80+"]
VEHICLE_EDGES = [0, 1, 3, 6, 11, 16, 21]
VEHICLE_LABELS = ["0", "1-2", "3-5", "6-10", "11-15", "16-20", "21+"]
BONUS_EDGES = [0, 60, 70, 80, 90, 100, 110, 130, 150]
BONUS_LABELS = ["Below 60", "60-69", "70-79", "80-89", "90-99", "100-109", "110-129",
                "130-149", "150+"]


def case_band(column: str, edges: list, labels: list) -> str:
    """Missing goes to the last band, negative to the first."""
    arms = " ".join(f"WHEN {column} < {e} THEN '{n}'" for e, n in zip(edges[1:], labels))
    return f"CASE {arms} ELSE '{labels[-1]}' END"


def cut_band(column: str, edges: list, labels: list) -> str:
    """Missing and negative have no band."""
    return (f"CASE WHEN {column} IS NULL OR {column} < 0 THEN NULL ELSE "
            f"{case_band(column, edges, labels)} END")


def _band_metrics(name: str, case: str, *extra: str) -> str:
    inner = segments(name, f"(SELECT *, {case} AS {name} FROM policy_fact)")
    severity = "AverageClaimSeverity AS average_claim_severity, " if extra else ""
    return rounded(
        f"""SELECT {name}, Policies AS policies, Exposure AS exposure, Claims AS claims,
            ClaimsPer100ExposureYears AS claims_per_100_exposure_years, {severity}
            PurePremium AS pure_premium FROM ({inner})""",
        "exposure", "claims_per_100_exposure_years", "pure_premium", *extra)


ORACLE["driver_age_metrics"] = _band_metrics(
    "driver_age_band", case_band("DrivAge", DRIVER_EDGES, DRIVER_LABELS),
    "average_claim_severity")
ORACLE["bonus_malus_metrics"] = _band_metrics(
    "bonus_malus_band", case_band("BonusMalus", BONUS_EDGES, BONUS_LABELS))
ORACLE["top_regions"] = rounded(
    f"""SELECT Region, Policies AS policies, CompleteLossExposure AS complete_loss_exposure,
        PurePremium AS pure_premium FROM ({segments('Region')})
        WHERE CompleteLossExposure >= 100 ORDER BY PurePremium DESC, Region LIMIT 10""",
    "complete_loss_exposure", "pure_premium")
ORACLE["largest_losses"] = rounded(
    f"""SELECT IDpol, ClaimNb, Exposure, Area, VehPower, VehAge, DrivAge, BonusMalus, VehBrand,
        VehGas, Region, {COST}, CompletePurePremium FROM policy_fact
        WHERE PurePremiumModelEligible AND {COST} > 0
        ORDER BY {COST} DESC, IDpol LIMIT 20""",
    "Exposure", "VehPower", "VehAge", "DrivAge", "BonusMalus", COST, "CompletePurePremium")
ORACLE["model_eligibility"] = rounded(" UNION ALL ".join(
    f"""SELECT '{n}' AS model_sample, count(*) FILTER (WHERE {c}) AS eligible_policies,
        100e0 * count(*) FILTER (WHERE {c}) / count(*) AS eligible_percentage
        FROM policy_fact""" for n, c in [
        ("Frequency model", "FrequencyModelEligible"),
        ("Severity model", "SeverityModelEligible"),
        ("Pure premium model", "PurePremiumModelEligible")]), "eligible_percentage")
ORACLE["claim_completeness"] = _shares(
    "policy_fact", "SeverityCompletenessStatus", "completeness_status", "policy_count",
    "percentage")
ORACLE["claim_count_distribution"] = _shares(
    "valid_policy", "CASE WHEN ClaimNb < 4 THEN CAST(ClaimNb AS VARCHAR) ELSE '4+' END",
    "claim_count_group", "policy_count", "percentage")
ORACLE["claim_count_bars"] = sql(" UNION ALL ".join(
    f"SELECT '{n}' AS ClaimCountGroup, count(*) AS PolicyCount FROM valid_policy WHERE {c}"
    for n, c in [("0", "ClaimNb = 0"), ("1", "ClaimNb = 1"), ("2", "ClaimNb = 2"),
                 ("3", "ClaimNb = 3"), ("4+", "ClaimNb > 3")]))
ORACLE["claim_occurrence_counts"] = rounded(" UNION ALL ".join(
    f"""SELECT '{n}' AS ClaimStatus, count(*) FILTER (WHERE HasClaim = {v}) AS PolicyCount,
        count(*) FILTER (WHERE HasClaim = {v}) / count(*) AS Share FROM policy_fact"""
    for n, v in [("No claim", 0), ("At least one claim", 1)]), "Share")
ORACLE["issue_types"] = sql("""SELECT AuditStatus, count(*) AS policy_count,
    CAST(sum(ClaimCountDifference) AS BIGINT) AS total_count_difference
    FROM issues GROUP BY AuditStatus""")
CTES["orphan_groups"] = """SELECT IDpol, count(*) AS claim_rows,
    sum(ClaimAmount) AS total_claim_amount FROM orphaned GROUP BY IDpol"""
ORACLE["orphans_by_policy"] = rounded("SELECT * FROM orphan_groups", "total_claim_amount")
ORACLE["orphan_summary"] = rounded(
    """SELECT count(*) AS orphan_claim_rows, count(DISTINCT IDpol) AS orphan_policy_ids,
       sum(ClaimAmount) AS orphan_claim_amount FROM orphaned""", "orphan_claim_amount")
ORACLE["incomplete_policies"] = rounded(
    f"""SELECT IDpol, ClaimNb, SeverityRowCount, ClaimCountDifference,
        SeverityTotalClaimAmount, {COST}, SeverityCompletenessStatus
        FROM policy_fact WHERE NOT ClaimCountMatch""", "SeverityTotalClaimAmount", COST)
ORACLE["complete_zero_claim_policies"] = rounded(
    f"""SELECT IDpol, ClaimNb, SeverityRowCount, {COST}, CompletePurePremium FROM policy_fact
        WHERE ClaimNb = 0 AND ClaimCountMatch""", COST, "CompletePurePremium")

# --- quality reports ----------------------------------------------------------------

ORACLE["missing_values"] = rounded(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count,
        100e0 * (count(*) - count({c})) / count(*) AS missing_percentage FROM typed_frequency"""
    for c in _COLUMNS), "missing_percentage")
ORACLE["numeric_describe"] = rounded(" UNION ALL ".join(
    f"""SELECT '{c}' AS Variable, count({c}) AS count, avg({c}) AS mean,
        stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS p25,
        quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, max({c}) AS max
        FROM typed_frequency""" for c in _NUMBERS),
    "mean", "std", "min", "p25", "p50", "p75", "max")
_REVIEW = [(0.0, "Minimum"), (0.01, "1st percentile"), (0.05, "5th percentile"),
           (0.25, "25th percentile"), (0.5, "Median"), (0.75, "75th percentile"),
           (0.95, "95th percentile"), (0.99, "99th percentile"), (1.0, "Maximum")]
_AMOUNT = [(0.0, "Minimum"), (0.25, "25th percentile"), (0.5, "Median"),
           (0.75, "75th percentile"), (0.9, "90th percentile"), (0.95, "95th percentile"),
           (0.99, "99th percentile"), (0.995, "99.5th percentile"),
           (0.999, "99.9th percentile"), (1.0, "Maximum")]


def _points(table: str, column: str, points) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{column}' AS Variable, {i} AS Position, '{n}' AS Point,
            quantile_cont({column}, {p}) AS Value FROM {table}"""
        for i, (p, n) in enumerate(points))


ORACLE["review_percentiles"] = rounded(" UNION ALL ".join(
    [_points("typed_frequency", c, _REVIEW)
     for c in ["Exposure", "VehAge", "DrivAge", "BonusMalus", "Density"]]
    + [_points("typed_severity", "ClaimAmount", _REVIEW)]), "Value")
ORACLE["amount_percentiles"] = rounded(_points("valid_claim", "ClaimAmount", _AMOUNT), "Value")
ORACLE["claim_count_values"] = rounded(
    """SELECT ClaimNb, count(*) AS PolicyCount,
       100e0 * count(*) / (SELECT count(*) FROM typed_frequency) AS Percentage
       FROM typed_frequency GROUP BY ClaimNb""", "ClaimNb", "Percentage")
ORACLE["category_values"] = rounded(" UNION ALL ".join(
    f"""SELECT '{c}' AS ColumnName, {c} AS Value, count(*) AS Count,
        100e0 * count(*) / (SELECT count(*) FROM typed_frequency) AS Percentage
        FROM typed_frequency GROUP BY {c}"""
    for c in ["Area", "VehBrand", "VehGas", "Region"]), "Percentage")


def _rows(table: str, condition: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {condition})"


ORACLE["validity_checks"] = _measures([
    ("Missing frequency policy IDs", _rows("typed_frequency", "IDpol IS NULL")),
    ("Missing severity policy IDs", _rows("typed_severity", "IDpol IS NULL")),
    ("Non-positive frequency policy IDs", _rows("typed_frequency", "IDpol <= 0")),
    ("Non-positive severity policy IDs", _rows("typed_severity", "IDpol <= 0")),
    ("Negative claim counts", _rows("typed_frequency", "ClaimNb < 0")),
    ("Non-integer claim counts",
     _rows("typed_frequency", "ClaimNb IS NULL OR ClaimNb <> floor(ClaimNb)")),
    ("Non-positive exposure", _rows("typed_frequency", "Exposure <= 0")),
    ("Negative vehicle ages", _rows("typed_frequency", "VehAge < 0")),
    ("Negative driver ages", _rows("typed_frequency", "DrivAge < 0")),
    ("Negative bonus-malus values", _rows("typed_frequency", "BonusMalus < 0")),
    ("Non-positive density", _rows("typed_frequency", "Density <= 0")),
    ("Non-positive claim amounts", _rows("typed_severity", "ClaimAmount <= 0")),
], '"Check"', "IssueCount", "BIGINT")
CTES["consistency"] = """
SELECT COALESCE(f.IDpol, s.IDpol) AS IDpol,
       COALESCE(CAST(trunc(f.ClaimNb) AS BIGINT), 0) AS ClaimNb,
       COALESCE(s.n, 0) AS SeverityRowCount,
       CASE WHEN f.here IS NULL THEN 'right_only' WHEN s.n IS NULL THEN 'left_only'
            ELSE 'both' END AS _merge
FROM (SELECT IDpol, ClaimNb, 1 AS here FROM typed_frequency) f
FULL JOIN (SELECT IDpol, count(*) AS n FROM typed_severity GROUP BY IDpol) s
  ON s.IDpol = f.IDpol"""
ORACLE["raw_mismatches"] = sql(
    """SELECT IDpol, ClaimNb, SeverityRowCount, _merge,
       ClaimNb - SeverityRowCount AS CountDifference FROM consistency
       WHERE ClaimNb <> SeverityRowCount""")
_REPORTED = "(SELECT trunc(sum(ClaimNb)) FROM typed_frequency)"
_MISMATCHED = _rows("consistency", "ClaimNb <> SeverityRowCount")
ORACLE["consistency_summary"] = _measures([
    ("Claims reported in frequency table", _REPORTED),
    ("Claim rows in severity table", "(SELECT count(*) FROM typed_severity)"),
    ("Policies with count mismatches", _MISMATCHED),
    ("Claim policies without severity records",
     _rows("consistency", "ClaimNb > 0 AND SeverityRowCount = 0")),
    ("Severity policies without frequency records",
     _rows("consistency", "_merge = 'right_only'")),
    ("Policies with more severity rows than ClaimNb",
     _rows("consistency", "SeverityRowCount > ClaimNb")),
    ("Policies with fewer severity rows than ClaimNb",
     _rows("consistency", "SeverityRowCount < ClaimNb")),
], "Measure", "Count", "BIGINT")


def _repeated(table: str, columns: str = "*") -> str:
    return (f"(SELECT count(*) FROM {table}) - "
            f"(SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table}))")


def _ids(table: str) -> str:
    return f"(SELECT count(DISTINCT IDpol) FROM {table})"


ORACLE["duplicate_report"] = _measures([
    ("Frequency duplicate rows", _repeated("typed_frequency")),
    ("Severity duplicate rows", _repeated("typed_severity")),
    ("Duplicate policy IDs in frequency", _repeated("typed_frequency", "IDpol")),
    ("Unique frequency policy IDs", _ids("typed_frequency")),
    ("Unique severity policy IDs", _ids("typed_severity")),
], "Measure", "Count", "BIGINT")
ORACLE["quality_summary"] = rounded(" UNION ALL ".join(
    f"SELECT '{n}' AS Measure, CAST({e} AS DOUBLE) AS Value" for n, e in [
        ("Frequency rows", "(SELECT count(*) FROM typed_frequency)"),
        ("Frequency columns", "12"),
        ("Severity rows", "(SELECT count(*) FROM typed_severity)"),
        ("Severity columns", "2"),
        ("Unique frequency policy IDs", _ids("typed_frequency")),
        ("Unique severity policy IDs", _ids("typed_severity")),
        ("Frequency duplicate rows", _repeated("typed_frequency")),
        ("Severity duplicate rows", _repeated("typed_severity")),
        ("Duplicate policy IDs in frequency", _repeated("typed_frequency", "IDpol")),
        ("Missing values in frequency", _missing("typed_frequency", _COLUMNS)),
        ("Missing values in severity", _missing("typed_severity", ["IDpol", "ClaimAmount"])),
        ("Policies with claims", _rows("typed_frequency", "ClaimNb > 0")),
        ("Policies without claims", _rows("typed_frequency", "ClaimNb = 0")),
        ("Observed policy claim rate",
         _rows("typed_frequency", "ClaimNb > 0") + " / (SELECT count(*) FROM typed_frequency)"),
        ("Claims reported in frequency table", _REPORTED),
        ("Claim rows in severity table", "(SELECT count(*) FROM typed_severity)"),
        ("Policies with claim-count mismatches", _MISMATCHED),
        ("Severity policy IDs missing from frequency",
         "(SELECT count(DISTINCT s.IDpol) FROM typed_severity s WHERE s.IDpol NOT IN"
         " (SELECT IDpol FROM typed_frequency))"),
    ]), "Value")

# --- exploration ----------------------------------------------------------------------

BANDS = {
    "DrivAgeBand": cut_band("DrivAge", DRIVER_EDGES, DRIVER_LABELS),
    "VehAgeBand": cut_band("VehAge", VEHICLE_EDGES, VEHICLE_LABELS),
    "BonusMalusBand": cut_band("BonusMalus", BONUS_EDGES, BONUS_LABELS),
}


def banded(table: str) -> str:
    return "(SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in BANDS.items()) + f" FROM {table})"


ORACLE["policy_bands"] = sql(
    f"SELECT IDpol, DrivAgeBand, VehAgeBand, BonusMalusBand FROM {banded('valid_policy')}")
CTES["risk"] = " UNION ALL ".join(
    segments("SegmentType, Segment",
             f"(SELECT *, '{c}' AS SegmentType, COALESCE({c}, 'nan') AS Segment"
             f" FROM {banded('policy_fact')})")
    for c in ["Area", "VehGas", "Region", "VehBrand", "DrivAgeBand", "VehAgeBand",
              "BonusMalusBand"])
_RISK_DOUBLES = ["Exposure", "CompleteLossExposure", "CompleteClaimCost",
                 "CompletePositiveClaimCost", "ClaimOccurrenceRate", "ClaimFrequency",
                 "ClaimsPer100ExposureYears", "AverageClaimSeverity", "PurePremium",
                 "CompleteLossPercentage"]
ORACLE["group_risk_summary"] = rounded("SELECT * FROM risk", *_RISK_DOUBLES)


def _extreme(kind: str, metric: str) -> list[str]:
    where = (f"SegmentType = '{kind}' AND {metric} IS NOT NULL"
             + (" AND CompleteLossExposure >= 100" if kind == "Region" else ""))
    return [
        f"""SELECT '{kind}' AS SegmentType, '{metric}' AS Metric, '{name}' AS Extreme, Segment,
            {metric} AS Value FROM (SELECT Segment, {metric} FROM risk WHERE {where}
            ORDER BY {metric} {way}, Segment LIMIT 1)"""
        for name, way in [("Highest", "DESC"), ("Lowest", "ASC")]]


CTES["extremes"] = " UNION ALL ".join(
    _extreme("Area", "ClaimsPer100ExposureYears") + _extreme("DrivAgeBand", "PurePremium")
    + _extreme("BonusMalusBand", "ClaimsPer100ExposureYears") + _extreme("Region", "PurePremium"))
ORACLE["segment_extremes"] = rounded("SELECT * FROM extremes", "Value")


def _histogram(values: str, scaled: str, bins: int, edge: str) -> str:
    return rounded(f"""
        WITH v AS ({values}), e AS (SELECT min({scaled}) AS lo, max({scaled}) AS hi FROM v),
        c AS (SELECT least(CAST(floor(({scaled} - lo) * {bins} / (hi - lo)) AS BIGINT),
                           {bins - 1}) AS Bin, count(*) AS n FROM v, e GROUP BY 1)
        SELECT b.Bin, {edge.format(f'lo + b.Bin * ((hi - lo) / {bins})')} AS LowerEdge,
               {edge.format(f'lo + (b.Bin + 1) * ((hi - lo) / {bins})')} AS UpperEdge,
               COALESCE(c.n, 0) AS Count
        FROM (SELECT unnest(range({bins})) AS Bin) b CROSS JOIN e LEFT JOIN c ON c.Bin = b.Bin
        """, "LowerEdge", "UpperEdge")


ORACLE["driver_age_histogram"] = _histogram(
    """SELECT DrivAge AS x FROM valid_policy
       WHERE DrivAge <= (SELECT quantile_cont(DrivAge, 0.995) FROM valid_policy)""",
    "x", 40, "{}")
ORACLE["claim_amount_histogram"] = _histogram(
    "SELECT ClaimAmount AS x FROM valid_claim", "log10(x)", 59, "pow(10e0, {})")

# --- ranks, splits, samples ---------------------------------------------------------------

FIRST = "(BonusMalus - 40 + CASE WHEN COALESCE(DrivAge, 45) < 25 THEN 40 ELSE 0 END) / 400e0"
SECOND = "(BonusMalus - 30 + 6 * VehPower) / 800e0"
FIRST_SEVERITY = "1000 + 10 * COALESCE(DrivAge, 45)"
SECOND_SEVERITY = "50000 + 100 * VehPower"


# Integer arithmetic, so that no rounding moves a row over an edge.
def decile(rows: str, order: str, keep: str) -> str:
    return f"""SELECT {keep}, CAST(greatest(1, CASE WHEN n = 1 THEN 1 ELSE
        (10 * (p - 1) + n - 2) // (n - 1) END) AS INT) AS RiskDecile
        FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS p, count(*) OVER () AS n
              FROM {rows})"""


ORACLE["risk_deciles"] = rounded(decile(
    f"(SELECT IDpol, {FIRST} AS Score FROM policy_fact)", "Score, IDpol", "IDpol, Score"),
    "Score")
ORACLE["constant_score_deciles"] = rounded(decile(
    "(SELECT IDpol, 0.1e0 AS Score FROM policy_fact)", "Score, IDpol", "IDpol, Score"), "Score")

CTES["severity_sample"] = f"""
SELECT * EXCLUDE (RiskDecile), RiskDecile - 1 AS SeverityStratum FROM (
{decile(f"(SELECT *, {COST} / ClaimNb AS AverageClaimSeverity FROM policy_fact WHERE SeverityModelEligible)",
       "AverageClaimSeverity, IDpol", "* EXCLUDE (p, n)")})"""
ORACLE["severity_strata"] = rounded(
    "SELECT IDpol, AverageClaimSeverity, SeverityStratum FROM severity_sample",
    "AverageClaimSeverity")


def _remainder(counts: str, size: str, draws: str, total: str) -> str:
    """Draws shared over strata in proportion, leftovers by largest fraction."""
    return f"""SELECT s, {size} AS size, floor(x) + CASE WHEN row_number() OVER (
          ORDER BY x - floor(x) DESC, CAST(s AS VARCHAR))
          <= {draws} - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS given, {total}, {draws}
        FROM (SELECT *, {size} / CAST({total} AS DOUBLE) * {draws} AS x FROM {counts})"""


def split(rows: str, stratum: str) -> str:
    """A 60/20/20 split: per stratum the first rows by digest are Test, then Validation."""
    return f"""
    SELECT r.* EXCLUDE (place, digest), CASE WHEN place <= d.size - d.dev THEN 'Test'
        WHEN place <= d.size - d.train THEN 'Validation' ELSE 'Training' END AS Sample
    FROM (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY digest, IDpol) AS place
          FROM (SELECT *, md5(concat(CAST(IDpol AS VARCHAR), '-42')) AS digest FROM {rows})) r
    JOIN (
      SELECT t.s, v.size0 AS size, t.size AS dev, t.given AS train FROM (
        {_remainder('''(SELECT s, CAST(given AS BIGINT) AS dev, devs,
            CAST(devs - ceil(0.25e0 * devs) AS BIGINT) AS trains FROM (%s))''' % _remainder(
                f'''(SELECT s, n, total, CAST(total - ceil(0.2e0 * total) AS BIGINT) AS devs
                     FROM (SELECT {stratum} AS s, count(*) AS n,
                           CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM {rows}
                           GROUP BY 1))''', "n", "devs", "total"),
            "dev", "trains", "devs")}) t
      JOIN (SELECT {stratum} AS s, count(*) AS size0 FROM {rows} GROUP BY 1) v ON v.s = t.s
    ) d ON d.s = r.{stratum}"""


CTES["occurrence_sample"] = """SELECT IDpol, Exposure, ClaimNb, Area, VehPower, VehAge, DrivAge,
  BonusMalus, VehBrand, VehGas, Density, Region, HasClaim FROM policy_fact"""
CTES["frequency_sample"] = """SELECT IDpol, Exposure, ClaimNb, Area, VehPower, VehAge, DrivAge,
  BonusMalus, VehBrand, VehGas, Density, Region, ln(1 + Density) AS LogDensity,
  CASE WHEN ClaimNb = 0 THEN '0 claims' WHEN ClaimNb = 1 THEN '1 claim' ELSE '2+ claims' END
    AS ClaimCountStratum FROM policy_fact"""
CTES["occ_split"] = split("occurrence_sample", "HasClaim")
CTES["freq_split"] = split("frequency_sample", "ClaimCountStratum")
CTES["sev_split"] = split("severity_sample", "SeverityStratum")
ORACLE["occurrence_split"] = sql("SELECT IDpol, HasClaim, Sample FROM occ_split")
ORACLE["frequency_split"] = sql("SELECT IDpol, ClaimCountStratum, Sample FROM freq_split")
ORACLE["severity_split"] = sql("SELECT IDpol, SeverityStratum, Sample FROM sev_split")
ORACLE["occurrence_split_summary"] = rounded(
    """SELECT Sample, count(*) AS "Rows", CAST(sum(HasClaim) AS BIGINT) AS Claims,
       CAST(sum(1 - HasClaim) AS BIGINT) AS NoClaims, avg(HasClaim) AS ClaimRate
       FROM occ_split GROUP BY Sample""", "ClaimRate")
ORACLE["frequency_split_summary"] = rounded(
    """SELECT Sample, count(*) AS Policies, sum(Exposure) AS Exposure,
       CAST(sum(ClaimNb) AS BIGINT) AS Claims,
       count(*) FILTER (WHERE ClaimNb = 0) AS ZeroClaimPolicies,
       count(*) FILTER (WHERE ClaimNb = 1) AS OneClaimPolicies,
       count(*) FILTER (WHERE ClaimNb > 1) AS MultipleClaimPolicies,
       sum(ClaimNb) / sum(Exposure) AS ObservedFrequency,
       100 * sum(ClaimNb) / sum(Exposure) AS ClaimsPer100ExposureYears
       FROM freq_split GROUP BY Sample""",
    "Exposure", "ObservedFrequency", "ClaimsPer100ExposureYears")
ORACLE["severity_split_summary"] = rounded(
    f"""SELECT Sample, count(*) AS Policies, CAST(sum(ClaimNb) AS BIGINT) AS Claims,
        sum({COST}) AS TotalClaimAmount, sum({COST}) / sum(ClaimNb) AS WeightedMeanSeverity,
        median(AverageClaimSeverity) AS MedianPolicyAverageSeverity,
        max(AverageClaimSeverity) AS MaximumPolicyAverageSeverity
        FROM sev_split GROUP BY Sample""",
    "TotalClaimAmount", "WeightedMeanSeverity", "MedianPolicyAverageSeverity",
    "MaximumPolicyAverageSeverity")
_SAMPLED = _remainder(
    """(SELECT s, n, total, least(1000, total) AS draws FROM (SELECT HasClaim AS s,
        count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM occurrence_sample
        GROUP BY 1))""", "n", "draws", "total")
ORACLE["stratified_sample"] = sql(
    f"""SELECT r.IDpol, r.HasClaim FROM (SELECT *, row_number() OVER (PARTITION BY HasClaim
        ORDER BY md5(concat(CAST(IDpol AS VARCHAR), '-sample')), IDpol) AS place
        FROM occurrence_sample) r JOIN ({_SAMPLED}) g ON g.s = r.HasClaim
        WHERE place <= g.given""")


def two(rows: str, first: tuple, second: tuple, column: str) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{name}' AS Model, CAST({text} AS DOUBLE) AS {column} FROM {rows}"
        for name, text in (first, second))


LOGISTIC, BOOSTING = "Logistic regression", "Histogram gradient boosting"
POISSON, GAMMA = "Poisson regression", "Gamma regression"
CTES["occ_scores"] = two("occ_split", (LOGISTIC, FIRST), (BOOSTING, SECOND), "Score")
CTES["freq_scores"] = two("freq_split", (POISSON, FIRST), (BOOSTING, SECOND),
                          "PredictedFrequency")
CTES["sev_scores"] = two("sev_split", (GAMMA, FIRST_SEVERITY), (BOOSTING, SECOND_SEVERITY),
                         "PredictedSeverity")
ORACLE["prediction_sample"] = rounded(
    f"""SELECT IDpol, Score FROM occ_scores WHERE Model = '{LOGISTIC}'
        ORDER BY md5(concat(CAST(IDpol AS VARCHAR), '-preview-42')), IDpol LIMIT 500""", "Score")

# --- audit of the occurrence score ---------------------------------------------------------


def confusion(rows: str, threshold: str, keys: str) -> str:
    return f"""
    SELECT {keys}, {threshold} AS Threshold, tn AS TrueNegatives, fp AS FalsePositives,
      fn AS FalseNegatives, tp AS TruePositives, BrierScore, MeanPredictedProbability,
      (tp + tn) / every AS Accuracy, prec AS Precision, rec AS Recall,
      {share('tn', 'tn + fp')} AS Specificity, {share('tn', 'tn + fn')} AS NegativePredictiveValue,
      COALESCE({share('2 * prec * rec', 'prec + rec')}, 0) AS F1Score,
      COALESCE({share('5 * prec * rec', '4 * prec + rec')}, 0) AS F2Score,
      (tp + fp) / every AS PredictedPositiveRate, (tp + fn) / every AS ObservedClaimRate
    FROM (SELECT *, tn + fp + fn + tp AS every, COALESCE({share('tp', 'tp + fp')}, 0) AS prec,
                 COALESCE({share('tp', 'tp + fn')}, 0) AS rec
          FROM (SELECT {keys}, count(*) FILTER (WHERE HasClaim = 0 AND Score < {threshold}) AS tn,
                  count(*) FILTER (WHERE HasClaim = 0 AND Score >= {threshold}) AS fp,
                  count(*) FILTER (WHERE HasClaim = 1 AND Score < {threshold}) AS fn,
                  count(*) FILTER (WHERE HasClaim = 1 AND Score >= {threshold}) AS tp,
                  avg((Score - HasClaim) * (Score - HasClaim)) AS BrierScore,
                  avg(Score) AS MeanPredictedProbability
                FROM {rows} GROUP BY {keys}))"""


def steps(rows: str, keys: str) -> str:
    """Per distinct score: what lies at it and at or above it."""
    return f"""
    SELECT {keys}, Score AS Threshold, n, pos,
      CAST(sum(n) OVER up AS BIGINT) AS chosen, CAST(sum(pos) OVER up AS BIGINT) AS hits,
      CAST(sum(n) OVER all_ AS BIGINT) AS n_all, CAST(sum(pos) OVER all_ AS BIGINT) AS pos_all
    FROM (SELECT {keys}, Score, count(*) AS n, CAST(sum(HasClaim) AS BIGINT) AS pos
          FROM {rows} GROUP BY {keys}, Score)
    WINDOW up AS (PARTITION BY {keys} ORDER BY Score DESC), all_ AS (PARTITION BY {keys})"""


def areas(rows: str, keys: str) -> str:
    # Below a step: all minus what lies at or above it.
    return f"""
    SELECT {keys}, sum(pos * ((n_all - pos_all) - (chosen - hits) + 0.5e0 * (n - pos)))
        / NULLIF(CAST(max(pos_all) AS DOUBLE) * max(n_all - pos_all), 0) AS ROCAUC,
      sum(pos * hits / CAST(chosen AS DOUBLE)) / NULLIF(max(pos_all), 0) AS PRAUC
    FROM ({steps(rows, keys)}) GROUP BY {keys}"""


TEST = "(SELECT * FROM occ_scores WHERE Sample = 'Test')"
VALIDATION = "(SELECT * FROM occ_scores WHERE Sample = 'Validation')"
_CONFUSION_DOUBLES = ["Threshold", "BrierScore", "MeanPredictedProbability", "Accuracy",
                      "Precision", "Recall", "Specificity", "NegativePredictiveValue", "F1Score",
                      "F2Score", "PredictedPositiveRate", "ObservedClaimRate"]
ORACLE["occurrence_metrics"] = rounded(
    f"""SELECT c.*, a.ROCAUC, a.PRAUC FROM ({confusion(TEST, '0.2e0', 'Model')}) c
        JOIN ({areas(TEST, 'Model')}) a ON a.Model = c.Model""",
    *_CONFUSION_DOUBLES, "ROCAUC", "PRAUC")
ORACLE["confusion_cells"] = sql(" UNION ALL ".join(
    f"SELECT Model, '{c}' AS Cell, {c} AS Policies FROM ({confusion(TEST, '0.2e0', 'Model')})"
    for c in ["TrueNegatives", "FalsePositives", "FalseNegatives", "TruePositives"]))


def curve(rows: str) -> str:
    return f"""SELECT Model, Threshold, prec AS Precision, rec AS Recall,
        COALESCE({share('5 * prec * rec', '4 * prec + rec')}, 0) AS F2Score
        FROM (SELECT Model, Threshold, COALESCE({share('hits', 'chosen')}, 0) AS prec,
              COALESCE({share('hits', 'pos_all')}, 0) AS rec FROM ({steps(rows, 'Model')}))"""


ORACLE["precision_recall_curve"] = rounded(
    curve(VALIDATION), "Threshold", "Precision", "Recall", "F2Score")
ORACLE["roc_points"] = rounded(
    f"""SELECT Model, Threshold, {share('chosen - hits', 'n_all - pos_all')}
        AS FalsePositiveRate, {share('hits', 'pos_all')} AS TruePositiveRate
        FROM ({steps(VALIDATION, 'Model')})""",
    "Threshold", "FalsePositiveRate", "TruePositiveRate")
ORACLE["ranking_areas"] = rounded(areas("occ_scores", "Model"), "ROCAUC", "PRAUC")
ORACLE["f2_threshold"] = rounded(
    f"""SELECT Model, Threshold, F2Score FROM (SELECT *, row_number() OVER (
        PARTITION BY Model ORDER BY F2Score DESC, Threshold) AS p FROM ({curve(VALIDATION)}))
        WHERE p = 1""",
    "Threshold", "F2Score")
_GRID = """(SELECT DISTINCT t FROM (SELECT CASE i WHEN 48 THEN 0.25e0
    ELSE 0.01e0 + i * 0.005e0 END AS t FROM (SELECT unnest(range(49)) AS i)
    UNION ALL SELECT 0.1234e0 UNION ALL SELECT 0.5e0))"""
_GRID_REPORT = f"""
    SELECT t AS Threshold, prec AS Precision, rec AS Recall,
      COALESCE({share('2 * prec * rec', 'prec + rec')}, 0) AS F1Score,
      COALESCE({share('5 * prec * rec', '4 * prec + rec')}, 0) AS F2Score,
      chosen / n AS PredictedPositiveRate
    FROM (SELECT t, n, chosen, COALESCE({share('hits', 'chosen')}, 0) AS prec,
                 COALESCE({share('hits', 'pos')}, 0) AS rec
          FROM (SELECT t, count(*) AS n, count(*) FILTER (WHERE Score >= t) AS chosen,
                  count(*) FILTER (WHERE Score >= t AND HasClaim = 1) AS hits,
                  sum(HasClaim) AS pos
                FROM {TEST} s CROSS JOIN {_GRID} g WHERE s.Model = '{LOGISTIC}' GROUP BY t))"""
_GRID_DOUBLES = ["Threshold", "Precision", "Recall", "F1Score", "F2Score",
                 "PredictedPositiveRate"]
ORACLE["threshold_grid"] = rounded(_GRID_REPORT, *_GRID_DOUBLES)
ORACLE["thresholds_in_range"] = rounded(
    f"SELECT * FROM ({_GRID_REPORT}) WHERE Threshold BETWEEN 0.01 AND 0.20", *_GRID_DOUBLES)
_BIN = " + ".join(f"CAST(Score > e[{i}] AS INT)" for i in range(1, 10))
_EDGES = "(SELECT Model, quantile_cont(Score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])" \
         " AS e FROM occ_scores GROUP BY Model)"
ORACLE["quantile_calibration"] = rounded(
    f"""SELECT Model, {_BIN} AS Bin,
        count(*) AS Policies, avg(Score) AS MeanPredictedProbability,
        avg(HasClaim) AS ObservedClaimRate
        FROM occ_scores JOIN {_EDGES} USING (Model) GROUP BY 1, 2""",
    "MeanPredictedProbability", "ObservedClaimRate")


def capacity(rows: str) -> str:
    return f"""
    SELECT Model, Capacity, k AS SelectedPolicies, hits AS SelectedClaims,
      {share('hits', 'k')} AS PrecisionAtCapacity, {share('hits', 'claims')} AS ClaimCaptureRate,
      {share('hits', 'k')} / NULLIF({share('claims', 'n')}, 0) AS Lift,
      cut AS ThresholdAtCapacity
    FROM (SELECT Model, Capacity, k, n, CAST(sum(HasClaim) AS BIGINT) AS claims,
            CAST(sum(CASE WHEN p <= k THEN HasClaim ELSE 0 END) AS BIGINT) AS hits,
            min(Score) FILTER (WHERE p <= k) AS cut
          FROM (SELECT *, CAST(greatest(1, ceil(n * Capacity)) AS BIGINT) AS k
                FROM (SELECT *, row_number() OVER (PARTITION BY Model ORDER BY Score DESC, IDpol)
                        AS p, count(*) OVER (PARTITION BY Model) AS n FROM {rows})
                CROSS JOIN (SELECT unnest([0.05e0, 0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0])
                            AS Capacity))
          GROUP BY Model, Capacity, k, n)"""


_CAPACITY_DOUBLES = ["Capacity", "PrecisionAtCapacity", "ClaimCaptureRate", "Lift",
                     "ThresholdAtCapacity"]
ORACLE["capacity_analysis"] = rounded(capacity(TEST), *_CAPACITY_DOUBLES)
_LOGISTIC_ROWS = f"(SELECT * FROM occ_scores WHERE Model = '{LOGISTIC}')"
ORACLE["capture_curve"] = rounded(
    f"""SELECT Model, Capacity * 100 AS ReviewedPercent, ClaimCaptureRate * 100
        AS CapturedPercent, Capacity * 100 AS RandomPercent
        FROM ({capacity("occ_scores")})""",
    "ReviewedPercent", "CapturedPercent", "RandomPercent")


def subgroups(rows: str) -> str:
    parts = "(" + " UNION ALL ".join(
        f"SELECT Model, HasClaim, Score, '{c}' AS GroupType,"
        f" COALESCE({c}, 'Missing') AS GroupValue FROM {banded(rows)}"
        for c in ["Area", "VehGas", "DrivAgeBand"]) + ")"
    keys = "Model, GroupType, GroupValue"
    return f"""
    SELECT c.Model, c.GroupType, c.GroupValue, TrueNegatives + FalsePositives + FalseNegatives
        + TruePositives AS Policies, FalseNegatives + TruePositives AS Claims,
      ObservedClaimRate, MeanPredictedProbability,
      MeanPredictedProbability - ObservedClaimRate AS CalibrationDifference,
      PredictedPositiveRate AS SelectionRate, Precision, Recall, Specificity, ROCAUC, PRAUC
    FROM ({confusion(parts, '0.15e0', keys)}) c JOIN ({areas(parts, keys)}) a
      ON a.Model = c.Model AND a.GroupType = c.GroupType AND a.GroupValue = c.GroupValue
    WHERE TrueNegatives + FalsePositives + FalseNegatives + TruePositives >= 200
      AND FalseNegatives + TruePositives >= 30"""


ORACLE["subgroup_metrics"] = rounded(
    subgroups("occ_scores"), "ObservedClaimRate", "MeanPredictedProbability",
    "CalibrationDifference", "SelectionRate", "Precision", "Recall", "Specificity", "ROCAUC",
    "PRAUC")
ORACLE["recall_range"] = rounded(
    f"""SELECT Model, min(Recall) AS MinimumRecall, max(Recall) AS MaximumRecall
        FROM ({subgroups("occ_scores")}) GROUP BY Model""", "MinimumRecall", "MaximumRecall")
ORACLE["occurrence_selection"] = rounded(
    f"SELECT * FROM ({areas(VALIDATION, 'Model')}) ORDER BY PRAUC DESC, ROCAUC DESC, Model LIMIT 1",
    "ROCAUC", "PRAUC")
ORACLE["two_threshold_predictions"] = rounded(
    f"""SELECT IDpol, Exposure, HasClaim, Score AS PredictedClaimProbability,
        CAST(Score >= 0.5e0 AS INT) AS PredictedClaimDefaultThreshold,
        CAST(Score >= 0.15e0 AS INT) AS PredictedClaimSelectedThreshold
        FROM {TEST} WHERE Model = '{LOGISTIC}'""", "Exposure", "PredictedClaimProbability")

# --- audit of the frequency and severity scores -------------------------------------------

_UNIT_POISSON = "2 * (CASE WHEN {0} > 0 THEN {0} * ln({0} / {1}) ELSE 0 END - {0} + {1})"
CTES["freq_rows"] = """SELECT *, ClaimNb / Exposure AS y,
    greatest(PredictedFrequency, 1e-12) AS m,
    greatest(PredictedFrequency, 1e-12) * Exposure AS e FROM freq_scores"""
CTES["freq_null"] = """SELECT Model, Sample, sum(ClaimNb) / sum(Exposure) AS mean
    FROM freq_rows GROUP BY Model, Sample"""
CTES["freq_metrics"] = f"""
SELECT r.Model, r.Sample,
  sum(Exposure * {_UNIT_POISSON.format('y', 'm')}) / sum(Exposure)
    AS ExposureWeightedPoissonDeviance,
  avg({_UNIT_POISSON.format('ClaimNb', 'e')}) AS CountMeanPoissonDeviance,
  1 - sum(Exposure * {_UNIT_POISSON.format('y', 'm')})
    / sum(Exposure * {_UNIT_POISSON.format('y', 'mean')}) AS D2Poisson,
  sum(Exposure * abs(y - m)) / sum(Exposure) AS WeightedFrequencyMAE,
  avg(abs(ClaimNb - e)) AS CountMAE, sqrt(avg((ClaimNb - e) * (ClaimNb - e))) AS CountRMSE,
  CAST(sum(ClaimNb) AS DOUBLE) AS ObservedClaims, sum(e) AS PredictedClaims,
  sum(e) / sum(ClaimNb) AS PredictedToObservedClaimsRatio,
  sum(ClaimNb) / sum(Exposure) AS ObservedFrequency,
  sum(e) / sum(Exposure) AS PredictedFrequency,
  sum(e) / sum(Exposure) - sum(ClaimNb) / sum(Exposure) AS FrequencyDifference,
  avg((ClaimNb - e) * (ClaimNb - e) / greatest(e, 1e-12)) AS PearsonDispersionDiagnostic
FROM freq_rows r JOIN freq_null z ON z.Model = r.Model AND z.Sample = r.Sample
GROUP BY r.Model, r.Sample"""
ORACLE["frequency_metrics"] = rounded(
    "SELECT * FROM freq_metrics", "ExposureWeightedPoissonDeviance",
    "CountMeanPoissonDeviance", "D2Poisson", "WeightedFrequencyMAE", "CountMAE", "CountRMSE",
    "ObservedClaims", "PredictedClaims", "PredictedToObservedClaimsRatio", "ObservedFrequency",
    "PredictedFrequency", "FrequencyDifference", "PearsonDispersionDiagnostic")
ORACLE["frequency_selection"] = sql(
    """SELECT Model FROM freq_metrics WHERE Sample = 'Validation'
       ORDER BY ExposureWeightedPoissonDeviance, D2Poisson DESC, Model LIMIT 1""")
_UNIT_GAMMA = "2 * (ln({1} / {0}) + {0} / {1} - 1)"
CTES["sev_rows"] = """SELECT *, AverageClaimSeverity AS y,
    greatest(PredictedSeverity, 1e-12) AS m FROM sev_scores"""
CTES["sev_null"] = """SELECT Model, Sample, sum(ClaimNb * y) / sum(ClaimNb) AS mean
    FROM sev_rows GROUP BY Model, Sample"""
CTES["sev_metrics"] = f"""
SELECT r.Model, r.Sample,
  sum(ClaimNb * {_UNIT_GAMMA.format('y', 'm')}) / sum(ClaimNb) AS WeightedGammaDeviance,
  1 - sum(ClaimNb * {_UNIT_GAMMA.format('y', 'm')})
    / sum(ClaimNb * {_UNIT_GAMMA.format('y', 'mean')}) AS D2Gamma,
  sum(ClaimNb * abs(y - m)) / sum(ClaimNb) AS WeightedMAE,
  sqrt(sum(ClaimNb * (y - m) * (y - m)) / sum(ClaimNb)) AS WeightedRMSE,
  sum(ClaimNb * (m - y)) / sum(ClaimNb) AS WeightedBias,
  count(*) AS Policies, CAST(sum(ClaimNb) AS BIGINT) AS Claims,
  sum({COST}) AS ObservedClaimAmount, sum(m * ClaimNb) AS PredictedClaimAmount,
  sum(m * ClaimNb) / sum({COST}) AS PredictedToObservedAmountRatio,
  sum(y * ClaimNb) / sum(ClaimNb) AS ObservedMeanSeverity,
  sum(m * ClaimNb) / sum(ClaimNb) AS PredictedMeanSeverity,
  sum(m * ClaimNb) / sum(ClaimNb) - sum(y * ClaimNb) / sum(ClaimNb) AS MeanSeverityDifference
FROM sev_rows r JOIN sev_null z ON z.Model = r.Model AND z.Sample = r.Sample
GROUP BY r.Model, r.Sample"""
ORACLE["severity_metrics"] = rounded(
    "SELECT * FROM sev_metrics", "WeightedGammaDeviance", "D2Gamma", "WeightedMAE",
    "WeightedRMSE", "WeightedBias", "ObservedClaimAmount", "PredictedClaimAmount",
    "PredictedToObservedAmountRatio", "ObservedMeanSeverity", "PredictedMeanSeverity",
    "MeanSeverityDifference")
ORACLE["severity_selection"] = sql(
    """SELECT Model FROM sev_metrics WHERE Sample = 'Validation'
       ORDER BY WeightedGammaDeviance, D2Gamma DESC, Model LIMIT 1""")
CTES["freq_deciles"] = f"""
SELECT '{POISSON}' AS Model, RiskDecile, count(*) AS Policies, sum(Exposure) AS Exposure,
  CAST(sum(ClaimNb) AS BIGINT) AS ObservedClaims, sum(e) AS PredictedClaims,
  min(m) AS MinimumPredictedFrequency, max(m) AS MaximumPredictedFrequency,
  avg(m) AS MeanPredictedFrequency, sum(ClaimNb) / sum(Exposure) AS ObservedFrequency,
  sum(e) / sum(Exposure) AS PredictedFrequency,
  sum(ClaimNb) / NULLIF(sum(e), 0) AS ObservedToExpectedRatio
FROM ({decile(f"(SELECT * FROM freq_rows WHERE Model = '{POISSON}')", "m, IDpol", "*")})
GROUP BY RiskDecile"""
ORACLE["frequency_deciles"] = rounded(
    "SELECT * FROM freq_deciles", "Exposure", "PredictedClaims", "MinimumPredictedFrequency",
    "MaximumPredictedFrequency", "MeanPredictedFrequency", "ObservedFrequency",
    "PredictedFrequency", "ObservedToExpectedRatio")
ORACLE["decile_extremes"] = rounded(
    """SELECT min_by(ObservedFrequency, RiskDecile) AS Lowest,
       max_by(ObservedFrequency, RiskDecile) AS Highest,
       max_by(ObservedFrequency, RiskDecile) / min_by(ObservedFrequency, RiskDecile) AS Ratio,
       max_by(ObservedFrequency, RiskDecile) > min_by(ObservedFrequency, RiskDecile)
         AS Increasing FROM freq_deciles""", "Lowest", "Highest", "Ratio")
_SEVERITY_GROUP = f"""count(*) AS Policies, CAST(sum(ClaimNb) AS BIGINT) AS Claims,
  sum({COST}) AS ObservedClaimAmount, sum(m * ClaimNb) AS PredictedClaimAmount,
  sum({COST}) / sum(ClaimNb) AS ObservedSeverity,
  sum(m * ClaimNb) / sum(ClaimNb) AS PredictedSeverity,
  sum({COST}) / NULLIF(sum(m * ClaimNb), 0) AS ObservedToExpectedRatio"""
_SEVERITY_GROUP_DOUBLES = ["ObservedClaimAmount", "PredictedClaimAmount", "ObservedSeverity",
                           "PredictedSeverity", "ObservedToExpectedRatio"]
ORACLE["severity_deciles"] = rounded(
    f"""SELECT '{GAMMA}' AS Model, RiskDecile, {_SEVERITY_GROUP},
        min(m) AS MinimumPredictedSeverity, max(m) AS MaximumPredictedSeverity
        FROM ({decile(f"(SELECT * FROM sev_rows WHERE Model = '{GAMMA}')", "m, IDpol",
                            "*")}) GROUP BY RiskDecile""",
    *_SEVERITY_GROUP_DOUBLES, "MinimumPredictedSeverity", "MaximumPredictedSeverity")
_FREQUENCY_SEGMENTS = " UNION ALL ".join(
    f"""SELECT '{POISSON}' AS Model, '{c}' AS SegmentType, COALESCE({c}, 'nan') AS Segment,
        count(*) AS Policies, sum(Exposure) AS Exposure,
        CAST(sum(ClaimNb) AS BIGINT) AS ObservedClaims, sum(e) AS PredictedClaims,
        sum(ClaimNb) / sum(Exposure) AS ObservedFrequency,
        sum(e) / sum(Exposure) AS PredictedFrequency,
        sum(ClaimNb) / NULLIF(sum(e), 0) AS ObservedToExpectedRatio,
        sum(Exposure) >= 100 AS EligibleForComparison
        FROM {banded('freq_rows')} WHERE Model = '{POISSON}' GROUP BY {c}"""
    for c in ["Area", "VehGas", "DrivAgeBand", "BonusMalusBand"])
ORACLE["frequency_segments"] = rounded(
    _FREQUENCY_SEGMENTS, "Exposure", "PredictedClaims", "ObservedFrequency",
    "PredictedFrequency", "ObservedToExpectedRatio")
ORACLE["bonus_malus_bars"] = rounded(
    f"""SELECT Model, Segment, ObservedFrequency, PredictedFrequency
        FROM ({_FREQUENCY_SEGMENTS}) WHERE SegmentType = 'BonusMalusBand'
        AND EligibleForComparison""", "ObservedFrequency", "PredictedFrequency")
ORACLE["severity_segments"] = rounded(" UNION ALL ".join(
    f"""SELECT '{GAMMA}' AS Model, '{c}' AS SegmentType, COALESCE({c}, 'nan') AS Segment,
        {_SEVERITY_GROUP}, count(*) >= 100 AND sum(ClaimNb) >= 100 AS EligibleForComparison
        FROM {banded('sev_rows')} WHERE Model = '{GAMMA}' GROUP BY {c}"""
    for c in ["Area", "VehGas", "VehBrand", "DrivAgeBand", "VehAgeBand", "BonusMalusBand"]),
    *_SEVERITY_GROUP_DOUBLES)
CTES["loss_order"] = f"""SELECT {COST} AS loss, row_number() OVER (ORDER BY {COST} DESC, IDpol)
    AS p, count(*) OVER () AS n FROM severity_sample"""
ORACLE["tail_summary"] = rounded(" UNION ALL ".join([
    *[f"""SELECT 'Policy average severity: {n}' AS Metric,
          quantile_cont(AverageClaimSeverity, {p}) AS Value FROM severity_sample"""
      for p, n in _AMOUNT],
    *[f"""SELECT 'Top {s}% policy share of claim amount',
          sum(loss) FILTER (WHERE p <= greatest(1, ceil(n * {s / 100!r}e0))) / sum(loss)
          FROM loss_order""" for s in (1, 5, 10)],
]), "Value")
ORACLE["largest_errors"] = rounded(
    f"""SELECT IDpol, ClaimNb, Area, VehPower, VehAge, DrivAge, BonusMalus, VehBrand, VehGas,
        Region, {COST}, AverageClaimSeverity, m AS PredictedSeverity,
        m * ClaimNb AS PredictedClaimAmount, m - y AS SeverityError,
        abs(m - y) AS AbsoluteSeverityError, m * ClaimNb - {COST} AS FinancialError,
        abs(m * ClaimNb - {COST}) AS AbsoluteFinancialError
        FROM sev_rows WHERE Model = '{GAMMA}'
        ORDER BY abs(m * ClaimNb - {COST}) DESC, IDpol LIMIT 25""",
    "VehPower", "VehAge", "DrivAge", "BonusMalus", COST, "AverageClaimSeverity",
    "PredictedSeverity", "PredictedClaimAmount", "SeverityError", "AbsoluteSeverityError",
    "FinancialError", "AbsoluteFinancialError")
ORACLE["severity_histogram"] = _histogram(
    "SELECT AverageClaimSeverity AS x FROM severity_sample", "log10(x)", 59, "pow(10e0, {})")



def _problems(table: str, problems: dict[str, str]) -> str:
    return sql(" UNION ALL ".join(
        f"""SELECT '{n}' AS Problem, count(*) AS "Rows" FROM {table} WHERE {c}"""
        for n, c in problems.items()))


_EXPOSURE = {"exposure_missing_or_not_positive": "Exposure IS NULL OR Exposure <= 0"}
_DENSITY = {"density_negative": "Density < 0"}
_CLAIMS = {"claims_missing_or_negative": "ClaimNb IS NULL OR ClaimNb < 0"}
ORACLE["occurrence_problems"] = _problems("occurrence_sample", {
    "target_not_zero_or_one": "HasClaim IS NULL OR HasClaim NOT IN (0, 1)", **_EXPOSURE,
    **_DENSITY})
ORACLE["frequency_problems"] = _problems(
    "frequency_sample", {**_EXPOSURE, **_CLAIMS, **_DENSITY})
ORACLE["raw_problems"] = _problems("frequency_clean", {**_EXPOSURE, **_CLAIMS, **_DENSITY})
ORACLE["severity_problems"] = _problems("severity_sample", {
    "claims_missing_or_not_positive": "ClaimNb IS NULL OR ClaimNb <= 0",
    "total_missing_or_not_positive": f"{COST} IS NULL OR {COST} <= 0",
    "average_missing_or_not_positive":
        "CompleteAverageClaimAmount IS NULL OR CompleteAverageClaimAmount <= 0",
    **_DENSITY,
    "average_does_not_reconcile":
        "abs(AverageClaimSeverity - CompleteAverageClaimAmount) > 1e-6"
        " + 1e-8 * abs(CompleteAverageClaimAmount)"})

# --- features -------------------------------------------------------------------------------

_RATE_NUMBERS = ["VehPower", "VehAge", "DrivAge", "BonusMalus", "LogDensity"]
_FILLED = ", ".join(f"COALESCE(s.{c}, med.{c}) AS {c}" for c in _RATE_NUMBERS)
CTES["medians"] = "SELECT " + ", ".join(
    f"median({c}) AS {c}" for c in _RATE_NUMBERS) + " FROM freq_split WHERE Sample = 'Training'"
CTES["filled"] = f"""SELECT s.IDpol, s.Sample, s.Area, s.VehBrand, s.VehGas, s.Region, {_FILLED}
    FROM freq_split s, medians med"""
CTES["moments"] = "SELECT " + ", ".join(
    f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in _RATE_NUMBERS) + \
    " FROM filled WHERE Sample = 'Training'"
# The categories of the test tables after the first of each column.
_ONE_HOT = [
    *[("Area", v) for v in "BCDEF"],
    *[("VehBrand", v) for v in sorted(f"B{i}" for i in range(1, 15))[1:]],
    ("VehGas", "Regular"),
    *[("Region", v) for v in sorted(f"NATION_{i}" for i in range(25))[1:]],
]
ORACLE["design_matrix"] = rounded(
    "SELECT IDpol, " + ", ".join(
        f"({c} - a_{c}) / s_{c} AS numeric__{c}" for c in _RATE_NUMBERS) + ", " + ", ".join(
        f"""CASE WHEN {c} = '{v}' THEN 1e0 ELSE 0e0 END AS "categorical__{c}_{v}\""""
        for c, v in _ONE_HOT) + " FROM filled, moments",
    *[f"numeric__{c}" for c in _RATE_NUMBERS],
    *[f'"categorical__{c}_{v}"' for c, v in _ONE_HOT])
CTES["gain_rows"] = """SELECT *, ClaimNb / Exposure AS ClaimFrequency, CAST('0x' || substr(md5(concat(CAST(IDpol AS VARCHAR), '-holdout')), 1, 7)
    AS BIGINT) % 10 <> 0 AS fitting FROM freq_split WHERE Sample = 'Training'"""
CTES["gain_start"] = """SELECT sum(ClaimFrequency * Exposure) / sum(Exposure) AS m
    FROM gain_rows WHERE fitting"""
_GAIN_SUMS = """sum(Exposure * (m - ClaimFrequency)) AS g, sum(Exposure * m) AS h, count(*) AS n
    FROM gain_rows, gain_start WHERE fitting"""
CTES["gain_total"] = f"SELECT {_GAIN_SUMS}"
CTES["gain_numbers"] = " UNION ALL ".join(
    f"SELECT '{c}' AS f, CAST({c} AS DOUBLE) AS v, {_GAIN_SUMS} GROUP BY 2"
    for c in ["VehPower", "VehAge", "DrivAge", "BonusMalus"])
CTES["gain_texts"] = " UNION ALL ".join(
    f"SELECT '{c}' AS f, {c} AS v, {_GAIN_SUMS} GROUP BY 2"
    for c in ["Area", "VehBrand", "VehGas", "Region"])
_SO_FAR = "sum({0}) OVER (PARTITION BY f ORDER BY {1}) AS {0}"
CTES["gain_sides"] = f"""
SELECT f AS Feature, Cut, CAST(NULL AS VARCHAR) AS Category, side AS MissingLeft,
  s.g + CASE WHEN side THEN z.g ELSE 0 END AS g, s.h + CASE WHEN side THEN z.h ELSE 0 END AS h,
  s.n + CASE WHEN side THEN z.n ELSE 0 END AS n
FROM (SELECT f, v + (lead(v) OVER (PARTITION BY f ORDER BY v) - v) / 2 AS Cut,
        {', '.join(_SO_FAR.format(c, 'v') for c in 'ghn')} FROM gain_numbers WHERE v IS NOT NULL) s
LEFT JOIN (SELECT f AS zf, g, h, n FROM gain_numbers WHERE v IS NULL) z ON zf = f
JOIN (SELECT unnest([true, false]) AS side) ON NOT side OR zf IS NOT NULL
UNION ALL
SELECT f, NULL, v, false, {', '.join(_SO_FAR.format(c, 'g0 / (h0 + 1), v') for c in 'ghn')}
FROM (SELECT *, g AS g0, h AS h0 FROM gain_texts)"""
ORACLE["first_split_gains"] = rounded(
    """SELECT Feature, Cut, Category, MissingLeft, CAST(s.n AS BIGINT) AS LeftRows,
       s.g * s.g / (s.h + 1) + (t.g - s.g) * (t.g - s.g) / (t.h - s.h + 1) - t.g * t.g / (t.h + 1) AS Gain
       FROM gain_sides s, gain_total t
       WHERE s.n >= 100 AND t.n - s.n >= 100 AND s.h >= 1e-3 AND t.h - s.h >= 1e-3""", "Cut", "Gain")
ORACLE["model_baselines"] = rounded(
    """SELECT 'Claim rate' AS Baseline, avg(HasClaim) AS Value FROM occ_split
       WHERE Sample = 'Training'
       UNION ALL SELECT 'Claim frequency', sum(ClaimNb) / sum(Exposure) FROM freq_split
       WHERE Sample = 'Training'
       UNION ALL SELECT 'Mean severity', sum(AverageClaimSeverity * ClaimNb) / sum(ClaimNb)
       FROM sev_split WHERE Sample = 'Training'""", "Value")

# --- named reports: the same results as the queries that build them from DataFrames ---------

for _report, _same in {
        "portfolio_kpis": "portfolio_kpis", "table_counts": "table_counts",
        "claim_count_distribution": "claim_count_distribution", "area_metrics": "area_metrics",
        "area_ranking": "area_ranking", "model_eligibility": "model_eligibility",
        "claim_completeness": "claim_completeness", "claim_count_issues": "issue_types",
        "orphan_claims": "orphans_by_policy", "driver_age_metrics": "driver_age_metrics",
        "bonus_malus_metrics": "bonus_malus_metrics",
        "top_regions_by_pure_premium": "top_regions", "largest_losses": "largest_losses"}.items():
    ORACLE[f"sql_{_report}"] = ORACLE[_same]
ORACLE["stored_tables"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({ORACLE[same]})"
    for name, same in {
        "frequency_clean": "clean_frequency", "severity_clean": "clean_severity",
        "severity_by_policy": "severity_by_policy", "claim_count_audit": "claim_count_audit",
        "policy_analytics": "policy_analytics", "data_preparation_summary": "preparation_summary",
        "claim_count_audit_summary": "audit_summary"}.items())

# --- model tables on formula scores ----------------------------------------------------------

CTES["effects"] = " UNION ALL ".join(
    f"""SELECT concat('categorical__{c}_', {c}) AS Feature,
        100 * ln((sum(ClaimNb) / sum(Exposure)) / (SELECT sum(ClaimNb) / sum(Exposure) FROM freq_split
                 WHERE Sample = 'Training')) AS Coefficient
        FROM freq_split WHERE Sample = 'Training' GROUP BY {c}"""
    for c in ["Area", "VehBrand", "Region"])
CTES["effect_rows"] = """SELECT Feature, Coefficient, exp(least(greatest(Coefficient, -20), 20)) AS RateRatio,
    abs(Coefficient) AS AbsoluteCoefficient FROM effects"""
_EFFECTS = ["Coefficient", "RateRatio", "AbsoluteCoefficient"]
ORACLE["coefficient_effects"] = rounded("SELECT * FROM effect_rows", *_EFFECTS)
ORACLE["strongest_effects"] = rounded(
    """(SELECT * FROM effect_rows WHERE Coefficient > 0 ORDER BY Coefficient DESC, Feature LIMIT 15)
       UNION ALL
       (SELECT * FROM effect_rows WHERE Coefficient < 0 ORDER BY Coefficient, Feature LIMIT 15)""", *_EFFECTS)
ORACLE["occurrence_sample"] = rounded(
    """SELECT IDpol, HasClaim, ln(Exposure) AS LogExposure, ln(1 + Density) AS LogDensity
       FROM occurrence_sample""", "LogExposure", "LogDensity")
ORACLE["frequency_sample"] = rounded(
    """SELECT IDpol, ClaimNb / Exposure AS ClaimFrequency, LogDensity, ClaimCountStratum
       FROM frequency_sample""", "ClaimFrequency", "LogDensity")
CTES["gaps"] = """SELECT * REPLACE (CASE WHEN IDpol % 7 = 0 THEN NULL ELSE Area END AS Area,
    CASE WHEN IDpol % 5 = 0 OR VehGas = 'Diesel' AND IDpol % 3 = 0 THEN NULL ELSE VehGas END AS VehGas)
    FROM freq_split"""
ORACLE["missing_labels"] = sql("SELECT IDpol, " + ", ".join(
    f"coalesce({c}, 'Missing') AS {c}" for c in ["Area", "VehBrand", "VehGas", "Region"]) + " FROM gaps")


def _usual(column: str) -> str:
    return f"""(SELECT {column} FROM gaps WHERE Sample = 'Training' AND {column} IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""


ORACLE["design_with_gaps"] = rounded(
    f"""SELECT IDpol, (VehPower - (SELECT avg(VehPower) FROM gaps WHERE Sample = 'Training'))
        / (SELECT stddev_pop(VehPower) FROM gaps WHERE Sample = 'Training') AS numeric__VehPower, """
    + ", ".join(f"CASE WHEN coalesce({c}, {_usual(c)}) = '{v}' THEN 1e0 ELSE 0e0 END AS categorical__{c}_{v}"
                for c, v in [*[("Area", v) for v in "BCDEF"], ("VehGas", "Regular")]) + " FROM gaps",
    "numeric__VehPower", *[f"categorical__Area_{v}" for v in "BCDEF"], "categorical__VehGas_Regular")
ORACLE["clipped_predictions"] = rounded(
    "SELECT IDpol, greatest((BonusMalus - 100) / 50e0, 1e-12) * 1e12 AS Scaled FROM policy_fact", "Scaled")
CTES["occ_wide"] = f"""SELECT a.IDpol, a.Exposure, a.HasClaim, a.Score AS First, b.Score AS Second
    FROM {TEST} a JOIN {TEST} b ON a.IDpol = b.IDpol
    WHERE a.Model = '{LOGISTIC}' AND b.Model = '{BOOSTING}'"""
ORACLE["occurrence_predictions"] = rounded(
    f"""SELECT IDpol, Exposure, HasClaim, First AS LogisticProbability,
        Second AS GradientBoostingProbability, '{BOOSTING}' AS SelectedModel,
        Second AS SelectedModelProbability, CAST(Second >= 0.15e0 AS INT) AS SelectedModelPrediction
        FROM occ_wide""", "Exposure", "LogisticProbability", "GradientBoostingProbability",
    "SelectedModelProbability")
CTES["freq_wide"] = f"""SELECT a.IDpol, a.Exposure, a.ClaimNb, a.PredictedFrequency AS First,
    b.PredictedFrequency AS Second FROM freq_scores a JOIN freq_scores b ON a.IDpol = b.IDpol
    WHERE a.Model = '{POISSON}' AND b.Model = '{BOOSTING}' AND a.Sample = 'Test'"""
ORACLE["frequency_predictions"] = rounded(
    f"""SELECT IDpol, Exposure, ClaimNb, ClaimNb / Exposure AS ObservedFrequency,
        0.25e0 AS BaselinePredictedFrequency, First AS PoissonPredictedFrequency,
        Second AS BoostingPredictedFrequency, '{POISSON}' AS SelectedModel,
        First AS SelectedPredictedFrequency, First * Exposure AS SelectedExpectedClaims FROM freq_wide""",
    "Exposure", "ObservedFrequency", "BaselinePredictedFrequency", "PoissonPredictedFrequency",
    "BoostingPredictedFrequency", "SelectedPredictedFrequency", "SelectedExpectedClaims")
CTES["sev_wide"] = f"""SELECT a.IDpol, a.ClaimNb, a.{COST}, a.AverageClaimSeverity,
    a.PredictedSeverity AS First, b.PredictedSeverity AS Second
    FROM sev_scores a JOIN sev_scores b ON a.IDpol = b.IDpol
    WHERE a.Model = '{GAMMA}' AND b.Model = '{BOOSTING}' AND a.Sample = 'Test'"""
ORACLE["severity_predictions"] = rounded(
    f"""SELECT IDpol, ClaimNb, {COST}, AverageClaimSeverity, 0.25e0 AS BaselinePredictedSeverity,
        First AS GammaPredictedSeverity, Second AS BoostingPredictedSeverity, '{GAMMA}' AS SelectedModel,
        First AS SelectedPredictedSeverity, First * ClaimNb AS SelectedPredictedClaimAmount FROM sev_wide""",
    COST, "AverageClaimSeverity", "BaselinePredictedSeverity", "GammaPredictedSeverity",
    "BoostingPredictedSeverity", "SelectedPredictedSeverity", "SelectedPredictedClaimAmount")
# Takers in the order of one digest, givers in that of another; the n-th takes from the n-th.
CTES["perm_rows"] = """SELECT IDpol, HasClaim, BonusMalus, DrivAge, Area, VehAge,
    row_number() OVER (ORDER BY md5(concat(CAST(IDpol AS VARCHAR), '-42')), IDpol) AS place
    FROM occ_split WHERE Sample = 'Test'"""
CTES["perm_variants"] = """SELECT * FROM (SELECT unnest(['BonusMalus', 'DrivAge', 'Area', 'VehAge']) AS Feature),
    (SELECT unnest([1, 2, 3, 4, 5]) AS Repeat)"""
CTES["perm_givers"] = """SELECT Feature, Repeat, row_number() OVER (PARTITION BY Feature, Repeat
      ORDER BY md5(concat(CAST(IDpol AS VARCHAR), '-', Feature, '-', CAST(Repeat AS VARCHAR), '-42')), IDpol) AS place,
    BonusMalus AS b, DrivAge AS d, Area AS a FROM perm_rows, perm_variants"""
_PERMUTED = """({b} - 40 + CASE WHEN COALESCE({d}, 45) < 25 THEN 40 ELSE 0 END
    + CASE WHEN {a} = 'A' THEN 7 ELSE 0 END) / 400e0"""
CTES["perm_scores"] = f"""SELECT Feature, Repeat, HasClaim, {_PERMUTED.format(
    b="CASE WHEN Feature = 'BonusMalus' THEN b ELSE BonusMalus END",
    d="CASE WHEN Feature = 'DrivAge' THEN d ELSE DrivAge END",
    a="CASE WHEN Feature = 'Area' THEN a ELSE Area END")} AS Score
    FROM perm_rows JOIN perm_givers USING (place)
    UNION ALL SELECT '', 0, HasClaim, {_PERMUTED.format(b='BonusMalus', d='DrivAge', a='Area')} FROM perm_rows"""
ORACLE["formula_importance"] = rounded(
    f"""SELECT Feature, avg(loss) AS ImportanceMean, stddev_pop(loss) AS ImportanceStandardDeviation
        FROM (SELECT *, max(PRAUC) FILTER (WHERE Feature = '') OVER () - PRAUC AS loss
              FROM ({areas('perm_scores', 'Feature, Repeat')}))
        WHERE Feature <> '' GROUP BY Feature""", "ImportanceMean", "ImportanceStandardDeviation")


def _checks(parts: list[tuple[str, str]]) -> str:
    return sql(" UNION ALL ".join(f"""SELECT '{name}' AS Validation, ({test}) AS Passed""" for name, test in parts))


ORACLE["occurrence_published_review"] = _checks([
    ("Three evaluation rows exist", f"SELECT 1 + count(DISTINCT Model) = 3 FROM {TEST}"),
    ("Selected threshold is between zero and one", "SELECT 0.2 > 0 AND 0.2 < 1"),
    ("ROC-AUC is at least 0.50",
     f"SELECT ROCAUC >= 0.5 FROM ({areas(TEST, 'Model')}) WHERE Model = '{LOGISTIC}'"),
    ("PR-AUC exceeds zero", f"SELECT PRAUC > 0 FROM ({areas(TEST, 'Model')}) WHERE Model = '{LOGISTIC}'"),
    ("Test sample contains predictions", f"SELECT count(*) > 0 FROM {TEST}"),
    ("Coefficient table is non-empty", "SELECT count(*) > 0 FROM effects")])
_FREQ_BEST = """(SELECT Model FROM freq_metrics WHERE Sample = 'Validation'
    ORDER BY ExposureWeightedPoissonDeviance, D2Poisson DESC, Model LIMIT 1)"""
_SEV_BEST = """(SELECT Model FROM sev_metrics WHERE Sample = 'Validation'
    ORDER BY WeightedGammaDeviance, D2Gamma DESC, Model LIMIT 1)"""
CTES["freq_best_deciles"] = f"""SELECT RiskDecile, sum(ClaimNb) / sum(Exposure) AS ObservedFrequency
    FROM ({decile(f"(SELECT * FROM freq_rows WHERE Sample = 'Test' AND Model = {_FREQ_BEST})", "m, IDpol", "*")})
    GROUP BY RiskDecile"""
CTES["sev_best_deciles"] = f"""SELECT RiskDecile, sum(m * ClaimNb) / sum(ClaimNb) AS PredictedSeverity
    FROM ({decile(f"(SELECT * FROM sev_rows WHERE Sample = 'Test' AND Model = {_SEV_BEST})", "m, IDpol", "*")})
    GROUP BY RiskDecile"""
ORACLE["frequency_published_review"] = _checks([
    ("Three models were evaluated", "SELECT count(*) = 3 FROM freq_metrics WHERE Sample = 'Test'"),
    ("Selected model came from validation",
     f"SELECT count(*) = 1 FROM freq_metrics WHERE Sample = 'Validation' AND Model = {_FREQ_BEST}"),
    ("All predicted claim totals are positive",
     "SELECT count(*) = 0 FROM freq_metrics WHERE Sample = 'Test' AND NOT coalesce(PredictedClaims > 0, false)"),
    ("All Poisson deviances are finite", """SELECT count(*) = 0 FROM freq_metrics WHERE Sample = 'Test'
     AND NOT coalesce(isfinite(ExposureWeightedPoissonDeviance), false)"""),
    ("Calibration contains ten deciles", "SELECT count(*) = 10 FROM freq_best_deciles"),
    ("Risk decile ten has higher observed frequency than decile one",
     """SELECT max_by(ObservedFrequency, RiskDecile) > min_by(ObservedFrequency, RiskDecile)
        FROM freq_best_deciles"""),
    ("Segment calibration is non-empty", "SELECT count(*) > 0 FROM freq_rows WHERE Sample = 'Test'"),
    ("Poisson coefficient table is non-empty", "SELECT count(*) > 0 FROM effects")])
ORACLE["severity_published_review"] = _checks([
    ("Three models were evaluated", "SELECT count(*) = 3 FROM sev_metrics WHERE Sample = 'Test'"),
    ("Selected model came from validation",
     f"SELECT count(*) = 1 FROM sev_metrics WHERE Sample = 'Validation' AND Model = {_SEV_BEST}"),
    ("All Gamma deviances are finite", """SELECT count(*) = 0 FROM sev_metrics WHERE Sample = 'Test'
     AND NOT coalesce(isfinite(WeightedGammaDeviance), false)"""),
    ("All predicted claim amounts are positive",
     "SELECT count(*) = 0 FROM sev_metrics WHERE Sample = 'Test' AND NOT coalesce(PredictedClaimAmount > 0, false)"),
    ("Calibration contains ten deciles", "SELECT count(*) = 10 FROM sev_best_deciles"),
    ("Predicted severity is positive in every decile",
     "SELECT count(*) = 0 FROM sev_best_deciles WHERE NOT coalesce(PredictedSeverity > 0, false)"),
    ("Segment calibration is non-empty", "SELECT count(*) > 0 FROM sev_rows WHERE Sample = 'Test'"),
    ("Gamma coefficient table is non-empty", "SELECT count(*) > 0 FROM effects"),
    ("Tail summary is non-empty", "SELECT count(*) > 0 FROM sev_rows WHERE Sample = 'Test'"),
    ("Largest-error report contains records", "SELECT count(*) > 0 FROM sev_rows WHERE Sample = 'Test'")])
_REGION_BRAND = "SELECT count(DISTINCT Area) + count(DISTINCT VehBrand) + count(DISTINCT VehGas) + count(DISTINCT Region) - 4"
ORACLE["fit_gradients"] = sql(" UNION ALL ".join(
    f"""SELECT '{name}' AS Model, true AS Flat, CAST(({_REGION_BRAND} FROM {rows} WHERE Sample = 'Training')
        + {numbers} AS BIGINT) AS Features"""
    for name, rows, numbers in [(LOGISTIC, "occ_split", 6), (POISSON, "freq_split", 5), (GAMMA, "sev_split", 5)]))
ORACLE["raw_files"] = sql(" UNION ALL ".join(
    f"SELECT '{n}' AS TableName, count(*) AS RowCount, count(DISTINCT IDpol) AS Ids FROM raw_{n}"
    for n in ("frequency", "severity")))
ORACLE["contained_models"] = rounded(
    f"""SELECT Model, Recall FROM ({confusion(TEST, '0.2e0', 'Model')})
        WHERE lower(Model) LIKE '%gradient%'""", "Recall")
ORACLE["selected_frequency_summary"] = rounded(
    f"""SELECT Model, CAST(ObservedClaims AS DOUBLE) AS ObservedClaims, PredictedClaims,
        ExposureWeightedPoissonDeviance
        FROM freq_metrics WHERE Sample = 'Test' AND Model = {_FREQ_BEST}""",
    "ObservedClaims", "PredictedClaims", "ExposureWeightedPoissonDeviance")
ORACLE["repeated_issue_ids"] = sql(
    """SELECT IDpol, count(*) AS RowCount FROM (SELECT IDpol FROM issues UNION ALL
       SELECT IDpol FROM issues WHERE IDpol % 5 = 0) GROUP BY IDpol HAVING count(*) > 1""")
ORACLE["mismatch_tables"] = f"""SELECT count(*) AS Mismatches, true AS NoEmptyTable
    FROM ({ORACLE['raw_mismatches']})"""
ORACLE["guard_outcomes"] = """SELECT * FROM (VALUES ('columns', false, true), ('rows', false, true),
    ('unique', false, true), ('one per key', false, true), ('fit for a model', false, true))
    AS t(Guard, StopsGood, StopsBad)"""
ORACLE["saved_model_scores"] = sql(
    "SELECT count(*) AS Policies, count(*) AS Equal FROM occ_split WHERE Sample = 'Test'")
