"""Reconciliation, relational layer and contracts on hand-made rows."""

import pytest

from claimwright import vocabulary as V
from claimwright.operators import clean, contracts, portfolio, quality, ranking, reconcile
from claimwright.plans import preparation, warehouse
from claimwright.sources import store


def raw(spark, policies, claims):
    rows = [
        (str(i), str(n), "0.5", area, "5", "1", "40", "50", "B1", "Diesel", "100", "R1")
        for i, n, area in policies]
    return (
        spark.createDataFrame(rows, V.RAW_FREQUENCY_SCHEMA),
        spark.createDataFrame([(str(i), str(a)) for i, a in claims], V.RAW_SEVERITY_SCHEMA))


POLICIES = [(1, 0, "A"), (2, 1, "A"), (3, 1, "A"), (4, 2, "B"), (5, 1, "B"), (6, 2, "C")]
CLAIMS = [(3, 100.0), (4, 10.0), (5, 7.0), (5, 8.0), (6, 50.0), (6, 50.0), (9, 1.0), (9, 1.0)]


@pytest.fixture(scope="module")
def prepared(spark):
    return preparation.prepare(*raw(spark, POLICIES, CLAIMS))


def test_every_status_occurs(prepared):
    audit = {r.IDpol: (r.AuditStatus, r._merge) for r in prepared.audit.collect()}
    assert audit == {
        1: (V.NO_CLAIM, "left_only"), 2: (V.NO_SEVERITY, "left_only"), 3: (V.MATCHED, "both"),
        4: (V.FEWER, "both"), 5: (V.MORE, "both"), 6: (V.MATCHED, "both"),
        9: (V.ORPHAN, "right_only")}


def test_unknown_loss_is_not_zero(prepared):
    rows = {r.IDpol: r for r in prepared.policy.collect()}
    assert rows[1].CompleteTotalClaimAmount == 0.0
    assert rows[2].CompleteTotalClaimAmount is None
    assert rows[2].SeverityTotalClaimAmount == 0.0
    assert rows[2].ObservedAverageClaimAmount is None
    assert rows[4].CompletePurePremium is None
    assert rows[6].CompleteAverageClaimAmount == 50.0
    assert rows[6].CompletePurePremium == 200.0
    assert [i for i, r in sorted(rows.items()) if r.SeverityModelEligible] == [3, 6]


def test_no_claims_at_all(spark):
    found = preparation.prepare(*raw(spark, POLICIES, CLAIMS))
    empty = found.claims.filter("false")
    audit = reconcile.claim_count_audit(found.policies, reconcile.claim_counts(empty))
    assert {r.AuditStatus for r in audit.collect()} == {V.NO_CLAIM, V.NO_SEVERITY}


def test_claims_split_and_numbered(spark, prepared):
    tables = warehouse.relational_tables(prepared.policy, prepared.severity, prepared.audit)
    claims = sorted((r.ClaimID, r.IDpol, r.ClaimAmount) for r in tables["claims"].collect())
    assert [c[0] for c in claims] == [1, 2, 3, 4, 5, 6]
    assert [c[1:] for c in claims] == sorted(c for c in CLAIMS if c[0] != 9)
    assert [r.OrphanClaimID for r in tables["orphan_claims"].orderBy("OrphanClaimID").collect()] == [1, 2]
    tables["database_metadata"] = warehouse.metadata(tables, "test")
    assert contracts.constraint_violations(tables).filter("Violations > 0").count() == 0
    twice = {**tables, "claims": tables["claims"].unionByName(tables["claims"].limit(2))}
    broken = contracts.constraint_violations(twice).filter("Violations > 0").collect()
    assert [tuple(r) for r in broken] == [("claims", "ClaimID is unique", 2)]


@pytest.mark.parametrize("shares", [1, 3, 50])
def test_hot_policies_change_nothing(spark, prepared, shares):
    """With 50 shares every id is hot, with 1 none is."""
    spark.conf.set("spark.sql.shuffle.partitions", str(shares))
    try:
        known = reconcile.known_claims(prepared.claims, prepared.policies.union(prepared.policies))
        matched, orphans = reconcile.matched_claims(known), reconcile.orphan_claims(known)
        assert sorted(tuple(r) for r in matched.collect()) == sorted(c for c in CLAIMS if c[0] != 9)
        assert sorted(tuple(r) for r in orphans.collect()) == [(9, 1.0), (9, 1.0)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_claims_are_read_twice_and_hot_ids_are_spread(spark, tmp_path, monkeypatch):
    # Two thirds of the claims have one unknown id, the others have different ones.
    spark.range(0, 3000, 1, 6).selectExpr(
        "IF(id % 3 = 0, id, -1) AS IDpol", "5.0D AS ClaimAmount").write.parquet(str(tmp_path / "claims"))
    plans = []
    real = reconcile.stage
    monkeypatch.setattr(reconcile, "stage", lambda df, *more: (plans.append(df), real(df, *more))[1])
    claims = spark.read.parquet(str(tmp_path / "claims"))
    known = reconcile.known_claims(claims, spark.range(100).withColumnRenamed("id", "IDpol"))
    texts = [df._jdf.queryExecution().optimizedPlan().toString() for df in [*plans, known]]
    assert sum(t.count("IDpol#") > 0 and t.count("ClaimAmount#") > 0 for t in texts) <= 2
    reads = [df._jdf.queryExecution().sparkPlan().toString().count(str(tmp_path)) for df in [*plans, known]]
    assert reads == [1, 1]
    assert {(r.Known, r["count"]) for r in known.groupBy("Known").count().collect()} == {(True, 34), (False, 2966)}


def test_policy_ids_are_never_broadcast(spark, prepared, tmp_path):
    """However small the plan takes them to be: only the hot ids of known_claims are."""
    store.write_table(prepared.policies, str(tmp_path), "policies")
    policies = store.read_tables(spark, str(tmp_path), ["policies"])["policies"]
    plans = [f(prepared.claims, policies)._jdf.queryExecution().sparkPlan().toString() for f in (
        reconcile.known_claims, reconcile.unknown_claim_ids, contracts.foreign_key_violations)]
    assert [p.count("BroadcastHashJoin") for p in plans] == [1, 0, 0]
    assert [p.count("SortMergeJoin") for p in plans] == [2, 1, 1]
    assert [r.IDpol for r in reconcile.unknown_claim_ids(prepared.claims, policies).collect()] == [9]
    assert [tuple(r) for r in contracts.foreign_key_violations(
        prepared.claims, policies).collect()] == [(9, 2)]


def test_a_repeated_policy_fails_inside_the_plan(spark):
    from pyspark.errors import PySparkException

    frequency, severity = raw(spark, [*POLICIES, POLICIES[0]], CLAIMS)
    found = preparation.prepare(frequency, severity)  # a plan, nothing has run
    for table in (found.policy, found.audit):
        with pytest.raises(PySparkException, match="repeated values of IDpol: 1"):
            table.select("IDpol").collect()


def test_checks_pass_and_fail(spark, prepared):
    contracts.enforce(contracts.output_checks(prepared.policy, prepared.audit))
    twice = prepared.policy.unionByName(prepared.policy)
    with pytest.raises(ValueError, match="unique"):
        contracts.enforce(contracts.output_checks(twice, prepared.audit))
    with pytest.raises(ValueError, match="repeated"):
        contracts.require_unique(twice, "policies")
    with pytest.raises(ValueError, match="lacks"):
        contracts.require_columns(prepared.policy.drop("Area"), V.POLICY_COLUMNS, "policies")
    with pytest.raises(ValueError, match="no rows"):
        contracts.require_rows(prepared.policy.filter("false"), "policies")
    with pytest.raises(ValueError, match="differ"):
        contracts.require_counts({"policies": prepared.policy}, {"policies": 99})
    with pytest.raises(ValueError, match="unfit"):
        contracts.require_none(prepared.policy, {"few_claims": "ClaimNb < 1"}, "sample")


def test_group_without_eligible_policies_has_no_ratio(prepared):
    rows = {r.Area: r for r in portfolio.area_metrics(
        prepared.policy.filter("IDpol IN (2, 6)")).collect()}
    assert rows["A"].pure_premium is None and rows["A"].average_claim_severity is None
    assert rows["C"].pure_premium == 200.0


def test_segments_add_up_to_the_portfolio(prepared):
    whole = portfolio.portfolio_kpis(prepared.policy).first()
    areas = portfolio.area_metrics(prepared.policy).collect()
    assert sum(a.policies for a in areas) == whole.total_policies == 6
    assert sum(a.claims for a in areas) == whole.total_reported_claims == 7


def test_duplicates_are_reported_and_kept(spark):
    _, claims = raw(spark, POLICIES, CLAIMS)
    frequency, _ = raw(spark, [*POLICIES, POLICIES[0]], CLAIMS)
    report = {r.Measure: r.Count for r in quality.duplicate_report(
        quality.typed(frequency), quality.typed(claims)).collect()}
    assert report == {
        "Frequency duplicate rows": 1, "Duplicate policy IDs in frequency": 1,
        "Unique frequency policy IDs": 6, "Severity duplicate rows": 2,
        "Unique severity policy IDs": 5}


def test_run_and_build(spark, tmp_path):
    frequency, severity = raw(spark, POLICIES, CLAIMS)
    folder = str(tmp_path / "prepared")
    preparation.run(frequency, severity, folder)
    assert set(store.read_tables(spark, folder, store.PREPARED)) == set(store.PREPARED)
    tables = warehouse.build(spark, folder, str(tmp_path / "tables"))
    assert {n: t.count() for n, t in tables.items()} == {
        "policies": 6, "claims": 6, "orphan_claims": 2, "claim_count_issues": 4,
        "database_metadata": 6}
    warehouse.register(tables)
    assert warehouse.query(spark, "SELECT * FROM v_model_eligibility").count() == 3
    warehouse.export_reports(tables, str(tmp_path / "reports"))
    kpis = store.read_tables(spark, str(tmp_path / "reports"), ["portfolio_kpis"], "csv")
    assert kpis["portfolio_kpis"].first()["total_policies"] == 6


def test_stored_tables_are_written_once_and_read(spark, tmp_path, prepared):
    folder = str(tmp_path / "stored")
    found = preparation.stored(*raw(spark, POLICIES, CLAIMS), folder)
    # What follows a written step reads its files, not the raw rows again.
    for df in (found.summary(), found.audit_summary(), found.policies):
        assert df.inputFiles() and all(f"{folder}/" in f for f in df.inputFiles())
    tables = store.read_tables(spark, folder, store.PREPARED)
    for name, df in prepared.tables().items():
        assert tables[name].schema.simpleString() == df.schema.simpleString()
        assert sorted(map(str, tables[name].collect())) == sorted(map(str, df.collect())), name


def test_a_failed_build_writes_nothing(spark, tmp_path, monkeypatch):
    folder, target = str(tmp_path / "prepared"), tmp_path / "tables"
    preparation.run(*raw(spark, POLICIES, CLAIMS), folder)
    real = warehouse.relational_tables
    # Every claim twice: more claims than there are valid ones.
    monkeypatch.setattr(warehouse, "relational_tables", lambda *tables: {
        n: t.union(t) if n == "claims" else t for n, t in real(*tables).items()})
    with pytest.raises(ValueError):
        warehouse.build(spark, folder, str(target))
    assert not target.exists()


def test_a_failed_gate_writes_nothing(spark, tmp_path):
    frequency, severity = raw(spark, [*POLICIES, POLICIES[0]], CLAIMS)
    with pytest.raises(ValueError, match="repeated values of IDpol"):
        preparation.run(frequency, severity, str(tmp_path / "prepared"))
    assert not (tmp_path / "prepared").exists()


def test_csv_tables_keep_their_types(spark, tmp_path):
    rows = [(1, "007", 1.0, True, None), (2, " a,b ", 2.5, False, "q"), (3, 'say "x"', None, None, "z")]
    df = spark.createDataFrame(rows, "k bigint, code string, x double, b boolean, t string")
    store.write_table(df, str(tmp_path), "typed", "csv")
    again = store.read_tables(spark, str(tmp_path), ["typed"], "csv")["typed"]
    assert again.dtypes == df.dtypes
    assert sorted(map(tuple, again.collect())) == sorted(rows)
    empty = df.filter("false")
    store.write_table(empty, str(tmp_path), "typed", "csv")
    assert store.read_tables(spark, str(tmp_path), ["typed"], "csv")["typed"].dtypes == df.dtypes
    df.select("k", "x").write.option("header", True).csv(str(tmp_path / "foreign"))
    assert store.read_tables(spark, str(tmp_path), ["foreign"], "csv")["foreign"].dtypes[0][1] == "int"


def test_named_reports_are_checked(spark, prepared):
    from claimwright.plans import sql_reports

    tables = warehouse.relational_tables(prepared.policy, prepared.severity, prepared.audit)
    warehouse.register(tables)
    assert sql_reports.report(spark, "top_regions_by_pure_premium").count() == 0
    assert sql_reports.report(spark, "top_regions_by_pure_premium", least_exposure=0).count() == 1
    assert [r.Area for r in sql_reports.report(spark, "area_metrics").collect()] == ["A", "B", "C"]
    for name in sql_reports.REPORTS:
        assert sql_reports.report(spark, name).columns
    with pytest.raises(KeyError, match="no parameters"):
        sql_reports.report(spark, "area_metrics", least_exposure=1)
    with pytest.raises(KeyError, match="No report"):
        sql_reports.report(spark, "unknown")
    tables["policies"].withColumn("Area", tables["policies"].IDpol).createOrReplaceTempView("policies")
    for name, text in warehouse.VIEWS.items():
        spark.sql(text).createOrReplaceTempView(name)
    with pytest.raises(ValueError, match="catalogue"):
        sql_reports.report(spark, "area_metrics")


def test_missing_tables_are_all_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="claims.*policies"):
        store.read_tables(spark, str(tmp_path), ["claims", "policies"])


def test_mismatches_are_written_only_if_any(spark, tmp_path, prepared):
    issues = reconcile.claim_count_issues(prepared.audit)
    assert store.write_if_any(issues.filter("false"), str(tmp_path), "none") is None
    assert store.write_if_any(issues, str(tmp_path), "some")
    assert spark.read.parquet(str(tmp_path / "some")).count() == 4


def test_csv_round_trip(spark, tmp_path):
    from claimwright.sources.raw import read_frequency, read_severity

    frequency, severity = raw(spark, POLICIES, CLAIMS)
    frequency.write.option("header", True).csv(str(tmp_path / "f"))
    severity.write.option("header", True).csv(str(tmp_path / "s"))
    again = preparation.prepare(
        read_frequency(spark, str(tmp_path / "f")), read_severity(spark, str(tmp_path / "s")))
    assert clean.valid_frequency(again.frequency).count() == 6
    assert again.audit.filter("NOT ClaimCountMatch").count() == 4


def test_published_status_counts(spark, folder):
    """The status counts of the fixture at the smallest scale."""
    from verification import base

    counts = {r.AuditStatus: r.PolicyCount for r in base.prepared(spark, folder).audit_summary().collect()}
    assert counts == {
        V.NO_CLAIM: 399, V.MATCHED: 1027, V.NO_SEVERITY: 31, V.FEWER: 21, V.MORE: 17, V.ORPHAN: 13}


def test_numbered_many_copies(spark):
    rows = [(1, 5.0)] * 700 + [(i, float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "IDpol long, ClaimAmount double")
    found = sorted((r.n, r.IDpol, r.ClaimAmount) for r in ranking.numbered(
        df, "IDpol", "ClaimAmount", "n").collect())
    assert [f[0] for f in found] == list(range(1, 1001))
    assert [f[1:] for f in found] == sorted(rows)


def test_known_claims_need_ids_only(spark, folder, monkeypatch):
    """Neither the wide policy fact is written for them, nor are raw rows dealt by id first."""
    from verification import base

    monkeypatch.setattr(base, "_kept", {})
    monkeypatch.setattr(base, "_plans", {})
    dealt = []
    monkeypatch.setattr(base, "stage", lambda df, label, by=None, stage=base.stage: (
        dealt.append((label, by)), stage(df, label, by))[1])
    orphans = base.orphans(spark, folder)
    assert ("raw-frequency", None) in dealt and ("raw-severity", None) in dealt
    assert "policy" not in dict(dealt)
    known = base.prepared(spark, folder).policy.select("IDpol")
    wanted = base.prepared(spark, folder).claims.join(known, "IDpol", "left_anti")
    assert sorted(orphans.collect()) == sorted(wanted.select(*orphans.columns).collect())


@pytest.mark.parametrize("few, dealt", [(1_000, False), (10, True)])
def test_only_many_copies_are_dealt_anew(spark, monkeypatch, few, dealt):
    monkeypatch.setattr(ranking, "FEW_COPIES", few)
    rows = [(3, 5.0)] * 40 + [(i, float(i % 7)) for i in range(50)] + [(None, 1.0), (4, None)]
    found = ranking.numbered(
        spark.createDataFrame(rows, "IDpol long, ClaimAmount double"), "IDpol", "ClaimAmount", "n")
    assert ("_block" in found._jdf.queryExecution().optimizedPlan().toString()) == dealt
    got = sorted(((r.n, r.IDpol, r.ClaimAmount) for r in found.collect()), key=lambda r: r[0])
    assert [r[0] for r in got] == list(range(1, len(rows) + 1))
    assert [r[1:] for r in got] == sorted(rows, key=lambda r: [(x is not None, x or 0) for x in r])
