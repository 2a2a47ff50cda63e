"""The steps of a run, one after the other, from files to reviewed reports."""

from argparse import Namespace

import pytest

from claimwright import run
from claimwright.operators import boosting
from claimwright.plans import frequency, review
from claimwright.sources import fixtures, store


@pytest.fixture(scope="module")
def folders(spark, folder, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    fixtures.raw_frequency(spark, folder).write.option("header", True).csv(f"{root}/raw/frequency")
    fixtures.raw_severity(spark, folder).write.option("header", True).csv(f"{root}/raw/severity")
    return str(root)


def step(spark, name, root, to, **more):
    run.STEPS[name](spark, Namespace(
        frequency=f"{root}/raw/frequency", severity=f"{root}/raw/severity", prepared=f"{root}/prepared",
        tables=f"{root}/tables", logistic=f"{root}/logistic", to=f"{root}/{to}", **more))


def test_every_step_runs(spark, folders):
    step(spark, "prepare", folders, "prepared")
    assert set(store.read_tables(spark, f"{folders}/prepared", store.PREPARED)) == set(store.PREPARED)
    step(spark, "tables", folders, "tables")
    step(spark, "reports", folders, "reports")
    reports = store.read_tables(spark, f"{folders}/reports", [
        "portfolio_kpis", "area_metrics", "model_eligibility", "claim_completeness", "claim_count_issues",
        "top_regions_by_pure_premium"], "csv")
    assert reports["area_metrics"].count() == 6
    assert dict(reports["portfolio_kpis"].dtypes)["total_policies"] == "bigint"
    step(spark, "quality", folders, "quality")
    step(spark, "explore", folders, "explore")
    assert store.read_tables(spark, f"{folders}/explore", ["largest_losses"], "csv")["largest_losses"].count() == 20
    step(spark, "logistic", folders, "logistic")
    step(spark, "review", folders, "logistic", family="occurrence", reports=f"{folders}/logistic")
    checks = store.read_tables(spark, f"{folders}/logistic", ["published_report_checks"], "csv")
    found = {r["Validation"]: r["Passed"] for r in checks["published_report_checks"].collect()}
    # So few rows say nothing of the score; all else must hold.
    assert len(found) == 6 and all(p for v, p in found.items() if v != "ROC-AUC is at least 0.50")
    # Two rounds are enough to see the steps through.
    few = frequency.train(frequency.split(run._policy(spark, f"{folders}/prepared")), rounds=2)
    few.publish(f"{folders}/frequency")
    found = {r["Validation"]: r["Passed"] for r in review.of_folder(
        spark, "frequency", f"{folders}/frequency").collect()}
    assert len(found) == 8 and found["Three models were evaluated"]
    assert found["Selected model came from validation"]
    model = boosting.BoostedTrees.load(spark, f"{folders}/frequency/models/histogram_gradient_boosting")
    assert len(model.trees) == 2


def test_a_review_names_all_missing_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="claim_occurrence_metrics.*logistic_coefficients"):
        review.of_folder(spark, "occurrence", str(tmp_path))
