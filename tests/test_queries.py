"""Every registered query next to its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from verification import check
from verification.oracle import ORACLE
from verification.queries import QUERIES

# Fitted models have no SQL; their operators are checked in test_models and test_scores.
MODELS = {
    "logistic_metrics", "logistic_coefficients", "logistic_predictions", "logistic_review",
    "occurrence_model_comparison", "occurrence_model_predictions", "permutation_importances",
    "frequency_model_comparison", "frequency_model_predictions", "poisson_coefficients",
    "strongest_coefficients", "frequency_review", "severity_model_comparison",
    "severity_model_predictions", "gamma_coefficients", "severity_review",
}


@pytest.fixture(scope="module")
def connection(folder):
    return check.connect(folder)


def test_registry():
    # Optional subpackages add further queries.
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) & set(QUERIES) == set(QUERIES) - MODELS


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.total_policies == 1495 and row.total_reported_claims == 1963
    assert row.pure_premium == pytest.approx(126895.71, abs=0.01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, connection, folder, name):
    if name == "top_regions":  # no region reaches the floor at this scale
        assert QUERIES[name](spark, folder).count() == 0
        return
    assert check.differences(spark, connection, folder, name) == ""


def test_model_run_is_consistent(spark, folder, tmp_path):
    """The logistic run: published tables can be read back for review."""
    from claimwright.plans import review
    from claimwright.sources import store
    from verification import base, queries

    run = queries._logistic_run(spark, folder)
    run.publish(str(tmp_path), "parquet")
    names = ["claim_occurrence_metrics", "prediction_sample", "logistic_coefficients"]
    tables = store.read_tables(spark, str(tmp_path), names)
    checks = review.occurrence_review(*[tables[n] for n in names]).collect()
    assert len(checks) == 6
    assert run.predictions.count() == base.occurrence_split(spark, folder).filter(
        "Sample = 'Test'").count()


def test_guards_bring_no_rows_to_the_driver(spark, folder, monkeypatch):
    """The guards read whole tables; the driver gets sums and verdicts only."""
    from pyspark.sql.classic.dataframe import DataFrame

    brought, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: brought.append(collect(df)) or brought[-1])
    found = QUERIES["guard_outcomes"](spark, folder).collect()
    assert {(r.StopsGood, r.StopsBad) for r in found} == {(False, True)} and len(found) == 5
    assert max(len(rows) for rows in brought) < 100
