"""Ratios, conditional sums and loss terms shared by all reports."""

from pyspark.sql import Column, functions as F

from claimwright import vocabulary as V


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as a double, NULL where bottom is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def percent(top: Column, bottom: Column) -> Column:
    return ratio(F.lit(100.0) * top, bottom)


def count_if(condition: Column) -> Column:
    """Number of rows where the condition holds; 0, never NULL."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def sum_if(condition: Column, value: Column) -> Column:
    """Sum of value where the condition holds; 0 for an empty group."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0).cast("double"))


def clipped(prediction: Column) -> Column:
    """A prediction kept strictly positive."""
    return F.greatest(prediction, F.lit(V.EPSILON))


def poisson_loss(actual: Column, expected: Column) -> Column:
    """Unit Poisson deviance; the logarithmic term is 0 where actual is 0."""
    log_term = F.when(actual > 0, actual * F.log(actual / expected)).otherwise(F.lit(0.0))
    return 2.0 * (log_term - actual + expected)


def gamma_loss(actual: Column, expected: Column) -> Column:
    """Unit Gamma deviance."""
    return 2.0 * (F.log(expected / actual) + actual / expected - 1.0)


def effect(coefficient: Column) -> Column:
    """Multiplicative effect of a log-scale coefficient."""
    return F.exp(F.least(F.greatest(coefficient, F.lit(-20.0)), F.lit(20.0)))
