"""Text-to-value conversions as plain column expressions."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

TRUE_WORDS = ["true", "1"]
FALSE_WORDS = ["false", "0"]


def lenient_double(df: DataFrame, name: str) -> Column:
    """The column as a double; what is not a number becomes NULL.

    Java's parser also takes a type suffix ("1.0f"), which is no number in a data
    file, so d and f are made unreadable first; an infinite value is refused with
    them. NaN counts as missing. The column is referred to once, which keeps the
    plans that build on it small.
    """
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        column = F.translate(column, "dDfF", "####")
    return F.nanvl(column.try_cast("double"), F.lit(None).cast("double"))


def lenient_long(df: DataFrame, name: str) -> Column:
    """The column as a whole number; fractions and non-numbers become NULL.

    A whole text is read as a long directly, so ids beyond 2^53 keep all digits.
    """
    number = lenient_double(df, name)
    rounded = F.when(whole(number), F.floor(number))
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        return rounded
    return F.coalesce(F.col(name).try_cast("bigint"), rounded)


def strict_long(name: str) -> Column:
    """The column as a long; a bad value raises when the plan runs."""
    return F.col(name).cast("bigint")


def truth(df: DataFrame, name: str) -> Column:
    """true/false/1/0 in any case, padded or not, as a boolean; else NULL."""
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.col(name)
    word = F.lower(F.trim(F.col(name).cast("string")))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def strict_truth(df: DataFrame, name: str) -> Column:
    """As truth(), but any other word (or a missing value) raises, naming it."""
    known = truth(df, name)
    word = F.coalesce(F.col(name).cast("string"), F.lit("nan"))
    failure = F.raise_error(F.concat(F.lit(f"Could not convert {name} to a boolean: "), word))
    return F.when(known.isNull(), failure.cast("boolean")).otherwise(known)


def lenient_truth(df: DataFrame, name: str) -> Column:
    """As truth(), with every unknown word counted as false."""
    return F.coalesce(truth(df, name), F.lit(False))


def holds(condition: Column) -> Column:
    """The condition as a two-valued flag: unknown is false."""
    return F.coalesce(condition, F.lit(False))


def missing_or(column: Column, condition: Column) -> Column:
    """True where the column is missing or the condition holds."""
    return column.isNull() | holds(condition)


def whole(column: Column) -> Column:
    """Whether a double is a whole number, up to 1e-8 around zero remainder."""
    return holds(F.abs(F.pmod(column, F.lit(1.0))) <= 1e-8)


def label(column: Column) -> Column:
    """Text form of a grouping value; a missing one prints as 'nan'."""
    return F.coalesce(column.cast("string"), F.lit("nan"))
