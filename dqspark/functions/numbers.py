"""Numeric expressions: strict parsing, percentages, status and label rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.fixed import (
    KURTOSIS_LABELS,
    OUTLIER_ACTIONS,
    SKEW_LABELS,
    STATUS_BAD,
    STATUS_OK,
    STATUS_WARN,
)
from dqspark.functions.text import strip

#: Plain decimal or exponent notation; "1d", "nan", "inf" and "1_000" are no numbers.
STRICT_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _guarded_double(text: Column) -> Column:
    return F.when(text.rlike(STRICT_NUMBER), text.try_cast("double"))


def to_numeric(c: Column) -> Column:
    """Number written in text as double; anything else is missing."""
    return _guarded_double(strip(c))


def parse_money(c: Column) -> Column:
    """Amounts such as ``4500``, ``5.200`` or ``R$ 6.300,00`` as double.

    With a comma, dots group thousands and the comma is the decimal mark.
    Without one, a dot followed by exactly three last characters groups
    thousands, any other dot is the decimal mark.
    """
    bare = F.replace(strip(F.replace(strip(c), F.lit("R$"), F.lit(""))), F.lit(" "), F.lit(""))
    no_dots = F.replace(bare, F.lit("."), F.lit(""))
    text = (
        F.when(bare.contains(","), F.replace(no_dots, F.lit(","), F.lit(".")))
        .when(bare.rlike(r"\.[^.]{3}$"), no_dots)
        .otherwise(bare)
    )
    return _guarded_double(text)


def half_even_long(c: Column) -> Column:
    """Round to a whole number, ties to even."""
    return F.bround(c, 0).cast("long")


def numeric(df: DataFrame, column: str) -> Column:
    """``column`` as double whatever its type; NaN becomes NULL."""
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        return to_numeric(c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return c.cast("double")


def share(part: Column, whole: Column) -> Column:
    """Percentage with two decimals; 0.0 for an empty whole."""
    return F.coalesce(F.round(F.try_divide(part * F.lit(100.0), whole), 2), F.lit(0.0))


def status(worse: Column, ok: float, warn: float) -> Column:
    """Three-level status of a "higher is worse" percentage."""
    return F.when(worse <= ok, STATUS_OK).when(worse <= warn, STATUS_WARN).otherwise(STATUS_BAD)


def skew_label(c: Column) -> Column:
    return (
        F.when(c > 1, SKEW_LABELS["strong_right"])
        .when(c > 0.5, SKEW_LABELS["mild_right"])
        .when(c < -1, SKEW_LABELS["strong_left"])
        .when(c < -0.5, SKEW_LABELS["mild_left"])
        .otherwise(SKEW_LABELS["symmetric"])
    )


def kurtosis_label(c: Column) -> Column:
    return (
        F.when(c > 1, KURTOSIS_LABELS["heavy"])
        .when(c < -1, KURTOSIS_LABELS["light"])
        .otherwise(KURTOSIS_LABELS["normal"])
    )


def outlier_action(percentage: Column) -> Column:
    return (
        F.when(percentage == 0, OUTLIER_ACTIONS["none"])
        .when(percentage < 1, OUTLIER_ACTIONS["low"])
        .when(percentage < 5, OUTLIER_ACTIONS["moderate"])
        .otherwise(OUTLIER_ACTIONS["high"])
    )
