"""Column expressions: numeric coercion, finite tests and small fixed-width vector algebra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# What counts as a number, an infinity or a boolean in a text cell.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_PATTERN = r"^[+-]?(?i)(inf|infinity)$"
INTEGER_PATTERN = r"^[+-]?[0-9]{1,18}$"
BOOLEAN_PATTERN = r"^(True|TRUE|true|False|FALSE|false)$"

NUMERIC_TYPES = (T.NumericType, T.BooleanType)


def is_finite(value: Column) -> Column:
    """False for NULL, NaN and both infinities."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def numeric_value(value: Column, dtype: T.DataType, booleans: bool = False) -> Column:
    """DOUBLE reading of a column; unparseable cells become NULL, infinities are kept."""
    if isinstance(dtype, NUMERIC_TYPES):
        return value.cast("double")
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("double")
    text = F.trim(value)
    parsed = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double")).when(
        text.rlike(INFINITY_PATTERN),
        F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))),
    )
    if booleans:
        parsed = parsed.when(
            text.rlike(BOOLEAN_PATTERN), F.when(F.lower(text) == "true", 1.0).otherwise(0.0)
        )
    return parsed


def finite_value(value: Column, dtype: T.DataType, booleans: bool = False) -> Column:
    """DOUBLE reading with NaN, infinities and unparseable cells all mapped to NULL."""
    number = numeric_value(value, dtype, booleans)
    return F.when(is_finite(number), number)


def total(terms: Sequence[Column]) -> Column:
    """Sum as a balanced tree, so that wide sums stay shallow for the optimizer."""
    items = list(terms)
    if not items:
        return F.lit(0.0)
    while len(items) > 1:
        paired = [items[i] + items[i + 1] for i in range(0, len(items) - 1, 2)]
        items = paired + ([items[-1]] if len(items) % 2 else [])
    return items[0]


# Up to this many multiply-adds an expression stays inside generated code; wider vector
# work goes through Arrow batches.
EXPRESSION_TERMS = 128


def squared_norm(vector: Column, width: int) -> Column:
    """Sum of squares of a fixed-width array column."""
    if width <= EXPRESSION_TERMS:
        return total([vector[i] * vector[i] for i in range(width)])
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x)


def squared_distance(left: Column, right: Column, width: int) -> Column:
    """Squared Euclidean distance of two fixed-width array columns."""
    if width <= EXPRESSION_TERMS // 2:
        return total(
            [(left[i] - right[i]) * (left[i] - right[i]) for i in range(width)]
        )
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x
    )


def squared_distance_to(vector: Column, point: Sequence[float]) -> Column:
    """Squared Euclidean distance of an array column to one literal point."""
    return total(
        [
            (vector[i] - F.lit(float(p))) * (vector[i] - F.lit(float(p)))
            for i, p in enumerate(point)
        ]
    )


def tidy(value: Column, digits: int = 6) -> Column:
    """Rounded value without a negative zero."""
    return F.round(value, digits) + F.lit(0.0)


# How near to a tie a scaled value is rounded by the slow way, and up to which size its last digits can be trusted.
TIE_SLACK = 1e-6
SCALED_LIMIT = 1e9


def tidy_many(value: Column, digits: int = 6) -> Column:
    """``tidy`` for columns of billions of values: decimal arithmetic only for values next to a tie, as any other value has
    the same nearest decimal either way."""
    scaled = value * F.lit(10.0**digits)
    clear = (F.abs(scaled) < SCALED_LIMIT) & (F.abs(scaled - F.rint(scaled)) < 0.5 - TIE_SLACK)
    return F.when(clear, F.rint(scaled) / F.lit(10.0**digits)).otherwise(F.round(value, digits)) + F.lit(0.0)
