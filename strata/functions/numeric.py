"""Numeric expressions.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none of them raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal number text, optionally signed, with optional exponent.
# Anything else (thousands separators, type suffixes such as "3f" or "1d",
# words) is not a number.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Special values a lenient numeric parser accepts.
INFINITY_PATTERN = r"^[+-]?(?i)(inf|infinity)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Types whose values are the same double by a cast as by their text.
PLAIN_NUMBERS = ("tinyint", "smallint", "int", "bigint", "double")


def to_number(c, kind: str | None = None) -> Column:
    """Coerce text (or a number) to double; anything unparseable -> null.

    Surrounding blanks are ignored. NaN never survives: it becomes null so
    that counts and averages treat it as missing. ``kind``: the column's type, if
    known; plain numbers are not written as text and parsed again.
    """
    c = _col(c)
    if kind in PLAIN_NUMBERS:
        number = c.cast("double")
        return F.when(~F.isnan(number), number)
    text = F.trim(c.cast("string"))
    # Neither pattern has a text of NaN.
    return (
        F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
        .when(text.rlike(INFINITY_PATTERN),
              F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    )


#: Decimal places kept by exact sums, and the size from which a value is too
#: large for them (28 digits stand before the point; sums need room).
DECIMAL_PLACES = 10
DECIMAL_LIMIT = 1e17


def exact_sum(c, places: int = DECIMAL_PLACES) -> Column:
    """Sum of a double column that does not depend on the order of its rows.

    Double addition is not associative, so a plain ``sum`` depends on the
    partitioning. Values below ``DECIMAL_LIMIT`` are added as decimals of
    ``places`` places, exactly. Infinite and larger values are added as doubles
    beside them: an infinity makes the sum infinite, as in a plain sum.
    """
    c = _col(c)
    small = F.abs(c) < F.lit(DECIMAL_LIMIT)
    decimals = F.sum(F.when(small, c).cast(f"decimal(38,{places})")).cast("double")
    rest = F.sum(F.when(~small, c))
    return F.coalesce(decimals + rest, decimals, rest)


def exact_mean(c, places: int = DECIMAL_PLACES) -> Column:
    """Order-independent mean: :func:`exact_sum` over the count, both over the
    same rows."""
    c = _col(c)
    return exact_sum(c, places) / F.count(c)


def flag_rate(flag) -> Column:
    """Share of rows whose 0/1 flag equals 1; missing flags count as 0."""
    hit = F.when(_col(flag) == 1, F.lit(1)).otherwise(F.lit(0))
    return F.sum(hit).cast("double") / F.count(F.lit(1))


def relative_change(current, previous) -> Column:
    """(current - previous) / previous; null when previous is null or 0."""
    current, previous = _col(current), _col(previous)
    return (
        F.when(previous.isNull() | (previous == 0), F.lit(None).cast("double"))
        .otherwise((current - previous) / previous)
    )


def share_percent(part, total) -> Column:
    """100 * part / total in double precision."""
    return _col(part).cast("double") * F.lit(100.0) / _col(total).cast("double")


def ordered_mean(c) -> Column:
    """Mean of a small, bounded set of doubles summed in ascending order.

    For re-aggregating an already aggregated table (e.g. yearly means per
    topic, one value per year): summing in a fixed order makes the result
    independent of partitioning and identical across engines. Only use it
    where the group size is bounded by a dimension, never on raw rows.
    """
    values = F.array_sort(F.collect_list(_col(c)))
    total = F.aggregate(values, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.when(F.size(values) > 0, total / F.size(values))


def _sorted_list(values: Column) -> Column:
    return F.array_sort(values)


def ordered_sum_of(values: Column) -> Column:
    """Sum of an array of doubles in ascending order (deterministic)."""
    return F.aggregate(_sorted_list(values), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def ordered_mean_of(values: Column) -> Column:
    """Mean of an array of doubles summed in ascending order; null when empty."""
    return F.when(F.size(values) > 0, ordered_sum_of(values) / F.size(values))


def ordered_stddev_of(values: Column) -> Column:
    """Sample standard deviation of an array of doubles, two-pass, summed in
    ascending order; null for fewer than two values."""
    mean = ordered_mean_of(values)
    squares = F.transform(_sorted_list(values), lambda x: (x - mean) * (x - mean))
    total = F.aggregate(squares, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.when(F.size(values) > 1, F.sqrt(total / (F.size(values) - 1)))
