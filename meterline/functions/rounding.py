"""Rounding and exact-average helpers.

``to_fixed`` mirrors ``parseFloat(x.toFixed(k))``: half away from zero on the scaled double. It is written
as plain arithmetic (not ``F.round``) so that Spark and any SQL engine evaluating the same formula produce
the same double bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_fixed(c, digits: int) -> Column:
    x = _col(c)
    scale = float(10 ** digits)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def _units(x: Column) -> tuple[Column, Column]:
    """The value in whole 1e-4 units, and whether it is a whole number of them that 64 bits hold."""
    units = F.floor(x * F.lit(1e4) + F.lit(0.5))
    return units, (F.abs(x) < F.lit(9e11)) & (units / F.lit(1e4) == x)


def _finished(whole: Column, wholes: Column, rest: Column, rests: Column, n: Column, plain: Column) -> Column:
    """The sum as a double from its parts (see ``sum_parts``)."""
    overflown = (whole.isNull() & (wholes > 0)) | (rest.isNull() & (rests > 0))
    total = F.coalesce(whole, F.lit(0)) / F.lit(1e4) + F.coalesce(rest.cast("double"), F.lit(0.0))
    return F.when(n == 0, F.lit(None)).when((n - wholes - rests > 0) | overflown, plain).otherwise(total)


def _sums(c) -> tuple[Column, ...]:
    x = _col(c).cast("double")
    units, whole = _units(x)
    rest = F.when(~whole, x.try_cast("decimal(38,18)"))
    return F.try_sum(F.when(whole, units.try_cast("bigint"))), F.count(F.when(whole, 1)), F.try_sum(rest), F.count(rest), F.count(x), F.sum(x)


def exact_sum(c) -> Column:
    """Order-independent sum as double, without cutting digits or raising.

    Values that are whole numbers of 1e-4 (money, loaded features) are added as 64-bit integers; all others as
    decimal(38,18). Where neither holds a value (beyond 1e20, not finite) or a sum overflows, the plain double sum
    is the result."""
    return _finished(*_sums(c))


# The parts are written as SQL text: a query merges dozens of them, and each would be hundreds of calls from Python.
_WHOLE = "(abs({x}) < 9e11D AND floor({x} * 1e4D + 0.5D) / 1e4D = {x})"
_SUM_PARTS = f"""struct(
  try_sum(CASE WHEN {_WHOLE} THEN try_cast(floor({{x}} * 1e4D + 0.5D) AS bigint) END) AS whole, count(CASE WHEN {_WHOLE} THEN 1 END) AS wholes,
  try_sum(CASE WHEN NOT {_WHOLE} THEN try_cast({{x}} AS decimal(38,18)) END) AS rest, count(CASE WHEN NOT {_WHOLE} THEN try_cast({{x}} AS decimal(38,18)) END) AS rests,
  count({{x}}) AS n, sum({{x}}) AS plain)"""
_MERGED_PARTS = """struct(
  CASE WHEN coalesce(bool_or({c}.whole IS NULL AND {c}.wholes > 0), false) THEN NULL ELSE try_sum({c}.whole) END AS whole, coalesce(sum({c}.wholes), 0L) AS wholes,
  CASE WHEN coalesce(bool_or({c}.rest IS NULL AND {c}.rests > 0), false) THEN NULL ELSE try_sum({c}.rest) END AS rest, coalesce(sum({c}.rests), 0L) AS rests,
  coalesce(sum({c}.n), 0L) AS n, sum({c}.plain) AS plain)"""
_PARTS_SUM = """CASE WHEN {c}.n = 0 THEN NULL
  WHEN {c}.n > {c}.wholes + {c}.rests OR ({c}.whole IS NULL AND {c}.wholes > 0) OR ({c}.rest IS NULL AND {c}.rests > 0) THEN {c}.plain
  ELSE coalesce({c}.whole, 0L) / 1e4D + coalesce(cast({c}.rest AS double), 0D) END"""


def sum_parts(column: str) -> Column:
    """Aggregate: the parts of ``exact_sum`` over a named column, as a struct that can be stored and merged. Of sums that
    overflowed the value is null while their count isn't 0."""
    return F.expr(_SUM_PARTS.format(x=f"cast({column} AS double)"))


def merged_parts(column: str) -> Column:
    """Aggregate: the parts of all rows together, from rows of parts."""
    return F.expr(_MERGED_PARTS.format(c=column))


def parts_sum(column: str) -> Column:
    """The sum that merged parts stand for: what ``exact_sum`` gives over all their rows."""
    return F.expr(_PARTS_SUM.format(c=column))


def parts_avg(column: str) -> Column:
    return F.expr(f"try_divide({_PARTS_SUM.format(c=column)}, {column}.n)")


def exact_avg(c) -> Column:
    """AVG as exact sum / count: independent of row order and partitioning."""
    return F.try_divide(exact_sum(c), F.count(_col(c)))
