"""Display formats of the dashboard, as Column expressions.

Values are first rounded with ``to_fixed`` (half away from zero, like ``Number.prototype.toFixed``) and only
then printed, so the printed digits never depend on the printf rounding mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import to_fixed

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_timestamp(c) -> Column:
    """``Date.prototype.toISOString`` text of a UTC timestamp."""
    return F.date_format(_col(c), ISO_FORMAT)


def fixed_text(c, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", to_fixed(_col(c), digits))


def fmt_num(c) -> Column:
    """Thousands separators for integers (``toLocaleString`` en-US)."""
    return F.format_number(_col(c).cast("bigint"), 0)


def fmt_usd(c) -> Column:
    return F.concat(F.lit("$"), fixed_text(c, 2))


def fmt_pct(c) -> Column:
    return F.concat(fixed_text(c, 1), F.lit("%"))


def fmt_rpm(c) -> Column:
    return F.concat(F.lit("$"), fixed_text(c, 2), F.lit("/min"))


def fmt_k(c) -> Column:
    return F.concat(fixed_text(_col(c) / F.lit(1000), 0), F.lit("k"))


def fmt_date(c) -> Column:
    """'Jan 1' style short date."""
    return F.date_format(_col(c), "MMM d")


def fmt_hr(c) -> Column:
    return F.concat(F.lpad(_col(c).cast("int").cast("string"), 2, "0"), F.lit(":00"))


def label_spaces(c) -> Column:
    return F.replace(_col(c), F.lit("_"), F.lit(" "))


def default_dash(c) -> Column:
    """The text, or a dash where there is none."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit("—"))
