"""Text → value coercions with the semantics of the reference's JavaScript loader.

``parseInt`` / ``parseFloat`` read the longest numeric prefix (``'1.0'`` → 1, ``'12abc'`` → 12), so a
plain cast is not enough: the prefix is cut out with a regular expression and then ``try_cast``.
Everything stays a native Column expression.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TIMESTAMP_FORMATS

# Fixed patterns: the numeric prefixes JavaScript's parseInt(s, 10) and parseFloat(s) accept.
INT_PREFIX = r"^\s*([+-]?[0-9]+)"
PLAIN_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"
FLOAT_PREFIX = r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(c) -> Column:
    """``parseInt(s, 10)``; NULL where JavaScript gives NaN."""
    c = _col(c)
    # a sign and digits alone mean the same to a cast, which reads them without a pattern; a cast alone would strip more than \s
    plain = F.when(F.ascii(c).between(ord("+"), ord("9")), c.try_cast("bigint"))
    return F.coalesce(plain, F.regexp_extract(c, INT_PREFIX, 1).try_cast("bigint"))


def parse_float(c) -> Column:
    """``parseFloat(s)``; NULL where JavaScript gives NaN (and for Infinity, a declared deviation)."""
    c = _col(c)
    # what begins with a digit or a point and casts as a whole is its own longest prefix, but for hexadecimal numbers
    digit = F.ascii(c).between(ord("."), ord("9")) & ~c.startswith("0x") & ~c.startswith("0X")
    return F.coalesce(F.when(digit, c.try_cast("double")), F.regexp_extract(c, FLOAT_PREFIX, 1).try_cast("double"))


def int_or_null(c) -> Column:
    """``parseInt(s) || null``: NaN and 0 both become NULL."""
    return F.nullif(parse_int(c), F.lit(0))


def float_or_zero(c) -> Column:
    """``isNaN(parseFloat(s)) ? 0 : parseFloat(s)`` (equivalently ``parseFloat(s) || 0``)."""
    return F.coalesce(parse_float(c), F.lit(0.0))


def string_or_null(c) -> Column:
    """``s || null``."""
    return F.nullif(_col(c), F.lit(""))


def blank_aware_float(c) -> Column:
    """Empty text → NULL, otherwise ``parseFloat``."""
    return F.when(_col(c) == "", F.lit(None).cast("double")).otherwise(parse_float(c))


def parse_timestamp(c, formats: Iterable[str] = TIMESTAMP_FORMATS) -> Column:
    """Strict timestamp parse over a list of accepted formats; invalid text (or day 30 of February) → NULL."""
    attempts = [_strict_timestamp(_col(c), fmt) for fmt in formats]
    return attempts[0] if len(attempts) == 1 else F.coalesce(*attempts)


def _strict_timestamp(c: Column, fmt: str) -> Column:
    """Text in the plain form means the same to a cast, which reads it several times faster than a formatter does."""
    by_format = F.try_to_timestamp(c, F.lit(fmt))
    return F.when(c.rlike(PLAIN_TIMESTAMP), c.try_cast("timestamp")).otherwise(by_format) if fmt == "yyyy-MM-dd HH:mm:ss" else by_format


def js_number_text(c) -> Column:
    """``String(x)`` for a JavaScript number: integral values print without a decimal point, NULL → 'NaN'."""
    x = _col(c)
    integral = (x == F.floor(x)) & (F.abs(x) < F.lit(9.007199254740992e15))
    return (F.when(x.isNull(), F.lit("NaN"))
            .when(integral, F.floor(x).cast("bigint").cast("string"))
            .otherwise(x.cast("string")))
