"""Column expressions: every helper takes and returns ``pyspark.sql.Column`` (JVM side, codegen'd)."""

from .parsing import (blank_aware_float, float_or_zero, int_or_null, js_number_text, parse_float, parse_int,
                      parse_timestamp, string_or_null)
from .rounding import exact_avg, exact_sum, to_fixed

__all__ = [
    "blank_aware_float", "float_or_zero", "int_or_null", "js_number_text", "parse_float", "parse_int",
    "parse_timestamp", "string_or_null", "exact_avg", "exact_sum", "to_fixed",
]
