"""Anomaly queries over the error log: summary, counts by type, paged list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ANOMALY_LIST_DEFAULT_LIMIT, ANOMALY_LIST_MAX_LIMIT
from ..functions.formats import iso_timestamp
from ..functions.rounding import to_fixed
from ..operators.errorlog import VARIANT, created_time, error_rows, json_extract_num, soft_only
from ..operators.joins import cross_scalar
from ..operators.paging import cursor, follows, page_end, read_cursor
from ..operators.sorting import clamp_limit, clamp_offset, paginate
from ..session import written
from .rollups import flags, load_tallies, rollup
from .tables import Tables

def list_order():
    """created_at DESC (newest batch first); rows of one batch share created_at, so the page order is made
    total with row_num DESC, err_type, source."""
    return [F.desc_nulls_first("created_at"), F.desc("row_num"), F.asc("err_type"), F.asc("source")]


def by_type(t: Tables) -> DataFrame:
    return flags(t).where(F.col("err_type").isNotNull()).orderBy(F.desc("count"), F.asc("err_type"))


def summary(t: Tables) -> DataFrame:
    """total_error_records, unique_flagged_rows, flag_rate_percent (flagged rows per 100 trips). Rows of several loads are
    told apart by load and row number."""
    made = load_tallies(t)
    if made is not None:
        return _rated(_totals(made))
    kind = F.col("err_type").isNull()
    totals = flags(t).agg(F.coalesce(F.sum(F.when(~kind, F.col("count"))), F.lit(0)).alias("total_error_records"),
                          F.coalesce(F.sum(F.when(kind, F.col("count"))), F.lit(0)).alias("unique_flagged_rows"))
    return _rated(cross_scalar(totals, rollup(t, {}, ()).select(F.col("n").alias("_trips"))))


def _totals(tallies: DataFrame, *more: Column) -> DataFrame:
    of = lambda what: F.coalesce(F.sum(F.when(F.col("what") == what, F.col("count"))), F.lit(0))
    return tallies.agg(of("flag").alias("total_error_records"), of("rows").alias("unique_flagged_rows"), of("trips").alias("_trips"), *more)


def _rated(totals: DataFrame, *more: str) -> DataFrame:
    rate = F.when(F.col("_trips") > 0,
                  to_fixed(F.col("unique_flagged_rows") / F.col("_trips") * F.lit(100), 2)).otherwise(F.lit(0.0))
    return totals.select("total_error_records", "unique_flagged_rows", rate.alias("flag_rate_percent"), *more)


def summary_with_types(t: Tables) -> DataFrame:
    """The summary plus ``by_type`` as an array (bounded by the number of flag codes)."""
    made = load_tallies(t)
    if made is not None:
        each = F.when(F.col("what") == "flag", F.struct(F.col("count"), F.col("err_type")))
        return _rated(_totals(made, F.sort_array(F.collect_list(each), False).alias("by_type")), "by_type")
    types = by_type(t).agg(F.sort_array(F.collect_list(F.struct(F.col("count"), F.col("err_type"))), False)
                           .alias("by_type"))
    return cross_scalar(summary(t), types)


def _filtered(t: Tables, flag_type: str | None) -> DataFrame:
    """Flags of the list. Of a stored log the numbers come from its Variant column, of which the scan reads these two only. Those of
    a load that isn't stored are finished by ``_shown``, when the page is known."""
    errors = soft_only(t.error_log if t.loaded is None else t.loaded.flag_rows.withColumn("created_at", created_time(t.loaded.created_at)))
    if VARIANT in errors.columns:
        errors = errors.withColumns({k: F.try_variant_get(VARIANT, f"$.{k}", "double") for k in ("fare", "distance")}).drop(VARIANT)
    return errors.where(F.col("err_type") == F.lit(flag_type)) if flag_type else errors


def _shown(t: Tables, rows: DataFrame, *more: str) -> DataFrame:
    if t.loaded is not None:
        # The optimizer moves projections below a limit, and over two of them it sorts all rows (and makes them twice, for the ranges
        # of the sort) instead of taking the first ones. They don't pass a generator.
        rows = rows.select(F.inline(F.array(F.struct(*rows.columns))))
        rows = error_rows(rows, F.col("created_at"), *more)
    numbers = [F.col(k) if k in rows.columns else json_extract_num(F.col("details"), k).alias(k) for k in ("fare", "distance")]
    return rows.select("err_id", "row_num", "err_type", "details", iso_timestamp("created_at").alias("created_at"), *numbers, *more)


def with_written_list(t: Tables, flag_type: str | None = None) -> Tables:
    """The same tables with the flags of the list written once, for callers that read several pages of a log that isn't stored."""
    if t.loaded is None:
        return t
    rows = error_rows(_filtered(t, flag_type), F.col("created_at")).select("err_id", "row_num", "err_type", "details", "created_at", "source")
    return Tables(zones=t.zones, error_log=written(rows, "list"))


def anomaly_list(t: Tables, limit=ANOMALY_LIST_DEFAULT_LIMIT, offset=0, flag_type: str | None = None):
    """(page, meta). Page columns: err_id, row_num, err_type, details, created_at, fare, distance."""
    n = clamp_limit(limit, ANOMALY_LIST_DEFAULT_LIMIT, ANOMALY_LIST_MAX_LIMIT)
    o = clamp_offset(offset)
    page, meta = paginate(_filtered(t, flag_type), list_order(), n, o)
    return _shown(t, page), meta


def anomaly_page(t: Tables, limit=ANOMALY_LIST_DEFAULT_LIMIT, after: str | None = None, flag_type: str | None = None) -> DataFrame:
    """The page that follows the row whose ``cursor`` is given (the first page without one), in the order of the list. Each row
    carries its cursor. A page costs the same wherever it lies: the stored index of the error log tells how far down ``limit``
    rows reach at most, so the scan is bounded on both sides by columns that the files are sorted by."""
    n = clamp_limit(limit, ANOMALY_LIST_DEFAULT_LIMIT, ANOMALY_LIST_MAX_LIMIT)
    start = read_cursor(after) if after else None
    rows = _filtered(t, flag_type)
    if start is not None:
        rows = rows.where(follows(start))
    index = t.partials("flag_pages")
    end = None if index is None else page_end(index, n, start, flag_type)
    if end is not None:
        rows = rows.where((F.col("created_at") > F.lit(end[0])) | ((F.col("created_at") == F.lit(end[0])) & (F.col("row_num") >= F.lit(end[1]))))
    page = rows.orderBy(*list_order()).limit(n)
    return _shown(t, page.withColumn("cursor", cursor()), "cursor")
