"""Physical-plan checks: broadcast of the zone dimension, no Python evaluation, one exchange for dedup
with the partial WindowGroupLimit before it, pushed-down scan columns."""
from meterline.plans import overview
from meterline.plans.tables import from_testdata
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_zone_join_is_broadcast_and_no_python(spark):
    t = from_testdata(spark, SF_SMALL)
    p = _plan(overview.top_zones(t))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_dedup_single_exchange_with_partial_limit(spark):
    t = from_testdata(spark, SF_SMALL)
    p = t.loaded.kept._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange hashpartitioning(vendor") == 1
    assert p.count("WindowGroupLimit") >= 2   # partial (before the shuffle) and final


def test_scan_reads_only_needed_columns(spark):
    t = from_testdata(spark, SF_SMALL)
    p = _plan(t.trips.select("row_num"))
    assert "l_tax" not in p and "l_returnflag" not in p and "l_shipdate" not in p


def test_no_cartesian_or_python_in_registered_plans(spark):
    from meterline.plans.registry import queries
    offending = {}
    for key, build in queries().items():
        if key.startswith(("stream_", "store_", "scan_", "load_files_", "anomalies_page_")) or key in ("stable_sort", "sort_by_any_column"):   # these run a job while being built
            continue
        plan = _plan(build(spark, SF_SMALL))
        hits = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
                if w in plan]
        if hits:
            offending[key] = hits
    assert offending == {}


def test_both_halves_of_partition_trips_parse_each_text_once(spark):
    from meterline.operators.anomalies import partition_trips
    from meterline.operators.features import compute_features

    columns = ("row_num", "pickup_datetime", "dropoff_datetime", "trip_distance", "total_amount", "tip_amount", "fare_amount")
    rows = [(1, "2019-01-01 10:00:00", "2019-01-01 10:10:00", "1.5", "12", "1", "10"), (2, "2019-01-01 10:00:00", "2019-01-01 10:00:00", "0", "12", "1", "10"),
            (3, None, "x", None, "", None, "abc"), (3, None, "x", None, "", None, "abc"), (None, "2019-01-01 10:00:00", "2019-01-01 10:01:00", "9", "12", "20", "10")]
    featured = compute_features(spark.createDataFrame(rows, "row_num long, " + ", ".join(f"{c} string" for c in columns[1:])))
    clean, bad = partition_trips(featured)
    assert [r["row_num"] for r in clean.collect()] == [1]
    assert sorted(((r["row_num"] or 0), r["types"]) for r in bad.collect()) == [
        (0, ["excessive_speed", "excessive_tip_percentage"]), (2, ["zero_distance_positive_fare", "invalid_duration"]), (3, ["invalid_duration"]), (3, ["invalid_duration"])]
    for half in (clean, bad):
        plan = half._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("gettimestamp") == 2 and plan.count("regexp_extract") <= 6  # four amounts, and the two that a rule reads itself
