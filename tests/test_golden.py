"""Golden counts of the lineitem-derived fixture (FIXTURES.md F3), sf0.01."""
from pyspark.sql import functions as F

from meterline.plans.tables import from_testdata
from tests.conftest import SF_MID


def test_golden_counts_sf001(spark):
    t = from_testdata(spark, SF_MID)
    s = t.loaded.summary.first()
    assert (s.total_raw_rows, s.excluded, s.duplicates, s.flagged, s.clean) == (60000, 1127, 3758, 4093, 51022)
    assert s.quarantined == 2139 and s.inserted == 55115 - 2139
    counts = {(r.source, r.err_type): r["count"] for r in t.error_log.groupBy("source", "err_type").count().collect()}
    expected_quality = {"BAD_DATETIME": 301, "DROPOFF_BEFORE_PICKUP": 826, "ZERO_PASS": 1199, "HIGH_PASS": 1175,
                        "ZERO_DIST": 214, "LARGE_DIST": 179, "NEG_FARE": 166, "NEG_TOTAL": 1043, "NEG_TIP": 125,
                        "BAD_RATE_CODE": 761, "HIGH_SPEED": 3635, "HIGH_TIP_PCT": 99, "ZERO_DIST_POS_FARE": 369}
    for code, n in expected_quality.items():
        assert counts[("quality", code)] == n, code
    assert sum(v for (src, _), v in counts.items() if src == "anomaly") == 4103
    soft = t.error_log.where(~F.col("err_type").isin("BAD_DATETIME", "DROPOFF_BEFORE_PICKUP"))
    assert soft.count() == 13068
    assert soft.select(F.count_distinct("row_num")).first()[0] == 8169
