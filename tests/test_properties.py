"""Properties: row accounting, dedup idempotence, independence from partitioning, a hot duplicate key."""
from pyspark.sql import functions as F

from meterline.operators.dedup import TRIP_KEY, dedup_keep_first
from meterline.operators.normalise import hard_exclusion, normalise
from meterline.plans.pipeline import load
from meterline.plans.tables import fixture_inputs
from tests.conftest import SF_SMALL


def test_accounting_identity(spark):
    raw, zones, _ = fixture_inputs(spark, SF_SMALL)
    s = load(raw, zones).summary.first()
    assert s.excluded + s.duplicates + s.flagged + s.clean == s.total_raw_rows
    assert s.inserted + s.quarantined == s.flagged + s.clean


def test_dedup_idempotent(spark):
    raw, _, _ = fixture_inputs(spark, SF_SMALL)
    once = dedup_keep_first(hard_exclusion(normalise(raw)))
    twice = dedup_keep_first(once)
    assert sorted(r.row_num for r in once.select("row_num").collect()) == \
        sorted(r.row_num for r in twice.select("row_num").collect())


def test_independent_of_partitioning(spark):
    raw, zones, _ = fixture_inputs(spark, SF_SMALL)
    a = load(raw.repartition(1), zones).trips.select("row_num", "money_per_min").collect()
    b = load(raw.repartition(7, "VendorID"), zones).trips.select("row_num", "money_per_min").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_hot_duplicate_key_keeps_first_only(spark):
    raw, zones, _ = fixture_inputs(spark, SF_SMALL)
    n = raw.count()
    template = raw.where(F.col("tpep_pickup_datetime") != "not-a-date").orderBy("row_num").limit(1)
    # copies of one trip with later row numbers: a third of all rows share one key
    copies = (template.select(F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("id"), *raw.columns)
              .select((F.lit(10 ** 17) + F.col("id")).alias("row_num"), *[c for c in raw.columns if c != "row_num"]))
    hot = raw.unionByName(copies)
    kept = load(hot, zones).kept
    base = load(raw, zones).kept
    assert kept.count() == base.count()
    assert kept.where(F.col("row_num") >= 10 ** 17).count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
