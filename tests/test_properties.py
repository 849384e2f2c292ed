"""Properties: conservation of rows, and record scoring against a plain-Python model."""

import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField, StructType)

from claimflow.operators import expectations as E, scoring
from claimflow.plans import claims_model

from conftest import SF_SMALL


def test_kept_plus_failed_equals_rows_in(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    for t in ("policies", "customers", "claims"):
        rows_in = ctx.unchecked(t).count()
        kept = ctx.read(t).count()
        failed = E.failed_records(ctx.unchecked(t), ctx.registry.rules(t)).count()
        assert kept + failed == rows_in, t


def test_scorers_keep_row_count(spark):
    base = claims_model.context(spark, SF_SMALL).read("scoring_base")
    n = base.count()
    assert scoring.score_all(base).count() == n
    assert scoring.score_records_all(base.withColumn(
        "days_to_report", F.datediff("report_date", "incident_date"))).count() == n


# ---- record form against a plain-Python statement of the rules -----------------------

def cents(x):
    return math.floor(x * 100.0 + 0.5) / 100.0


def model(rec):
    def get(k, d):
        v = rec.get(k)
        return d if v is None or (isinstance(v, float) and math.isnan(v)) else v
    amount = get("claim_amount", 0.0)
    sev, status = get("severity_level", "Low"), get("claim_status", "Open")
    score = amount / 1000 + {"Critical": 30, "High": 20, "Medium": 10}.get(sev, 5) \
        + (5 if status in ("Open", "In Progress") else 0)
    band = "P1" if score >= 60 else "P2" if score >= 40 else "P3" if score >= 20 else "P4"
    f = (10 if get("lifetime_claims_count", 0) >= 3 else 0) + (15 if amount >= 50000 else 0) \
        + (10 if get("witness_count", 0) == 0 and get("photos_taken", 0) < 3 else 0) \
        + (8 if get("days_to_report", 0) > 14 else 0) \
        + (5 if get("premium_coverage_ratio", 0.0) < 0.005 else 0) \
        + (5 if get("state", "") in ("FL", "LA", "TX") else 0)
    fband = "High" if f >= 35 else "Medium" if f >= 20 else "Low"
    fs = get("fraud_score", None)
    fs = get("fraud_risk_score", 0.0) if fs is None else fs
    mult = {"Critical": 0.9, "High": 0.7, "Medium": 0.5}.get(sev, 0.3)
    adj = -0.1 if fs >= 70 else (-0.05 if fs >= 40 else 0.0)
    reserve = cents(amount * mult * (1.0 + adj))
    channel = "Straight-Through Processing" if amount < 2000 else \
        "Adjuster" if sev in ("Low", "Medium") else "Senior Adjuster"
    return (cents(score), band, f, fband, reserve, cents(reserve * 0.85), channel)


SCHEMA = StructType([
    StructField("claim_amount", DoubleType()), StructField("severity_level", StringType()),
    StructField("claim_status", StringType()), StructField("lifetime_claims_count", IntegerType()),
    StructField("witness_count", IntegerType()), StructField("photos_taken", IntegerType()),
    StructField("days_to_report", IntegerType()),
    StructField("premium_coverage_ratio", DoubleType()), StructField("state", StringType()),
    StructField("fraud_score", DoubleType()), StructField("fraud_risk_score", DoubleType())])


def maybe(s):
    return st.one_of(st.none(), s)


record = st.fixed_dictionaries({
    "claim_amount": maybe(st.one_of(st.floats(0, 200000, allow_nan=False),
                                    st.sampled_from([1999.99, 2000.0, 50000.0]))),
    "severity_level": maybe(st.sampled_from(["Low", "Medium", "High", "Critical", "other"])),
    "claim_status": maybe(st.sampled_from(["Open", "In Progress", "Closed", "Denied"])),
    "lifetime_claims_count": maybe(st.integers(0, 6)),
    "witness_count": maybe(st.integers(0, 4)), "photos_taken": maybe(st.integers(0, 5)),
    "days_to_report": maybe(st.integers(0, 40)),
    "premium_coverage_ratio": maybe(st.sampled_from([0.001, 0.004, 0.005, 0.02])),
    "state": maybe(st.sampled_from(["FL", "LA", "TX", "CA", ""])),
    "fraud_score": maybe(st.floats(0, 100, allow_nan=False)),
    "fraud_risk_score": maybe(st.floats(0, 100, allow_nan=False)),
})


@settings(max_examples=4, deadline=None)
@given(st.lists(record, min_size=1, max_size=150))
def test_record_scoring_matches_model(spark, recs):
    df = spark.createDataFrame([tuple(r[f.name] for f in SCHEMA.fields) for r in recs], SCHEMA) \
        .withColumn("rid", F.monotonically_increasing_id())
    out = scoring.score_records_all(df).orderBy("rid").collect()
    assert len(out) == len(recs)
    for rec, row in zip(recs, out):
        got = (row.priority_score, row.priority_band, row.fraud_risk_score, row.fraud_risk_band,
               row.reserve_amount, row.suggested_settlement, row.channel)
        assert got == model(rec), (rec, got)
