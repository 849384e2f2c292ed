"""Incremental bronze: micro-batch outputs and metrics add up to the batch result."""

from pyspark.sql import functions as F

from claimflow.operators import expectations as E
from claimflow.plans import claims_model
from claimflow.schemas import CLAIM_SCHEMA, CUSTOMER_SCHEMA
from claimflow.session import scratch_path
from claimflow.sources import fixtures
from claimflow.streaming.incremental import read_rows, start_incremental

from conftest import SF_SMALL


def test_stream_equals_batch_and_restarts_cleanly(spark):
    src = fixtures.materialize_raw(spark, SF_SMALL, "customers")
    out, metrics, ckpt = (scratch_path(spark, n) for n in ("s-out", "s-metrics", "s-ckpt"))
    q = start_incremental(spark, "customers", src, CUSTOMER_SCHEMA, out, metrics, ckpt,
                          max_files_per_trigger=3)
    q.awaitTermination()
    batch = claims_model.context(spark, SF_SMALL).read("customers")
    streamed = spark.read.parquet(out)
    assert streamed.select(F.countDistinct("batch_id")).first()[0] > 1
    assert streamed.count() == batch.count()
    cols = [c for c in batch.columns if c != "ingestion_timestamp"]
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    per_rule = {r.rule: r.failed for r in spark.read.parquet(metrics)
                .groupBy("rule").agg(F.sum("failed").alias("failed")).collect()}
    whole = {r.rule: r.failed for r in E.expectation_metrics(
        claims_model.context(spark, SF_SMALL).unchecked("customers"), E.CUSTOMER_RULES,
        "customers").collect()}
    assert per_rule == whole
    # a restart on the same checkpoint finds nothing new and writes nothing
    q2 = start_incremental(spark, "customers", src, CUSTOMER_SCHEMA, out, metrics, ckpt)
    q2.awaitTermination()
    assert spark.read.parquet(out).count() == batch.count()


def test_stream_keeps_failed_rows_apart(spark):
    src = fixtures.materialize_raw(spark, SF_SMALL, "claims")
    out, metrics, ckpt = (scratch_path(spark, n) for n in ("q-out", "q-metrics", "q-ckpt"))
    q = start_incremental(spark, "claims", src, CLAIM_SCHEMA, out, metrics, ckpt, max_files_per_trigger=20, quarantine=True)
    q.awaitTermination()
    ctx = claims_model.context(spark, SF_SMALL)
    kept, failed = read_rows(spark, out), read_rows(spark, out, failed=True)
    same = [c for c in ctx.read("claims").columns if c != "ingestion_timestamp"]
    assert "PartitionFilters: [isnotnull(row_state" in failed._jdf.queryExecution().executedPlan().toString()
    want = E.failed_records(ctx.unchecked("claims"), E.CLAIM_RULES).select(*same, "failed_rules")
    assert failed.count() == want.count() > 0 and failed.select(*same, "failed_rules").exceptAll(want).count() == 0
    assert kept.count() == ctx.read("claims").count()
    assert kept.select(*same).exceptAll(ctx.read("claims").select(*same)).count() == 0
