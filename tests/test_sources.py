"""Generator, partitioned writes, registry runs."""

from pyspark.sql import functions as F

from claimflow.operators import expectations as E
from claimflow.plans import claims_model
from claimflow.schemas import PARTITION_COLUMNS
from claimflow.session import scratch_path
from claimflow.sources import generate, io

from conftest import SF_SMALL


def test_generator_independent_of_partitioning(spark):
    a = generate.generate_claims(spark, spark.range(1, 501).repartition(1), 300, 200)
    b = generate.generate_claims(spark, spark.range(1, 501).repartition(9), 300, 200)
    assert a.count() == 500
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_generated_claims_are_valid_and_skewed(spark):
    raw = generate.generate_claims(spark, 4000, n_policies=1000, n_customers=800)
    ctx = claims_model.registry.context(spark, {"raw_claims": raw})
    kept = ctx.read("claims").count()
    metrics = {r.rule: r.failed for r in
               E.expectation_metrics(ctx.unchecked("claims"), E.CLAIM_RULES, "claims").collect()}
    assert metrics["valid_dates"] == 0          # incident <= claim <= report by construction
    assert metrics["valid_claim_type_values"] == 0
    assert kept > 3900
    freq = {r.claim_status: r["count"] for r in raw.groupBy("claim_status").count().collect()}
    assert max(freq, key=freq.get) == "Closed"  # weight 40 of 100


def test_generated_customers_and_policies_pass_rules(spark):
    cust = generate.generate_customers(spark, 1000)
    pol = generate.generate_policies(spark, 1000, n_customers=1000)
    ctx = claims_model.registry.context(spark, {"raw_customers": cust, "raw_policies": pol})
    assert ctx.read("customers").count() == 1000
    assert ctx.read("policies").count() > 900


def test_write_partitioned_roundtrip_with_slash_values(spark):
    raw = claims_model.context(spark, SF_SMALL).read("raw_claims")
    path = io.write_partitioned(raw, scratch_path(spark, "t-rt"), PARTITION_COLUMNS["claims"])
    back = io.read_dataset(spark, path, raw.schema)
    assert back.columns == raw.columns
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    assert back.filter(F.col("claim_type") == "wind/hail").count() > 0
    summary, sample = io.verify_written(spark, path, n=5)
    s = summary.first()
    assert s.rows == raw.count() and s.files >= s.partitions > 0
    assert sample.count() == 5


def test_row_counts_one_frame(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    rc = {r.table_name: r.row_count for r in
          io.row_counts({"claims": ctx.read("claims"), "policies": ctx.read("policies")}).collect()}
    assert rc["claims"] == ctx.read("claims").count()


def test_registry_run_writes_in_dependency_order(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    out = scratch_path(spark, "t-run")
    written = ctx.run(out, targets=["fact_claim", "agent_triage"])
    assert list(written)[:3] == ["claims", "policies", "dim_policy"] or \
        list(written).index("dim_policy") < list(written).index("fact_claim")
    assert list(written).index("fact_claim") < list(written).index("agent_scores")
    fact = spark.read.parquet(written["fact_claim"])
    assert fact.count() == claims_model.context(spark, SF_SMALL).read("fact_claim").count()


def test_registry_declarations():
    reg = claims_model.registry
    assert reg.datasets["enriched_claims"].kind == "view"
    assert reg.datasets["claim_daily_summary"].kind == "view"
    assert {"policies", "customers", "claims", "dim_customer", "dim_policy",
            "fact_claim"} <= set(reg.tables())
    assert len(reg.rules("claims")) == 18 and len(reg.rules("fact_claim")) == 6
    assert sum(len(reg.rules(t)) for t in E.RULES) == 55


def test_run_model_on_parquet_dirs(spark):
    from claimflow.plans.jobs import run_model
    from claimflow.sources import fixtures
    raw = fixtures.materialize_all(spark, SF_SMALL)
    out = scratch_path(spark, "t-job")
    written = run_model(spark, raw["policies"], raw["customers"], raw["claims"], out,
                        targets=["agent_routing", "data_lineage_audit"], run_ts="2024-01-01 00:00:00")
    assert {"claims", "fact_claim", "agent_scores", "agent_routing"} <= set(written)
    audit = spark.read.parquet(written["data_lineage_audit"]).collect()
    assert {r.source_path for r in audit} == set(raw.values())
    assert spark.read.parquet(written["agent_routing"]).count() == \
        claims_model.context(spark, SF_SMALL).read("fact_claim").count()


def test_run_observes_rule_counts_during_write(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    ctx.run(scratch_path(spark, "t-obs"), targets=["claims", "dim_policy"])
    observed = {(d, r): (p, f) for d, r, _a, p, f in ctx.rule_metrics()}
    fresh = claims_model.context(spark, SF_SMALL)
    for t in ("claims", "policies", "dim_policy"):
        for m in E.expectation_metrics(fresh.unchecked(t), fresh.registry.rules(t), t).collect():
            assert observed[(t, m.rule)] == (m.passed, m.failed)


def test_register_views(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    names = ctx.register_views()
    assert "enriched_claims" in names
    n = spark.sql("SELECT count(*) AS n FROM fact_claim").first().n
    assert n == ctx.read("fact_claim").count()


def test_quality_summary_from_observed_counts_equals_scan(spark):
    ctx = claims_model.context(spark, SF_SMALL, run_ts="2024-01-01 00:00:00")
    written = ctx.run(scratch_path(spark, "t-dq"),
                      targets=["policies", "customers", "claims", "data_quality_summary"])
    from_run = {tuple(r) for r in spark.read.parquet(written["data_quality_summary"])
                .drop("last_updated").collect()}
    scanned = {tuple(r) for r in claims_model.context(spark, SF_SMALL).read("data_quality_summary")
               .drop("last_updated").collect()}
    assert from_run == scanned


def test_run_after_lazy_reads_still_writes(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    ctx.read("fact_claim")                       # built lazily first
    written = ctx.run(scratch_path(spark, "t-lazy"), targets=["fact_claim"])
    assert {"claims", "dim_policy", "dim_customer", "fact_claim"} <= set(written)


def test_jobs_cli(spark, capsys):
    import json
    from claimflow.plans import jobs
    from claimflow.sources import fixtures
    raw = fixtures.materialize_all(spark, SF_SMALL)
    out = scratch_path(spark, "t-cli")
    jobs.main(["--policies", raw["policies"], "--customers", raw["customers"],
               "--claims", raw["claims"], "--out", out, "--targets", "dim_policy", "--run-id", "cli", "--no-quarantine"])
    written = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(written) == {"policies", "dim_policy"}
    assert spark.read.parquet(written["dim_policy"]).count() > 0
    runs = spark.read.parquet(f"{out}/run_tables")
    assert {(r.dataset, r.run_id) for r in runs.collect()} == {("policies", "cli"), ("dim_policy", "cli")}
