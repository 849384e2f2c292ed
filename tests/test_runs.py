"""Runs of the model: failed rows apart, counts by run, publishing, table-level expectations."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from claimflow.functions import bloom
from claimflow.operators import enrich, expectations as E, scoring, table_checks as T
from claimflow.plans import claims_model
from claimflow.plans.registry import Registry, TableCheckError
from claimflow.session import scratch_path
from claimflow.sources import generate, io

from conftest import SF_SMALL


def local(path: str) -> str:
    return path.replace("file:", "", 1)


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def schema(spark):
    name = "runs_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def small_model(rows, fail_when="false", **checks):
    """items -> items_twice, with two drop rules and one that warns."""
    reg = Registry()

    def items(ctx):
        return rows.withColumn("amount", F.when(F.expr(fail_when), F.raise_error(F.lit("broken source")).cast("int"))
                               .otherwise(F.col("amount")))

    for name, predicate in (("positive", "amount > 0"), ("named", "id IS NOT NULL")):
        items = reg.expect_or_drop(name, predicate)(items)
    items = reg.expect("small", "amount < 5")(items)
    if "unique" in checks:
        items = reg.expect_unique("unique_id", "id", action=checks["unique"])(items)
    reg.table(name="items", comment="Items", properties={"quality": "test"})(items)

    @reg.table(name="doubled")
    def doubled(ctx):
        return ctx.read("items").select("id", (F.col("amount") * 2).alias("amount"))
    return reg


@pytest.fixture(scope="module")
def item_rows(spark):
    return spark.createDataFrame([("a", 1), ("b", 0), (None, 3), ("c", 9), ("d", None), ("e", -1), ("a", 2)],
                                 "id string, amount int")


# ---- failed rows and counts ---------------------------------------------------------------

def test_kept_and_failed_rows_are_all_rows(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    out = scratch_path(spark, "r-all")
    ctx.run(out, run_id="one")
    fresh = claims_model.context(spark, SF_SMALL)
    for t in E.RULES:
        rows, failed = fresh.unchecked(t), ctx.failed(t)
        assert ctx.read(t).count() + failed.count() == rows.count(), t
        same = [c for c in rows.columns if c not in ("ingestion_timestamp", "etl_loaded_at")]
        want = E.failed_records(rows, E.RULES[t]).select(*same, "failed_rules")
        got = failed.select(*same, "failed_rules")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, t
    tables = {r.dataset: r for r in ctx.counts("run_tables", out).collect()}
    assert set(tables) == set(claims_model.registry.tables())
    for t, r in tables.items():
        assert r.rows_kept == ctx.row_counts()[t] == ctx.read(t).count() and r.rows_read == r.rows_kept + r.rows_failed
    assert ctx.failed_tables["claims"] == f"{out}/quarantine/claims"


def test_one_scan_writes_kept_and_failed_rows(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    for t in ("policies", "customers", "claims"):
        plan = executed(E.split_by_rules(ctx.unchecked(t), E.RULES[t]).hint("rebalance", F.col(E.STATE)))
        assert plan.count("FileScan") == 1 and "Join" not in plan


def test_counts_of_runs_are_kept_by_run_id(spark, schema, item_rows):
    reg, out = small_model(item_rows, unique="warn"), scratch_path(spark, "r-ids")
    for run_id in ("2024-01-01", "2024-01-02", "2024-01-02"):      # the last repeats a run
        ctx = reg.context(spark, {})
        ctx.run(out, schema=schema, run_id=run_id)
    found = {(r.run_id, r.dataset, r.rule): (r.passed, r.failed) for r in spark.table(f"{schema}.rule_metrics").collect()}
    want = {("items", "positive"): (4, 3), ("items", "named"): (6, 1), ("items", "small"): (5, 2),
            ("items", "unique_id"): (2, 1)}
    assert found == {(i, *k): v for i in ("2024-01-01", "2024-01-02") for k, v in want.items()}
    assert ctx.counts("rule_metrics", schema=schema).count() == 8
    assert {r.id for r in spark.table(f"{schema}.items_failed").collect()} == {"b", None, "d", "e"}
    assert sorted(spark.table(f"{schema}.items_failed").where("id = 'e'").first().failed_rules) == ["positive"]
    assert spark.table(f"{schema}.doubled").count() == 3
    with pytest.raises(ValueError):
        reg.context(spark, {}).run(out, run_id="../x")


def test_model_run_without_quarantine(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    ctx.run(scratch_path(spark, "r-noq"), targets=["claims", "policies", "dim_policy"], quarantine=False)
    fresh = claims_model.context(spark, SF_SMALL)
    for t in ("claims", "policies", "dim_policy"):
        assert ctx.row_counts()[t] == ctx.read(t).count() == fresh.read(t).count()
        kept = ctx.observed(t)
        assert kept["__rows"] == fresh.unchecked(t).count()


def test_run_without_quarantine_and_empty_states(spark, item_rows):
    out = scratch_path(spark, "r-plain")
    ctx = small_model(item_rows).context(spark, {})
    ctx.run(out, quarantine=False)
    assert ctx.failed_tables == {} and not os.path.exists(local(f"{out}/quarantine"))
    assert sorted(r.id for r in ctx.read("items").collect()) == ["a", "a", "c"]
    good = small_model(item_rows.where("id = 'a'")).context(spark, {})
    good.run(scratch_path(spark, "r-good"))
    assert good.failed("items").count() == 0 and "failed_rules" in good.failed("items").columns
    bad = small_model(item_rows.where("id = 'b'")).context(spark, {})
    bad.run(scratch_path(spark, "r-bad"))
    assert bad.read("items").count() == 0 == bad.read("doubled").count() and bad.failed("items").count() == 1


# ---- publishing ---------------------------------------------------------------------------

@pytest.mark.parametrize("named", [True, False])
def test_a_failed_write_leaves_the_old_rows(spark, schema, item_rows, named):
    out, where = scratch_path(spark, "r-fail"), schema if named else None
    written = small_model(item_rows).context(spark, {}).run(out, schema=where, run_id="good")
    read = lambda t: sorted(map(tuple, (spark.table(written[t]) if named else spark.read.parquet(written[t])
                                        ).collect()), key=str)
    before = {t: read(t) for t in written}
    assert before["doubled"] == [("a", 2), ("a", 4), ("c", 18)]
    # the second run fails after some of its tasks, or in its second table
    later = item_rows.unionByName(item_rows)
    with pytest.raises(Exception, match="broken source"):
        small_model(later, fail_when="id = 'e'").context(spark, {}).run(out, schema=where, run_id="bad")
    reg = small_model(later)
    reg.datasets["doubled"].fn = lambda ctx: ctx.read("items").select("id", F.raise_error(F.lit("broken table")).alias("x"))
    ctx = reg.context(spark, {})
    with pytest.raises(Exception, match="broken table"):
        ctx.run(out, schema=where, run_id="bad")
    assert {t: read(t) for t in written} == before
    metrics = ctx.counts("rule_metrics", out, where)
    assert [r.run_id for r in metrics.select("run_id").distinct().collect()] == ["good"]
    # a good run after them replaces all
    small_model(later).context(spark, {}).run(out, schema=where, run_id="next")
    assert len(read("doubled")) == 6


def test_write_table_switches_to_new_files(spark, schema):
    base, name = scratch_path(spark, "r-switch"), f"{schema}.t"
    ids = lambda n, **more: spark.range(n).withColumns(more)
    io.write_table(ids(3), name, path=base, comment="It's one", properties={"a": "b"})
    first, held = io.table_location(spark, name), spark.table(name)
    with pytest.raises(Exception, match="no luck"):
        io.write_table(ids(5, id=F.raise_error(F.lit("no luck")).cast("long")), name, path=base)
    assert spark.table(name).count() == 3 and io.table_location(spark, name) == first
    io.write_table(ids(5), name, path=base)
    assert spark.table(name).count() == 5 and io.table_location(spark, name) != first
    assert held.count() == 3                       # a reader of the version before
    for n in (6, 7, 8):
        io.write_table(ids(n), name, path=base)
    assert spark.table(name).count() == 8 and len(glob.glob(f"{local(base)}/v-*")) <= io.KEEP_VERSIONS + 1
    io.write_table(ids(2, more=F.lit("x")), name, path=base)       # another schema
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 2
    unplaced = io.write_table(ids(4), f"{schema}.u")               # below the schema's own location
    assert spark.table(unplaced).count() == 4


def test_compacting_a_table(spark, schema, item_rows):
    path = scratch_path(spark, "r-many")
    spark.range(4000).repartition(24).write.parquet(path)
    name = f"{schema}.many"
    spark.catalog.createTable(name, path=path, source="parquet", schema=spark.range(1).schema)
    files = lambda t: spark.table(t).select(F.input_file_name()).distinct().count()
    assert files(name) == 24
    io.compact_table(spark, name)
    assert files(name) == 1 and spark.table(name).agg(F.sum("id")).first()[0] == 4000 * 3999 // 2
    assert len(glob.glob(f"{local(path)}/*.parquet")) == 24          # files that are not ours stay
    out = scratch_path(spark, "r-compact")
    written = small_model(item_rows).context(spark, {}).run(out, schema=schema)
    for _ in range(4):
        io.compact_table(spark, written["items"])
    assert io.table_location(spark, written["items"]).startswith(io.table_location(spark, written["doubled"]).split("/doubled/")[0])
    assert spark.table(written["items"]).count() == 3 and spark.table(f"{schema}.items_failed").count() == 4
    assert spark.catalog.getTable(written["items"]).description == "Items"


def test_swap_keeps_the_old_folder_if_the_new_one_is_missing(spark):
    path = scratch_path(spark, "r-swap")
    spark.range(3).write.parquet(f"{path}/t")
    with pytest.raises(Exception):
        io.swap_folder(spark, f"{path}/nothing", f"{path}/t")
    assert spark.read.parquet(f"{path}/t").count() == 3


def test_files_have_the_advisory_size(spark):
    wide = spark.range(200_000, numPartitions=40).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")

    def sizes(df, advisory):
        for k, v in zip(keys, (advisory, "false")):      # small tables too in files of that size
            spark.conf.set(k, v)
        try:
            path = io.stage(df, scratch_path(spark, "r-size"))
        finally:
            for k in keys:
                spark.conf.unset(k)
        return [os.path.getsize(f) for f in glob.glob(f"{local(path)}/*.parquet")]

    assert len(sizes(wide, "64m")) == 1            # not one for each of 40 splits
    small = sizes(wide, "2m")
    assert 6 <= len(small) <= 16 and max(small) < 4 << 20
    hot = wide.withColumn("id", F.lit(7))          # all rows on one value of the column they are dealt by
    assert len(sizes(hot, "2m")) >= 4


def test_counts_of_written_tables_read_no_column(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    ctx.run(scratch_path(spark, "r-counts"), targets=["fact_claim", "agent_scores"])
    tables = ["policies", "claims", "dim_policy", "dim_customer", "fact_claim", "agent_scores"]
    counts = io.row_counts({t: ctx.read(t) for t in tables})
    plan = executed(counts)
    assert plan.count("FileScan") == len(tables) == len(re.findall(r"ReadSchema: struct<>", plan))
    assert not re.search("Join|Window", plan)
    assert {r.table_name: r.row_count for r in counts.collect()} == {t: ctx.row_counts()[t] for t in tables}


# ---- expectations on tables ------------------------------------------------------------------

def test_a_failed_table_check_publishes_nothing(spark, item_rows):
    out = scratch_path(spark, "r-check")
    with pytest.raises(TableCheckError, match="unique_id"):
        small_model(item_rows, unique="fail").context(spark, {}).run(out)
    assert not os.path.exists(local(f"{out}/items")) and not os.path.exists(local(f"{out}/rule_metrics"))
    small_model(item_rows.dropDuplicates(["id"]), unique="fail").context(spark, {}).run(out)
    assert os.path.exists(local(f"{out}/items"))


def test_references_between_tables_of_a_run(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    ctx.run(scratch_path(spark, "r-refs"), targets=["policies", "customers", "claims"])
    found = {(d, r): f for d, r, _, _, f in ctx.rule_metrics()}
    for child, key, parent, rule in (("claims", "policy_id", "policies", "claim_policy_exists"),
                                     ("claims", "customer_id", "customers", "claim_customer_exists"),
                                     ("policies", "customer_id", "customers", "policy_customer_exists")):
        assert found[child, rule] == enrich.orphan_keys(ctx.read(child), ctx.read(parent), key).count()
    alone = claims_model.context(spark, SF_SMALL)
    alone.run(scratch_path(spark, "r-refs1"), targets=["claims"])      # no parent in the run: not counted
    assert not [r for _, r, *_ in alone.rule_metrics() if r.endswith("_exists")]


@pytest.mark.parametrize("filtered", [False, True])
def test_orphans_with_null_keys_and_two_columns(spark, filtered):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (None, "a"), (2, None), (3, "c"), (3, "c")], "x int, y string")
    parent = spark.createDataFrame([(1, "a"), (1, "a"), (3, "d"), (None, "a"), (2, None)], "p int, q string")
    got = T.orphan_counts(child, parent, ["x", "y"], ["p", "q"], bloom_keys=5 if filtered else None)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "b", 2), (3, "c", 2), (None, "a", 1), (2, None, 1)], key=str)
    rule = T.Reference("r", ("x", "y"), "parent", ("p", "q"))
    assert tuple(T.reference_metrics(child, parent, rule, "child", 5 if filtered else None).first()) == (
        "child", "r", "warn", 1, 6)
    empty = parent.limit(0)
    assert T.orphan_counts(child, empty, ["x", "y"], ["p", "q"]).agg(F.sum("n_rows")).first()[0] == 7
    assert T.reference_metrics(child.limit(0), parent, rule, "child").first().failed == 0


def test_bloom_filter_has_every_key_and_few_others(spark):
    keys = spark.range(20_000).select((F.col("id") * 7).alias("k"))
    words = bloom.words_for(20_000)
    table = bloom.build(keys, "k", words)
    assert table.count() <= words
    asked = spark.range(140_000).select(F.col("id").alias("k"))
    found = bloom.maybe(asked, "k", table, words, "maybe").groupBy((F.col("k") % 7 == 0).alias("member")).agg(
        F.count_if("maybe").alias("yes"), F.count("*").alias("n"))
    rates = {r.member: r.yes / r.n for r in found.collect()}
    assert rates[True] == 1.0 and rates[False] < 0.05


def test_keys_are_filtered_only_where_they_are_too_large_to_broadcast(spark):
    parent = generate.generate_customers(spark, 3000)
    assert T.keys_to_filter(spark.range(10), ["id"]) is None
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "1k")
    try:
        assert T.keys_to_filter(parent, ["customer_id"]) == 3000
    finally:
        spark.conf.set(key, old)


def test_enriching_once_keeps_the_row_count(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    claims, policies, customers = (ctx.read(t) for t in ("claims", "policies", "customers"))
    doubled = policies.unionByName(policies)
    assert enrich.enriched_claims(claims, doubled, customers).count() > claims.count()
    assert enrich.enriched_claims(claims, doubled, customers, once=True).count() == claims.count()
    assert T.duplicate_keys(doubled, ["policy_id"]).count() == policies.count()
    rule = T.UniqueKey("u", ("policy_id",))
    assert T.unique_metrics(doubled, rule, "policies").first().failed == policies.count()
    assert T.unique_metrics(doubled.limit(0), rule, "policies").first().failed == 0


# ---- records that do not parse ------------------------------------------------------------------

def test_a_bad_record_is_named_and_the_others_are_scored(spark):
    records = spark.createDataFrame(
        [("1", "n/a", "3"), ("2", "60000", "two"), ("3", "60000", "3"), ("4", None, None), ("5", " 12 ", ""), ("6", "NaN", "3.5")],
        "claim_id string, claim_amount string, witness_count string")
    out = {r.claim_id: r for r in scoring.score_records_all(records, errors="errors").collect()}
    assert {k: r.errors for k, r in out.items()} == {
        "1": ["claim_amount"], "2": ["witness_count"], "3": [], "4": [], "5": ["witness_count"], "6": ["witness_count"]}
    assert (out["1"].priority_score, out["1"].reserve_amount, out["1"].channel, out["1"].fraud_risk_score) == (None,) * 4
    assert out["2"].fraud_risk_score is None and out["2"].priority_score == 70.0
    assert out["3"].fraud_risk_score == 20 and out["5"].priority_score == 10.01 and out["6"].priority_score == 10.0
    good = records.where("claim_id = '3'")
    plain = scoring.score_records_all(good).first().asDict()
    assert {k: v for k, v in scoring.score_records_all(good, errors="e").first().asDict().items() if k != "e"} == plain
    with pytest.raises(Exception, match="does not parse"):
        scoring.score_records(records, "triage").collect()


# ---- plans -----------------------------------------------------------------------------------------

def test_hot_join_keys_are_split_over_tasks(spark):
    """A third of the claims on one policy: sort-merge joins whose hot partition is split."""
    n = 30_000
    claims = generate.generate_claims(spark, n, n_policies=500, n_customers=400)
    hot = F.col("claim_id") <= F.lit(f"CLM_{n // 3:06d}")
    claims = claims.withColumn("policy_id", F.when(hot, "POL_000001").otherwise(F.col("policy_id")))
    path = scratch_path(spark, "r-skew")
    claims.repartition(12).write.parquet(path)             # several map outputs to split by
    policies = generate.generate_policies(spark, 500, n_customers=400)
    customers = generate.generate_customers(spark, 400)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        raw = spark.read.parquet(path)
        joined = enrich.enriched_claims(raw, policies, customers)
        rows = joined.collect()
        assert "SortMergeJoin(skew=true)" in executed(joined)
        by_policy = raw.join(policies.select("policy_id", "coverage_amount"), "policy_id", "left").withColumn(
            "task", F.spark_partition_id())
        tasks = {r.task for r in by_policy.collect() if r.policy_id == "POL_000001"}
        assert "SortMergeJoin(skew=true)" in executed(by_policy) and len(tasks) >= 3
        # the fact's key lookup and the scoring base, over dimensions that a run has written (those of a lazy
        # plan come straight from their deduplication, whose partitions Spark can't split)
        ctx = claims_model.registry.context(spark, {"raw_claims": raw, "raw_policies": policies,
                                                    "raw_customers": customers})
        ctx.run(scratch_path(spark, "r-skew-run"), targets=["claims", "dim_policy", "dim_customer"])
        scores = ctx.read("agent_scores")
        n_scored = len(scores.collect())
        assert "SortMergeJoin(skew=true)" in executed(scores)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == n and sum(r.policy_id == "POL_000001" for r in rows) >= n // 3
    assert all(r.coverage_amount is not None for r in rows) and 0.9 * n < n_scored <= n


@pytest.mark.parametrize("table, draws", [("claims", 23), ("policies", 22), ("customers", 22)])
def test_each_draw_is_hashed_once_a_row(spark, table, draws):
    args = {"claims": (50, 30, 20), "policies": (50, 20), "customers": (50,)}[table]
    df = getattr(generate, f"generate_{table}")(spark, *args)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("md5(") == draws
