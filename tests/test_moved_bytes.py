"""What a query moves: narrow rows through shuffles, no sort or shuffle that a write does not need."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from claimflow.functions import join_texts, split_texts
from claimflow.operators import enrich, star
from claimflow.plans import catalog, claims_model, registry
from claimflow.session import scratch_path
from claimflow.sources import fixtures, generate, io

from conftest import SF_SMALL


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("table", ["policies", "customers", "claims"])
def test_raw_copies_are_dealt_out_before_their_columns_are_derived(spark, table):
    dealt, plain = fixtures.dealt_raw(spark, SF_SMALL, table), fixtures.DERIVE[table](spark, SF_SMALL)
    above, below = optimized(dealt).split("RebalancePartitions")
    assert "POL_" in above or "CUST_" in above or "CLM_" in above
    assert not any(x in below for x in ("POL_", "CUST_", "CLM_"))
    assert dealt.schema == plain.schema
    assert dealt.exceptAll(plain).count() == 0 and plain.exceptAll(dealt).count() == 0


@pytest.mark.parametrize("query", ["score_all", "settlement_record", "bad_records"])
def test_scores_join_each_dimension_once(spark, query):
    assert optimized(catalog.QUERIES[query](spark, SF_SMALL)).count("Join LeftOuter") == 2


def test_fact_keys_of_absent_repeated_and_null_ids(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    claim = ctx.read("claims").limit(1).drop("policy_id", "customer_id")
    ids = spark.createDataFrame([("p", "c"), ("p", None), (None, "c"), (None, None), ("x", "c"), ("", ""), ("p", "c")],
                                "policy_id string, customer_id string")
    key = lambda name: F.sha2(F.col(name), 256)
    pol = spark.createDataFrame([("p",), (None,), ("q",)], "policy_id string").withColumn("policy_sk", key("policy_id"))
    cust = spark.createDataFrame([("c",), ("c",), (None,)], "customer_id string").withColumn("customer_sk", key("customer_id"))
    claims = claim.crossJoin(ids)
    got = star.fact_claim(claims, pol, cust, apply_expectations=False).select(
        "policy_id", "customer_id", "policy_sk", "customer_sk")
    want = claims.select("policy_id", "customer_id").join(pol, "policy_id", "left").join(cust, "customer_id", "left").select(
        "policy_id", "customer_id", "policy_sk", "customer_sk")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 11


def test_writes_put_the_settings_back(spark):
    keys = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = [spark.conf.get(k) for k in keys]
    with io.lean_writes(spark):
        with io.lean_writes(spark, presorted=True):
            assert [spark.conf.get(k) for k in keys] == [str(io.OPEN_FILES), "true"]
        assert spark.conf.get(keys[1]) == "true"
    assert [spark.conf.get(k) for k in keys] == before


def test_a_staged_table_is_not_dealt_out_again(spark):
    rows = spark.range(1000, numPartitions=3).withColumn("part", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    path = io.stage(rows, scratch_path(spark, "m-stage"), partition_by="part", deal=False)
    back = spark.read.parquet(path).withColumn("file", F.input_file_name())
    assert back.count() == 1000 and back.select("file").distinct().count() == 6     # a file of each task and part


@pytest.mark.parametrize("quarantine", [True, False])
def test_a_large_fact_is_written_in_shares(spark, monkeypatch, quarantine):
    def write(title):
        ctx, calls = claims_model.context(spark, SF_SMALL, run_ts=catalog.RUN_TS), []
        stage = io.stage
        monkeypatch.setattr(io, "stage", lambda df, base, *a, **k: calls.append(base.split("/")[-1]) or stage(df, base, *a, **k))
        path = scratch_path(spark, f"m-{title}")
        ctx.run(path, targets=["fact_claim"], quarantine=quarantine)
        monkeypatch.setattr(io, "stage", stage)
        failed = [ctx.failed("fact_claim")] if quarantine else []
        return calls, [ctx.read("fact_claim"), *failed], sorted(ctx.rule_metrics()), ctx.row_counts()

    calls, tables, metrics, counts = write("whole")
    monkeypatch.setattr(registry, "SHARE_BYTES", 1 << 10)
    calls_s, tables_s, metrics_s, counts_s = write("shares")
    assert calls.count("fact_claim") == 1 and calls_s.count("fact_claim") == registry.SHARES
    assert metrics == metrics_s and counts == counts_s
    for a, b in zip(tables, tables_s, strict=True):
        assert a.schema == b.schema and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_shares_of_the_fact_are_the_fact(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    ids = spark.createDataFrame([("p", "c"), (None, "c"), (None, None), ("x", None), ("", ""), ("p", "c")], "policy_id string, customer_id string")
    claims = ctx.read("claims").limit(3).drop("policy_id", "customer_id").crossJoin(ids)
    pol, cust = ids.select("policy_id").distinct(), ids.select("customer_id").distinct()
    fact = lambda **kw: star.fact_claim(claims, pol, cust, catalog.RUN_TS, apply_expectations=False, **kw)
    shares = [row for k in range(3) for row in fact(share=(k, 3)).collect()]
    assert sorted(map(str, shares)) == sorted(map(str, fact().collect())) and len(shares) == 18


def test_the_fact_moves_each_id_once(spark):
    ctx = claims_model.context(spark, SF_SMALL)
    written = ctx.run(scratch_path(spark, "m-fact"), targets=["dim_policy", "dim_customer", "claims"])
    assert {"claims", "dim_policy", "dim_customer"} <= set(written)
    plan = optimized(ctx.read("fact_claim"))
    wide = next(x for x in plan.split("Join LeftOuter", 1)[1].splitlines() if ":- Project" in x)   # the claims' side
    kept = re.findall(r"[\[ ](\w+)#\d+(?=[,\]])", wide)
    assert {"claim_id", "__p", "__c"} <= set(kept) and not {"policy_id", "customer_id"} & set(kept)


def exchanges_of(plan, column: str) -> int:
    """Shuffles of a plan that move the column."""
    moves = plan.nodeName() == "Exchange" and column in re.findall(r"(\w+)#", plan.output().mkString(","))
    return moves + sum(exchanges_of(plan.children().apply(i), column) for i in range(plan.children().size()))


def test_enriched_once_moves_the_claims_once(spark):
    claims = generate.generate_claims(spark, 300, n_policies=40, n_customers=30)
    policies, customers = generate.generate_policies(spark, 30, n_customers=20), generate.generate_customers(spark, 20)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = enrich.enriched_claims(claims, policies, customers, once=True)
        assert exchanges_of(df._jdf.queryExecution().executedPlan().initialPlan(), "claim_amount") == 1
        got = df.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    plain = enrich.enriched_claims(claims, policies, customers)      # the sides hold each key once
    assert df.schema == plain.schema and len(got) == 300
    assert sorted(map(str, got)) == sorted(map(str, plain.collect()))


@pytest.fixture
def no_broadcasts(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_the_enriched_claims_query_moves_the_claims_once(spark, no_broadcasts):
    df = catalog.QUERIES["enriched_claims"](spark, SF_SMALL)
    assert exchanges_of(df._jdf.queryExecution().executedPlan().initialPlan(), "claim_amount") == 1
    view = claims_model.context(spark, SF_SMALL, materialized=False).read("enriched_claims").select(*df.columns)
    assert df.schema == view.schema and df.count() == view.count()
    assert df.exceptAll(view).count() == 0 and view.exceptAll(df).count() == 0


def test_whole_rows_fan_out_with_their_sides(spark, no_broadcasts):
    claims = generate.generate_claims(spark, 200, n_policies=12, n_customers=9)
    policies, customers = generate.generate_policies(spark, 10, n_customers=8), generate.generate_customers(spark, 8)
    policies = policies.unionByName(policies.where("policy_id < 'POL_000006'").withColumn("region", F.lit("\x01?\x02")))
    customers = customers.unionByName(customers.where("customer_id > 'CUST_000004'")).unionByName(
        customers.withColumn("customer_id", F.lit(None).cast("string")))
    plain = enrich.enriched_claims(claims, policies, customers)
    whole = enrich.enriched_claims(claims, policies, customers, whole=True)
    assert whole.schema == plain.schema and plain.count() > 200
    assert sorted(map(str, whole.collect())) == sorted(map(str, plain.collect()))


def test_rules_on_a_derived_table_are_not_one_large_method(spark):
    df = claims_model.context(spark, SF_SMALL, materialized=False).read("claims")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    rules = [x for x in plan.splitlines() if "Filter (" in x and "l_extendedprice" in x]
    assert rules and not any(re.search(r"\*\(\d+\) Filter", x) for x in rules)
    empty = fixtures._apart(spark.createDataFrame([(None, None), ("a", 1)], "t string, n int"))
    assert sorted(map(tuple, empty.collect()), key=str) == [("a", 1), (None, None)]        # no row goes


def test_plain_texts_are_joined_as_they_are(spark):
    df = spark.createDataFrame([("a", "", None), (None, None, None), ("", "é", "b"), ("a\x01", "\x02", None)], "a string, b string, c string")
    got = df.withColumn("j", join_texts([*"abc"])).withColumn("s", split_texts("j"))
    assert [r.j for r in got.collect()][:3] == ["a\x01\x01\x02", "\x02\x01\x02\x01\x02", "\x01é\x01b"]
    assert all(r.s == [r.a, r.b, r.c] for r in got.collect())
    halves = df.limit(1).select(F.unhex(F.lit("C3")).cast("string").alias("a"), F.unhex(F.lit("A9")).cast("string").alias("b"))
    back = halves.select(split_texts(join_texts([*"ab"])).alias("s")).select(*[F.hex(F.get("s", F.lit(i)).cast("binary")) for i in (0, 1)])
    assert tuple(back.first()) == ("C3", "A9")       # two parts of a character are not one


def test_enriched_once_of_odd_ids_and_texts(spark):
    claim = generate.generate_claims(spark, 1).drop("policy_id", "customer_id", "comments")
    rows = [("p", "c", "a"), ("p", None, ""), (None, "c", None), (None, None, "\x01"), ("x", "c", "\x02"), ("", "", "\x02n"),
            ("p", "c", "a"), ("q", "c", "\x02\x01,\x01\x02m\n")]
    claims = claim.crossJoin(spark.createDataFrame(rows, "policy_id string, customer_id string, comments string"))
    day = lambda d: F.lit(d).cast("date")
    pol = spark.createDataFrame([("p", 1, "new"), ("p", 2, "old"), (None, 3, "none"), ("q", 4, None), ("", 5, "\x02")],
                                "policy_id string, coverage_amount int, region string").withColumns(
        {"last_updated": F.when(F.col("region") == "old", day("2020-01-01")).otherwise(day("2021-01-01")),
         "created_date": day("2020-01-01"), "data_source": F.lit("a")})
    cust = spark.createDataFrame([("c", "\x01"), (None, "n"), ("c", "\x01"), ("", "e")], "customer_id string, city string").withColumns(
        {"last_contact_date": day("2020-01-01")})
    got = enrich.enriched_claims(claims, pol, cust, once=True).select(
        "policy_id", "customer_id", "comments", "coverage_amount", "region", "policy_last_updated", "city")
    new, by = dt.date(2021, 1, 1), {"p": (1, "new"), "q": (4, None), "": (5, "\x02")}
    want = [(p, c, t, *by.get(p, (None, None)), new if p in by else None, {"c": "\x01", "": "e"}.get(c)) for p, c, t in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_joined_texts_come_apart_again(spark):
    texts = ["", None, "a", "\x01", "\x02", "\x02n", "\x02m", "\x02x41", "\x01\x02\x01", "é\n", "x" * 1000]
    df = spark.createDataFrame([(a, b, c) for a in texts for b in texts for c in texts], "a string, b string, c string")
    df = df.withColumn("d", F.unhex(F.lit("41FF01")).cast("string"))     # not valid UTF-8
    parts = df.withColumn("j", join_texts([*"abcd"])).withColumn("s", split_texts("j"))
    same = [F.get("s", F.lit(i)).cast("binary").eqNullSafe(F.col(c).cast("binary")) for i, c in enumerate("abcd")]
    assert parts.where(~(same[0] & same[1] & same[2] & same[3] & (F.size("s") == 4))).count() == 0
    assert parts.count() == len(texts) ** 3
    assert spark.sql("SELECT cast(NULL AS string) AS j").select(split_texts("j").alias("s")).first().s is None
