"""The claims model: bronze (cleaned, checked) and silver (star) datasets and
the scorer outputs, declared once in a registry.

Inputs are the three raw tables ``raw_policies``, ``raw_customers`` and
``raw_claims``, given as sources of a context (the test-table derivation of
``sources.fixtures``, a Parquet directory, or a generated table).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import enrich, scoring, star, summaries
from ..operators.clean import clean_claims, clean_customers, clean_policies
from ..operators.expectations import (CLAIM_RULES, CUSTOMER_RULES, DIM_CUSTOMER_RULES,
                                      DIM_POLICY_RULES, FACT_CLAIM_RULES, POLICY_RULES)
from ..sources import fixtures
from ..sources.io import rows_to_df
from .registry import Context, Registry

registry = Registry()

# Where the bronze tables' raw inputs and targets are described (lineage rows).
DEFAULT_SOURCE_BASE = "insurance_data/"
DEFAULT_CATALOG = "claims_catalog"
DEFAULT_SCHEMA = "claims_schema"


# ---- bronze ---------------------------------------------------------------------

@registry.table(name="policies", comment="Cleaned policies that pass the policy rules",
                properties={"quality": "bronze"})
@registry.expectations(POLICY_RULES)
@registry.expect_unique("unique_policy_id", "policy_id")
@registry.expect_reference("policy_customer_exists", "customer_id", "customers")
def policies(ctx: Context):
    return clean_policies(ctx.read("raw_policies"), ctx.param("run_ts"))


@registry.table(name="customers", comment="Cleaned customers that pass the customer rules",
                properties={"quality": "bronze"})
@registry.expectations(CUSTOMER_RULES)
@registry.expect_unique("unique_customer_id", "customer_id")
def customers(ctx: Context):
    return clean_customers(ctx.read("raw_customers"), ctx.param("run_ts"))


@registry.table(name="claims", comment="Cleaned claims that pass the claim rules",
                properties={"quality": "bronze"})
@registry.expectations(CLAIM_RULES)
@registry.expect_unique("unique_claim_id", "claim_id")
@registry.expect_reference("claim_policy_exists", "policy_id", "policies")
@registry.expect_reference("claim_customer_exists", "customer_id", "customers")
def claims(ctx: Context):
    return clean_claims(ctx.read("raw_claims"), ctx.param("run_ts"))


@registry.view(name="enriched_claims", comment="Each claim with its policy, its customer and derived figures")
def enriched_claims(ctx: Context):
    return enrich.enriched_claims(ctx.read("claims"), ctx.read("policies"), ctx.read("customers"),
                                  whole=ctx.param("whole_rows", False))


BRONZE = ("policies", "customers", "claims")


def _bronze_counts(ctx: Context):
    """(table_name, total_records, quality_score, rows_in) per bronze table.

    When the bronze tables were written in this run, the counts observed by
    those writes are used (no rescan); otherwise one aggregate per table.
    """
    seen = {t: ctx.observed(t) for t in BRONZE}
    if all(v is not None for v in seen.values()):
        rows = [(t, v["__kept"], v["__kept"] * 100.0 / v["__rows"] if v["__rows"] else None,
                 v["__rows"]) for t, v in seen.items()]
        return rows_to_df(
            ctx.spark, rows, "table_name string, total_records long, quality_score double, rows_in long")
    return summaries.union_all(*[
        summaries.table_quality(ctx.unchecked(t), ctx.registry.rules(t), t) for t in BRONZE])


@registry.table(name="data_quality_summary", comment="Records and share of records kept, by bronze table",
                properties={"quality": "bronze"})
def data_quality_summary(ctx: Context):
    ts = F.lit(ctx.param("run_ts")).cast("timestamp") if ctx.param("run_ts") \
        else F.current_timestamp()
    return _bronze_counts(ctx).select("table_name", "total_records", "quality_score",
                                      ts.alias("last_updated"))


def _quality_table(name, of):
    def fn(ctx: Context):
        return getattr(summaries, f"{of}_quality")(ctx.read(of))
    fn.__name__ = name
    registry.table(name=name, comment=f"Quality figures of the {of} table", properties={"quality": "bronze"})(fn)


for _t in BRONZE:
    _quality_table(f"{_t}_quality", _t)


@registry.table(name="data_lineage_audit", comment="Where each bronze table comes from, its rules and counts",
                properties={"quality": "bronze"})
def data_lineage_audit(ctx: Context):
    base = ctx.param("source_base", DEFAULT_SOURCE_BASE)
    paths = ctx.param("source_paths") or {t: f"{base}{t}/" for t in BRONZE}
    tables = {t: {"source_path": paths[t], "source_format": "parquet"} for t in BRONZE}
    rules = {t: ctx.registry.rules(t) for t in BRONZE}
    counts = _bronze_counts(ctx)
    return summaries.data_lineage_audit(
        ctx.spark, tables, rules, ctx.param("catalog", DEFAULT_CATALOG),
        ctx.param("schema", DEFAULT_SCHEMA), counts=counts, run_ts=ctx.param("run_ts"))


# ---- silver ---------------------------------------------------------------------

@registry.table(name="dim_customer", comment="One row for each customer, the latest contact",
                properties={"quality": "silver"})
@registry.expectations(DIM_CUSTOMER_RULES)
def dim_customer(ctx: Context):
    return star.dim_customer(ctx.read("customers"), apply_expectations=False)


@registry.table(name="dim_policy", comment="Conformed policy dimension",
                properties={"quality": "silver"})
@registry.expectations(DIM_POLICY_RULES)
def dim_policy(ctx: Context):
    return star.dim_policy(ctx.read("policies"), apply_expectations=False)


@registry.table(name="fact_claim", comment="Claims with the keys of their policy and customer",
                properties={"quality": "silver"}, shares_of="claims")
@registry.expectations(FACT_CLAIM_RULES)
def fact_claim(ctx: Context):
    return star.fact_claim(ctx.read("claims"), ctx.read("dim_policy"), ctx.read("dim_customer"),
                           ctx.param("run_ts"), apply_expectations=False, share=ctx.share())


@registry.view(name="claim_daily_summary", comment="Counts and sums of claims by day, type and severity")
def claim_daily_summary(ctx: Context):
    return star.claim_daily_summary(ctx.read("fact_claim"))


# ---- scoring ------------------------------------------------------------------------

@registry.view(name="scoring_base", comment="Fact joined with the scoring attributes")
def scoring_base(ctx: Context):
    return scoring.scoring_base(ctx.read("fact_claim"), ctx.read("dim_policy"),
                                ctx.read("dim_customer"))


@registry.table(name="agent_scores", comment="All four scorer outputs, computed once",
                properties={"quality": "silver"})
def agent_scores(ctx: Context):
    return scoring.score_all(ctx.read("scoring_base"))


def _subset(name):
    def fn(ctx: Context):
        return ctx.read("agent_scores").select(*scoring.TABLE_OUTPUTS[name])
    fn.__name__ = f"agent_{name}"
    return fn


for _n in ("triage", "fraud", "settlement", "routing"):
    registry.table(name=f"agent_{_n}", comment=f"{_n} scorer output",
                   properties={"quality": "silver"})(_subset(_n))


# ---- contexts -----------------------------------------------------------------------

def fixture_sources(spark: SparkSession, sf_dir: str, materialized: bool = True) -> dict:
    return {
        f"raw_{t}": (lambda t=t: fixtures.raw_table(spark, sf_dir, t, materialized))
        for t in ("policies", "customers", "claims")
    }


def context(spark: SparkSession, sf_dir: str, materialized: bool = True, **params) -> Context:
    """A context over the raw tables derived from the test tables in ``sf_dir``.

    By default the raw tables are read from their partitioned Parquet copy
    (written once per session); ``materialized=False`` derives them inline.
    """
    return registry.context(spark, fixture_sources(spark, sf_dir, materialized), **params)
