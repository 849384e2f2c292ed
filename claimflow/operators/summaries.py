"""Profiles, quality aggregates and summary tables.

Every aggregate here is a ``groupBy``/``agg`` with partial (map-side)
aggregation, so a hot group value costs one partial row per task, never a
whole group in one task. Counts over several tables are computed lazily and
unioned; nothing is pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .expectations import all_pass, rule_form_counts


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of each value, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")) \
             .orderBy(F.desc("count"), F.asc_nulls_last(col))


# The names of the columns below are the outputs' contract: fixed values.

def avg_claim_by_type(claims: DataFrame) -> DataFrame:
    return claims.groupBy("claim_type").agg(
        F.avg("claim_amount").alias("avg_claim_amount"),
        F.count("claim_id").alias("claim_count"),
    ).orderBy(F.desc("avg_claim_amount"), "claim_type")


def claims_by_severity(claims: DataFrame) -> DataFrame:
    return claims.groupBy("severity_level").agg(
        F.count("claim_id").alias("claim_count"),
        F.avg("claim_amount").alias("avg_amount"),
    ).orderBy(F.desc("claim_count"), "severity_level")


def policy_coverage(policies: DataFrame) -> DataFrame:
    return policies.groupBy("policy_type").agg(
        F.avg("coverage_amount").alias("avg_coverage"),
        F.avg("premium_amount").alias("avg_premium"),
        F.count("policy_id").alias("policy_count"),
    ).orderBy(F.desc("policy_count"), "policy_type")


def policies_quality(policies: DataFrame) -> DataFrame:
    return policies.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count("policy_id").alias("valid_policy_ids"),
        F.count_if(F.col("coverage_amount") > 0).alias("valid_coverage_amounts"),
        F.avg("premium_amount").alias("avg_premium"),
        F.max("coverage_amount").alias("max_coverage"),
    )


def customers_quality(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("email").like("%@%")).alias("valid_emails"),
        F.count("phone").alias("valid_phones"),
        F.count_distinct("state").alias("unique_states"),
    )


def claims_quality(claims: DataFrame) -> DataFrame:
    return claims.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count("comments").alias("records_with_comments"),
        F.avg("claim_amount").alias("avg_claim_amount"),
        F.max("claim_amount").alias("max_claim_amount"),
        F.count_if(F.col("settlement_amount") > 0).alias("settled_claims"),
    )


def table_quality(cleaned: DataFrame, rules, table_name: str) -> DataFrame:
    """One row: records kept by the drop rules and the share kept, in percent."""
    counts = cleaned.agg(F.count(F.lit(1)).alias("rows_in"),
                         F.count_if(all_pass(rules)).alias("rows_kept"))
    return counts.select(
        F.lit(table_name).alias("table_name"),
        F.col("rows_kept").cast("long").alias("total_records"),
        F.when(F.col("rows_in") > 0,
               F.col("rows_kept") * F.lit(100.0) / F.col("rows_in")).alias("quality_score"),
        F.col("rows_in").cast("long").alias("rows_in"),
    )


LINEAGE_SCHEMA = StructType([StructField(n, StringType(), True) for n in (
    "table_name", "source_path", "source_format", "target_catalog", "target_schema",
    "data_quality_rules", "pipeline_version")])


def data_lineage_audit(spark: SparkSession, tables: dict[str, dict], rules: dict[str, list],
                       catalog: str, schema: str, version: str = "1.0",
                       counts: DataFrame | None = None, run_ts: str | None = None) -> DataFrame:
    """Audit rows per table: source, target, rule counts derived from the registry.

    ``tables`` maps table name to ``{"source_path":..., "source_format":...}``.
    When ``counts`` (table_name, rows_in, total_records) is given, the measured
    record counts of the run are joined in.
    """
    rows = [(t, meta.get("source_path"), meta.get("source_format", "parquet"), catalog, schema,
             rule_form_counts(rules.get(t, [])), version) for t, meta in tables.items()]
    meta = spark.createDataFrame(rows, LINEAGE_SCHEMA)
    ts = F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp()
    meta = meta.withColumn("created_timestamp", ts)
    if counts is not None:
        # ``meta`` is a handful of driver-built rows: a bounded broadcast side.
        meta = counts.select("table_name", F.col("rows_in").alias("records_read"),
                             F.col("total_records").alias("records_written")) \
                     .join(F.broadcast(meta), "table_name", "right")
    return meta


def top_n(df: DataFrame, n: int, order: list) -> DataFrame:
    """First n rows under a total order (TakeOrderedAndProject: per-task top-n)."""
    return df.orderBy(*order).limit(n)


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
