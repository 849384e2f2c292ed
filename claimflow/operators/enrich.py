"""Three-way enrichment of claims and the referential-integrity check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import days_between, join_texts, ratio_or_zero, split_texts
from .star import DIM_CUSTOMER_ORDER, DIM_POLICY_ORDER, dedupe

AUDIT = ("ingestion_timestamp", "data_source")


def _prefixed(df: DataFrame, key: str, prefix: str, taken: set[str]) -> DataFrame:
    """Project a dimension for a join: drop audit columns, prefix clashes."""
    cols = []
    for c in df.columns:
        if c in AUDIT:
            continue
        if c != key and c in taken:
            cols.append(F.col(c).alias(f"{prefix}{c}"))
        else:
            cols.append(F.col(c))
    return df.select(cols)


def enrich_columns(df: DataFrame) -> DataFrame:
    """Derived business metrics; NULL inputs fall to the ``otherwise`` branch."""
    return df.withColumns({
        "days_to_report": days_between("report_date", "incident_date"),
        "days_to_settle": days_between("last_updated", "claim_date"),
        "settlement_ratio": ratio_or_zero("settlement_amount", "claim_amount"),
        "is_high_value_claim": F.coalesce(F.col("claim_amount") >= 50000, F.lit(False)),
        "is_fraud_risk": F.coalesce(F.col("fraud_score") >= 70, F.lit(False)),
        "claim_complexity": F.when(F.col("witness_count") > 3, "High")
                             .when(F.col("photos_taken") > 10, "Medium")
                             .otherwise("Low"),
        "coverage_utilization": ratio_or_zero("claim_amount", "coverage_amount"),
    })


def _unaudited(df: DataFrame) -> DataFrame:
    """Without the audit columns at the table's end: they are not kept, and as the last tie-breaks they decide nothing."""
    cols = list(df.columns)
    while cols and cols[-1] in AUDIT:
        cols.pop()
    return df.select(*cols)


def _narrow(df: DataFrame, keys: list[str], into: str) -> tuple[DataFrame, list[str]]:
    """``df`` with all texts but the keys as one column, and these texts' names."""
    texts = [f.name for f in df.schema.fields if f.dataType == StringType() and f.name not in keys]
    rest = [c for c in df.columns if c not in texts]
    return df.select(*rest, join_texts(texts).alias(into)) if texts else df, texts


def _join_through_pairs(claims: DataFrame, policies: DataFrame, customers: DataFrame) -> DataFrame:
    """claims ⟕ policies ⟕ customers; the claims' wide rows are shuffled once.

    Each side is joined to the distinct pairs of ids that claims hold, and the claims to what that gives, by
    the pair: so they need not be dealt out anew for each side. The texts of a row cross the shuffles as one, which
    compresses to about three quarters of the bytes of many. All columns are moved even if the caller drops some.
    """
    packed = {}
    claims_n, packed["__claim"] = _narrow(claims, ["policy_id", "customer_id"], "__claim")
    policies_n, packed["__policy"] = _narrow(policies, ["policy_id"], "__policy")
    customers_n, packed["__customer"] = _narrow(customers, ["customer_id"], "__customer")
    pairs = claims.select("policy_id", "customer_id").distinct()
    joined = claims_n
    for side, key in ((policies_n, "policy_id"), (customers_n, "customer_id")):
        found = pairs.join(side, key, "left").withColumnsRenamed({"policy_id": "__p", "customer_id": "__c"})
        joined = joined.join(found, F.col("policy_id").eqNullSafe(F.col("__p"))
                             & F.col("customer_id").eqNullSafe(F.col("__c")), "left").drop("__p", "__c")
    packed = {into: texts for into, texts in packed.items() if texts}
    split = joined.withColumns({into: split_texts(into) for into in packed})
    text = {c: F.get(into, F.lit(i)) for into, texts in packed.items() for i, c in enumerate(texts)}
    never_null = {f.name: F.coalesce(text[f.name], F.lit("")) for f in claims.schema.fields
                  if f.name in packed.get("__claim", ()) and not f.nullable}     # said by the schema, as before
    return split.withColumns(text | never_null).drop(*packed)


def enriched_claims(claims: DataFrame, policies: DataFrame, customers: DataFrame,
                    once: bool = False, whole: bool = False) -> DataFrame:
    """claims ⟕ policies on policy_id ⟕ customers on the claim's customer_id.

    A claim comes as often as its policy and customer stand in their tables; with
    ``once`` each side is first reduced to the newest row of each key, as in the
    star schema, so the result has a row for each claim. Each side is projected before the join; a policy or customer column whose
    name is already used elsewhere gets a ``policy_`` / ``customer_`` prefix
    (the claim keeps its own ``customer_id``, ``last_updated`` ...). ``whole``, and ``once``, are for callers that take
    all columns: the sides are joined by the pairs of ids, which moves fewer bytes but leaves no column out.
    """
    if once:
        policies = dedupe(_unaudited(policies), ["policy_id"], DIM_POLICY_ORDER)
        customers = dedupe(_unaudited(customers), ["customer_id"], DIM_CUSTOMER_ORDER)
    claim_cols = set(claims.columns)
    pol = _prefixed(policies, "policy_id", "policy_",
                    claim_cols | set(customers.columns))
    cust = _prefixed(customers, "customer_id", "customer_",
                     claim_cols | set(policies.columns))
    if once or whole:
        joined = _join_through_pairs(claims, pol, cust)
    else:
        joined = claims.join(pol, "policy_id", "left").join(cust, "customer_id", "left")
    ordered = claims.columns + [c for c in pol.columns if c != "policy_id"] \
        + [c for c in cust.columns if c != "customer_id"]
    return enrich_columns(joined.select(*ordered))


def orphan_keys(child: DataFrame, parent: DataFrame, key: str | list[str]) -> DataFrame:
    """Child rows whose key has no parent row (a left anti join)."""
    keys = [key] if isinstance(key, str) else key
    return child.join(parent.select(*keys), keys, "left_anti")
