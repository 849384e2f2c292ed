"""Cleaning and standardisation of the three raw tables (one projection each).

Every cleaning step is a built-in expression inside a single ``withColumns``,
so the whole table is one codegen stage after the scan. Date strings become
dates with ``try_to_date`` (an unparsable date is NULL, not an ANSI error).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical_value
from ..schemas import CANONICAL_DOMAINS, DATA_SOURCE

DATE_FORMAT = "yyyy-MM-dd"


def to_date(c: str) -> Column:
    return F.try_to_date(F.col(c), DATE_FORMAT)


def audit_columns(df: DataFrame, source: str = DATA_SOURCE, run_ts: str | None = None) -> DataFrame:
    """ingestion_timestamp (the run's timestamp) and data_source."""
    ts = F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp()
    return df.withColumns({"ingestion_timestamp": ts, "data_source": F.lit(source)})


def _clean(df: DataFrame, upper=(), title=(), lower=(), dates=(), trim=(),
           run_ts: str | None = None) -> DataFrame:
    cols: dict[str, Column] = {}
    for c in upper:
        cols[c] = F.upper(F.col(c))
    for c in title:
        dom = CANONICAL_DOMAINS.get(c)
        cols[c] = canonical_value(c, dom) if dom else F.initcap(F.col(c))
    for c in lower:
        cols[c] = F.lower(F.col(c))
    for c in dates:
        cols[c] = to_date(c)
    for c in trim:
        cols[c] = F.trim(F.col(c))
    return audit_columns(df.withColumns(cols), run_ts=run_ts)


# Which columns each table standardises, and how.
CLEAN_SPEC = {
    "policies": dict(
        upper=("policy_id", "customer_id", "region"),
        title=("policy_type", "property_type", "policy_status", "payment_frequency"),
        dates=("policy_start_date", "policy_end_date", "renewal_date", "created_date",
               "last_updated")),
    "customers": dict(
        upper=("customer_id", "state", "country"),
        title=("first_name", "last_name", "city", "occupation"),
        lower=("email",),
        dates=("date_of_birth", "customer_since", "last_contact_date")),
    "claims": dict(
        upper=("claim_id", "policy_id", "customer_id", "adjuster_id", "investigator_id"),
        title=("claim_type", "claim_status", "severity_level"),
        dates=("claim_date", "incident_date", "report_date", "created_date", "last_updated"),
        trim=("comments",)),
}


def clean_policies(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    return _clean(df, run_ts=run_ts, **CLEAN_SPEC["policies"])


def clean_customers(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    return _clean(df, run_ts=run_ts, **CLEAN_SPEC["customers"])


def clean_claims(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    return _clean(df, run_ts=run_ts, **CLEAN_SPEC["claims"])


CLEANERS = {
    "policies": clean_policies,
    "customers": clean_customers,
    "claims": clean_claims,
}


def project(df: DataFrame, cols: dict[str, str | Column]) -> DataFrame:
    """Select with renames: ``{output_name: source column or expression}``."""
    return df.select([(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in cols.items()])
