"""Rule-based claim scorers: triage, fraud, settlement, routing.

Each scorer is a set of column expressions, so scoring a table is a single
projection inside whole-stage codegen; there is no Python worker and no row
loop. Two forms exist and differ on purpose:

* ``mode="table"``: scores the joined fact table. NULL inputs fall through the
  ``when`` chains (a NULL amount gives a NULL priority score and band P4).
* ``mode="record"``: scores free-form records where any field may be absent.
  Absent or NULL (or NaN) fields take a default, the triage band is taken from
  the unrounded score, money is rounded to cents, and no adjuster is assigned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import days_between, hash_bucket, padded_bucket, round_cents

# ---- fixed values: thresholds, bonuses, labels -------------------------------
SEVERITY_BONUS = [("Critical", 30), ("High", 20), ("Medium", 10)]
SEVERITY_BONUS_DEFAULT = 5
OPEN_STATUSES = ["Open", "In Progress"]
OPEN_STATUS_BONUS = 5
LATE_CLAIM_DAYS, LATE_CLAIM_PENALTY = 30, -5
PRIORITY_BANDS = [(60, "P1"), (40, "P2"), (20, "P3")]
PRIORITY_BAND_DEFAULT = "P4"

FRAUD_HIGH_STATES = ["FL", "LA", "TX"]
FRAUD_BANDS = [(35, "High"), (20, "Medium")]
FRAUD_BAND_DEFAULT = "Low"

RESERVE_FACTOR = [("Critical", 0.9), ("High", 0.7), ("Medium", 0.5)]
RESERVE_FACTOR_DEFAULT = 0.3
FRAUD_ADJUSTMENT = [(70, -0.1), (40, -0.05)]
SUGGESTED_SHARE = 0.85

STP_LIMIT = 2000
CH_STP, CH_ADJ, CH_SENIOR = "Straight-Through Processing", "Adjuster", "Senior Adjuster"
ADJUSTER_POOL, SENIOR_POOL = 50, 20
ACTION_STP = "Auto-approve if checks pass"
ACTION_CRITICAL = "Escalate to senior adjuster"
ACTION_HIGH = "Expedite investigation"
ACTION_DEFAULT = "Standard processing"

# record-form defaults for absent fields
RECORD_DEFAULTS = {
    "claim_amount": 0.0, "severity_level": "Low", "claim_status": "Open",
    "lifetime_claims_count": 0, "witness_count": 0, "photos_taken": 0,
    "days_to_report": 0, "premium_coverage_ratio": 0.0, "state": "",
}


def _lookup(c: Column, pairs, default) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def _band(score: Column, bands, default) -> Column:
    expr = None
    for t, label in bands:
        expr = F.when(score >= t, F.lit(label)) if expr is None else expr.when(score >= t, F.lit(label))
    return expr.otherwise(F.lit(default))


def _flag(cond: Column, points: int) -> Column:
    return F.when(cond, F.lit(points)).otherwise(F.lit(0))


# ---- table form ------------------------------------------------------------------

def triage_columns(mode: str = "table") -> dict[str, Column]:
    amount = F.col("claim_amount")
    sev, status = F.col("severity_level"), F.col("claim_status")
    score = (amount / 1000
             + _lookup(sev, SEVERITY_BONUS, SEVERITY_BONUS_DEFAULT)
             + _flag(status.isin(*OPEN_STATUSES), OPEN_STATUS_BONUS))
    if mode == "table":
        late = days_between("claim_date", "incident_date") > LATE_CLAIM_DAYS
        score = score + F.when(late, F.lit(LATE_CLAIM_PENALTY)).otherwise(F.lit(0))
        return {"priority_score": score,
                "priority_band": _band(score, PRIORITY_BANDS, PRIORITY_BAND_DEFAULT)}
    return {"priority_score": round_cents(score),
            "priority_band": _band(score, PRIORITY_BANDS, PRIORITY_BAND_DEFAULT)}


def fraud_flag_columns(mode: str = "table") -> dict[str, Column]:
    days_to_report = (days_between("report_date", "incident_date") if mode == "table"
                      else F.col("days_to_report"))
    return {
        "recent_claims_flag": _flag(F.col("lifetime_claims_count") >= 3, 10),
        "high_amount_flag": _flag(F.col("claim_amount") >= 50000, 15),
        "low_evidence_flag": _flag((F.col("witness_count") == 0) & (F.col("photos_taken") < 3), 10),
        "late_report_flag": _flag(days_to_report > 14, 8),
        "policy_ratio_flag": _flag(F.col("premium_coverage_ratio") < 0.005, 5),
        "state_risk_flag": _flag(F.col("state").isin(*FRAUD_HIGH_STATES), 5),
    }


def fraud_columns(mode: str = "table", with_flags: bool = False) -> dict[str, Column]:
    flags = fraud_flag_columns(mode)
    score = None
    for c in flags.values():
        score = c if score is None else score + c
    out = dict(flags) if with_flags else {}
    out["fraud_risk_score"] = score
    out["fraud_risk_band"] = _band(score, FRAUD_BANDS, FRAUD_BAND_DEFAULT)
    return out


def settlement_columns(mode: str = "table") -> dict[str, Column]:
    sev = F.col("severity_level")
    fraud_score = (F.col("fraud_score") if mode == "table" else F.col("__fraud_in"))
    base = F.col("claim_amount") * _lookup(sev, RESERVE_FACTOR, RESERVE_FACTOR_DEFAULT)
    adj = _lookup_threshold(fraud_score, FRAUD_ADJUSTMENT, 0.0)
    reserve = base * (F.lit(1.0) + adj)
    if mode == "table":
        reserve = reserve.cast("double")
        return {"reserve_amount": reserve,
                "suggested_settlement": (reserve * SUGGESTED_SHARE).cast("double")}
    reserve = round_cents(reserve)
    return {"reserve_amount": reserve,
            "suggested_settlement": round_cents(reserve * SUGGESTED_SHARE)}


def _lookup_threshold(c: Column, pairs, default) -> Column:
    expr = None
    for t, v in pairs:
        expr = F.when(c >= t, F.lit(v)) if expr is None else expr.when(c >= t, F.lit(v))
    return expr.otherwise(F.lit(default))


def routing_columns(mode: str = "table") -> dict[str, Column]:
    amount, sev = F.col("claim_amount"), F.col("severity_level")
    channel = (F.when(amount < STP_LIMIT, F.lit(CH_STP))
               .when(sev.isin("Low", "Medium"), F.lit(CH_ADJ))
               .otherwise(F.lit(CH_SENIOR)))
    action = (F.when(channel == CH_STP, F.lit(ACTION_STP))
              .when(sev == "Critical", F.lit(ACTION_CRITICAL))
              .when(sev == "High", F.lit(ACTION_HIGH))
              .otherwise(F.lit(ACTION_DEFAULT)))
    out = {"channel": channel}
    if mode == "table":
        out["assigned_adjuster"] = (
            F.when(channel == CH_STP, F.lit("AUTO"))
            .when(channel == CH_ADJ, padded_bucket("ADJ_", hash_bucket("claim_id", ADJUSTER_POOL)))
            .otherwise(padded_bucket("SADJ_", hash_bucket("claim_id", SENIOR_POOL))))
    out["recommended_action"] = action
    return out


SCORERS = {
    "triage": triage_columns,
    "fraud": fraud_columns,
    "settlement": settlement_columns,
    "routing": routing_columns,
}

# Output projections of the four table-form scorers.
TABLE_OUTPUTS = {
    "triage": ["claim_id", "policy_id", "customer_id", "claim_type", "claim_status",
               "severity_level", "claim_date", "incident_date", "claim_amount",
               "priority_score", "priority_band"],
    "fraud": ["claim_id", "policy_id", "customer_id", "claim_type", "claim_status",
              "fraud_risk_score", "fraud_risk_band"],
    "settlement": ["claim_id", "policy_id", "customer_id", "claim_type", "severity_level",
                   "claim_amount", "reserve_amount", "suggested_settlement"],
    "routing": ["claim_id", "policy_id", "customer_id", "claim_type", "claim_status",
                "channel", "assigned_adjuster", "recommended_action"],
}


def scoring_base(fact: DataFrame, dim_policy: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """fact ⟕ policy (status, ratio) ⟕ customer (lifetime claims, state).

    Only the needed dimension columns reach the joins. Join strategy is left
    to Catalyst/AQE: a dimension under the broadcast threshold is broadcast,
    a larger one is shuffled (sort-merge, with AQE skew splitting).
    """
    pol = dim_policy.select("policy_id", "policy_status", "premium_coverage_ratio")
    cust = dim_customer.select("customer_id", "lifetime_claims_count", "state")
    return fact.join(pol, "policy_id", "left").join(cust, "customer_id", "left")


def _score_table(base: DataFrame, name: str) -> DataFrame:
    cols = SCORERS[name]("table")
    return base.withColumns(cols).select(*TABLE_OUTPUTS[name])


def triage(df: DataFrame, mode: str = "table") -> DataFrame:
    return _score_table(df, "triage") if mode == "table" else score_records(df, "triage")


def fraud(df: DataFrame, mode: str = "table") -> DataFrame:
    return _score_table(df, "fraud") if mode == "table" else score_records(df, "fraud")


def settlement(df: DataFrame, mode: str = "table") -> DataFrame:
    return _score_table(df, "settlement") if mode == "table" else score_records(df, "settlement")


def routing(df: DataFrame, mode: str = "table") -> DataFrame:
    return _score_table(df, "routing") if mode == "table" else score_records(df, "routing")


def score_all(base: DataFrame) -> DataFrame:
    """All four table-form outputs in one projection over one base.

    The per-scorer tables are column subsets of this frame, so the scan and
    the joins run once instead of once per scorer.
    """
    cols: dict[str, Column] = {}
    for name in ("triage", "fraud", "settlement", "routing"):
        cols.update(SCORERS[name]("table"))
    # withColumns resolves all expressions against the input, so scores that
    # feed bands are recomputed inline; Catalyst dedups common subexpressions.
    keep = []
    for name in ("triage", "fraud", "settlement", "routing"):
        for c in TABLE_OUTPUTS[name]:
            if c not in keep:
                keep.append(c)
    return base.withColumns(cols).select(*keep)


# ---- record form -----------------------------------------------------------------

#: Types of the record fields.
RECORD_KINDS = {"claim_amount": "double", "severity_level": "string", "claim_status": "string",
                "lifetime_claims_count": "int", "witness_count": "int", "photos_taken": "int",
                "days_to_report": "int", "premium_coverage_ratio": "double", "state": "string"}
FRAUD_FIELDS = ("fraud_score", "fraud_risk_score")          # the first one present counts
#: Fields that each scorer reads: one that doesn't parse fails this scorer's outputs only.
SCORER_FIELDS = {
    "triage": ("claim_amount", "severity_level", "claim_status"),
    "fraud": ("lifetime_claims_count", "claim_amount", "witness_count", "photos_taken", "days_to_report",
              "premium_coverage_ratio", "state"),
    "settlement": ("claim_amount", "severity_level", *FRAUD_FIELDS),
    "routing": ("claim_amount", "severity_level"),
}


def _parsed(df: DataFrame, name: str, kind: str) -> Column:
    """A field as its type, NULL where it is absent, NULL, NaN or does not parse."""
    if name not in df.columns:
        return F.lit(None).cast(kind)
    c = F.col(name).try_cast(kind)
    return F.when(~F.isnan(c), c) if kind == "double" else c


def _unparsed(df: DataFrame, name: str, kind: str) -> Column:
    """Whether a field holds something that is not of its type."""
    if name not in df.columns:
        return F.lit(False)
    return F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()


def _kinds() -> dict[str, str]:
    return RECORD_KINDS | {f: "double" for f in FRAUD_FIELDS}


def record_inputs(df: DataFrame, errors: str | None = None) -> DataFrame:
    """Normalise a records table: every scorer input present, defaults applied.

    A field that does not parse as its type ends the job, unless ``errors`` names a
    column to hold the names of such fields (sorted, empty where all is well).
    """
    default = lambda n, k: F.coalesce(_parsed(df, n, k), F.lit(RECORD_DEFAULTS[n]).cast(k))
    bad = {n: _unparsed(df, n, k) for n, k in sorted(_kinds().items())}
    cols = {n: default(n, k) for n, k in RECORD_KINDS.items()}
    cols["__fraud_in"] = F.coalesce(*(_parsed(df, f, "double") for f in FRAUD_FIELDS), F.lit(0.0))
    if errors is None:
        for n in (n for n in cols if n in df.columns):
            cols[n] = F.when(bad[n], F.raise_error(F.concat(
                F.lit(f"{n} does not parse: "), F.col(n).cast("string"))).cast(RECORD_KINDS[n])).otherwise(cols[n])
        for f in FRAUD_FIELDS:
            cols["__fraud_in"] = F.when(bad[f], F.raise_error(F.lit(f"{f} does not parse")).cast("double")
                                        ).otherwise(cols["__fraud_in"])
    else:
        cols[errors] = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in bad.items()])).cast("array<string>")
    return df.select([F.col(c) for c in df.columns if c not in cols] + [c.alias(n) for n, c in cols.items()])


def _record_outputs(scorer: str, errors: str | None) -> dict[str, Column]:
    """A scorer's outputs; NULL where one of its fields did not parse."""
    out = SCORERS[scorer]("record")
    if errors is None:
        return out
    wrong = F.arrays_overlap(F.col(errors), F.array(*map(F.lit, SCORER_FIELDS[scorer])))
    return {n: F.when(~wrong, c) for n, c in out.items()}


def score_records(df: DataFrame, scorer: str, errors: str | None = None) -> DataFrame:
    """Score a table of records with one scorer (record form).

    Returns the records with every scorer input present (defaults filled in)
    followed by the scorer's outputs. An unknown scorer name raises
    ``ValueError``. With ``errors`` the names of fields that do not parse stand in
    a column of that name; a record with one of the scorer's own among them has NULL
    outputs, and all others are scored. Without it such a record ends the job.
    """
    if scorer not in SCORERS:
        raise ValueError(f"Unknown agent: {scorer}")
    return record_inputs(df, errors).withColumns(_record_outputs(scorer, errors)).drop("__fraud_in")


def score_records_all(df: DataFrame, errors: str | None = None) -> DataFrame:
    """All four record-form outputs in one projection."""
    out: dict[str, Column] = {}
    for name in ("triage", "fraud", "settlement", "routing"):
        out.update(_record_outputs(name, errors))
    return record_inputs(df, errors).withColumns(out).drop("__fraud_in")


def band_counts(scored: DataFrame) -> DataFrame:
    """(scorer, band, claims) for priority, fraud and channel bands.

    One pass: each row is stacked into three (scorer, band) rows and counted
    by one partially-aggregated groupBy.
    """
    stacked = scored.selectExpr(
        "stack(3, 'triage', priority_band, 'fraud', fraud_risk_band, 'routing', channel)"
        " AS (scorer, band)")
    return stacked.groupBy("scorer", "band").agg(F.count(F.lit(1)).alias("claims"))
