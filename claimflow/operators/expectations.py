"""Named data-quality expectations: warn, drop, per-rule counts, failed rows.

A rule is a name plus a SQL boolean text evaluated by Catalyst (``F.expr``),
so drop rules become ordinary filters that Parquet pushdown and partition
pruning can use. A rule that is NULL on a row counts as failed: a plain filter
already drops NULL, and everywhere a rule is negated or counted it is wrapped
in ``coalesce(rule, false)``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DROP, WARN = "drop", "warn"
# declaration forms, kept to report rule counts per form
ALL_OR_DROP, OR_DROP, EXPECT = "expect_all_or_drop", "expect_or_drop", "expect"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str          # Spark SQL boolean text
    action: str = DROP      # DROP or WARN
    form: str = ALL_OR_DROP
    duckdb: str | None = None  # same rule as DuckDB text, when the text differs

    @property
    def column(self) -> Column:
        return F.expr(self.predicate)

    def passed(self) -> Column:
        """True only where the rule holds (NULL -> False)."""
        return F.coalesce(self.column, F.lit(False))

    def sql(self, dialect: str = "spark") -> str:
        return self.duckdb if (dialect == "duckdb" and self.duckdb) else self.predicate


def _all(form: str, rules: dict[str, str]) -> list[Rule]:
    return [Rule(n, p, DROP, form) for n, p in rules.items()]


# ---- fixed values: the rule catalogue (names and predicate texts) ------------
# Two intentional corrections to the source text: a literal '+' in the two
# format patterns is written as [+], and divisions use nullif(den, 0) so a zero
# denominator yields NULL (a failed rule) instead of an ANSI error.
POLICY_RULES: list[Rule] = _all(ALL_OR_DROP, {
    "valid_policy_id": "policy_id IS NOT NULL AND policy_id != ''",
    "valid_customer_id": "customer_id IS NOT NULL AND customer_id != ''",
    "valid_coverage_amount": "coverage_amount > 0 AND coverage_amount <= 10000000",
    "valid_premium_amount": "premium_amount > 0 AND premium_amount <= 100000",
    "valid_deductible": "deductible >= 0 AND deductible <= 10000",
    "valid_dates": "policy_start_date <= policy_end_date",
    "valid_risk_score": "risk_score >= 200 AND risk_score <= 850",
    "valid_discount": "discount_percentage >= 0 AND discount_percentage <= 50",
    "valid_square_footage": "square_footage > 0 AND square_footage <= 10000",
    "valid_construction_year": "construction_year >= 1900 AND construction_year <= 2024",
}) + _all(OR_DROP, {
    "reasonable_premium_coverage_ratio":
        "premium_amount / nullif(coverage_amount, 0) BETWEEN 0.001 AND 0.05",
})

AGE_GROUP_PATTERN = "^[0-9]+-[0-9]+$|^[0-9]+[+]$"
INCOME_RANGE_PATTERN = "^<[0-9]+k$|^[0-9]+k-[0-9]+k$|^[0-9]+k[+]$"

CUSTOMER_RULES: list[Rule] = _all(ALL_OR_DROP, {
    "valid_customer_id": "customer_id IS NOT NULL AND customer_id != ''",
    "valid_email": "email IS NOT NULL AND email LIKE '%@%.%'",
    "valid_phone": "phone IS NOT NULL AND LENGTH(phone) >= 10",
    "valid_first_name": "first_name IS NOT NULL AND first_name != ''",
    "valid_last_name": "last_name IS NOT NULL AND last_name != ''",
    "valid_zip_code": "zip_code IS NOT NULL AND LENGTH(zip_code) = 5",
    "valid_state": "state IS NOT NULL AND LENGTH(state) = 2",
    "valid_country": "country = 'USA'",
    "valid_years_at_address": "years_at_address >= 0 AND years_at_address <= 50",
    "valid_previous_claims": "previous_claims_count >= 0 AND previous_claims_count <= 20",
}) + [
    Rule("valid_age_group_format", f"age_group RLIKE '{AGE_GROUP_PATTERN}'", DROP, OR_DROP,
         f"regexp_matches(age_group, '{AGE_GROUP_PATTERN}')"),
    Rule("valid_income_range_format", f"income_range RLIKE '{INCOME_RANGE_PATTERN}'", DROP,
         OR_DROP, f"regexp_matches(income_range, '{INCOME_RANGE_PATTERN}')"),
]

CLAIM_RULES: list[Rule] = _all(ALL_OR_DROP, {
    "valid_claim_id": "claim_id IS NOT NULL AND claim_id != ''",
    "valid_policy_id": "policy_id IS NOT NULL AND policy_id != ''",
    "valid_customer_id": "customer_id IS NOT NULL AND customer_id != ''",
    "valid_claim_type": "claim_type IS NOT NULL AND claim_type != ''",
    "valid_claim_status": "claim_status IS NOT NULL AND claim_status != ''",
    "valid_claim_amount": "claim_amount > 0 AND claim_amount <= 10000000",
    "valid_settlement_amount": "settlement_amount >= 0 AND settlement_amount <= claim_amount",
    "valid_deductible": "deductible_applied >= 0 AND deductible_applied <= 10000",
    "valid_fraud_score": "fraud_score >= 0 AND fraud_score <= 100",
    "valid_witness_count": "witness_count >= 0 AND witness_count <= 50",
    "valid_photos_taken": "photos_taken >= 0 AND photos_taken <= 100",
    "valid_repair_estimate": "repair_estimate >= 0 AND repair_estimate <= 20000000",
    "valid_dates": "incident_date <= claim_date AND claim_date <= report_date",
}) + _all(OR_DROP, {
    "reasonable_settlement_ratio":
        "settlement_amount / nullif(claim_amount, 0) BETWEEN 0 AND 1.1",
    "valid_severity_level": "severity_level IN ('Low', 'Medium', 'High', 'Critical')",
    "valid_claim_type_values": "claim_type IN ('Water Damage', 'Theft', 'Fire', 'Wind/Hail', "
                               "'Vandalism', 'Liability', 'Personal Property', "
                               "'Additional Living Expenses')",
    "valid_claim_status_values": "claim_status IN ('Open', 'In Progress', 'Approved', 'Denied', "
                                 "'Closed', 'Under Review')",
}) + [Rule("has_comments", "comments IS NOT NULL AND comments != ''", WARN, EXPECT)]

DIM_CUSTOMER_RULES: list[Rule] = _all(ALL_OR_DROP, {
    "pk_not_null": "customer_sk IS NOT NULL",
    "customer_id_present": "customer_id IS NOT NULL AND customer_id != ''",
    "email_valid": "email LIKE '%@%.%'",
    "state_len": "LENGTH(state) = 2",
})

DIM_POLICY_RULES: list[Rule] = _all(ALL_OR_DROP, {
    "pk_not_null": "policy_sk IS NOT NULL",
    "policy_id_present": "policy_id IS NOT NULL AND policy_id != ''",
    "coverage_positive": "coverage_amount > 0",
    "premium_positive": "premium_amount > 0",
})

FACT_CLAIM_RULES: list[Rule] = _all(ALL_OR_DROP, {
    "fk_policy": "policy_id IS NOT NULL AND policy_id != ''",
    "fk_customer": "customer_id IS NOT NULL AND customer_id != ''",
    "amount_positive": "claim_amount > 0",
    "deductible_nonneg": "deductible_applied >= 0",
    "severity_valid": "severity_level IN ('Low','Medium','High','Critical')",
}) + _all(OR_DROP, {
    "settlement_ratio_valid": "settlement_amount / nullif(claim_amount, 0) BETWEEN 0 AND 1.1",
})

RULES: dict[str, list[Rule]] = {
    "policies": POLICY_RULES,
    "customers": CUSTOMER_RULES,
    "claims": CLAIM_RULES,
    "dim_customer": DIM_CUSTOMER_RULES,
    "dim_policy": DIM_POLICY_RULES,
    "fact_claim": FACT_CLAIM_RULES,
}


# ---- operators ---------------------------------------------------------------

def drop_rules(rules: list[Rule]) -> list[Rule]:
    return [r for r in rules if r.action == DROP]


def all_pass_sql(rules: list[Rule], dialect: str = "spark") -> str:
    """Conjunction of the drop rules as SQL text ('TRUE' if none)."""
    rs = drop_rules(rules)
    return " AND ".join(f"({r.sql(dialect)})" for r in rs) if rs else "TRUE"


def expect(df: DataFrame, name: str, predicate: str) -> DataFrame:
    """Keep every row; the rule is only counted (see ``expectation_metrics``)."""
    F.expr(predicate)  # fail fast on bad text at declaration time
    return df


def expect_or_drop(df: DataFrame, name: str, predicate: str) -> DataFrame:
    """Drop rows where the rule is false or NULL."""
    return df.filter(F.expr(predicate))


def expect_all_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Drop rows failing any of the rules: one conjunctive filter."""
    if not rules:
        return df
    cond = reduce(lambda a, b: a & b, [F.expr(p) for p in rules.values()])
    return df.filter(cond)


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Apply every drop rule of a set (warn rules keep the row)."""
    rs = drop_rules(rules)
    return expect_all_or_drop(df, {r.name: r.predicate for r in rs})


def all_pass(rules: list[Rule]) -> Column:
    rs = drop_rules(rules)
    if not rs:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [r.passed() for r in rs])


def expectation_metrics(df: DataFrame, rules: list[Rule], dataset: str) -> DataFrame:
    """Per-rule (dataset, rule, action, passed, failed) in one pass.

    One global aggregate with a ``count_if`` per rule (partial aggregation on
    every task, a single row shuffled per task), then ``stack`` to long form.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(r.passed()).alias(f"__p{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{r.name}', '{r.action}', __p{i}" for i, r in enumerate(rules))
    long = wide.selectExpr("__rows", f"stack({len(rules)}, {parts}) AS (rule, action, passed)")
    return long.select(
        F.lit(dataset).alias("dataset"), "rule", "action",
        F.col("passed").cast("long").alias("passed"),
        (F.col("__rows") - F.col("passed")).cast("long").alias("failed"),
    )


def failed_records(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows failing at least one drop rule, with the names of the rules failed."""
    rs = drop_rules(rules)
    names = F.array_compact(F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rs]))
    return df.filter(~all_pass(rs)).withColumn("failed_rules", names)


#: Columns that :func:`split_by_rules` adds.
STATE, FAILED_RULES = "row_state", "failed_rules"
KEPT, FAILED = "kept", "failed"


def split_by_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every row with its ``row_state`` (kept or failed) and the names of the drop rules it failed
    (NULL where kept): written partitioned by the state, one pass keeps both apart."""
    rs = drop_rules(rules)
    names = F.array_compact(F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rs])) if rs else F.array()
    good = all_pass(rs)
    return df.withColumns({FAILED_RULES: F.when(~good, names.cast("array<string>")),
                           STATE: F.when(good, KEPT).otherwise(FAILED)})


def rule_form_counts(rules: list[Rule]) -> str:
    """'10 expect_all_or_drop, 1 expect_or_drop[, 1 expect]' from a rule set."""
    out = []
    for form in (ALL_OR_DROP, OR_DROP, EXPECT):
        n = sum(1 for r in rules if r.form == form)
        if n:
            out.append(f"{n} {form}")
    return ", ".join(out)


def observe_rules(df: DataFrame, rules: list[Rule], name: str):
    """Attach per-rule pass counts to ``df`` as a named observation.

    The counts are computed by the job that consumes ``df`` (typically the
    write of the cleaned table), so they cost no extra scan. Returns
    ``(observed_df, observation)``; after the action ``observation.get`` holds
    ``{"__rows": rows in, "__kept": rows that pass every drop rule, rule name: rows
    passing that rule, ...}``.
    """
    from pyspark.sql import Observation
    obs = Observation(f"rules_{name}")
    # not count_if: it names its condition in a projection, and from such names of all rules and of their
    # conjunction the optimizer would infer a filter's every variant
    count = lambda c, n: F.count(F.when(c, F.lit(1))).alias(n)
    aggs = [F.count(F.lit(1)).alias("__rows"), count(all_pass(rules), "__kept")]
    aggs += [count(r.passed(), r.name) for r in rules]
    return df.observe(obs, *aggs), obs


class SummedCounts:
    """The observations of several writes as one."""

    def __init__(self, parts: list):
        self.parts = parts

    @property
    def get(self) -> dict:
        seen = [p.get for p in self.parts]
        return {k: sum(s[k] for s in seen) for k in seen[0]}


def observed_metrics(values: dict, rules: list[Rule], dataset: str) -> list[tuple]:
    """(dataset, rule, action, passed, failed) rows from an observation's values."""
    n = values["__rows"]
    return [(dataset, r.name, r.action, int(values[r.name]), int(n - values[r.name]))
            for r in rules]
