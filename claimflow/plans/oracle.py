"""The same datasets written as plain SQL for DuckDB (the correctness oracle).

Each dataset is a CTE; ``query(body, *ctes)`` prepends every CTE the body
needs, in dependency order. The test tables are DuckDB views, so the oracle
derives the raw insurance tables by the expressions of ``sources.fixtures`` and
then recomputes every step in SQL. It shares with the library the expressions
of the raw tables, the texts of the rules, the list of cleaned columns, the
value domains and the generator's column list; what is written a second time
here are dimensions, fact, joins, scorers and aggregates. Literal counts in
``tests`` guard the shared parts.
"""

from __future__ import annotations

from ..operators.clean import CLEAN_SPEC
from ..operators.expectations import (CLAIM_RULES, CUSTOMER_RULES, DIM_CUSTOMER_RULES,
                                      DIM_POLICY_RULES, FACT_CLAIM_RULES, POLICY_RULES,
                                      all_pass_sql, drop_rules)
from ..schemas import (CANONICAL_DOMAINS, CLAIM_COLUMNS, CUSTOMER_COLUMNS, DATA_SOURCE,
                       POLICY_COLUMNS)
from ..sources import fixtures

RULES = {"policies": POLICY_RULES, "customers": CUSTOMER_RULES, "claims": CLAIM_RULES}
COLUMNS = {"policies": POLICY_COLUMNS, "customers": CUSTOMER_COLUMNS, "claims": CLAIM_COLUMNS}


# ---- scalar SQL helpers ---------------------------------------------------------------

def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def canonical(x: str, domain: list[str]) -> str:
    whens = " ".join(f"WHEN '{v.lower()}' THEN '{v}'" for v in domain)
    return f"CASE lower({x}) {whens} ELSE {initcap(x)} END"


def to_date(x: str) -> str:
    return f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"


def rnd(x: str, digits: int = 6) -> str:
    s = float(10 ** digits)
    return f"(floor(({x}) * {s!r} + 0.5) / {s!r})"


def cents(x: str) -> str:
    return f"(floor(({x}) * CAST(100.0 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(100.0 AS DOUBLE))"


def ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / nullif({den}, 0))"


def md5_bucket(x: str, n: int) -> str:
    return f"((CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT) % {n}) + 1)"


def passed(rule) -> str:
    return f"coalesce(({rule.sql('duckdb')}), false)"


# ---- CTE catalogue --------------------------------------------------------------------

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


cte("raw_policies", fixtures.raw_policies_sql())
cte("raw_customers", fixtures.raw_customers_sql())
cte("raw_claims", fixtures.raw_claims_sql())


def _clean_sql(table: str) -> str:
    spec = CLEAN_SPEC[table]
    out = []
    for name, _ in COLUMNS[table]:
        if name in spec.get("upper", ()):
            e = f"upper({name})"
        elif name in spec.get("title", ()):
            dom = CANONICAL_DOMAINS.get(name)
            e = canonical(name, dom) if dom else initcap(name)
        elif name in spec.get("lower", ()):
            e = f"lower({name})"
        elif name in spec.get("dates", ()):
            e = to_date(name)
        elif name in spec.get("trim", ()):
            e = f"trim({name})"
        else:
            e = name
        out.append(f"{e} AS {name}")
    out.append(f"'{DATA_SOURCE}' AS data_source")
    return "SELECT " + ",\n  ".join(out) + f"\nFROM raw_{table}"


for _t in ("policies", "customers", "claims"):
    cte(f"clean_{_t}", _clean_sql(_t), f"raw_{_t}")
    cte(f"valid_{_t}", f"SELECT * FROM clean_{_t} WHERE {all_pass_sql(RULES[_t], 'duckdb')}",
        f"clean_{_t}")

# dimensions: project, dedupe (latest first, then every column descending), rules
DIM_CUSTOMER_SELECT = f"""SELECT upper(customer_id) AS customer_id, {initcap('first_name')} AS first_name,
  {initcap('last_name')} AS last_name, lower(email) AS email,
  regexp_replace(phone, '[^0-9]', '', 'g') AS phone_e164_like, date_of_birth, age_group,
  {initcap('city')} AS city, upper(state) AS state, zip_code AS postal_code,
  upper(country) AS country, {initcap('occupation')} AS occupation,
  previous_claims_count AS lifetime_claims_count, customer_since, last_contact_date,
  CASE WHEN customer_id IS NOT NULL THEN sha256(upper(customer_id)) END AS customer_sk
FROM valid_customers"""
DIM_CUSTOMER_COLS = ["customer_id", "first_name", "last_name", "email", "phone_e164_like",
                     "date_of_birth", "age_group", "city", "state", "postal_code", "country",
                     "occupation", "lifetime_claims_count", "customer_since", "last_contact_date",
                     "customer_sk"]
cte("dimc_pre", DIM_CUSTOMER_SELECT, "valid_customers")


def dedupe_sql(src: str, key: str, cols: list[str], first: list[str]) -> str:
    order = first + [c for c in cols if c != key and c not in first]
    ob = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {ob}) AS __rn FROM {src}) WHERE __rn = 1")


cte("dimc_dedup", dedupe_sql("dimc_pre", "customer_id", DIM_CUSTOMER_COLS,
                              ["last_contact_date"]), "dimc_pre")
cte("dim_customer", f"SELECT * FROM dimc_dedup WHERE {all_pass_sql(DIM_CUSTOMER_RULES, 'duckdb')}",
    "dimc_dedup")

DIM_POLICY_SELECT = f"""SELECT upper(policy_id) AS policy_id, upper(customer_id) AS customer_id,
  {canonical('policy_type', CANONICAL_DOMAINS['policy_type'])} AS policy_type,
  coverage_amount, premium_amount, deductible,
  {canonical('property_type', CANONICAL_DOMAINS['property_type'])} AS property_type,
  construction_year, square_footage,
  {canonical('policy_status', CANONICAL_DOMAINS['policy_status'])} AS policy_status,
  upper(region) AS region, zip_code AS postal_code, policy_start_date, policy_end_date,
  {ratio('premium_amount', 'coverage_amount')} AS premium_coverage_ratio,
  CASE WHEN policy_id IS NOT NULL THEN sha256(upper(policy_id)) END AS policy_sk,
  last_updated, created_date
FROM valid_policies"""
DIM_POLICY_COLS = ["policy_id", "customer_id", "policy_type", "coverage_amount", "premium_amount",
                   "deductible", "property_type", "construction_year", "square_footage",
                   "policy_status", "region", "postal_code", "policy_start_date",
                   "policy_end_date", "premium_coverage_ratio", "policy_sk"]
cte("dimp_pre", DIM_POLICY_SELECT, "valid_policies")
cte("dimp_dedup", dedupe_sql("dimp_pre", "policy_id", DIM_POLICY_COLS, ["last_updated", "created_date"]),
    "dimp_pre")
cte("dim_policy", f"SELECT * FROM dimp_dedup WHERE {all_pass_sql(DIM_POLICY_RULES, 'duckdb')}",
    "dimp_dedup")

FACT_SELECT = f"""SELECT upper(c.claim_id) AS claim_id, p.policy_sk, d.customer_sk,
  c.policy_id, c.customer_id,
  {canonical('c.claim_type', CANONICAL_DOMAINS['claim_type'])} AS claim_type,
  {canonical('c.claim_status', CANONICAL_DOMAINS['claim_status'])} AS claim_status,
  {canonical('c.severity_level', CANONICAL_DOMAINS['severity_level'])} AS severity_level,
  c.claim_date, c.incident_date, c.report_date, c.claim_amount, c.settlement_amount,
  c.deductible_applied, c.settlement_amount - c.deductible_applied AS net_settlement_amount,
  {ratio('c.settlement_amount', 'c.claim_amount')} AS settlement_ratio,
  c.fraud_score, c.witness_count, c.photos_taken, c.repair_estimate,
  CAST(length(c.comments) AS INTEGER) AS comment_length, c.comments AS claim_comment
FROM valid_claims c
LEFT JOIN dim_policy p ON c.policy_id = p.policy_id
LEFT JOIN dim_customer d ON c.customer_id = d.customer_id"""
cte("fact_pre", FACT_SELECT, "valid_claims", "dim_policy", "dim_customer")
cte("fact_claim", f"SELECT * FROM fact_pre WHERE {all_pass_sql(FACT_CLAIM_RULES, 'duckdb')}",
    "fact_pre")

cte("scoring_base", """SELECT f.*, p.policy_status, p.premium_coverage_ratio,
  d.lifetime_claims_count, d.state
FROM fact_claim f
LEFT JOIN (SELECT policy_id, policy_status, premium_coverage_ratio FROM dim_policy) p
  ON f.policy_id = p.policy_id
LEFT JOIN (SELECT customer_id, lifetime_claims_count, state FROM dim_customer) d
  ON f.customer_id = d.customer_id""", "fact_claim", "dim_policy", "dim_customer")

D = "CAST({} AS DOUBLE)".format

PRIORITY_SCORE = ("claim_amount / 1000"
                  " + CASE severity_level WHEN 'Critical' THEN 30 WHEN 'High' THEN 20"
                  " WHEN 'Medium' THEN 10 ELSE 5 END"
                  " + CASE WHEN claim_status IN ('Open', 'In Progress') THEN 5 ELSE 0 END")
PRIORITY_SCORE_TABLE = (PRIORITY_SCORE + " + CASE WHEN date_diff('day', incident_date, claim_date)"
                        " > 30 THEN -5 ELSE 0 END")


def band_priority(s: str) -> str:
    return (f"CASE WHEN {s} >= 60 THEN 'P1' WHEN {s} >= 40 THEN 'P2' WHEN {s} >= 20 THEN 'P3'"
            " ELSE 'P4' END")


def fraud_score_sql(days_to_report: str) -> str:
    return ("CASE WHEN lifetime_claims_count >= 3 THEN 10 ELSE 0 END"
            " + CASE WHEN claim_amount >= 50000 THEN 15 ELSE 0 END"
            " + CASE WHEN witness_count = 0 AND photos_taken < 3 THEN 10 ELSE 0 END"
            f" + CASE WHEN {days_to_report} > 14 THEN 8 ELSE 0 END"
            " + CASE WHEN premium_coverage_ratio < 0.005 THEN 5 ELSE 0 END"
            " + CASE WHEN state IN ('FL', 'LA', 'TX') THEN 5 ELSE 0 END")


def band_fraud(s: str) -> str:
    return f"CASE WHEN {s} >= 35 THEN 'High' WHEN {s} >= 20 THEN 'Medium' ELSE 'Low' END"


def reserve_sql(fraud: str) -> str:
    mult = (f"CASE severity_level WHEN 'Critical' THEN {D(0.9)} WHEN 'High' THEN {D(0.7)}"
            f" WHEN 'Medium' THEN {D(0.5)} ELSE {D(0.3)} END")
    adj = (f"CASE WHEN {fraud} >= 70 THEN {D(-0.1)} WHEN {fraud} >= 40 THEN {D(-0.05)}"
           f" ELSE {D(0.0)} END")
    return f"(claim_amount * {mult}) * ({D(1.0)} + {adj})"


CHANNEL = ("CASE WHEN claim_amount < 2000 THEN 'Straight-Through Processing'"
           " WHEN severity_level IN ('Low', 'Medium') THEN 'Adjuster' ELSE 'Senior Adjuster' END")
ACTION = ("CASE WHEN claim_amount < 2000 THEN 'Auto-approve if checks pass'"
          " WHEN severity_level = 'Critical' THEN 'Escalate to senior adjuster'"
          " WHEN severity_level = 'High' THEN 'Expedite investigation'"
          " ELSE 'Standard processing' END")
ADJUSTER = ("CASE WHEN claim_amount < 2000 THEN 'AUTO'"
            " WHEN severity_level IN ('Low', 'Medium') THEN 'ADJ_' || "
            f"lpad(CAST({md5_bucket('claim_id', 50)} AS VARCHAR), 3, '0')"
            f" ELSE 'SADJ_' || lpad(CAST({md5_bucket('claim_id', 20)} AS VARCHAR), 3, '0') END")

cte("scores", f"""SELECT claim_id, policy_id, customer_id, claim_type, claim_status, severity_level,
  claim_date, incident_date, claim_amount,
  {PRIORITY_SCORE_TABLE} AS priority_score,
  {band_priority(f'({PRIORITY_SCORE_TABLE})')} AS priority_band,
  {fraud_score_sql("date_diff('day', incident_date, report_date)")} AS fraud_risk_score,
  {band_fraud('(' + fraud_score_sql("date_diff('day', incident_date, report_date)") + ')')} AS fraud_risk_band,
  {reserve_sql('fraud_score')} AS reserve_amount,
  ({reserve_sql('fraud_score')}) * {D(0.85)} AS suggested_settlement,
  {CHANNEL} AS channel, {ADJUSTER} AS assigned_adjuster, {ACTION} AS recommended_action
FROM scoring_base""", "scoring_base")

# records for the record-form scorers, defaults applied
cte("scoring_records", """SELECT claim_id, policy_id, customer_id, severity_level, claim_status,
  state, claim_amount, premium_coverage_ratio, fraud_score, witness_count, photos_taken,
  CAST(date_diff('day', incident_date, report_date) AS INTEGER) AS days_to_report,
  lifetime_claims_count
FROM scoring_base""", "scoring_base")


def _nn(x: str) -> str:
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"


cte("records_norm", f"""SELECT claim_id, policy_id, customer_id, fraud_score,
  coalesce({_nn('claim_amount')}, {D(0.0)}) AS claim_amount,
  coalesce(severity_level, 'Low') AS severity_level,
  coalesce(claim_status, 'Open') AS claim_status,
  coalesce(lifetime_claims_count, 0) AS lifetime_claims_count,
  coalesce(witness_count, 0) AS witness_count,
  coalesce(photos_taken, 0) AS photos_taken,
  coalesce(days_to_report, 0) AS days_to_report,
  coalesce({_nn('premium_coverage_ratio')}, {D(0.0)}) AS premium_coverage_ratio,
  coalesce(state, '') AS state,
  coalesce({_nn('fraud_score')}, {D(0.0)}) AS __fraud_in
FROM scoring_records""", "scoring_records")


def query(body: str, *names: str) -> str:
    """``WITH`` every CTE ``names`` need (transitively, dependencies first)."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    withs = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {withs}\n{body}"


def rule_metrics_sql(dataset: str, src: str, rules) -> str:
    parts = []
    for r in rules:
        parts.append(
            f"SELECT '{dataset}' AS dataset, '{r.name}' AS rule, '{r.action}' AS action, "
            f"CAST(sum(CASE WHEN {passed(r)} THEN 1 ELSE 0 END) AS BIGINT) AS passed, "
            f"CAST(count(*) - sum(CASE WHEN {passed(r)} THEN 1 ELSE 0 END) AS BIGINT) AS failed "
            f"FROM {src}")
    return "\nUNION ALL\n".join(parts)


def failed_rules_sql(rules) -> tuple[str, str]:
    """(WHERE condition for failing rows, failed_rules list text)."""
    rs = drop_rules(rules)
    cond = " OR ".join(f"NOT {passed(r)}" for r in rs)
    names = ", ".join(f"CASE WHEN NOT {passed(r)} THEN '{r.name}' END" for r in rs)
    return cond, f"concat_ws(',', {names})"
