"""Synthetic policies / customers / claims, generated in parallel.

Every value is a pure function of (row id, column, seed): a uniform draw
``u = first 52 bits of md5("<id>:<seed>:<column>") / 2^52`` turned into a
categorical pick, a number or a date. Rows are produced over any DataFrame of
ids (``spark.range(n)`` or the key column of an existing table), so the
output does not depend on partitioning, retried tasks regenerate the same
rows, and no list of rows is ever built on the driver.

Each generator is written once against a small builder interface that has a
Spark implementation (Columns) and a SQL implementation (DuckDB text, used as
the oracle).
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

#: 13 hexadecimal digits: as many bits as a double holds exactly.
DRAW_DIGITS, DRAWS = 13, float(2 ** 52)


class SparkGen:
    """Builds Spark Columns in stages: the draws, then what is picked by them and used again
    (``keep``), then the table's columns. A later stage names the earlier one's columns several
    times, which keeps Catalyst from folding the stages into one, so a draw is a hash once a row."""

    def __init__(self, id_col: str, seed: int):
        self.id, self.seed = F.col(id_col), seed
        self.stages: list[dict[str, Column]] = [{}]

    def u(self, salt: str) -> Column:
        h = F.md5(F.concat(self.id.cast("string"), F.lit(f":{self.seed}:{salt}")))
        return self._put(0, f"u_{salt}", F.conv(F.substring(h, 1, DRAW_DIGITS), 16, 10).cast("long") / F.lit(DRAWS))

    def keep(self, name: str, expr: Column, stage: int = 1) -> Column:
        return self._put(stage, f"p_{name}", expr)

    def _put(self, stage: int, name: str, expr: Column) -> Column:
        self.stages += [{} for _ in range(stage + 1 - len(self.stages))]
        self.stages[stage][name] = expr
        return F.col(name)

    def lit(self, v):
        return F.lit(v)

    def weighted(self, u, values, weights):
        total, cum = sum(weights), list(accumulate(weights))
        x = u * F.lit(float(total))
        expr = None
        for v, c in zip(values[:-1], cum[:-1]):
            expr = F.when(x < c, F.lit(v)) if expr is None else expr.when(x < c, F.lit(v))
        return expr.otherwise(F.lit(values[-1])) if expr is not None else F.lit(values[-1])

    def choice(self, u, values):
        return F.element_at(F.array(*[F.lit(v) for v in values]),
                            (F.floor(u * F.lit(float(len(values)))) + 1).cast("int"))

    def int_(self, u, lo: int, hi: int):
        return self.key(u, lo, hi).cast("int")

    def key(self, u, lo: int, hi: int):
        """A number from lo to hi, of any size: ids of tables of any length."""
        return (F.lit(lo) + F.floor(u * F.lit(float(hi - lo + 1)))).cast("long")

    def uniform(self, u, lo: float, hi: float):
        return F.lit(float(lo)) + u * F.lit(float(hi - lo))

    def round2(self, x):
        return F.floor(x * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)

    def mul(self, a, b):
        return a * b

    def add(self, a, b):
        return a + b

    def date(self, u, start: str, end: str):
        from datetime import date
        days = (date.fromisoformat(end) - date.fromisoformat(start)).days
        return F.date_add(F.lit(start).cast("date"), F.floor(u * F.lit(float(days + 1))).cast("int"))

    def date_plus(self, d, n):
        return F.date_add(d, n)

    def date_str(self, d):
        return d.cast("string")

    def pad(self, prefix: str, n, width: int):
        return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", n.cast("long")))

    def row_id(self):
        return self.id

    def concat(self, *parts):
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])

    def when(self, cond_pairs, otherwise):
        expr = None
        for c, v in cond_pairs:
            expr = F.when(c, v) if expr is None else expr.when(c, v)
        return expr.otherwise(otherwise)

    def lt(self, a, b):
        return a < b

    def eq(self, a, b):
        return a == b

    def isin(self, a, values):
        return a.isin(*values)

    def cast(self, x, t):
        return x.cast({"int": "int", "double": "double", "string": "string"}[t])

    def choice_at(self, values, idx):
        return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


class SqlGen:
    """Builds DuckDB SQL text (the oracle)."""

    def __init__(self, id_col: str, seed: int):
        self.id, self.seed = id_col, seed

    def u(self, salt: str) -> str:
        h = f"md5(CAST({self.id} AS VARCHAR) || ':{self.seed}:{salt}')"
        return f"(CAST('0x' || substr({h}, 1, {DRAW_DIGITS}) AS BIGINT) / CAST({DRAWS!r} AS DOUBLE))"

    def keep(self, name: str, expr: str, stage: int = 1) -> str:
        return expr

    def lit(self, v):
        return _sql_lit(v)

    def weighted(self, u, values, weights):
        total, cum = sum(weights), list(accumulate(weights))
        x = f"({u} * CAST({float(total)!r} AS DOUBLE))"
        whens = " ".join(f"WHEN {x} < {c} THEN {_sql_lit(v)}"
                         for v, c in zip(values[:-1], cum[:-1]))
        return f"(CASE {whens} ELSE {_sql_lit(values[-1])} END)" if whens else _sql_lit(values[-1])

    def choice(self, u, values):
        arr = "[" + ", ".join(_sql_lit(v) for v in values) + "]"
        return f"({arr}[CAST(floor({u} * {float(len(values))!r}) AS INTEGER) + 1])"

    def int_(self, u, lo, hi):
        return f"CAST({self.key(u, lo, hi)} AS INTEGER)"

    def key(self, u, lo, hi):
        width = f"(({hi}) - {lo} + 1)" if isinstance(hi, str) else repr(float(hi - lo + 1))
        return f"CAST({lo} + floor({u} * CAST({width} AS DOUBLE)) AS BIGINT)"

    def choice_at(self, values, idx):
        return "([" + ", ".join(_sql_lit(v) for v in values) + f"][{idx}])"

    def uniform(self, u, lo, hi):
        return f"(CAST({float(lo)!r} AS DOUBLE) + {u} * CAST({float(hi - lo)!r} AS DOUBLE))"

    def round2(self, x):
        return f"(floor({x} * CAST(100.0 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(100.0 AS DOUBLE))"

    def mul(self, a, b):
        return f"({a} * {b})"

    def add(self, a, b):
        return f"({a} + {b})"

    def date(self, u, start, end):
        from datetime import date
        days = (date.fromisoformat(end) - date.fromisoformat(start)).days
        return (f"(DATE '{start}' + CAST(floor({u} * CAST({float(days + 1)!r} AS DOUBLE))"
                " AS INTEGER))")

    def date_plus(self, d, n):
        return f"({d} + CAST({n} AS INTEGER))"

    def date_str(self, d):
        return f"CAST({d} AS VARCHAR)"

    def pad(self, prefix, n, width):
        return f"('{prefix}' || printf('%0{width}d', CAST({n} AS BIGINT)))"

    def row_id(self):
        return self.id

    def concat(self, *parts):
        return "(" + " || ".join(f"CAST({p} AS VARCHAR)" if not _is_plain(p) else _sql_lit(p)
                                 for p in parts) + ")"

    def when(self, cond_pairs, otherwise):
        whens = " ".join(f"WHEN {c} THEN {v}" for c, v in cond_pairs)
        return f"(CASE {whens} ELSE {otherwise} END)"

    def lt(self, a, b):
        return f"({a} < {b})"

    def eq(self, a, b):
        return f"({a} = {b})"

    def isin(self, a, values):
        return f"({a} IN ({', '.join(_sql_lit(v) for v in values)}))"

    def cast(self, x, t):
        return f"CAST({x} AS {dict(int='INTEGER', double='DOUBLE', string='VARCHAR')[t]})"


class _Plain(str):
    """A literal text fragment in ``SqlGen.concat``."""


def _is_plain(p) -> bool:
    return isinstance(p, _Plain)


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


def _txt(g, s: str):
    return F.lit(s) if isinstance(g, SparkGen) else _Plain(s)


# ---- table definitions (written once, rendered by either builder) -------------------

def policy_columns(g, n_customers: int) -> list[tuple[str, object]]:
    u = g.u
    coverage = g.keep("coverage", g.weighted(u("coverage"), S.COVERAGE_AMOUNTS, S.COVERAGE_WEIGHTS))
    premium = g.round2(g.add(g.mul(coverage, g.uniform(u("premium_rate"), *S.RANGES["premium_rate"])),
                             g.uniform(u("premium_shift"), *S.RANGES["premium_shift"])))
    return [
        ("policy_id", g.pad("POL_", g.row_id(), 6)),
        ("customer_id", g.pad("CUST_", g.key(u("customer"), 1, n_customers), 6)),
        ("policy_type", g.weighted(u("policy_type"), S.POLICY_TYPES, S.POLICY_TYPE_WEIGHTS)),
        ("coverage_amount", g.cast(coverage, "int")),
        ("premium_amount", g.cast(premium, "double")),
        ("deductible", g.cast(g.choice(u("deductible"), S.DEDUCTIBLES), "int")),
        ("policy_start_date", g.date_str(g.date(u("start"), *S.RANGES["start"]))),
        ("policy_end_date", g.date_str(g.date(u("end"), *S.RANGES["end"]))),
        ("renewal_date", g.date_str(g.date(u("renewal"), *S.RANGES["renewal"]))),
        ("region", g.weighted(u("region"), S.REGIONS, S.REGION_WEIGHTS)),
        ("zip_code", g.cast(g.int_(u("zip"), *S.RANGES["zip"]), "string")),
        ("property_type", g.choice(u("property_type"), S.PROPERTY_TYPES)),
        ("construction_year", g.int_(u("construction_year"), *S.RANGES["construction_year"])),
        ("square_footage", g.int_(u("square_footage"), *S.RANGES["square_footage"])),
        ("policy_status", g.weighted(u("policy_status"), S.POLICY_STATUSES,
                                     S.POLICY_STATUS_WEIGHTS)),
        ("agent_id", g.concat(_txt(g, "AGENT_"), g.pad("", g.int_(u("agent"), *S.RANGES["agent"]), 3))),
        ("underwriter_id", g.concat(_txt(g, "UW_"), g.pad("", g.int_(u("underwriter"), *S.RANGES["underwriter"]), 3))),
        ("risk_score", g.cast(g.round2(g.uniform(u("risk"), *S.RANGES["risk"])), "double")),
        ("discount_percentage", g.cast(g.round2(g.uniform(u("discount"), *S.RANGES["discount"])), "double")),
        ("payment_frequency", g.choice(u("payment_frequency"), S.PAYMENT_FREQUENCIES)),
        ("created_date", g.date_str(g.date(u("created"), *S.RANGES["created"]))),
        ("last_updated", g.date_str(g.date(u("updated"), *S.RANGES["updated"]))),
    ]


def customer_columns(g) -> list[tuple[str, object]]:
    u = g.u
    phone = g.concat(g.int_(u("phone_a"), *S.RANGES["phone_a"]), _txt(g, "-"), g.int_(u("phone_b"), *S.RANGES["phone_b"]),
                     _txt(g, "-"), g.int_(u("phone_c"), *S.RANGES["phone_c"]))
    address = g.concat(g.int_(u("house"), *S.RANGES["house"]), _txt(g, " "), g.choice(u("street"), S.STREETS),
                       _txt(g, " St"))
    return [
        ("customer_id", g.pad("CUST_", g.row_id(), 6)),
        ("first_name", g.choice(u("first_name"), S.FIRST_NAMES)),
        ("last_name", g.choice(u("last_name"), S.LAST_NAMES)),
        ("email", g.concat(_txt(g, "customer"), g.row_id(), _txt(g, "@email.com"))),
        ("phone", phone),
        ("date_of_birth", g.date_str(g.date(u("dob"), *S.RANGES["dob"]))),
        ("age_group", g.weighted(u("age_group"), S.AGE_GROUPS, S.AGE_WEIGHTS)),
        ("gender", g.choice(u("gender"), S.GENDERS)),
        ("marital_status", g.weighted(u("marital"), S.MARITAL_STATUSES, S.MARITAL_WEIGHTS)),
        ("employment_status", g.weighted(u("employment"), S.EMPLOYMENT_STATUSES,
                                         S.EMPLOYMENT_WEIGHTS)),
        ("income_range", g.weighted(u("income"), S.INCOME_RANGES, S.INCOME_WEIGHTS)),
        ("credit_score_range", g.weighted(u("credit"), S.CREDIT_RANGES, S.CREDIT_WEIGHTS)),
        ("address_line1", address),
        ("city", g.choice(u("city"), S.CITIES)),
        ("state", g.choice(u("state"), S.CUSTOMER_STATES)),
        ("zip_code", g.cast(g.int_(u("zip"), *S.RANGES["zip"]), "string")),
        ("country", g.lit("USA")),
        ("occupation", g.choice(u("occupation"), S.OCCUPATIONS)),
        ("years_at_address", g.int_(u("years_at_address"), *S.RANGES["years_at_address"])),
        ("previous_claims_count", g.cast(g.weighted(u("previous_claims"), S.PREVIOUS_CLAIMS,
                                                    S.PREVIOUS_CLAIMS_WEIGHTS), "int")),
        ("customer_since", g.date_str(g.date(u("since"), *S.RANGES["since"]))),
        ("last_contact_date", g.date_str(g.date(u("contact"), *S.RANGES["contact"]))),
    ]


# Claim dates: incident first, then the claim is filed 0-60 days later and the
# report 0-30 days after filing, so incident <= claim <= report always holds.
CLAIM_LAG_DAYS, REPORT_LAG_DAYS = 60, 30


def claim_columns(g, n_policies: int, n_customers: int) -> list[tuple[str, object]]:
    u = g.u
    ctype = g.keep("claim_type", g.weighted(u("claim_type"), S.CLAIM_TYPES, S.CLAIM_TYPE_WEIGHTS))
    status = g.keep("claim_status", g.weighted(u("claim_status"), S.CLAIM_STATUSES, S.CLAIM_STATUS_WEIGHTS))
    severity = g.keep("severity", g.weighted(u("severity"), S.SEVERITY_LEVELS, S.SEVERITY_WEIGHTS))
    band = g.keep("amount_band", g.weighted(u("amount_band"), list(range(len(S.CLAIM_AMOUNT_RANGES))),
                                            S.CLAIM_AMOUNT_WEIGHTS))
    ua = u("amount")
    base = g.when([(g.eq(band, i), g.uniform(ua, lo, hi))
                   for i, (lo, hi) in enumerate(S.CLAIM_AMOUNT_RANGES[:-1])],
                  g.uniform(ua, *S.CLAIM_AMOUNT_RANGES[-1]))
    factor = g.when([(g.eq(severity, g.lit(k)), g.lit(float(v)))
                     for k, v in list(S.SEVERITY_AMOUNT_FACTOR.items())[:-1]],
                    g.lit(float(list(S.SEVERITY_AMOUNT_FACTOR.values())[-1])))
    amount = g.keep("amount", g.round2(g.mul(base, factor)), stage=2)
    settlement = g.when([(g.isin(status, ["Approved", "Closed"]),
                          g.round2(g.mul(amount, g.uniform(u("settle"), *S.RANGES["settle"]))))],
                        g.lit(0.0))
    pick = g.keep("comment", g.int_(u("comment"), *S.RANGES["comment"]))
    comment = g.when([(g.eq(ctype, g.lit(t)), g.choice_at(S.CLAIM_COMMENTS[t], pick))
                      for t in S.CLAIM_TYPES[:-1]],
                     g.choice_at(S.CLAIM_COMMENTS[S.CLAIM_TYPES[-1]], pick))
    incident = g.keep("incident", g.date(u("incident"), *S.RANGES["incident"]))
    claim_d = g.keep("claim_date", g.date_plus(incident, g.int_(u("claim_lag"), 0, CLAIM_LAG_DAYS)), stage=2)
    report_d = g.date_plus(claim_d, g.int_(u("report_lag"), 0, REPORT_LAG_DAYS))
    police = g.when([(g.lt(u("police"), g.lit(0.3)),
                      g.concat(_txt(g, "PR"), g.int_(u("police_no"), *S.RANGES["police_no"])))],
                    g.lit(None))
    return [
        ("claim_id", g.pad("CLM_", g.row_id(), 6)),
        ("policy_id", g.pad("POL_", g.key(u("policy"), 1, n_policies), 6)),
        ("customer_id", g.pad("CUST_", g.key(u("customer"), 1, n_customers), 6)),
        ("claim_type", ctype),
        ("claim_status", status),
        ("claim_date", g.date_str(claim_d)),
        ("incident_date", g.date_str(incident)),
        ("report_date", g.date_str(report_d)),
        ("claim_amount", g.cast(amount, "double")),
        ("settlement_amount", g.cast(settlement, "double")),
        ("deductible_applied", g.cast(g.choice(u("deductible"), S.DEDUCTIBLES), "int")),
        ("severity_level", severity),
        ("adjuster_id", g.concat(_txt(g, "ADJ_"), g.pad("", g.int_(u("adjuster"), *S.RANGES["adjuster"]), 3))),
        ("investigator_id", g.concat(_txt(g, "INV_"),
                                     g.pad("", g.int_(u("investigator"), *S.RANGES["investigator"]), 3))),
        ("police_report_number", g.cast(police, "string")),
        ("witness_count", g.int_(u("witness"), *S.RANGES["witness"])),
        ("photos_taken", g.int_(u("photos"), *S.RANGES["photos"])),
        ("repair_estimate", g.cast(g.round2(g.mul(amount, g.uniform(u("repair"), *S.RANGES["repair"]))),
                                   "double")),
        ("fraud_score", g.cast(g.round2(g.uniform(u("fraud"), *S.RANGES["fraud"])), "double")),
        ("comments", comment),
        ("created_date", g.date_str(g.date(u("created"), *S.RANGES["created"]))),
        ("last_updated", g.date_str(g.date(u("updated"), *S.RANGES["updated"]))),
    ]


# ---- Spark entry points ------------------------------------------------------------------

ROWS_PER_PARTITION = 1_000_000


def _ids(spark: SparkSession, ids, id_col: str) -> DataFrame:
    """Row ids 1..n spread over enough partitions for n (about 1M rows each)."""
    if isinstance(ids, int):
        parts = max(spark.sparkContext.defaultParallelism, -(-ids // ROWS_PER_PARTITION))
        return spark.range(1, ids + 1, numPartitions=parts).withColumnRenamed("id", id_col)
    return ids


def _build(ids: DataFrame, id_col: str, seed: int, columns) -> DataFrame:
    g = SparkGen(id_col, seed)
    cols = columns(g)
    df = ids.select(id_col)
    for stage in g.stages:
        df = df.select("*", *[c.alias(n) for n, c in stage.items()])
    return df.select(*[c.alias(n) for n, c in cols])


def generate_policies(spark: SparkSession, ids=10000, n_customers: int = 8000,
                      seed: int = 42, id_col: str = "id") -> DataFrame:
    """Policies over ``ids`` (a count, or a DataFrame with column ``id_col``)."""
    return _build(_ids(spark, ids, id_col), id_col, seed, lambda g: policy_columns(g, n_customers))


def generate_customers(spark: SparkSession, ids=8000, seed: int = 42,
                       id_col: str = "id") -> DataFrame:
    return _build(_ids(spark, ids, id_col), id_col, seed, customer_columns)


def generate_claims(spark: SparkSession, ids=5000, n_policies: int = 10000,
                    n_customers: int = 8000, seed: int = 42, id_col: str = "id") -> DataFrame:
    return _build(_ids(spark, ids, id_col), id_col, seed, lambda g: claim_columns(g, n_policies, n_customers))


def generated_sql(table: str, source: str, id_expr: str, seed: int = 42, **n) -> str:
    """The oracle text for one generated table over ``SELECT id_expr AS id FROM source``."""
    g = SqlGen("id", seed)
    cols = {"policies": lambda: policy_columns(g, n["n_customers"]),
            "customers": lambda: customer_columns(g),
            "claims": lambda: claim_columns(g, n["n_policies"], n["n_customers"])}[table]()
    sel = ",\n  ".join(f"{e} AS {name}" for name, e in cols)
    return f"SELECT\n  {sel}\nFROM (SELECT {id_expr} AS id FROM {source})"
