"""Each of the 55 rules: passing rows at the bounds, failing rows just outside, NULL fails."""

import datetime as dt

import pytest
from pyspark.sql.types import (DateType, DoubleType, IntegerType, StringType, StructField,
                               StructType)

from claimflow.operators import expectations as E

S, I, D, DT = StringType(), IntegerType(), DoubleType(), DateType()
TYPES = {
    "policy_id": S, "customer_id": S, "coverage_amount": I, "premium_amount": D,
    "deductible": I, "policy_start_date": DT, "policy_end_date": DT, "risk_score": D,
    "discount_percentage": D, "square_footage": I, "construction_year": I,
    "email": S, "phone": S, "first_name": S, "last_name": S, "zip_code": S, "state": S,
    "country": S, "years_at_address": I, "previous_claims_count": I, "age_group": S,
    "income_range": S, "claim_id": S, "claim_type": S, "claim_status": S, "claim_amount": D,
    "settlement_amount": D, "deductible_applied": I, "fraud_score": D, "witness_count": I,
    "photos_taken": I, "repair_estimate": D, "incident_date": DT, "claim_date": DT,
    "report_date": DT, "severity_level": S, "comments": S, "customer_sk": S, "policy_sk": S,
}
d1, d2, d3 = dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2023, 1, 3)


def nonempty(col):
    return [({col: "X_1"}, True), ({col: ""}, False), ({col: None}, False)]


def rng(col, lo_ok, hi_ok, lo_bad, hi_bad):
    return [({col: lo_ok}, True), ({col: hi_ok}, True), ({col: lo_bad}, False),
            ({col: hi_bad}, False), ({col: None}, False)]


CASES = {
    ("policies", "valid_policy_id"): nonempty("policy_id"),
    ("policies", "valid_customer_id"): nonempty("customer_id"),
    ("policies", "valid_coverage_amount"): rng("coverage_amount", 1, 10000000, 0, 10000001),
    ("policies", "valid_premium_amount"): rng("premium_amount", 0.01, 100000.0, 0.0, 100000.01),
    ("policies", "valid_deductible"): rng("deductible", 0, 10000, -1, 10001),
    ("policies", "valid_dates"): [
        ({"policy_start_date": d1, "policy_end_date": d1}, True),
        ({"policy_start_date": d1, "policy_end_date": d2}, True),
        ({"policy_start_date": d2, "policy_end_date": d1}, False),
        ({"policy_start_date": None, "policy_end_date": d1}, False)],
    ("policies", "valid_risk_score"): rng("risk_score", 200.0, 850.0, 199.99, 850.01),
    ("policies", "valid_discount"): rng("discount_percentage", 0.0, 50.0, -0.01, 50.01),
    ("policies", "valid_square_footage"): rng("square_footage", 1, 10000, 0, 10001),
    ("policies", "valid_construction_year"): rng("construction_year", 1900, 2024, 1899, 2025),
    ("policies", "reasonable_premium_coverage_ratio"): [
        ({"premium_amount": 100.0, "coverage_amount": 100000}, True),
        ({"premium_amount": 5000.0, "coverage_amount": 100000}, True),
        ({"premium_amount": 99.0, "coverage_amount": 100000}, False),
        ({"premium_amount": 5001.0, "coverage_amount": 100000}, False),
        ({"premium_amount": 1.0, "coverage_amount": 0}, False),   # NULL ratio, no error
        ({"premium_amount": None, "coverage_amount": 100000}, False)],
    ("customers", "valid_customer_id"): nonempty("customer_id"),
    ("customers", "valid_email"): [({"email": "a@b.co"}, True), ({"email": "a@b"}, False),
                                   ({"email": "bad-email"}, False), ({"email": None}, False)],
    ("customers", "valid_phone"): [({"phone": "123-555-0001"}, True),
                                   ({"phone": "1234567890"}, True),
                                   ({"phone": "123456789"}, False), ({"phone": None}, False)],
    ("customers", "valid_first_name"): nonempty("first_name"),
    ("customers", "valid_last_name"): nonempty("last_name"),
    ("customers", "valid_zip_code"): [({"zip_code": "12345"}, True), ({"zip_code": "1234"}, False),
                                      ({"zip_code": "123456"}, False), ({"zip_code": None}, False)],
    ("customers", "valid_state"): [({"state": "CA"}, True), ({"state": "C"}, False),
                                   ({"state": "CAL"}, False), ({"state": None}, False)],
    ("customers", "valid_country"): [({"country": "USA"}, True), ({"country": "usa"}, False),
                                     ({"country": None}, False)],
    ("customers", "valid_years_at_address"): rng("years_at_address", 0, 50, -1, 51),
    ("customers", "valid_previous_claims"): rng("previous_claims_count", 0, 20, -1, 21),
    ("customers", "valid_age_group_format"): [
        ({"age_group": "18-25"}, True), ({"age_group": "65+"}, True), ({"age_group": "65"}, False),
        ({"age_group": "65++"}, False), ({"age_group": "abc"}, False), ({"age_group": None}, False)],
    ("customers", "valid_income_range_format"): [
        ({"income_range": "<30k"}, True), ({"income_range": "30k-50k"}, True),
        ({"income_range": "250k+"}, True), ({"income_range": "250k"}, False),
        ({"income_range": "<30"}, False), ({"income_range": "30k-"}, False),
        ({"income_range": None}, False)],
    ("claims", "valid_claim_id"): nonempty("claim_id"),
    ("claims", "valid_policy_id"): nonempty("policy_id"),
    ("claims", "valid_customer_id"): nonempty("customer_id"),
    ("claims", "valid_claim_type"): nonempty("claim_type"),
    ("claims", "valid_claim_status"): nonempty("claim_status"),
    ("claims", "valid_claim_amount"): rng("claim_amount", 0.01, 10000000.0, 0.0, 10000000.01),
    ("claims", "valid_settlement_amount"): [
        ({"settlement_amount": 0.0, "claim_amount": 10.0}, True),
        ({"settlement_amount": 10.0, "claim_amount": 10.0}, True),
        ({"settlement_amount": -0.01, "claim_amount": 10.0}, False),
        ({"settlement_amount": 10.01, "claim_amount": 10.0}, False),
        ({"settlement_amount": None, "claim_amount": 10.0}, False)],
    ("claims", "valid_deductible"): rng("deductible_applied", 0, 10000, -1, 10001),
    ("claims", "valid_fraud_score"): rng("fraud_score", 0.0, 100.0, -0.01, 100.01),
    ("claims", "valid_witness_count"): rng("witness_count", 0, 50, -1, 51),
    ("claims", "valid_photos_taken"): rng("photos_taken", 0, 100, -1, 101),
    ("claims", "valid_repair_estimate"): rng("repair_estimate", 0.0, 20000000.0, -0.01,
                                             20000000.01),
    ("claims", "valid_dates"): [
        ({"incident_date": d1, "claim_date": d1, "report_date": d1}, True),
        ({"incident_date": d1, "claim_date": d2, "report_date": d3}, True),
        ({"incident_date": d2, "claim_date": d1, "report_date": d3}, False),
        ({"incident_date": d1, "claim_date": d3, "report_date": d2}, False),
        ({"incident_date": d1, "claim_date": None, "report_date": d3}, False)],
    ("claims", "reasonable_settlement_ratio"): [
        ({"settlement_amount": 0.0, "claim_amount": 10.0}, True),
        ({"settlement_amount": 11.0, "claim_amount": 10.0}, True),
        ({"settlement_amount": 11.01, "claim_amount": 10.0}, False),
        ({"settlement_amount": 5.0, "claim_amount": 0.0}, False)],   # NULL ratio, no error
    ("claims", "valid_severity_level"): [
        ({"severity_level": "Low"}, True), ({"severity_level": "Critical"}, True),
        ({"severity_level": "low"}, False), ({"severity_level": None}, False)],
    ("claims", "valid_claim_type_values"): [
        ({"claim_type": "Wind/Hail"}, True), ({"claim_type": "Additional Living Expenses"}, True),
        ({"claim_type": "Wind/hail"}, False), ({"claim_type": None}, False)],
    ("claims", "valid_claim_status_values"): [
        ({"claim_status": "Under Review"}, True), ({"claim_status": "under review"}, False),
        ({"claim_status": None}, False)],
    ("claims", "has_comments"): [({"comments": "x"}, True), ({"comments": ""}, False),
                                 ({"comments": None}, False)],
    ("dim_customer", "pk_not_null"): [({"customer_sk": "ab"}, True), ({"customer_sk": None}, False)],
    ("dim_customer", "customer_id_present"): nonempty("customer_id"),
    ("dim_customer", "email_valid"): [({"email": "a@b.c"}, True), ({"email": "a@b"}, False),
                                      ({"email": None}, False)],
    ("dim_customer", "state_len"): [({"state": "CA"}, True), ({"state": "C"}, False),
                                    ({"state": None}, False)],
    ("dim_policy", "pk_not_null"): [({"policy_sk": "ab"}, True), ({"policy_sk": None}, False)],
    ("dim_policy", "policy_id_present"): nonempty("policy_id"),
    ("dim_policy", "coverage_positive"): [({"coverage_amount": 1}, True),
                                          ({"coverage_amount": 0}, False),
                                          ({"coverage_amount": None}, False)],
    ("dim_policy", "premium_positive"): [({"premium_amount": 0.01}, True),
                                         ({"premium_amount": 0.0}, False),
                                         ({"premium_amount": None}, False)],
    ("fact_claim", "fk_policy"): nonempty("policy_id"),
    ("fact_claim", "fk_customer"): nonempty("customer_id"),
    ("fact_claim", "amount_positive"): [({"claim_amount": 0.01}, True), ({"claim_amount": 0.0}, False),
                                        ({"claim_amount": None}, False)],
    ("fact_claim", "deductible_nonneg"): [({"deductible_applied": 0}, True),
                                          ({"deductible_applied": -1}, False),
                                          ({"deductible_applied": None}, False)],
    ("fact_claim", "severity_valid"): [({"severity_level": "High"}, True),
                                       ({"severity_level": "high"}, False)],
    ("fact_claim", "settlement_ratio_valid"): [
        ({"settlement_amount": 11.0, "claim_amount": 10.0}, True),
        ({"settlement_amount": 12.0, "claim_amount": 10.0}, False),
        ({"settlement_amount": 1.0, "claim_amount": 0.0}, False)],
}


def test_every_rule_has_cases():
    declared = {(d, r.name) for d, rules in E.RULES.items() for r in rules}
    assert declared == set(CASES)
    assert len(declared) == 55


@pytest.mark.parametrize("dataset,rule_name", sorted(CASES))
def test_rule(spark, dataset, rule_name):
    rule = next(r for r in E.RULES[dataset] if r.name == rule_name)
    cases = CASES[(dataset, rule_name)]
    cols = sorted({c for vals, _ in cases for c in vals})
    schema = StructType([StructField("case", IntegerType())] +
                        [StructField(c, TYPES[c]) for c in cols])
    rows = [(i, *[vals.get(c) for c in cols]) for i, (vals, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, schema)
    got = {r.case: r.ok for r in df.select("case", rule.passed().alias("ok")).collect()}
    assert got == {i: exp for i, (_, exp) in enumerate(cases)}
    # the metric agrees and dropping keeps exactly the passing rows
    m = E.expectation_metrics(df, [rule], dataset).collect()[0]
    assert (m.passed, m.failed) == (sum(e for _, e in cases), sum(not e for _, e in cases))
    kept = {r.case for r in E.expect_or_drop(df, rule.name, rule.predicate).collect()}
    assert kept == {i for i, (_, e) in enumerate(cases) if e}
    failed = E.failed_records(df, [rule])
    if rule.action == E.DROP:
        assert {r.case: r.failed_rules for r in failed.collect()} == \
            {i: [rule.name] for i, (_, e) in enumerate(cases) if not e}


def test_lineage_rule_counts():
    assert E.rule_form_counts(E.POLICY_RULES) == "10 expect_all_or_drop, 1 expect_or_drop"
    assert E.rule_form_counts(E.CUSTOMER_RULES) == "10 expect_all_or_drop, 2 expect_or_drop"
    assert E.rule_form_counts(E.CLAIM_RULES) == \
        "13 expect_all_or_drop, 4 expect_or_drop, 1 expect"


def test_expect_keeps_rows(spark):
    df = spark.createDataFrame([("",), ("x",)], "comments string")
    assert E.expect(df, "has_comments", "comments != ''").count() == 2
    assert E.expect_all_or_drop(df, {"a": "comments IS NOT NULL", "b": "comments != ''"}).count() == 1
