"""The registered queries: names, columns, SQL, and native plans."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from cases import llm_spark  # noqa: F401
from claimflow.llm import queries
from test_exact import SF
from tools.check_oracle import TABLES, digest

COLUMNS = {
    "op3": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4": "doc_id n_words n_hit n_items items_sha256 contaminated", "op5": "page_id url text n_chars",
    "op6": "doc_id n_bytes n_removed n_spans kept_sha256", "op8": "doc_id start n_tokens ids_crc32",
    "op9": "page_id host path rule verdict", "op11": "lang source part item value rank",
    "op12": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op13": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}
LONG = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_hit", "n_items", "n_chars", "n_bytes",
        "n_removed", "n_spans", "start", "n_tokens", "ids_crc32", "n_assign", "n_access", "n_hex", "value", "gaps", "blank",
        "duplicate", "truncated", "illegal", "cost"}


def test_each_operator_is_registered_once():
    names = [n for n in se.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in se.queries()
    assert set(queries.ORACLE) <= set(queries.QUERIES) and queries.QUERIES.items() <= se.queries().items()


@pytest.mark.parametrize("operator", COLUMNS)
def test_contract_columns(llm_spark, operator):
    name = next(n for n in queries.QUERIES if n.startswith(operator + "_"))
    df = queries.QUERIES[name](llm_spark, SF)
    assert set(COLUMNS[operator].split()) <= set(df.columns)
    assert all(kind == "bigint" for c, kind in df.dtypes if c in LONG)
    table = {"op5": "pages", "op9": "pages", "op13": "conversations"}.get(operator, "documents")
    rows = llm_spark.read.parquet(f"{SF}/{table}.parquet")
    if operator == "op11":      # at least all pairs
        groups = rows.groupBy("lang").agg(F.count_distinct("source").alias("n"))
        assert df.where("part = 'pair'").count() == groups.agg(F.sum(F.expr("n * (n - 1)"))).first()[0]
    else:
        assert df.count() == (rows.select("conv_id").distinct() if operator == "op13" else rows).count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(llm_spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](llm_spark, SF)
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, want.fetchall())[0]


@pytest.mark.parametrize("name", ["op4_decontaminate", "op7_mix_sources", "op12_credential_links"])
def test_native_plans_run_no_python(llm_spark, name):
    df = queries.QUERIES[name](llm_spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
