"""Each operator on odd rows, an empty table and a table with clashing columns: defined results, no crash."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimflow.llm import chunks, dac, decontaminate, jaccard, lm, mixing, pages, quality, suffix, urls
from cases import CLASHING, PROSE, WORD, clashing, empty, llm_spark, odd, odd_documents  # noqa: F401

BENCHMARK = [(1, "Quick brown fox jumps over a lazy dog while SEVEN wise owls"), (2, "line one"), (3, None), (4, ""),
             (None, "one"), (5, "river and nobody"), (5, "river and nobody")]


@pytest.fixture(scope="module")
def benchmark(llm_spark):
    return llm_spark.createDataFrame(BENCHMARK, "item_id bigint, text string")


OPERATORS = {
    "pseudo_likelihood": lambda d, b: lm.score(d, lm.fit(d)),
    "jaccard": lambda d, b: jaccard.near_classes(d),
    "quality": lambda d, b: quality.judge(d),
    "decontaminate": lambda d, b: decontaminate.overlaps(d, b),
    "suffix": lambda d, b: suffix.remove_repeats(d),
    "mix": lambda d, b: mixing.mix(d),
    "tokens": lambda d, b: dac.round_trip(d),
    "chunks": lambda d, b: chunks.remove_repeats(d),
    "keep_good": lambda d, b: quality.keep_good(d),
    "keep_one": lambda d, b: jaccard.keep_one(d),
    "remove_documents": lambda d, b: decontaminate.remove_documents(d, b),
    "remove_spans": lambda d, b: decontaminate.remove_spans(d, b),
}
PER_ROW = {"pseudo_likelihood", "jaccard", "quality", "suffix", "tokens", "chunks", "remove_spans"}
STAGES = {"keep_good", "keep_one", "remove_documents", "remove_spans"}


def rows(df):
    # floats of averaged models aside, every value must agree
    return Counter(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(empty, benchmark, name):
    out = OPERATORS[name](empty, benchmark)
    assert out.collect() == [] and out.columns


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_columns(odd, clashing, benchmark, name):
    plain, more = OPERATORS[name](odd, benchmark), OPERATORS[name](clashing, benchmark)
    if name in PER_ROW:
        assert plain.count() == len(odd_documents())
    if name in STAGES:
        assert more.columns == clashing.columns and plain.columns == odd.columns
        more = more.drop(*CLASHING)
    elif name == "mix":
        assert more.columns[:len(clashing.columns)] == clashing.columns
        assert more.columns[len(clashing.columns):] == ["_n_copies", "_copy", "_shuffle_key"]
        more = more.drop(*CLASHING).withColumnsRenamed({f"_{c}": c for c in ("n_copies", "copy", "shuffle_key")})
    assert rows(plain) == rows(more)


@pytest.mark.parametrize("name", [n for n in OPERATORS if n not in ("pseudo_likelihood",)])
def test_result_does_not_depend_on_the_partitions(odd, benchmark, name):
    assert rows(OPERATORS[name](odd, benchmark)) == rows(OPERATORS[name](odd.coalesce(1), benchmark))


@pytest.mark.parametrize("name", ["quality", "decontaminate", "mix", "jaccard"])
def test_all_null_columns(llm_spark, benchmark, name):
    df = llm_spark.createDataFrame([(None,) * 5] * 3, "doc_id bigint, text string, lang string, source string, "
                                                     "n_chars bigint")
    out = OPERATORS[name](df, benchmark).collect()
    assert len(out) == (1 if name == "decontaminate" else 3) or name == "mix"


def test_null_and_empty_texts_by_operator(odd, benchmark):
    score = {r.doc_id: r for r in OPERATORS["pseudo_likelihood"](odd, benchmark).collect()}
    assert all((score[i].n_tokens, score[i].pseudo_log_likelihood, score[i].mean_log_probability) == (0, 0.0, None)
               for i in (1, 2, 3))
    judged = {r.doc_id: r for r in OPERATORS["quality"](odd, benchmark).collect()}
    assert all(judged[i].n_words == 0 and judged[i].base_failed and not judged[i].kept for i in (1, 2, 3))
    cut = {r.doc_id: r for r in OPERATORS["suffix"](odd, benchmark).collect()}
    assert cut[1].n_bytes == cut[2].n_bytes == 0 and bytes(cut[1].kept) == b""
    tokens = {r.doc_id: r for r in OPERATORS["tokens"](odd, benchmark).collect()}
    assert tokens[1].n_tokens == tokens[2].n_tokens == 1
    classes = {r.doc_id: r for r in OPERATORS["jaccard"](odd, benchmark).collect()}
    assert all(classes[i].class_id == i and classes[i].n_links == 0 for i in (1, 2, 3))
    hit = {r.doc_id: r for r in OPERATORS["decontaminate"](odd, benchmark).collect()}
    assert not any(hit[i].contaminated for i in (1, 2, 3))
    assert (hit[4].contaminated, hit[4].n_hit, hit[4].items) == (True, 1, [None])      # by the item without an id
    assert hit[13].contaminated and hit[13].n_hit == 6 and hit[13].items == ["2", None]


def test_tables_without_their_usual_rows(llm_spark, odd, benchmark):
    none = llm_spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r.contaminated for r in decontaminate.overlaps(odd, none).collect())
    assert decontaminate.remove_documents(odd, none).count() == odd.count()
    no_pages = llm_spark.createDataFrame([], "page_id bigint, url string, html string")
    assert pages.extract(no_pages).collect() == [] and urls.judge(no_pages, odd).collect() == []
    null_pages = llm_spark.createDataFrame([(1, None, None), (1, None, None), (None, "", ""), (2, "x", "<p>y"),
                                            (3, "HTTP://A.B?c", "<")], "page_id bigint, url string, html string")
    assert sorted((r.page_id or 0, r.text) for r in pages.extract(null_pages).collect()) == [
        (0, ""), (1, ""), (1, ""), (2, "y"), (3, "<")]
    judged = urls.judge(null_pages.withColumns({"words": F.lit(1), "score": F.lit(2), "odds": F.lit(3)}),
                        odd.limit(0)).collect()
    assert sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in judged) == [
        (0, "", "", None, "allow"), (1, "", "", None, "allow"), (1, "", "", None, "allow"),
        (2, "", "", None, "allow"), (3, "a.b", "", None, "allow")]


def test_repeated_rows_in_the_pipeline_stages(odd, benchmark):
    kept = quality.keep_good(odd).collect()
    assert sum(r.doc_id == 5 for r in kept) == sum(r[0] == 5 for r in odd_documents() if r[1])
    one = jaccard.keep_one(odd).collect()
    rows_ = Counter((r.doc_id, r.text) for r in one)
    assert max(rows_.values()) == 1         # of rows of one id and text a single one
    ids = {r.doc_id for r in one}
    prose = next(t for d, t, *_ in odd_documents() if d == 6)
    # of the copies of the prose (ids 5, 6, 7 and none) one is left; id 5's other text stays
    assert {1, 2, 3, 5} <= ids and sum(t in (prose, prose + " today") for _, t in rows_) == 1
    assert any(d == 5 and t.startswith("another") for d, t in rows_)


def test_null_items_and_documents_hit(llm_spark):
    words = " ".join(PROSE[:12])
    docs = llm_spark.createDataFrame([(None, words), (1, words), (2, "x")], "doc_id bigint, text string")
    items = llm_spark.createDataFrame([(None, words), (3, words), (None, "y")], "item_id bigint, text string")
    for limit in (10, 0):       # broadcast, and joined by a shuffle
        found = {r.doc_id: r for r in decontaminate.hits(docs, items, broadcast_limit=limit).collect()}
        assert len(found) == 3 and len(found[1].spans) == 3 and not found[2].spans
    got = {r.doc_id: (r.n_hit, r.items, r.contaminated) for r in decontaminate.overlaps(docs, items).collect()}
    assert got == {None: (12, ["3", None], True), 1: (12, ["3", None], True), 2: (0, [], False)}
    assert [r.doc_id for r in decontaminate.remove_documents(docs, items).collect()] == [2]


def test_words_agree_with_the_pattern(odd):
    judged = Counter((r.doc_id, r.n_words, r.word_chars) for r in quality.judge(odd).collect())
    want = Counter((d, len(w), sum(map(len, w))) for d, t, *_ in odd_documents() for w in [WORD.findall(t or "")])
    assert judged == want


def test_kept_bytes_are_the_texts_less_their_spans(odd):
    texts = {t.encode() for _, t, *_ in odd_documents() if t}
    for operator in (suffix, chunks):
        for r in operator.remove_repeats(odd).collect():
            assert r.n_bytes - r.n_removed == len(r.kept) and r.n_spans == len(r.spans)
            assert r.n_removed == sum(s.end - s.start for s in r.spans)
            if not r.spans and r.n_bytes:
                assert bytes(r.kept) in texts
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
