"""The pipeline against its stages by brute force, and the stages' contracts."""

import zlib

import numpy as np

import corpus_pipeline as P
from cases import llm_spark, odd  # noqa: F401
from claimflow.llm import dac, mixing, quality, vocab
from test_exact import SF, ascii_words, exact_classes, texts_of


def test_pipeline_rows(llm_spark):
    from tokenizers import Tokenizer
    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    bench = llm_spark.read.parquet(f"{SF}/benchmark.parquet")
    # stage 1: its verdicts are checked on their own
    good = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    texts = {d: t for d, t in texts_of(docs).items() if d in good}
    # stage 2
    texts = {d: t for d, t in texts.items() if exact_classes({**texts})[0][d] == d} if len(texts) < 30 else {
        d: texts[d] for d, c in exact_classes(texts)[0].items() if c == d}
    # stage 3
    grams = {}
    for r in bench.collect():
        w = ascii_words(r.text)
        n = min(10, len(w))
        grams.setdefault(n, set()).update(tuple(w[i:i + n]) for i in range(len(w) - n + 1) if n)
    clean = {}
    for d, t in texts.items():
        w = ascii_words(t)
        if not any(tuple(w[i:i + n]) in gs for n, gs in grams.items() for i in range(len(w) - n + 1)):
            clean[d] = t
    # stage 4
    mixed = mixing.mix(docs.where(docs.doc_id.isin(list(clean)))).collect()
    # stage 5
    model = Tokenizer.from_file(vocab.path(dac.VOCABULARY))
    want, at = [], 0
    for d in (r.doc_id for r in sorted(mixed, key=lambda r: (r.shuffle_key, r.doc_id))):    # the files' order
        ids = np.array([*model.encode(clean[d], add_special_tokens=False).ids, 0], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in P.run(llm_spark, SF).collect()), key=lambda r: r[1])
    assert got == want and 100 < len(got)
    assert [r[0] for r in got] != sorted(r[0] for r in got)


def test_stages_keep_the_columns(llm_spark, odd):
    docs = odd
    for name, stage in P.STAGES[:-1]:
        out = stage(llm_spark, docs, SF)
        assert out.columns == docs.columns and out.schema.fieldNames() == odd.columns, name
        docs = out
    assert P.STAGES[-1][1](llm_spark, docs, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert 4 <= len(P.STAGES) <= 5 and P.ORACLE_SQL is None


def test_near_copies_loses_no_different_text(llm_spark):
    one, two = (" ".join(f"{w}{i}" for i in range(40)) for w in "ab")
    docs = llm_spark.createDataFrame([(None, one), (None, two), (5, one + " x"), (5, two[::-1]), (5, two[::-1]), (9, two + " y"),
                                      (None, None), (None, ""), (7, None)], "doc_id bigint, text string")
    stage = dict(P.STAGES)["near_duplicates"]
    got = sorted((str(r.doc_id), r.text or "") for r in stage(llm_spark, docs, SF).collect())
    # the classes of ``one`` and ``two`` keep a row each; copies under other ids go, different texts stay
    kept = [t for _, t in got]
    assert sum(t.startswith("a0 ") for t in kept) == sum(t.startswith("b0 ") for t in kept) == 1
    assert kept.count(two[::-1]) == 1 and sum(not t for t in kept) >= 2
    four = llm_spark.createDataFrame([(None, one), (None, two), (5, one[::-1]), (5, two[::-1])], "doc_id bigint, text string")
    assert stage(llm_spark, four, SF).count() == 4


def test_pipeline_of_an_empty_table(llm_spark, odd):
    docs = odd.limit(0)
    for _, stage in P.STAGES:
        docs = stage(llm_spark, docs, SF)
    assert docs.collect() == []
