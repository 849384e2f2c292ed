"""Shared fixtures of the training-data tests: odd documents and brute force."""

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = ("the quick brown fox jumps over a lazy dog while seven wise owls watch from an old oak tree near "
         "the river and nobody in the village knows why they never sleep at night").split()

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# columns that operators use as names of their own
CLASHING = ("key tie places node bands bucket class kept copy n_copies shuffle_key rate_source sure steps hit_id "
            "hit_hash hit_more good_id good_tie first_id pieces words word pos start span items spans part before "
            "base a b c comp hub company _text own_entropy_low host path name url").split()


def odd_documents():
    """Null, empty, blank, short, long, repeated, tied and unusual texts."""
    prose = " ".join(PROSE)
    long = " ".join(PROSE[(i * i + i // 7) % len(PROSE)] + str(i % 97) for i in range(60_000))
    return [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (4, "one", "en", "b", 3),
        (5, prose, "en", "a", None), (6, prose, "en", "a", 1), (7, prose + " today", None, "a", 2),
        (8, long, "en", "c", -1), (9, "Übergrößenträger " * 40, "de", "c", 0), (10, "漢字かな交じり文。" * 30, "ja", "c", 0),
        (11, "x" * 70_000, "en", "c", 0), (12, "a\x00b \x85 c　d <|endoftext|> e\r\n  f", "en", "d", 0),
        (13, "line one\nline one\n\nline one", "en", "d", 0), (None, prose, "en", "d", 0), (None, None, None, None, None),
        (5, prose, "en", "a", None), (5, "another text under the same id " + prose[::-1], "en", "b", 0),
        (14, "😀 " * 50, "xx", None, 0), (15, "# * $ % & | < >", "en", "b", 0),
    ]


@pytest.fixture(scope="session")
def llm_spark(spark):
    from claimflow.llm.common import ship
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(llm_spark):
    return llm_spark.createDataFrame(odd_documents(), SCHEMA).repartition(3, "source")


@pytest.fixture(scope="session")
def empty(llm_spark):
    return llm_spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F
    return odd.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def small(llm_spark):
    return llm_spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
