"""URL filter by host word segmentation and naive Bayes (operator 9).

Names, runs of letters in host and path, are often words written together. A
unigram model cuts them apart: Viterbi search for the split into words with
the largest product of probabilities, counted over all documents and the
training rows. A multinomial naive Bayes model then sums the evidence of the
words for the classes block and allow; words that the training rows lack say
nothing. Where a rule fits, the longest one decides instead.

Only words that are parts of some name count, and each distinct name is cut
once. The evidence is summed as whole millionths: the same in any order.

A null url, or one without ``://``, has an empty host and path, no names, and
the verdict of the classes' prior. Names longer than 63 letters, the most that
a host's label holds, are cut every 63. Rows that repeat come out as often.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LONGEST_NAME, LONGEST_WORD = 63, 20
#: Rows (parts of names, or names) that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: What an occurrence in the training rows counts in the unigram model: host names use these words far
#: more than prose does, in which many of them never stand.
TRAINING_COUNT = 100

Rule = tuple[str, str, str]

# Training rows: words of host names, each row one host, by what such sites deal in. Fixed values.
BLOCK_HOSTS = (
    # games of chance
    "casino bonus online", "royal casino jackpot", "live casino slots", "poker tables online", "poker bets blog",
    "sports bets odds", "bets tips today", "free slots casino", "lottery win jackpot", "roulette bonus spins",
    "betting bookmaker odds", "gambling bonus casino", "bingo win prizes", "keno royale lottery", "blackjack bets win",
    "slots spin win", "vegas casino royale", "online betting tips", "free spins bonus",
    # medicines without a prescription
    "pills pharmacy online", "buy cheap viagra", "cialis pills discount", "diet pills weight loss", "cheap meds pharmacy",
    "drug discount pills", "buy xanax online", "order tramadol now", "generic viagra shop", "cheap steroids buy",
    "meds without prescription", "pills for men",
    # adult
    "adult video", "adult chat cams", "xxx video tube", "x rated movies", "porn tube free", "sex cams live",
    "hot singles dating", "sexy girls dating", "escort girls adult", "erotic adult blog", "nude cams xxx",
    "hot girls cams", "meet singles now", "x rated cams", "milf tube xxx",
    # unwanted mail and links
    "spam mail blast", "link farm seo", "content farm network", "bulk mail sender", "spam sender bulk", "seo backlinks spam",
    "spam blog", "buy backlinks cheap", "guest post seo links", "article spinner seo", "buy followers cheap",
    # advertising
    "ads server click", "track click pixel", "ads banner popup", "ad server track", "popup ads network",
    "click track affiliate", "pixel track server", "affiliate ads bonus", "ads click network", "banner ads exchange",
    # quick money
    "payday loans cash", "fast cash loans", "cheap loans debt", "get rich quick cash", "crypto bonus signals",
    "forex signals profit", "forex trading robot", "crypto doubler profit", "binary options profit", "bitcoin profit bonus",
    "easy money online", "work from home cash", "debt relief fast",
    # forgeries, theft and tricks
    "replica watches cheap", "cheap luxury replica", "replica bags shop", "free ringtones download", "crack warez keygen",
    "warez torrent crack", "free iphone prize", "win prize survey", "phishing login verify", "verify account login",
    "buy essay cheap", "essay writers service", "custom essay papers", "fake diploma buy", "fake passport buy",
    "keygen serial crack", "miracle weight loss", "free gift card generator",
)
ALLOW_HOSTS = (
    "daily news", "world news times", "city news online", "local weather report", "science journal", "nature science",
    "open university", "university press", "public library", "national library", "city museum", "museum of art",
    "history archive", "free software foundation", "open source project", "linux help forum", "python blog",
    "developer notes", "code blog", "travel blog", "food blog kitchen", "recipe book", "family farm market", "farm and garden",
    "organic farm shop", "garden club", "track and field", "railway track history", "running club", "football club",
    "chess club", "music school", "school district", "primary school", "community college", "medical journal",
    "health clinic", "city hospital", "children charity", "free concert hall", "free public lectures", "adult education",
    "adult learning college", "book review", "poetry magazine", "film festival", "theatre company", "photo gallery",
    "map of europe", "mountain hiking", "bird watching", "animal rescue", "bike repair", "car repair shop", "house design",
    "cheap flights travel", "bank of england", "tax office", "city council", "parliament debates", "court records",
    "patent office", "writers guild", "essay collection", "village pharmacy", "hot springs hotel", "card games club",
    "trading post museum", "watch repair", "live music hall", "online course", "home and garden", "women writers",
    "radio station", "video library", "research network", "weather service", "mail archive", "money museum", "dating of fossils",
    "work and health", "game design school", "royal society", "royal theatre", "prize for poetry", "sports club", "data server",
    "mobile phone repair", "press release", "job market", "loans for students", "credit union", "family doctor",
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII capitals lower-cased) and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, what in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):   # the longest is asked first
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def _names(*texts: Column) -> Column:
    """The names of texts, lower-cased, cut to the greatest length."""
    joined = F.lower(F.concat_ws(" ", *texts))
    return F.regexp_extract_all(joined, F.lit(f"([a-z]{{1,{LONGEST_NAME}}})"), 1)


def training_words() -> Counter:
    return Counter(w for row in (*BLOCK_HOSTS, *ALLOW_HOSTS) for w in row.split())


def word_evidence(block: Sequence[str] = BLOCK_HOSTS, allow: Sequence[str] = ALLOW_HOSTS) -> dict[str, int]:
    """For each training word the logarithm of its probability under block over
    that under allow, with one added to every count, in millionths."""
    one, two = (Counter(w for row in rows for w in row.split()) for rows in (block, allow))
    words = sorted({*one, *two})
    n1, n2 = (sum(c.values()) + len(words) for c in (one, two))
    return {w: round(1e6 * (math.log((one[w] + 1) / n1) - math.log((two[w] + 1) / n2))) for w in words}


#: The odds of block before any word is seen: three hosts in ten, fewer than their share of the training
#: rows, so that a name is allowed which no word speaks against.
PRIOR = round(1e6 * math.log(0.3 / 0.7))


def best_split(name: str, words: dict[str, float], unknown: float) -> list[str]:
    """Viterbi: the split with the greatest sum of logarithms. An unknown letter
    stands alone and costs ``unknown``. Of equals the split whose last words are longer."""
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        top, at = best[end - 1] + words.get(name[end - 1:end], unknown), end - 1
        for start in range(max(0, end - LONGEST_WORD), end - 1):
            p = words.get(name[start:end])
            if p is not None and best[start] + p >= top + (1e-12 if start > at else 0.0):
                top, at = best[start] + p, start
        best.append(top)
        back.append(at)
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def _split(total: int, evidence: dict[str, int]):
    unknown = -math.log(total) - 10.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, scores = [], []
            for name, parts, counts in zip(*(batch.column(c).to_pylist() for c in ("name", "parts", "counts"))):
                cut = best_split(name, {p: math.log(c / total) for p, c in zip(parts or (), counts or ())}, unknown)
                words.append(cut)
                # a single letter is a word only if it is the whole name, else what is left between words
                scores.append(sum(evidence.get(w, 0) for w in cut if len(w) > 1 or len(cut) == 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("name"), pa.array(words, pa.list_(pa.string())), pa.array(scores, pa.int64())],
                names=["name", "words", "score"])
    return run


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def split_names(names: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(name, words, score) of distinct names, by the words of all documents."""
    spark: SparkSession = names.sparkSession
    size = F.length("name")
    starts = F.sequence(F.lit(1), size)
    parts = (names.select("name", F.explode(starts).alias("at"))
             .select("name", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), size - F.col("at") + 1)))
                     .alias("n"))
             .select("name", F.substring("name", F.col("at"), F.col("n")).alias("part")).distinct())
    parts = materialize(parts, "name-parts")
    wanted = materialize(parts.select("part").distinct(), "parts")
    corpus = docs.select(F.explode(F.split(F.lower(text), "[^a-z]+")).alias("part"))
    counted = corpus.join(_few(wanted), "part", "left_semi").groupBy("part").agg(F.count("*").alias("n"))
    trained = spark.createDataFrame([(w, c * TRAINING_COUNT) for w, c in sorted(training_words().items())],
                                    "part string, n bigint")
    counts = materialize(counted.unionByName(trained).groupBy("part").agg(F.sum("n").alias("n")), "unigrams")
    total = int(counts.agg(F.sum("n")).first()[0])
    lists = (names.join(parts.join(counts, "part"), "name", "left").groupBy("name")
             .agg(F.collect_list("part").alias("parts"), F.collect_list("n").alias("counts")))
    return materialize(lists.mapInArrow(_split(total, word_evidence()),
                                        "name string, words array<string>, score bigint"), "split-names")


def judge(pages: DataFrame, docs: DataFrame, rules: Sequence[Rule] = (), page_id: str = "page_id",
          url: str = "url", text: str = "text") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, log_odds (of block) and words."""
    distinct = materialize(pages.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct(), "urls")
    listed = distinct.select("url", F.posexplode(_names(*url_parts(F.col("url")))).alias("at", "name"))
    names = materialize(listed.select("name").distinct(), "names")
    cut = split_names(names, docs, text)
    scored = (listed.join(_few(cut), "name").groupBy("url")
              .agg(F.sum("score").alias("score"), F.array_sort(F.collect_list(F.struct("at", "words"))).alias("w")))
    scored = materialize(scored.select("url", "score", F.flatten(F.col("w.words")).alias("words")), "url-scores")
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).join(scored, "url", "left")
    rows = rows.select("page_id", host.alias("host"), path.alias("path"),
                       (F.coalesce("score", F.lit(0)) + F.lit(PRIOR)).alias("odds"), "words")
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", name.alias("rule"),
                       F.coalesce(verdict, F.when(F.col("odds") > 0, "block").otherwise("allow")).alias("verdict"),
                       (F.col("odds") / 1e6).alias("log_odds"), F.concat_ws(" ", "words").alias("words"))
