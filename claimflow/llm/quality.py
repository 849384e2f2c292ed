"""Quality rules: tokeniser fertility (operator 3).

Each word of a text is cut into tokens by a public vocabulary with byte
fallback. Three measures describe a text: characters per token, the share of
byte tokens, and the entropy of its tokens in bits. Junk shows as little
*variety*, characters per token times entropy (shouting, stray symbols and
tables raise the number of tokens and repeat them), as low entropy alone
(repeated words), or as many byte tokens (broken or foreign scripts).

The rejection bands come from the corpus itself, from all documents that pass
the base rules, whatever their number: median and quartiles of each measure. A text
is judged by the first of these groups that has enough texts, and never by texts of
another script: its language and class of length (``GROUP`` texts); its language;
its script; its script with ``FEW`` texts. The bands of the latter three are wider.
Entropy grows with a text's length, hence the classes, each doubling of the tokens;
in a group over all lengths measures are shares of the median of their class. A text
of a script with fewer than ``FEW`` texts in the corpus has no band and is kept if it
passes the base rules. A text's script is that of most of its letters, told by the lead bytes of
UTF-8: runs of alphabets that share these count as one.

Words are runs of characters other than ASCII white space. Null and empty
texts have none and fail the base rules. A null language is a language of its
own. Rows that repeat an id are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocab
from .common import fresh, materialize
from .textnum import PIECE, mix, ngram_hashes, text_bytes, word_hashes, word_spans

VOCABULARY = "piece_bpe_32k.model"
MIN_WORDS, MAX_REPEATED = 20, 30
WINDOW = 8
#: Widths of the bands in robust standard deviations below the median, and the
#: least deviation: entropy in bits, variety as a share of the median.
ENTROPY_BAND, VARIETY_BAND = 4.0, 3.5
LEAST_ENTROPY, LEAST_VARIETY = 0.03, 0.01
#: The share of byte tokens may exceed the upper quartile by so much.
BYTE_BAND = 0.1
#: Documents that a group needs for a band, or for a wider one; the first and last class of length (log2 of the tokens).
GROUP, FEW, SHORT, LONG = 100, 20, 6, 12
#: How much wider the bands over all lengths are, and that of a few texts.
WIDER = {"lang": 1.5, "script": 1.5, "few": 2.0}

#: Scripts by the lead bytes that their letters have in UTF-8. Fixed values.
SCRIPTS = {"latin": [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)], "greek": [0xCD, 0xCE, 0xCF],
           "cyrillic": [*range(0xD0, 0xD4)], "hebrew": [0xD6, 0xD7], "arabic": [*range(0xD8, 0xDC)],
           "indic": [0xE0], "kana": [0xE3], "han": [*range(0xE4, 0xEA)], "hangul": [*range(0xEA, 0xEE)],
           "other": [0xCA, 0xCB, 0xCC, 0xD4, 0xD5, *range(0xDC, 0xE0), 0xE1, 0xE2, 0xEF, *range(0xF0, 0xF5)]}
_SCRIPT = np.full(256, -1, np.int8)
for _k, _bytes in enumerate(SCRIPTS.values()):
    _SCRIPT[_bytes] = _k

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "n_tokens bigint, n_byte_tokens bigint, entropy double, script string")


def repeated_words(words: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Per document the words in n-word windows that it has twice or more."""
    counts = np.diff(of)
    docs = np.flatnonzero(counts >= n)
    covered = np.zeros(len(words) + 1, np.int32)
    if len(docs):
        grams, bounds = ngram_hashes(words, of, n)
        doc = np.repeat(np.arange(len(counts)), np.diff(bounds))
        at = np.arange(len(grams)) - bounds[doc] + of[doc]
        full = counts[doc] >= n
        grams, doc, at = grams[full], doc[full], at[full]
        own = mix(grams ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        order = np.argsort(own)
        own = own[order]
        same = own[1:] == own[:-1]
        twice = np.zeros(len(own), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = at[order[twice]]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + n, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
    return inside[of[1:]] - inside[of[:-1]]


def repeated_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            n += line in seen
            seen.add(line)
    return n


def entropy(ids: np.ndarray) -> float:
    """Of the tokens of a text, in bits."""
    if not len(ids):
        return 0.0
    ids = np.sort(ids)
    counts = np.diff(np.concatenate(([0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [len(ids)])))
    return float(np.log2(len(ids)) - (counts * np.log2(counts)).sum() / len(ids))


def measure(column: pa.Array, file: str) -> list[pa.Array]:
    data, bounds = text_bytes(column)
    encode, is_byte = vocab.piece_model(file)
    starts, ends, of = word_spans(data, bounds)

    def per_text(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return sums[bounds[1:]] - sums[bounds[:-1]]

    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends, 1)
    chars = per_text((np.cumsum(inside[:-1], dtype=np.int8) > 0) & ((data & 0xC0) != 0x80))
    symbols = per_text(_SYMBOL[data])
    repeats = repeated_words(word_hashes(data, starts, ends), of, WINDOW)
    raw = memoryview(data)
    texts = [bytes(raw[bounds[i]:bounds[i + 1]]) for i in range(len(column))]
    lines = [repeated_lines(t) for t in texts]
    n_tokens, n_bytes, bits = [], [], []
    for lo in range(0, len(texts), 64):
        for ids in encode([t.split() for t in texts[lo:lo + 64]]):
            n_tokens.append(len(ids))
            n_bytes.append(int(is_byte[ids].sum()))
            bits.append(entropy(ids))
    long = [np.diff(of), chars, symbols, lines, repeats, n_tokens, n_bytes]
    return [*(pa.array(x, pa.int64()) for x in long), pa.array(bits, pa.float64()),
            pa.array(scripts(data, bounds), pa.string())]


def scripts(data: np.ndarray, bounds: np.ndarray) -> list[str]:
    """The script of most letters of each text; of equal numbers the first, "none" without any."""
    names, n = list(SCRIPTS), len(bounds) - 1
    counts = np.zeros(n * len(names), np.int64)
    for lo in range(0, len(data), PIECE):
        kinds = _SCRIPT[data[lo:lo + PIECE]]
        letters = np.flatnonzero(kinds >= 0)
        text = np.searchsorted(bounds, letters + lo, "right") - 1
        counts += np.bincount(text * len(names) + kinds[letters], minlength=len(counts))
    counts = counts.reshape(n, -1)
    return [names[c.argmax()] if c.any() else "none" for c in counts]


def _measured(file: str, columns: list[str]):
    names = columns + [x.split()[0] for x in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("_text")
            own = [batch.column(c) for c in columns]
            if not len(batch):
                continue
            size = max(1, min(len(batch), int(len(batch) * (1 << 20) / max(1, text.nbytes))))
            for lo in range(0, len(batch), size):
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, size) for c in own), *measure(text.slice(lo, size), file)], names=names)
    return run


def measures(docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang") -> DataFrame:
    """doc_id, lang, tie (a hash of the text) and the measures of every row."""
    file = vocabulary or vocab.path(VOCABULARY)
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"),
                    F.xxhash64(text).alias("tie"), F.col(text).alias("_text"))
    kind = dict(d.dtypes)["doc_id"]
    return d.mapInArrow(_measured(file, ["doc_id", "lang", "tie"]),
                        f"doc_id {kind}, lang string, tie bigint, {MEASURES}")


#: The groups, in the order in which they judge, with the texts that they need.
LEVELS = {"class": GROUP, "lang": GROUP, "script": GROUP, "few": FEW}
_LOWS = ["entropy_low", "variety_low", "byte_high"]


def class_medians(measured: DataFrame) -> DataFrame:
    """(class, entropy_mid, variety_mid) over all texts that pass the base rules."""
    once = measured.where("NOT base_failed").dropDuplicates(["lang", "tie"])
    return once.groupBy("class").agg(F.percentile(F.round("entropy", 2), 0.5).alias("entropy_mid"),
                                     F.percentile(F.round("variety", 2), 0.5).alias("variety_mid"))


def bands(measured: DataFrame, medians: DataFrame) -> DataFrame:
    """(level, name, class, entropy_low, variety_low, byte_high): the bands of the groups with enough
    texts; those over all lengths (a null class) in shares of the class medians. Each text counts
    once, as copies would narrow its group's band. Exact quantiles of rounded measures: the same in
    any order of the rows. Junk stands on the low side, so the spread is the greater of that between
    the quartiles and of the upper part."""
    quantiles = F.array(*map(F.lit, (0.25, 0.5, 0.75, 0.9)))
    e, v = F.round("entropy", 2), F.round("variety", 2)
    share = lambda x, mid: F.round(x / F.greatest(F.col(mid), F.lit(0.01)), 4)
    group = lambda level, name, of, x, y: F.struct(
        F.lit(level).alias("level"), F.col(name).alias("name"), of.alias("class"), x.alias("e"), y.alias("v"))
    every = F.lit(None).cast("bigint")
    e_share, v_share = share(e, "entropy_mid"), share(v, "variety_mid")
    groups = (measured.where("NOT base_failed").dropDuplicates(["lang", "tie"]).join(medians, "class")
              .select(F.round("byte_share", 3).alias("b"), F.explode(F.array(
                  group("class", "lang", F.col("class"), e, v), group("lang", "lang", every, e_share, v_share),
                  group("script", "script", every, e_share, v_share))).alias("g"))
              .groupBy("g.level", "g.name", "g.class")
              .agg(F.count("*").alias("n"), F.percentile("g.e", quantiles).alias("e"),
                   F.percentile("g.v", quantiles).alias("v"), F.percentile("b", quantiles).alias("b")))
    few = groups.where((F.col("level") == "script") & F.col("n").between(FEW, GROUP - 1)).withColumn("level", F.lit("few"))
    enough = groups.where(F.col("n") >= GROUP).unionByName(few)
    wide = F.lit(1.0)
    for level, by in WIDER.items():
        wide = F.when(F.col("level") == level, by).otherwise(wide)

    def low(c: str, width: float, least) -> F.Column:
        spread = F.greatest((F.col(c)[2] - F.col(c)[0]) / 1.349, (F.col(c)[3] - F.col(c)[1]) / 1.2816)
        return F.col(c)[1] - wide * width * F.greatest(spread, least)

    # the least deviation of entropy is in bits, or as much of a median of about eight bits
    least = F.when(F.col("level") == "class", LEAST_ENTROPY).otherwise(LEAST_ENTROPY / 8)
    return enough.select("level", "name", "class", low("e", ENTROPY_BAND, least).alias("entropy_low"),
                         low("v", VARIETY_BAND, LEAST_VARIETY * F.col("v")[1]).alias("variety_low"),
                         (F.col("b")[2] + wide * BYTE_BAND).alias("byte_high"))


def judge(docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang") -> DataFrame:
    """doc_id, tie, the base counts, base_failed, the measures, and ``kept``."""
    tokens = F.greatest(F.col("n_tokens"), F.lit(1))
    m = materialize(
        measures(docs, vocabulary, doc_id, text, lang)
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                    | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
        .withColumn("chars_per_token", F.col("word_chars") / tokens)
        .withColumn("byte_share", F.col("n_byte_tokens") / tokens)
        .withColumn("variety", F.col("chars_per_token") * F.col("entropy"))
        .withColumn("class", F.least(F.greatest(F.floor(F.log2(tokens)), F.lit(SHORT)), F.lit(LONG))), "measures")
    mid = materialize(class_medians(m), "class-medians")
    b = materialize(bands(m, mid), "bands")
    # the rows of bands are as many as languages, classes and scripts; a null language meets its own band
    j = m.join(mid, "class", "left")
    for level, name in (("class", "lang"), ("lang", "lang"), ("script", "script"), ("few", "script")):
        own = b.where(F.col("level") == level).select(
            F.col("name").alias(f"{level}_name"), F.col("class").alias(f"{level}_class"), F.lit(True).alias(f"{level}_has"),
            *(F.col(c).alias(f"{level}_{c}") for c in _LOWS))
        on = F.col(name).eqNullSafe(F.col(f"{level}_name"))
        j = j.join(own, on & (F.col("class") == F.col(f"{level}_class")) if level == "class" else on, "left")
    odd = F.lit(False)
    for level in reversed(LEVELS):
        times = lambda c, m_: F.col(c) if level == "class" else F.col(c) * F.col(m_)  # noqa: B023, E731
        judged = ((F.col("entropy") < times(f"{level}_entropy_low", "entropy_mid"))
                  | (F.col("variety") < times(f"{level}_variety_low", "variety_mid"))
                  | (F.col("byte_share") > F.col(f"{level}_byte_high")))
        odd = F.when(F.col(f"{level}_has"), judged).otherwise(odd)
    return j.select("doc_id", "tie", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", (~F.col("base_failed") & ~F.coalesce(odd, F.lit(False))).alias("kept"),
                    "n_tokens", "n_byte_tokens", "entropy")


def keep_good(docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text",
              lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept; all columns stay."""
    id_, tie = (fresh(c, docs.columns) for c in ("good_id", "good_tie"))
    good = judge(docs, vocabulary, doc_id, text, lang).where("kept").select(
        F.col("doc_id").alias(id_), F.col("tie").alias(tie)).distinct()
    return docs.join(good, F.col(doc_id).eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(tie)), "left_semi")
