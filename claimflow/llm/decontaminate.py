"""Benchmark decontamination: broadcast n-gram set, token window scan (operator 4).

Texts are normalised (ASCII capitals lower-cased) and split into words, runs
of digits, ASCII letters and non-ASCII characters. The n-grams of the
benchmark are grouped by their rarest word in the corpus, so the scan of the
documents looks at a window only where that word stands; a window is a hit
when all its words equal those of the n-gram. DataFrame functions only.

Null and empty texts have no words; items without a word are ignored; items with a
null id hit like others, count together as one item, and have no name in a list of
ids; documents with a null id are documents like others; an item of fewer than ``n`` words is one window of all its words. Rows that repeat a
document id with the same text are one document. Other columns are ignored by
:func:`overlaps` and kept by :func:`remove_documents` and :func:`remove_spans`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize

#: n-grams held in one broadcast; larger sets are joined by a shuffle.
BROADCAST_NGRAMS = 500_000

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# the same in a text whose capitals still stand
_RAW_WORD, _RAW_SEPARATORS = (rf"[{n}\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+" for n in ("^", ""))
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_pieces(text: Column) -> Column:
    """Words of a text; the first and the last element may be empty strings."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.split(low, SEPARATORS)


def word_count(pieces: Column) -> Column:
    ends = (F.element_at(pieces, 1) == "").cast("long") + F.when(
        F.size(pieces) > 1, (F.element_at(pieces, -1) == "").cast("long")).otherwise(0)
    return F.size(pieces).cast("long") - ends


def benchmark_ngrams(benchmark: DataFrame, n: int = 10, text: str = "text",
                     item: str = "item_id") -> DataFrame:
    """(words, items): each distinct window of the items with the ids, as structs, that it comes from."""
    words = F.filter(word_pieces(F.col(text)), lambda w: w != "")
    size = F.size("words")
    return (benchmark.select(F.col(item).cast("string").alias("item"), words.alias("words"))
            .where(size > 0)
            .select("item", "words", F.explode(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))))
                    .alias("at"))
            .select("item", F.slice("words", F.col("at"), n).alias("words"))
            .groupBy("words").agg(F.collect_set(F.struct("item")).alias("items")))


def _tokens(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       word_pieces(F.col(text)).alias("pieces"))


def hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text",
         doc_id: str = "doc_id", item: str = "item_id",
         broadcast_limit: int = BROADCAST_NGRAMS) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, spans [(start, len)], items.

    ``start`` counts from 0 within the document's words (a leading empty piece
    counts as one). The n-gram set is broadcast only if its counted size is
    within ``broadcast_limit``.
    """
    grams = materialize(benchmark_ngrams(benchmark, n, text, item), "ngrams")
    small = grams.count() <= broadcast_limit
    tokens = _tokens(docs, text, doc_id)
    anchors = _anchors(grams, tokens, small)
    counted = tokens.select("*", word_count(F.col("pieces")).alias("n_words"))
    start = (F.col("pos") - F.col("off")).alias("start")
    if small:
        # a row for each word that anchors an n-gram, and for each document's first piece
        found = (counted.select("*", F.posexplode("pieces").alias("pos", "word"))
                 .join(F.broadcast(anchors), "word", "left")
                 .select("*", start)
                 .withColumn("hit", F.coalesce(_equal("start", "gram_words"), F.lit(False)))
                 .where(F.col("hit") | (F.col("pos") == 0)))
        when = lambda c: F.when(F.col("hit"), c)
        return (found.groupBy("doc_id", "text_hash")
                .agg(F.max("n_words").alias("n_words"),
                     F.collect_set(when(F.struct("start", F.size("gram_words").alias("len")))).alias("spans"),
                     F.array_distinct(F.flatten(F.collect_set(when(F.col("items"))))).alias("items")))
    # words travel alone; the candidates of a document, as many as its anchors, come back to it
    candidates = (tokens.select("doc_id", "text_hash", F.posexplode("pieces").alias("pos", "word"))
                  .join(anchors, "word").select("doc_id", "text_hash", start, "gram_words", "items").distinct()
                  .groupBy("doc_id", "text_hash")
                  .agg(F.collect_list(F.struct("start", "gram_words", "items")).alias("candidates"))
                  .withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    hit = F.filter(F.coalesce("candidates", F.array()), lambda c: _equal(c["start"], c["gram_words"]))
    found = counted.join(candidates, same, "left").select("doc_id", "text_hash", "n_words", hit.alias("hits"))
    return found.dropDuplicates(["doc_id", "text_hash"]).select(
        "doc_id", "text_hash", "n_words",
        F.array_distinct(F.transform("hits", lambda h: F.struct(h["start"].alias("start"),
                                                                F.size(h["gram_words"]).alias("len")))).alias("spans"),
        F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))).alias("items"))


def _equal(start, words) -> Column:
    """Whether the pieces from ``start`` on are these words."""
    start, words = (F.col(c) if isinstance(c, str) else c for c in (start, words))
    return (start >= 0) & (F.slice("pieces", F.greatest(start + 1, F.lit(1)), F.size(words)) == words)


def _anchors(grams: DataFrame, tokens: DataFrame, small: bool) -> DataFrame:
    """(word, off, gram_words, items): each n-gram with its rarest word in the corpus
    and that word's place in it. One with a word that the corpus lacks can't occur."""
    vocabulary = grams.select(F.explode("words").alias("word")).distinct()
    words = tokens.select(F.explode("pieces").alias("word"))
    if small:
        frequency = words.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count("*").alias("df"))
    else:   # counted first: a frequent word is a row per task
        frequency = words.groupBy("word").agg(F.count("*").alias("df")).join(vocabulary, "word")
    known = (grams.select("*", F.monotonically_increasing_id().alias("gram"))
             .select("gram", "words", "items", F.posexplode("words").alias("off", "word"))
             .join(frequency, "word", "left")
             .groupBy("gram").agg(F.min("words").alias("gram_words"), F.min("items").alias("items"),
                                  F.count("df").alias("known"),
                                  F.min(F.struct("df", "off", "word")).alias("rarest"))
             .where(F.col("known") == F.size("gram_words")))
    return materialize(known.select(F.col("rarest.word").alias("word"), F.col("rarest.off").alias("off"),
                                    "gram_words", "items"), "anchors")


def overlaps(docs: DataFrame, benchmark: DataFrame, n: int = 10, **names) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted ids), spans, contaminated."""
    found = hits(docs, benchmark, n, **names)
    covered = F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))
    return found.select("doc_id", "text_hash", "n_words", F.size(covered).cast("long").alias("n_hit"),
                        F.array_sort(F.transform("items", lambda i: i["item"])).alias("items"), "spans",
                        (F.size("spans") > 0).alias("contaminated"))


def _marked(docs: DataFrame, benchmark: DataFrame, n: int, text: str, doc_id: str, how: str, extra, **names):
    """``docs`` joined with the documents that have hits; the join's own columns get new names."""
    id_, hash_, more = (fresh(c, docs.columns) for c in ("hit_id", "hit_hash", "hit_more"))
    bad = (hits(docs, benchmark, n, text=text, doc_id=doc_id, **names).where(F.size("spans") > 0)
           .select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), extra.alias(more)))
    same = F.col(doc_id).eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(hash_))
    return docs.join(bad, same, how), more


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text",
                     doc_id: str = "doc_id", **names) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns kept."""
    return _marked(docs, benchmark, n, text, doc_id, "left_anti", F.lit(True), **names)[0]


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text",
                 doc_id: str = "doc_id", **names) -> DataFrame:
    """``docs`` with the hit words, and what follows each up to the next word, cut out of the text."""
    covered = F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))
    joined, hit = _marked(docs, benchmark, n, text, doc_id, "left", covered, **names)
    # a word with the separators after it, or those before the first: numbered like the pieces
    parts = F.regexp_extract_all(text, F.lit(f"(^{_RAW_SEPARATORS}|{_RAW_WORD}(?:{_RAW_SEPARATORS})?)"), 1)
    kept = F.filter(F.transform(parts, lambda p, i: F.when(~F.array_contains(hit, i), p)), lambda p: p.isNotNull())
    return joined.withColumn(text, F.when(F.col(hit).isNull(), F.col(text)).otherwise(F.concat_ws("", kept))
                             ).select(*docs.columns)
