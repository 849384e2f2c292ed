"""Mixing sources to target weights by Poisson replication (operator 7).

Each source gets a repetition rate: its target weight times the size of the
mix, over its own size in characters. A document's number of copies is the
inverse of the Poisson distribution with that rate at a uniform number taken
from a hash of seed and document id: the same in every run and on every
machine. The copies are exploded and dealt out by a hash of seed, id and copy
number, within which they are sorted: a global shuffle without a sampling
pass. DataFrame functions only.

A null source is a source of its own. A source without characters has rate 1,
one without a given weight rate 0. Documents drawn zero times are not in the
mix. Rows that repeat an id are drawn alike. All columns of the input are
kept; the added ones are ``copy`` (from 1), ``n_copies`` and ``shuffle_key``
(with underscores before them if the input has such columns).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize

#: Sources whose rates are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 20_000

#: The largest rate of one draw: exp(-rate) must not vanish. A larger rate is the sum of draws.
LARGEST_RATE = 500

#: Hexadecimal digits of MD5 that make a number: 52 bits are exact in a double.
HEX_DIGITS = 13


def hash_long(*parts: Column) -> Column:
    """A uniform number of 52 bits from the parts, joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, HEX_DIGITS), 16, 10).cast("long")


def source_rates(docs: DataFrame, weights: Mapping | None = None, alpha: float = 0.5,
                 total_chars: float | None = None, source: str = "source",
                 text: str = "text") -> DataFrame:
    """(source, n_chars, rate). Without ``weights`` a source's weight is its size
    to the power ``alpha``, normalised; without ``total_chars`` the mix is as
    large as the input."""
    size = docs.groupBy(F.col(source).alias("source")).agg(
        F.coalesce(F.sum(F.char_length(text)), F.lit(0)).cast("double").alias("n_chars"))
    if weights is None:
        weight = F.when(F.col("n_chars") > 0, F.pow("n_chars", F.lit(float(alpha)))).otherwise(0.0)
    else:
        # chained conditions rather than a map: None is a possible source
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), float(value)).otherwise(weight)
    size = materialize(size.withColumn("weight", weight), "source-sizes")
    sums = size.agg(F.sum("weight").alias("weight"), F.sum("n_chars").alias("chars")).first()
    total = (sums.chars or 0.0) if total_chars is None else float(total_chars)
    return size.select(
        "source", "n_chars",
        F.when(F.col("n_chars") == 0, 1.0)
        .otherwise(F.col("weight") / F.lit(sums.weight or 1.0) * F.lit(total) / F.col("n_chars")).alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... copies, until the tail is below 2**-52."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    first = F.exp(-rate)
    zero = F.struct(first.alias("p"), F.array(first).alias("c"))
    return F.aggregate(
        F.sequence(F.lit(1), last), zero,
        lambda a, k: F.struct((a["p"] * rate / k).alias("p"),
                              F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * rate / k)).alias("c")),
        lambda a: a["c"])


def mix(docs: DataFrame, weights: Mapping | None = None, alpha: float = 0.5,
        total_chars: float | None = None, seed: int = 0, source: str = "source",
        text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The mix: every document as often as drawn, in a global random order.

    A sum of independent Poisson numbers is one of the sum of their rates: a rate over
    ``LARGEST_RATE`` is cut into equal parts of at most that, each drawn by a hash of its own.
    """
    taken = list(docs.columns)
    copy, copies, key = (fresh(c, taken) for c in ("copy", "n_copies", "shuffle_key"))
    name, draws, chances = (fresh(c, taken) for c in ("rate_source", "draws", "steps"))
    rates = source_rates(docs, weights, alpha, total_chars, source, text)
    parts = F.greatest(F.ceil(F.col("rate") / LARGEST_RATE), F.lit(1)).cast("int")
    table = rates.select(F.col("source").alias(name), parts.alias(draws), poisson_steps(F.col("rate") / parts).alias(chances))
    identity = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))

    def drawn_with(salt: Column) -> Column:
        uniform = hash_long(salt, identity) / F.lit(2.0 ** 52)
        return F.size(F.filter(chances, lambda c: c <= uniform)).cast("long")

    first = drawn_with(F.lit(f"draw{seed}"))
    more = F.when(F.col(draws) > 1, F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.col(draws) - 1, F.lit(1))), F.lit(0).cast("long"),
        lambda n, i: n + drawn_with(F.concat(F.lit(f"draw{seed}."), i.cast("string"))))).otherwise(0)
    if rates.count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    drawn = (docs.join(table, F.col(source).eqNullSafe(F.col(name)))
             .withColumn(copies, first + more).where(F.col(copies) > 0))
    out = drawn.select(*taken, copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(copy))
    out = out.withColumn(key, shuffle_key(seed, doc_id, F.col(copy)))
    return out.repartition(F.col(key)).sortWithinPartitions(key, copy)


def shuffle_key(seed: int, doc_id: str, copy: Column) -> Column:
    """A copy's place in the mix."""
    return hash_long(F.lit(f"order{seed}"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), copy.cast("string"))


def with_shuffle_keys(mixed: DataFrame, seed: int = 0, doc_id: str = "doc_id", text: str = "text",
                      name: str = "shuffle_key") -> DataFrame:
    """The rows of a mix that has lost its added columns, with their places in it: the copies
    of an id are numbered again, and so get the keys they had."""
    same = Window.partitionBy(doc_id).orderBy(F.xxhash64(text))
    return mixed.withColumn(name, shuffle_key(seed, doc_id, F.row_number().over(same)))
