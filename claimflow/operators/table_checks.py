"""Expectations on whole tables: unique keys, and keys that must stand in another table.

Both are counted by partial aggregates over the key columns alone, so a hot key
is one row per task in the shuffle. A repeated key's rows beyond the first fail; a
row whose key (or a part of it) is NULL or has no parent row fails.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bloom
from .expectations import WARN

FAIL = "fail"                       # beside WARN: the run ends before anything is published

#: Distinct parent keys whose filter is broadcast (a million words of 16 bytes); beyond, all child keys are joined.
BLOOM_KEYS = 1 << 22


@dataclass(frozen=True)
class UniqueKey:
    name: str
    columns: tuple[str, ...]
    action: str = WARN


@dataclass(frozen=True)
class Reference:
    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    action: str = WARN


def duplicate_keys(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """(key columns, n_rows) of the keys that more than one row has; NULL is a key like others."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unique_metrics(df: DataFrame, rule: UniqueKey, dataset: str) -> DataFrame:
    """One row: dataset, rule, action, passed (rows that are the first of their key), failed (the others)."""
    per_key = df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count(F.lit(1)).alias("passed"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).select(
        F.lit(dataset).alias("dataset"), F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"), "passed",
        (F.col("rows") - F.col("passed")).alias("failed"))


def orphan_counts(child: DataFrame, parent: DataFrame, columns: list[str] | tuple[str, ...],
                  parent_columns: list[str] | tuple[str, ...] | None = None,
                  bloom_keys: int | None = None) -> DataFrame:
    """(key columns, n_rows) of the child's keys without a parent row.

    The child's rows are counted by key first, so the join sees each key once. ``bloom_keys`` (the
    number of distinct parent keys, where it is known and within ``BLOOM_KEYS``) puts a Bloom filter
    of the parent's keys before the anti join: a key that it lacks is an orphan and needs no join.
    """
    parent_columns = parent_columns or columns
    keys = child.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    own = [f"parent_{c}" for c in parent_columns]
    parents = parent.select(*(F.col(c).alias(o) for c, o in zip(parent_columns, own))).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(o) for c, o in zip(columns, own)])
    if not bloom_keys:
        return keys.join(parents, same, "left_anti")
    words = bloom.words_for(bloom_keys)
    hashed = lambda df, cols: df.withColumn("bloom_key", F.when(
        reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]), F.xxhash64(*cols)))
    table = bloom.build(hashed(parents, own), "bloom_key", words)
    marked = bloom.maybe(hashed(keys, columns), "bloom_key", table, words, "maybe").drop("bloom_key")
    joined = marked.where("maybe").drop("maybe").join(parents, same, "left_anti")
    return marked.where("NOT maybe").drop("maybe").unionByName(joined)


def keys_to_filter(parent: DataFrame, columns: list[str] | tuple[str, ...]) -> int | None:
    """The number of distinct parent keys where their filter may be broadcast and they themselves may not."""
    keys = parent.select(*columns)
    bound = keys.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if int(str(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= bound:
        return None                                     # Catalyst broadcasts the keys
    n = keys.distinct().count()
    return n if 0 < n <= BLOOM_KEYS else None


def reference_metrics(child: DataFrame, parent: DataFrame, rule: Reference, dataset: str,
                      bloom_keys: int | None = None) -> DataFrame:
    """One row: dataset, rule, action, passed (rows with a parent), failed (rows without)."""
    orphans = orphan_counts(child, parent, rule.columns, rule.parent_columns, bloom_keys)
    rows = child.agg(F.count(F.lit(1)).alias("passed"), F.lit(0).cast("long").alias("failed"))
    lost = orphans.agg((-F.coalesce(F.sum("n_rows"), F.lit(0))).alias("passed"),
                       F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failed"))
    return rows.unionByName(lost).agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed")).select(
        F.lit(dataset).alias("dataset"), F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"),
        "passed", "failed")
