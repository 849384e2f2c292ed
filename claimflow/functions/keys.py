"""Key helpers: hashed surrogate keys, deterministic hash buckets, padded ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def surrogate_key(*cols) -> Column:
    """sha-256 hex of the ``|``-joined natural key; NULL if any part is NULL.

    ``concat_ws`` silently skips NULLs, so without the guard a NULL key would
    hash the empty string and a not-null rule on the key could never fail.
    """
    parts = [_col(c) for c in cols]
    all_present = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(all_present, F.sha2(F.concat_ws("|", *parts), 256))


def hash_unit(c) -> Column:
    """First 32 bits of md5(c) as a non-negative long in [0, 2^32)."""
    return F.conv(F.substring(F.md5(_col(c).cast("string")), 1, 8), 16, 10).cast("long")


def hash_bucket(c, n: int) -> Column:
    """Deterministic 1-based bucket in [1, n] from md5 of ``c``.

    Replaces an unseeded ``rand()`` so a retried task (or a re-run) assigns
    the same bucket to the same key.
    """
    return (F.pmod(hash_unit(c), F.lit(n)) + 1).cast("int")


def padded_bucket(prefix: str, n, width: int = 3) -> Column:
    """``prefix`` + ``lpad(n, width, '0')`` (lpad truncates, as the source does)."""
    return F.concat(F.lit(prefix), F.lpad(_col(n).cast("string"), width, "0"))
