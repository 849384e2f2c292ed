"""Helpers of the training-data tests."""

from collections import Counter


def rows_of(df) -> Counter:
    return Counter(str(tuple(r)) for r in df.collect())
