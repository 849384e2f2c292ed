from .keys import hash_bucket, hash_unit, padded_bucket, surrogate_key
from .numeric import days_between, ratio, ratio_or_zero, round_cents, round_half_up
from .text import canonical_value, join_texts, keep_digits, split_texts

__all__ = [
    "hash_bucket", "hash_unit", "padded_bucket", "surrogate_key",
    "days_between", "ratio", "ratio_or_zero", "round_cents", "round_half_up",
    "canonical_value", "join_texts", "keep_digits", "split_texts",
]
