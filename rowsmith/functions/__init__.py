from rowsmith.functions.expressions import (
    hash32,
    hash_below,
    hash_bucket,
    same_value,
    tidy,
)
from rowsmith.functions.prefix import running_totals, value_counts

__all__ = [
    "value_counts",
    "hash32",
    "hash_below",
    "hash_bucket",
    "running_totals",
    "same_value",
    "tidy",
]
