"""Column helpers (P3, P5, P7–P12) and window assignment."""

from kairo.functions.scalar import (
    fahrenheit_to_celsius, split_explode, abs_diff, pair_max, pair_min,
    tuple_of, message, bucket_start,
)
from kairo.functions.windowing import tumbling, assign_windows

__all__ = [
    "fahrenheit_to_celsius", "split_explode", "abs_diff", "pair_max", "pair_min",
    "tuple_of", "message", "bucket_start", "tumbling", "assign_windows",
]
