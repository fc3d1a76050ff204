from raresight.functions.columns import (
    hash_hex,
    hash_uniform,
    hour_of_day,
    instant_to_ntz,
    label_flag,
    linspace_value,
    micros_between,
    ntz_to_instant,
    null_safe_join,
    safe_div,
    seconds_between,
)

__all__ = [
    "hash_hex", "hash_uniform", "hour_of_day", "instant_to_ntz", "ntz_to_instant", "label_flag", "linspace_value",
    "micros_between", "null_safe_join", "safe_div", "seconds_between",
]
