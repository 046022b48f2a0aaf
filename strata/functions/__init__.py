"""Native Column expressions shared by all operators (no Python UDFs)."""

from strata.functions.exact import exact_avg, round_half_up
from strata.functions.predicates import all_of, contains_text, in_list
from strata.functions.text import guarded_int, hash_key, strip_ws, truncate

__all__ = [
    "all_of", "contains_text", "exact_avg", "guarded_int", "hash_key", "in_list",
    "round_half_up", "strip_ws", "truncate",
]
