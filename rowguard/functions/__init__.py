"""Row-level predicates and scalar helpers (all built-in Catalyst expressions)."""

from rowguard.functions.constants import ELEVEN_YEARS_MINUTES, STATE_CODES, TAIL_NUMBER_PATTERN
from rowguard.functions.predicates import (
    all_not_null,
    col,
    data_type,
    greater_than,
    is_missing,
    is_null,
    less_than,
    minutes_between,
    never_null,
    not_in_list,
    older_than,
    outside,
    pair_not_equal,
    pair_not_greater,
    regex_mismatch,
    safe_divide,
    sql,
    value,
)

__all__ = [
    "ELEVEN_YEARS_MINUTES", "STATE_CODES", "TAIL_NUMBER_PATTERN",
    "all_not_null", "col", "data_type", "greater_than", "is_missing", "is_null",
    "less_than", "minutes_between", "never_null", "not_in_list", "older_than",
    "outside", "pair_not_equal", "pair_not_greater", "regex_mismatch",
    "safe_divide", "sql", "value",
]
