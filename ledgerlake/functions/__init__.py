"""Column-expression helpers (all Catalyst built-ins, no UDFs)."""

from .text import (java_trim, empty_if_null, normalise_header, ordered_text, zero_pad,
                   statement_ref_prefix, statement_ref, truncate_error,
                   words_match, includes_words, excludes_words)
from .keys import incoming_dedup_key, stored_dedup_key
from .numbers import (to_decimal, decimal_status, strip_zeros, money_text,
                      price_text, round_half_up)
from .ids import stable_id

__all__ = [
    "java_trim", "empty_if_null", "normalise_header", "ordered_text", "zero_pad",
    "statement_ref_prefix", "statement_ref", "truncate_error", "words_match",
    "includes_words", "excludes_words", "incoming_dedup_key", "stored_dedup_key",
    "to_decimal", "decimal_status", "strip_zeros", "money_text", "price_text",
    "round_half_up", "stable_id",
]
