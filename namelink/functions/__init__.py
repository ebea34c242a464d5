"""Column functions: text, phonetic code, distances."""

from .distance import (
    dob_distance,
    levenshtein_sql,
    levenshtein_strict,
    match_score,
    name_distance,
    total_distance,
)
from .phonetic import fragment_columns, nysiis
from .text import (
    bind,
    display_name,
    dob_parts,
    dob_text,
    name_alias,
    remove_special_chars,
    split_tokens,
    strip_name_suffix,
)

__all__ = [
    "bind",
    "display_name",
    "dob_distance",
    "dob_parts",
    "dob_text",
    "fragment_columns",
    "levenshtein_sql",
    "levenshtein_strict",
    "match_score",
    "name_alias",
    "name_distance",
    "nysiis",
    "remove_special_chars",
    "split_tokens",
    "strip_name_suffix",
    "total_distance",
]
