"""DataFrame operators the index builders and searches are made of."""

from .aliases import apply_alias_rules
from .contains import contains_join, contains_stored, length_directory, substrings
from .dictionary import encode_once
from .fragments import distinct_fragments, fragment_union, without_empty_codes
from .index_diff import index_changed, index_new_rows, index_stale, index_unchanged
from .people import (
    dob_gate_join,
    eligible_fanout,
    eligible_parties,
    lookup_claims,
)
from .ranking import (
    match_rank,
    top_candidates,
    top_n,
    top_rows,
)

__all__ = [
    "apply_alias_rules",
    "contains_join",
    "contains_stored",
    "distinct_fragments",
    "dob_gate_join",
    "eligible_fanout",
    "eligible_parties",
    "encode_once",
    "fragment_union",
    "index_changed",
    "index_new_rows",
    "index_stale",
    "index_unchanged",
    "length_directory",
    "lookup_claims",
    "match_rank",
    "substrings",
    "top_candidates",
    "top_n",
    "top_rows",
    "without_empty_codes",
]
