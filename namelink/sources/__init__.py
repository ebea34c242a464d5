"""Reading typed inputs, publishing indexes, checking table rules."""

from .constraints import check_constraints
from .publish import StoredIndex, publish_index, read_index
from .tables import conform, load_table, seed_entities

__all__ = [
    "StoredIndex",
    "check_constraints",
    "conform",
    "load_table",
    "publish_index",
    "read_index",
    "seed_entities",
]
