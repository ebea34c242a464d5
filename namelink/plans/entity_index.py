"""Build the phonetic index of entities."""

from pyspark.sql import functions as F

from ..functions import nysiis
from ..operators import distinct_fragments, encode_once, without_empty_codes
from ..schemas import ENTITY_INDEX


def encode_entities(entities):
    """(entity_id, code1, code2); a missing second value encodes to ``''``."""
    return entities.select(
        "entity_id",
        nysiis("entity_value1").alias("code1"),
        nysiis("entity_value2").alias("code2"),
    )


def build_entity_index(entities, by_name=False):
    """Index rows (phonetic_name, name_field_id, weight, entity_id), no empty code.

    One narrow stage: encode, explode, drop duplicates within the entity. With ``by_name``
    each distinct name is encoded once and its code joined back, which pays where names
    repeat so much that encoding costs more than two shuffles.
    """
    if by_name:
        encoded = encode_once(entities, "entity_id", {"code1": "entity_value1", "code2": "entity_value2"})
    else:
        encoded = encode_entities(entities)
    rows = distinct_fragments(encoded, "entity_id", "code1", "code2")
    return without_empty_codes(rows).select(*ENTITY_INDEX.names)


def index_preview(fragments):
    """Distinct non-empty rows of raw fragments, as shown before publishing."""
    return without_empty_codes(fragments).distinct()
