"""Turn encoded names into weighted index rows in one narrow pass."""

from pyspark.sql import functions as F

from ..functions import fragment_columns
from ..schemas import FIRST_FIELD, SECOND_FIELD, VARIANT_WEIGHTS, WEIGHT


def _fragment_structs(first_code, second_code, with_variant):
    for field, code in ((FIRST_FIELD, first_code), (SECOND_FIELD, second_code)):
        for variant, fragment in fragment_columns(code).items():
            yield F.struct(
                fragment.alias("phonetic_name"),
                F.lit(field).alias("name_field_id"),
                *([F.lit(variant).alias("variant")] if with_variant else []),
                F.lit(VARIANT_WEIGHTS[variant]).cast(WEIGHT).alias("weight"),
            )


def fragment_union(encoded, id_column, first_code, second_code):
    """All eight (fragment, field, variant, weight) rows of every id."""
    rows = F.array(*_fragment_structs(F.col(first_code), F.col(second_code), True))
    return encoded.select(id_column, F.inline(rows))


def distinct_fragments(encoded, id_column, first_code, second_code):
    """Distinct (fragment, field, weight) rows of every id.

    Rows of different ids never coincide, so duplicates are dropped inside each row's
    own array and no shuffle is needed; ``id_column`` must be unique.
    """
    rows = F.array(*_fragment_structs(F.col(first_code), F.col(second_code), False))
    return encoded.select(id_column, F.inline(F.array_distinct(rows)))


def without_empty_codes(index):
    return index.filter(F.nullif(F.col("phonetic_name"), F.lit("")).isNotNull())
