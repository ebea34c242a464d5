"""Free-text search over indexed entities, many search terms per job.

A result row is the best index row (highest weight) per search and displayed value
(type, value 1, value 2).

Of the index rows with one fragment only the best one of a value can be its best match, so the
others are dropped before any term meets them: the hits grow with the values, not with all
rows that repeat them. Hits of a published index, which knows no values, are first cut to the
best one per search and entity. Where many batches are searched, the index can be prepared
once: each row lists the codes that outrank it within its value, so that the join itself
yields each (search, value) pair once and no shuffle follows it.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import display_name, levenshtein_sql, nysiis
from ..operators import contains_join, contains_stored, length_directory, without_empty_codes
from ..sources.publish import StoredIndex

VALUE = ["entity_type", "entity_value1", "entity_value2"]


def encoded_terms(terms):
    """Echo of each search term with its code."""
    return terms.select("query_id", "search_term", nysiis("search_term").alias("code"))


def entity_index_join(entities, index):
    """Entities with their non-empty index rows."""
    return entities.select("entity_id", *VALUE).join(
        without_empty_codes(index), "entity_id"
    )


def _rank_key():
    return F.struct(
        (-F.col("weight")).alias("minus_weight"), "name_field_id", "entity_id", "phonetic_name"
    )


def _unpack(best):
    return [
        best["entity_id"].alias("entity_id"),
        best["phonetic_name"].alias("phonetic_name"),
        best["name_field_id"].alias("name_field_id"),
        (-best["minus_weight"]).cast("decimal(18,3)").alias("weight"),
    ]


def _best_per_code(entities, index):
    return entity_index_join(entities, index).groupBy(*VALUE, "phonetic_name").agg(F.min(_rank_key()).alias("best"))


def best_rows(entities, index):
    """The best index row of each displayed value and fragment."""
    return _best_per_code(entities, index).select(*VALUE, *_unpack(F.col("best")))


def prepare_entity_search(entities, index):
    """One row per (value, code) with the better codes of the same value.

    Worth writing once, bucketed by phonetic_name, when many batches are searched.
    """
    best = _best_per_code(entities, index).select(*VALUE, "best")
    ranked = Window.partitionBy(*VALUE).orderBy("best")
    return best.select(
        *VALUE,
        *_unpack(F.col("best")),
        F.collect_list(F.col("best.phonetic_name"))
        .over(ranked.rowsBetween(Window.unboundedPreceding, -1)).alias("better_codes"),
    )


def _best_by_rank(matches, keys):
    return (
        matches.groupBy(*keys)
        .agg(F.min(_rank_key()).alias("best"))
        .select(*keys, *_unpack(F.col("best")))
    )


def best_fragment_per_entity(matches, search=("query_id",)):
    """Best matched index row per search and displayed value, from all matches."""
    return _best_by_rank(matches, [*search, *VALUE])


def matched_rows(encoded, entities, index):
    """Matches of encoded terms with the best index row of each (value, fragment)."""
    directory = length_directory(without_empty_codes(index))
    return contains_join(encoded, best_rows(entities, index), directory=directory)


def search_index(encoded, entities, index):
    """Best index row per (search, value) of encoded terms; the index may be a published one."""
    search = ("query_id", "search_term")
    if isinstance(index, StoredIndex):
        hits = contains_stored(encoded, index).groupBy(*search, "entity_id").agg(F.min(_rank_key()).alias("best"))
        matches = entity_index_join(entities, hits.select(*search, *_unpack(F.col("best"))))
    else:
        matches = matched_rows(encoded, entities, index)
    return best_fragment_per_entity(matches, search)


def search_prepared(encoded, prepared):
    """Best index row per (search, value) for encoded terms, from a prepared index."""
    columns = ["query_id", "search_term", *VALUE,
               "entity_id", "phonetic_name", "name_field_id", "weight"]
    return contains_join(encoded, prepared).filter(
        ~F.exists("better_codes", lambda better: F.contains(F.col("code"), better))
    ).select(columns)


def with_distance(best, term="search_term"):
    return best.withColumn("row_id", F.lit(1)).withColumn(
        "distance",
        levenshtein_sql(term, display_name("entity_value1", "entity_value2")),
    )


def find_entity_matches(terms, entities, index):
    """Matching entities of each search term (query_id, search_term) with distance."""
    best = search_index(encoded_terms(terms), entities, index)
    return with_distance(best).select(
        "query_id", "entity_id", *VALUE, "phonetic_name", "name_field_id", "weight",
        "row_id", "distance",
    )


def sorted_matches(matches):
    """Presentation order: nearest first within each search."""
    return matches.orderBy("query_id", "distance", F.desc("weight"), "name_field_id", "entity_id")
