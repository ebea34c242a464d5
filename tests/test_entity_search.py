import random

import pytest
from pyspark.sql import functions as F

from namelink.operators import contains_join, contains_stored, length_directory, substrings
from namelink.operators.dictionary import name_dictionary
from namelink.plans.entity_index import build_entity_index
from namelink.plans.entity_search import (
    best_fragment_per_entity,
    encoded_terms,
    entity_index_join,
    find_entity_matches,
    matched_rows,
    prepare_entity_search,
    search_index,
    search_prepared,
    sorted_matches,
)
from namelink.schemas import ENTITY, ENTITY_INDEX
from namelink.sources import publish_index, read_index, seed_entities

from helpers import plan, rows


def search_terms(spark, *terms):
    return spark.createDataFrame(list(enumerate(terms)), "query_id bigint, search_term string")


def test_seed_search(spark):
    entities = seed_entities(spark)
    index = build_entity_index(entities)
    assert index.count() == 64
    assert index.distinct().count() == 64
    found = find_entity_matches(search_terms(spark, "Austin Dallas"), entities, index)
    got = [(r["entity_id"], r["distance"]) for r in sorted_matches(found).collect()]
    assert got[0] == (1, 5)
    assert sorted(got[1:]) == [(5, 7), (6, 7), (8, 7)]


def test_building_the_index_needs_no_shuffle(spark):
    assert "Exchange" not in plan(build_entity_index(seed_entities(spark)))


def test_each_name_is_encoded_once(spark):
    values = [("Dallas", None)] * 3000 + [("Moon", "Dallas"), ("Cook", "Cook"), ("", "S")]
    entities = spark.createDataFrame([(i, "T", a, b, "t", i) for i, (a, b) in enumerate(values)], ENTITY)
    assert rows(name_dictionary(entities, ["entity_value1", "entity_value2"])) == [
        ("", "", 1), ("Cook", "CAC", 2), ("Dallas", "DAL", 3001), ("Moon", "MAN", 1), ("S", "", 1)]
    assert rows(build_entity_index(entities, by_name=True)) == rows(build_entity_index(entities))
    assert rows(build_entity_index(entities.limit(0), by_name=True)) == []


def test_contains_join_equals_the_naive_join(spark):
    rng = random.Random(2)
    codes = {"".join(rng.choices("ABCN", k=rng.randint(0, 7))) for _ in range(60)}
    queries = spark.createDataFrame([(c,) for c in sorted(codes)], "code string")
    pieces = {"".join(rng.choices("ABCN", k=rng.randint(1, 4))) for _ in range(60)}
    index = spark.createDataFrame([(p,) for p in sorted(pieces)], "phonetic_name string")
    naive = sorted((c, p) for c in codes for p in pieces if p in c)
    joined = contains_join(queries, index)
    assert rows(joined) == naive
    assert "SortMergeJoin" in plan(joined)


def test_long_codes_and_long_fragments(spark):
    rng = random.Random(9)
    codes = ["".join(rng.choices("ABCN", k=n)) for n in (0, 1, 31, 32, 33, 200, 400)]
    pieces = {c[a:a + n] for c in codes for a in (0, 3, 50) for n in (1, 5, 31, 32, 33, 40, 120)} - {""}
    pieces |= {p[:-1] + "X" for p in pieces} | {codes[-1] * 2}
    queries = spark.createDataFrame([(c,) for c in codes], "code string")
    index = spark.createDataFrame([(p, n) for n, p in enumerate(sorted(pieces))], "phonetic_name string, id int")
    naive = sorted((c, p) for c in codes for p in pieces if p in c)
    assert rows(contains_join(queries, index), "code", "phonetic_name") == naive
    stored = read_index(spark, publish_index(index, 3, least_share=1))
    assert rows(contains_stored(queries, stored), "code", "phonetic_name") == naive
    assert rows(stored.index) == rows(index)


def test_probes_grow_with_the_code_not_with_its_square(spark):
    index = spark.createDataFrame([("AB",), ("ABCAB",), ("B",), ("A" * 5000,)], "phonetic_name string")
    code = "".join(random.Random(1).choices("ABC", k=10_000))
    one = spark.createDataFrame([(code,), ("",)], "code string").withColumn("lengths", length_directory(index))
    probes = one.select(F.size(substrings(F.col("code"), F.col("lengths"))).alias("n")).collect()
    assert probes[0]["n"] <= 3 * len(code) and probes[1]["n"] == 0
    assert contains_join(one.select("code"), index).count() == 3


def test_a_stored_index_is_not_shuffled(spark):
    entities = seed_entities(spark)
    stored = read_index(spark, publish_index(build_entity_index(entities)))
    terms = search_terms(spark, "Austin Dallas", "Moon")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = contains_stored(encoded_terms(terms), stored)
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    side = text[text.index("SortMergeJoin"):].split("phonetic_name")[0]
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert text.count("Exchange hashpartitioning") == 1, side
    found = find_entity_matches(terms, entities, stored)
    assert rows(found) == rows(find_entity_matches(terms, entities, build_entity_index(entities)))


def test_equal_values_collapse_and_hot_copies_stay_one_row(spark):
    copies = [(i, "Loan Officer", "Auston", "Matthew", "t", i) for i in range(1, 301)]
    other = [(900, "County", "Dallas", None, "t", 900)]
    entities = spark.createDataFrame(copies + other, ENTITY)
    found = find_entity_matches(
        search_terms(spark, "Austin Dallas", "", None), entities, build_entity_index(entities)
    )
    assert rows(found, "query_id", "entity_id", "row_id") == [(0, 1, 1), (0, 900, 1)]


def test_stale_index_with_many_codes_per_value(spark):
    """More codes than one value has of its own: the aggregated path must agree."""
    rng = random.Random(3)
    entities = spark.createDataFrame(
        [(i, "T", "Same", "Value", "t", i) for i in range(40)]
        + [(100, "T", "Other", None, "t", 100)], ENTITY,
    )
    weights = ["1.000", "0.900", "0.500"]
    index = spark.createDataFrame(
        [("".join(rng.choices("ASTN", k=rng.randint(1, 3))), rng.randint(1, 2),
          rng.choice(weights), i) for i in list(range(40)) * 3 + [100]],
        "phonetic_name string, name_field_id int, w string, entity_id bigint",
    ).withColumn("weight", F.col("w").cast("decimal(18,3)")).select(*ENTITY_INDEX.names)
    terms = search_terms(spark, "Austin", "Stan", "Nat", "Anst", "T")
    encoded = encoded_terms(terms)
    fast = search_prepared(encoded, prepare_entity_search(entities, index))
    slow = best_fragment_per_entity(contains_join(encoded, entity_index_join(entities, index)))
    assert prepare_entity_search(entities, index).agg(F.max(F.size("better_codes"))).first()[0] >= 8
    assert rows(fast, *slow.columns) == rows(slow)
    assert slow.count() > 3


def test_search_plan(spark):
    entities = seed_entities(spark)
    found = find_entity_matches(search_terms(spark, "Dallas"), entities, build_entity_index(entities))
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "EvalPython" not in text and "InPandas" not in text


def test_rows_that_repeat_a_value_make_no_more_matches(spark):
    """Copies of a value and weaker rows of one fragment are dropped before a term meets them."""
    entities = spark.createDataFrame(
        [(n, "T", "Dallas", None, "t", n) for n in range(1, 201)] + [(201, "T", "Cook", None, "t", 201)], ENTITY)
    index = build_entity_index(entities).unionByName(build_entity_index(entities).withColumn("name_field_id", F.lit(2)))
    terms = spark.createDataFrame([(1, "Austin Dallas"), (2, "Cook")], "query_id bigint, search_term string")
    encoded = encoded_terms(terms)
    every = contains_join(encoded, entity_index_join(entities, index))
    matched = matched_rows(encoded, entities, index)
    assert every.count() > 1000 and matched.count() <= 8
    assert rows(best_fragment_per_entity(matched)) == rows(best_fragment_per_entity(every))
    expected = rows(best_fragment_per_entity(every, ("query_id", "search_term")))
    assert rows(search_index(encoded, entities, index)) == expected
    for spread_by in (None, ["entity_id"]):
        stored = read_index(spark, publish_index(index, 3, least_share=20, spread_by=spread_by))
        assert rows(search_index(encoded, entities, stored)) == expected
