import pytest

from namelink.operators import lookup_claims
from namelink.plans.entity_index import build_entity_index
from namelink.schemas import CLAIM
from namelink.sources import check_constraints, publish_index, read_index, seed_entities

from helpers import rows


def test_every_publication_stays_as_it_was(spark):
    index = build_entity_index(seed_entities(spark))
    first, second = publish_index(index, 4), publish_index(index.filter("entity_id > 5"), 4)
    assert first != second  # nobody else can get a publication's name
    assert rows(read_index(spark, first).index) == rows(index)
    assert read_index(spark, second).index.filter("entity_id <= 5").isEmpty()
    assert rows(read_index(spark, publish_index(index.limit(0))).index) == []
    with pytest.raises(Exception, match="index_none"):
        read_index(spark, "index_none")


def test_common_fragments_are_dealt_to_several_buckets(spark):
    index = spark.createDataFrame([("A", n) for n in range(500)] + [("B", 1)], "phonetic_name string, entity_id bigint")
    stored = read_index(spark, publish_index(index, 4, least_share=50))
    assert rows(stored.common) == [("A", 10)]
    assert stored.rows.filter("probe = 'A'").select("slice").distinct().count() == 10
    assert rows(stored.index) == rows(index)


def test_constraints(spark):
    entities = seed_entities(spark)
    index = build_entity_index(entities)
    assert all(r["violations"] == 0 for r in check_constraints(entities, index).collect())
    broken = entities.filter("entity_id <> 8").union(entities.filter("entity_id = 1"))
    report = {r["rule"]: r["violations"] for r in check_constraints(broken, index.union(index)).collect()}
    assert report["entity primary key"] == 1
    assert report["entity_index primary key"] == 64
    assert report["entity_index.entity_id references entity"] == 6


def test_lookup_claims(spark):
    claims = spark.createDataFrame(
        [(1, "A", "x", "y", None), (2, "A", "x", "y", None), (3, "B", "x", "y", None)], CLAIM
    )
    assert rows(lookup_claims(claims, stamp_number="A"), "claim_id") == [(1,), (2,)]
    assert rows(lookup_claims(claims, claim_id=3, stamp_number="A"), "claim_id") == [(1,), (2,), (3,)]
    for missing in ({}, {"claim_id": 0}, {"claim_id": None, "stamp_number": ""}):
        with pytest.raises(ValueError):
            lookup_claims(claims, **missing)
    requests = spark.createDataFrame(
        [(10, 1, "A"), (11, 3, ""), (12, 0, "B"), (13, 9, None)],
        "request_id bigint, claim_id bigint, stamp_number string",
    )
    found = lookup_claims(claims, requests)
    assert rows(found, "request_id", "claim_id") == [(10, 1), (10, 2), (11, 3), (12, 3)]
    empty = spark.createDataFrame([(1, 0, "")], requests.schema)
    with pytest.raises(Exception, match="must be given in every request"):
        lookup_claims(claims, empty).collect()


def test_seeded_rows_keep_the_order_of_their_keys(spark):
    rest = spark.createDataFrame(
        [("T", f"v{k}", None, "t", k) for k in (7, 0, 3)],
        "entity_type string, entity_value1 string, entity_value2 string, source_table string, source_key bigint")
    found = seed_entities(spark, rest)
    assert rows(found.filter("entity_id > 11"), "entity_id", "source_key") == [(12, 0), (15, 3), (19, 7)]
    assert found.count() == 14
