from pathlib import Path

from namelink.plans.party_index import (
    build_party_index,
    read_party_index,
    refresh_party_index,
    refresh_stored_index,
    store_party_index,
)
from namelink.schemas import MEMBER, PARTY, RELATIONSHIP

from helpers import rows

KEY = ["party_id", "name_field_id", "variant", "phonetic_name", "weight"]


def people(spark, names, covered):
    parties = spark.createDataFrame([(i, f, l, None) for i, f, l in names], PARTY)
    relationships = spark.createDataFrame([(i * 10, i) for i, _, _ in names], RELATIONSHIP)
    members = spark.createDataFrame([(i * 10,) for i in covered for _ in range(2)], MEMBER)
    return parties, relationships, members


NAMES = [(1, "Corbyn", "Dallas"), (2, "Shawn", "Chandwani"), (3, None, "Severance"),
         (4, "Seever", "Sulaiman")]


def actions(changes):
    return {r["action"]: r["count"] for r in changes.groupBy("action").count().collect()}


def test_every_eligible_party_has_eight_rows(spark):
    index = build_party_index(*people(spark, NAMES, [1, 2, 3]), 7)
    assert index.count() == 24
    assert index.filter("party_id = 3 AND name_field_id = 1").select("phonetic_name").distinct() \
        .first()[0] == ""


def test_refresh_of_a_fresh_index_keeps_everything(spark):
    given = people(spark, NAMES, [1, 2, 3])
    index = build_party_index(*given, 7)
    refreshed, changes = refresh_party_index(*given, index, 8)
    assert actions(changes) == {"keep": 24}
    assert rows(refreshed) == rows(index)


def test_refresh_equals_a_rebuild_and_leaves_other_parties_alone(spark):
    old = build_party_index(*people(spark, NAMES, [1, 2, 3]), 7)
    renamed = [(1, "Corbyn", "Duvall"), *NAMES[1:]]
    given = people(spark, renamed, [1, 2, 4])
    refreshed, changes = refresh_party_index(*given, old, 8)
    run = refreshed.filter("party_id <> 3")
    assert rows(run, *KEY) == rows(build_party_index(*given, 8), *KEY)
    assert rows(refreshed.filter("party_id = 3")) == rows(old.filter("party_id = 3"))
    # DAL -> DAVAL: the full code and every fragment of the last name change
    assert actions(changes) == {"keep": 12, "update": 4, "insert": 8}
    stamps = {(r["party_id"], r["created_by"], r["modified_by"]) for r in run.collect()}
    assert stamps == {(1, 7, 7), (2, 7, 7), (4, 8, 8)}
    assert rows(refresh_party_index(*given, refreshed, 9)[0]) == rows(refreshed)


def test_fragments_of_equal_weight_are_both_kept(spark):
    old = build_party_index(*people(spark, [(1, "Severance", "Moon")], [1]), 7)
    given = people(spark, [(1, "Chandwani", "Moon")], [1])
    refreshed, _ = refresh_party_index(*given, old, 8)
    half = refreshed.filter("weight = 0.5 AND name_field_id = 1")
    assert rows(half, "variant", "phonetic_name") == [("left4", "CAND"), ("right4", "DWAN")]


def test_repeated_rows_are_deleted_and_the_right_copy_stays(spark):
    given = people(spark, NAMES[:1], [1])
    index = build_party_index(*given, 7)
    stale = index.filter("variant = 'full'").withColumn("phonetic_name", index.weight.cast("string"))
    refreshed, changes = refresh_party_index(*given, index.union(stale), 8)
    assert actions(changes) == {"keep": 8, "delete": 2}
    assert rows(refreshed) == rows(index)


def files_by_part(folder):
    return {p.name: {f.name for f in p.glob("*.parquet")} for p in Path(folder).glob("part=*")}


def test_stored_refresh_rewrites_only_what_changed(spark, tmp_path):
    folder = str(tmp_path / "index")
    names = [(i, f"Name{i % 17}", "Dallas" if i % 2 else "Moon") for i in range(1, 201)]
    given = people(spark, names, range(1, 181))
    old = build_party_index(*given, 7)
    store_party_index(old, folder, parts=16)
    before = files_by_part(folder)
    assert len(before) == 16 and rows(read_party_index(spark, folder)) == rows(old)

    assert actions(refresh_stored_index(*given, folder, 8, parts=16)) == {"keep": 1440}
    assert files_by_part(folder) == before

    renamed = [(i, "Chandwani" if i in (3, 77) else f, l) for i, f, l in names]
    changed = people(spark, renamed, [*range(1, 180), 190])
    full, changes = refresh_party_index(*changed, old, 8)
    assert rows(refresh_stored_index(*changed, folder, 8, parts=16)) == rows(changes)
    assert rows(read_party_index(spark, folder)) == rows(full)
    after = files_by_part(folder)
    touched = {part for part in before if after[part] != before[part]}
    assert after.keys() == before.keys() and 1 <= len(touched) <= 3  # parties 3, 77 and 190
    assert actions(refresh_stored_index(*changed, folder, 9, parts=16)) == {"keep": 8 * 180}
    assert files_by_part(folder) == after
