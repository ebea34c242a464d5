import random

import duckdb
import pytest

from namelink.operators.components import connected_components
from namelink.operators.spread import spread_join
from namelink.plans.duplicates import (
    distinct_names,
    duplicate_clusters,
    duplicate_pairs,
    merge_duplicates,
    merge_links,
    near_names,
    same_code_names,
)
from namelink.plans.entity_index import build_entity_index, encode_entities
from namelink.schemas import ENTITY

from helpers import edit_distance, rows


def entities(spark, values):
    return spark.createDataFrame(
        [(i, t, a, b, "t", 100 + i) for i, (t, a, b) in enumerate(values)], ENTITY
    )


def union_find(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("distance", [1, 2])
def test_pairs_agree_with_brute_force(spark, distance):
    rng = random.Random(7)
    base = ["Klueppel", "Klappel", "Austin", "Austyn", "Moon", "Mon", "Duvall", "Duval"]

    def value():
        text = rng.choice(base)
        if rng.random() < 0.4:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", "x", "an"]) + text[at + 1:]
        return text if rng.random() < 0.8 else text.upper()

    values = [(rng.choice("AB"), value(), rng.choice([None, value()])) for _ in range(70)]
    frame = entities(spark, values)
    fragments = {}
    for r in build_entity_index(frame).collect():
        fragments.setdefault(r["entity_id"], set()).add(r["phonetic_name"])
    names = {}
    for i, (t, a, b) in enumerate(values):
        names.setdefault((t, a.upper(), (b or "").upper()), []).append(i)
    expected = [(ids[0], i, 0) for ids in names.values() for i in ids[1:]]
    firsts = [(ids[0], k[0], " ".join(filter(None, k[1:]))) for k, ids in names.items()]
    for i, t, a in firsts:
        for j, u, b in firsts:
            if i < j and t == u and fragments.get(i, set()) & fragments.get(j, set()):
                d = edit_distance(a, b)
                if d <= distance:
                    expected.append((i, j, d))
    by_code = {}
    for r in encode_entities(frame).collect():
        by_code.setdefault((values[r["entity_id"]][0], r["code1"], r["code2"]), []).append(r["entity_id"])
    texts = {i: a for i, _, a in firsts}
    for ids in by_code.values():
        first, *others = sorted(i for i in ids if i in texts)
        expected += [(first, i, edit_distance(texts[i], texts[first])) for i in others]
    expected = set(expected)
    assert rows(duplicate_pairs(frame, distance)) == sorted(expected, key=repr)
    label = union_find(range(len(values)), [(a, b) for a, b, _ in expected])
    assert rows(duplicate_clusters(frame, distance)) == sorted(label.items(), key=repr)


def all_near(texts, distance):
    con = duckdb.connect()
    con.execute("CREATE TABLE names (i BIGINT, t VARCHAR)")
    con.executemany("INSERT INTO names VALUES (?, ?)", list(enumerate(texts)))
    return con.execute(
        "SELECT a.i, b.i, levenshtein(a.t, b.t) AS d FROM names a JOIN names b ON a.i < b.i WHERE d <= ?", [distance]
    ).fetchall()


def as_names(spark, texts):
    """Names of one code, so that only the distance decides."""
    return spark.createDataFrame(
        [("T", n, t, "SAME", "") for n, t in enumerate(texts)],
        "entity_type string, name_id bigint, text string, code1 string, code2 string",
    )


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text) + 1)
        text = rng.choice([text[:at] + "x" + text[at:], text[:at] + text[at + 1:], text[:at] + "y" + text[at + 1:]])
    return text


@pytest.mark.parametrize("common_piece", [256, 4])
@pytest.mark.parametrize(("distance", "size"), [(1, 12), (2, 5), (3, 7), (3, 40)])
def test_near_names_of_any_length(spark, distance, size, common_piece):
    if size == 40 and common_piece == 4:
        size = 16  # what is left of long names after three deletions is tried on shorter ones
    rng = random.Random(size)
    base = ["".join(rng.choices("abcdefg", k=size)) for _ in range(6)]
    texts = sorted({edited(rng, rng.choice(base), rng.randint(0, distance + 1)) for _ in range(45)} | {"", "a", "ab", "abc"})
    assert rows(near_names(as_names(spark, texts), distance, common_piece)) == sorted(all_near(texts, distance), key=repr)


def test_common_pieces_do_not_pair_all_with_all(spark):
    """Names that differ in a number only share most pieces; few of them are near."""
    texts = [f"CUSTOMER NUMBER {n:06d}" for n in random.Random(4).sample(range(10**6), 600)]
    assert rows(near_names(as_names(spark, texts), 1, 16)) == sorted(all_near(texts, 1), key=repr)


def test_names_of_one_code_are_linked_to_the_first(spark):
    spelt = [("A", "Klueppel", None), ("A", "Klappel", None), ("B", "Klappel", None), ("A", "???", None), ("A", "!!", None)]
    frame = entities(spark, spelt + [("A", "M" + v * n + "n", None) for n in range(1, 41) for v in "aeiou"])
    linked = rows(same_code_names(distinct_names(frame)))
    assert (0, 1, 2) in linked and not any({2, 3, 4} & set(link[:2]) for link in linked)
    many = [link for link in linked if link[0] != 0]
    assert len(many) == 199 and {link[0] for link in many} == {5}
    assert rows(duplicate_clusters(frame), "entity_id", "cluster_id")[:2] == [(0, 0), (1, 0)]


def test_a_common_key_is_dealt_to_several_tasks(spark):
    given = spark.createDataFrame([("hot", n) for n in range(5000)] + [("a", 1), ("b", 2), ("c", 3)], "k string, id bigint")
    per_key = spark.createDataFrame([("hot", 5000, "x"), ("a", 1, "y"), ("b", 1, None)], "k string, n bigint, v string")
    joined = spread_join(given, per_key, ["k"], "n", 5003, "id")
    assert joined.groupBy("k", "v").count().orderBy("k").collect() == [("a", "y", 1), ("b", None, 1), ("hot", "x", 5000)]
    left = spread_join(given, per_key.filter("n > 1"), ["k"], "n", 5003, "id", "left")
    assert rows(left.groupBy("v").count()) == [("x", 5000), (None, 3)]


def test_copies_give_one_link_each(spark):
    frame = entities(spark, [("A", "Same", "Name")] * 200 + [("A", "Other", None)])
    pairs = duplicate_pairs(frame)
    assert pairs.count() == 199
    assert pairs.filter("left_id <> 0").isEmpty()


def test_merge_keeps_the_smallest_id_and_longest_values(spark):
    frame = entities(spark, [("A", "Dallas", None), ("A", "Dalla", None), ("A", "DALLAS", None),
                             ("B", "Dallas", None)])
    merged = merge_duplicates(frame, duplicate_clusters(frame))
    assert rows(merged) == [(0, "A", "DALLAS", None, "t", 100, 3), (3, "B", "Dallas", None, "t", 103, 1)]


def test_merge_names_the_members(spark):
    frame = entities(spark, [("A", "Dallas", None), ("B", "Dallas", None), ("A", "Dalla", None), ("A", "DALLAS", None)])
    merged = merge_duplicates(frame, duplicate_clusters(frame), with_members=True)
    assert rows(merged, "entity_id", "n_members", "member_ids") == [(0, 3, [0, 2, 3]), (1, 1, [1])]


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(8)
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 80)]
    noise = [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    links = chain + star + noise
    rng.shuffle(links)
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    label = union_find({n for link in links for n in link}, links)
    expected = sorted([(n, c) for n, c in label.items() if n != c], key=repr)
    assert rows(connected_components(frame, "a", "b")) == expected


def test_links_are_merged_into_stored_clusters(spark):
    rng = random.Random(13)
    nodes = range(120)
    old = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(40)]
    new = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(25)] + [(500, 3), (501, 502), (503, 503)]
    before = union_find(nodes, old)
    after = union_find([*nodes, 500, 501, 502, 503], old + new)
    stored = spark.createDataFrame(list(before.items()), "entity_id bigint, cluster_id bigint")
    links = spark.createDataFrame(new, "left_id bigint, right_id bigint")
    merged, changed = merge_links(stored, links)
    assert rows(merged) == sorted(after.items(), key=repr)
    assert rows(changed) == sorted([(n, c) for n, c in after.items() if before.get(n, n) != c], key=repr)
    again, changed = merge_links(merged, links)
    assert changed.isEmpty() and rows(again) == rows(merged)
    assert rows(merge_links(stored, links.limit(0))[0]) == rows(stored)
