import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from namelink import catalog
from namelink.functions.distance import least_distance, letter_set, levenshtein_compared
from namelink.operators import dob_gate_join, top_n
from namelink.plans import claim_search
from namelink.plans.claim_search import find_party_matches
from namelink.plans.party_index import build_party_index
from namelink.schemas import CLAIM, MEMBER, PARTY, RELATIONSHIP
from namelink.sources import publish_index, read_index

from helpers import plan, rows

D = datetime.date
PARTIES = [
    (1, "JOSE FELIX", "VALDERRAMA-LOPEZ", D(1971, 5, 20)),
    (2, "JESSE", "JAMES", D(1955, 9, 5)),
    (3, "TIMOTHY", "MOORE", D(1980, 1, 31)),
    (4, "JUAN", "DAVILA", D(1964, 12, 2)),
    (5, "MARIA", "KNOPFEL", D(1990, 7, 14)),
    (6, "MARIO", "ROMERO", D(1990, 7, 14)),
]


def setup(spark, parties=PARTIES, memberships=1):
    ids = [p[0] for p in parties]
    frames = (
        spark.createDataFrame(parties, PARTY),
        spark.createDataFrame([(i, i) for i in ids], RELATIONSHIP),
        spark.createDataFrame([(i,) for i in ids for _ in range(memberships)], MEMBER),
    )
    return *frames, build_party_index(*frames, 1)


def search(spark, claims, given=None, **options):
    frame = spark.createDataFrame(
        [(n, f"PC{n}", last, first, dob) for n, (first, last, dob) in enumerate(claims)], CLAIM
    )
    found = find_party_matches(frame, *(given or setup(spark)), **options)
    best = defaultdict(list)
    for r in found.orderBy("claim_id", "rank").collect():
        best[r["claim_id"]].append(r["party_id"])
    return [best[n] for n in range(len(claims))]


def test_scenarios(spark):
    exact, wrong_day, misspelt, swapped, joined, alias, no_dob, initials, one_empty = search(spark, [
        ("JUAN", "DAVILA", D(1964, 12, 2)),
        ("JUAN", "DAVILA", D(1964, 12, 3)),
        ("MARIA", "KNOPPFEL", D(1990, 7, 15)),
        ("DAVILA", "JUAN", D(1964, 12, 2)),
        ("JOSEFELIX", "VALDERRAMALOPEZ", D(1971, 5, 20)),
        ("", "Federal Bureau", D(1955, 9, 5)),
        ("JUAN", "DAVILA", None),
        ("T", "M", D(1980, 1, 31)),
        ("S", "MOORE", D(1980, 1, 31)),
    ])
    assert [m[0] for m in (exact, wrong_day, misspelt, swapped, joined, alias)] == [4, 4, 5, 4, 1, 2]
    assert no_dob == [] and initials == [] and one_empty == []


def test_equal_claims_share_one_search(spark):
    claim = ("JUAN", "DAVILA", D(1964, 12, 2))
    got = search(spark, [claim] * 50)
    assert got == [got[0]] * 50 and got[0][0] == 4


def test_quantity_and_empty_codes(spark):
    parties = [*PARTIES, (7, None, "QQQ", D(1964, 1, 1)), (8, "JUANA", "DAVILLA", D(1964, 3, 3))]
    claim = [("JUAN", "DAVILA", D(1964, 12, 2))]
    given = setup(spark, parties)
    assert search(spark, claim, given) == [[4, 8]]
    assert search(spark, claim, given, quantity=1) == [[4]]
    literal = search(spark, claim, given, keep_empty_codes=True)
    assert sorted(literal[0]) == [4, 7, 8]


def brute_force(claims, parties, index, n_members, limit, quantity):
    """Rank parties claim by claim from (claim, codes) and raw index rows."""
    from helpers import edit_distance

    fragments = defaultdict(list)
    for r in index:
        if r["phonetic_name"]:
            fragments[r["party_id"]].append(r)
    out = []
    for c in claims:
        scored = []
        for p in parties.values():
            a, b = p["dob"], c["claim_dob"]
            if a is None or not (a.year == b.year or a.month == b.month or a.day == b.day):
                continue
            groups = defaultdict(list)
            for r in fragments[p["party_id"]]:
                if r["phonetic_name"] in c["last_code"] or r["phonetic_name"] in c["first_code"]:
                    groups[r["weight"]].append(r["name_field_id"])
            for w, fields in groups.items():
                score = w * (len(set(fields)) + n_members * len(fields))
                scored.append((-score, -w, p["party_id"]))
        best = {}
        for s, _, pid in sorted(scored)[:limit]:
            p = parties[pid]

            def d(x, y):
                return edit_distance(x.upper(), y.upper())

            direct = d(p["first_name"], c["claim_first"]) + d(p["last_name"], c["claim_last"])
            swapped = d(p["first_name"], c["claim_last"]) + d(p["last_name"], c["claim_first"])
            days = d(p["dob"].isoformat(), c["claim_dob"].isoformat())
            total = min(direct, swapped) + 2 * days + 10 + s
            best[pid] = min(total, best.get(pid, total))
        ranked = sorted((t, pid) for pid, t in best.items())[:quantity]
        out += [(c["claim_id"], n, pid) for n, (_, pid) in enumerate(ranked, start=1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [1, 7, None])
def test_limits_agree_with_brute_force(spark, limit):
    """One name holds a third of all parties; the limit cuts through ties."""
    rng = random.Random(5)
    firsts = ["JUAN", "MARIA", "ANNA", "HANNAH", "SEEVER", "THEODORE", "ANN"]
    lasts = ["DAVILA", "ROMERO", "KNOPFEL", "DUVALL", "SULAIMAN", "MOON", "CHANDWANI"]

    def person():
        return rng.choice(firsts), rng.choice(lasts), D(1960 + rng.randint(0, 4), rng.randint(1, 12), rng.randint(1, 28))

    parties = [(i, *(("JUAN", "DAVILA", D(1960, 1, 1)) if i % 3 == 0 else person()))
               for i in range(1, 91)]
    given = setup(spark, parties, memberships=2)
    claims = spark.createDataFrame(
        [(n, f"PC{n}", last, first, dob) for n, (first, last, dob) in
         enumerate([("JUAN", "DAVILA", D(1960, 1, 1)), *(person() for _ in range(12))])], CLAIM,
    )
    expected = brute_force(
        claim_search.encode_claims(claims).collect(),
        {p["party_id"]: p for p in given[0].collect()}, given[3].collect(), 2, limit, 6,
    )
    found = find_party_matches(claims, *given, quantity=6, candidate_limit=limit)
    assert rows(found, "claim_id", "rank", "party_id") == expected


def test_an_index_is_searched_as_it_is_stored(spark):
    """Unknown variants and fields, any weight, repeated rows, rows of other parties."""
    rng = random.Random(11)
    given = setup(spark, [(i, rng.choice(["JUAN", "ANNA", "THEODORE"]), rng.choice(["DAVILA", "MOON", "ROMERO"]),
                           D(1960, rng.randint(1, 12), rng.randint(1, 28))) for i in range(1, 41)], memberships=3)
    pieces = ["J", "JA", "JAN", "AN", "DAVAL", "VAL", "MAN", "RANAR", "T", "TADAR", "ADA", ""]
    weights = ["0.300", "7.125", "1.000", "0.000", "-0.500", "12345678.900"]
    odd = spark.createDataFrame(
        [(rng.randint(1, 60), rng.choice(pieces), rng.choice([1, 2, 3, 9]), rng.choice(["left3", "full", "x"]),
          rng.choice(weights)) for _ in range(300)] * 2,
        "party_id bigint, phonetic_name string, name_field_id int, variant string, w string",
    ).selectExpr("party_id", "phonetic_name", "name_field_id", "variant", "cast(w as decimal(18,3)) weight",
                 "1 created_by", "1 modified_by")
    claims = spark.createDataFrame(
        [(n, f"PC{n}", last, first, D(1960, n % 12 + 1, 5)) for n, (first, last) in
         enumerate([("JUAN", "DAVILA"), ("ANNA", "MOON"), ("THEODORE", "ROMERO"), ("MOON", "ANNA"), ("JUANA", "ROMERA")])], CLAIM)
    for limit in (None, 4):
        expected = brute_force(
            claim_search.encode_claims(claims).collect(), {p["party_id"]: p for p in given[0].collect()},
            odd.collect(), 3, limit, 6,
        )
        found = find_party_matches(claims, *given[:3], odd, quantity=6, candidate_limit=limit)
        assert rows(found, "claim_id", "rank", "party_id") == expected
    stored = read_index(spark, publish_index(odd, 3, least_share=5))
    assert rows(stored.index) == rows(odd)


def test_bounds_drop_no_wanted_party(spark, sf_dir):
    encoded, prepared = catalog.searches_and_parties(spark, sf_dir)
    searches = claim_search.distinct_searches(encoded)
    exact = claim_search.totals_per_pair(claim_search.candidate_pairs(searches, prepared))
    for quantity in (2,):
        bounded = claim_search.with_bound(searches, prepared, quantity)
        assert not bounded.filter("most_total is not null").isEmpty()
        near = claim_search.nearest_parties(searches, prepared, quantity)
        assert rows(near, "search_id", "rank", "party_id", "total_distance") == rows(
            top_n(exact, quantity), "search_id", "rank", "party_id", "total_distance")
    pairs = claim_search.candidate_pairs(searches, prepared).withColumn("score", claim_search._best_score())
    assert pairs.filter("score < sure or score > most").isEmpty()
    assert claim_search.possible_pairs(bounded, prepared).count() < pairs.count()


def test_packed_rows_score_as_walked_ones(spark, sf_dir):
    everyone = catalog.people(spark, sf_dir)
    built = claim_search.prepare_party_search(*everyone, build_party_index(*everyone, 1))
    assert claim_search._with_joined(built).filter("packed is null").isEmpty()
    rng = random.Random(14)
    given = setup(spark, [(i, "JUAN", "DAVILA", D(1960, 1, i % 28 + 1)) for i in range(1, 61)], memberships=2)
    pieces = ["J", "JA", "JAN", "AN", "DA", "DAV", "DAVAL", "AV", "VAL", "AL", "L", "N", "V", "X", "J\nD", "N\n"]
    some = [(i, rng.choice(pieces[:3 + i % 14]), rng.choice([1, 2, 3, 9, 5][:1 + i % 5]), rng.choice(["1.000", "0.500", "-2.000"]))
            for i in range(1, 61) for _ in range(2 + i % 19)]
    index = spark.createDataFrame(some, "party_id bigint, phonetic_name string, name_field_id int, w string").selectExpr(
        "party_id", "phonetic_name", "name_field_id", "cast(w as decimal(18,3)) weight")
    claims = spark.createDataFrame([(1, "PC1", "DAVAL", "JUAN", D(1960, 1, 5)), (2, "PC2", "DAVILA", "JO", D(1990, 1, 9))], CLAIM)
    prepared = claim_search.prepare_party_search(*given[:3], index)
    packed = claim_search._with_joined(prepared).groupBy(F.col("packed").isNull().alias("walked")).count()
    assert packed.count() == 2
    encoded = claim_search.encode_claims(claims)
    pairs = claim_search.candidate_pairs(claim_search.distinct_searches(encoded), prepared)
    scored = claim_search.scored_candidates(pairs)
    expected = []
    for c in encoded.collect():
        for pid in range(1, 61):
            hits = [(w, f) for p, x, f, w in some if p == pid and (x in c["last_code"] or x in c["first_code"])]
            for weight in {w for w, _ in hits}:
                fields = [f for w, f in hits if w == weight]
                types, cnt = len(set(fields)), 2 * len(fields)
                expected.append((c["claim_id"], pid, float(weight), types, cnt, float(weight) * (types + cnt)))
    columns = [F.col(x).cast("double") if x in ("weight", "score") else x for x in (
        "search_id", "party_id", "weight", "types", "cnt", "score")]
    assert rows(scored, *columns) == sorted(expected, key=repr)
    best = pairs.withColumn("best", claim_search._best_score() / 1000).select("search_id", "party_id", "best")
    top = {}
    for claim, pid, *_, score in expected:
        top[claim, pid] = max(score, top.get((claim, pid), score))
    assert rows(best) == sorted([(*k, v) for k, v in top.items()], key=repr)


def test_a_search_makes_its_pairs_once(spark, sf_dir):
    text = plan(catalog.party_matches(spark, sf_dir))
    assert text.count("keys [3]: [fragment") == 2  # the left and the right side of one join


def test_least_distance_is_a_lower_bound(spark):
    rng = random.Random(12)
    texts = ["".join(rng.choices("ABCé中 ", k=rng.randint(0, 9))) for _ in range(400)]
    pairs = spark.createDataFrame(list(zip(texts, texts[::-1])), "a string, b string")
    bounds = pairs.select(
        least_distance("a", letter_set("a"), "b", letter_set("b")).alias("least"), levenshtein_compared("a", "b").alias("d"))
    assert bounds.filter("least > d").isEmpty() and not bounds.filter("least = d and d > 2").isEmpty()


def test_dob_gate(spark):
    rng = random.Random(6)
    days = [None] + [D(1990 + rng.randint(0, 5), rng.randint(1, 12), rng.randint(1, 28))
                     for _ in range(40)]
    left = spark.createDataFrame([(n % 2, d) for n, d in enumerate(days)], "k int, a date")
    right = spark.createDataFrame([(n % 2, d) for n, d in enumerate(days[::-1])], "k int, b date")
    naive = sorted(
        [(n % 2, a, b) for n, a in enumerate(days) for m, b in enumerate(days[::-1])
         if a and b and n % 2 == m % 2
         and (a.year == b.year or a.month == b.month or a.day == b.day)], key=repr)
    assert rows(dob_gate_join(left, right, "a", "b", on=["k"]), "k", "a", "b") == naive


def test_pairs_of_a_busy_key_are_dealt_out(spark):
    from namelink.operators.spread import spread_pairs

    left = spark.createDataFrame([("TO", n) for n in range(300)] + [("AN", 1), (None, 2), ("X", 3)], "k string, a int")
    right = spark.createDataFrame([("TO", n) for n in range(50)] + [("AN", 1), ("AN", 1), (None, 2)], "k string, b int")
    found = spread_pairs(left, right, ["k"], least=500)
    assert rows(found, "k", "a", "b") == rows(left.join(right, "k"), "k", "a", "b")
    assert "_slot" in plan(found) and found.columns == ["k", "a", "b"]


def test_rows_of_a_busy_key_are_copied_along_one_side_of_a_grid(spark):
    from namelink.operators.spread import dealt_pairs

    for n, m in ((300, 300), (900, 100), (100, 900)):
        left = spark.createDataFrame([("TO", i) for i in range(n)] + [("AN", 1)], "k string, a int")
        right = spark.createDataFrame([("TO", i) for i in range(m)] + [("AN", 1)], "k string, b int")
        # 180 tasks: 180 copies of either side would be 18,000 rows at least
        dealt, copies = dealt_pairs(left, right, ["k"], least=500)
        assert dealt.count() + copies.count() <= 9_000
        met = dealt.join(copies, ["k", "_slot_line", "_slot_column"])
        assert met.count() == met.select("k", "a", "b").distinct().count() == n * m + 1
        assert met.groupBy("_slot_line", "_slot_column").count().groupBy().max("count").first()[0] < 2_500


def test_claim_search_plan(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(catalog.party_matches(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "EvalPython" not in text and "InPandas" not in text
    # the cut to the wanted number happens before the shuffle by search
    assert "WindowGroupLimit" in text
    # of the wide orders table only keys and status are read
    text = plan(catalog.searches_and_parties(spark, sf_dir)[1])
    assert "o_totalprice" not in text and "PushedFilters: [IsNotNull(o_orderstatus)" in text
