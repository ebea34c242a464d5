"""The prefix trie against plain Python, for any container size."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from namelink.llm.prefix_trie import conversation_units, prefix_trie, rebuilt_paths

SCHEMA = "conv_id bigint, turn bigint, role string, text string, head string, path int, n string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, ids in members.items():
        own_saved = (len(ids) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += own_saved
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(rebuilt[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def conversations(seed, n=400):
    """Few distinct turns, so that conversations share prefixes; some equal, some long, some odd."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(1200), n):
        if c % 3 == 0:
            rows += [(c, k, "user", "the same") for k in range(3)]
            continue
        for turn in range(rng.choice([1, 2, 3, 7, 8])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["yes", "no", "💥 ünï", "", None])))
    rows += [(5000, k, "user", "yes" if k < 60 else f"turn {k}") for k in range(150)]
    rows += [(5001, k, "user", "yes" if k < 60 else f"other {k}") for k in range(150)]
    rows += [(None, 1, "user", "lost"), (7001, None, None, None), (7001, 1, "user", "x"), (7002, 4, "a", "bc"), (7003, 4, "ab", "c")]
    return rows


@pytest.mark.parametrize("burst_turns", [1, 40, 10_000_000])
def test_nodes_match_brute_force(spark, burst_turns):
    rows = conversations(burst_turns, 200 if burst_turns == 1 else 400)
    if burst_turns == 1:  # every shared turn bursts, so no long common beginning here
        rows = [r for r in rows if r[0] is None or r[0] not in (5000, 5001)]
    got = prefix_trie(table(spark, rows).repartition(5), burst_turns)
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_few_heads_may_burst(spark):
    rows = conversations(3)
    got = prefix_trie(table(spark, rows), burst_turns=1, most_heads=5)
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_turns_without_number_and_repeated_turns(spark):
    rows = [(1, None, "a", "x"), (1, None, "a", "x"), (1, 0, "b", "y"), (2, 3, None, "z"), (2, None, "a", None)]
    paths = {r["conv_id"]: len(r["path"]) // 24 for r in rebuilt_paths(conversation_units(table(spark, rows))).collect()}
    shared = {c: zlib.crc32(str(c).encode()) % 6 for c in (1, 2)}
    assert paths == {1: max(0, 3 - shared[1]), 2: max(0, 2 - shared[2])}
    assert Counter(map(tuple, prefix_trie(table(spark, rows)).collect())) == brute(rows)


def test_no_conversations(spark):
    assert prefix_trie(table(spark, [])).collect() == []
    assert prefix_trie(table(spark, [(None, 1, "a", "b")])).collect() == []


def test_one_conversation_without_turns_is_in_the_root(spark):
    c = next(c for c in range(100, 1000) if c % 100 and zlib.crc32(str(c).encode()) % 6 >= 1)
    got = [tuple(r) for r in prefix_trie(table(spark, [(c, 0, "user", "x")])).collect()]
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
