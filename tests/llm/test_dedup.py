"""Line dedup, near-dedup and decontamination against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from corpus_cases import awkward_texts, frame, lower_ascii, near_components, prose, shingle_sets, within_one_edit

from namelink.llm import line_dedup, minhash
from namelink.llm.components import components
from namelink.llm.decontaminate import contamination_report, decontaminate
from namelink.llm.line_dedup import dedup_lines, line_dedup_report
from namelink.llm.minhash import near_dedup


def brute_lines(rows, least=30):
    """(doc_id, remaining text, equal, near) by comparing all lines."""
    def key(row):
        return (row[0] is None, row[0] or 0)

    occurrences = {}
    for row in rows:
        for pos, line in enumerate((row[1] or "").split("\n") if row[1] is not None else []):
            if len(line) >= least:
                at = (*key(row), pos)
                occurrences[line] = min(occurrences.get(line, at), at)
    lines = list(occurrences)
    near = {
        max(a, b, key=lambda x: occurrences[x])
        for i, a in enumerate(lines) for b in lines[i + 1:] if within_one_edit(a, b)
    }
    found = []
    for row in rows:
        if row[1] is None:
            found.append((row[0], None, 0, 0))
            continue
        kept, equal, close = [], 0, 0
        for pos, line in enumerate(row[1].split("\n")):
            if len(line) < least:
                kept.append(line)
            elif occurrences[line] != (*key(row), pos):
                equal += 1
            elif line in near:
                close += 1
            else:
                kept.append(line)
        found.append((row[0], "\n".join(kept), equal, close))
    return found


def edited(line, rng):
    at = rng.randrange(len(line))
    return rng.choice([line[:at] + line[at + 1:], line[:at] + "Z" + line[at:], line[:at] + "Z" + line[at + 1:]])


@pytest.mark.parametrize("hot", [64, 1])
def test_lines_match_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    rng = random.Random(4)
    lines = [prose(k, 9, 1) for k in range(12)]
    lines += [edited(x, rng) for x in lines for _ in range(3)]
    texts = ["\n".join(rng.choice(lines) for _ in range(5)) for _ in range(25)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, t) for k, (_, t) in enumerate(awkward_texts())]
    got = dedup_lines(frame(spark, rows)).select("doc.doc_id", "doc.text", "n_dropped_equal", "n_dropped_near").collect()
    assert Counter(map(tuple, got)) == Counter(brute_lines(rows))
    assert sum(r["n_dropped_near"] for r in got) > 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


@pytest.mark.parametrize(("hot", "edits"), [(64, 2), (1, 2), (1, 3)])
def test_lines_some_edits_apart(spark, monkeypatch, hot, edits):
    """Every pair within the edits is found, and no other; equal short lines go as well."""
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    rng = random.Random(40 + edits)
    lines = ["Invoice number 00417 of the year 2019", "Invoice number 00452 of the year 2019", "ab the same letters swapped at the end ba"]
    for k in range(10):
        line = prose(k, 7, 1)[:rng.randint(30, 45)].ljust(30, "k")
        lines.append(line)
        for n in range(1, edits + 2):
            for _ in range(3):
                other = line
                for _ in range(n):
                    other = edited(other, rng)
                lines.append(other)
        lines += ["Q" * n + line for n in range(1, edits + 1)] + [line + "Q" * n for n in range(1, edits + 1)]
        lines += [line[n:] + "W" * n for n in range(1, edits)]
    lines = [x for x in dict.fromkeys(lines) if len(x) >= 30]
    rng.shuffle(lines)
    near = {b for i, b in enumerate(lines) if any(abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits for a in lines[:i])}
    docs = frame(spark, [(k, x + "\nshort\n") for k, x in enumerate(lines)])
    got = {r["doc_id"]: r for r in dedup_lines(docs, 30, edits, 1).selectExpr("doc.doc_id", "doc.text", "n_dropped_equal", "n_dropped_near").collect()}
    assert {lines[k] for k, r in got.items() if r["n_dropped_near"]} == near
    assert [r["n_dropped_equal"] for _, r in sorted(got.items())] == [0] + [1] * (len(lines) - 1)
    assert got[0]["text"] == lines[0] + "\nshort\n"
    with pytest.raises(ValueError):
        dedup_lines(docs, 8, 2)


def test_many_lines_of_one_segment_make_few_pairs(spark, monkeypatch):
    """Lines that share most of their text, yet are not near, do not all meet."""
    monkeypatch.setattr(line_dedup, "HOT_LINES", 8)
    made, among_many = [], line_dedup._among_many

    def recorded(*args):
        made.append(among_many(*args))
        return made[0]

    monkeypatch.setattr(line_dedup, "_among_many", recorded)
    rng = random.Random(6)
    words = prose(21, 24, 1).split(" ")
    lines = []
    for _ in range(150):
        own = list(words)
        for _ in range(3):
            own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
        lines.append(" ".join(own))
    lines += [edited(x, rng) for x in lines[::10]]
    near = {b for i, b in enumerate(lines) if any(abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2 for a in lines[:i])}
    got = dedup_lines(frame(spark, list(enumerate(lines))), 30, 2).filter("n_dropped_near > 0").select("doc.doc_id").collect()
    assert {lines[r["doc_id"]] for r in got} == near and len(near) >= 15
    found, pairs = made[0]
    assert found.count() + pairs.distinct().count() < 8 * len(lines) < len(lines) * (len(lines) - 1) / 4


def test_lines_without_ids_and_repeated_rows(spark):
    line = "A line that is long enough to be compared."
    rows = [(None, line), (5, line), (7, "only once, but the very same row twice"), (7, "only once, but the very same row twice"), (4, None)]
    got = dedup_lines(frame(spark, rows)).select("doc.doc_id", "doc.text").collect()
    assert Counter(map(tuple, got)) == Counter([(None, ""), (5, line), (7, rows[2][1]), (7, rows[2][1]), (4, None)])
    assert line_dedup_report(frame(spark, [])).collect() == []


def test_other_columns_stay(spark):
    docs = frame(spark, awkward_texts())
    assert dedup_lines(docs).select("doc.*").columns == docs.columns


def test_near_dedup_matches_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, t) for i, t in awkward_texts() if i is not None]
    for group in range(6):
        words = prose(50 + group, 120).split(" ")
        for _ in range(8):
            own = list(words)
            for _ in range(rng.randint(0, 9)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows) + 100, " ".join(own)))
    shared = prose(77, 40)
    rows += [(1000 + k, shared + " " + prose(500 + k, 30)) for k in range(30)]
    got = near_dedup(frame(spark, rows)).collect()
    sets = shingle_sets(rows)
    expected = near_components(sets)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        (i, len(sets[i]), expected[i], expected[i] == i) for i in sets
    }
    assert len(got) == len(rows)


def test_near_dedup_without_pivots_loses_nothing(spark, monkeypatch):
    """The exact filters alone find every link between different texts."""
    monkeypatch.setattr(minhash, "MAX_MISMATCHES", -1)
    words = prose(5, 100).split(" ")
    rows = [(k, " ".join([*words[:k * 3], f"x{k}", *words[k * 3 + 1:]])) for k in range(12)]
    rows += [(20 + k, prose(k + 900, 50)) for k in range(5)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup(frame(spark, rows)).collect()}
    assert got == near_components(shingle_sets(rows))


def test_near_dedup_rows_without_id(spark):
    text = prose(3)
    got = near_dedup(frame(spark, [(None, text), (2, text), (2, text), (3, None), (None, "")])).collect()
    assert Counter((r["doc_id"], r["component_id"], r["kept"]) for r in got) == Counter(
        [(None, None, True), (2, 2, True), (2, 2, True), (3, 3, True), (None, None, True)])
    assert near_dedup(frame(spark, [])).collect() == []


def test_estimate_follows_similarity():
    import numpy as np

    common = np.arange(900, dtype="u8") * np.uint64(0x9E3779B97F4A7C15)
    own = [(np.arange(100, dtype="u8") + np.uint64(10_000 * k + 5000)) * np.uint64(0xBF58476D1CE4E5B9) for k in (1, 2)]
    bits = minhash.low_bits(np.stack([minhash.minima(np.concatenate([common, x])) for x in own])).view("u8")
    differing = bits[0] ^ bits[1]
    odd = (differing | (differing >> np.uint64(1))) & np.uint64(0x5555555555555555)
    mismatches = sum(int(x).bit_count() for x in odd)
    similarity = (1 - mismatches / minhash.HASHES - 0.25) / 0.75
    assert abs(similarity - 900 / 1100) < 0.15


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(20)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(21)} | {100 + k: 100 for k in range(30)}


def brute_hits(rows, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t or ""))

    found = []
    for doc_id, text in rows:
        own, hit, ids = words(text), set(), set()
        for item_id, item in items:
            w = words(item)
            m = min(window, len(w))
            wins = {tuple(w[i:i + m]) for i in range(len(w) - m + 1)} if m else set()
            for i in range(len(own) - m + 1):
                if m and tuple(own[i:i + m]) in wins:
                    hit.update(range(i, i + m))
                    ids |= {str(item_id)} if item_id is not None else set()
        found.append((doc_id, len(own), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return found


@pytest.mark.parametrize("block_chars", [50, 8_000_000])
def test_decontamination_matches_brute_force(spark, block_chars):
    item = prose(300, 30, 1)
    items = [(1, item), (2, "ab CD"), (3, ""), (4, None), (None, "zz yy"), (12, "a b a b a b a b a b a b a b"), (5, item), (6, "中文 x")]
    rows = awkward_texts() + [(50, "before " + item.upper() + " after"), (51, "a b " * 9), (52, "zz-YY"), (53, " ".join(item.split()[3:12])),
                              (54, " ".join(item.split()[3:13]) + "\n" + " ".join(item.split()[9:25]))]
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id bigint, text string, words string")
    got = contamination_report(frame(spark, rows), bench, block_chars).collect()
    assert Counter(map(tuple, got)) == Counter(brute_hits(rows, items))


def test_decontamination_of_nothing(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r["n_hit"] for r in decontaminate(frame(spark, awkward_texts()), bench).collect())
    assert decontaminate(frame(spark, []), bench).collect() == []
