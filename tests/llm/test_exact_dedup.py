"""Exact dedup against plain Python, with any fan-in and number of runs."""

import hashlib
from collections import Counter, defaultdict

import pytest
from corpus_cases import awkward_texts, frame

from namelink.llm.exact_dedup import drop_copies, exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for place, (doc_id, text) in enumerate(rows):
        groups[text or ""].append((doc_id is not None, doc_id or 0, -place, doc_id))
    out = []
    for place, (doc_id, text) in enumerate(rows):
        best = max(groups[text or ""])
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, best[3], len(groups[text or ""]), best[2] == -place, digest))
    return Counter(out)


@pytest.mark.parametrize(("fan_in", "parts"), [(2, 1), (2, 7), (3, 20), (16, 5)])
def test_verdicts_match_brute_force(spark, fan_in, parts):
    rows = awkward_texts() + [(100 + i, "many copies of one text") for i in range(60)] + [(20, "Case"), (21, "case"), (22, "case ")]
    docs = frame(spark, rows).repartition(parts)
    got = Counter(map(tuple, exact_dedup(docs, fan_in).collect()))
    expected = brute(rows)
    # Which of several rows with one id is first depends on how the rows are dealt out.
    strip = lambda found: Counter(x[:3] + x[4:] for x in found.elements())
    assert strip(got) == strip(expected)
    kept = Counter(x[4] for x in got.elements() if x[3])
    assert set(kept.values()) == {1} and set(kept) == {x[4] for x in expected}


def test_single_run_keeps_the_first_of_equal_rows(spark):
    rows = awkward_texts()
    assert Counter(map(tuple, exact_dedup(frame(spark, rows).coalesce(1)).collect())) == brute(rows)


def test_empty_table_and_bad_fan_in(spark):
    assert exact_dedup(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        exact_dedup(frame(spark, []), fan_in=1)


def test_whole_rows_stay(spark):
    rows = awkward_texts()
    docs = frame(spark, rows).repartition(4)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    best = {text or "": max((i is not None, i or 0) for i, t in rows if (t or "") == (text or "")) for _, text in rows}
    assert Counter((r["doc_id"], r["text"] or "") for r in kept.collect()) == Counter(
        (i if known else None, text) for text, (known, i) in best.items()
    )


def test_no_python_in_the_plan(spark, sf_dir):
    from namelink.llm.queries import op13_exact_dedup

    plan = op13_exact_dedup(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Cartesian" not in plan
