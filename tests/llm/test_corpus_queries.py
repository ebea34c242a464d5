"""Registered corpus queries against SQL, and the pipeline against brute force."""

from collections import Counter
from pathlib import Path

import corpus_pipeline
import duckdb
import public_tokenizers as tokens
import pytest
from corpus_cases import awkward_texts, frame, lower_ascii, near_components, shingle_sets
from test_dedup import brute_hits, brute_lines
from test_tokens import encoding  # noqa: F401

from namelink.llm.oracles import ORACLES
from namelink.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    rows = QUERIES[name](spark, sf_dir)
    columns = sorted(rows.columns)
    cursor = con.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = Counter(tuple(str(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert Counter(tuple(str(r[c]) for c in columns) for r in rows.collect()) == expected


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline_matches_brute_force(spark, sf_dir, tmp_path, encoding):  # noqa: F811
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs if any(map(str.isalpha, r["text"] or ""))]
    rows = [(i, t) for i, t, equal, near in brute_lines(rows) if t.strip(" ") or not equal + near]
    root = near_components(shingle_sets(rows))
    rows = [(i, t) for i, t in rows if root[i] == i]
    clean = {r[0] for r in brute_hits(rows, items) if not r[2]}
    expected = {i: len(encoding.encode_ordinary(t)) for i, t in rows if i in clean}
    got = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == expected


@pytest.mark.parametrize("rows", ["awkward", "none"])
def test_stages_take_awkward_rows(spark, sf_dir, rows):
    docs = frame(spark, awkward_texts() if rows == "awkward" else [])
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert (docs.count() > 0) == (rows == "awkward")
