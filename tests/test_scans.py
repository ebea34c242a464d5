"""Queries read the texts once, however often they use what comes of them."""

import pytest

from namelink import catalog

from helpers import plan, rows


@pytest.fixture
def text_scans(monkeypatch):
    """The number of times that names are derived from the texts while a query is built."""
    found, names = [], catalog.fx.names

    def counted(spark, sf_dir):
        found.append(sf_dir)
        return names(spark, sf_dir)

    monkeypatch.setattr(catalog.fx, "names", counted)
    return found


@pytest.mark.parametrize("name", [
    "check_constraints", "name_alias_rules", "index_changed", "index_unchanged", "index_new_rows", "index_stale",
    "merge_duplicates", "dob_gate_join",
])
def test_texts_are_read_once(spark, sf_dir, text_scans, name):
    found = catalog.QUERIES[name](spark, sf_dir)
    assert len(text_scans) == 1
    # what is used several times is written down, so the texts are not part of the plan
    assert "documents.parquet" not in plan(found) and rows(found)
