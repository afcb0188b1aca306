"""The driver's entry, also where the training-data operators cannot be imported."""

import importlib
import sys

import pytest

from daybook.plans.queries import QUERIES


@pytest.mark.parametrize("missing", ["zstandard", "corpus_pipeline", "daybook.llm"])
def test_other_queries_stay_where_something_is_missing(monkeypatch, missing):
    for name in list(sys.modules):
        if name.startswith("daybook.llm") or name == "corpus_pipeline":
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    entry = importlib.reload(importlib.import_module("__spark_entry__"))
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(queries) and set(oracles) <= set(queries)
    assert ("pipeline" in queries) == (missing == "none")
