"""The driver's entry, with and without the corpus operators."""

import importlib
import sys

import __spark_entry__ as entry


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_corpus_operators(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("cadenza.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "cadenza.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        reloaded = importlib.reload(entry)
        assert reloaded.llm is None and "pipeline" not in reloaded.queries()
        assert len(reloaded.queries()) > 30
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
