"""A broken part of the training-data operators is an error, not a shorter list of queries."""

import sys

import pytest

import __spark_entry__ as driver


def test_broken_parts_are_not_swallowed(monkeypatch):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("tessera.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tessera.llm.streams", None)
    with pytest.raises(ModuleNotFoundError):
        driver.queries()
