"""The driver's entry without the training-data folders."""

import sys

import __spark_entry__ as driver
from tessera.plans import catalog


def test_without_the_training_data_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert driver.queries().keys() == catalog.QUERIES.keys() and driver.oracle_sql() == catalog.ORACLE
