"""Every registered query against its oracle SQL on the smallest tables."""

from __future__ import annotations

import importlib
import os
import sys

import pytest

from __spark_entry__ import entry
from larder.workload import load
from tools.check_oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(load().QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, SF_DIR, name) == ""


def test_every_query_has_an_oracle():
    assert set(load().ORACLES) == set(load().QUERIES)


def test_entry(spark):
    rows = entry(spark).collect()
    assert [r["score"] for r in rows] == ["A", "B"]


def test_entry_works_without_the_training_data_package(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    alone = importlib.import_module("__spark_entry__")
    assert set(alone.queries()) == set(load().QUERIES) and set(alone.oracle_sql()) == set(load().ORACLES)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
