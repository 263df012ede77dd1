"""Every registered query against its SQL twin."""

import importlib
import os
import sys

import pytest

import compare

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
registered = importlib.import_module("__spark_entry__")

from ticketmill.plans import catalog  # noqa: E402


@pytest.fixture(scope="module")
def duck(folder):
    con = compare.connect(folder)
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, folder, duck, name):
    result = catalog.queries()[name](spark, folder)
    assert compare.differences(result, duck, catalog.oracle_sql()[name]) is None


def test_entry(spark):
    assert registered.entry(spark).count() > 0
