"""Every registered query against its DuckDB text."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import verify
from bedside_spark.plans import catalog
from bedside_spark.plans.oracle import oracle_texts
from tests.conftest import SMALL

QUERIES, TEXTS = catalog.QUERIES, oracle_texts()


@pytest.fixture(scope="module")
def con():
    return verify.connect(SMALL)


def test_every_query_has_a_text():
    assert set(QUERIES) == set(TEXTS)


def test_entry(spark):
    assert contract.entry(spark).count() == 15


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert verify.difference(got, con.execute(TEXTS[name]).df()) is None
