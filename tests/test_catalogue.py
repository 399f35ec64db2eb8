"""Every catalogue query against its SQL on the smallest tables."""

import os
import sys
from concurrent.futures import ThreadPoolExecutor

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from martloom import catalogue, oracle  # noqa: E402
from compare import compare, database  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the supplied tables")


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    """Comparison of every query; several at a time, since small queries mostly wait for the driver."""
    db = database(sf_dir)

    def outcome(name):
        try:
            return compare(spark, db.cursor(), name, sf_dir)
        except Exception as error:
            return f"FAIL  {name}: {error}"

    with ThreadPoolExecutor(4) as pool:
        return dict(zip(catalogue.QUERIES, pool.map(outcome, catalogue.QUERIES)))


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(lines, name):
    line = lines[name]
    assert line.startswith(("ok", "rows")) and "TYPES" not in line, line


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.QUERIES) - set(oracle.statements()) == set()


def test_entry(spark):
    assert entry.entry(spark).columns == ["date_id", "item_id", "customer_id", "price", "quantity", "payment_amount"]
