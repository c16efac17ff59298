"""Every registered query against DuckDB over the same files."""

import pytest

from tests.compare import connect, difference
from tests.conftest import SMALL
from tillwright.operators import profiling
from tillwright.plans import registry
from tillwright.plans.layers import Layers, StoredLayers


@pytest.fixture(scope="module")
def layers(spark):
    return StoredLayers(Layers.from_test_data(spark, SMALL))


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n, q in registry.QUERIES.items() if q.oracle])
def test_query_equals_sql(name, layers, duck):
    query = registry.QUERIES[name]
    assert difference(registry.portable(query.run(layers)), duck, query.oracle) is None


@pytest.mark.parametrize("name", [n for n, q in registry.QUERIES.items() if not q.oracle])
def test_query_without_sql_has_rows(name, layers):
    assert registry.portable(registry.QUERIES[name].run(layers)).count() > 0


def test_approximate_quantiles_are_close(layers):
    exact = profiling.quantity_profile(layers.raw.orders).first()
    approx = profiling.quantity_profile(layers.raw.orders, approx=True).first()
    for name in ("q1_qty", "median_qty", "q3_qty"):
        assert abs(exact[name] - approx[name]) <= 1


def test_driver_interface(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() == 79  # one month has no orders
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.queries()["dq_row_counts"](spark, SMALL).count() == 4
