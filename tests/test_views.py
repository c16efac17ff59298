"""Views over a stored build, managed tables with a switch at the end, and cleaning up."""

import os

import pytest

from tests.conftest import SMALL
from tillwright.operators import metrics
from tillwright.plans.layers import TABLES, Layers, TableLayers, build, build_database, drop_runs
from tillwright.plans.views import VIEWS, register_views
from tillwright.session import materialise, release, temporary_tables


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("mart"))
    build(spark, Layers.from_test_data(spark, SMALL).raw, folder)
    return TableLayers.from_folder(spark, folder)


def test_all_views_by_name(spark, mart):
    assert len(VIEWS) == 28
    register_views(mart)
    for name in VIEWS:
        assert spark.sql(f"SELECT * FROM {name}").count() > 0, name


def test_metrics_from_tables_equal_those_from_raw(spark, mart, rows):
    raw = Layers.from_test_data(spark, SMALL)
    assert rows(mart.monthly) == rows(raw.monthly)
    assert rows(metrics.v_category_performance(mart.lines)) == rows(metrics.v_category_performance(raw.lines))


def test_managed_build_switches_at_the_end(spark, monkeypatch):
    raw = Layers.from_test_data(spark, SMALL).raw
    first = build_database(spark, raw, "mart_db")
    before = spark.table("mart_db.fact_sales").count()
    import tillwright.operators.star as star

    monkeypatch.setattr(star, "fact_sales", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build_database(spark, raw, "mart_db")
    assert spark.table("mart_db.fact_sales").count() == before > 0
    drop_runs(spark, "mart_db", keep=first)
    left = {t.name for t in spark.catalog.listTables("mart_db") if t.tableType == "MANAGED"}
    assert left == {f"{name}_{first}" for name in TABLES}
    assert TableLayers.from_database(spark, "mart_db").monthly.count() > 0


def test_stored_tables_go(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    kept = materialise(spark.range(3), "kept")
    with temporary_tables(spark):
        materialise(spark.range(3), "gone")
        assert any("-gone-" in name for name in os.listdir(folder))
    assert not any("-gone-" in name for name in os.listdir(folder))
    assert kept.count() == 3


def test_release_deletes_what_the_session_stored(spark):
    folder, other = spark.conf.get("spark.checkpoint.dir"), spark.newSession()
    before = set(os.listdir(folder))
    materialise(other.range(3))
    assert set(os.listdir(folder)) > before
    release(other)
    assert set(os.listdir(folder)) == before
