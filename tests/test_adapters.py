"""Views as Spark derives and stores them against their SQL texts, and the space they take."""

from __future__ import annotations

from datetime import datetime

import duckdb
import pytest

from pitwall.plans import adapters
from pitwall.sources import storage
from tests.oracle import rows_of

LINES = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
    l_quantity double, l_extendedprice double, l_discount double, l_tax double,
    l_returnflag string, l_linestatus string, l_shipdate timestamp"""
SUPPLIERS = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
NATIONS = "n_nationkey int, n_name string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two races, with replayed events of other content."""
    root, day = tmp_path_factory.mktemp("odd"), datetime(2024, 1, 1)
    lines = [
        (order, 1, order * 7 % 23, number, 1.0, 9000.0 + order * 37 % 500 + again, 0.01 * (order % 11),
         0.0, "R" if order % 9 == 0 else "N", "F", day)
        for order in range(1, 520, 2) for number in (1, 2) for again in range(1 + order % 2)
    ]
    for name, rows, schema in (
        ("lineitem", lines, LINES),
        ("supplier", [(key, f"S{key}", 0, 0.0) for key in range(40)], SUPPLIERS),
        ("nation", [(0, "BRAZIL")], NATIONS),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(root / f"{name}.parquet"))
    return str(root)


@pytest.mark.parametrize("view", ["laps", "timing", "frames", "final_state", "timing_cut", "order_cut"])
def test_view_in_spark_equals_its_text(spark, folder, view):
    duck = duckdb.connect()
    for name in ("lineitem", "supplier", "nation"):
        duck.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    sql = f"SELECT * EXCLUDE (event_time) FROM {view}" if view == "laps" else f"SELECT * FROM {view}"
    theirs = duck.sql(adapters.with_views(sql))
    ours = adapters.Tables(spark, folder)(view).drop("event_time")
    assert ours.columns == theirs.columns
    assert ours.count() > 0
    assert rows_of(ours.columns, [tuple(row) for row in ours.collect()]) == rows_of(
        theirs.columns, theirs.fetchall()
    )


def test_no_table_of_crossings_is_stored(spark, folder, monkeypatch):
    monkeypatch.setattr(adapters, "_stored", {})
    t = adapters.Tables(spark, folder)
    crossings, laps = t("timing").count(), t("laps").count()
    assert crossings == 6 * laps
    t("timing_cut").count(), t("order_cut").count()
    stored = [spark.read.parquet(path).count() for path in adapters._stored.values()]
    assert max(stored) == laps
    assert sum(stored) < 2 * laps


def test_shuffles_of_a_written_table_are_dropped(spark, tmp_path):
    before = spark.conf.get(storage.DROP_SHUFFLES)
    with storage.shuffles_dropped(spark):
        assert spark.conf.get(storage.DROP_SHUFFLES) == "true"
        spark.range(1000).repartition(4, "id").write.parquet(str(tmp_path / "rows"))
    assert spark.conf.get(storage.DROP_SHUFFLES) == before
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 1000


def stored_for(spark, folder, monkeypatch, *views):
    monkeypatch.setattr(adapters, "_stored", {})
    for view in views:
        adapters.Tables(spark, folder)(view).count()
    return {view for _, _, view in adapters._stored}


def test_the_gap_reference_stores_laps_and_one_row_a_car(spark, folder, monkeypatch):
    found = stored_for(spark, folder, monkeypatch, "timing_cut", "order_cut")
    assert found == {"lap_starts", "cut_lap", "order_cut"}


def test_final_states_store_no_frames(spark, folder, monkeypatch):
    assert stored_for(spark, folder, monkeypatch, "final_state", "laps") == {
        "lap_starts", "final_state",
    }
