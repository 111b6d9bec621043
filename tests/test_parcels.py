"""Joins by parcels give the rows of a plain join, whatever the keys are."""

import datetime as dt
from decimal import Decimal

import pytest

from ledgerlens.operators import parcels, skew
from tests.test_large_joins import table, warehouse

LEFT = "id string, key string, n int, x double, day date, at timestamp, local timestamp_ntz, yes boolean, money decimal(12,2)"


@pytest.fixture
def moved(monkeypatch):
    """No table is few rows, and tasks pack and give out a few at a time."""
    monkeypatch.setattr(parcels, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(parcels, "HELD_BYTES", 2_000)
    monkeypatch.setattr(parcels, "ROWS", 3)


@pytest.fixture
def left(spark):
    at = dt.datetime(2024, 3, 4, 5, 6, 7, 89)
    rows = [
        (f"t{i}", None if i % 7 == 0 else f"k{i % 5}", i, i / 3, at.date(), at + dt.timedelta(seconds=i), at, i % 2 == 0, Decimal(i) / 4)
        for i in range(60)
    ]
    rows += rows[:2] + [("blank", "", *[None] * 7), (None, "k1", *[None] * 7), (None, None, *[None] * 7)]
    return spark.createDataFrame(rows, LEFT).repartition(3)


@pytest.fixture
def right(spark):
    rows = [("k0", "a", 1.5, 1), ("k1", "b", None, 2), ("k1", "b", None, 2), ("k1", None, 2.5, 3), ("k3", None, None, None), (None, "no", 0.0, 4), ("", "empty", 9.0, 5), ("other", "c", 1.0, 6)]
    return spark.createDataFrame(rows, "key string, tier string, rate double, level bigint").repartition(2)


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_parcels_join_like_a_plain_join(left, right, moved, monkeypatch, hot_rows):
    """Null, absent, repeated and hot keys, and every type of column."""
    if hot_rows:
        monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
        assert skew.find_hot(left, "key").count() > 2
    got, plain = parcels.left_join(left, right, "key"), left.join(right, "key", "left")
    assert dict(got.dtypes) == dict(plain.dtypes)
    assert table(got.select(plain.columns)) == table(plain)
    none = right.filter("false")
    assert table(parcels.left_join(left, none, "key").select(plain.columns)) == table(left.join(none, "key", "left"))
    assert parcels.left_join(left.filter("false"), right, "key").count() == 0


def test_hot_rows_are_dealt_to_all_shards(spark, moved, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    rows = spark.range(1000).selectExpr("cast(id as string) as id", "'busy' as key")
    dims = spark.createDataFrame([("busy", 1)], "key string, v int")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = parcels.left_join(rows, dims, "key")
    assert [len(p) > 0 for p in got.rdd.glom().collect()] == [True] * shards
    assert got.where("v = 1").distinct().count() == 1000


def test_counted_dimensions_do_not_move_whole_rows(spark, sample):
    """Merchants beyond Catalyst's threshold, but few by count, move no transactions."""
    w = warehouse(sample)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        plan = w.enriched_rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    joins = [line for line in plan.splitlines() if "Join [" in line]
    assert not [x for x in joins if "SortMergeJoin [merchant_id" in x or "SortMergeJoin [customer_id" in x]


def test_whole_rows_move_as_parcels(sample, moved):
    """Customers and merchants that are many: the same rows, and no plain move of them."""
    for semantics in ("corrected", "reference"):
        w = warehouse(sample, semantics)
        assert w.enriched_rows.columns == w.enriched.columns
        assert table(w.enriched_rows) == table(w.enriched)
        assert w.enriched_rows._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow meet(") == 2
