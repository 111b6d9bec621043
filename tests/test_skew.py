import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import skew

START = dt.datetime(2023, 1, 1)


@pytest.fixture(scope="module")
def rows():
    """A third of the rows belong to one key; many share an instant; one key is null."""
    rng = random.Random(5)
    keys = ["hot"] * 100 + [f"k{i % 20}" for i in range(190)] + [None] * 10
    return [
        (key, START + dt.timedelta(hours=rng.randrange(0, 24 * 90, 7), minutes=rng.choice([0, 0, 30])), f"t{i:03d}",
         rng.choice([1.0, 2.5, 2.5, 80.0, -3.0, 1000.25, None]))
        for i, key in enumerate(keys)
    ]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "key string, at timestamp, id string, v double")


def hot_of(table, limit):
    return None if limit is None else skew.find_hot(table, "key", limit)


def test_find_hot(table):
    assert skew.find_hot(table, "key", 1000) is None
    assert [r["_hot_key"] for r in skew.find_hot(table, "key", 50).collect()] == ["hot"]
    assert skew.find_hot(table, "key", 9).filter("_hot_key is null").count() == 1


def test_key_load(table, monkeypatch):
    assert skew.key_load(table, "key") == skew.KeyLoad(None, False)
    monkeypatch.setattr(skew, "FRAME_ROWS", 50)
    assert skew.key_load(table, "key") == skew.KeyLoad(None, True)
    monkeypatch.setattr(skew, "HOT_ROWS", 60)
    assert skew.key_load(table, "key").hot.count() == 1


@pytest.mark.parametrize("limit", [None, 50, 5])
def test_running_total(table, rows, limit):
    got = skew.with_running_total(table, "key", "at", ["id"], F.lit(2), "n", hot_of(table, limit))
    assert got.columns == ["key", "at", "id", "v", "n"]
    for r in got.collect():
        want = sum(2 for k, at, i, _ in rows if k == r["key"] and (at, i) <= (r["at"], r["id"]))
        assert r["n"] == want


@pytest.mark.parametrize("limit", [None, 50, 5, "frame"])
def test_trailing_count(table, rows, limit):
    load = skew.KeyLoad(None, False) if limit == "frame" else skew.KeyLoad(hot_of(table, limit))
    got = skew.with_trailing_count(table, "key", "at", 30, "n", load).collect()
    assert len(got) == len(rows)
    for r in got:
        since = r["at"] - dt.timedelta(days=30)
        assert r["n"] == sum(1 for k, at, _, _ in rows if k == r["key"] and since <= at <= r["at"])


def test_trailing_count_includes_the_exact_edge(spark):
    rows = [("a", START), ("a", START + dt.timedelta(days=30)), ("a", START + dt.timedelta(days=30, seconds=1))]
    df = spark.createDataFrame(rows, "key string, at timestamp")
    got = [r["n"] for r in skew.with_trailing_count(df, "key", "at", 30, "n").orderBy("at").collect()]
    assert got == [1, 2, 2]


def test_hot_medians(table, rows):
    got = {r["key"]: r["m"] for r in skew.hot_medians(table, ["key"], "v", "m").collect()}
    for key in {r[0] for r in rows}:
        values = [v for k, _, _, v in rows if k == key and v is not None]
        assert got[key] == pytest.approx(statistics.median(values))


def test_one_key_without_times_is_spread(spark, monkeypatch):
    """All rows belong to one key and have no time: the order is that of the ids, and every slice gets its share."""
    laid = []
    keep = skew.stage
    monkeypatch.setattr(skew, "stage", lambda df, name: laid.append(keep(df, name)) or laid[-1])
    table = spark.range(4000).selectExpr("'c' AS key", "cast(null AS timestamp) AS at", "lpad(cast(id AS string), 5, '0') AS id")
    got = skew.with_running_total(table, "key", "at", ["id"], F.lit(1), "n", skew.find_hot(table, "key", 100))
    assert got.filter(F.col("n") != F.col("id").cast("long") + 1).count() == 0 and got.count() == 4000
    sizes = [r["count"] for r in laid[0].groupBy("_slice").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000
