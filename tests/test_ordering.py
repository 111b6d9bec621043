import random

import numpy as np
import pytest

from ledgerlens.operators import ordering


@pytest.fixture(params=[1_000_000, 40])
def limit(request, monkeypatch):
    """Once in one go, once with many rounds of splitting."""
    monkeypatch.setattr(ordering, "ORDERED_ROWS", request.param)
    monkeypatch.setattr(ordering, "SPLITS_PER_ROUND", 5)
    return request.param


def ntile(values, tiles):
    order = sorted(range(len(values)), key=lambda i: values[i])
    size, extra = divmod(len(values), tiles)
    out, place = {}, 0
    for t in range(tiles):
        for _ in range(size + (t < extra)):
            out[order[place]] = t + 1
            place += 1
    return [out[i] for i in range(len(values))]


@pytest.mark.parametrize("n", [1, 3, 5, 7, 501])
def test_ntiles_match_a_sort(spark, limit, n):
    rng = random.Random(n)
    rows = [(f"id{i:04d}", rng.choice([1, 1, 1, 2, 3, None, 50]), rng.random()) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, a int, b double")
    got = {r["id"]: r for r in ordering.with_ntiles(df, {"ta": ("a", True), "tb": ("b", False)}, "id").collect()}
    want_a = ntile([(r[1] is None, -(r[1] or 0), r[0]) for r in rows], 5)
    want_b = ntile([(r[2], r[0]) for r in rows], 5)
    assert [got[r[0]]["ta"] for r in rows] == want_a
    assert [got[r[0]]["tb"] for r in rows] == want_b
    assert got[rows[0][0]].asDict().keys() == {"id", "a", "b", "ta", "tb"}


def test_ntiles_of_nothing(spark):
    df = spark.createDataFrame([], "id string, a int")
    assert ordering.with_ntiles(df, {"t": ("a", False)}, "id").count() == 0


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0] * 300, list(range(257)), [None, 1.0, None, 4.0, 9.0],
    [float(x) for x in random.Random(1).choices(range(100), k=700)],
])
def test_percentiles_match_numpy(spark, limit, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 0.98, 1.0]
    want = np.percentile([v for v in values if v is not None], [100 * p for p in points])
    assert ordering.exact_percentiles(df, "v", points) == pytest.approx(list(want))


def test_percentile_of_nothing(spark):
    assert ordering.exact_percentiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]


def test_row_index_is_dense_and_ordered(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 1, 2, 9]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(7)
    got = ordering.with_row_index(df, ["k"], "place").collect()
    assert sorted(r["place"] for r in got) == list(range(400))
    in_order = [r["k"] for r in sorted(got, key=lambda r: r["place"])]
    assert in_order == sorted(in_order)


def test_tile_ends():
    assert ordering.tile_ends(12, 5) == [3, 6, 8, 10, 12]
    assert ordering.tile_ends(3, 5) == [1, 2, 3, 3, 3]


def test_a_row_is_placed_by_halving_the_split_points(spark, monkeypatch):
    from ledgerlens.operators import ordering

    monkeypatch.setattr(ordering, "ORDERED_ROWS", 20)
    rows = spark.range(500).selectExpr("cast(id * 7 % 40 as double) as k", "id")
    want = sorted((r["k"], r["id"]) for r in rows.collect())
    ranks = [1, 2, 13, 250, 251, 499, 500]
    assert ordering.rows_at_ranks(rows, ["k", "id"], ranks, 500) == {r: want[r - 1] for r in ranks}
    only = sorted(k for k, _ in want)
    assert ordering.rows_at_ranks(rows, ["k"], ranks, 500) == {r: (only[r - 1],) for r in ranks}
