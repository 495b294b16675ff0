import numpy as np
import pytest

from textlab.operators import order_statistics, ranking


def test_blocked_positions_equal_window_positions(spark):
    rows = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else cast(id % 50 as string) end as g",
        "hash(id) as o", "id",
    )
    plain = {tuple(r) for r in ranking.window_positions(rows, ["g"], ["o", "id"]).select("id", "_pos", "_n").collect()}
    blocked = ranking.positions(rows, ["g"], ["o", "id"], hot_rows=100)
    assert {tuple(r) for r in blocked.select("id", "_pos", "_n").collect()} == plain


def test_no_hot_groups(spark):
    rows = spark.range(10).selectExpr("id % 2 as g", "id")
    assert ranking.hot_groups(rows, ["g"], 5) is None
    assert ranking.hot_groups(rows, ["g"], 4).count() == 2


def test_a_group_of_few_long_texts_is_ranked_in_blocks(spark, monkeypatch):
    rows = spark.range(60).selectExpr("id % 2 as g", "repeat(cast(id % 7 as string), if(id % 2 = 0, 5000, 5)) as o", "id")
    plain = {tuple(r) for r in ranking.window_positions(rows, ["g"], ["o", "id"]).select("id", "_pos", "_n").collect()}
    assert [r._group.g for r in ranking.hot_groups(rows, ["g"], 100, 10_000).collect()] == [0]
    assert ranking.block_count(rows, ranking.hot_groups(rows, ["g"], 100, 10_000), 100, 10_000) == 15
    monkeypatch.setattr(ranking, "window_positions", lambda df, *a, real=ranking.window_positions: real(df.where("g = 1"), *a))
    got = ranking.positions(rows, ["g"], ["o", "id"], 100, 10_000)
    assert {tuple(r) for r in got.select("id", "_pos", "_n").collect()} == plain


@pytest.mark.parametrize("values", [
    list(range(1000)), [1.0] * 50, [1e-300, 1e300] * 20 + [0.5], list(np.random.default_rng(1).exponential(size=3000)),
    [2**60 + i for i in range(300)], [-1.7e308, 1.7e308, 0.0, 1.0] * 10,
])
@pytest.mark.parametrize("small", [5, 100_000])
def test_exact_quantile(spark, monkeypatch, values, small):
    monkeypatch.setattr(order_statistics, "LIST_VALUES", small)
    monkeypatch.setattr(order_statistics, "BINS", 16)
    kind = "long" if isinstance(values[0], int) else "double"
    df = spark.createDataFrame([(v.item() if hasattr(v, "item") else v,) for v in values], f"v {kind}")
    ordered = sorted(values)
    assert order_statistics.nth_values(df, "v", [0, len(values) // 3, len(values) - 1]) == [
        ordered[0], ordered[len(values) // 3], ordered[-1]]
    assert order_statistics.exact_quantile(df, "v", 0.9) == pytest.approx(
        float(np.percentile(np.array(values, dtype=float), 90)), rel=1e-12)


def test_weighted_quantile(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (9.0, 2), (None, 5)], "v double, w int")
    assert order_statistics.exact_quantile(df, "v", 0.5, "w") == np.percentile([1, 1, 1, 2, 9, 9], 50)
    assert order_statistics.exact_quantile(df.limit(0), "v", 0.5) is None


@pytest.mark.parametrize("listed,grid", [(100_000, 1_000), (50, 20), (1, 7)])
def test_sketch_brackets_and_narrows(spark, monkeypatch, listed, grid):
    monkeypatch.setattr(order_statistics, "LIST_VALUES", listed)
    monkeypatch.setattr(order_statistics, "GRID", grid)
    rng = np.random.default_rng(4)
    for values in (rng.normal(size=3000), np.repeat([5.0, 5.0, 1.0, 9.5], 500), np.r_[np.zeros(2500), rng.random(400)]):
        df = spark.createDataFrame([(float(x),) for x in values] + [(None,), (float("nan"),)], "v double").repartition(3)
        ranks = [0, 1, len(values) // 3, len(values) // 2, len(values) - 2, len(values) - 1]
        assert order_statistics.nth_values(df, "v", ranks) == [np.sort(values)[r] for r in ranks]
        for p in (0.0, 0.01, 0.5, 0.95, 1.0):
            assert order_statistics.exact_quantile(df, "v", p) == pytest.approx(np.quantile(values, p))


def test_a_quantile_takes_three_jobs(spark):
    df = spark.range(0, 50_000, 1, 4).selectExpr("id * 0.37d as v")
    spark.sparkContext.setJobGroup("quantile", "quantile")
    try:
        found = order_statistics.exact_quantile(df, "v", 0.99)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("quantile")) <= 3
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == pytest.approx(0.37 * 0.99 * 49_999)
