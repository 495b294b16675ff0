import numpy as np
import pytest
from pyspark.sql import functions as F

from textlab.operators import forest, outliers
from textlab.plans.outlier_report import first_by_key, outlier_report, quick_report


def texts(spark, n=600):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join("w" * int(k) for k in rng.integers(2, 9, size=rng.integers(5, 25)))) for i in range(n)]
    rows.append((n, "z" * 5000))
    return spark.createDataFrame(rows, "id long, sentence string")


def test_contamination_cut(spark):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("score"))
    assert outliers.flag(df, "score", 0.05).filter("is_outlier = 1").count() == 5
    assert outliers.flag(df, "score", 0.05, approx=True).filter("is_outlier = 1").count() in (4, 5, 6)


def test_reports_on_empty_input(spark):
    df = outliers.outlier_features(spark.createDataFrame([], "id long, sentence string"))
    flagged = outliers.flag(df.withColumn("score", F.lit(1.0)))
    assert tuple(outliers.outlier_summary(flagged).first()) == (0, 0, None)
    assert outliers.outlier_profile(flagged).count() == 0
    parts = outlier_report(spark.createDataFrame([], "id long, sentence string"), ["id"], trees=3)
    assert parts["summary"].first()["total_sentences"] == 0
    assert parts["top"].count() == 0


def test_profile_and_summary_weighted_equal_unweighted(spark):
    rows = spark.createDataFrame([(1, 10, 2, 1), (1, 10, 2, 1), (0, 4, 1, 1), (0, 6, 2, 1)],
                                 "is_outlier int, char_count long, word_count long, one int")
    grouped = rows.groupBy("is_outlier", "char_count", "word_count").agg(F.count(F.lit(1)).alias("n"))
    for report in (outliers.outlier_profile, outliers.outlier_summary):
        assert {tuple(r) for r in report(rows).collect()} == {tuple(r) for r in report(grouped, "n").collect()}
    assert outliers.outlier_summary(rows).first()["outlier_percentage"] == 50.0


def test_average_path():
    assert forest.average_path(1) == 0.0
    assert forest.average_path(2) == 1.0
    assert forest.average_path(256) == pytest.approx(10.2448, abs=1e-4)


def test_forest_is_repeatable_and_finds_the_planted_row(spark):
    df = outliers.outlier_features(texts(spark))
    fit = [forest.fit_isolation_forest(d, outliers.FEATURES, ["id"], 30, 64) for d in (df, df.repartition(5))]
    assert fit[0].nodes.sort_values(["tree", "node"]).reset_index(drop=True).equals(
        fit[1].nodes.sort_values(["tree", "node"]).reset_index(drop=True))
    assert fit[0].sample_size == 64
    assert fit[0].nodes.groupby("tree").size().max() <= 2 * 64 - 1
    scored = fit[0].score(df)
    top = scored.orderBy(F.desc("score")).limit(10).collect()
    assert 600 in [r.id for r in top]
    assert all(0 < r.score < 1 for r in scored.collect())


def walk(nodes, x):
    total = 0.0
    for _, tree in nodes.groupby("tree"):
        tree = tree.set_index("node")
        at = tree.loc[0]
        while at.feature >= 0:
            at = tree.loc[int(at.left if x[int(at.feature)] <= at.threshold else at.right)]
        total += at.path_length
    return total / nodes["tree"].nunique()


def test_scores_follow_the_definition(spark):
    df = outliers.outlier_features(texts(spark, 120))
    model = forest.fit_isolation_forest(df, outliers.FEATURES, ["id"], 8, 32)
    for row in model.score(df).limit(15).collect():
        x = [float(row[f]) for f in outliers.FEATURES]
        assert row.score == pytest.approx(2 ** (-walk(model.nodes, x) / forest.average_path(32)), rel=1e-9)


def test_few_rows(spark):
    df = outliers.outlier_features(spark.createDataFrame([(1, "a b"), (2, "a b")], "id long, sentence string"))
    model = forest.fit_isolation_forest(df, outliers.FEATURES, ["id"], 5, 256)
    assert model.sample_size == 2
    assert {round(r.score, 6) for r in model.score(df).collect()} == {0.5}


def test_report(spark):
    parts = outlier_report(texts(spark), ["id"], contamination=0.05, trees=40, psi=64)
    summary = parts["summary"].first()
    assert summary["total_sentences"] == 601
    assert abs(summary["outliers_detected"] - 30) <= 2
    assert parts["flagged"].filter("is_outlier = 1").count() == summary["outliers_detected"]
    top = parts["top"].orderBy(F.desc("anomaly_score")).collect()
    assert len(top) == 10 and 600 in [r.id for r in top]
    assert all(r.anomaly_score > 0 for r in top)
    assert [len(r.sentence) for r in top if r.id == 600] == [203]
    profile = {r.is_outlier: r for r in parts["profile"].collect()}
    assert profile[1].max_char_count == 5000


def test_first_rows_and_quick_report(spark):
    df = texts(spark, 3000)
    assert {r.id for r in first_by_key(df, "id", 1500).collect()} == set(range(1500))
    assert first_by_key(df, "id", 10).count() == 10
    assert first_by_key(df, "id", 9999).count() == 3001
    assert quick_report(df, "id", 1500, trees=10, psi=32)["summary"].first()["total_sentences"] == 1500


@pytest.mark.parametrize("rows", [0, 3, 39, 40, 41, 500])
def test_every_tree_gets_its_rows(spark, rows):
    """One rule on both sides of trees * psi rows."""
    df = spark.range(rows).select("id", F.col("id").cast("double").alias("x"))
    nodes = forest.fit_isolation_forest(df, ["x"], ["id"], trees=5, psi=8).nodes
    assert nodes[nodes["node"] == 0]["size"].tolist() == [min(rows, 8)] * (5 if rows else 0)
