import json
import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from textlab.operators import classify, report
from textlab.operators.validation import validate_ranges, with_errors
from textlab.plans.scoring import validate_and_score
from textlab.plans.training import train_and_evaluate
from textlab.schemas import FORM_RULES, REQUEST_RULES, WINE_FEATURES, WINE_TABLE
from textlab.sources import files, model_store


def sample(**changes):
    record = dict(zip(WINE_FEATURES, [7.4, 0.7, 0.0, 1.9, 0.076, 11.0, 34.0, 0.9978, 3.51, 0.56, 9.4]))
    return {**record, **changes}


def records(spark, *rows):
    schema = "id int, " + ", ".join(f"{f} double" for f in WINE_FEATURES)
    return spark.createDataFrame([(i, *[r[f] for f in WINE_FEATURES]) for i, r in enumerate(rows)], schema)


def test_validation(spark):
    df = records(
        spark, sample(), sample(alcohol=8.0, pH=4.5, density=0.9), sample(alcohol=7.999), sample(chlorides=None),
        sample(sulphates=math.nan, pH=5.0), sample(fixed_acidity=20.0), sample(fixed_acidity=20.0001),
    )
    valid, rejected = validate_ranges(df, REQUEST_RULES)
    assert {r.id for r in valid.collect()} == {0, 1, 5}
    assert {r.id: r.errors for r in rejected.collect()} == {
        2: ["alcohol"], 3: ["chlorides"], 4: ["pH", "sulphates"], 6: ["fixed_acidity"]}
    narrow = {r.id: r.errors for r in with_errors(df, FORM_RULES).collect()}
    assert narrow[0] == [] and narrow[1] == ["density", "pH", "alcohol"]


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(0.0, 5.0), (1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaler = classify.fit_scaler(df, ["a", "b"])
    assert scaler["a"] == pytest.approx((1.5, 1.118033988749895))
    assert scaler["b"] == (5.0, 1.0)
    got = [r.a for r in classify.scale(df, scaler).orderBy("a").collect()]
    assert got == pytest.approx([-1.3416407, -0.4472136, 0.4472136, 1.3416407])


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(3, 3), (3, 4), (4, 4), (5, 4)], "y int, p int")
    rows = {r["class"]: r for r in classify.classification_report(df, "y", "p").collect()}
    assert (rows["5"].precision, rows["5"].f1, rows["5"].support) == (0.0, 0.0, 1)
    assert (rows["4"].precision, rows["4"].recall) == (pytest.approx(1 / 3), 1.0)
    assert rows["accuracy"].f1 == 0.5
    assert rows["macro avg"].recall == pytest.approx((0.5 + 1 + 0) / 3)
    assert rows["weighted avg"].precision == pytest.approx((2 * 1 + 1 / 3 + 0) / 4)
    empty = {r["class"]: r for r in classify.classification_report(df.limit(0), "y", "p").collect()}
    assert empty["accuracy"].support == 0


def wine(spark):
    """Separable records: quality follows alcohol."""
    x = F.col("id")
    columns = [(7 + x % 5 * 0.1).alias("fixed_acidity"), *[
        (F.pmod(F.hash(x, F.lit(f)), F.lit(100)) / 1000 + 0.9).alias(f) for f in WINE_FEATURES[1:-2]
    ], (F.lit(0.5)).alias("sulphates"), (8 + x % 6).cast("double").alias("alcohol")]
    return spark.range(600).select(x.alias("Id"), *columns, (3 + x % 6).cast("int").alias("quality"))


def test_train_predict_save_load(spark, tmp_path):
    result = train_and_evaluate(wine(spark), WINE_FEATURES, "quality", ["Id"], path=str(tmp_path / "m"), trees=10)
    scores = {r.part: r.accuracy for r in result.accuracy.collect()}
    assert scores["train"] > 0.95 and scores["test"] > 0.9
    assert result.importance.first()["feature"] == "alcohol" and result.importance.count() == 5
    loaded = model_store.load_model(str(tmp_path / "m"))
    assert model_store.feature_names(loaded) == WINE_FEATURES
    again = classify.predict(loaded, wine(spark).drop("quality"))
    assert again.columns[-2:] == ["quality", "confidence"]
    got = {tuple(r) for r in again.select("Id", "quality", "confidence").collect()}
    assert got == {tuple(r) for r in result.predictions.select("Id", "quality", "confidence").collect()}
    assert all(0 < c <= 1 for _, _, c in got)
    assert {r["class"] for r in result.report.collect()} >= {"3", "8", "accuracy", "macro avg", "weighted avg"}


def test_two_classes_are_predicted_in_a_session_that_has_observed(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = wine(spark).withColumn("quality", (F.col("quality") > 5).cast("int"))
    result = train_and_evaluate(rows, WINE_FEATURES, "quality", ["Id"], trees=5)
    assert {r.part: r.accuracy > 0.9 for r in result.accuracy.collect()} == {"train": True, "test": True}
    assert not next(s for s in result.model.stages if hasattr(s, "featureImportances")).hasSummary


def test_score_a_request_file(spark, tmp_path):
    rows = [sample(), sample(alcohol=99.0), sample(alcohol=13.0)]
    (tmp_path / "one.json").write_text(json.dumps({"wines": rows}, indent=2))
    requests = files.read_requests(spark, str(tmp_path / "one.json"))
    model = classify.train_classifier(wine(spark), WINE_FEATURES, "quality", trees=5)
    results, summary, rejected = validate_and_score(model, requests, REQUEST_RULES)
    got = results.orderBy("sample").collect()
    assert [(r["sample"], r.position) for r in got] == [(1, 0), (2, 2)]
    assert got[1].quality == 8 and got[1].category == "Good (8)"
    assert summary.first()["total_samples"] == 2
    assert [r.errors for r in rejected.collect()] == [["alcohol"]]


def test_wine_csv(spark, tmp_path):
    header = [f.replace("_", " ") for f in WINE_FEATURES] + ["quality", "Id"]
    line = [str(x) for x in sample().values()] + ["5", "0"]
    path = tmp_path / "wine.csv"
    path.write_text("\n".join([",".join(header), ",".join(line)]))
    df = files.read_csv(spark, str(path))
    assert df.schema.fieldNames() == WINE_TABLE.fieldNames()
    assert (df.first()["quality"], df.first()["pH"]) == (5, 3.51)
    path.write_text("a,b\n1,2")
    with pytest.raises(ValueError):
        files.read_csv(spark, str(path))


def test_csv_files_with_other_headers(spark, tmp_path):
    values = {**sample(), "quality": 5, "Id": 0}
    for name, columns in (("a.csv", list(values)), ("b.csv", list(values)[::-1])):
        (tmp_path / name).write_text("\n".join([",".join(columns), ",".join(str(values[c]) for c in columns)]))
    (tmp_path / "c.csv").write_text("\n".join([",".join(values), ",".join("x" if c == "quality" else str(v) for c, v in values.items())]))
    rows = files.read_csv(spark, str(tmp_path), rejects="bad").collect()
    assert [r.pH for r in rows] == [3.51] * 3
    assert sorted((r.quality or 0, r.bad is None) for r in rows) == [(0, False), (5, True), (5, True)]


def test_requests_that_cannot_be_read(spark, tmp_path):
    for name, text in (("x/req.json", {"wines": [sample()]}), ("y/req.json", {"wines": [sample(), sample()]}), ("z/none.json", {"wines": None}), ("z/empty.json", {"wines": []})):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(json.dumps(text))
    (tmp_path / "z/cut.json").write_text('{"wines": [{"alcohol": 9')
    df = files.read_requests(spark, f"{tmp_path}/*/*.json")
    rows = df.collect()
    assert len({r.batch_id for r in rows}) == 5
    assert sorted((r.batch_id[-10:], r.position, r.problem) for r in rows if r.problem is None) == [("x/req.json", 0, None), ("y/req.json", 0, None), ("y/req.json", 1, None)]
    model = classify.train_classifier(wine(spark), WINE_FEATURES, "quality", trees=5)
    _, summary, rejected = validate_and_score(model, df, REQUEST_RULES)
    assert summary.count() == 2
    assert sorted(r.problem for r in rejected.collect()) == ["malformed file", "no records", "no records"]


def test_distribution_and_accuracy(spark):
    df = spark.createDataFrame([(5, 5), (3, 5), (5, None)], "y int, p int")
    assert [tuple(r) for r in classify.label_distribution(df, "y").collect()] == [(3, 1), (5, 2)]
    assert classify.accuracy(df, "y", "p").first()[0] == pytest.approx(1 / 3)


def test_presentation(spark):
    df = spark.createDataFrame([("b1", 1, 3), ("b1", 0, 9), ("b2", 0, None), ("b1", 2, 8)],
                               "batch string, position int, quality int")
    for hot in (1_000_000, 1):
        rows = {(r.batch, r["sample"]): (r.position, r.category)
                for r in report.batch_results(df, "batch", ["position"], hot_rows=hot).collect()}
        assert rows == {("b1", 1): (0, "Unknown"), ("b1", 2): (1, "Very Poor (3)"), ("b1", 3): (2, "Good (8)"),
                        ("b2", 1): (0, "Unknown")}
    summary = {r.batch: r for r in report.batch_summary(df, "batch").collect()}
    assert (summary["b1"].average_quality, summary["b1"].good_samples) == (pytest.approx(20 / 3), 2)
    long = report.feature_profile(records(spark, sample()), ["id"], ["pH", "citric_acid"])
    assert {tuple(r) for r in long.collect()} == {(0, "Ph", 3.51), (0, "Citric Acid", 0.0)}


def test_timing_comparison(spark):
    df = spark.createDataFrame(
        [("even", "base", 4.0), ("even", "cand", 4.0), ("zero", "base", 3.0), ("zero", "cand", 0.0),
         ("fast", "base", 9.0), ("fast", "cand", 3.0)], "test string, engine string, ms double")
    rows = {r.test: (r.speedup, r.winner) for r in report.ab_summary(df).collect()}
    assert rows == {"even": (1.0, "base"), "zero": (None, "cand"), "fast": (3.0, "cand")}
    total = report.ab_totals(report.ab_summary(df)).first()
    assert (total.overall_speedup, total.candidate_wins, total.baseline_wins, total.faster) == (
        pytest.approx(16 / 7), 2, 1, "cand")
    assert report.ab_totals(report.ab_summary(df.limit(0))).first()["overall_speedup"] is None
    alone = spark.createDataFrame([("a", "base", 5.0), ("b", "cand", 1.0)], df.schema)
    total = report.ab_totals(report.ab_summary(alone)).first()
    assert (total.total_baseline_ms, total.total_candidate_ms, total.overall_speedup, total.faster) == (0.0, 0.0, None, None)
    total = report.ab_totals(report.ab_summary(df.unionByName(alone))).first()
    assert (total.total_baseline_ms, total.total_candidate_ms, total.faster) == (16.0, 7.0, "cand")
