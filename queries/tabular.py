"""Validation, classification and presentation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import views as v
from queries.family import Family
from queries.text import SPLIT
from textlab.operators import classify, report
from textlab.operators.sampling import split_flag
from textlab.operators.validation import with_errors
from textlab.plans.scoring import validate_and_score
from textlab.plans.training import train_and_evaluate
from textlab.schemas import QUALITY_LABELS

family = Family()
query = family.query

FEATURES = ["char_count", "word_count", "avg_word_length"]
LINE_RULES = [("l_quantity", 1.0, 45.0), ("l_discount", 0.0, 0.08), ("l_tax", 0.0, 0.06)]


@query("validate_ranges", """WITH checked AS (
  SELECT l_orderkey, l_linenumber, concat_ws(',',
    CASE WHEN NOT coalesce(l_quantity BETWEEN 1 AND 45, false) THEN 'l_quantity' END,
    CASE WHEN NOT coalesce(l_discount BETWEEN 0 AND CAST(0.08 AS DOUBLE), false) THEN 'l_discount' END,
    CASE WHEN NOT coalesce(l_tax BETWEEN 0 AND CAST(0.06 AS DOUBLE), false) THEN 'l_tax' END) AS errors FROM lineitem)
SELECT *, errors = '' AS valid FROM checked""")
def validate_ranges(spark, sf):
    checked = with_errors(v.table(spark, sf, "lineitem"), LINE_RULES)
    return checked.select("l_orderkey", "l_linenumber", F.array_join("errors", ",").alias("errors"),
                          (F.size("errors") == 0).alias("valid"))


@query("label_distribution", "SELECT quality, count(*) AS n FROM labels GROUP BY quality ORDER BY quality")
def label_distribution(spark, sf):
    return classify.label_distribution(v.table(spark, sf, "labels"), "quality")


@query("accuracy", f"""WITH {v.DOCUMENT_FEATURES}
SELECT avg(CASE WHEN quality = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM document_features""")
def accuracy(spark, sf):
    return classify.accuracy(v.document_features(spark, sf), "quality", "prediction")


@query("classification_report", f"""WITH {v.DOCUMENT_FEATURES},
classes AS (SELECT quality AS c FROM document_features UNION SELECT prediction FROM document_features),
counts AS (
  SELECT c, (SELECT count(*) FROM document_features WHERE quality = c) AS support,
         (SELECT count(*) FROM document_features WHERE prediction = c) AS predicted,
         (SELECT count(*) FROM document_features WHERE quality = c AND prediction = c) AS tp FROM classes),
per_class AS (
  SELECT CAST(c AS VARCHAR) AS class, coalesce(tp / nullif(predicted, 0), 0.0) AS precision,
         coalesce(tp / nullif(support, 0), 0.0) AS recall,
         coalesce(2 * tp / nullif(support + predicted, 0), 0.0) AS f1, support, tp FROM counts)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per_class
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
  round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per_class
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM per_class
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM per_class""")
def classification_report(spark, sf):
    rows = classify.classification_report(v.document_features(spark, sf), "quality", "prediction")
    return rows.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("scale_features", f"""WITH {v.DOCUMENT_FEATURES}, {SPLIT.format(table="document_features")},
fitted AS (SELECT avg(char_count) AS m1, stddev_pop(char_count) AS d1, avg(word_count) AS m2,
  stddev_pop(word_count) AS d2, avg(avg_word_length) AS m3,
  stddev_pop(avg_word_length) AS d3 FROM split WHERE NOT is_test)
SELECT doc_id, is_test, round((char_count - m1) / d1, 6) AS char_count, round((word_count - m2) / d2, 6) AS word_count,
  round((avg_word_length - m3) / d3, 6) AS avg_word_length FROM split, fitted""")
def scale_features(spark, sf):
    rows = split_flag(v.document_features(spark, sf), ["quality"], ["doc_id"])
    scaler = classify.fit_scaler(rows.filter(~F.col("is_test")), FEATURES)
    return classify.scale(rows, scaler).select("doc_id", "is_test", *[F.round(f, 6).alias(f) for f in FEATURES])


def trained(spark, sf):
    return train_and_evaluate(v.document_features(spark, sf).drop("prediction"), FEATURES, "quality", ["doc_id"])


@query("rf_train_eval")
def rf_train_eval(spark, sf):
    return trained(spark, sf).accuracy


@query("rf_predict")
def rf_predict(spark, sf):
    rules = [("char_count", 1.0, 1e9), ("word_count", 1.0, 1e9), ("avg_word_length", 0.0, 1e4)]
    records = v.document_features(spark, sf).withColumn("batch_id", F.col("quality").cast("string"))
    results, _, _ = validate_and_score(trained(spark, sf).model, records, rules, order=["doc_id"])
    return results.select("batch_id", "doc_id", "sample", F.col("quality").alias("predicted"), "confidence")


@query("feature_importance")
def feature_importance(spark, sf):
    return trained(spark, sf).importance


@query("feature_profile", """SELECT p_partkey, property, value FROM (
  SELECT p_partkey, 'P Size' AS property, CAST(p_size AS DOUBLE) AS value FROM part
  UNION ALL SELECT p_partkey, 'P Retailprice', p_retailprice FROM part)""")
def feature_profile(spark, sf):
    return report.feature_profile(v.table(spark, sf, "part"), ["p_partkey"], ["p_size", "p_retailprice"])


LABELS = "CASE quality " + " ".join(f"WHEN {k} THEN '{label}'" for k, label in QUALITY_LABELS.items()) \
    + " ELSE 'Unknown' END"
GRADED = "graded AS (SELECT p_partkey, p_brand, CAST(2 + p_size // 7 AS INTEGER) AS quality FROM part)"


def graded(spark, sf):
    """Parts with a grade from their size, partly outside the scale."""
    return v.table(spark, sf, "part").select(
        "p_partkey", "p_brand", (2 + F.floor(F.col("p_size") / 7)).cast("int").alias("quality")
    )


@query("quality_category", f"WITH {GRADED} SELECT p_partkey, quality, {LABELS} AS category FROM graded")
def quality_category(spark, sf):
    return report.with_category(graded(spark, sf)).select("p_partkey", "quality", "category")


@query("batch_results", f"""WITH {GRADED} SELECT p_brand, p_partkey, quality, {LABELS} AS category,
  row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS sample FROM graded""")
def batch_results(spark, sf):
    return report.batch_results(graded(spark, sf), "p_brand", ["p_partkey"])


@query("batch_summary", f"""WITH {GRADED} SELECT p_brand, count(*) AS total_samples, avg(quality) AS average_quality,
  count(*) FILTER (WHERE quality >= 7) AS good_samples FROM graded GROUP BY p_brand""")
def batch_summary(spark, sf):
    return report.batch_summary(graded(spark, sf), "p_brand")


# Tests named "only base" have times of one side.
TIMED = """timed AS (SELECT event_type || CASE WHEN user_id % 10 = 0 THEN ' only base' ELSE '' END AS test,
  CASE WHEN user_id % 2 = 0 THEN 'base' ELSE 'cand' END AS engine, value AS ms FROM events),
times AS (SELECT test, sum(ms) FILTER (WHERE engine = 'base') AS baseline_ms,
  sum(ms) FILTER (WHERE engine = 'cand') AS candidate_ms FROM timed GROUP BY test),
summary AS (SELECT *, baseline_ms / nullif(candidate_ms, 0) AS speedup,
  CASE WHEN candidate_ms < baseline_ms THEN 'cand' WHEN candidate_ms >= baseline_ms THEN 'base' END AS winner FROM times)"""


def timed(spark, sf):
    return v.table(spark, sf, "events").select(
        F.concat("event_type", F.when(F.col("user_id") % 10 == 0, " only base").otherwise("")).alias("test"),
        F.when(F.col("user_id") % 2 == 0, "base").otherwise("cand").alias("engine"),
        F.col("value").alias("ms"),
    )


def _rounded(df):
    return df.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("ab_summary", f"""WITH {TIMED} SELECT test, round(baseline_ms, 4) AS baseline_ms,
  round(candidate_ms, 4) AS candidate_ms, round(speedup, 4) AS speedup, winner FROM summary""")
def ab_summary(spark, sf):
    return _rounded(report.ab_summary(timed(spark, sf)))


@query("ab_totals", f"""WITH {TIMED}, totals AS (SELECT sum(baseline_ms) FILTER (WHERE winner IS NOT NULL) AS b, sum(candidate_ms) FILTER (WHERE winner IS NOT NULL) AS c,
  count(*) FILTER (WHERE winner = 'cand') AS candidate_wins,
  count(*) FILTER (WHERE winner = 'base') AS baseline_wins FROM summary)
SELECT round(b, 4) AS total_baseline_ms, round(c, 4) AS total_candidate_ms, candidate_wins, baseline_wins,
  round(b / nullif(c, 0), 4) AS overall_speedup, CASE WHEN c < b THEN 'cand' ELSE 'base' END AS faster FROM totals""")
def ab_totals(spark, sf):
    return _rounded(report.ab_totals(report.ab_summary(timed(spark, sf))))
