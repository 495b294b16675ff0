"""Outlier queries: SQL-checked on a fixed score, rows-only on the isolation forest."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import views as v
from queries.family import Family
from textlab.operators import outliers as ou
from textlab.operators.forest import fit_isolation_forest
from textlab.plans.outlier_report import outlier_report, quick_report
from textlab.session import staged

family = Family()
query = family.query

KEY = ["docID", "sentenceID"]

FLAGGED = f"""{v.SENTENCES},
scored AS (
  SELECT "docID", "sentenceID", sentence, name, section, length(sentence) AS char_count,
         len(string_split(sentence, ' ')) AS word_count,
         abs(length(sentence) - (SELECT avg(length(sentence)) FROM sentences)) AS score FROM sentences),
cut AS (SELECT quantile_cont(score, 0.95) AS threshold FROM scored),
flagged AS (SELECT *, CAST(score > threshold AS INTEGER) AS is_outlier, score - threshold AS anomaly_score
            FROM scored, cut)"""


def flagged_rows(spark, sf):
    """Distance of the length from the mean length as score."""
    rows = ou.outlier_features(v.sentences(spark, sf))
    mean = rows.agg(F.avg("char_count")).first()[0]
    return ou.flag(rows.withColumn("score", F.abs(F.col("char_count") - F.lit(mean))), "score", 0.05)


@query("contamination_flag", f"""WITH {FLAGGED} SELECT "docID", "sentenceID", round(score, 6) AS score, is_outlier
FROM flagged""")
def contamination_flag(spark, sf):
    return flagged_rows(spark, sf).select(*KEY, F.round("score", 6).alias("score"), "is_outlier")


@query("outlier_summary", f"""WITH {FLAGGED} SELECT count(*) AS total_sentences,
  CAST(sum(is_outlier) AS BIGINT) AS outliers_detected,
  round(100.0 * sum(is_outlier) / count(*), 6) AS outlier_percentage FROM flagged""")
def outlier_summary(spark, sf):
    return ou.outlier_summary(flagged_rows(spark, sf)).withColumn(
        "outlier_percentage", F.round("outlier_percentage", 6)
    )


@query("outlier_profile", f"""WITH {FLAGGED} SELECT is_outlier,
  min(char_count) AS min_char_count, max(char_count) AS max_char_count, avg(char_count) AS mean_char_count,
  min(word_count) AS min_word_count, max(word_count) AS max_word_count, avg(word_count) AS mean_word_count
FROM flagged GROUP BY is_outlier""")
def outlier_profile(spark, sf):
    return ou.outlier_profile(flagged_rows(spark, sf))


@query("outlier_top10", f"""WITH {FLAGGED} SELECT "docID", "sentenceID", name, section,
  CASE WHEN length(sentence) > 200 THEN substr(sentence, 1, 200) || '...' ELSE sentence END AS sentence,
  char_count, word_count, round(char_count / word_count, 6) AS avg_word_length, round(anomaly_score, 6) AS anomaly_score
FROM flagged WHERE is_outlier = 1
ORDER BY score DESC, "docID", "sentenceID" LIMIT 10""")
def outlier_top10(spark, sf):
    return ou.outlier_top(flagged_rows(spark, sf), KEY).select(
        *KEY, "name", "section", "sentence", "char_count", "word_count", F.round("avg_word_length", 6).alias("avg_word_length"),
        F.round("anomaly_score", 6).alias("anomaly_score"),
    )


def forest(spark, sf):
    rows = staged(ou.outlier_features(v.sentences(spark, sf)).select(*KEY, *ou.FEATURES), "features")
    return rows, fit_isolation_forest(rows, ou.FEATURES, KEY)


@query("iforest_nodes")
def iforest_nodes(spark, sf):
    return forest(spark, sf)[1].nodes_frame(spark)


@query("score_outliers")
def score_outliers(spark, sf):
    rows, model = forest(spark, sf)
    return model.score(rows.select(*KEY, *ou.FEATURES))


@query("outlier_report")
def report(spark, sf):
    parts = outlier_report(v.sentences(spark, sf), KEY, contamination=0.05)
    return parts["summary"]


@query("outlier_report_quick", f"""WITH {v.SENTENCES} SELECT least(count(*), 3000) AS total_sentences,
  CAST(0.02 AS DOUBLE) AS contamination_rate, 'Isolation Forest' AS algorithm FROM sentences""")
def report_quick(spark, sf):
    """The quick report of the first rows, whose number is what the report is cut to."""
    rows = v.sentences(spark, sf).withColumn("row", F.col("docID") * (1 << 32) + F.col("sentenceID"))
    return quick_report(rows, "row", 3000)["summary"].select("total_sentences", "contamination_rate", "algorithm")
