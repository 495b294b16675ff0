"""Classification: scaling, random forest, evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def fit_scaler(train: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per feature; a constant feature gets deviation 1."""
    row = train.agg(
        *[F.avg(f).alias(f"{f}_mean") for f in features], *[F.stddev_pop(f).alias(f"{f}_std") for f in features]
    ).first()
    return {f: (row[f"{f}_mean"] or 0.0, row[f"{f}_std"] or 1.0) for f in features}


def scale(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Replace each feature by its standardised value."""
    return df.withColumns({f: (F.col(f) - F.lit(mean)) / F.lit(std) for f, (mean, std) in scaler.items()})


def _scaler_stage(scaler: Mapping[str, tuple[float, float]]):
    """The same scaling as a stage that is saved with the model."""
    from pyspark.ml.feature import SQLTransformer

    scaled = ", ".join(
        f"(CAST(`{f}` AS DOUBLE) - {mean!r}D) / {std!r}D AS `_scaled_{f}`" for f, (mean, std) in scaler.items()
    )
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


def train_classifier(
    train: DataFrame, features: Sequence[str], label: str,
    trees: int = 100, depth: int = 10, min_leaf: int = 2, seed: int = 42,
):
    """A fitted pipeline: scaling, assembling by feature name, random forest, label names."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler

    # several passes read these few columns; losing a cached block only recomputes it
    rows = train.select(label, *features).persist(StorageLevel.MEMORY_AND_DISK)
    names = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(rows)
    prepare = Pipeline(stages=[
        _scaler_stage(fit_scaler(rows, features)),
        VectorAssembler(inputCols=[f"_scaled_{f}" for f in features], outputCol="_features", handleInvalid="keep"),
    ]).fit(rows)
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="_label", predictionCol="_prediction", probabilityCol="_probability",
        rawPredictionCol="_raw", numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed,
    ).fit(names.transform(prepare.transform(rows)))
    rows.unpersist()
    # A copy has no training summary. The summary holds the session, which tasks cannot be sent once it has observed a query.
    forest = forest.copy()
    back = IndexToString(inputCol="_prediction", outputCol="_predicted", labels=names.labels)
    return PipelineModel(stages=[*prepare.stages, forest, back])


def predict(model, df: DataFrame, label_type: str = "int") -> DataFrame:
    """Add ``quality`` and ``confidence``, the largest class probability."""
    from pyspark.ml.functions import vector_to_array

    return (
        model.transform(df)
        .withColumn("quality", F.col("_predicted").cast(label_type))
        .withColumn("confidence", F.array_max(vector_to_array("_probability")))
        .select(*[c for c in df.columns if c not in ("quality", "confidence")], "quality", "confidence")
    )


def feature_importance(spark, model, k: int | None = 5) -> DataFrame:
    """(feature, importance), largest first."""
    forest = next(s for s in model.stages if hasattr(s, "featureImportances"))
    names = next(s for s in model.stages if hasattr(s, "getInputCols")).getInputCols()
    values = forest.featureImportances.toArray()
    rows = [(name.removeprefix("_scaled_"), float(values[i])) for i, name in enumerate(names)]
    ranked = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return ranked.limit(k) if k else ranked


def accuracy(df: DataFrame, label: str, prediction: str, split: str | None = None) -> DataFrame:
    """Share of correct predictions, per value of ``split`` if given."""
    correct = F.avg(F.coalesce((F.col(label) == F.col(prediction)).cast("double"), F.lit(0.0))).alias("accuracy")
    return df.groupBy(split).agg(correct) if split else df.agg(correct)


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows (class, precision, recall, f1, support) per class, then accuracy, macro and weighted means.

    Undefined ratios are 0. Only the confusion counts, one row per pair of classes, are shuffled.
    """
    pairs = df.groupBy(
        F.col(label).cast("string").alias("label"), F.col(prediction).cast("string").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("class"), none.alias("support"), F.col("n").alias("predicted"),
                 none.alias("tp")),
    )
    counts = pairs.select(F.inline(sides)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "tp")]
    )
    zero = F.lit(0.0)
    per_class = counts.select(
        "class", "support", "tp",
        F.coalesce(F.try_divide("tp", "predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide("tp", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("tp"), F.col("support") + F.col("predicted")), zero).alias("f1"),
    )
    ratios = ["precision", "recall", "f1"]
    total = F.coalesce(F.sum("support"), F.lit(0)).alias("support")
    right = F.coalesce(F.try_divide(F.sum("tp"), F.sum("support")), zero)

    def weighted(c: str):
        return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")), zero).alias(c)

    summary = per_class.agg(
        total,
        F.array(
            F.struct(F.lit("accuracy").alias("class"), *[right.alias(c) for c in ratios]),
            F.struct(F.lit("macro avg").alias("class"), *[F.coalesce(F.avg(c), zero).alias(c) for c in ratios]),
            F.struct(F.lit("weighted avg").alias("class"), *[weighted(c) for c in ratios]),
        ).alias("rows"),
    ).select("support", F.inline("rows"))
    columns = ["class", *ratios, "support"]
    return per_class.select(*columns).unionByName(summary.select(*columns))
