"""Next-bar direction: features, split, fit, score, records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ("open", "high", "low", "close", "volume")


def feature_frame(labelled: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Numeric feature columns and a double label."""
    kept = [c for c in labelled.columns if c not in (*features, "label")]
    return labelled.select(
        *kept, *[F.col(c).cast("double").alias(c) for c in features], F.col("label").cast("double").alias("label")
    )


def split_rows(df: DataFrame, key: str, day: str, train_tenths: int = 7) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by whole-number arithmetic on a key and a day: the same rows however the table is partitioned,
    and in any engine."""
    bucket = F.pmod(F.col(key) * 31 + F.datediff(F.to_date(day), F.lit("1970-01-01").cast("date")) * 17, F.lit(10))
    return df.filter(bucket < train_tenths), df.filter(bucket >= train_tenths)


def fit(train: DataFrame, penalty: float, features: Sequence[str] = FEATURES, max_iter: int = 100) -> PipelineModel:
    """Logistic regression with a ridge penalty on unscaled features. ``penalty`` is per row: ``1 / rows``
    gives the unit penalty on the summed loss that single-machine libraries use."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    model = LogisticRegression(regParam=penalty, elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    return Pipeline(stages=[assembler, model]).fit(train)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).drop("features", "rawPrediction", "probability")


def accuracy(predicted: DataFrame) -> DataFrame:
    """Share of rows whose prediction equals the label."""
    return predicted.agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("rows"),
    )


def log_run(predicted: DataFrame, params: dict[str, str], path: str) -> None:
    """Append the score and parameters of a run to a metrics table."""
    noted = F.create_map(*[F.lit(x) for pair in params.items() for x in pair])
    accuracy(predicted).select(
        "accuracy", "rows", noted.alias("params"), F.current_timestamp().alias("logged_at")
    ).write.mode("append").parquet(path)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
