"""Logistic regression by Newton steps, for few features and any number of rows.

A step needs the gradient and the matrix of second derivatives, sums over the rows that one aggregate takes; what comes to the
driver is one row of them, and the equations it solves have one unknown per feature. The fit ends when a step no longer
moves the coefficients, and the gradient there says how exact it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INTERCEPT = "intercept"


@dataclass(frozen=True)
class Newton:
    """Coefficients on standardised features, the intercept first, and the mean gradient where the fit ended."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    coefficients: tuple[float, ...]
    gradient: tuple[float, ...]

    def standardised(self) -> list[Column]:
        return [F.lit(1.0)] + [(F.col(f) - m) / d for f, m, d in zip(self.features, self.means, self.deviations, strict=True)]

    def margin(self) -> Column:
        total = F.lit(0.0)
        for weight, value in zip(self.coefficients, self.standardised(), strict=True):
            total = total + F.lit(weight) * value
        return total

    def predict(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("prediction", (self.margin() > 0).cast("double"))

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per coefficient; what is saved."""
        names, zeros = (INTERCEPT, *self.features), ((0.0, 1.0), *zip(self.means, self.deviations, strict=True))
        rows = [(k, n, m, d, c, g) for k, (n, (m, d), c, g) in enumerate(zip(names, zeros, self.coefficients, self.gradient, strict=True))]
        return spark.createDataFrame(
            rows, "place INT, feature STRING, mean DOUBLE, deviation DOUBLE, coefficient DOUBLE, gradient DOUBLE")


def load(table: DataFrame) -> Newton:
    rows = table.orderBy("place").collect()
    return Newton(
        tuple(r.feature for r in rows[1:]), tuple(r["mean"] for r in rows[1:]), tuple(r.deviation for r in rows[1:]),
        tuple(r.coefficient for r in rows), tuple(r.gradient for r in rows))


def fit(train: DataFrame, features: Sequence[str], penalty: float, label: str = "label", steps: int = 25) -> Newton:
    """``penalty`` is the ridge penalty per row on the standardised coefficients, not on the intercept.

    A constant feature gets deviation 1 and so stays zero. Rows with a null feature or label are left out; without rows
    all coefficients are zero. With a positive penalty the minimum is unique, also when the classes can be separated.
    """
    features = tuple(features)
    whole = train.dropna(subset=[*features, label]).select(*features, label)
    first = whole.agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(f).alias(f"m_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"d_{f}") for f in features]).first()
    n, width = first["rows"], len(features) + 1
    means = tuple(first[f"m_{f}"] or 0.0 for f in features)
    deviations = tuple(first[f"d_{f}"] or 1.0 for f in features)
    at = np.zeros(width)
    ridge = penalty * n * np.r_[0.0, np.ones(width - 1)]

    def model(gradient: np.ndarray) -> Newton:
        return Newton(features, means, deviations, tuple(map(float, at)), tuple(map(float, gradient)))

    if n == 0:
        return model(np.zeros(width))
    for _ in range(steps):
        now = model(np.zeros(width))
        z = now.standardised()
        chance = 1 / (1 + F.exp(-now.margin()))
        sums = [F.sum((F.col("__p") - F.col(label)) * z[i]).alias(f"g{i}") for i in range(width)]
        sums += [F.sum(F.col("__p") * (1 - F.col("__p")) * z[i] * z[j]).alias(f"h{i}_{j}") for i in range(width) for j in range(i + 1)]
        found = whole.withColumn("__p", chance).agg(*sums).first()
        gradient = np.array([found[f"g{i}"] for i in range(width)]) + ridge * at
        if np.abs(gradient).max() <= 1e-12 * n:
            break
        second = np.array([[found[f"h{max(i, j)}_{min(i, j)}"] for j in range(width)] for i in range(width)])
        at = at - np.linalg.solve(second + np.diag(ridge + 1e-12), gradient)
    return model(gradient / n)
