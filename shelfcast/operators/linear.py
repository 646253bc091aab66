"""Least squares and ridge from one distributed Gram aggregate; only a d × d system reaches the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.config import LAMBDAS


@dataclass(frozen=True)
class Gram:
    """XᵀX, Xᵀy, yᵀy and the row count."""

    xx: np.ndarray
    xy: np.ndarray
    yy: float
    n: int

    def solve(self, lam: float = 0.0) -> np.ndarray:
        """Weights; the shortest ones if constant or collinear columns leave a choice."""
        return np.linalg.lstsq(self.xx + lam * np.eye(len(self.xy)), self.xy, rcond=None)[0]

    def mse(self, w: np.ndarray) -> float:
        return float((w @ self.xx @ w - 2 * w @ self.xy + self.yy) / self.n)


def gram_matrix(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row with the pairwise sums x{i}x{j} (i ≤ j), x{i}y, yy and n."""
    cols = [F.col(c).cast("double") for c in features]
    y = F.col(label).cast("double")
    sums = [F.sum(cols[i] * cols[j]).alias(f"x{i}x{j}") for i in range(len(cols)) for j in range(i, len(cols))]
    sums += [F.sum(c * y).alias(f"x{i}y") for i, c in enumerate(cols)]
    return df.dropna(subset=[*features, label]).agg(*sums, F.sum(y * y).alias("yy"), F.count(F.lit(1)).alias("n"))


def collect_gram(df: DataFrame, features: Sequence[str], label: str) -> Gram:
    row = gram_matrix(df, features, label).first()
    d = len(features)
    xx = np.array([[row[f"x{min(i, j)}x{max(i, j)}"] for j in range(d)] for i in range(d)])
    return Gram(xx, np.array([row[f"x{i}y"] for i in range(d)]), row["yy"], row["n"])


def ols(df: DataFrame, features: Sequence[str], label: str) -> np.ndarray:
    """Weights without an intercept."""
    return collect_gram(df, features, label).solve()


def ridge(df: DataFrame, features: Sequence[str], label: str, lam: float = 5.0) -> np.ndarray:
    """Weights that minimise ‖Xw − y‖² + λ‖w‖²."""
    return collect_gram(df, features, label).solve(lam)


def tune_lambda(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str, lambdas: Sequence[float] = LAMBDAS
) -> list[tuple[float, float]]:
    """(λ, validation MSE) for every λ from one pass over each split. The first smallest MSE is the best."""
    fitted, held = collect_gram(train, features, label), collect_gram(val, features, label)
    return [(lam, held.mse(fitted.solve(lam))) for lam in lambdas]


def predict(features: Sequence[str], weights: Sequence[float]) -> Column:
    """Linear prediction as a column expression."""
    return sum((F.col(c).cast("double") * float(w) for c, w in zip(features, weights)), F.lit(0.0))
