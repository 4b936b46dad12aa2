"""The compared classifiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression

from tidemark.ml.preparation import VECTOR

LOGISTIC, FOREST, BOOSTING = "Logistic Regression", "Random Forest", "Gradient Boosting"


@dataclass(frozen=True)
class Settings:
    """Fixed values of the compared models and of the validation scheme.

    ``one_hot`` gives all candidates indicator columns instead of text ordinals.
    """

    inverse_penalty: float = 0.5
    logistic_iterations: int = 1000
    forest_trees: int = 200
    forest_depth: int = 6
    boosting_rounds: int = 300
    boosting_depth: int = 5
    boosting_step: float = 0.05
    boosting_sample: float = 0.8
    test_share: float = 0.2
    folds: int = 5
    seed: int = 42
    beta: float = 2.0
    one_hot: bool = False
    models: tuple[str, ...] = (LOGISTIC, FOREST, BOOSTING)


def logistic(settings: Settings, n_train: int) -> LogisticRegression:
    """The linear candidate; the ridge penalty depends on the number of training rows."""
    return LogisticRegression(
        featuresCol=VECTOR,
        labelCol="label",
        weightCol="balanced_weight",
        regParam=1.0 / (settings.inverse_penalty * n_train),
        elasticNetParam=0.0,
        maxIter=settings.logistic_iterations,
        standardization=False,
    )
