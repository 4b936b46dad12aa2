import uuid
from types import SimpleNamespace

import pytest

from tidemark.ml import training
from tidemark.ml.candidates import Settings
from tidemark.plans import registry


@pytest.mark.parametrize(
    "name",
    ["model_comparison", "forest_importance", "permutation_importance", "churn_scores", "driver_importance", "model_report",
     "top_drivers", "insight_report"],
)
def test_registered_model_queries_fit_the_full_ensembles(spark, monkeypatch, small_ensembles, name):
    asked = []

    class Seen(Exception):
        pass

    def compare(features, settings=Settings(), **more):
        asked.append(settings)
        raise Seen

    monkeypatch.setattr(registry, "ENSEMBLES", small_ensembles)  # as registered, outside the test run
    monkeypatch.setattr(registry, "settle", lambda df, name: spark.range(1))
    monkeypatch.setattr(training, "compare", compare)
    with pytest.raises(Seen):
        registry.MODEL_PLANS[name](SimpleNamespace(spark=spark, fingerprint=lambda: uuid.uuid4().hex, features=lambda: None))
    full = Settings()
    assert (asked[0].forest_trees, asked[0].boosting_rounds) == (full.forest_trees, full.boosting_rounds) == (200, 300)
