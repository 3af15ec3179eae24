"""The model queries learn from every pair of their splits, however many there are."""

import numpy as np
import pyarrow as pa
import pytest

from kinlink.operators import classifier
from kinlink.operators.features import FEATURES
from kinlink.queries import linkage as q

N, REST = 130_000, 3_000


@pytest.fixture
def given(spark, monkeypatch):
    """Labelled pairs of an entity each in place of those of the documents, two trees, and the model of all fitting pairs."""
    r = np.random.default_rng(8)
    n = N + 2 * REST
    x = r.integers(0, 40, (n, len(FEATURES))) / 39
    y = ((x[:, 2] > 0.5) ^ (x[:, 7] > 0.6) ^ (r.random(n) < 0.1)).astype(int)
    split = np.array(["fitting"] * N + ["tuning"] * REST + ["holdout"] * REST)
    ids = [f"S1-{i}" for i in range(n)]
    columns = {"ref_id": ids, "target_id": ["S2-1"] * n, "label": pa.array(y, pa.int32())} | dict(zip(FEATURES, x.T, strict=True))
    pairs = spark.createDataFrame(pa.table(columns | {"split": split})).persist()
    entities = spark.createDataFrame(pa.table({"ref_id": ids, "country": ["c"] * n, "n_true": y, "split": split})).persist()
    monkeypatch.setattr(q, "_labelled", lambda spark, sf_dir: (entities, pairs))
    monkeypatch.setitem(q.OPTIONS, "iterations", 2)
    yield x, y, classifier.boost(x[:N], y[:N].astype(float), 2)
    pairs.unpersist()
    entities.unpersist()


def probabilities(found):
    table = found.select("ref_id", "probability").toArrow()
    order = np.array([int(k[3:]) for k in table.column("ref_id").to_pylist()])
    out = np.empty(len(order))
    out[order] = table.column("probability").to_numpy()
    return out


def expected(model, x):
    return pytest.approx(1 / (1 + np.exp(-model.logit(x))), abs=1e-12)


def test_fit_classifier_learns_from_all_fitting_pairs(spark, given):
    x, _, model = given
    assert probabilities(q.SPARK["fit_classifier"](spark, "")) == expected(model, x)


def test_feature_importance_is_that_of_all_fitting_pairs(spark, given):
    _, _, model = given
    found = {r.feature: r.importance for r in q.SPARK["feature_importance"](spark, "").collect()}
    assert found == pytest.approx(classifier.importance(model), abs=1e-12)


def test_model_report_is_that_of_a_model_and_threshold_of_all_pairs(spark, given, monkeypatch):
    x, y, model = given
    seen, choose = [], q.metrics.choose_threshold

    def noted(entities, scored):
        seen.append(probabilities(scored))
        return choose(entities, scored)

    monkeypatch.setattr(q.metrics, "choose_threshold", noted)
    found = {r.split: (r.entities, r.singletons) for r in q.SPARK["model_report"](spark, "").collect()}
    assert seen[0] == expected(model, x)
    at = np.cumsum([0, N, REST, REST])
    assert found == {s: (b - a, int((y[a:b] == 0).sum())) for s, a, b in zip(["fitting", "tuning", "holdout"], at, at[1:])}


def test_refit_final_learns_from_all_pairs(spark, given):
    x, y, _ = given
    assert probabilities(q.SPARK["refit_final"](spark, "")) == expected(classifier.boost(x, y.astype(float), 2), x)
