"""Evaluator values, factory, fail-fast preconditions, end-to-end training on
18 rows, scoring invariants and the custom-model contract."""

import pytest
from pyspark.sql import functions as F

from vitalis.operators import evaluate as EV
from vitalis.operators import gates as G
from vitalis.operators import models as M
from vitalis.operators import score as SC
from vitalis.operators.custom import KeywordModel, check_contract


def test_binary_metrics(spark):
    df = spark.createDataFrame([(0, 0, .1), (0, 1, .6), (1, 1, .8), (1, 1, .9)], "y_true int, y_pred int, score double")
    m = EV.global_metrics(df).first()
    assert m["accuracy"] == 0.75
    assert m["precision"] == pytest.approx(2 / 3, abs=1e-6)
    assert m["recall"] == 1.0
    assert EV.auc_binary(df).first()["roc_auc"] == 1.0


def test_auc_ties_get_half_credit(spark):
    df = spark.createDataFrame([(0, .5), (1, .5), (0, .2), (1, .9)], "y_true int, score double")
    # pairs: (.5,.5) tie -> .5, (.9>.5), (.9>.2), (.5>.2) -> 3.5 / 4
    assert EV.auc_binary(df).first()["roc_auc"] == pytest.approx(0.875)


def test_multiclass_columns(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (2, 2), (1, 0), (0, 0)], "y_true int, y_pred int")
    assert set(EV.global_metrics(df).columns) >= {"accuracy", "f1_macro", "f1_weighted", "precision_weighted"}
    assert EV.by_class(df).columns == ["class", "precision", "recall", "f1", "support"]


def test_factory_normalises_and_lists_choices():
    assert type(M.create("Classification", "Random Forest")).__name__ == "RandomForestClassifier"
    with pytest.raises(ValueError, match="choices"):
        M.create("classification", "no_such_model")


def _texts(spark, all_train=False):
    words = {"normal": "mild cough stable", "atencao": "fever vomiting pain", "urgente": "chest unconscious bleeding"}
    rows = []
    for cls, w in words.items():
        for i in range(6):
            split = "train" if (all_train or i < 4) else "validation"
            rows.append((f"{w} case {i}", cls, split, "test-dataset-v1"))
    return spark.createDataFrame(rows, "clinical_text string, target string, split string, dataset_version string")


def test_fit_precondition_names_missing_validation(spark):
    df = _texts(spark, all_train=True)
    row = df.agg((F.countDistinct(F.when(F.col("split") == "validation", F.col("target"))) == 3)
                 .alias("validation_all_classes"))
    with pytest.raises(ValueError, match="validation_all_classes"):
        G.enforce(G.checks_long(row, row.columns))


def test_train_logistic_and_score(spark):
    df = _texts(spark)
    model = M.fit_text_logistic(df.where("split = 'train'"), max_iter=200, min_df=1)
    pred = model.transform(df.where("split = 'validation'"))
    m = EV.global_metrics(pred.select(F.col("target").alias("y_true"), F.col("predicted_target").alias("y_pred")))
    assert m.first()["f1_macro"] == 1.0
    probs = pred.select(SC.probability_map(["atencao", "normal", "urgente"]).alias("p"))
    sums = probs.select(F.aggregate(F.map_values("p"), F.lit(0.0), lambda a, x: a + x).alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-5 for r in sums)


def test_custom_model_contract(spark):
    class NoProba:
        def predict(self, x):
            return x

    with pytest.raises(TypeError, match="predict_proba"):
        check_contract(NoProba())
    check_contract(KeywordModel())


def test_request_validity(spark):
    df = spark.createDataFrame([("   ",), ("ok",), ("x" * 5001,)], "clinical_text string")
    out = [(r["valid"], r["reason"]) for r in SC.request_validity(df).collect()]
    assert out == [(False, "empty"), (True, None), (False, "too_long")]


def test_the_comparison_fits_the_whole_forest(monkeypatch):
    from unittest.mock import MagicMock

    from vitalis.plans.catalog import models as C
    fitted = []
    monkeypatch.setattr(C, "_tabular", lambda spark, sf: (None, None))
    monkeypatch.setattr(C, "_metrics", lambda *a: MagicMock())
    monkeypatch.setattr(C, "materialize", lambda rows, name: rows)
    monkeypatch.setattr(C.M, "create", lambda kind, name, params: (name, params))
    monkeypatch.setattr(C.M, "fit_and_score", lambda name, est, *a: (fitted.append(est), None, 0.0))
    C.q_ml_compare(None, None)
    alone = dict(fitted)["random_forest"]
    fitted.clear()
    C.q_ml_random_forest(None, None)
    assert fitted == [("random_forest", alone)] and alone == {"numTrees": 100, "maxDepth": 10}
