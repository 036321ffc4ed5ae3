"""``score_custom_model``: score any Python model object on Spark.

The object needs ``predict`` and ``predict_proba`` (and may offer
``transform``, applied first). The contract is checked on the driver before
any job starts; the object is pickled once into the task closure and
applied to Arrow record batches with ``mapInPandas``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame


def check_contract(model) -> None:
    missing = [m for m in ("predict", "predict_proba") if not callable(getattr(model, m, None))]
    if missing:
        raise TypeError(f"model lacks required methods: {missing}")


def score_with(df: DataFrame, model, key: str, text: str = "clinical_text") -> DataFrame:
    check_contract(model)
    classes = list(model.classes_)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[text]
            if callable(getattr(model, "transform", None)):
                x = model.transform(x)
            proba = model.predict_proba(x)
            yield pd.DataFrame({
                key: pdf[key].values,
                "target": model.predict(x),
                "probabilities": [dict(zip(classes, map(float, row))) for row in proba],
            })

    schema = f"{key} {dict(df.dtypes)[key]}, target string, probabilities map<string,double>"
    return df.select(key, text).mapInPandas(run, schema)


class KeywordModel:
    """A small rule model used as the custom-model example: the share of
    alarm words in a text drives a three-class score."""

    classes_ = ("atencao", "normal", "urgente")
    # Fixed vocabulary of the example rule.
    ALARM = ("pain", "blood", "chest", "fever", "breath", "urgent", "stupid", "idiot", "trash")

    def transform(self, texts: pd.Series) -> pd.Series:
        low = texts.fillna("").str.lower()
        hits = sum(low.str.count(w) for w in self.ALARM)
        words = low.str.split().str.len().clip(lower=1)
        return (hits / words).astype(float)

    def predict_proba(self, x: pd.Series):
        import numpy as np
        u = np.clip(x.to_numpy() * 20, 0, 1)
        n = 1 - u
        a = np.full_like(u, 0.2)
        p = np.stack([a, n, u], axis=1) + 1e-9
        return p / p.sum(axis=1, keepdims=True)

    def predict(self, x: pd.Series):
        import numpy as np
        return np.array(self.classes_)[self.predict_proba(x).argmax(axis=1)]
