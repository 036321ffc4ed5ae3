"""What is shuffled: codes instead of rows, bytes instead of digits."""

import pytest
from pyspark.sql import functions as F

from vitalis.operators import clean as C
from vitalis.operators import models as M
from vitalis.operators import nets
from vitalis.operators.split import group_folds
from vitalis.plans import training_table as TT


def test_large_code_book_gives_the_labels_of_a_small_one(spark, monkeypatch):
    cols = ("RFV1", "RFV2", "RFV3")
    rows = [(1, 5, 6, -9, "a"), (1, 5, 6, -9, "a"), (1, 7, 5, 5, "b"), (None, 6, -9, 99, "c"), (None, 6, -9, 99, "d"),
            (2, -9, -9, -9, "e"), (3, None, 0, 7, None)]
    df = spark.createDataFrame(rows, "visit_row long, RFV1 long, RFV2 long, RFV3 long, other string")
    book = spark.createDataFrame([(5, "five"), (6, "six"), (7, None), (-9, "none"), (0, "zero")], "code int, label string")
    told = lambda d: sorted(map(repr, d.collect()))
    small = C.decode_complaints(df, book, cols)
    monkeypatch.setattr("vitalis.session.BROADCAST_MAX_ROWS", 1)
    monkeypatch.setattr(C, "decode_complaints_wide", None)  # would shuffle the rows once a slot
    large = C.decode_complaints(df, book, cols)
    assert large.dtypes == small.dtypes
    assert told(large) == told(small) and len(rows) == small.count()


def test_groups_in_bytes_get_the_folds_of_their_digits(spark):
    df = spark.range(3000).select(F.sha2((F.col("id") % 700).cast("string"), 256).alias("text_hash"),
                                  F.element_at(F.array(F.lit("urgente"), F.lit("normal"), F.lit("atencao")), (F.col("id") % 700 % 3 + 1).cast("int")).alias("target"))
    df = df.union(spark.createDataFrame([(None, "normal"), (None, "urgente")], df.schema))
    told = lambda d: sorted(map(repr, d.collect()))
    digits = group_folds(df)
    by_bytes = group_folds(df.withColumn("text_hash", F.unhex("text_hash")))
    assert told(by_bytes.withColumn("text_hash", F.lower(F.hex("text_hash")))) == told(digits)


def test_training_rows_are_split_by_bytes(spark, monkeypatch):
    from tests.conftest import SF_SMALL
    from vitalis.sources import fixtures as FX
    kinds, real = [], TT.assign_splits

    def seen(rows):
        kinds.append(dict(rows.dtypes))
        return real(rows)
    monkeypatch.setattr(TT, "assign_splits", seen)
    args = FX.visits(spark, SF_SMALL), FX.rfv_codebook(spark, SF_SMALL), FX.sex_codebook(spark)
    built, lazy = TT.build_training_table(*args), TT.build_training_table(*args, materialize_rows=False)
    assert kinds[0]["text_hash"] == kinds[0]["record_id"] == "binary"
    assert sorted(built.collect()) == sorted(lazy.collect())


def test_text_optimiser_has_a_bounded_number_of_rows_a_task(spark, monkeypatch):
    texts = ["red ring hot", "old gear cold", "blue anvil warm", "red gear hot"]
    df = spark.createDataFrame([(texts[k % 4], ("a", "b")[k % 2]) for k in range(80)], "clinical_text string, target string").coalesce(1)
    parts, real = [], M.MC.LogisticRegression.fit
    monkeypatch.setattr(M.MC.LogisticRegression, "fit", lambda self, d: parts.append(d.rdd.getNumPartitions()) or real(self, d))
    monkeypatch.setattr(M, "TEXT_ROWS", 10, raising=False)
    model = M.fit_text_logistic(df)
    assert parts == [8]
    assert model.transform(df).where("target = predicted_target").count() == 80


@pytest.mark.parametrize("rows", [[[3, 1, 3], [], [0, 2, 0], [5]], [[]], [[4] * 9]])
def test_pooled_sums(rows):
    import numpy as np
    w = nets.PooledNet.start(8, 4, 3, 1)
    want = np.array([np.mean([w["e"][t] for t in r if t] or [np.zeros(4)], axis=0) for r in rows])
    np.testing.assert_allclose(nets.PooledNet.pooled(w["e"], [np.array(r, np.int32) for r in rows]), want)
    values = np.arange(12.0).reshape(4, 3)
    assert nets.PooledNet._summed(values, np.array([2, 0, 2, 0]), 3).tolist() == [[12, 14, 16], [0, 0, 0], [6, 8, 10]]
