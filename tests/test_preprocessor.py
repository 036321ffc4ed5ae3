"""The preprocessor as a pipeline stage that is saved and loaded."""

import subprocess
import sys

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler

from vitalis.operators import features as FE
from vitalis.operators import models as M

ROWS = [(1, 0, 1.0, "b", 7), (2, 1, None, "a", 7), (3, 1, 5.0, None, 8), (4, 0, 2.0, "a", None), (5, None, 9.0, "c", 7)]
SCHEMA = "id long, flag int, n double, kind string, code int"


def fitted(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df, FE.TabularPreprocessor(binary=["flag"], numeric=["n"], categorical=["kind", "code"], keys=["id"]).fit(df)


def test_values(spark):
    df, model = fitted(spark)
    out = model.transform(df).orderBy("id")
    assert out.columns == ["id", "bin__flag", "num__n", "cat__kind_a", "cat__kind_b", "cat__kind_c", "cat__code_7", "cat__code_8"]
    rows = [tuple(r) for r in out.collect()]
    assert rows[1] == (2, 1, (3.5 - 1) / 8, 1, 0, 0, 1, 0)  # the median of 1, 2, 5, 9
    assert rows[2][3:] == (1, 0, 0, 0, 1) and rows[3][3:] == (1, 0, 0, 1, 0)  # the most frequent value
    other = spark.createDataFrame([(9, 1, 17.0, "new", 5)], SCHEMA)
    assert tuple(model.transform(other).first()) == (9, 1, 2.0, 0, 0, 0, 0, 0)  # unknown: zeros; no clipping
    assert "Join" not in model.transform(df)._jdf.queryExecution().toString()


def test_saved_model_gives_the_same_in_a_new_session(spark, tmp_path):
    df, model = fitted(spark)
    want = [tuple(r) for r in model.transform(df).orderBy("id").collect()]
    model.write().save(str(tmp_path / "model"))
    df.write.parquet(str(tmp_path / "rows"))
    script = f"""
from pyspark.sql import SparkSession
from vitalis.operators.features import TabularPreprocessorModel
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()
model = TabularPreprocessorModel.load({str(tmp_path / 'model')!r})
print('ROWS', [tuple(r) for r in model.transform(spark.read.parquet({str(tmp_path / 'rows')!r})).orderBy('id').collect()])
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    line = next(x for x in out.stdout.splitlines() if x.startswith("ROWS "))
    assert eval(line[5:]) == want


def test_in_a_pipeline_with_a_model(spark, tmp_path):
    df = spark.createDataFrame([(k, k % 2, float(k), "ab"[k % 2], float(k % 2)) for k in range(40)], "id long, flag int, n double, kind string, label double")
    prep = FE.TabularPreprocessor(binary=["flag"], numeric=["n"], categorical=["kind"], keys=["id", "label"])
    stages = [prep, VectorAssembler(inputCols=["bin__flag", "num__n", "cat__kind_a"], outputCol="features"),
              M.create("classification", "decision tree", {"labelCol": "label"})]
    model = Pipeline(stages=stages).fit(df)
    M.save_model(model, str(tmp_path / "p"))
    loaded = M.load_model(str(tmp_path / "p"))
    assert loaded.transform(df).where("prediction = label").count() == 40


def test_odd_columns(spark):
    df = spark.createDataFrame([(1, None, None, None, None), (2, None, None, None, None)], SCHEMA)
    model = FE.TabularPreprocessor(numeric=["n"], categorical=["kind"], keys=["id"]).fit(df)
    assert [tuple(r) for r in model.transform(df).orderBy("id").collect()] == [(1, 0.0), (2, 0.0)]
    with pytest.raises(RuntimeError, match="not fitted"):
        FE.TabularPreprocessor(numeric=["n"]).transform(df)
    many = spark.createDataFrame([(k, 0, 0.0, str(k), 0) for k in range(5)], SCHEMA)
    with pytest.raises(ValueError, match="more than 3"):
        FE.TabularPreprocessor(categorical=["kind"], max_categories=3).fit(many)
