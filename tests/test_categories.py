"""Sparse one-hot codes against plain Python."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from vitalis.operators import categories as CT
from vitalis.operators import models as M


def coded(out, name, key="id"):
    v = F.unwrap_udt(name)
    return {r[0]: (r[1], r[2]) for r in out.select(key, v["size"], F.get(v["indices"], F.lit(0))).collect()}


def test_dictionary_numbers_values_in_order(spark):
    values = ["b", "a", None, "é", "b", "", "Z", "\U0001f600", "￮"] * 3
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(7)
    got = {r["value"]: r["id"] for r in CT.dictionary(df, "v").collect()}
    assert got == {v: k for k, v in enumerate(sorted({v for v in values if v is not None}, key=lambda v: v.encode()))}


def test_a_hundred_thousand_categories(spark):
    n = 100_000
    # A third of all rows has one value.
    df = spark.range(150_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % n).alias("code"))
    model = CT.SparseOneHot(["code"]).fit(df)
    seen = {0} | {k % n for k in range(150_000) if k % 3}
    assert model.sizes == {"code": len(seen)}
    number = {v: k for k, v in enumerate(sorted(map(str, seen)))}
    out = coded(model.transform(df), "cat__code")
    assert len(out) == 150_000
    assert all(out[k] == (len(seen), number[str(0 if k % 3 == 0 else k % n)]) for k in range(0, 150_000, 37))
    # The shuffle join gives the same.
    model._small["code"] = False
    assert coded(model.transform(df), "cat__code") == out


def test_saved_in_a_pipeline_unknown_null_and_empty(spark, tmp_path):
    schema = "id long, kind string, code int, none string"
    train = spark.createDataFrame([(1, "b", 7, None), (2, "a", 7, None), (3, None, 8, None), (4, "b", None, None)], schema)
    asked = spark.createDataFrame([(1, "a", 8, "x"), (2, "new", 7, None), (3, None, 9, None)], schema)
    fitted = Pipeline(stages=[CT.SparseOneHot(["kind", "code", "none"])]).fit(train)
    M.save_model(fitted, str(tmp_path / "m"))
    for model in (fitted, M.load_model(str(tmp_path / "m"))):
        out = model.transform(asked)
        assert out.columns == ["id", "kind", "code", "none", "cat__kind", "cat__code", "cat__none"]
        assert coded(out, "cat__kind") == {1: (2, 0), 2: (2, None), 3: (2, None)}
        assert coded(out, "cat__code") == {1: (2, 1), 2: (2, 0), 3: (2, None)}
        assert coded(out, "cat__none") == {1: (1, None), 2: (1, None), 3: (1, None)}
