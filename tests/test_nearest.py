"""Exact nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.oracle import compare, duck
from vitalis.operators import models as M
from vitalis.operators import nearest as NN


def points_of(spark, rows):
    return spark.createDataFrame([(i, [float(v) for v in x] if x is not None else None, y) for i, x, y in rows], "id long, x array<double>, label double").repartition(4)


def brute(rows, queries, k):
    out = {}
    for q in queries:
        near = sorted((sum((a - b) ** 2 for a, b in zip(q, x)), i, y) for i, x, y in rows)[:k]
        out[q] = [(r + 1, i, y, d) for r, (d, i, y) in enumerate(near)]
    return out


def found(searched, spark, queries):
    df = spark.createDataFrame([([float(v) for v in q],) for q in queries], "x array<double>")
    got = {}
    for r in searched.neighbours(df).collect():
        got.setdefault(tuple(r["x"]), []).append((r["rank"], r["id"], r["label"], r["distance"]))
    return {q: sorted(v) for q, v in got.items()}


def grid(n, seed, spread=6):
    rng = np.random.default_rng(seed)
    return [tuple(v) for v in rng.integers(0, spread, (n, 3)).astype(float).tolist()]


def test_equals_brute_force_with_ties_copies_and_far_queries(spark):
    xs = grid(900, 1, 9) + [(4.0, 4.0, 4.0)] * 500 + [(50.0, 50.0, 50.0), (51.0, 50.0, 50.0)]
    rows = [(k, x, float(k % 3)) for k, x in enumerate(xs)]
    queries = list(dict.fromkeys(grid(80, 2, 12) + [(4.0, 4.0, 4.0), (49.0, 50.0, 50.0), (-500.0, 0.0, 0.0), (0.5, 0.25, 7.75)]))
    searched = NN.Searched(points_of(spark, rows), 5, cell_rows=32, query_rows=8)
    assert searched.n < len(rows) - 450  # of equal points only five are kept
    assert found(searched, spark, queries + queries[:3]) == brute(rows, queries, 5)


def test_few_points_odd_rows_and_none(spark):
    rows = [(1, (0, 0), 1.0), (2, (3, 4), 0.0)]
    odd = rows + [(3, None, 1.0), (4, (float("nan"), 0), 1.0), (5, (float("inf"), 0), 0.0), (6, (1, 1), None)]
    searched = NN.Searched(points_of(spark, odd), 5)
    assert found(searched, spark, [(0, 0)]) == {(0.0, 0.0): [(1, 1, 1.0, 0.0), (2, 2, 0.0, 25.0)]}
    assert found(searched, spark, [(float("nan"), 0.0), (1.0, 1.0, 1.0)]) == {}
    assert NN.Searched(points_of(spark, rows).where("id > 9"), 5).neighbours(points_of(spark, rows)).collect() == []
    with pytest.raises(ValueError, match="dimensions"):
        NN.Searched(points_of(spark, rows + [(7, (1, 2, 3), 0.0)]), 5)


def test_most_cells_are_left_out(spark):
    rng = np.random.default_rng(4)
    rows = [(k, tuple(x), 0.0) for k, x in enumerate(rng.normal(size=(20_000, 3)).tolist())]
    queries = [tuple(x) for x in rng.normal(size=(300, 3)).tolist()]
    searched = NN.Searched(points_of(spark, rows), 5, cell_rows=128)
    got = found(searched, spark, queries)
    x, q = np.array([r[1] for r in rows]), np.array(queries)
    want = np.argsort(((q[:, None] - x[None]) ** 2).sum(2), axis=1)[:, :5]
    assert [[r[1] for r in got[t]] for t in queries] == want.tolist()
    assert searched.n_cells > 100 and searched.visits < 0.1 * searched.n_cells * len(queries)


def test_no_join_of_everything_with_everything(spark):
    searched = NN.Searched(points_of(spark, [(k, (k, 0), 0.0) for k in range(50)]), 2, cell_rows=8)
    plan = searched.neighbours(points_of(spark, [(1, (1, 1), 0.0)]))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("spread, n, k", [(4, 3000, 5), (1000, 3000, 5), (1000, 3, 5), (2, 200, 7)])
def test_search_inside_a_cell_equals_all_distances(spread, n, k):
    rng = np.random.default_rng(7)
    p, q = rng.integers(0, spread, (n, 3)).astype(float), rng.integers(-5, spread + 5, (400, 3)).astype(float)
    order = rng.permutation(n)
    told = lambda f: sorted(zip(f[0].tolist(), f[1].tolist(), f[2].tolist()))
    every = NN.best_of(q, p, order, k)
    assert told(NN.best_within(q, p, order, k, np.full(len(q), np.inf))) == told(every)
    reach = rng.uniform(0, spread, len(q)) ** 2
    near = every[2] <= reach[every[0]]
    assert told(NN.best_within(q, p, order, k, reach)) == told([c[near] for c in every])


def test_a_query_goes_down_the_tree_instead_of_to_all_cells(spark, monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(4)
    rows = [(k, tuple(x), 0.0) for k, x in enumerate(rng.normal(size=(6000, 3)).tolist())]
    searched = NN.Searched(points_of(spark, rows), 5, cell_rows=64)
    q, reach = rng.normal(size=(200, 3)), rng.uniform(0, 0.5, 200)
    far = NN.box_distances(q, searched.low, searched.high)
    batch = pa.RecordBatch.from_arrays([pa.array(q.tolist(), pa.list_(pa.float64())), pa.array(reach)], ["x", "reach"])
    assert searched.size.min() >= 5
    monkeypatch.setattr(NN, "box_distances", lambda *a: pytest.fail("all cells"))
    went = {}
    for second in (False, True):
        for b in searched._routes(second)(iter([batch])):
            for x, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                assert c not in went.setdefault(tuple(x), set())
                went[tuple(x)].add(c)
    own = searched.cells.of(q)
    for k, x in enumerate(q.tolist()):
        assert went[tuple(x)] == {*searched.number[far[k] <= reach[k]].tolist(), int(own[k])}


@pytest.mark.parametrize("kind, want", [("classification", [1.0, 0.0, 0.0]), ("regression", [0.6, 0.4, 0.4])])
def test_factory_models_vote_or_average_and_can_be_saved(spark, tmp_path, kind, want):
    near = [(0, 0.0, 1.0), (1, 0.1, 1.0), (2, 0.2, 1.0), (3, 0.3, 0.0), (4, 0.4, 0.0),
            (10, 10.0, 0.0), (11, 10.1, 0.0), (12, 10.2, 0.0), (13, 10.3, 1.0), (14, 10.4, 1.0)]
    df = spark.createDataFrame(near, "id long, a double, label double")
    model = M.create_pipeline(VectorAssembler(inputCols=["a"], outputCol="features"), kind, "KNN", {"idCol": "id"}).fit(df)
    asked = spark.createDataFrame([(1, 0.05), (2, 10.0), (3, 10.0)], "q long, a double")
    M.save_model(model, str(tmp_path / "knn"))
    for m in (model, M.load_model(str(tmp_path / "knn"))):
        got = m.transform(asked).orderBy("q").collect()
        assert [r["prediction"] for r in got] == pytest.approx(want)
    tie = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="features"), M.create("classification", "knn", {"k": 4})]).fit(df.where("id < 4 or id = 4"))
    assert tie.transform(asked.where("q = 2")).first()["prediction"] == 0.0  # two against two: the smaller label


def test_query_matches_its_oracle(spark):
    from vitalis.plans.registry import oracle_sql, queries
    res = compare(spark, SF_SMALL, "ml_knn", queries()["ml_knn"], oracle_sql()["ml_knn"], duck(SF_SMALL))
    assert res["status"] == "ok" and res["rows"], res
