"""Model training, comparison, gates (2.8, 2.10) and scoring (2.12)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.functions import text as X
from vitalis.operators import evaluate as EV
from vitalis.operators import gates as G
from vitalis.operators import models as M
from vitalis.operators import nearest as NN
from vitalis.operators import runlog as R
from vitalis.operators import score as SC
from vitalis.operators.quantiles import exact_quantiles
from vitalis.plans.catalog.eda import eda
from vitalis.plans.catalog.learn import MAJ_SQL
from vitalis.plans.registry import register
from vitalis.plans.training_table import source_key, training_table
from vitalis.session import checkpoint_dir, materialize, scratch
from vitalis.sources import fixtures as FX
from vitalis.sources.tables import table
from vitalis.streaming import serving as SV

TAB_FEATURES = ["AGE", "temperature_f", "heart_rate", "respiratory_rate", "systolic_bp", "diastolic_bp",
                "oxygen_saturation", "pain_scale"]


def _train_valid_text(spark, sf):
    t = training_table(spark, sf).select("record_id", "clinical_text", "target", "split")
    return t.where(F.col("split") == "train"), t.where(F.col("split") == "validation")


def _tabular(spark, sf):
    """EDA cohort features with the training table's split (joined on the
    record id, so both views share one leak-free assignment)."""
    e = eda(spark, sf).withColumn("record_id", X.record_id("visit_row"))
    splits = training_table(spark, sf).select("record_id", "split")
    rows = materialize(e.join(splits, "record_id").select("visit_row", "target", "split", *TAB_FEATURES)
                       .withColumn("AGE", F.col("AGE").cast("double")), "tabular-rows")
    # Medians come from the training rows alone and are applied to all.
    frame = M.tabular_frame(rows, TAB_FEATURES, keep=("visit_row", "target", "split"),
                            fit_on=rows.where(F.col("split") == "train"))
    frame = materialize(frame.select("visit_row", "target", "split", "features"), "tabular")
    return frame.where(F.col("split") == "train"), frame.where(F.col("split") == "validation")


def _metrics(pred, name, digits=6):
    both = pred.select(F.col("target").alias("y_true"), F.col("predicted_target").alias("y_pred"))
    m, rec = EV.global_metrics(both, digits=digits), EV.by_class(both, digits=digits)
    ur = rec.where(F.col("class") == "urgente").select(F.col("recall").alias("urgent_recall"), F.lit(0).alias("_g"))
    out = m.withColumn("_g", F.lit(0)).join(ur, "_g", "left").drop("_g")
    return out.select(F.lit(name).alias("model"), "*")


# --- factory and estimators ----------------------------------------------------------

@register("ml_factory")
def q_ml_factory(spark, sf):
    """The factory on the tables: per problem type, a two-stage pipeline
    (preprocessing stage, then the estimator picked by a display name that
    the factory normalises) fitted and scored -- classification on the
    visits' triage features (label indexer + logistic regression, held-out
    accuracy), regression on ``lineitem`` (assembler + least squares, r2).
    Dummy models and the tree, forest and boosting regressors are fitted too.
    One row per model with the estimator class the registry chose."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    train, valid = _tabular(spark, sf)
    clf = M.create_pipeline(StringIndexer(inputCol="target", outputCol="label_id", stringOrderType="alphabetAsc"),
                            "Classification", "Logistic Regression",
                            {"featuresCol": "features", "labelCol": "label_id", "maxIter": 100})
    acc = MulticlassClassificationEvaluator(labelCol="label_id", metricName="accuracy").evaluate(
        clf.fit(train).transform(valid))
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    reg = M.create_pipeline(VectorAssembler(inputCols=["l_quantity"], outputCol="features"),
                            "regression", "linear-regression", {"labelCol": "l_extendedprice"})
    r2 = RegressionEvaluator(labelCol="l_extendedprice", metricName="r2").evaluate(reg.fit(li).transform(li))
    rows = [("classification", M.normalize_name("Logistic Regression"), type(clf.getStages()[1]).__name__,
             "StringIndexer > LogisticRegression", "accuracy", round(float(acc), 6)),
            ("regression", M.normalize_name("linear-regression"), type(reg.getStages()[1]).__name__,
             "VectorAssembler > LinearRegression", "r2", round(float(r2), 6))]
    dummy = M.create_pipeline(StringIndexer(inputCol="target", outputCol="label_id", stringOrderType="alphabetAsc"),
                              "classification", "dummy", {"labelCol": "label_id"})
    acc = MulticlassClassificationEvaluator(labelCol="label_id", metricName="accuracy").evaluate(dummy.fit(train).transform(valid))
    rows.append(("classification", "dummy", "Dummy", "StringIndexer > Dummy", "accuracy", round(float(acc), 6)))
    for name in ("dummy", "decision tree", "random forest", "gradient boosting", "hist-gradient-boosting"):
        reg = M.create_pipeline(VectorAssembler(inputCols=["l_quantity"], outputCol="features"), "regression", name,
                                {"labelCol": "l_extendedprice"})
        r2 = RegressionEvaluator(labelCol="l_extendedprice", metricName="r2").evaluate(reg.fit(li).transform(li))
        kind = type(reg.getStages()[1]).__name__
        rows.append(("regression", M.normalize_name(name), kind, f"VectorAssembler > {kind}", "r2", round(float(r2), 6)))
    return spark.createDataFrame(rows, "problem_type string, model_name string, estimator string, "
                                       "pipeline string, metric string, value double")


@register("ml_logistic")
def q_ml_logistic(spark, sf):
    train, valid = _train_valid_text(spark, sf)
    model = M.fit_text_logistic(train)
    return _metrics(model.transform(valid), "tfidf_logistic")


@register("ml_text_pooled")
def q_ml_text_pooled(spark, sf):
    train, valid = _train_valid_text(spark, sf)
    model = M.fit_text_pooled(train)
    return _metrics(model.transform(valid), "pooled_embedding")


@register("ml_dummy_class", [], """
SELECT quality, round(count(*) / sum(count(*)) OVER (), 6) AS share,
  row_number() OVER (ORDER BY count(*) DESC, quality) = 1 AS is_majority FROM labels GROUP BY quality""")
def q_ml_dummy_class(spark, sf):
    d = M.dummy_classifier(table(spark, sf, "labels"), "quality")
    return d.withColumn("share", F.round("share", 6))


@register("ml_dummy_reg", [], """
SELECT o_orderkey, round((SELECT avg(o_totalprice) FROM orders), 6) AS prediction FROM orders""")
def q_ml_dummy_reg(spark, sf):
    o = table(spark, sf, "orders")
    mean = o.agg(F.avg("o_totalprice").alias("m"), F.lit(0).alias("_g"))
    return o.withColumn("_g", F.lit(0)).join(F.broadcast(mean), "_g").select(
        "o_orderkey", F.round("m", 6).alias("prediction"))


@register("ml_linear_reg", [], """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""")
def q_ml_linear_reg(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    data = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    model = M.create("regression", "Linear Regression", {"labelCol": "l_extendedprice"}).fit(data)
    return spark.createDataFrame([(round(float(model.coefficients[0]), 4), round(float(model.intercept), 4))],
                                 "slope double, intercept double")


#: The forest, alone and in the comparison.
FOREST = {"numTrees": 100, "maxDepth": 10}


def _tab_model(spark, sf, name, params):
    train, valid = _tabular(spark, sf)
    est = M.create("classification", name, params)
    _, pred, _ = M.fit_and_score(name, est, train, valid)
    return _metrics(pred, name)


@register("ml_decision_tree")
def q_ml_decision_tree(spark, sf):
    return _tab_model(spark, sf, "decision_tree", {"maxDepth": 5})


@register("ml_random_forest")
def q_ml_random_forest(spark, sf):
    return _tab_model(spark, sf, "random_forest", FOREST)


@register("ml_gradient_boosting")
def q_ml_gradient_boosting(spark, sf):
    return _tab_model(spark, sf, "gradient_boosting", {})


@register("ml_hist_boosting")
def q_ml_hist_boosting(spark, sf):
    return _tab_model(spark, sf, "hist_gradient_boosting", {})


KNN_SQL = """
WITH r AS (SELECT e.*, t.split, CAST(e.AGE AS DOUBLE) AS f0, {named} FROM eda e
  JOIN train_text x USING (visit_row) JOIN training t ON t.record_id = x.record_id),
m AS (SELECT {medians} FROM r WHERE split = 'train'),
f AS (SELECT visit_row, r.target, split, {filled} FROM r, m),
d AS (SELECT q.visit_row AS q, min({{'d': {distance}, 'i': p.visit_row, 't': p.target}}, 5) AS near
  FROM f q JOIN f p ON q.split = 'validation' AND p.split = 'train' GROUP BY q.visit_row),
n AS (SELECT q, unnest(near) AS u FROM d),
v AS (SELECT q, u.t AS t, count(*) AS c FROM n GROUP BY q, u.t)
SELECT q AS visit_row, (SELECT arg_min(t, (-c, t)) FROM v WHERE v.q = n.q) AS predicted_target,
  round(avg(CASE WHEN u.t = 'urgente' THEN 1.0E0 ELSE 0.0E0 END), 6) AS urgent_share, round(max(u.d), 6) AS reach
FROM n GROUP BY q""".format(
    named=", ".join(f"e.{c} AS f{k}" for k, c in enumerate(TAB_FEATURES) if k),
    medians=", ".join(f"quantile_cont(f{k}, 0.5) AS m{k}" for k in range(len(TAB_FEATURES))),
    filled=", ".join(f"coalesce(f{k}, m{k}) AS f{k}" for k in range(len(TAB_FEATURES))),
    distance=" + ".join(f"(q.f{k} - p.f{k}) * (q.f{k} - p.f{k})" for k in range(len(TAB_FEATURES))))


@register("ml_knn", ["eda", "training"], KNN_SQL)
def q_ml_knn(spark, sf):
    """The five nearest training visits of each validation visit by the
    triage features, exactly: the majority class, the share of urgent ones
    (the mean of a 0/1 label) and the squared distance of the fifth."""
    from pyspark.ml.functions import vector_to_array
    train, valid = _tabular(spark, sf)
    ids = {c: float(k) for k, c in enumerate(sorted(S.TARGET_ORDER))}
    label = F.create_map(*[F.lit(v) for pair in ids.items() for v in pair])
    model = M.create("classification", "knn", {"idCol": "visit_row"}).fit(train.withColumn("label", label[F.col("target")]))
    asked = valid.select("visit_row", vector_to_array("features").alias("x"))
    found = materialize(model.neighbours(asked), "knn")
    urgent = found.groupBy("x").agg(F.avg((F.col("label") == ids["urgente"]).cast("double")).alias("share"), F.max("distance").alias("reach"))
    back = F.create_map(*[F.lit(v) for c, k in ids.items() for v in (k, c)])
    return (asked.join(NN.predictions(found, "classification"), "x").join(urgent, "x")
            .select("visit_row", back[F.col("prediction")].alias("predicted_target"), F.round("share", 6).alias("urgent_share"),
                    F.round("reach", 6).alias("reach")))


@register("ml_tabular_net")
def q_ml_tabular_net(spark, sf):
    """One hidden layer of 32 rectified units, urgent or not, trained on
    mini-batches of 512 for 10 epochs: features scaled to [0, 1] by the
    training rows, threshold 0.5 on the probability."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import MinMaxScaler
    train, valid = _tabular(spark, sf)
    lab = lambda d: d.withColumn("label", (F.col("target") == "urgente").cast("double"))
    net = M.create("classification", "tabular_net", {"featuresCol": "scaled"})
    p = Pipeline(stages=[MinMaxScaler(inputCol="features", outputCol="scaled"), net]).fit(lab(train)).transform(lab(valid))
    return EV.global_metrics(p.select(F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred")))


#: Every classifier of the factory that fits the triage features, by name.
CANDIDATES = [("dummy", {}), ("logistic_regression", {}), ("decision_tree", {"maxDepth": 5}), ("random_forest", FOREST),
              ("gradient_boosting", {}), ("hist_gradient_boosting", {}), ("knn", {}), ("naive_bayes", {"modelType": "gaussian"})]


@register("ml_compare")
def q_ml_compare(spark, sf):
    """Fit each candidate on train, score validation: metrics, and the rank by
    macro F1 (ties by name). How long the fits take is in the bench, as a
    result that holds times differs from run to run."""
    return _compare(spark, sf)


def _compare(spark, sf):
    train, valid = _tabular(spark, sf)
    rows = None
    for name, params in CANDIDATES:
        _, pred, _ = M.fit_and_score(name, M.create("classification", name, params), train, valid)
        m = _metrics(pred, name)
        rows = m if rows is None else rows.unionByName(m)
    # One row per candidate.
    return materialize(rows.selectExpr("*", "row_number() OVER (ORDER BY f1_macro DESC, model) AS rank"), "compare")


@register("ml_compare_text")
def q_ml_compare_text(spark, sf):
    """The two text models on one split: held-out metrics."""
    return _compare_text(spark, sf)


def _compare_text(spark, sf):
    train, valid = _train_valid_text(spark, sf)
    out = None
    for name, fit in (("tfidf_logistic", M.fit_text_logistic), ("pooled_embedding", M.fit_text_pooled)):
        m = _metrics(fit(train).transform(valid), name)
        out = m if out is None else out.unionByName(m)
    return materialize(out, "compare-text")


@register("win_model_ranking")
def q_win_model_ranking(spark, sf):
    """The text models, best macro F1 first, ties by name."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("f1_macro"), F.asc("model"))  # one row per model
    return _compare_text(spark, sf).select("model", "f1_macro", F.row_number().over(w).alias("rank"),
                                           (F.col("f1_macro") - F.lead("f1_macro").over(w)).alias("gap_to_next"))


def _run_log(spark):
    """The run log of this application."""
    return f"{checkpoint_dir(spark).rstrip('/')}/vitalis-runlog-{spark.sparkContext.applicationId}"


_compared: dict[tuple, DataFrame] = {}


def _logged(spark, sf):
    """The path of the run log, with the candidates' runs appended; they are
    fitted once for an application and its tables, and logged each time."""
    path, key = _run_log(spark), source_key(spark, sf)
    if key not in _compared:
        _compared[key] = _compare(spark, sf)
    R.append(spark, path, _compared[key])
    R.set_alias(spark, path)
    return path


@register("ml_run_log")
def q_ml_run_log(spark, sf):
    """Append the candidates' runs to the stored log (versions go on from the
    last), and set the alias; returns the log with the alias."""
    path = _logged(spark, sf)
    champion = R.current(R.runs(spark, path), R.aliases(spark, path)).select("version", F.lit("champion").alias("alias"))
    return materialize(R.runs(spark, path).join(champion, "version", "left").withColumn("valid_commit", X.valid_version("commit")), "run-log")


# --- gates -----------------------------------------------------------------------------

@register("dq_model_gate", ["eda"], MAJ_SQL + """,
cm AS (SELECT y_true AS y, y_pred AS p, count(*) AS n FROM pred GROUP BY 1, 2),
t AS (SELECT y AS label, sum(n) AS support, sum(CASE WHEN y = p THEN n ELSE 0 END) AS tp FROM cm GROUP BY y),
pr AS (SELECT p AS label, sum(n) AS predicted FROM cm GROUP BY p),
s AS (SELECT coalesce(t.label, pr.label) AS label, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
        coalesce(predicted, 0) AS predicted FROM t FULL OUTER JOIN pr ON t.label = pr.label),
gm AS (SELECT avg(CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END) AS f1_macro,
        max(CASE WHEN label = 'urgente' THEN tp / support END) AS urgent_recall FROM s)
SELECT 'f1_macro' AS "check", f1_macro >= 0.55 AS passed FROM gm
UNION ALL SELECT 'urgent_recall', urgent_recall >= 0.55 FROM gm""")
def q_dq_model_gate(spark, sf):
    pred = M.majority_rule_predictions(eda(spark, sf), "RFV1_description", "target")
    m = EV.global_metrics(pred, digits=None)
    ur = EV.by_class(pred, digits=None).where(F.col("class") == "urgente").select(F.col("recall").alias("urgent_recall"))
    row = m.select("f1_macro", F.lit(0).alias("_g")).join(ur.withColumn("_g", F.lit(0)), "_g")
    return G.model_gate(row)


@register("dq_report_gate")
def q_dq_report_gate(spark, sf):
    """The stored text model's report, written as JSON and read back: held-out
    metrics, the agreement of its batch and stream predictions, and the
    timed runs of the events table (number, and the slowest handler's median
    over the fastest's)."""
    model, (_, valid) = _stored_model(spark, sf), _train_valid_text(spark, sf)
    m = _metrics(model.transform(valid), "tfidf_logistic", digits=None)
    same = R.agreement(q_score_batch(spark, sf), q_score_stream(spark, sf))
    medians = exact_quantiles(table(spark, sf, "events").select("event_type", "value"), ["event_type"], "value", [0.5])
    bench = medians.agg(F.min("n").alias("runs"), (F.max("q0") / F.min("q0")).alias("speedup"))
    g = lambda d: d.withColumn("_g", F.lit(0))
    report = g(m).join(g(bench), "_g").join(g(same), "_g").select(
        F.struct("accuracy", "f1_macro", "urgent_recall").alias("metrics"),
        F.struct("agreement", "runs", "speedup").alias("benchmark"))
    path = scratch(spark, "report")
    report.coalesce(1).write.mode("overwrite").json(path)
    return R.report_checks(spark.read.schema(report.schema).json(path))


@register("dq_registration_gate")
def q_dq_registration_gate(spark, sf):
    """The champion's report, written when its run was logged, against the
    stored log and alias."""
    path = _logged(spark, sf)
    champion = R.current(R.runs(spark, path), R.aliases(spark, path)).select("run_id", "version", "commit")
    out = scratch(spark, "registration-report")
    champion.coalesce(1).write.json(out)
    report = spark.read.schema("run_id string, version long, commit string").json(out)
    return materialize(R.registration_checks(report, R.runs(spark, path), R.aliases(spark, path)), "registration")


# --- scoring ---------------------------------------------------------------------------

def _store(spark, sf):
    """The published text models of a dataset version, for the tables under
    ``sf`` in this application; the first is fitted and published here."""
    key = hashlib.sha256(repr(source_key(spark, sf)).encode()).hexdigest()[:24]
    store = SV.ModelStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/vitalis-serving-{key}")
    if store.version() is None:
        store.publish(M.fit_text_logistic(_train_valid_text(spark, sf)[0]), 1)
    return store


def _stored_model(spark, sf):
    """The published text model, loaded."""
    return _store(spark, sf).current()[1]


def _scored(model, requests):
    return model.transform(requests).select(
        "record_id", F.col("predicted_target").alias("target"),
        SC.probability_map(sorted(S.TARGET_ORDER)).alias("probabilities"), F.lit(S.DATASET_VERSION).alias("dataset_version"))


def _requests(spark, sf):
    """All records as scoring requests; invalid texts are refused."""
    t = training_table(spark, sf).select("record_id", "clinical_text")
    return SC.request_validity(t).where("valid").select("record_id", "clinical_text")


def _score_batch(spark, sf):
    version, model = _store(spark, sf).current()
    out = _scored(model, _requests(spark, sf)).withColumn("model_version", F.lit(version))
    return out.withColumn("confidence", SC.confidence("probabilities"))


@register("score_batch")
def q_score_batch(spark, sf):
    return _score_batch(spark, sf)


@register("score_stream")
def q_score_stream(spark, sf):
    """Requests land as parquet files; a Structured Streaming query scores
    them with the model that the alias names at each micro-batch, refuses
    invalid ones, and writes predictions (never the text) by batch."""
    store = _store(spark, sf)
    landing, out = scratch(spark, "requests"), scratch(spark, "predictions")
    training_table(spark, sf).select("record_id", "clinical_text").write.parquet(landing)
    stream = spark.readStream.schema("record_id string, clinical_text string").parquet(landing)
    SV.drain(stream, SV.batch_scorer(store, _scored, out, f"{out}-refused"), f"{out}-ckpt")
    return spark.read.parquet(out)


@register("score_confidence", ["scored"], """
SELECT doc_id, round(greatest(1 - score, score), 6) AS confidence FROM scored""")
def q_score_confidence(spark, sf):
    s = FX.scored(spark, sf)
    probs = F.map_from_arrays(F.array(F.lit("0"), F.lit("1")), F.array(1 - F.col("score"), F.col("score")))
    return s.select("doc_id", F.round(SC.confidence(probs), 6).alias("confidence"))


@register("score_custom_model")
def q_score_custom_model(spark, sf):
    """Any object with ``predict`` / ``predict_proba`` (optional
    ``transform``) scored with ``mapInPandas``: the object is shipped once
    per task and applied to Arrow batches."""
    from vitalis.operators.custom import KeywordModel, score_with
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("clinical_text"))
    return score_with(docs, KeywordModel(), key="doc_id")


@register("score_reject_invalid", [], """
SELECT doc_id, CASE WHEN length(trim(text)) = 0 THEN 'empty' ELSE 'too_long' END AS reason
FROM documents WHERE NOT (length(trim(text)) BETWEEN 1 AND 5000)""")
def q_score_reject_invalid(spark, sf):
    d = SC.request_validity(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return d.where(~F.col("valid")).select("doc_id", "reason")
