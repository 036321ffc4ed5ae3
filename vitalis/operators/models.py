"""Distributed estimators, the model factory and model comparison (2.10).

Training uses ``pyspark.ml`` (treeAggregate-based optimisers: each
iteration is one distributed pass). The featurised training frame is
materialised in the checkpoint folder before iterative fits, so the
lineage is cut and a lost executor recomputes from parquet, not from the
raw text.
"""

from __future__ import annotations

import math
import time
from collections.abc import Mapping

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml import classification as MC
from pyspark.ml import feature as MF
from pyspark.ml import regression as MR
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalis.functions import text as X
from vitalis.operators.boosting import Boosting
from vitalis.operators.nearest import Nearest
from vitalis.operators.nets import TabularClassifier, TextClassifier

RANDOM_STATE = 42
#: Texts of one task of the optimiser, whose vectors are several times the text.
TEXT_ROWS = 65_536


def majority_rule_predictions(df: DataFrame, label: str, target: str) -> DataFrame:
    """Majority class per ``label`` value (smallest class on ties); rows
    without a label get the overall majority. Only grouped tables move."""
    per = df.where(F.col(label).isNotNull()).groupBy(label, target).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(label).orderBy(F.desc("n"), F.asc(target))
    maj = per.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(label, F.col(target).alias("_maj"))
    glob = (df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(target)).limit(1)
              .select(F.col(target).alias("_gmaj"), F.lit(0).alias("_g")))
    j = df.join(maj, label, "left").withColumn("_g", F.lit(0)).join(F.broadcast(glob), "_g")
    return j.select(F.col(target).alias("y_true"), F.coalesce("_maj", "_gmaj").alias("y_pred"))


def dummy_classifier(train: DataFrame, label: str) -> DataFrame:
    """``ml_dummy_class``: prior model -- majority class (smallest on tie)
    and class shares; returns (class, share, is_majority)."""
    g = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row: the total, and the first label in the order (most rows, smallest).
    one = g.agg(F.sum("n").alias("_n"), F.min(F.struct((-F.col("n")).alias("n"), F.col(label).alias("l"))).alias("_top"), F.lit(0).alias("_g"))
    return (g.withColumn("_g", F.lit(0)).join(F.broadcast(one), "_g")
            .select(label, (F.col("n") / F.col("_n")).alias("share"), F.col(label).eqNullSafe(F.col("_top.l")).alias("is_majority")))


class Dummy(Estimator):
    """``dummy`` of the factory: predicts the majority label (the smallest on a
    tie) or the mean label of the training rows, whatever the features."""

    def __init__(self, mode: str, labelCol: str = "label", featuresCol: str = "features"):
        super().__init__()
        self.mode, self.label_col = mode, labelCol

    def setParams(self, featuresCol: str = "features", labelCol: str = "label"):
        self.label_col = labelCol
        return self

    def _fit(self, df: DataFrame) -> "DummyModel":
        if self.mode == "mean":
            value = df.agg(F.avg(self.label_col)).first()[0]
        else:
            top = df.groupBy(self.label_col).count().orderBy(F.desc("count"), F.asc(self.label_col)).limit(1).collect()
            value = top[0][0] if top else None
        return DummyModel(None if value is None else float(value))


class DummyModel(Model):
    def __init__(self, value: float | None):
        super().__init__()
        self.value = value

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(self.value).cast("double"))


# --- factory ----------------------------------------------------------------------

_CLASSIFIERS = {
    "logistic_regression": lambda p: MC.LogisticRegression(**p),
    "decision_tree": lambda p: MC.DecisionTreeClassifier(**{"seed": RANDOM_STATE, **p}),
    "random_forest": lambda p: MC.RandomForestClassifier(**{"seed": RANDOM_STATE, **p}),
    "gradient_boosting": lambda p: Boosting(**{"criterion": "variance", **p}),
    "hist_gradient_boosting": lambda p: Boosting(**p),
    "knn": lambda p: Nearest(**p),
    "mlp": lambda p: MC.MultilayerPerceptronClassifier(**{"seed": RANDOM_STATE, **p}),
    "tabular_net": lambda p: TabularClassifier(**p),
    "naive_bayes": lambda p: MC.NaiveBayes(**p),
    "dummy": lambda p: Dummy(mode="majority", **p),
}
_REGRESSORS = {
    "linear_regression": lambda p: MR.LinearRegression(**{"regParam": 0.0, "solver": "normal", **p}),
    "decision_tree": lambda p: MR.DecisionTreeRegressor(**{"seed": RANDOM_STATE, **p}),
    "random_forest": lambda p: MR.RandomForestRegressor(**{"seed": RANDOM_STATE, **p}),
    "gradient_boosting": lambda p: Boosting(**{"kind": "regression", "criterion": "variance", **p}),
    "hist_gradient_boosting": lambda p: Boosting(**{"kind": "regression", **p}),
    "knn": lambda p: Nearest(**{"kind": "regression", **p}),
    "dummy": lambda p: Dummy(mode="mean", **p),
}
REGISTRY = {"classification": _CLASSIFIERS, "regression": _REGRESSORS}


def normalize_name(name: str) -> str:
    return name.strip().lower().replace("-", "_").replace(" ", "_")


def create(problem_type: str, model_name: str, params: Mapping | None = None):
    """``ml_factory``: estimator by (problem type, normalised name); an
    unknown name raises listing the choices."""
    pt = normalize_name(problem_type)
    if pt not in REGISTRY:
        raise ValueError(f"unknown problem type {problem_type!r}; choices: {sorted(REGISTRY)}")
    name = normalize_name(model_name)
    choices = REGISTRY[pt]
    if name not in choices:
        raise ValueError(f"unknown model {model_name!r}; choices: {sorted(choices)}")
    return choices[name](dict(params or {}))


def create_pipeline(preprocessor, problem_type: str, model_name: str, params: Mapping | None = None) -> Pipeline:
    """Two-stage pipeline: preprocessing then the model."""
    return Pipeline(stages=[preprocessor, create(problem_type, model_name, params)])


def save_model(model: PipelineModel, path: str) -> None:
    """A fitted pipeline under ``path``, over whatever is there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """The fitted pipeline under ``path``; a clear error if there is none."""
    try:
        return PipelineModel.load(path)
    except Exception as e:
        raise FileNotFoundError(f"no model is stored under {path}") from e


# --- text logistic model (TF-IDF + balanced multinomial logistic) ---------------------

def text_features(pattern: str = X.TOKEN_RE_ASCII):
    """Tokens (lower-cased regex matches, no word boundaries, as the
    vectoriser contract), then with their space-joined bigrams, as one stage
    of two built-in SQL expressions: they stay in whole-stage codegen, where
    the tokenizer and n-gram transformers are per-row Scala UDFs."""
    tokens = f"regexp_extract_all(lower(clinical_text), '{pattern}', 1)"
    return [PipelineModel(stages=[
        MF.SQLTransformer(statement=f"SELECT *, {tokens} AS _tk FROM __THIS__"),
        MF.SQLTransformer(statement=(
            "SELECT *, concat(_tk, zip_with(slice(_tk, 1, greatest(size(_tk) - 1, 0)), "
            "slice(_tk, 2, greatest(size(_tk) - 1, 0)), (a, b) -> concat_ws(' ', a, b))) AS _terms FROM __THIS__"))])]


def capped_vocabulary(df: DataFrame, terms: str, min_df: int, cap: int) -> list:
    """(term, df) rows of the ``cap`` most frequent terms with document
    frequency ``>= min_df``, ties by term, from one aggregate: each distinct
    term of a row counts once for df, every occurrence once for corpus
    frequency. Only the capped list reaches the driver. (Spark's
    ``CountVectorizer`` top-k leaves ties at the cap unordered.)"""
    entries = F.concat(
        F.transform(F.array_distinct(terms), lambda x: F.struct(x.alias("term"), F.lit(1).alias("d"), F.lit(0).alias("c"))),
        F.transform(terms, lambda x: F.struct(x.alias("term"), F.lit(0).alias("d"), F.lit(1).alias("c"))))
    stats = (df.select(F.inline(entries)).groupBy("term").agg(F.sum("d").alias("df"), F.sum("c").alias("cf"))
               .where(F.col("df") >= min_df).orderBy(F.desc("cf"), F.asc("term")).limit(cap))
    return stats.select("term", "df").collect()


def fit_text_logistic(train: DataFrame, label: str = "target", max_iter: int = 1000,
                      min_df: int = 2, vocab: int = 10_000) -> PipelineModel:
    """``ml_logistic``: TF-IDF (1-2 grams, min_df, capped vocabulary, smooth
    IDF + 1, L2) and balanced multinomial logistic regression with the
    summed-loss L2 strength of C=1 (``regParam = 1 / n`` on a loss that
    Spark averages over the balanced weights, which sum to ``n``).

    The text is tokenised once: its tokens are written with label and weight,
    and read for the term statistics (document and corpus frequency per term
    in one aggregate) and for the optimiser. The vocabulary is the ``vocab`` most frequent terms with ``df >= min_df``,
    ties by term (deterministic at the cap); only that capped list and its
    document frequencies reach the driver."""
    from vitalis.session import discard, scratch

    # One row per class: labels, weights and the number of rows in one small pass.
    counts = sorted((r[0], r[1]) for r in train.where(F.col(label).isNotNull()).groupBy(label).count().collect())
    n = sum(c for _, c in counts)
    idx = MF.StringIndexerModel.from_labels([c for c, _ in counts], inputCol=label, outputCol="label_id")
    weight = F.create_map(*[x for k, (_, c) in enumerate(counts) for x in (F.lit(float(k)), F.lit(n / (len(counts) * c)))])
    # Tokens are written once; the vocabulary and the fit both read them.
    spark, path = train.sparkSession, scratch(train.sparkSession, "lr-tokens")
    tokens_stage, terms_stage = text_features()[0].stages
    (tokens_stage.transform(idx.transform(train.select("clinical_text", label))).select("_tk", "label_id")
     .withColumn("weight", weight[F.col("label_id")]).write.option("maxRecordsPerFile", TEXT_ROWS).parquet(path))
    tokens = spark.read.parquet(path)
    top = capped_vocabulary(terms_stage.transform(tokens), "_terms", min_df, vocab)
    cv = MF.CountVectorizerModel.from_vocabulary([r["term"] for r in top], inputCol="_terms", outputCol="_tf")
    # Smooth IDF plus one: ln((1 + n) / (1 + df)) + 1.
    idf = [math.log((1 + n) / (1 + r["df"])) + 1.0 for r in top]
    scale = MF.ElementwiseProduct(scalingVec=DenseVector(idf), inputCol="_tf", outputCol="_w")
    norm = MF.Normalizer(p=2.0, inputCol="_w", outputCol="features")
    # The optimiser keeps its blocks; a lost one is computed again from the tokens.
    rows = tokens
    if tokens.rdd.getNumPartitions() * TEXT_ROWS < n:
        # Tokens are far smaller than vectors: one file a task, set apart in a session of its own.
        apart = spark.newSession()
        apart.conf.set("spark.sql.files.maxPartitionBytes", "4m")
        apart.conf.set("spark.sql.files.openCostInBytes", "4m")
        rows = apart.read.parquet(path)
    data = norm.transform(scale.transform(cv.transform(terms_stage.transform(rows)))).select("features", "label_id", "weight")
    # tol = 1e-4: the stopping tolerance of the reference solver (library
    # default); Spark's own default (1e-6) iterates far past it.
    lr = MC.LogisticRegression(featuresCol="features", labelCol="label_id", weightCol="weight", maxIter=max_iter,
                               regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False,
                               family="multinomial", tol=1e-4)
    model = lr.fit(data)
    discard(spark, path)
    back = MF.IndexToString(inputCol="prediction", outputCol="predicted_target", labels=idx.labels)
    return PipelineModel(stages=[idx, tokens_stage, terms_stage, cv, scale, norm, model, back])


def fit_text_pooled(train: DataFrame, label: str = "target", epochs: int = 10, batch: int = 128) -> PipelineModel:
    """``ml_text_pooled``: mean-pooled token embeddings of 64 components and a
    softmax head, trained on mini-batches (Unicode word tokens, one-letter
    tokens kept, up to 256 of a text and 20,000 in the vocabulary)."""
    idx = MF.StringIndexer(inputCol=label, outputCol="label_id", stringOrderType="alphabetAsc").fit(train)
    model = TextClassifier(labelCol="label_id", maxIter=epochs, batchSize=batch).fit(idx.transform(train))
    back = MF.IndexToString(inputCol="prediction", outputCol="predicted_target", labels=idx.labels)
    return PipelineModel(stages=[idx, model, back])


# --- tabular models -------------------------------------------------------------------

def tabular_frame(eda: DataFrame, numeric: list[str], keep: tuple = ("visit_row", "target"),
                  fit_on: DataFrame | None = None) -> DataFrame:
    """Median-imputed numeric triage features assembled into a vector. The
    medians are learnt on ``fit_on`` (the training rows; default ``eda``)."""
    from vitalis.operators.features import impute_median, medians
    fitted = medians(fit_on if fit_on is not None else eda, numeric)
    filled = impute_median(eda.select(*keep, *numeric), numeric, fitted)
    return MF.VectorAssembler(inputCols=numeric, outputCol="features").transform(filled)


def fit_and_score(name: str, estimator, train: DataFrame, valid: DataFrame, label: str = "target") -> tuple:
    """Fit on train, predict validation; returns (model, predictions, seconds)."""
    idx = MF.StringIndexer(inputCol=label, outputCol="label_id", stringOrderType="alphabetAsc").fit(train)
    est = estimator.copy()
    est.setParams(featuresCol="features", labelCol="label_id") if hasattr(est, "setParams") else None
    t0 = time.time()
    model = Pipeline(stages=[idx, est]).fit(train)
    secs = time.time() - t0
    back = MF.IndexToString(inputCol="prediction", outputCol="predicted_target", labels=idx.labels)
    pred = back.transform(model.transform(valid))
    return model, pred, secs
