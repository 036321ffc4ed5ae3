"""Feature engineering (inventory 2.9) as DataFrame jobs.

Text features stay in long form ``(doc, term, weight)`` until a model needs
vectors: counts where a row is read (map-side partial aggregation absorbs
hot terms), a vocabulary capped by a distributed top-k (so its size is
proven before it is broadcast), and per-document norms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalis.functions import nulls as N
from vitalis.functions import text as X
from vitalis.operators.quantiles import exact_quantiles
from vitalis.operators.score import strip_text
from vitalis.operators.stored import Stored
from vitalis.session import materialize, small_enough

PAD_TOKEN = "<PAD>"
UNK_TOKEN = "<UNK>"


class DocTerms(NamedTuple):
    """Documents by what their counts need: ``alone`` (``doc, tokens``) has the ids of
    one row, whose terms are counted where the row is read; ``several``
    (``doc, term, tf``) those of more rows, which meet in a shuffle, or None."""

    alone: DataFrame
    several: DataFrame | None
    bigrams: bool


def doc_terms(docs: DataFrame, doc: str, text: str, pattern: str = X.TOKEN_RE_ASCII, group: int = 1,
              bigrams: bool = True) -> DocTerms:
    """Lower-case tokens (+ bigrams) of each document. Rows that share an id,
    null included, are one document; only these move."""
    rows = docs.select(F.col(doc).alias("doc"), F.col(text).alias("_t"))
    again = materialize(rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"), "repeated-docs")
    tokens = X.tokenize("_t", pattern, group).alias("tokens")
    if again.isEmpty():
        return DocTerms(rows.select("doc", tokens), None, bigrams)
    shared = F.broadcast(again) if small_enough(again) else again
    same = rows["doc"].eqNullSafe(again["doc"])
    # Documents move with their tokens, before these are repeated in bigrams.
    several = (rows.join(shared, same, "left_semi").select("doc", tokens).repartition("doc")
               .select("doc", F.explode(_terms(bigrams)).alias("term")).where(F.col("term").isNotNull())
               .groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf")))
    return DocTerms(rows.join(shared, same, "left_anti").select("doc", tokens), several, bigrams)


def _terms(bigrams: bool) -> Column:
    return X.ngrams_1_2("tokens") if bigrams else F.col("tokens")


def tfidf_fit(tf: DocTerms, docs: DataFrame, min_df: int = 2, max_features: int = 10_000) -> DataFrame:
    """Vocabulary with smooth IDF: (term, idf) where
    ``idf = ln((1 + n) / (1 + df)) + 1`` and ``n`` counts every fitted
    document (token-less ones too); terms with ``df >= min_df``, the
    ``max_features`` most frequent in the corpus (ties by term). Each distinct
    term of a row counts once for df, every occurrence once for corpus frequency;
    only partial counts by term are shuffled."""
    n = docs.agg(F.count(F.lit(1)).alias("n"), F.lit(0).alias("_g"))
    counts = tf.alone.where("tokens is not null").mapInArrow(_partial_counts(tf.bigrams), "term string, d long, c long")
    if tf.several is not None:
        counts = counts.union(tf.several.select("term", F.lit(1).cast("long"), "tf"))
    stats = counts.groupBy("term").agg(F.sum("d").alias("df"), F.sum("c").alias("cf"))
    vocab = stats.where(F.col("df") >= min_df).orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    vocab = vocab.withColumn("_g", F.lit(0)).join(F.broadcast(n), "_g")
    return vocab.select("term", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf_transform(tf: DocTerms, model: DataFrame) -> DataFrame:
    """(doc, term, weight): tf x idf, L2-normalised per document. The
    vocabulary is capped, so it may reach the driver and every task."""
    idf = {r["term"]: r["idf"] for r in model.select("term", "idf").collect()}
    kind = tf.alone.schema["doc"].dataType.simpleString()
    out = tf.alone.where("tokens is not null").mapInArrow(_weighed(idf, tf.bigrams), f"doc {kind}, term string, weight double")
    if tf.several is None:
        return out
    learnt = tf.alone.sparkSession.createDataFrame(list(idf.items()), "term string, idf double")
    w = tf.several.join(F.broadcast(learnt), "term").select("doc", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc")))
    return out.union(w.select("doc", "term", (F.col("w") / norm).alias("weight")))


#: Rows whose terms are held at once.
_HELD_ROWS = 256


def _row_terms(batches: Iterable[pa.RecordBatch], bigrams: bool) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Runs of rows (document, tokens) and each row's terms, as an iterable."""
    for batch in batches:
        for at in range(0, batch.num_rows, _HELD_ROWS):
            part = batch.slice(at, _HELD_ROWS)
            yield part, [chain(t, map(" ".join, zip(t, t[1:]))) if bigrams else t for t in part.column(1).to_pylist()]


def _partial_counts(bigrams: bool):
    """Documents and occurrences of each term, over a run of rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _row_terms(batches, bigrams):
            d, c = Counter(), Counter()
            for terms in rows:
                own = Counter(terms)
                c.update(own)
                d.update(own.keys())
            yield pa.RecordBatch.from_arrays([pa.array(list(d), pa.string()), pa.array(list(d.values()), pa.int64()),
                                              pa.array([c[t] for t in d], pa.int64())], ["term", "d", "c"])
    return run


def _weighed(idf: dict[str, float], bigrams: bool):
    """The weights of the known terms of each row's tokens."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, every in _row_terms(batches, bigrams):
            rows, terms, weights = [], [], []
            for k, own in enumerate(every):
                w = {t: n * idf[t] for t, n in Counter(filter(idf.__contains__, own)).items()}
                norm = math.sqrt(sum(v * v for v in w.values()))
                rows += [k] * len(w)
                terms += w
                weights += [v / norm for v in w.values()]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int32())), pa.array(terms, pa.string()), pa.array(weights, pa.float64())],
                                             ["doc", "term", "weight"])
    return run


def vocabulary(docs: DataFrame, text: str, min_freq: int = 1, max_size: int = 20_000,
               pattern: str = X.TOKEN_RE_UNICODE) -> DataFrame:
    """``feat_vocabulary``: PAD=0, UNK=1, then tokens by (-count, token)
    with ``count >= min_freq``, capped so the table has ``max_size`` rows."""
    toks = docs.select(F.explode(X.tokenize(text, pattern, 0)).alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") >= min_freq)
    top = counts.orderBy(F.desc("count"), F.asc("token")).limit(max(max_size - 2, 0))
    ranked = top.select("token", (F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc("count"), F.asc("token"))) + 1).cast("int").alias("id"))
    special = docs.sparkSession.createDataFrame([(PAD_TOKEN, 0), (UNK_TOKEN, 1)], "token string, id int")
    return special.unionByName(ranked)


def encode_pad(docs: DataFrame, doc: str, text: str, vocab: DataFrame, max_len: int = 256,
               pattern: str = X.TOKEN_RE_UNICODE) -> DataFrame:
    """``feat_encode_pad`` / ``join_vocabulary``: first ``max_len`` token
    ids (unknown -> 1), right-padded with 0. Per-document work is bounded
    by ``max_len``; the capped vocabulary is broadcast."""
    toks = F.slice(X.tokenize(text, pattern, 0), 1, max_len)
    # posexplode_outer keeps token-less documents as one row with a NULL
    # position (collect_list skips the NULL entry), so no join back to the
    # document list is needed.
    pos = docs.select(F.col(doc).alias("doc"), F.posexplode_outer(toks).alias("pos", "token"))
    ids = pos.join(F.broadcast(vocab), "token", "left").select(
        "doc", F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce(F.col("id"), F.lit(1)).alias("id")))
        .alias("_e"))
    seq = ids.groupBy("doc").agg(F.array_sort(F.collect_list("_e")).alias("_s"))
    seq = seq.select("doc", F.transform("_s", lambda s: s["id"]).alias("_ids"))
    pad = F.array_repeat(F.lit(0), F.lit(max_len) - F.size("_ids"))
    return seq.select(F.col("doc").alias(doc), F.concat("_ids", pad).alias("token_ids"))


def text_checks(docs: DataFrame, text: str) -> DataFrame:
    """``feat_text_validate``: counts of missing and blank texts."""
    return docs.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(text).isNull()).alias("null_texts"),
                    F.count_if(strip_text(text) == "").alias("blank_texts"))


def reject_texts(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` unchanged, or an error in the same job at a missing or blank
    text (any white space), as a text model refuses such input."""
    bad = F.col(text).isNull() | (strip_text(text) == "")
    return docs.withColumn(text, N.fail_if(bad, f"missing or blank text in {text}", F.col(text)))


def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row exact medians (linear interpolation) of ``cols``, each found in
    ranges of its values, so a column of distinct numbers isn't one task."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s"))
    found = exact_quantiles(long.select("s.c", "s.v"), ["c"], "v", [0.5])
    return found.agg(*[F.max(F.when(F.col("c") == c, F.col("q0"))).alias(c) for c in cols])


def impute_median(df: DataFrame, cols: Sequence[str], fitted: DataFrame | None = None) -> DataFrame:
    """``feat_impute_median``: NULL -> median learnt on ``fitted`` (default
    ``df``). The one-row statistics table joins on a constant key."""
    m = (fitted if fitted is not None else medians(df, cols))
    m = m.select(*[F.col(c).alias(f"_m_{c}") for c in cols], F.lit(0).alias("_g"))
    j = df.withColumn("_g", F.lit(0)).join(F.broadcast(m), "_g")
    return j.select(*[F.coalesce(F.col(c), F.col(f"_m_{c}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.min(c).alias(f"{c}__min") for c in cols], *[F.max(c).alias(f"{c}__max") for c in cols])


def minmax_apply(df: DataFrame, cols: Sequence[str], stats: DataFrame, lo: float = 0.0, hi: float = 1.0,
                 keep: Sequence[str] = ()) -> DataFrame:
    """``feat_minmax``: scale to [lo, hi] with the learnt range, no
    clipping; a constant column maps to ``lo``."""
    j = df.withColumn("_g", F.lit(0)).join(F.broadcast(stats.withColumn("_g", F.lit(0))), "_g")
    out = []
    for c in cols:
        mn, mx = F.col(f"{c}__min"), F.col(f"{c}__max")
        scaled = F.when(mx > mn, (F.col(c) - mn) / (mx - mn) * (hi - lo) + lo).otherwise(F.lit(lo))
        out.append(scaled.alias(c))
    return j.select(*keep, *out)


def mode_value(df: DataFrame, col: str) -> DataFrame:
    """``feat_impute_mode``: most frequent non-null value, smallest on tie."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).count()
              .orderBy(F.desc("count"), F.asc(col)).limit(1).select(F.col(col).alias("mode")))


def impute_mode(df: DataFrame, col: str, mode: DataFrame | None = None) -> DataFrame:
    # Left, as a column without any value has no mode and stays null.
    mode = mode if mode is not None else mode_value(df, col)
    j = df.withColumn("_g", F.lit(0)).join(F.broadcast(mode.withColumn("_g", F.lit(0))), "_g", "left")
    return j.select(*[F.coalesce(F.col(c), F.col("mode")).alias(c) if c == col else F.col(c) for c in df.columns])


MAX_CATEGORIES = 10_000


def categories(df: DataFrame, col: str, max_categories: int = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct categories. Only a bounded result may reach the
    driver: more than ``max_categories`` values raises (such a column is an
    identifier, not a category) instead of being silently truncated."""
    vals = (df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)
              .limit(max_categories + 1).collect())
    if len(vals) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories")
    return [r[0] for r in vals]


def onehot(df: DataFrame, col: str, cats: Sequence[str], prefix: str = "cat__", keep: Sequence[str] = (),
           dtype: str = "int") -> DataFrame:
    """``feat_onehot``: one 0/1 column per learnt category, named
    ``cat__<col>_<value>``; unknown values give all zeros."""
    return df.select(*keep, *[(F.col(col) == F.lit(v)).cast(dtype).alias(f"{prefix}{col}_{v}") for v in cats])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``feat_class_weight``: balanced weight ``n / (k * n_c)``."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    total = g.agg(F.sum("n_c").alias("_n"), F.count(F.lit(1)).alias("_k"), F.lit(0).alias("_g"))  # one row
    return (g.withColumn("_g", F.lit(0)).join(F.broadcast(total), "_g")
            .select(label, "n_c", (F.col("_n") / (F.col("_k") * F.col("n_c"))).alias("weight")))


def label_index(df: DataFrame, label: str) -> DataFrame:
    """``feat_label_index``: alphabetical label -> id (0-based) table."""
    d = df.select(label).distinct()
    return d.select(label, (F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(label)) - 1).alias("label_id"))


class _PreprocessorParams(Params):
    binary = Param(Params._dummy(), "binary", "columns passed through", TypeConverters.toListString)
    numeric = Param(Params._dummy(), "numeric", "columns imputed and scaled", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "columns imputed and encoded", TypeConverters.toListString)
    keys = Param(Params._dummy(), "keys", "columns kept as they are", TypeConverters.toListString)
    featureRange = Param(Params._dummy(), "featureRange", "range of the scaled columns", TypeConverters.toListFloat)
    maxCategories = Param(Params._dummy(), "maxCategories", "categories of a column at most", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(binary=[], numeric=[], categorical=[], keys=[], featureRange=[0.0, 1.0], maxCategories=MAX_CATEGORIES)


class TabularPreprocessor(Estimator, _PreprocessorParams, Stored):
    """``feat_fit_prepare`` / ``udf_transformer``: learn on a training
    frame, reuse on others. Binary columns pass through, numeric columns are
    median-imputed then min-max scaled, categorical columns are mode-imputed
    then one-hot encoded over the learnt (sorted) categories. Output order:
    binary, numeric, categorical; other columns dropped (keys kept). The fitted
    model can be saved, alone or in a pipeline, and loaded in another session."""

    def __init__(self, binary=(), numeric=(), categorical=(), keys=(), feature_range=(0.0, 1.0),
                 max_categories=MAX_CATEGORIES):
        super().__init__()
        self._defaults()
        self._set(binary=list(binary), numeric=list(numeric), categorical=list(categorical), keys=list(keys),
                  featureRange=[float(v) for v in feature_range], maxCategories=max_categories)

    def transform(self, df: DataFrame) -> DataFrame:
        raise RuntimeError("TabularPreprocessor is not fitted")

    def _fit(self, df: DataFrame) -> "TabularPreprocessorModel":
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        learnt = {"median": {}, "low": {}, "high": {}, "mode": {}, "categories": {}}
        if numeric:
            learnt["median"] = medians(df, numeric).first().asDict()
            filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(learnt["median"][c])).alias(c) for c in numeric])
            ranges = minmax_fit(filled, numeric).first()
            learnt["low"], learnt["high"] = ({c: ranges[f"{c}__{end}"] for c in numeric} for end in ("min", "max"))
        for c in categorical:
            text = df.select(F.col(c).cast("string").alias(c))
            top = mode_value(df, c).select(F.col("mode").cast("string").alias("mode")).first()
            learnt["mode"][c] = top["mode"] if top else None
            learnt["categories"][c] = categories(text, c, self.getOrDefault("maxCategories"))
        return self._copyValues(TabularPreprocessorModel()._learnt(learnt))


class TabularPreprocessorModel(Model, _PreprocessorParams, Stored):
    """What was learnt, as one projection; no join and no shuffle."""

    def __init__(self):
        super().__init__()
        self._defaults()

    def _learnt(self, learnt: dict[str, dict]) -> "TabularPreprocessorModel":
        self.learnt = learnt
        return self

    def _transform(self, df: DataFrame) -> DataFrame:
        lo, hi = self.getOrDefault("featureRange")
        cols = [*self.getOrDefault("keys"), *[F.col(c).alias(f"bin__{c}") for c in self.getOrDefault("binary")]]
        for c in self.getOrDefault("numeric"):
            median, low, high = (self.learnt[k][c] for k in ("median", "low", "high"))
            filled = F.coalesce(F.col(c).cast("double"), F.lit(median).cast("double"))
            varies = low is not None and high > low
            cols.append((((filled - low) / (high - low) * (hi - lo) + lo) if varies else F.lit(lo)).alias(f"num__{c}"))
        for c in self.getOrDefault("categorical"):
            value = F.coalesce(F.col(c).cast("string"), F.lit(self.learnt["mode"][c]).cast("string"))
            cols += [(value == F.lit(v)).cast("int").alias(f"cat__{c}_{v}") for v in self.learnt["categories"][c]]
        return df.select(*cols)

    def _tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        numbers = [(c, self.learnt["median"][c], self.learnt["low"][c], self.learnt["high"][c]) for c in self.learnt["median"]]
        names = [(c, k, v) for c, vs in self.learnt["categories"].items() for k, v in enumerate(vs)]
        return {"numbers": spark.createDataFrame(numbers, "name string, median double, low double, high double"),
                "modes": spark.createDataFrame(list(self.learnt["mode"].items()), "name string, mode string"),
                "categories": spark.createDataFrame(names, "name string, pos int, value string")}

    def _restore(self, tables: dict[str, DataFrame]) -> None:
        numbers, modes = tables["numbers"].collect(), tables["modes"].collect()
        found: dict[str, list[str]] = {r["name"]: [] for r in modes}
        for r in tables["categories"].orderBy("name", "pos").collect():
            found[r["name"]].append(r["value"])
        self._learnt({**{k: {r["name"]: r[k] for r in numbers} for k in ("median", "low", "high")},
                      "mode": {r["name"]: r["mode"] for r in modes}, "categories": found})
