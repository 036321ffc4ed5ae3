"""Evaluation from a confusion table (inventory 2.11).

All global metrics derive from one ``groupBy(y, p).count()`` whose size is
bounded by classes squared, so everything after the first aggregate runs on
a tiny table. Conventions kept: zero division -> 0; macro averages over the
union of true and predicted labels; per-class table over true labels only;
binary problems report the largest label as the positive class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    return df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion_normalized(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """``eval_confusion``: counts and row-normalised shares."""
    cm = confusion(df, y, p)
    tot = cm.groupBy("y").agg(F.sum("n").alias("_row"))
    return cm.join(tot, "y").select(F.col("y").alias(y), F.col("p").alias(p), F.col("n").alias("count"),
                                    F.round(F.col("n") / F.col("_row"), 6).alias("rate"))


def class_stats(cm: DataFrame) -> DataFrame:
    """Per label over the union of labels: support, predicted, tp, p, r, f1."""
    # Each cell counts once for its true label and once for its predicted
    # label: one aggregate over the confusion table, no self-join (a join
    # would infer a NOT NULL filter on one side only, so the two uses of
    # the confusion table would differ and the predictions be scored twice).
    y, p, n, zero = F.col("y"), F.col("p"), F.col("n"), F.lit(0).cast("long")
    sides = F.array(
        F.struct(y.alias("label"), n.alias("support"), F.when(y == p, n).otherwise(zero).alias("tp"),
                 zero.alias("predicted")),
        F.struct(p.cast(cm.schema["y"].dataType).alias("label"), zero.alias("support"), zero.alias("tp"),
                 n.alias("predicted")))
    j = cm.select(F.inline(sides)).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"))
    return j.select(
        "label", "support", "predicted", "tp",
        F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0).alias("precision"),
        F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0).alias("recall"),
        F.when(F.col("support") + F.col("predicted") > 0,
               2 * F.col("tp") / (F.col("support") + F.col("predicted"))).otherwise(0.0).alias("f1"))


def by_class(df: DataFrame, y: str = "y_true", p: str = "y_pred", digits: int | None = 6) -> DataFrame:
    """``eval_by_class``: precision, recall, F1 and support per true label."""
    s = class_stats(confusion(df, y, p)).where(F.col("support") > 0)
    return s.select(F.col("label").alias("class"), *[_shown(c, digits) for c in ("precision", "recall", "f1")],
                    F.col("support").cast("bigint").alias("support"))


def _shown(c: str, digits: int | None) -> Column:
    return F.col(c) if digits is None else F.round(c, digits).alias(c)


def global_metrics(df: DataFrame, y: str = "y_true", p: str = "y_pred", digits: int | None = 6) -> DataFrame:
    """``eval_global``: one row of accuracy, default-average and macro /
    weighted precision, recall and F1, rounded for display; gates pass
    ``digits=None`` and compare the raw values."""
    s = class_stats(confusion(df, y, p))
    n_true_labels = F.count_if(F.col("support") > 0)
    pos = F.max(F.when(F.col("support") > 0, F.col("label")))
    agg = s.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision_weighted"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall_weighted"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
        n_true_labels.alias("_k"), pos.alias("_pos"))
    posrow = s.select(F.col("label").alias("_pos"), F.col("precision").alias("_pp"),
                      F.col("recall").alias("_pr"), F.col("f1").alias("_pf"))
    j = agg.join(F.broadcast(posrow), "_pos", "left")
    binary = F.col("_k") == 2
    out = j.select(
        "accuracy",
        F.when(binary, F.col("_pp")).otherwise(F.col("precision_macro")).alias("precision"),
        F.when(binary, F.col("_pr")).otherwise(F.col("recall_macro")).alias("recall"),
        F.when(binary, F.col("_pf")).otherwise(F.col("f1_macro")).alias("f1"),
        "precision_macro", "recall_macro", "f1_macro", "precision_weighted", "recall_weighted", "f1_weighted")
    return out.select(*[_shown(c, digits) for c in out.columns])


def metrics_long(row: DataFrame) -> DataFrame:
    """One-row metrics -> (metric, value)."""
    cols = row.columns
    return row.selectExpr(f"stack({len(cols)}, " + ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
                          + ") AS (metric, value)")


def auc_binary(df: DataFrame, y: str = "y_true", score: str = "score", n_buckets: int = 1024) -> DataFrame:
    """``eval_auc_binary``: exact ROC AUC with tie-averaged ranks, as
    P(score_pos > score_neg) + 0.5 P(tie), from a (score -> pos, neg)
    histogram. The prefix sum of negatives below each score is two-phase:
    totals per value-range bucket (a small table, broadcast) plus a window
    inside each bucket -- no single-partition window at any size."""
    hist = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    return auc_from_hist(hist, n_buckets)


def _quantile_buckets(hist: DataFrame, n_buckets: int) -> DataFrame:
    """Bucket id per distinct score from approximate quantiles of the
    distinct scores (a bounded sketch, at most ``n_buckets`` boundaries
    reach the driver), so a dense cluster of scores cannot pile into one
    bucket the way equal-width buckets would."""
    from pyspark.ml.feature import Bucketizer

    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = sorted(set(hist.approxQuantile("s", probs, 1.0 / (4 * n_buckets)))) if n_buckets > 1 else []
    splits = [float("-inf"), *cuts, float("inf")]
    out = Bucketizer(splits=splits, inputCol="s", outputCol="_bd", handleInvalid="keep").transform(hist)
    return out.withColumn("_b", F.col("_bd").cast("int")).drop("_bd")


def auc_from_hist(hist: DataFrame, n_buckets: int = 1024, keys: list[str] | None = None) -> DataFrame:
    """AUC per group of ``keys`` from a (s, pos, neg) histogram. Buckets:
    quantiles of the distinct scores (one sketch over all groups)."""
    if not keys:
        hist, keys = hist.withColumn("_g", F.lit(0)), ["_g"]
    # Rows without a score take no part. The bucket id is made
    # non-nullable so the inner join below infers no NOT NULL filter that
    # Catalyst would push into only one of the two uses of ``h``, and both
    # uses read ``pos`` and ``neg`` (class totals come from the bucket
    # table), so column pruning leaves them identical: they share one
    # exchange and the histogram is built once.
    h = _quantile_buckets(hist.where(F.col("s").isNotNull()), n_buckets)
    h = h.withColumn("_b", F.coalesce(F.col("_b"), F.lit(-1)))
    per_b = h.groupBy(*keys, "_b").agg(F.sum("neg").alias("_bn"), F.sum("pos").alias("_bp"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wk = Window.partitionBy(*keys)
    offs = per_b.select(*keys, "_b", (F.sum("_bn").over(wb) - F.col("_bn")).alias("_off"),
                        F.sum("_bp").over(wk).alias("_p"), F.sum("_bn").over(wk).alias("_n"))
    wi = Window.partitionBy(*keys, "_b").orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.withColumn("_below", F.sum("neg").over(wi) - F.col("neg"))
    h = h.join(F.broadcast(offs), [*keys, "_b"])
    contrib = F.col("pos") * (F.col("_off") + F.col("_below") + 0.5 * F.col("neg"))
    res = h.groupBy(*keys).agg(F.sum(contrib).alias("_num"), F.max("_p").alias("_p"), F.max("_n").alias("_n"))
    out = res.select(*keys, F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                                   F.round(F.col("_num") / (F.col("_p") * F.col("_n")), 6)).alias("roc_auc"))
    return out.drop("_g")
