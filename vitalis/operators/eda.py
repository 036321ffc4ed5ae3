"""Analytic queries over the EDA cohort (inventory 2.4-2.6, 2.14).

Crosstabs use ``pivot`` with the fixed class list (one job, no value
discovery pass); top-k is ``orderBy(...).limit(k)`` which plans as
``TakeOrderedAndProject`` (per-partition top-k, then merge); rates over
grouped results are plain column arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.operators.clean import target_ordinal


def complaints_long(eda: DataFrame, cols: Sequence[str] | None = None,
                    ids: Sequence[str] = ("visit_row", "target")) -> DataFrame:
    """``unpivot_complaints``: wide description columns -> long, NULL dropped."""
    cols = list(cols or [f"{c}_description" for c in S.RFV_COLUMNS])
    return (eda.unpivot(list(ids), cols, "slot", "complaint")
               .where(F.col("complaint").isNotNull()))


def crosstab(df: DataFrame, label: str, target: str = "target",
             classes: Sequence[str] = S.TARGET_ORDER, rates: bool = True) -> DataFrame:
    """``agg_crosstab`` + ``agg_row_rates``: label x class counts (missing
    classes 0), row total and class share per row. NULL labels dropped."""
    # Fixed class list: conditional counts in one hash aggregate (no pivot
    # value discovery, no pivot-first phase, missing classes count 0).
    p = (df.where(F.col(label).isNotNull()).groupBy(label)
           .agg(*[F.count_if(F.col(target) == c).alias(c) for c in classes]))
    total = sum((F.col(c) for c in classes[1:]), F.col(classes[0]))
    p = p.select(label, *[F.col(c).cast("bigint").alias(c) for c in classes], total.cast("bigint").alias("total"))
    if rates:
        p = p.select("*", *[F.round(F.col(c) / F.col("total"), 6).alias(f"{c}_rate") for c in classes])
    return p


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Distributed top-k (``TakeOrderedAndProject``); ties resolved by the
    explicit trailing keys in ``order``."""
    return df.orderBy(*order).limit(k)


def pair_pivot(eda: DataFrame, min_total: int = 15) -> DataFrame:
    """``agg_pair_pivot``: primary complaint x primary diagnosis x class."""
    d = eda.select("RFV1_description", primary_diagnosis().alias("primary_diagnosis"), "target")
    d = d.where(F.col("RFV1_description").isNotNull() & F.col("primary_diagnosis").isNotNull())
    p = d.groupBy("RFV1_description", "primary_diagnosis").agg(
        *[F.count_if(F.col("target") == c).alias(c) for c in S.TARGET_ORDER])
    total = F.col("normal") + F.col("atencao") + F.col("urgente")
    return (p.select("RFV1_description", "primary_diagnosis",
                     *[F.col(c).cast("bigint").alias(c) for c in S.TARGET_ORDER],
                     total.cast("bigint").alias("total"))
             .withColumn("urgente_rate", F.round(F.col("urgente") / F.col("total"), 6))
             .where(F.col("total") >= min_total))


def primary_diagnosis() -> Column:
    """``prj_fill_coalesce``: description, else the code."""
    return F.coalesce(F.col("DIAG1_description"), F.col("DIAG1_code"))


def outcomes(eda: DataFrame, digits: int | None = 6) -> DataFrame:
    """``agg_outcomes``: visits, admission / critical-care / death rates,
    rounded for display (``digits=None``: raw, for comparisons)."""
    rate = lambda c: F.avg(c) if digits is None else F.round(F.avg(c), digits)
    adm = (F.coalesce(F.col("ADMITHOS") == 1, F.lit(False)) | F.coalesce(F.col("OBSHOS") == 1, F.lit(False)))
    crit = F.coalesce(F.col("ADMIT") == 1, F.lit(False))
    died = F.coalesce(F.col("DIEDED") == 1, F.lit(False))
    return eda.groupBy("target").agg(
        F.count(F.lit(1)).alias("visits"),
        rate(adm.cast("int")).alias("admission_rate"),
        rate(crit.cast("int")).alias("critical_care_rate"),
        F.sum(died.cast("int")).cast("bigint").alias("deaths_in_ed"),
        rate(died.cast("int")).alias("death_rate"))


VITAL_FIELDS = ("temperature_f", "heart_rate", "respiratory_rate", "systolic_bp",
                "oxygen_saturation", "pain_scale")


def median_count(eda: DataFrame, fields: Sequence[str] = VITAL_FIELDS) -> DataFrame:
    """``agg_median_count``: exact median (linear interpolation) and count
    per class and field. Spark's exact percentile keeps a value->count map
    per group, so memory follows the number of distinct values (small for
    vitals), not rows; ``percentile_approx`` is the unbounded-domain swap."""
    long = eda.unpivot(["target"], list(fields), "field", "value")
    return long.groupBy("target", "field").agg(
        F.round(F.median("value"), 6).alias("median"),
        F.count("value").alias("count"))


def box_stats(eda: DataFrame, fields: Sequence[str] = ("heart_rate", "respiratory_rate", "oxygen_saturation")
              ) -> DataFrame:
    """``agg_box_stats``: quartiles and 1.5 IQR whiskers (most extreme data
    within the fences) per class and field. One pass over the cohort builds
    a (class, field, value) -> count histogram (its size follows distinct
    values, not rows); exact quartiles are frequency-weighted percentiles of
    it and the whiskers scan it with the quartiles broadcast back."""
    # Rows without a class never reach the output (the joins drop them).
    long = eda.unpivot(["target"], list(fields), "field", "value").where(
        F.col("value").isNotNull() & F.col("target").isNotNull())
    long = long.groupBy("target", "field", "value").agg(F.count(F.lit(1)).alias("_c"))
    q = long.groupBy("target", "field").agg(
        F.percentile("value", [0.25, 0.5, 0.75], F.col("_c")).alias("_q"))
    q = q.select("target", "field", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3"))
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    w = (long.join(F.broadcast(q), ["target", "field"])
             .groupBy("target", "field")
             .agg(F.min(F.when(F.col("value") >= F.col("lo_fence"), F.col("value"))).alias("whisker_low"),
                  F.max(F.when(F.col("value") <= F.col("hi_fence"), F.col("value"))).alias("whisker_high")))
    return q.join(w, ["target", "field"]).select(
        "target", "field", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")])


def ambiguity(df: DataFrame, reps: dict[str, Column], target: str = "target") -> DataFrame:
    """``agg_ambiguity``: per representation, unique / repeated / conflicting
    values (NULL key kept as a group). Each representation is a grouped
    pass over SHA-256 digests, so no text is shuffled; results are stacked
    with ``unionByName``."""
    out = None
    keyed = df.select(target, *[F.unhex(F.sha2(expr.cast("string"), 256)).alias(f"_k{i}") for i, expr in enumerate(reps.values())])
    for i, name in enumerate(reps):
        # "More than one class" is max <> min (both skip NULL, like a
        # distinct count): one hash aggregate with map-side partial results.
        g = keyed.groupBy(f"_k{i}").agg(
            F.count(F.lit(1)).alias("rows"), (F.max(target) != F.min(target)).alias("conflict"))
        r = g.agg(F.count(F.lit(1)).alias("unique_values"),
                  F.count_if(F.col("rows") > 1).alias("repeated_values"),
                  F.count_if(F.col("conflict")).alias("conflicting_values"))
        r = r.select(F.lit(name).alias("representation"), "*")
        out = r if out is None else out.unionByName(r)
    return out


def majority_accuracy(eda: DataFrame, label: str = "RFV1_description") -> DataFrame:
    """``agg_majority_accuracy``: sum over labels of the largest class count
    divided by **all** rows (NULL labels count in the denominator only)."""
    per = (eda.where(F.col(label).isNotNull()).groupBy(label, "target").count()
              .groupBy(label).agg(F.max("count").alias("m")))
    num = per.agg(F.sum("m").alias("num"), F.lit(0).alias("_g"))
    den = eda.agg(F.count(F.lit(1)).alias("den"), F.lit(0).alias("_g"))
    return num.join(den, "_g").select(F.round(F.col("num") / F.col("den"), 6).alias("majority_accuracy"))


def head_per_group(df: DataFrame, part: str, order: Sequence[Column], n: int) -> DataFrame:
    """``win_head_per_group``: first ``n`` rows per group after a sort
    (Catalyst inserts a per-partition WindowGroupLimit before the shuffle)."""
    w = Window.partitionBy(part).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def monotonic_rate(rates: DataFrame, value: str = "admission_rate") -> DataFrame:
    """``agg_monotonic_rate``: on the 3-row per-class result, is ``value``
    non-decreasing in class order (``lag`` over the tiny grouped table)."""
    r = rates.withColumn("class_order", target_ordinal("target"))
    w = Window.partitionBy(F.lit(1)).orderBy("class_order")
    r = r.withColumn("_prev", F.lag(value).over(w))
    return r.agg(F.bool_and(F.coalesce(F.col(value) >= F.col("_prev"), F.lit(True))).alias("non_decreasing"))
