"""Preparation queries: eligibility, labels, decoding, cleaning, text,
ids, hashes, split and the training table (inventory 2.2, 2.3, 2.5, 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalis.operators import clean as C
from vitalis.plans.registry import register
from vitalis.plans.training_table import training_table
from vitalis.sources import fixtures as FX


@register("training_table", ["training"], "SELECT * FROM training")
def q_training_table(spark, sf):
    return training_table(spark, sf)


@register("flt_eligible", ["visits"], """
SELECT visit_row, IMMEDR FROM visits WHERE IMMEDR IN (1,2,3,4,5)""")
def q_flt_eligible(spark, sf):
    return C.require_rows(C.eligible(FX.visits(spark, sf)).select("visit_row", "IMMEDR"), "eligible visits")


@register("prj_target_map", ["visits"], """
SELECT visit_row, CASE WHEN IMMEDR IN (1,2) THEN 'urgente' WHEN IMMEDR = 3 THEN 'atencao'
  WHEN IMMEDR IN (4,5) THEN 'normal' END AS target FROM visits""")
def q_prj_target_map(spark, sf):
    return FX.visits(spark, sf).select("visit_row", C.target_expr().alias("target"))


@register("agg_class_distribution", ["visits"], """
SELECT target, CAST(count(*) AS BIGINT) AS rows, count(*) / sum(count(*)) OVER () AS rate,
  CASE target WHEN 'normal' THEN 1 WHEN 'atencao' THEN 2 ELSE 3 END AS class_order
FROM (SELECT CASE WHEN IMMEDR IN (1,2) THEN 'urgente' WHEN IMMEDR = 3 THEN 'atencao' ELSE 'normal' END AS target
      FROM visits WHERE IMMEDR IN (1,2,3,4,5)) t
GROUP BY target""")
def q_agg_class_distribution(spark, sf):
    from vitalis.operators.profile import class_distribution
    v = C.eligible(FX.visits(spark, sf)).select(C.target_expr().alias("target"))
    return class_distribution(v, "target")
