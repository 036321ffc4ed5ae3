"""Analytic (EDA) queries over the eligible cohort (inventory 2.4-2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.functions import text as X
from vitalis.operators import clean as C
from vitalis.operators import eda as E
from vitalis.operators import profile as P
from vitalis.plans.registry import register
from vitalis.sources import fixtures as FX

CLS = list(S.TARGET_ORDER)


def eda(spark, sf):
    return C.eda_cohort(FX.visits(spark, sf), FX.rfv_codebook(spark, sf),
                        FX.sex_codebook(spark), FX.diag_ref(spark, sf))


@register("agg_imbalance_ratio", ["eda"], """
SELECT round(max(n) / min(n), 6) AS imbalance_ratio FROM (SELECT target, count(*) AS n FROM eda GROUP BY target) g""")
def q_agg_imbalance_ratio(spark, sf):
    return P.imbalance_ratio(eda(spark, sf)).select(F.round("imbalance_ratio", 6).alias("imbalance_ratio"))


@register("unpivot_complaints", ["complaints_long"], "SELECT * FROM complaints_long")
def q_unpivot_complaints(spark, sf):
    return E.complaints_long(eda(spark, sf))


@register("agg_crosstab", ["complaint_summary"],
          "SELECT complaint, normal, atencao, urgente, total FROM complaint_summary")
def q_agg_crosstab(spark, sf):
    return E.crosstab(E.complaints_long(eda(spark, sf)), "complaint", rates=False)


@register("agg_row_rates", ["complaint_summary"], "SELECT * FROM complaint_summary")
def q_agg_row_rates(spark, sf):
    return E.crosstab(E.complaints_long(eda(spark, sf)), "complaint")


@register("rep_percentage_heatmap", ["complaint_summary"], """
SELECT complaint, normal_rate, atencao_rate, urgente_rate FROM complaint_summary
ORDER BY total DESC, complaint ASC LIMIT 20""")
def q_rep_percentage_heatmap(spark, sf):
    ct = E.crosstab(E.complaints_long(eda(spark, sf)), "complaint")
    return E.top_k(ct, [F.desc("total"), F.asc("complaint")], 20).select(
        "complaint", "normal_rate", "atencao_rate", "urgente_rate")


@register("top_most_frequent", ["complaint_summary"], """
SELECT complaint, total, normal, atencao, urgente, urgente_rate FROM complaint_summary
ORDER BY total DESC, complaint ASC LIMIT 20""")
def q_top_most_frequent(spark, sf):
    ct = E.crosstab(E.complaints_long(eda(spark, sf)), "complaint")
    return E.top_k(ct, [F.desc("total"), F.asc("complaint")], 20).select(
        "complaint", "total", *CLS, "urgente_rate")


@register("top_high_risk", ["complaint_summary"], """
SELECT complaint, total, normal_rate, atencao_rate, urgente_rate FROM complaint_summary
WHERE total >= 30 ORDER BY urgente_rate DESC, total DESC, complaint ASC LIMIT 20""")
def q_top_high_risk(spark, sf):
    ct = E.crosstab(E.complaints_long(eda(spark, sf)), "complaint").where(F.col("total") >= 30)
    return E.top_k(ct, [F.desc("urgente_rate"), F.desc("total"), F.asc("complaint")], 20).select(
        "complaint", "total", "normal_rate", "atencao_rate", "urgente_rate")


@register("top_diagnoses", ["diagnosis_summary"], """
SELECT primary_diagnosis, total, normal, atencao, urgente, urgente_rate FROM diagnosis_summary
ORDER BY total DESC, primary_diagnosis ASC LIMIT 20""")
def q_top_diagnoses(spark, sf):
    d = eda(spark, sf).select(E.primary_diagnosis().alias("primary_diagnosis"), "target")
    ct = E.crosstab(d, "primary_diagnosis")
    return E.top_k(ct, [F.desc("total"), F.asc("primary_diagnosis")], 20).select(
        "primary_diagnosis", "total", *CLS, "urgente_rate")


@register("agg_pair_pivot", ["eda"], """
SELECT RFV1_description, primary_diagnosis, normal, atencao, urgente, total, round(urgente / total, 6) AS urgente_rate
FROM (SELECT RFV1_description, primary_diagnosis,
        CAST(count(*) FILTER (WHERE target='normal') AS BIGINT) AS normal,
        CAST(count(*) FILTER (WHERE target='atencao') AS BIGINT) AS atencao,
        CAST(count(*) FILTER (WHERE target='urgente') AS BIGINT) AS urgente,
        CAST(count(*) AS BIGINT) AS total
      FROM (SELECT RFV1_description, coalesce(DIAG1_description, DIAG1_code) AS primary_diagnosis, target FROM eda) d
      WHERE RFV1_description IS NOT NULL AND primary_diagnosis IS NOT NULL
      GROUP BY RFV1_description, primary_diagnosis) p
WHERE total >= 15""")
def q_agg_pair_pivot(spark, sf):
    return E.pair_pivot(eda(spark, sf), 15)


@register("top_pairs", ["eda"], """
SELECT * FROM (
SELECT RFV1_description, primary_diagnosis, normal, atencao, urgente, total, round(urgente / total, 6) AS urgente_rate
FROM (SELECT RFV1_description, primary_diagnosis,
        CAST(count(*) FILTER (WHERE target='normal') AS BIGINT) AS normal,
        CAST(count(*) FILTER (WHERE target='atencao') AS BIGINT) AS atencao,
        CAST(count(*) FILTER (WHERE target='urgente') AS BIGINT) AS urgente,
        CAST(count(*) AS BIGINT) AS total
      FROM (SELECT RFV1_description, coalesce(DIAG1_description, DIAG1_code) AS primary_diagnosis, target FROM eda) d
      WHERE RFV1_description IS NOT NULL AND primary_diagnosis IS NOT NULL
      GROUP BY RFV1_description, primary_diagnosis) p
WHERE total >= 15) q
ORDER BY total DESC, urgente_rate DESC, RFV1_description, primary_diagnosis LIMIT 25""")
def q_top_pairs(spark, sf):
    p = E.pair_pivot(eda(spark, sf), 15)
    return E.top_k(p, [F.desc("total"), F.desc("urgente_rate"), F.asc("RFV1_description"),
                       F.asc("primary_diagnosis")], 25)


@register("agg_outcomes", ["eda"], """
SELECT target, count(*) AS visits,
  round(avg(CASE WHEN ADMITHOS = 1 OR OBSHOS = 1 THEN 1 ELSE 0 END), 6) AS admission_rate,
  round(avg(CASE WHEN ADMIT = 1 THEN 1 ELSE 0 END), 6) AS critical_care_rate,
  CAST(sum(CASE WHEN DIEDED = 1 THEN 1 ELSE 0 END) AS BIGINT) AS deaths_in_ed,
  round(avg(CASE WHEN DIEDED = 1 THEN 1 ELSE 0 END), 6) AS death_rate
FROM eda GROUP BY target""")
def q_agg_outcomes(spark, sf):
    return E.outcomes(eda(spark, sf))


@register("agg_monotonic_rate", ["eda"], """
SELECT bool_and(coalesce(admission_rate >= prev, true)) AS non_decreasing FROM (
  SELECT admission_rate, lag(admission_rate) OVER (ORDER BY CASE target WHEN 'normal' THEN 1 WHEN 'atencao' THEN 2 ELSE 3 END) AS prev
  FROM (SELECT target, avg(CASE WHEN ADMITHOS = 1 OR OBSHOS = 1 THEN 1 ELSE 0 END) AS admission_rate
        FROM eda GROUP BY target) g) t""")
def q_agg_monotonic_rate(spark, sf):
    return E.monotonic_rate(E.outcomes(eda(spark, sf), digits=None))


_MEDIAN_SQL = " UNION ALL ".join(
    f"SELECT target, '{f}' AS field, round(quantile_cont({f}, 0.5), 6) AS median, count({f}) AS count "
    f"FROM eda GROUP BY target" for f in E.VITAL_FIELDS)


@register("agg_median_count", ["eda"], _MEDIAN_SQL)
def q_agg_median_count(spark, sf):
    return E.median_count(eda(spark, sf))


_BOX_SQL = """
WITH long AS (""" + " UNION ALL ".join(
    f"SELECT target, '{f}' AS field, {f} AS value FROM eda WHERE {f} IS NOT NULL"
    for f in ("heart_rate", "respiratory_rate", "oxygen_saturation")) + """),
q AS (SELECT target, field, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
        quantile_cont(value, 0.75) AS q3 FROM long GROUP BY target, field)
SELECT q.target, q.field, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END), 6) AS whisker_low,
  round(max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END), 6) AS whisker_high
FROM q JOIN long l ON l.target = q.target AND l.field = q.field
GROUP BY q.target, q.field, q1, median, q3"""


@register("agg_box_stats", ["eda"], _BOX_SQL)
def q_agg_box_stats(spark, sf):
    return E.box_stats(eda(spark, sf))


@register("agg_ambiguity", ["eda_text"], """
SELECT 'Full derived clinical text' AS representation, count(*) AS unique_values,
  count(*) FILTER (WHERE rows > 1) AS repeated_values, count(*) FILTER (WHERE dt > 1) AS conflicting_values
FROM (SELECT clinical_text, count(*) AS rows, count(DISTINCT target) AS dt FROM eda_text GROUP BY clinical_text) a
UNION ALL
SELECT 'Complaint signature only', count(*), count(*) FILTER (WHERE rows > 1), count(*) FILTER (WHERE dt > 1)
FROM (SELECT concat_ws(' | ', coalesce(RFV1_description, ''), coalesce(RFV2_description, ''),
        coalesce(RFV3_description, ''), coalesce(RFV4_description, ''), coalesce(RFV5_description, '')) AS sig,
        count(*) AS rows, count(DISTINCT target) AS dt FROM eda GROUP BY sig) b""")
def q_agg_ambiguity(spark, sf):
    e = eda(spark, sf)
    desc = [f"{c}_description" for c in S.RFV_COLUMNS]
    return E.ambiguity(e, {"Full derived clinical text": X.clinical_text(eda=True),
                           "Complaint signature only": X.signature(desc)})


@register("agg_majority_accuracy", ["eda"], """
SELECT round(sum(m) / (SELECT count(*) FROM eda), 6) AS majority_accuracy FROM (
  SELECT RFV1_description, max(n) AS m FROM (
    SELECT RFV1_description, target, count(*) AS n FROM eda WHERE RFV1_description IS NOT NULL
    GROUP BY RFV1_description, target) x GROUP BY RFV1_description) y""")
def q_agg_majority_accuracy(spark, sf):
    return E.majority_accuracy(eda(spark, sf))


@register("agg_diag_match_rate", ["eda"], """
SELECT round(avg(CASE WHEN DIAG1_description IS NOT NULL THEN 1 ELSE 0 END), 6) AS diagnosis_match_rate
FROM eda WHERE DIAG1_code IS NOT NULL""")
def q_agg_diag_match_rate(spark, sf):
    return (eda(spark, sf).where(F.col("DIAG1_code").isNotNull())
            .agg(F.round(F.avg(F.col("DIAG1_description").isNotNull().cast("int")), 6).alias("diagnosis_match_rate")))


@register("win_head_per_group", ["eda_text"], """
SELECT clinical_text, target FROM (
  SELECT clinical_text, target, row_number() OVER (PARTITION BY target ORDER BY RFV1, visit_row) AS rn
  FROM eda_text WHERE RFV1_description IS NOT NULL) t WHERE rn <= 2""")
def q_win_head_per_group(spark, sf):
    # The text is templated after the per-class limit: only the kept rows
    # (two per class) pay for it, not the whole cohort.
    e = eda(spark, sf).where(F.col("RFV1_description").isNotNull())
    head = E.head_per_group(e, "target", [F.col("RFV1"), F.col("visit_row")], 2)
    return head.select(X.clinical_text(eda=True).alias("clinical_text"), "target")


@register("agg_coverage", ["eda"], " UNION ALL ".join(
    f"SELECT '{lbl}' AS field, count({col}) AS available_rows, round(count({col}) / count(*), 6) AS coverage FROM eda"
    for lbl, col in [("Reason for visit", "CASE WHEN RFV1 > 0 THEN RFV1 END")]
    + [(r.label, r.clean) for r in S.VITAL_RULES]))
def q_agg_coverage(spark, sf):
    e = eda(spark, sf).withColumn("RFV1", F.when(F.col("RFV1") > 0, F.col("RFV1")))
    fields = [("Reason for visit", "RFV1")] + [(r.label, r.clean) for r in S.VITAL_RULES]
    aggs = []
    for lbl, col in fields:
        aggs += [F.count(col).alias(f"{lbl}__available_rows"),
                 F.round(F.count(col) / F.count(F.lit(1)), 6).alias(f"{lbl}__coverage")]
    return P.unpivot_stats(e.agg(*aggs), [f for f, _ in fields], ["available_rows", "coverage"], "field")


@register("agg_coverage_by_class", ["eda"], " UNION ALL ".join(
    f"SELECT target, '{lbl}' AS field, round(avg(CASE WHEN {col} IS NOT NULL THEN 1 ELSE 0 END), 6) AS coverage "
    f"FROM eda GROUP BY target"
    for lbl, col in [("Reason for visit", "CASE WHEN RFV1 > 0 THEN RFV1 END")]
    + [(r.label, r.clean) for r in S.VITAL_RULES]))
def q_agg_coverage_by_class(spark, sf):
    e = eda(spark, sf).withColumn("RFV1", F.when(F.col("RFV1") > 0, F.col("RFV1")))
    fields = [("Reason for visit", "RFV1")] + [(r.label, r.clean) for r in S.VITAL_RULES]
    long = e.select("target", F.explode(F.array(*[
        F.struct(F.lit(l).alias("field"), F.col(c).isNotNull().cast("int").alias("present"))
        for l, c in fields])).alias("s"))
    return long.groupBy("target", F.col("s.field").alias("field")).agg(
        F.round(F.avg("s.present"), 6).alias("coverage"))


@register("agg_primary_coverage", ["visits"], """
SELECT round(avg(CASE WHEN RFV1 > 0 THEN 1 ELSE 0 END), 6) AS primary_coverage,
  avg(CASE WHEN RFV1 > 0 THEN 1 ELSE 0 END) >= 0.95 AS passed
FROM visits WHERE IMMEDR IN (1,2,3,4,5)""")
def q_agg_primary_coverage(spark, sf):
    v = C.eligible(FX.visits(spark, sf))
    share = F.avg((F.col("RFV1") > 0).cast("int"))
    return v.agg(F.round(share, 6).alias("primary_coverage"),
                 (share >= S.GATE_MIN_PRIMARY_COVERAGE).alias("passed"))


@register("agg_value_counts_all", ["visits"], """
SELECT IMMEDR, count(*) AS rows, IMMEDR IN (1,2,3,4,5) AS eligible FROM visits GROUP BY IMMEDR""")
def q_agg_value_counts_all(spark, sf):
    return (FX.visits(spark, sf).groupBy("IMMEDR").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("eligible", F.coalesce(F.col("IMMEDR").isin(list(S.TARGET_MAP)), F.lit(False))))


_SPECIAL_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) FILTER (WHERE {c} IS NULL) AS direct_nulls, "
    f"count(*) FILTER (WHERE {c} IN ({', '.join(map(str, codes))})) AS special_rows, "
    f"count(*) FILTER (WHERE {c} IS NULL OR {c} NOT IN ({', '.join(map(str, codes))})) AS usable_rows, "
    f"round(avg(CASE WHEN {c} IS NULL OR {c} NOT IN ({', '.join(map(str, codes))}) THEN 1 ELSE 0 END), 6) AS usable_rate "
    f"FROM visits" for c, codes in S.SPECIAL_CODES.items())


@register("agg_sentinel_profile", ["visits"], _SPECIAL_SQL)
def q_agg_sentinel_profile(spark, sf):
    from vitalis.functions import nulls as N
    v = FX.visits(spark, sf)
    aggs = []
    for c, codes in S.SPECIAL_CODES.items():
        usable = N.is_usable(c, codes)
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__direct_nulls"),
                 F.count_if(N.is_sentinel(c, codes)).alias(f"{c}__special_rows"),
                 F.count_if(usable).alias(f"{c}__usable_rows"),
                 F.round(F.avg(usable.cast("int")), 6).alias(f"{c}__usable_rate")]
    return P.unpivot_stats(v.agg(*aggs), list(S.SPECIAL_CODES),
                           ["direct_nulls", "special_rows", "usable_rows", "usable_rate"], "field")


_VITAL_SQL = " UNION ALL ".join(
    f"SELECT '{r.label}' AS field, "
    f"count(*) FILTER (WHERE {r.source} IN ({', '.join(map(str, r.sentinels))})) AS special_rows, "
    f"count(*) FILTER (WHERE {r.source} NOT IN ({', '.join(map(str, r.sentinels))}) AND {r.source} BETWEEN {r.lower} AND {r.upper}) AS usable_rows, "
    f"count(*) FILTER (WHERE {r.source} NOT IN ({', '.join(map(str, r.sentinels))}) AND NOT ({r.source} BETWEEN {r.lower} AND {r.upper})) AS invalid_rows "
    f"FROM visits" for r in S.VITAL_RULES)


@register("agg_vital_audit", ["visits"], _VITAL_SQL)
def q_agg_vital_audit(spark, sf):
    from vitalis.functions import nulls as N
    v = FX.visits(spark, sf)
    aggs = []
    for r in S.VITAL_RULES:
        special = N.is_sentinel(r.source, r.sentinels)
        ok = ~special & N.in_domain(r.source, r.lower, r.upper)
        aggs += [F.count_if(special).alias(f"{r.label}__special_rows"),
                 F.count_if(ok).alias(f"{r.label}__usable_rows"),
                 F.count_if(~special & ~ok).alias(f"{r.label}__invalid_rows")]
    return P.unpivot_stats(v.agg(*aggs), [r.label for r in S.VITAL_RULES],
                           ["special_rows", "usable_rows", "invalid_rows"], "field")


@register("flt_domain_violation", ["visits"], " UNION ALL ".join(
    f"SELECT '{r.source}' AS field, count(*) FILTER (WHERE {r.source} NOT IN ({', '.join(map(str, r.sentinels))}) "
    f"AND NOT ({r.source} BETWEEN {r.lower} AND {r.upper})) AS violations FROM visits WHERE IMMEDR IN (1,2,3,4,5)"
    for r in S.VITAL_RULES))
def q_flt_domain_violation(spark, sf):
    from vitalis.functions import nulls as N
    v = C.eligible(FX.visits(spark, sf))
    aggs = [F.count_if(N.is_usable(r.source, r.sentinels) & ~N.in_domain(r.source, r.lower, r.upper))
            .alias(f"{r.source}__violations") for r in S.VITAL_RULES]
    return P.unpivot_stats(v.agg(*aggs), [r.source for r in S.VITAL_RULES], ["violations"], "field")
