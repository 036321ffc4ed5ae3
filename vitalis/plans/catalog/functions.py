"""Scalar functions (2.7) and the remaining profile, window, sort and set
queries (2.4-2.6)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.functions import text as X
from vitalis.operators import clean as C
from vitalis.operators import eda as E
from vitalis.operators import profile as P
from vitalis.operators.split import group_folds
from vitalis.plans.catalog.eda import eda
from vitalis.plans.registry import register
from vitalis.plans.training_table import decoded_visits, training_table
from vitalis.sources import fixtures as FX
from vitalis.sources.tables import TABLES, table

AGE_SQL = """CASE WHEN AGE = 0 AND AGEDAYS BETWEEN 0 AND 365 THEN 'Age: ' || CAST(AGEDAYS AS VARCHAR) || ' days.'
  {cap} ELSE 'Age: ' || CAST(AGE AS VARCHAR) || ' years.' END"""
DEDUP_SQL = """concat_ws('; ', RFV1_description,
  CASE WHEN RFV2_description IS DISTINCT FROM RFV1_description THEN RFV2_description END,
  CASE WHEN RFV3_description IS DISTINCT FROM RFV1_description AND RFV3_description IS DISTINCT FROM RFV2_description
       THEN RFV3_description END,
  CASE WHEN RFV4_description IS DISTINCT FROM RFV1_description AND RFV4_description IS DISTINCT FROM RFV2_description
       AND RFV4_description IS DISTINCT FROM RFV3_description THEN RFV4_description END,
  CASE WHEN RFV5_description IS DISTINCT FROM RFV1_description AND RFV5_description IS DISTINCT FROM RFV2_description
       AND RFV5_description IS DISTINCT FROM RFV3_description AND RFV5_description IS DISTINCT FROM RFV4_description
       THEN RFV5_description END)"""
ALL_SQL = "concat_ws('; ', RFV1_description, RFV2_description, RFV3_description, RFV4_description, RFV5_description)"
DESC = [f"{c}_description" for c in S.RFV_COLUMNS]
WS_DUCK = "[\\t\\n\\x0b\\f\\r\\x1c-\\x1f ]+"


# --- 2.7 scalar functions ------------------------------------------------------

@register("fn_age_phrase", ["eda"], "SELECT visit_row, " + AGE_SQL.format(
    cap="WHEN AGE = 93 THEN 'Age: 93 years or older.'") + " AS age_phrase FROM eda")
def q_fn_age_phrase(spark, sf):
    return C.eligible(FX.visits(spark, sf)).select("visit_row", X.age_phrase().alias("age_phrase"))


@register("fn_age_phrase_eda", ["eda"], "SELECT visit_row, " + AGE_SQL.format(cap="") + " AS age_phrase FROM eda")
def q_fn_age_phrase_eda(spark, sf):
    return C.eligible(FX.visits(spark, sf)).select("visit_row", X.age_phrase(cap_93=False).alias("age_phrase"))


@register("fn_complaint_phrase", ["eda"], f"""
SELECT visit_row, CASE WHEN {DEDUP_SQL} <> '' THEN 'Reasons for visit: ' || {DEDUP_SQL} || '.' END AS complaint_phrase
FROM eda""")
def q_fn_complaint_phrase(spark, sf):
    return eda(spark, sf).select("visit_row", X.complaint_phrase(DESC).alias("complaint_phrase"))


@register("fn_complaint_phrase_eda", ["eda"], f"""
SELECT visit_row, CASE WHEN {ALL_SQL} <> '' THEN 'Reasons for visit: ' || {ALL_SQL} || '.' END AS complaint_phrase
FROM eda""")
def q_fn_complaint_phrase_eda(spark, sf):
    return eda(spark, sf).select("visit_row", X.complaint_phrase(DESC, dedupe=False).alias("complaint_phrase"))


@register("win_dedupe_keep_first", ["eda"], f"SELECT visit_row, {DEDUP_SQL} AS complaints FROM eda")
def q_win_dedupe_keep_first(spark, sf):
    return eda(spark, sf).select("visit_row", F.array_join(X.ordered_distinct(DESC), "; ").alias("complaints"))


@register("fn_observation_phrase", ["train_text"], """
SELECT visit_row, regexp_extract(clinical_text, '(Triage observations: .*)$', 1) AS observation_phrase
FROM train_text WHERE clinical_text LIKE '%Triage observations: %'""")
def q_fn_observation_phrase(spark, sf):
    e = C.clean_vitals(C.eligible(FX.visits(spark, sf)), policy="raise")
    return e.select("visit_row", X.observation_phrase().alias("observation_phrase")) \
            .where(F.col("observation_phrase").isNotNull())


@register("fn_clinical_text", ["train_text"], "SELECT visit_row, clinical_text FROM train_text")
def q_fn_clinical_text(spark, sf):
    d = decoded_visits(FX.visits(spark, sf), FX.rfv_codebook(spark, sf), FX.sex_codebook(spark))
    return d.select("visit_row", X.collapse_whitespace(X.clinical_text()).alias("clinical_text"))


@register("fn_clinical_text_eda", ["eda_text"], "SELECT visit_row, clinical_text FROM eda_text")
def q_fn_clinical_text_eda(spark, sf):
    return eda(spark, sf).select("visit_row", X.clinical_text(eda=True).alias("clinical_text"))


@register("fn_normalize_text", [], f"""
SELECT doc_id, trim(regexp_replace(nfc_normalize(text), '{WS_DUCK}', ' ', 'g')) AS normalized FROM documents""")
def q_fn_normalize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.normalize_text("text").alias("normalized"))


@register("fn_text_hash", [], "SELECT doc_id, sha256(replace(lower(text), 'ß', 'ss')) AS text_hash FROM documents")
def q_fn_text_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.text_hash("text").alias("text_hash"))


@register("udf_row", [], f"""
SELECT doc_id, trim(regexp_replace(nfc_normalize(text), '{WS_DUCK}', ' ', 'g')) AS normalized,
  sha256(replace(lower(trim(regexp_replace(nfc_normalize(text), '{WS_DUCK}', ' ', 'g'))), 'ß', 'ss')) AS text_hash
FROM documents""")
def q_udf_row(spark, sf):
    """The one remaining Python step (NFKC + casefold) as a single Arrow
    UDF call on non-ASCII rows; everything else is JVM expressions."""
    norm, h = X.normalize_with_hash("text")
    return table(spark, sf, "documents").select("doc_id", norm.alias("normalized"), h.alias("text_hash"))


@register("fn_record_id", ["visits"], """
SELECT visit_row, sha256('nhamcs-ed-2021-training-v1:' || CAST(visit_row AS VARCHAR)) AS record_id FROM visits""")
def q_fn_record_id(spark, sf):
    return FX.visits(spark, sf).select("visit_row", X.record_id("visit_row").alias("record_id"))


@register("fn_diag_normalize", ["visits"], """
SELECT visit_row, CASE WHEN rtrim(replace(trim(DIAG1), '.', ''), '-') IN ('', '-9', '-8', '-7') THEN NULL
  ELSE rtrim(replace(trim(DIAG1), '.', ''), '-') END AS DIAG1_code FROM visits""")
def q_fn_diag_normalize(spark, sf):
    return FX.visits(spark, sf).select("visit_row", X.diag_normalize("DIAG1").alias("DIAG1_code"))


@register("fn_signature", ["eda"], """
SELECT visit_row, concat_ws(' | ', coalesce(RFV1_description, ''), coalesce(RFV2_description, ''),
  coalesce(RFV3_description, ''), coalesce(RFV4_description, ''), coalesce(RFV5_description, '')) AS complaint_signature
FROM eda""")
def q_fn_signature(spark, sf):
    return eda(spark, sf).select("visit_row", X.signature(DESC).alias("complaint_signature"))


@register("fn_tokenize_ascii", [], """
SELECT doc_id, regexp_extract_all(lower(text), '([A-Za-z0-9_]{2,})', 1) AS tokens FROM documents""")
def q_fn_tokenize_ascii(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.tokenize("text").alias("tokens"))


@register("fn_tokenize_unicode", [], """
SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+', 0) AS tokens FROM documents""")
def q_fn_tokenize_unicode(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.tokenize("text", X.TOKEN_RE_UNICODE, 0).alias("tokens"))


@register("fn_token_count", [], f"""
SELECT doc_id, length(text) AS n_chars,
  CASE WHEN trim(regexp_replace(text, '{WS_DUCK}', ' ', 'g')) = '' THEN 0
       ELSE len(string_split(trim(regexp_replace(text, '{WS_DUCK}', ' ', 'g')), ' ')) END AS n_tokens
FROM documents""")
def q_fn_token_count(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.length("text").alias("n_chars"), X.token_count("text").alias("n_tokens"))


@register("fn_ngrams", [], """
SELECT doc_id, CASE WHEN len(t) >= 2 THEN list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))
  ELSE t END AS ngrams
FROM (SELECT doc_id, regexp_extract_all(lower(text), '([A-Za-z0-9_]{2,})', 1) AS t FROM documents) d""")
def q_fn_ngrams(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", X.tokenize("text").alias("t"))
    return d.select("doc_id", X.ngrams_1_2("t").alias("ngrams"))


@register("fn_bucket_target_status", ["eda"], """
SELECT target, CASE WHEN count(*) >= 1000 THEN 'PASS' ELSE 'FAIL' END AS status FROM eda GROUP BY target""")
def q_fn_bucket_target_status(spark, sf):
    g = eda(spark, sf).groupBy("target").agg(F.count(F.lit(1)).alias("n"))
    return g.select("target", X.status(F.col("n") >= 1000).alias("status"))


@register("fn_format_currency", [], """
SELECT o_orderkey, 'US$ ' || format('{:,.0f}', round_even(o_totalprice, 0)) AS formatted FROM orders""")
def q_fn_format_currency(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.format_currency("o_totalprice").alias("formatted"))


@register("fn_format_percent", [], """
SELECT c_custkey, format('{:,.1f}', round_even(c_acctbal / 10000.0E0 * 100, 1)) || '%' AS formatted FROM customer""")
def q_fn_format_percent(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", X.format_percent(F.col("c_acctbal") / 10000.0).alias("formatted"))


@register("fn_version_pattern", [], """
SELECT doc_id, (sha256(text) = 'local' OR regexp_matches(substr(sha256(text), 1, 40), '^[0-9a-fA-F]{40}$')) AS valid_commit,
  regexp_matches(source, '^[0-9a-fA-F]{40}$') OR source = 'local' AS source_is_commit FROM documents""")
def q_fn_version_pattern(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.valid_version(F.substring(F.sha2("text", 256), 1, 40)).alias("valid_commit"),
                    X.valid_version("source").alias("source_is_commit"))


# --- 2.4 profiles on the driver tables --------------------------------------

@register("agg_table_distribution", [], """
SELECT o_orderstatus, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS rate FROM orders GROUP BY 1""")
def q_agg_table_distribution(spark, sf):
    d = P.class_distribution(table(spark, sf, "orders"), "o_orderstatus", order=None)
    return d.select("o_orderstatus", "rows", F.round("rate", 6).alias("rate"))


@register("agg_table_summary", [], " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, (SELECT count(*) FROM (DESCRIBE {t})) AS columns FROM {t}"
    for t in TABLES))
def q_agg_table_summary(spark, sf):
    out = None
    for t in TABLES:
        df = table(spark, sf, t)
        r = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(t).alias("table"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))
        out = r if out is None else out.unionByName(r)
    return out.orderBy(F.desc("rows"), "table")


@register("union_reports", [], """
SELECT 'orders' AS report, o_orderstatus AS key, count(*) AS rows FROM orders GROUP BY 2
UNION ALL SELECT 'lineitem', l_returnflag, count(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'customer', c_mktsegment, count(*) FROM customer GROUP BY 2""")
def q_union_reports(spark, sf):
    parts = [("orders", "o_orderstatus"), ("lineitem", "l_returnflag"), ("customer", "c_mktsegment")]
    out = None
    for name, col in parts:
        r = table(spark, sf, name).groupBy(F.col(col).alias("key")).agg(F.count(F.lit(1)).alias("rows")) \
                                  .select(F.lit(name).alias("report"), "key", "rows")
        out = r if out is None else out.unionByName(r)
    return out


_ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_DT = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
       "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@register("agg_schema_profile", [], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{_DT[c]}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS null_rate, count(DISTINCT {c}) AS unique_values "
    f"FROM orders" for c in _ORD_COLS))
def q_agg_schema_profile(spark, sf):
    p = P.schema_profile(table(spark, sf, "orders"))
    return p.withColumn("null_rate", F.round("null_rate", 6))


@register("agg_missing_columns", ["eda"], "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS null_rate FROM eda"
    for c in C.EDA_COLUMNS) + ") m WHERE nulls > 0")
def q_agg_missing_columns(spark, sf):
    e = eda(spark, sf).select(*C.EDA_COLUMNS)
    p = P.schema_profile(e, exact_distinct=False)
    return (p.where(F.col("nulls") > 0).select("column", "nulls", F.round("null_rate", 6).alias("null_rate"))
             .orderBy(F.desc("null_rate"), F.desc("nulls")))


@register("agg_duplicate_rows", [], " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) "
    f"AS duplicate_rows FROM {t}" for t in ("lineitem", "orders", "documents", "labels")))
def q_agg_duplicate_rows(spark, sf):
    out = None
    for t in ("lineitem", "orders", "documents", "labels"):
        r = P.duplicate_rows(table(spark, sf, t)).select(F.lit(t).alias("table"), "rows", "duplicate_rows")
        out = r if out is None else out.unionByName(r)
    return out


@register("agg_duplicate_key", [], """
SELECT count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS missing_keys,
  (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem
     GROUP BY l_orderkey, l_linenumber) g) AS duplicated_keys FROM lineitem""")
def q_agg_duplicate_key(spark, sf):
    return P.duplicate_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("agg_binary_column", [], """
SELECT 'quality' AS "column", count(*) FILTER (WHERE quality IS NOT NULL AND quality NOT IN (0, 1)) AS invalid_rows
FROM labels UNION ALL
SELECT 'toxic', count(*) FILTER (WHERE toxic IS NOT NULL AND toxic NOT IN (0, 1)) FROM labels""")
def q_agg_binary_column(spark, sf):
    return P.binary_columns(table(spark, sf, "labels"), ["quality", "toxic"])


_DESC_STATS = "count({x}) AS count, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, " \
              "min({x}) AS min, round(quantile_cont({x}, 0.05), 6) AS p05, round(quantile_cont({x}, 0.5), 6) AS p50, " \
              "round(quantile_cont({x}, 0.95), 6) AS p95, max({x}) AS max"


@register("agg_text_describe", [], f"""
SELECT 'characters' AS measure, {_DESC_STATS.format(x='n')} FROM (SELECT length(text) AS n FROM documents) a
UNION ALL
SELECT 'tokens', {_DESC_STATS.format(x='n')} FROM (SELECT CASE WHEN trim(regexp_replace(text, '{WS_DUCK}', ' ', 'g')) = ''
  THEN 0 ELSE len(string_split(trim(regexp_replace(text, '{WS_DUCK}', ' ', 'g')), ' ')) END AS n FROM documents) b""")
def q_agg_text_describe(spark, sf):
    d = table(spark, sf, "documents")
    return P.describe_lengths(d.select(F.length("text").alias("characters"), X.token_count("text").alias("tokens")),
                              ["characters", "tokens"])


@register("agg_substring_coverage", [], """
SELECT 'the' AS literal, round(avg(CASE WHEN contains(text, 'the') THEN 1 ELSE 0 END), 6) AS coverage FROM documents
UNION ALL SELECT '@', round(avg(CASE WHEN contains(text, '@') THEN 1 ELSE 0 END), 6) FROM documents
UNION ALL SELECT 'http', round(avg(CASE WHEN contains(text, 'http') THEN 1 ELSE 0 END), 6) FROM documents""")
def q_agg_substring_coverage(spark, sf):
    lits = ["the", "@", "http"]
    d = table(spark, sf, "documents")
    row = d.agg(*[F.round(F.avg(F.col("text").contains(l).cast("int")), 6).alias(f"{l}__coverage") for l in lits])
    return P.unpivot_stats(row, lits, ["coverage"], "literal")


@register("agg_split_audit", ["training"], """
WITH g AS (SELECT text_hash, count(*) AS n, count(DISTINCT target) AS nt, count(DISTINCT split) AS ns
           FROM training GROUP BY text_hash),
gr AS (SELECT target, count(*) / sum(count(*)) OVER () AS r FROM training GROUP BY target),
sr AS (SELECT split, target, count(*) / sum(count(*)) OVER (PARTITION BY split) AS r FROM training GROUP BY split, target)
SELECT (SELECT count(*) FROM g) AS unique_texts, (SELECT count(*) FILTER (WHERE n > 1) FROM g) AS repeated_groups,
  (SELECT count(*) FILTER (WHERE nt > 1) FROM g) AS conflicting_groups,
  (SELECT count(*) FILTER (WHERE ns > 1) FROM g) AS crossing_groups,
  (SELECT round(max(abs(sr.r - gr.r)) * 100, 6) FROM sr JOIN gr USING (target)) AS max_drift_points""")
def q_agg_split_audit(spark, sf):
    return P.split_audit(training_table(spark, sf))


@register("agg_version_unique", ["training"], """
SELECT count(DISTINCT dataset_version) AS versions, count(DISTINCT dataset_version) = 1 AS passed FROM training""")
def q_agg_version_unique(spark, sf):
    t = training_table(spark, sf)
    return t.agg(F.countDistinct("dataset_version").alias("versions")).withColumn("passed", F.col("versions") == 1)


# --- 2.5 / 2.6 windows, sorts, sets -------------------------------------------

@register("win_quota_split", ["train_text"], """
SELECT text_hash, stratum, n, CAST(floor(20 * (sum(n) OVER (PARTITION BY stratum ORDER BY hh, text_hash
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n) / sum(n) OVER (PARTITION BY stratum)) AS INT) AS fold
FROM (SELECT text_hash, min(target) AS stratum, count(*) AS n, sha256('42:' || text_hash) AS hh
      FROM (SELECT target, sha256(lower(clinical_text)) AS text_hash FROM train_text) x GROUP BY text_hash) g""")
def q_win_quota_split(spark, sf):
    from vitalis.plans.training_table import training_rows
    from vitalis.session import materialize
    rows = training_rows(decoded_visits(FX.visits(spark, sf), FX.rfv_codebook(spark, sf), FX.sex_codebook(spark)))
    return group_folds(materialize(rows.select("text_hash", "target"), "split-rows"))


@register("win_latest_version", [], """
SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS latest_orderkey, max(o_orderdate) AS latest_date
FROM orders GROUP BY o_custkey""")
def q_win_latest_version(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(
        F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest_orderkey"),
        F.max("o_orderdate").alias("latest_date"))


@register("sort_multi_key", [], """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority ASC, o_totalprice DESC, o_orderkey""")
def q_sort_multi_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice") \
        .orderBy(F.asc("o_orderpriority"), F.desc("o_totalprice"), "o_orderkey")


@register("distinct_values", [], """
SELECT 'c_mktsegment' AS "column", c_mktsegment AS value FROM (SELECT DISTINCT c_mktsegment FROM customer) a
UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM (SELECT DISTINCT c_nationkey FROM customer) b""")
def q_distinct_values(spark, sf):
    c = table(spark, sf, "customer")
    a = c.select(F.lit("c_mktsegment").alias("column"), F.col("c_mktsegment").alias("value")).distinct()
    b = c.select(F.lit("c_nationkey").alias("column"), F.col("c_nationkey").cast("string").alias("value")).distinct()
    return a.unionByName(b)


@register("setop_class_equality", ["eda"], """
SELECT (SELECT count(*) FROM (SELECT DISTINCT target FROM eda EXCEPT SELECT * FROM (VALUES ('normal'), ('atencao'), ('urgente')) v(t))) = 0
   AND (SELECT count(*) FROM (SELECT * FROM (VALUES ('normal'), ('atencao'), ('urgente')) v(t) EXCEPT SELECT DISTINCT target FROM eda)) = 0
   AS classes_equal""")
def q_setop_class_equality(spark, sf):
    obs = eda(spark, sf).select("target").distinct()
    exp = spark.createDataFrame([(t,) for t in S.TARGET_ORDER], "target string")
    extra = obs.exceptAll(exp).agg(F.count(F.lit(1)).alias("n_extra"), F.lit(0).alias("_g"))
    missing = exp.exceptAll(obs).agg(F.count(F.lit(1)).alias("n_missing"), F.lit(0).alias("_g"))
    return extra.join(missing, "_g").select(((F.col("n_extra") == 0) & (F.col("n_missing") == 0)).alias("classes_equal"))


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("pivot_matrix", [], "SELECT o_orderstatus, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in _PRIOS) + " FROM orders GROUP BY 1")
def q_pivot_matrix(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy("o_orderstatus").pivot("o_orderpriority", _PRIOS).count().na.fill(0, _PRIOS)


@register("union_metric_frame", ["eda"], """
SELECT 'visits' AS metric, CAST(count(*) AS DOUBLE) AS value FROM eda
UNION ALL SELECT 'urgent_share', avg(CAST(target = 'urgente' AS INTEGER)) FROM eda
UNION ALL SELECT 'complaint_coverage', avg(CAST(RFV1_description IS NOT NULL AS INTEGER)) FROM eda""")
def q_union_metric_frame(spark, sf):
    """KPI cards: a few bounded aggregates stacked as (metric, value)."""
    v = eda(spark, sf)
    row = v.agg(F.count(F.lit(1)).cast("double").alias("visits"),
                F.avg((F.col("target") == "urgente").cast("int")).alias("urgent_share"),
                F.avg(F.col("RFV1_description").isNotNull().cast("int")).alias("complaint_coverage"))
    from vitalis.operators.evaluate import metrics_long
    return metrics_long(row)
