"""Sources, sinks, projections, filters and joins (inventory 2.1-2.3)."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis import schemas as S
from vitalis.functions import nulls as N
from vitalis.functions import text as X
from vitalis.operators import clean as C
from vitalis.operators import eda as E
from vitalis.plans.catalog.eda import eda
from vitalis.plans.catalog.learn import global_sql
from vitalis.plans.registry import register
from vitalis.session import checkpoint_dir, materialize, scratch
from vitalis.sources import files as FS
from vitalis.sources import fixtures as FX
from vitalis.sources import tables as TB


# --- 2.1 sources and sinks -------------------------------------------------

@register("src_csv_tables", [], """
SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey""")
def q_src_csv_tables(spark, sf):
    """Land nation/region as CSV, load both through the CSV loader with
    explicit schemas (no inference pass), join."""
    base = scratch(spark, "csv")
    for t in ("nation", "region"):
        TB.table(spark, sf, t).write.mode("overwrite").option("header", "true").csv(f"{base}/{t}")
    frames = TB.load_csv_tables(
        spark, base, {"nation": "nation", "region": "region"},
        schemas={"nation": T.StructType([T.StructField("n_nationkey", T.IntegerType()),
                                         T.StructField("n_name", T.StringType()),
                                         T.StructField("n_regionkey", T.IntegerType())]),
                 "region": T.StructType([T.StructField("r_regionkey", T.IntegerType()),
                                         T.StructField("r_name", T.StringType())])})
    n, r = frames["nation"], frames["region"]
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


@register("src_projected_scan", [], "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def q_src_projected_scan(spark, sf):
    return TB.projected_scan(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"])


@register("src_codebook", ["rfv_codebook"], "SELECT code, label FROM rfv_codebook WHERE code > 0")
def q_src_codebook(spark, sf):
    return FX.rfv_codebook(spark, sf).where(F.col("code") > 0)


@register("src_column_labels")
def q_src_column_labels(spark, sf):
    v = FX.visits(spark, sf)
    labelled = TB.table_with_metadata(v, {"IMMEDR": "Immediacy with which patient should be seen",
                                          "AGE": "Patient age in years", "SEX": "Patient sex"})
    return TB.column_labels(spark, labelled)


@register("src_fixed_width", [], """
SELECT 'P' || CAST(p_partkey % 1000 AS VARCHAR) AS code, arg_max(p_brand, p_partkey) AS description,
  count(*) AS n_lines, count(DISTINCT p_brand) > 1 AS conflicting
FROM part GROUP BY 1""")
def q_src_fixed_width(spark, sf):
    """Land a fixed-width reference file from ``part`` (code in columns 7-13,
    text from column 78; lines in order of the part's key, codes repeated),
    then parse it back."""
    path = scratch(spark, "fixed-width")
    lines = TB.table(spark, sf, "part").orderBy("p_partkey").select(F.format_string(
        "%-6s%-7s%-64s%s", F.lit("REF"), F.concat(F.lit("P"), (F.col("p_partkey") % 1000).cast("string")),
        F.lit(""), F.col("p_brand")).alias("value"))
    lines.write.mode("overwrite").text(path)
    return FS.fixed_width_reference(spark, path)


@register("src_table_read", [], "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def q_src_table_read(spark, sf):
    TB.table(spark, sf, "orders").createOrReplaceTempView("vitalis_orders")
    return TB.load_table(spark, "vitalis_orders", ["o_orderkey", "o_totalprice"], "o_orderstatus = 'F'")


@register("sink_table_write", [], "SELECT * FROM customer")
def q_sink_table_write(spark, sf):
    path = scratch(spark, "customer")
    TB.save_table(TB.table(spark, sf, "customer"), path, "replace", max_records_per_file=500)
    return spark.read.parquet(path)


@register("sink_readback_check", ["eda"], """
SELECT 'row_count' AS "check", true AS passed, CAST(count(*) AS VARCHAR) AS observed FROM eda
UNION ALL SELECT 'column_set', true, 'ADMIT,ADMITHOS,AGE,AGEDAYS,DIAG1_code,DIAG1_description,DIEDED,IMMEDR,OBSHOS,RFV1,RFV1_description,RFV2,RFV2_description,RFV3,RFV3_description,RFV4,RFV4_description,RFV5,RFV5_description,SEX,clinical_text,diastolic_bp,heart_rate,oxygen_saturation,pain_scale,respiratory_rate,sex_label,systolic_bp,target,temperature_f,visit_row'""")
def q_sink_readback_check(spark, sf):
    e = C.eda_table(FX.visits(spark, sf), FX.rfv_codebook(spark, sf), FX.sex_codebook(spark), FX.diag_ref(spark, sf))
    path = scratch(spark, "eda")
    TB.save_table(e, path)
    expected = e.count()
    return TB.readback_check(spark, path, expected, e.columns)


@register("sink_eda_artifact", ["eda_text"], """
SELECT visit_row, IMMEDR, target, AGE, AGEDAYS, SEX, sex_label, RFV1, RFV2, RFV3, RFV4, RFV5,
  RFV1_description, RFV2_description, RFV3_description, RFV4_description, RFV5_description,
  DIAG1_code, DIAG1_description, temperature_f, heart_rate, respiratory_rate, systolic_bp, diastolic_bp,
  oxygen_saturation, pain_scale, ADMITHOS, OBSHOS, ADMIT, DIEDED, clinical_text FROM eda_text""")
def q_sink_eda_artifact(spark, sf):
    e = C.eda_table(FX.visits(spark, sf), FX.rfv_codebook(spark, sf), FX.sex_codebook(spark), FX.diag_ref(spark, sf))
    path = scratch(spark, "eda-artifact")
    TB.save_table(e, path)
    back = spark.read.parquet(path)
    # Beside the artifact: what it holds and where it comes from.
    TB.save_table(back.groupBy("target").agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset_version", F.lit(S.DATASET_VERSION))
                  .withColumn("columns", F.lit(",".join(back.columns))), f"{path}-metadata")
    return back


@register("prj_column_contract", ["eda_text"], """
SELECT visit_row, IMMEDR, target, AGE, AGEDAYS, SEX, sex_label, RFV1, RFV2, RFV3, RFV4, RFV5,
  RFV1_description, RFV2_description, RFV3_description, RFV4_description, RFV5_description,
  DIAG1_code, DIAG1_description, temperature_f, heart_rate, respiratory_rate, systolic_bp, diastolic_bp,
  oxygen_saturation, pain_scale, ADMITHOS, OBSHOS, ADMIT, DIEDED, clinical_text FROM eda_text""")
def q_prj_column_contract(spark, sf):
    return C.eda_table(FX.visits(spark, sf), FX.rfv_codebook(spark, sf), FX.sex_codebook(spark), FX.diag_ref(spark, sf))


@register("sink_metadata", ["training"], """
SELECT * FROM (
  SELECT 'dataset_version' AS key, 'nhamcs-ed-2021-training-v1' AS value
  UNION ALL SELECT 'row_count', CAST(count(*) AS VARCHAR) FROM training
  UNION ALL SELECT 'class_counts', '{' || string_agg('"' || target || '": ' || CAST(n AS VARCHAR), ', ' ORDER BY target) || '}'
            FROM (SELECT target, count(*) AS n FROM training GROUP BY target) c
  UNION ALL SELECT 'split_counts', '{' || string_agg('"' || split || '": ' || CAST(n AS VARCHAR), ', ' ORDER BY split) || '}'
            FROM (SELECT split, count(*) AS n FROM training GROUP BY split) s
  UNION ALL SELECT 'split_strategy', 'stratified group quota split: 70/15/15 by text_hash'
  UNION ALL SELECT 'source_checksum', CAST(sum(CAST('0x' || substr(md5(o_orderkey || '|' || o_custkey), 1, 7) AS BIGINT)) AS VARCHAR) FROM orders
  UNION ALL SELECT 'random_state', '42') m""")
def q_sink_metadata(spark, sf):
    from vitalis.plans.training_table import training_table
    from vitalis.operators.gates import content_checksum, metadata_table
    source = content_checksum(TB.table(spark, sf, "orders"), ["o_orderkey", "o_custkey"])
    return metadata_table(training_table(spark, sf), checksum=source)


@register("sink_json_report", ["scored"], f"SELECT *, '{S.DATASET_VERSION}' AS dataset_version FROM ({global_sql('scored')}) m")
def q_sink_json_report(spark, sf):
    """Nested one-row run report to JSON and back with an explicit schema;
    the report's fields as columns."""
    from vitalis.operators.evaluate import global_metrics
    m = global_metrics(FX.scored(spark, sf), "y_true", "y_pred")
    report = m.select(F.struct(*[F.col(c) for c in m.columns]).alias("metrics"),
                      F.lit(S.DATASET_VERSION).alias("dataset_version"))
    path = scratch(spark, "report")
    report.coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema(report.schema).json(path).select("metrics.*", "dataset_version")


def source_manifest(spark, sf):
    """The manifest of the files under ``sf``, of this application's first read."""
    key = hashlib.sha256(f"{sf.rstrip('/')}|{spark.sparkContext.applicationId}".encode()).hexdigest()[:24]
    return FS.landed_manifest(spark, sf, f"{checkpoint_dir(spark).rstrip('/')}/vitalis-manifest-{key}", "*.parquet")


@register("src_file_checksum")
def q_src_file_checksum(spark, sf):
    """Digests of the landed files, read block by block, against the manifest
    that was stored when they were first seen."""
    return FS.verify_checksums(FS.file_checksums(spark, sf, "*.parquet"), source_manifest(spark, sf))


@register("fn_text_sha256", [], "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def q_fn_text_sha256(spark, sf):
    return TB.table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


# --- 2.2 projections and filters -------------------------------------------

@register("prj_required_columns")
def q_prj_required_columns(spark, sf):
    v = FX.visits(spark, sf)
    req = list(S.SOURCE_COLUMNS) + ["MISSING_COLUMN"]
    rows = [(c, c in v.columns) for c in sorted(req)]
    return spark.createDataFrame(rows, "column string, present boolean")


@register("prj_code_label", ["visits", "rfv_codebook"], """
SELECT v.visit_row, v.RFV1, c.label AS RFV1_description FROM visits v
LEFT JOIN rfv_codebook c ON c.code = v.RFV1 AND v.RFV1 > 0""")
def q_prj_code_label(spark, sf):
    return C.decode(FX.visits(spark, sf).select("visit_row", "RFV1"), FX.rfv_codebook(spark, sf),
                    "RFV1", "RFV1_description")


@register("prj_sentinel_null", ["visits"], "SELECT visit_row, " + ", ".join(
    f"CASE WHEN {r.source} NOT IN ({', '.join(map(str, r.sentinels))}) THEN {r.source} END AS {r.source}"
    for r in S.VITAL_RULES) + " FROM visits")
def q_prj_sentinel_null(spark, sf):
    v = FX.visits(spark, sf)
    return v.select("visit_row", *[N.sentinel_null(r.source, r.sentinels).alias(r.source) for r in S.VITAL_RULES])


@register("prj_domain_null", ["visits"], "SELECT visit_row, " + ", ".join(
    f"CASE WHEN {r.source} NOT IN ({', '.join(map(str, r.sentinels))}) AND {r.source} BETWEEN {r.lower} AND {r.upper} "
    f"THEN {r.source} END AS {r.source}" for r in S.VITAL_RULES) + " FROM visits")
def q_prj_domain_null(spark, sf):
    v = FX.visits(spark, sf)
    return v.select("visit_row", *[N.domain_null(N.sentinel_null(r.source, r.sentinels), r.lower, r.upper)
                                   .alias(r.source) for r in S.VITAL_RULES])


@register("prj_scale", ["eda"], "SELECT visit_row, " + ", ".join(r.clean for r in S.VITAL_RULES) + " FROM eda")
def q_prj_scale(spark, sf):
    return C.clean_vitals(C.eligible(FX.visits(spark, sf)), policy="null").select(
        "visit_row", *[r.clean for r in S.VITAL_RULES])


@register("flt_any_notnull", ["eda"], "SELECT visit_row FROM eda WHERE " + " OR ".join(
    [f"RFV{i}_description IS NOT NULL" for i in range(1, 6)] + [f"{r.clean} IS NOT NULL" for r in S.VITAL_RULES]))
def q_flt_any_notnull(spark, sf):
    e = eda(spark, sf)
    return e.where(N.any_not_null([f"{c}_description" for c in S.RFV_COLUMNS] + [r.clean for r in S.VITAL_RULES])) \
            .select("visit_row")


@register("flt_dropna_subset", ["eda"], """
SELECT visit_row, RFV1_description, coalesce(DIAG1_description, DIAG1_code) AS primary_diagnosis FROM eda
WHERE RFV1_description IS NOT NULL AND coalesce(DIAG1_description, DIAG1_code) IS NOT NULL""")
def q_flt_dropna_subset(spark, sf):
    e = eda(spark, sf).select("visit_row", "RFV1_description", E.primary_diagnosis().alias("primary_diagnosis"))
    return e.dropna(subset=["RFV1_description", "primary_diagnosis"])


@register("prj_fill_coalesce", ["eda"], """
SELECT visit_row, coalesce(DIAG1_description, DIAG1_code) AS primary_diagnosis,
  coalesce(RFV2_description, '') AS RFV2_filled FROM eda""")
def q_prj_fill_coalesce(spark, sf):
    e = eda(spark, sf)
    return e.select("visit_row", E.primary_diagnosis().alias("primary_diagnosis"),
                    F.coalesce("RFV2_description", F.lit("")).alias("RFV2_filled"))


@register("prj_positive_or_null", ["visits"], """
SELECT visit_row, CASE WHEN RFV1 > 0 THEN RFV1 END AS RFV1, CASE WHEN RFV3 > 0 THEN RFV3 END AS RFV3 FROM visits""")
def q_prj_positive_or_null(spark, sf):
    v = FX.visits(spark, sf)
    return v.select("visit_row", N.positive_or_null("RFV1").alias("RFV1"), N.positive_or_null("RFV3").alias("RFV3"))


@register("prj_outcome_flags", ["visits"], """
SELECT visit_row, (ADMITHOS = 1 OR OBSHOS = 1) AS hospital_admission, ADMIT = 1 AS critical_care_admission,
  DIEDED = 1 AS died_in_ed FROM visits""")
def q_prj_outcome_flags(spark, sf):
    return C.outcome_flags(FX.visits(spark, sf)).select(
        "visit_row", "hospital_admission", "critical_care_admission", "died_in_ed")


@register("prj_category_order", ["eda"], """
SELECT DISTINCT target, CASE target WHEN 'normal' THEN 1 WHEN 'atencao' THEN 2 WHEN 'urgente' THEN 3 END AS class_order
FROM eda""")
def q_prj_category_order(spark, sf):
    return eda(spark, sf).select("target", C.target_ordinal("target").alias("class_order")).distinct()


@register("flt_split", ["training"], "SELECT record_id, target FROM training WHERE split = 'validation'")
def q_flt_split(spark, sf):
    from vitalis.plans.training_table import training_table
    return training_table(spark, sf).where(F.col("split") == "validation").select("record_id", "target")


@register("flt_allowed_features")
def q_flt_allowed_features(spark, sf):
    from vitalis.operators.gates import allowed_features
    v = FX.visits(spark, sf)
    return allowed_features(v, S.TRIAGE_FEATURE_COLUMNS, S.POST_TRIAGE_COLUMNS)


@register("flt_request_valid", [], """
SELECT doc_id, length(trim(text)) BETWEEN 1 AND 5000 AS valid,
  CASE WHEN length(trim(text)) = 0 THEN 'empty' WHEN length(trim(text)) > 5000 THEN 'too_long' END AS reason
FROM documents""")
def q_flt_request_valid(spark, sf):
    from vitalis.operators.score import request_validity
    d = TB.table(spark, sf, "documents").select("doc_id", "text")
    return request_validity(d, "text").select("doc_id", "valid", "reason")


# --- 2.3 joins ----------------------------------------------------------------

@register("join_codebook_multi", ["eda"], "SELECT visit_row, " + ", ".join(
    f"RFV{i}_description" for i in range(1, 6)) + " FROM eda")
def q_join_codebook_multi(spark, sf):
    v = C.eligible(FX.visits(spark, sf)).select("visit_row", *S.RFV_COLUMNS)
    return C.decode_complaints(v, FX.rfv_codebook(spark, sf)).select(
        "visit_row", *[f"{c}_description" for c in S.RFV_COLUMNS])


@register("join_small_dim", [], """
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def q_join_small_dim(spark, sf):
    c = TB.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = TB.table(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    return C.decode(c, n, "c_nationkey", "n_name", positive_only=False).select("c_custkey", "c_name", "n_name")


@register("join_sex_label", ["eda"], "SELECT visit_row, sex_label FROM eda")
def q_join_sex_label(spark, sf):
    v = C.eligible(FX.visits(spark, sf)).select("visit_row", "SEX")
    return C.decode(v, FX.sex_codebook(spark), "SEX", "sex_label", positive_only=False).select("visit_row", "sex_label")


@register("join_diagnosis_ref", ["eda"], """
SELECT visit_row, DIAG1_code, DIAG1_description, coalesce(DIAG1_description, DIAG1_code) AS primary_diagnosis FROM eda""")
def q_join_diagnosis_ref(spark, sf):
    return eda(spark, sf).select("visit_row", "DIAG1_code", "DIAG1_description",
                                 E.primary_diagnosis().alias("primary_diagnosis"))


@register("anti_unmapped_codes", ["visits", "rfv_codebook"], """
SELECT slot, count(*) AS unmapped FROM (
  SELECT 'RFV1' AS slot, RFV1 AS code FROM visits UNION ALL SELECT 'RFV2', RFV2 FROM visits
  UNION ALL SELECT 'RFV3', RFV3 FROM visits UNION ALL SELECT 'RFV4', RFV4 FROM visits
  UNION ALL SELECT 'RFV5', RFV5 FROM visits) l
WHERE code > 0 AND code NOT IN (SELECT code FROM rfv_codebook WHERE code > 0) GROUP BY slot""")
def q_anti_unmapped_codes(spark, sf):
    v = FX.visits(spark, sf)
    long = v.unpivot(["visit_row"], list(S.RFV_COLUMNS), "slot", "code").where(F.col("code") > 0)
    cb = FX.rfv_codebook(spark, sf).where(F.col("code") > 0).select("code")
    return long.join(cb, "code", "left_anti").groupBy("slot").agg(F.count(F.lit(1)).alias("unmapped"))


@register("anti_domain_membership", ["visits", "sex_codebook"], """
SELECT 'SEX' AS field, SEX AS code FROM (SELECT DISTINCT SEX FROM visits) s
WHERE SEX NOT IN (SELECT code FROM sex_codebook)
UNION ALL SELECT 'IMMEDR', IMMEDR FROM (SELECT DISTINCT IMMEDR FROM visits) i WHERE IMMEDR NOT IN (1,2,3,4,5)""")
def q_anti_domain_membership(spark, sf):
    v = FX.visits(spark, sf)
    sx = v.select(F.col("SEX").alias("code")).distinct().join(FX.sex_codebook(spark).select("code"), "code", "left_anti")
    dom = spark.createDataFrame([(k,) for k in S.TARGET_MAP], "code int")
    im = v.select(F.col("IMMEDR").alias("code")).distinct().join(F.broadcast(dom), "code", "left_anti")
    return sx.select(F.lit("SEX").alias("field"), "code").unionByName(im.select(F.lit("IMMEDR").alias("field"), "code"))


@register("semi_label_filter", [], """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def q_semi_label_filter(spark, sf):
    o = TB.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    keep = spark.createDataFrame([("1-URGENT",), ("2-HIGH",)], "o_orderpriority string")
    return o.join(F.broadcast(keep), "o_orderpriority", "left_semi")


@register("join_prediction_truth", ["scored"], """
SELECT s.doc_id, s.y_true, p.y_pred, s.y_true = p.y_pred AS correct FROM
(SELECT doc_id, y_true FROM scored) s JOIN (SELECT doc_id, y_pred FROM scored) p ON p.doc_id = s.doc_id""")
def q_join_prediction_truth(spark, sf):
    sc = FX.scored(spark, sf)
    truth, pred = sc.select("doc_id", "y_true"), sc.select("doc_id", "y_pred")
    return truth.join(pred, "doc_id").select("doc_id", "y_true", "y_pred",
                                             (F.col("y_true") == F.col("y_pred")).alias("correct"))


@register("join_model_agreement", ["scored"], """
SELECT round(avg(CASE WHEN a.y_pred IS NOT DISTINCT FROM b.y_pred2 THEN 1 ELSE 0 END), 6) AS agreement,
  count(*) AS rows
FROM scored a JOIN (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 1 - y_true ELSE y_true END AS y_pred2 FROM scored) b
ON a.doc_id = b.doc_id""")
def q_join_model_agreement(spark, sf):
    sc = FX.scored(spark, sf)
    other = sc.select("doc_id", F.when(F.col("doc_id") % 7 == 0, 1 - F.col("y_true"))
                      .otherwise(F.col("y_true")).alias("y_pred2"))
    j = sc.select("doc_id", "y_pred").join(other, "doc_id")
    return j.agg(F.round(F.avg(F.col("y_pred").eqNullSafe(F.col("y_pred2")).cast("int")), 6).alias("agreement"),
                 F.count(F.lit(1)).alias("rows"))


@register("self_group_isolation", [], """
SELECT sha256(text) AS text_hash, count(*) AS rows, count(DISTINCT source) AS n_sources, count(DISTINCT lang) AS n_langs
FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1 OR count(DISTINCT lang) > 1""")
def q_self_group_isolation(spark, sf):
    d = TB.table(spark, sf, "documents").select(F.sha2("text", 256).alias("text_hash"), "source", "lang")
    g = d.groupBy("text_hash").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("source").alias("n_sources"),
                                   F.countDistinct("lang").alias("n_langs"))
    return g.where((F.col("n_sources") > 1) | (F.col("n_langs") > 1))
