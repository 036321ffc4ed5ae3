"""Data-quality gates (2.8) and report tables (2.14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.functions import nulls as N
from vitalis.functions import text as X
from vitalis.operators import clean as C
from vitalis.operators import gates as G
from vitalis.operators import profile as P
from vitalis.plans.catalog.io_joins import source_manifest
from vitalis.plans.registry import register
from vitalis.plans.training_table import training_table
from vitalis.session import scratch
from vitalis.sources import files as FS
from vitalis.sources import fixtures as FX
from vitalis.sources.tables import table

VERSION = S.DATASET_VERSION


@register("dq_training_contract", ["training"], f"""
WITH g AS (SELECT max(ns) AS ms, max(nt) AS mt FROM (SELECT text_hash, count(DISTINCT split) AS ns,
             count(DISTINCT target) AS nt FROM training GROUP BY text_hash) x),
a AS (SELECT count(*) > 0 AS not_empty,
        coalesce(bool_and(record_id IS NOT NULL AND clinical_text IS NOT NULL AND target IS NOT NULL
          AND text_hash IS NOT NULL AND split IS NOT NULL AND dataset_version IS NOT NULL), true) AS no_nulls,
        count(*) = count(DISTINCT record_id) AS record_id_unique,
        list_sort(list(DISTINCT target)) = ['atencao', 'normal', 'urgente'] AS classes_valid,
        list_sort(list(DISTINCT split)) = ['test', 'train', 'validation'] AS splits_valid,
        coalesce(bool_and(dataset_version = '{VERSION}'), false) AS version_valid,
        coalesce(bool_and(trim(clinical_text) <> ''), false) AS text_not_blank,
        coalesce(bool_and(text_hash = sha256(replace(lower(clinical_text), 'ß', 'ss'))), false) AS text_hash_valid
      FROM training)
SELECT 'schema_valid' AS "check", true AS passed
UNION ALL SELECT 'not_empty', not_empty FROM a UNION ALL SELECT 'no_nulls', no_nulls FROM a
UNION ALL SELECT 'record_id_unique', record_id_unique FROM a UNION ALL SELECT 'classes_valid', classes_valid FROM a
UNION ALL SELECT 'splits_valid', splits_valid FROM a UNION ALL SELECT 'version_valid', version_valid FROM a
UNION ALL SELECT 'text_not_blank', text_not_blank FROM a UNION ALL SELECT 'text_hash_valid', text_hash_valid FROM a
UNION ALL SELECT 'text_in_one_split', coalesce(ms, 0) <= 1 FROM g
UNION ALL SELECT 'text_one_target', coalesce(mt, 0) <= 1 FROM g""")
def q_dq_training_contract(spark, sf):
    return G.training_contract(training_table(spark, sf))


@register("dq_text_hash_valid", ["training"], """
SELECT count(*) AS rows_checked,
  coalesce(bool_and(text_hash = sha256(replace(lower(clinical_text), 'ß', 'ss'))), true) AS passed FROM training""")
def q_dq_text_hash_valid(spark, sf):
    t = training_table(spark, sf)
    return t.agg(F.count(F.lit(1)).alias("rows_checked"),
                 F.coalesce(F.bool_and(F.col("text_hash") == X.text_hash("clinical_text")), F.lit(True)).alias("passed"))


_EXPECTED_SQL = """
WITH e AS (SELECT CASE WHEN IMMEDR IN (1,2) THEN 'urgente' WHEN IMMEDR = 3 THEN 'atencao' ELSE 'normal' END AS target
           FROM visits WHERE IMMEDR IN (1,2,3,4,5)),
ex AS (SELECT 'rows' AS "check", '' AS key, count(*) AS expected FROM e
       UNION ALL SELECT 'class', target, count(*) FROM e GROUP BY target),
ob AS (SELECT 'rows' AS "check", '' AS key, count(*) AS observed FROM training
       UNION ALL SELECT 'unique_texts', '', count(DISTINCT text_hash) FROM training
       UNION ALL SELECT 'class', target, count(*) FROM training GROUP BY target
       UNION ALL SELECT 'split', split, count(*) FROM training GROUP BY split)
SELECT coalesce(ob."check", ex."check") AS "check", coalesce(ob.key, ex.key) AS key, observed, expected,
  expected IS NULL OR observed IS NOT DISTINCT FROM expected AS passed
FROM ob FULL OUTER JOIN ex ON ob."check" = ex."check" AND ob.key = ex.key"""


def _expected_frame(spark, sf):
    """Expected rows and class counts of the eligible cohort from one
    grouped pass (the row total is the sum of the class counts)."""
    e = C.eligible(FX.visits(spark, sf)).select(C.target_expr().alias("target"))
    by_class = e.groupBy("target").agg(F.count(F.lit(1)).alias("expected"))
    rows = by_class.agg(F.coalesce(F.sum("expected"), F.lit(0)).alias("expected")).select(
        F.lit("rows").alias("check"), F.lit("").alias("key"), "expected")
    cls = by_class.select(F.lit("class").alias("check"), F.col("target").alias("key"), "expected")
    return rows.unionByName(cls)


@register("dq_expected_counts", ["training", "visits"], _EXPECTED_SQL)
def q_dq_expected_counts(spark, sf):
    """Observed rows, classes, splits and distinct texts of the training table
    against what is expected of them: here the rows and classes of the
    eligible cohort, counted on the source; the others have no expectation."""
    e = {(r["check"], r["key"]): r["expected"] for r in _expected_frame(spark, sf).collect()}  # one row per class
    return G.expected_counts(training_table(spark, sf), rows=e[("rows", "")],
                             classes={k: n for (check, k), n in e.items() if check == "class"})


_DEMO_SQL = """
SELECT 'AGE within 0..93' AS "check", bool_and(AGE BETWEEN 0 AND 93) AS valid FROM visits
UNION ALL SELECT 'AGE and AGEDAYS consistent',
  count(*) FILTER (WHERE AGE = 0 AND AGEDAYS BETWEEN 0 AND 365) + count(*) FILTER (WHERE AGE >= 1 AND AGEDAYS = -7)
  = count(*) FROM visits
UNION ALL SELECT 'SEX within official domain', bool_and(SEX IN (1, 2)) FROM visits"""


def _demographics(v):
    row = v.agg(
        F.coalesce(F.bool_and(F.col("AGE").between(0, 93)), F.lit(True)).alias("AGE within 0..93"),
        ((F.count_if((F.col("AGE") == 0) & F.col("AGEDAYS").between(0, 365))
          + F.count_if((F.col("AGE") >= 1) & (F.col("AGEDAYS") == -7))) == F.count(F.lit(1)))
        .alias("AGE and AGEDAYS consistent"),
        F.coalesce(F.bool_and(F.col("SEX").isin(1, 2)), F.lit(True)).alias("SEX within official domain"))
    return G.checks_long(row, row.columns).withColumnRenamed("passed", "valid")


@register("dq_demographics", ["visits"], _DEMO_SQL)
def q_dq_demographics(spark, sf):
    return _demographics(FX.visits(spark, sf))


_SOURCE_SQL = """
WITH rf AS (SELECT * FROM visits),
el AS (SELECT * FROM rf WHERE IMMEDR IN (1,2,3,4,5)),
d AS (SELECT bool_and(AGE BETWEEN 0 AND 93)
        AND count(*) FILTER (WHERE AGE = 0 AND AGEDAYS BETWEEN 0 AND 365)
          + count(*) FILTER (WHERE AGE >= 1 AND AGEDAYS = -7) = count(*)
        AND bool_and(SEX IN (1, 2)) AS ok FROM rf),
u AS (SELECT count(*) AS un FROM (
        SELECT RFV1 AS code FROM rf UNION ALL SELECT RFV2 FROM rf UNION ALL SELECT RFV3 FROM rf
        UNION ALL SELECT RFV4 FROM rf UNION ALL SELECT RFV5 FROM rf) l
      WHERE code > 0 AND code NOT IN (SELECT code FROM rfv_codebook)),
cov AS (SELECT count(*) FILTER (WHERE RFV1 > 0) AS k, count(*) AS n FROM el),
vi AS (SELECT """ + " + ".join(
    f"count(*) FILTER (WHERE {r.source} NOT IN ({', '.join(map(str, r.sentinels))}) AND NOT ({r.source} BETWEEN {r.lower} AND {r.upper}))"
    for r in S.VITAL_RULES) + """ AS bad FROM rf),
k AS (SELECT count(*) AS n, count(DISTINCT visit_row) AS nd, count(*) FILTER (WHERE visit_row IS NULL) AS miss FROM rf)
SELECT 'Required schema' AS gate, true AS passed, '16 required columns' AS observed
UNION ALL SELECT 'Unique visit rows', n = nd AND miss = 0, CAST(n - nd + miss AS VARCHAR) FROM k
UNION ALL SELECT 'Source target domain', bool_and(IMMEDR IN (-9, -8, 0, 1, 2, 3, 4, 5, 7)),
  CAST(count(DISTINCT IMMEDR) AS VARCHAR) FROM rf
UNION ALL SELECT 'Eligible modeling cohort', count(*) > 0, CAST(count(*) AS VARCHAR) FROM el
UNION ALL SELECT 'Three target classes', count(DISTINCT CASE WHEN IMMEDR IN (1,2) THEN 'u' WHEN IMMEDR = 3 THEN 'a' ELSE 'n' END) = 3,
  CAST(count(DISTINCT CASE WHEN IMMEDR IN (1,2) THEN 'u' WHEN IMMEDR = 3 THEN 'a' ELSE 'n' END) AS VARCHAR) FROM el
UNION ALL SELECT 'Demographic domains', ok, CASE WHEN ok THEN 'valid' ELSE 'invalid' END FROM d
UNION ALL SELECT 'RFV mapping and primary coverage', un = 0 AND k >= 0.95 * n,
  CAST(CAST(floor(10000 * k / n) AS BIGINT) AS VARCHAR) FROM u, cov
UNION ALL SELECT 'Vital representation domains', bad = 0, CAST(bad AS VARCHAR) FROM vi
UNION ALL SELECT 'Source file checksums', true, 'valid'
UNION ALL SELECT 'Raw shape', count(*) > 0, CAST(count(*) AS VARCHAR) || ' rows' FROM rf
UNION ALL SELECT 'Persisted cohort', true, CAST(count(*) AS VARCHAR) || ' rows' FROM el
UNION ALL SELECT 'Temporal leakage contract', true, 'No overlap'"""


@register("dq_source_gates", ["visits", "rfv_codebook"], _SOURCE_SQL)
def q_dq_source_gates(spark, sf):
    """Source gates as (gate, passed, observed) rows from three passes over
    the visits instead of one per gate: (1) every row-level count grouped
    by the triage code (map-side partial aggregation leaves one row per
    code, so the gates are derived from a table the size of the code
    domain), (2) key uniqueness grouped by ``visit_row`` (only the key is
    shuffled), (3) unmapped complaint codes via an anti join with the code
    book."""
    v = FX.visits(spark, sf)
    immedr = F.col("IMMEDR")
    age, days = F.col("AGE"), F.col("AGEDAYS")
    bad_vitals = sum((F.count_if(N.is_usable(r.source, r.sentinels) & ~N.in_domain(r.source, r.lower, r.upper))
                      for r in S.VITAL_RULES[1:]),
                     F.count_if(N.is_usable(S.VITAL_RULES[0].source, S.VITAL_RULES[0].sentinels)
                                & ~N.in_domain(S.VITAL_RULES[0].source, S.VITAL_RULES[0].lower,
                                               S.VITAL_RULES[0].upper)))
    per_code = v.groupBy("IMMEDR").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~age.between(0, 93)).alias("age_bad"),
        (F.count_if((age == 0) & days.between(0, 365)) + F.count_if((age >= 1) & (days == -7))).alias("age_ok"),
        F.count_if(~F.col("SEX").isin(1, 2)).alias("sex_bad"),
        bad_vitals.alias("bad"),
        F.count_if(F.col("RFV1") > 0).alias("rfv1"))
    eligible = immedr.isin(list(S.TARGET_MAP))
    row = per_code.agg(
        F.coalesce(F.bool_and(immedr.isin(-9, -8, 0, 1, 2, 3, 4, 5, 7)), F.lit(True)).alias("dom_ok"),
        F.count(immedr).alias("codes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(eligible, F.col("n"))), F.lit(0)).alias("el_n"),
        F.coalesce(F.sum(F.when(eligible, F.col("rfv1"))), F.lit(0)).alias("el_k"),
        F.countDistinct(F.when(eligible, C.target_expr())).alias("classes"),
        ((F.sum("age_bad") == 0) & (F.sum("age_ok") == F.sum("n")) & (F.sum("sex_bad") == 0)).alias("demo_ok"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
        F.lit(0).alias("_g"))
    keys = (v.groupBy("visit_row").agg(F.count(F.lit(1)).alias("c"))
              .agg(F.coalesce(F.sum(F.when(F.col("visit_row").isNotNull(), F.col("c") - 1)), F.lit(0)).alias("dup"),
                   F.coalesce(F.sum(F.when(F.col("visit_row").isNull(), F.col("c"))), F.lit(0)).alias("miss"),
                   F.lit(0).alias("_g")))
    long = v.unpivot(["visit_row"], list(S.RFV_COLUMNS), "slot", "code").where(F.col("code") > 0)
    un = long.join(FX.rfv_codebook(spark, sf).select("code"), "code", "left_anti").agg(
        F.count(F.lit(1)).alias("un"), F.lit(0).alias("_g"))
    j = row.join(keys, "_g").join(un, "_g")
    # observed for uniqueness: rows - distinct non-null keys + missing keys
    not_unique = F.col("dup") + 2 * F.col("miss")
    gates = [
        ("Unique visit rows", (F.col("dup") == 0) & (F.col("miss") == 0), not_unique.cast("string")),
        ("Source target domain", F.col("dom_ok"), F.col("codes").cast("string")),
        ("Eligible modeling cohort", F.col("el_n") > 0, F.col("el_n").cast("string")),
        ("Three target classes", F.col("classes") == 3, F.col("classes").cast("string")),
        ("Demographic domains", F.col("demo_ok"), F.when(F.col("demo_ok"), "valid").otherwise("invalid")),
        ("RFV mapping and primary coverage",
         (F.col("un") == 0) & (F.col("el_k") >= S.GATE_MIN_PRIMARY_COVERAGE * F.col("el_n")),
         F.floor(10000 * F.col("el_k") / F.col("el_n")).cast("bigint").cast("string")),
        ("Vital representation domains", F.col("bad") == 0, F.col("bad").cast("string")),
    ]
    # The landed files against the manifest of their first read; the cohort as
    # written and read back.
    cohort = scratch(spark, "gate-cohort")
    files_ok = FS.verify_checksums(FS.file_checksums(spark, sf, "*.parquet"), source_manifest(spark, sf)).agg(
        F.coalesce(F.bool_and("valid"), F.lit(False))).first()[0]
    C.eligible(v).select("visit_row", "IMMEDR").write.parquet(cohort)
    persisted = spark.read.parquet(cohort).count()
    gates += [
        ("Source file checksums", F.lit(files_ok), F.lit("valid" if files_ok else "changed")),
        ("Raw shape", F.col("n_rows") > 0, F.concat(F.col("n_rows").cast("string"), F.lit(" rows"))),
        ("Persisted cohort", F.col("el_n") == persisted, F.lit(f"{persisted} rows")),
    ]
    rows = j.select(F.explode(F.array(*[
        F.struct(F.lit(g).alias("gate"), p.alias("passed"), o.alias("observed")) for g, p, o in gates])).alias("r"))
    fixed = spark.createDataFrame([("Required schema", set(S.SOURCE_COLUMNS) <= set(v.columns), "16 required columns"),
                                   ("Temporal leakage contract",
                                    not (set(S.TRIAGE_FEATURE_COLUMNS) & set(S.POST_TRIAGE_COLUMNS)), "No overlap")],
                                  "gate string, passed boolean, observed string")
    return fixed.unionByName(rows.select("r.gate", "r.passed", "r.observed"))


@register("dq_source_gates_status", ["visits", "rfv_codebook"],
          "SELECT gate, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + _SOURCE_SQL + ") g")
def q_dq_source_gates_status(spark, sf):
    """``fn_bucket_target_status`` over the source gates."""
    return q_dq_source_gates(spark, sf).select("gate", X.status("passed").alias("status"))


_READY_SQL = f"""
WITH e AS (SELECT CASE WHEN IMMEDR IN (1,2) THEN 'urgente' WHEN IMMEDR = 3 THEN 'atencao' ELSE 'normal' END AS target
           FROM visits WHERE IMMEDR IN (1,2,3,4,5)),
ec AS (SELECT target, count(*) AS n FROM e GROUP BY target),
tc AS (SELECT target, count(*) AS n FROM training GROUP BY target),
g AS (SELECT max(ns) AS ms, max(nt) AS mt FROM (SELECT text_hash, count(DISTINCT split) AS ns,
        count(DISTINCT target) AS nt FROM training GROUP BY text_hash) x),
st AS (SELECT split, target, count(*) AS c FROM training GROUP BY split, target),
dr AS (SELECT max(abs(sr - gr)) * 100 AS drift FROM (SELECT target, c / sum(c) OVER (PARTITION BY split) AS sr FROM st) st2
       JOIN (SELECT target, count(*) / (SELECT count(*) FROM training) AS gr FROM training GROUP BY target) gg USING (target)),
a AS (SELECT count(*) AS n, count(*) = count(DISTINCT record_id) AS uniq,
        coalesce(bool_and(record_id IS NOT NULL AND clinical_text IS NOT NULL AND target IS NOT NULL
          AND text_hash IS NOT NULL AND split IS NOT NULL AND dataset_version IS NOT NULL), true) AS no_nulls,
        count(DISTINCT dataset_version) = 1 AND bool_and(dataset_version = '{VERSION}') AS version_fixed,
        count(DISTINCT text_hash) AS texts FROM training)
SELECT 'schema' AS "check", true AS passed
UNION ALL SELECT 'volume', n = (SELECT count(*) FROM e) FROM a
UNION ALL SELECT 'no_nulls', no_nulls FROM a
UNION ALL SELECT 'record_id_unique', uniq FROM a
UNION ALL SELECT 'class_counts', (SELECT count(*) FROM ec FULL OUTER JOIN tc USING (target)
                                  WHERE ec.n IS DISTINCT FROM tc.n) = 0
UNION ALL SELECT 'unique_texts', texts > 0 FROM a
UNION ALL SELECT 'no_target_conflict', coalesce(mt, 0) <= 1 FROM g
UNION ALL SELECT 'no_split_leakage', coalesce(ms, 0) <= 1 FROM g
UNION ALL SELECT 'classes_in_all_splits', (SELECT count(*) FROM st WHERE c > 0) = 9
UNION ALL SELECT 'drift_within_0_5_points', drift <= 0.5 FROM dr
UNION ALL SELECT 'version_fixed', version_fixed FROM a"""


@register("dq_readiness", ["training", "visits"], _READY_SQL)
def q_dq_readiness(spark, sf):
    """11 readiness checks composed from the profile queries; expected
    volumes come from the source cohort (official counts are arguments
    that do not apply to these fixtures)."""
    t = training_table(spark, sf)
    exp = _expected_frame(spark, sf)
    audit = P.split_audit(t, digits=None)
    any_null = F.lit(False)
    for c in S.TRAINING_COLUMNS:
        any_null = any_null | F.col(c).isNull()
    a = t.agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) == F.countDistinct("record_id")).alias("uniq"),
              F.coalesce(~F.bool_or(any_null), F.lit(True)).alias("no_nulls"),
              ((F.countDistinct("dataset_version") == 1) & F.bool_and(F.col("dataset_version") == VERSION))
              .alias("version_fixed"), F.countDistinct("text_hash").alias("texts"), F.lit(0).alias("_g"))
    erows = exp.where(F.col("check") == "rows").select(F.col("expected").alias("_en"), F.lit(0).alias("_g"))
    # One (split, class) count table feeds the class totals and the cell count.
    st = t.groupBy("split", "target").agg(F.count(F.lit(1)).alias("c"))
    tc = st.groupBy("target").agg(F.sum("c").alias("n"))
    ec = exp.where(F.col("check") == "class").select(F.col("key").alias("target"), F.col("expected").alias("e"))
    mism = tc.join(ec, "target", "full_outer").agg(
        F.count_if(~F.col("n").eqNullSafe(F.col("e"))).alias("_mm"), F.lit(0).alias("_g"))
    cells = st.agg(F.count(F.lit(1)).alias("_cells"), F.lit(0).alias("_g"))
    j = (a.join(erows, "_g").join(mism, "_g").join(cells, "_g")
          .join(audit.withColumn("_g", F.lit(0)), "_g"))
    row = j.select(
        F.lit(True).alias("schema"), (F.col("n") == F.col("_en")).alias("volume"), "no_nulls",
        F.col("uniq").alias("record_id_unique"), (F.col("_mm") == 0).alias("class_counts"),
        (F.col("texts") > 0).alias("unique_texts"), (F.col("conflicting_groups") == 0).alias("no_target_conflict"),
        (F.col("crossing_groups") == 0).alias("no_split_leakage"), (F.col("_cells") == 9).alias("classes_in_all_splits"),
        (F.col("max_drift_points") <= 0.5).alias("drift_within_0_5_points"), "version_fixed")
    return G.checks_long(row, row.columns)


@register("dq_fit_precondition", ["training"], f"""
WITH a AS (SELECT count(*) > 0 AS not_empty,
             coalesce(bool_and(clinical_text IS NOT NULL AND target IS NOT NULL AND split IS NOT NULL
               AND dataset_version IS NOT NULL), true) AS no_nulls,
             count(DISTINCT dataset_version) = 1 AS one_version,
             count(DISTINCT target) FILTER (WHERE split = 'train') = 3 AS train_all_classes,
             count(DISTINCT target) FILTER (WHERE split = 'validation') = 3 AS validation_all_classes
           FROM training WHERE split IN ('train', 'validation'))
SELECT 'not_empty' AS "check", not_empty AS passed FROM a UNION ALL SELECT 'no_nulls', no_nulls FROM a
UNION ALL SELECT 'one_version', one_version FROM a UNION ALL SELECT 'train_all_classes', train_all_classes FROM a
UNION ALL SELECT 'validation_all_classes', validation_all_classes FROM a""")
def q_dq_fit_precondition(spark, sf):
    """Checked before any fit: only the train and validation rows are read
    (the split filter reaches the scan of a split-partitioned table)."""
    t = training_table(spark, sf).where(F.col("split").isin("train", "validation"))
    nn = F.lit(True)
    for c in ("clinical_text", "target", "split", "dataset_version"):
        nn = nn & F.col(c).isNotNull()
    row = t.agg((F.count(F.lit(1)) > 0).alias("not_empty"), F.coalesce(F.bool_and(nn), F.lit(True)).alias("no_nulls"),
                (F.countDistinct("dataset_version") == 1).alias("one_version"),
                (F.countDistinct(F.when(F.col("split") == "train", F.col("target"))) == 3).alias("train_all_classes"),
                (F.countDistinct(F.when(F.col("split") == "validation", F.col("target"))) == 3)
                .alias("validation_all_classes"))
    return G.checks_long(row, row.columns)


# --- 2.14 report tables ------------------------------------------------------------

@register("rep_comparison", [], """
SELECT o_orderpriority AS label, round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 6) AS current,
  round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 6) AS expected FROM orders GROUP BY 1 ORDER BY current""")
def q_rep_comparison(spark, sf):
    o = table(spark, sf, "orders")
    g = o.groupBy(F.col("o_orderpriority").alias("label")).agg(
        F.round(F.avg(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))), 6).alias("current"),
        F.round(F.avg(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), 6).alias("expected"))
    return g.orderBy("current")


@register("rep_ranking", [], """
SELECT p_brand AS label, round(avg(p_retailprice), 6) AS value FROM part GROUP BY 1 ORDER BY value""")
def q_rep_ranking(spark, sf):
    p = table(spark, sf, "part")
    return p.groupBy(F.col("p_brand").alias("label")).agg(F.round(F.avg("p_retailprice"), 6).alias("value")).orderBy("value")


@register("rep_timeline", [], """
SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS current,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS expected FROM orders GROUP BY 1 ORDER BY 1""")
def q_rep_timeline(spark, sf):
    o = table(spark, sf, "orders")
    return (o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("period"))
             .agg(F.count(F.lit(1)).alias("current"), F.count_if(F.col("o_orderstatus") == "F").alias("expected"))
             .orderBy("period"))


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("rep_heatmap", [], "SELECT CAST(year(o_orderdate) AS INT) AS year, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in _PRIOS) + " FROM orders GROUP BY 1")
def q_rep_heatmap(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_orderpriority")
    return o.groupBy("year").pivot("o_orderpriority", _PRIOS).count().na.fill(0, _PRIOS)
