"""DuckDB SQL for the derived views, composed into oracle queries as CTEs.

The oracle engine only sees the driver tables, so each oracle string inlines
the view definitions it needs.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["_rfv"] = """
SELECT l_orderkey,
  max(CASE WHEN l_linenumber=1 THEN code END) AS r1, max(CASE WHEN l_linenumber=2 THEN code END) AS r2,
  max(CASE WHEN l_linenumber=3 THEN code END) AS r3, max(CASE WHEN l_linenumber=4 THEN code END) AS r4,
  max(CASE WHEN l_linenumber=5 THEN code END) AS r5
FROM (SELECT l_orderkey, l_linenumber, min(l_partkey)+20000 AS code
      FROM lineitem GROUP BY l_orderkey, l_linenumber) x
GROUP BY l_orderkey"""

VIEWS["visits"] = """
SELECT o.o_orderkey AS visit_row,
  CASE WHEN o.o_orderkey % 11 = 0 THEN -9 WHEN o.o_orderkey % 23 = 0 THEN 0
       ELSE CAST(substr(o.o_orderpriority,1,1) AS INT) END AS IMMEDR,
  CAST(o.o_custkey % 94 AS INT) AS AGE,
  CASE WHEN o.o_custkey % 94 = 0 THEN CAST(o.o_orderkey % 366 AS INT) ELSE -7 END AS AGEDAYS,
  CAST(1 + o.o_custkey % 2 AS INT) AS SEX,
  coalesce(r1,-9) AS RFV1, coalesce(r2,-9) AS RFV2, coalesce(r3,-9) AS RFV3,
  coalesce(r4,-9) AS RFV4, coalesce(r5,-9) AS RFV5,
  CASE WHEN o.o_orderkey % 13 = 0 THEN -9 ELSE CAST(950 + o.o_orderkey % 100 AS INT) END AS TEMPF,
  CASE WHEN o.o_orderkey % 17 = 0 THEN 998 WHEN o.o_orderkey % 19 = 0 THEN -9
       ELSE CAST(50 + o.o_orderkey % 121 AS INT) END AS PULSE,
  CASE WHEN o.o_orderkey % 29 = 0 THEN -9 ELSE CAST(10 + o.o_orderkey % 30 AS INT) END AS RESPR,
  CASE WHEN o.o_orderkey % 31 = 0 THEN -9 ELSE CAST(90 + o.o_custkey % 90 AS INT) END AS BPSYS,
  CASE WHEN o.o_orderkey % 7 = 0 THEN 998 ELSE CAST(50 + o.o_custkey % 60 AS INT) END AS BPDIAS,
  CASE WHEN o.o_orderkey % 37 = 0 THEN -9 ELSE CAST(85 + o.o_orderkey % 16 AS INT) END AS POPCT,
  CASE WHEN o.o_orderkey % 5 = 0 THEN -9 WHEN o.o_orderkey % 41 = 0 THEN -8
       ELSE CAST(o.o_orderkey % 11 AS INT) END AS PAINSCALE,
  CASE WHEN o.o_orderkey % 43 = 0 THEN '-9'
       ELSE concat(substr(c.c_mktsegment,1,3), '.', CAST(o.o_orderkey % 7 AS VARCHAR), '-') END AS DIAG1,
  CASE WHEN o.o_totalprice > 300000 THEN 1 ELSE 0 END AS ADMITHOS,
  CASE WHEN o.o_totalprice BETWEEN 250000 AND 260000 THEN 1 ELSE 0 END AS OBSHOS,
  CASE WHEN o.o_totalprice > 400000 THEN 1 ELSE 2 END AS ADMIT,
  CASE WHEN o.o_orderkey % 997 = 0 THEN 1 ELSE 0 END AS DIEDED
FROM orders o
LEFT JOIN _rfv ON _rfv.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey"""

VIEWS["rfv_codebook"] = "SELECT p_partkey + 20000 AS code, p_name AS label FROM part"

VIEWS["sex_codebook"] = "SELECT * FROM (VALUES (1,'Female'),(2,'Male')) t(code,label)"

VIEWS["diag_ref"] = """
SELECT DISTINCT concat(substr(c_mktsegment,1,3), CAST(k AS VARCHAR)) AS code,
  concat(c_mktsegment, ' type ', CAST(k AS VARCHAR)) AS description
FROM customer CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5)) n(k)"""

VIEWS["scored"] = """
SELECT d.doc_id, l.quality AS y_true,
  CASE WHEN d.doc_id % 5 = 0 THEN 1 - l.quality ELSE l.quality END AS y_pred,
  round(0.6E0 * l.quality + (d.n_chars % 100) / 200.0E0, 6) AS score
FROM documents d JOIN labels l ON l.doc_id = d.doc_id"""

VIEWS["scored_mc"] = """
SELECT vec_id, label AS y_true,
  CASE WHEN vec_id % 4 = 0 THEN (label + 1) % 10 ELSE label END AS y_pred FROM embeddings"""

VIEWS["requests"] = """
SELECT event_id, ts, event_type AS handler,
  CASE WHEN event_type = 'error' THEN 500 WHEN event_id % 10 = 0 THEN 422 ELSE 200 END AS status,
  value / 100.0E0 AS duration_s,
  CASE WHEN value > 150 THEN 1.0E0 ELSE 0.25E0 + value / 200.0E0 END AS confidence,
  CASE WHEN event_id % 3 = 0 THEN 'v2' ELSE 'v1' END AS model_version
FROM events"""

# Eligible cohort with decoded complaints, cleaned vitals (null policy),
# normalised diagnosis and outcome columns.
VIEWS["eda"] = """
SELECT v.visit_row, v.IMMEDR,
  CASE WHEN v.IMMEDR IN (1,2) THEN 'urgente' WHEN v.IMMEDR = 3 THEN 'atencao' ELSE 'normal' END AS target,
  v.AGE, v.AGEDAYS, v.SEX, sx.label AS sex_label,
  v.RFV1, v.RFV2, v.RFV3, v.RFV4, v.RFV5,
  c1.label AS RFV1_description, c2.label AS RFV2_description, c3.label AS RFV3_description,
  c4.label AS RFV4_description, c5.label AS RFV5_description,
  dn.DIAG1_code, dr.description AS DIAG1_description,
  CASE WHEN v.TEMPF NOT IN (-9) AND v.TEMPF BETWEEN 600 AND 1112 THEN v.TEMPF / 10.0E0 END AS temperature_f,
  CASE WHEN v.PULSE NOT IN (-9, 998) AND v.PULSE BETWEEN 0 AND 300 THEN v.PULSE / 1.0E0 END AS heart_rate,
  CASE WHEN v.RESPR NOT IN (-9) AND v.RESPR BETWEEN 0 AND 200 THEN v.RESPR / 1.0E0 END AS respiratory_rate,
  CASE WHEN v.BPSYS NOT IN (-9) AND v.BPSYS BETWEEN 0 AND 350 THEN v.BPSYS / 1.0E0 END AS systolic_bp,
  CASE WHEN v.BPDIAS NOT IN (-9, 998) AND v.BPDIAS BETWEEN 0 AND 250 THEN v.BPDIAS / 1.0E0 END AS diastolic_bp,
  CASE WHEN v.POPCT NOT IN (-9) AND v.POPCT BETWEEN 0 AND 100 THEN v.POPCT / 1.0E0 END AS oxygen_saturation,
  CASE WHEN v.PAINSCALE NOT IN (-9, -8) AND v.PAINSCALE BETWEEN 0 AND 10 THEN v.PAINSCALE / 1.0E0 END AS pain_scale,
  v.ADMITHOS, v.OBSHOS, v.ADMIT, v.DIEDED
FROM visits v
LEFT JOIN sex_codebook sx ON sx.code = v.SEX
LEFT JOIN rfv_codebook c1 ON c1.code = v.RFV1 AND v.RFV1 > 0
LEFT JOIN rfv_codebook c2 ON c2.code = v.RFV2 AND v.RFV2 > 0
LEFT JOIN rfv_codebook c3 ON c3.code = v.RFV3 AND v.RFV3 > 0
LEFT JOIN rfv_codebook c4 ON c4.code = v.RFV4 AND v.RFV4 > 0
LEFT JOIN rfv_codebook c5 ON c5.code = v.RFV5 AND v.RFV5 > 0
LEFT JOIN (SELECT visit_row,
             CASE WHEN rtrim(replace(trim(DIAG1), '.', ''), '-') IN ('', '-9', '-8', '-7') THEN NULL
                  ELSE rtrim(replace(trim(DIAG1), '.', ''), '-') END AS DIAG1_code
           FROM visits) dn ON dn.visit_row = v.visit_row
LEFT JOIN diag_ref dr ON dr.code = dn.DIAG1_code
WHERE v.IMMEDR IN (1,2,3,4,5)"""


# Pipeline template text per eligible visit (before the split).
VIEWS["train_text"] = """
SELECT visit_row, target,
  sha256('nhamcs-ed-2021-training-v1:' || CAST(visit_row AS VARCHAR)) AS record_id,
  trim(regexp_replace(concat_ws(' ',
    CASE WHEN AGE = 0 AND AGEDAYS BETWEEN 0 AND 365 THEN 'Age: ' || CAST(AGEDAYS AS VARCHAR) || ' days.'
         WHEN AGE = 93 THEN 'Age: 93 years or older.'
         ELSE 'Age: ' || CAST(AGE AS VARCHAR) || ' years.' END,
    'Sex: ' || sex_label || '.',
    CASE WHEN cs <> '' THEN 'Reasons for visit: ' || cs || '.' END,
    CASE WHEN obs <> '' THEN 'Triage observations: ' || obs || '.' END), '\\s+', ' ', 'g')) AS clinical_text
FROM (
  SELECT *,
    concat_ws('; ', RFV1_description,
      CASE WHEN RFV2_description IS DISTINCT FROM RFV1_description THEN RFV2_description END,
      CASE WHEN RFV3_description IS DISTINCT FROM RFV1_description
            AND RFV3_description IS DISTINCT FROM RFV2_description THEN RFV3_description END,
      CASE WHEN RFV4_description IS DISTINCT FROM RFV1_description
            AND RFV4_description IS DISTINCT FROM RFV2_description
            AND RFV4_description IS DISTINCT FROM RFV3_description THEN RFV4_description END,
      CASE WHEN RFV5_description IS DISTINCT FROM RFV1_description
            AND RFV5_description IS DISTINCT FROM RFV2_description
            AND RFV5_description IS DISTINCT FROM RFV3_description
            AND RFV5_description IS DISTINCT FROM RFV4_description THEN RFV5_description END) AS cs,
    concat_ws('; ',
      'temperature ' || printf('%.1f', temperature_f) || ' F',
      'heart rate ' || printf('%.0f', heart_rate) || ' bpm',
      'respiratory rate ' || printf('%.0f', respiratory_rate) || '/min',
      CASE WHEN systolic_bp IS NOT NULL AND diastolic_bp IS NOT NULL
             THEN 'blood pressure ' || CAST(CAST(trunc(systolic_bp) AS BIGINT) AS VARCHAR) || '/'
                  || CAST(CAST(trunc(diastolic_bp) AS BIGINT) AS VARCHAR) || ' mmHg'
           WHEN systolic_bp IS NOT NULL
             THEN 'systolic blood pressure ' || CAST(CAST(trunc(systolic_bp) AS BIGINT) AS VARCHAR) || ' mmHg'
           WHEN diastolic_bp IS NOT NULL
             THEN 'diastolic blood pressure ' || CAST(CAST(trunc(diastolic_bp) AS BIGINT) AS VARCHAR) || ' mmHg'
      END,
      'oxygen saturation ' || printf('%.0f', oxygen_saturation) || '%',
      'pain score ' || printf('%.0f', pain_scale) || '/10') AS obs
  FROM eda) t"""

# Training table: text hash, quota split (plain running sum per stratum).
VIEWS["training"] = """
SELECT t.record_id, t.clinical_text, t.target, h.text_hash,
  CASE WHEN f.fold < 14 THEN 'train' WHEN f.fold < 17 THEN 'validation' ELSE 'test' END AS split,
  'nhamcs-ed-2021-training-v1' AS dataset_version
FROM train_text t
JOIN (SELECT visit_row, sha256(lower(clinical_text)) AS text_hash FROM train_text) h USING (visit_row)
JOIN (
  SELECT text_hash, CAST(floor(20 * (sum(n) OVER (PARTITION BY stratum ORDER BY hh, text_hash
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n)
         / sum(n) OVER (PARTITION BY stratum)) AS INT) AS fold
  FROM (SELECT text_hash, min(target) AS stratum, count(*) AS n, sha256('42:' || text_hash) AS hh
        FROM (SELECT target, sha256(lower(clinical_text)) AS text_hash FROM train_text) x
        GROUP BY text_hash) g
) f USING (text_hash)"""


# EDA table: cohort plus the EDA template text (repeats kept, truncation,
# blood pressure only when both sides are present, no 93+ rule).
VIEWS["eda_text"] = """
SELECT *, concat_ws(' ',
    CASE WHEN AGE = 0 AND AGEDAYS BETWEEN 0 AND 365 THEN 'Age: ' || CAST(AGEDAYS AS VARCHAR) || ' days.'
         ELSE 'Age: ' || CAST(AGE AS VARCHAR) || ' years.' END,
    'Sex: ' || sex_label || '.',
    CASE WHEN concat_ws('; ', RFV1_description, RFV2_description, RFV3_description, RFV4_description,
                        RFV5_description) <> ''
         THEN 'Reasons for visit: ' || concat_ws('; ', RFV1_description, RFV2_description, RFV3_description,
                                                 RFV4_description, RFV5_description) || '.' END,
    CASE WHEN eobs <> '' THEN 'Triage observations: ' || eobs || '.' END) AS clinical_text
FROM (SELECT *, concat_ws('; ',
      'temperature ' || printf('%.1f', temperature_f) || ' F',
      'heart rate ' || CAST(CAST(trunc(heart_rate) AS BIGINT) AS VARCHAR) || ' bpm',
      'respiratory rate ' || CAST(CAST(trunc(respiratory_rate) AS BIGINT) AS VARCHAR) || '/min',
      CASE WHEN systolic_bp IS NOT NULL AND diastolic_bp IS NOT NULL
           THEN 'blood pressure ' || CAST(CAST(trunc(systolic_bp) AS BIGINT) AS VARCHAR) || '/'
                || CAST(CAST(trunc(diastolic_bp) AS BIGINT) AS VARCHAR) || ' mmHg' END,
      'oxygen saturation ' || CAST(CAST(trunc(oxygen_saturation) AS BIGINT) AS VARCHAR) || '%',
      'pain score ' || CAST(CAST(trunc(pain_scale) AS BIGINT) AS VARCHAR) || '/10') AS eobs
      FROM eda) e"""

# Complaints in long form (slot 1..5), nulls dropped.
VIEWS["complaints_long"] = """
SELECT visit_row, target, 'RFV1_description' AS slot, RFV1_description AS complaint FROM eda WHERE RFV1_description IS NOT NULL
UNION ALL SELECT visit_row, target, 'RFV2_description', RFV2_description FROM eda WHERE RFV2_description IS NOT NULL
UNION ALL SELECT visit_row, target, 'RFV3_description', RFV3_description FROM eda WHERE RFV3_description IS NOT NULL
UNION ALL SELECT visit_row, target, 'RFV4_description', RFV4_description FROM eda WHERE RFV4_description IS NOT NULL
UNION ALL SELECT visit_row, target, 'RFV5_description', RFV5_description FROM eda WHERE RFV5_description IS NOT NULL"""

# Label x class crosstab of complaints with totals and row rates.
VIEWS["complaint_summary"] = """
SELECT complaint,
  CAST(count(*) FILTER (WHERE target = 'normal') AS BIGINT) AS normal,
  CAST(count(*) FILTER (WHERE target = 'atencao') AS BIGINT) AS atencao,
  CAST(count(*) FILTER (WHERE target = 'urgente') AS BIGINT) AS urgente,
  CAST(count(*) AS BIGINT) AS total,
  round(count(*) FILTER (WHERE target = 'normal') / count(*), 6) AS normal_rate,
  round(count(*) FILTER (WHERE target = 'atencao') / count(*), 6) AS atencao_rate,
  round(count(*) FILTER (WHERE target = 'urgente') / count(*), 6) AS urgente_rate
FROM complaints_long GROUP BY complaint"""

VIEWS["diagnosis_summary"] = """
SELECT primary_diagnosis,
  CAST(count(*) FILTER (WHERE target = 'normal') AS BIGINT) AS normal,
  CAST(count(*) FILTER (WHERE target = 'atencao') AS BIGINT) AS atencao,
  CAST(count(*) FILTER (WHERE target = 'urgente') AS BIGINT) AS urgente,
  CAST(count(*) AS BIGINT) AS total,
  round(count(*) FILTER (WHERE target = 'normal') / count(*), 6) AS normal_rate,
  round(count(*) FILTER (WHERE target = 'atencao') / count(*), 6) AS atencao_rate,
  round(count(*) FILTER (WHERE target = 'urgente') / count(*), 6) AS urgente_rate
FROM (SELECT coalesce(DIAG1_description, DIAG1_code) AS primary_diagnosis, target FROM eda) d
WHERE primary_diagnosis IS NOT NULL GROUP BY primary_diagnosis"""

# Dependencies between views (topological order of the CTE list).
DEPS = {
    "visits": ["_rfv"],
    "eda": ["visits", "sex_codebook", "rfv_codebook", "diag_ref"],
    "train_text": ["eda"],
    "training": ["train_text"],
    "eda_text": ["eda"],
    "complaints_long": ["eda"],
    "complaint_summary": ["complaints_long"],
    "diagnosis_summary": ["eda"],
}


def _expand(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(views: list[str], body: str) -> str:
    """Prefix ``body`` with the CTEs for ``views`` (and their dependencies).
    ``body`` may itself start with ``WITH``; its CTEs are appended."""
    names = _expand(views)
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in names]
    b = body.strip()
    if not ctes:
        return b
    if b[:4].upper() == "WITH":
        return "WITH " + ",\n".join(ctes) + ",\n" + b[4:].lstrip()
    if not ctes:
        return b
    return "WITH " + ",\n".join(ctes) + "\n" + b
