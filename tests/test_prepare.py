"""Training-table build on a synthetic survey (61 rows: 20 per class, one
exact copy of another row, one excluded row), the tampered-hash gate, null
rules and split isolation."""

import pytest
from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.functions import nulls as N
from vitalis.operators import gates as G
from vitalis.operators.split import group_folds
from vitalis.plans.training_table import build_training_table

CLASS_CODES = {"normal": (4, 5), "atencao": (3, 3), "urgente": (1, 2)}


def _rows():
    rows = []
    i = 0
    for ci, (cls, codes) in enumerate(CLASS_CODES.items()):
        for k in range(20):
            rows.append(dict(
                visit_row=i, AGE=93 if i == 0 else 20 + k, AGEDAYS=-7, SEX=1 + k % 2,
                IMMEDR=codes[k % 2], RFV1=20000 + ci * 100 + k, RFV2=-9, RFV3=-9, RFV4=-9, RFV5=-9,
                TEMPF=980 + k % 10, PULSE=60 + k + 20 * ci, RESPR=15 + k % 5, BPSYS=120, BPDIAS=998 if i == 0 else 80,
                POPCT=95 + k % 5, PAINSCALE=k % 11, DIAG1="blocked"))
            i += 1
    dup = dict(rows[5])
    dup["visit_row"] = i
    rows.append(dup)
    excluded = dict(rows[6])
    excluded.update(visit_row=i + 1, IMMEDR=-9)
    rows.append(excluded)
    return rows


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame(_rows())


@pytest.fixture(scope="module")
def codebooks(spark):
    rfv = spark.createDataFrame([(20000 + ci * 100 + k, "Complaint code") for ci in range(3) for k in range(20)],
                                "code long, label string")
    sex = spark.createDataFrame([(1, "Female"), (2, "Male")], "code int, label string")
    return rfv, sex


@pytest.fixture(scope="module")
def table(visits, codebooks):
    return build_training_table(visits, *codebooks).cache()


def test_contract_columns_and_counts(table):
    assert tuple(table.columns) == S.TRAINING_COLUMNS
    counts = {r["target"]: r["count"] for r in table.groupBy("target").count().collect()}
    # 61 eligible rows: the copy of row 5 is a normal-class visit.
    assert counts == {"normal": 21, "atencao": 20, "urgente": 20}
    assert table.select("record_id").distinct().count() == table.count()


def test_blocked_column_absent_and_phrases(table):
    assert "DIAG1" not in table.columns
    texts = [r[0] for r in table.select("clinical_text").collect()]
    assert any("Age: 93 years or older." in t for t in texts)
    assert any("systolic blood pressure 120 mmHg" in t for t in texts)


def test_groups_stay_in_one_split(table):
    g = table.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("split").alias("ns"))
    assert g.agg(F.max("n")).first()[0] == 2
    assert g.agg(F.max("ns")).first()[0] == 1


def test_contract_gate_passes_and_tampered_hash_fails(spark, table):
    checks = G.training_contract(table)
    failed = [r["check"] for r in checks.where(~F.col("passed")).collect()]
    assert failed == []
    tampered = table.withColumn("text_hash", F.when(F.col("record_id") == table.first()["record_id"],
                                                    F.lit("invalid")).otherwise(F.col("text_hash")))
    with pytest.raises(ValueError, match="text_hash_valid"):
        G.enforce(G.training_contract(tampered))


def test_domain_violation_raises_inside_the_job(spark, visits, codebooks):
    bad = visits.withColumn("PULSE", F.when(F.col("visit_row") == 3, F.lit(999)).otherwise(F.col("PULSE")))
    with pytest.raises(Exception, match="outside the domain in PULSE"):
        build_training_table(bad, *codebooks, materialize_rows=False).collect()


def test_unmapped_positive_code_raises(spark, visits, codebooks):
    rfv, sex = codebooks
    with pytest.raises(Exception, match="RFV1 codes without a description"):
        build_training_table(visits, rfv.where("code <> 20000"), sex, materialize_rows=False).collect()


def test_null_and_sentinel_rules(spark):
    df = spark.createDataFrame([(None,), (-9,), (70,), (400,)], "v int")
    out = df.select(N.is_usable("v", [-9]).alias("u"), N.in_domain("v", 0, 300).alias("d"),
                    N.sentinel_null("v", [-9]).alias("s")).collect()
    assert [r["u"] for r in out] == [True, False, True, True]
    assert [r["d"] for r in out] == [False, False, True, False]
    assert [r["s"] for r in out] == [None, None, 70, 400]


def test_split_is_stratified_and_uses_all_folds(spark):
    rows = [(f"h{i}", ("normal", "atencao", "urgente")[i % 3]) for i in range(3000)]
    df = spark.createDataFrame(rows, "text_hash string, target string")
    folds = group_folds(df)
    assert folds.select("fold").distinct().count() == 20
    per = {(r["stratum"], r["fold"]): r["count"] for r in folds.groupBy("stratum", "fold").count().collect()}
    # 1000 groups per class over 20 folds: exactly 50 each
    assert set(per.values()) == {50}
