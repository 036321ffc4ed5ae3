"""Source gates on a corrupted copy of the smoke visits: every gate that
must fail does, with the observed counts of the injected faults."""

import copy

from tests.conftest import SF_SMALL
from vitalis.sources import fixtures as FX


def test_source_gates_flag_injected_faults(spark, monkeypatch):
    base = FX.visits(spark, SF_SMALL).orderBy("visit_row").limit(300)
    rows = [r.asDict() for r in base.collect()]
    bad = copy.deepcopy(rows[:6])
    bad[0]["IMMEDR"] = 42            # outside the source domain
    bad[1]["AGE"] = 120              # outside 0..93
    bad[2]["SEX"] = 3                # outside the sex domain
    bad[3]["PULSE"] = 400            # usable value outside its domain
    bad[4]["visit_row"] = None       # missing key
    bad.append(dict(rows[7]))        # duplicate key
    data = rows + bad
    monkeypatch.setattr(FX, "visits", lambda s, sf: s.createDataFrame(data, base.schema))
    from vitalis.plans.catalog.gates_reports import q_dq_source_gates
    out = {r["gate"]: (r["passed"], r["observed"]) for r in q_dq_source_gates(spark, SF_SMALL).collect()}
    assert out["Source target domain"][0] is False
    assert out["Demographic domains"] == (False, "invalid")
    assert out["Vital representation domains"] == (False, "1")
    # 6 rows repeat a key (5 copies + 1 duplicate), 1 has none: 307 - 300 + 1
    assert out["Unique visit rows"] == (False, "8")
    assert out["Required schema"][0] and out["Temporal leakage contract"][0]


def test_spread_only_splits_small_scans(spark):
    from vitalis.sources.tables import spread
    slots = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one, "id").rdd.getNumPartitions() == slots
    many = spark.range(0, 1000, numPartitions=slots + 1)
    assert spread(many, "id") is many


def test_split_audit_counts_conflicting_and_crossing_groups(spark):
    from vitalis.operators.profile import split_audit
    df = spark.createDataFrame(
        [("g1", "normal", "train"), ("g1", "urgente", "train"), ("g2", "normal", "train"),
         ("g2", "normal", "test"), ("g3", "atencao", "validation"), ("g4", None, "train"), ("g4", None, "train")],
        "text_hash string, target string, split string")
    r = split_audit(df).first()
    assert (r["unique_texts"], r["repeated_groups"], r["conflicting_groups"], r["crossing_groups"]) == (4, 3, 1, 1)


def test_training_table_split_filter_prunes_folders(spark):
    from vitalis.plans.training_table import training_table
    t = training_table(spark, SF_SMALL)
    plan = t.where("split = 'validation'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan
    assert t.columns == ["record_id", "clinical_text", "target", "text_hash", "split", "dataset_version"]
