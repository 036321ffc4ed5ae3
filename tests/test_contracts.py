"""Results that must not depend on layout, batch size or code-book size; nulls
and raw thresholds; gates and the run log on faults."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis import session
from vitalis.functions import text as X
from vitalis.operators import clean as C
from vitalis.operators import evaluate as EV
from vitalis.operators import features as FE
from vitalis.operators import gates as G
from vitalis.operators import models as M
from vitalis.operators import runlog as R
from vitalis.operators import score as SC
from vitalis.plans import registry
from vitalis.plans import training_table as TT
from vitalis.sources import files as FS
from vitalis.streaming import monitor as MO
from tests.conftest import SF_ORACLE, SF_SMALL

STREAMS = ("mon_stream_errors", "mon_stream_totals", "mon_stream_alerts")


def rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_streams_and_checksums_read_folder_tables(spark, tmp_path):
    """A table of one file and the same table as a folder of part files."""
    folder = tmp_path / "sf"
    folder.mkdir()
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5).write.parquet(str(folder / "events.parquet"))
    q = registry.queries()
    for name in STREAMS:
        # The mean is a sum of doubles: its last shown digit may follow the order.
        one, many = (q[name](spark, at) for at in (SF_SMALL, str(folder)))
        keys = [c for c in one.columns if c != "value"]
        assert rows(one.select(keys)) == rows(many.select(keys)) and one.count(), name
        if "value" in one.columns:
            assert [r[-2] for r in rows(one)] == pytest.approx([r[-2] for r in rows(many)], abs=2e-6)
    sums = q["src_file_checksum"](spark, str(folder)).collect()
    assert len(sums) == 5 and all(r["valid"] and r["file"].startswith("events.parquet/") for r in sums)
    assert len(q["src_file_checksum"](spark, SF_SMALL).collect()) == 14


@pytest.mark.parametrize("records", ["50", "10000"])
def test_stream_alerts_do_not_depend_on_the_batch_size(spark, records):
    q = registry.queries()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        got = rows(q["mon_stream_alerts"](spark, SF_ORACLE).select("rule", "window_start"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    batch = None
    for name in ("mon_alert_errors", "mon_alert_duration", "mon_alert_confidence"):
        d = q[name](spark, SF_ORACLE).select("rule", "window_start")
        batch = d if batch is None else batch.union(d)
    last = spark.read.parquet(f"{SF_ORACLE}/events.parquet").agg(F.max("ts")).first()[0]
    closed = [r for r in rows(batch) if r[1] + dt.timedelta(hours=6) <= last - dt.timedelta(minutes=10)]
    assert got == closed and len(got) > 100


def test_closed_windows_equal_the_batch_form(spark):
    q = registry.queries()
    last = spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(F.max("ts")).first()[0]
    batch = q["mon_error_count"](spark, SF_SMALL)
    at = sorted(batch.columns).index("window_start")
    closed = [r for r in rows(batch) if r[at] + dt.timedelta(hours=6) <= last - dt.timedelta(minutes=10)]
    assert rows(q["mon_stream_errors"](spark, SF_SMALL)) == closed and closed


def test_code_books(spark, monkeypatch):
    visits = spark.createDataFrame([(k, *(20000 + (k * i) % 5 if i < 5 else None for i in range(1, 6))) for k in range(20)],
                                   "visit_row long, " + ", ".join(f"{c} long" for c in S.RFV_COLUMNS))
    book = spark.createDataFrame([(20000 + k, f"label {k}") for k in range(4)], "code long, label string")
    small = rows(C.decode_complaints(visits, book))
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 0)
    assert rows(C.decode_complaints(visits, book)) == small and len(small) == 20
    with pytest.raises(ValueError, match="20001"):
        C.decode_complaints(visits, book.union(spark.createDataFrame([(20001, "again")], book.schema)))


def test_small_enough_checks_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    assert session.small_enough(df, 100, 200_000) and not session.small_enough(df, 99, 200_000)
    assert not session.small_enough(df, 100, 50_000)
    assert session.small_enough(df.where("id < 0"), 0, 0)
    df = spark.createDataFrame([(None,)], "s string")
    assert session.small_enough(df, 1, 0)


def test_alert_thresholds_use_raw_values(spark):
    events = [(k, dt.datetime(2024, 1, 1, k // 6, 10 * (k % 6)), 200, 0.1, 0.4999998) for k in range(120)]
    df = spark.createDataFrame(events, "event_id long, ts timestamp_ntz, status int, duration_s double, confidence double")
    low = MO.rule_series(df).where("rule = 'LowAverageConfidence'").collect()
    assert low and all(r["condition"] and r["value"] == 0.5 for r in low)
    assert MO.alerts(MO.rule_series(df), "LowAverageConfidence").count() > 0


def test_gates_use_raw_values(spark):
    metrics = spark.createDataFrame([(0.5499996, 0.9)], "f1_macro double, urgent_recall double")
    assert {r["check"]: r["passed"] for r in G.model_gate(metrics).collect()} == {"f1_macro": False, "urgent_recall": True}
    pred = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (0, 0), (1, 1), (0, 1), (1, 1)], "y_true int, y_pred int")
    raw, shown = EV.global_metrics(pred, digits=None).first(), EV.global_metrics(pred).first()
    assert shown["accuracy"] == round(raw["accuracy"], 6) != raw["accuracy"]


def test_missing_and_blank_requests_are_rejected(spark):
    df = spark.createDataFrame([(1, None), (2, " \t\n"), (3, "fine"), (4, "x" * 5001)], "id int, clinical_text string")
    got = {r["id"]: (r["valid"], r["reason"]) for r in SC.request_validity(df).collect()}
    assert got == {1: (False, "missing"), 2: (False, "empty"), 3: (True, None), 4: (False, "too_long")}
    counts = FE.text_checks(df, "clinical_text").first()
    assert (counts["rows"], counts["null_texts"], counts["blank_texts"]) == (4, 1, 1)
    assert FE.reject_texts(df.where("id > 2"), "clinical_text").count() == 2
    for bad in (1, 2):
        with pytest.raises(Exception, match="missing or blank"):
            FE.reject_texts(df.where(f"id = {bad}"), "clinical_text").collect()


def test_a_column_without_values_keeps_its_rows(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, c string")
    assert rows(FE.impute_mode(df, "c")) == rows(df) or FE.impute_mode(df, "c").count() == 2
    assert [r["c"] for r in FE.impute_mode(df, "c").collect()] == [None, None]


def contract(spark, **change):
    base = []
    for k, (target, split) in enumerate((t, s) for t in S.TARGET_ORDER for s in S.SPLIT_NAMES):
        base.append({"record_id": f"r{k}", "clinical_text": f"text {k}", "target": target, "split": split, "dataset_version": S.DATASET_VERSION})
    base[0] |= change
    df = spark.createDataFrame(base, "record_id string, clinical_text string, target string, split string, dataset_version string")
    df = df.withColumn("text_hash", X.text_hash("clinical_text")).select(*S.TRAINING_COLUMNS)
    return {r["check"]: r["passed"] for r in G.training_contract(df).collect()}


def test_contract_survives_dirty_columns(spark):
    assert all(contract(spark).values())
    assert not contract(spark, clinical_text="\t\n")["text_not_blank"]
    assert not contract(spark, target="other")["classes_valid"]
    assert not contract(spark, split="other")["splits_valid"]
    assert not contract(spark, target=None)["no_nulls"]


def test_training_table_is_built_once_and_enforced(spark, monkeypatch):
    first = TT.training_table(spark, SF_SMALL)
    monkeypatch.setattr(TT, "build_training_table", lambda *a, **k: pytest.fail("built again"))
    assert TT.training_table(spark, SF_SMALL).inputFiles() == first.inputFiles()
    bad = first.withColumn("text_hash", F.lit("0" * 64))
    monkeypatch.setattr(TT, "build_training_table", lambda *a, **k: bad)
    monkeypatch.setattr(TT, "_published", {})
    with pytest.raises(ValueError, match="text_hash_valid"):
        TT.training_table(spark, SF_SMALL)
    assert not TT._published


def test_discard_removes_scratch_alone(spark, tmp_path):
    path = session.scratch(spark, "test")
    spark.range(3).write.parquet(path)
    session.discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        session.discard(spark, str(tmp_path))


def test_medians_are_learnt_on_the_training_rows(spark):
    make = lambda v: spark.createDataFrame(
        [(1, "normal", "train", 10.0), (2, "normal", "train", None), (3, "normal", "train", 20.0), (4, "normal", "validation", v),
         (5, "normal", "validation", None)], "visit_row int, target string, split string, x double")
    seen = []
    for v in (0.0, 1e9):
        df = make(v)
        out = M.tabular_frame(df, ["x"], keep=("visit_row", "target", "split"), fit_on=df.where("split = 'train'"))
        seen.append({r["visit_row"]: float(r["features"][0]) for r in out.collect() if r["visit_row"] != 4})
    assert seen[0] == seen[1] == {1: 10.0, 2: 15.0, 3: 20.0, 5: 15.0}


@pytest.mark.parametrize("ranges", [2, 7, 256])
def test_exact_quantiles(spark, ranges):
    import random

    import numpy as np

    from vitalis.operators.quantiles import exact_quantiles
    rng = random.Random(ranges)
    data = [(g, v) for g, n, f in ((1, 501, rng.random), (2, 400, lambda: float(rng.randrange(5))), (3, 1, rng.random), (None, 30, rng.random))
            for v in [f() for _ in range(n)]] + [(1, None), (4, None)]
    got = {r["g"]: r for r in exact_quantiles(spark.createDataFrame(data, "g int, v double").where("g is not null"), ["g"], "v", [0, 0.25, 0.5, 0.95, 1], ranges).collect()}
    assert set(got) == {1, 2, 3}
    for g, r in got.items():
        values = [v for k, v in data if k == g and v is not None]
        assert r["n"] == len(values) and [r[f"q{k}"] for k in range(5)] == pytest.approx(np.quantile(values, [0, 0.25, 0.5, 0.95, 1]))


def test_dummies(spark):
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(0.0, 1.0), (1.0, 2.0), (1.0, 6.0)], "label double, x double"))
    pick = lambda m: {r["prediction"] for r in m.fit(df).transform(df).collect()}
    assert pick(M.create("classification", "dummy", {"labelCol": "label"})) == {1.0}
    assert pick(M.create("regression", "Dummy", {"labelCol": "x"})) == {3.0}


def test_saved_model_scores_alike(spark, tmp_path):
    words = {"normal": "mild cough stable", "atencao": "fever vomiting pain", "urgente": "chest unconscious bleeding"}
    df = spark.createDataFrame([(f"{k}{i}", f"{w} case {i}", k) for k, w in words.items() for i in range(4)],
                               "record_id string, clinical_text string, target string")
    model = M.fit_text_logistic(df)
    with pytest.raises(FileNotFoundError):
        M.load_model(str(tmp_path / "none"))
    M.save_model(model, str(tmp_path / "m"))
    back = M.load_model(str(tmp_path / "m"))
    predict = lambda m: m.transform(df).select("record_id", F.col("predicted_target").alias("target"))
    assert R.agreement(predict(model), predict(back)).first()[0] == 1.0
    assert R.agreement(predict(model), predict(back).where("record_id <> 'normal0'")).first()[0] == pytest.approx(11 / 12)


def test_score_batch_covers_every_request(spark):
    out = registry.queries()["score_batch"](spark, SF_SMALL)
    table = TT.training_table(spark, SF_SMALL)
    assert sorted(r["record_id"] for r in out.collect()) == sorted(r["record_id"] for r in table.collect())


def test_run_log_accumulates_and_its_gate_can_fail(spark, tmp_path):
    path, commit = str(tmp_path / "log"), "a" * 40
    metrics = spark.createDataFrame([("m1", 0.9, 0.8, 0.7), ("m2", 0.8, 0.9, 0.7)], "model string, accuracy double, f1_macro double, urgent_recall double")
    for k in (1, 2):
        R.append(spark, path, metrics, commit=commit)
        R.set_alias(spark, path)
        assert R.runs(spark, path).count() == 2 * k
    runs, names = R.runs(spark, path), R.aliases(spark, path)
    champion = R.current(runs, names)
    assert (champion.first()["model"], champion.first()["version"]) == ("m2", 4)
    report = champion.select("run_id", "version", "commit")

    def failed(report=report, runs=runs, names=names):
        return {r["check"] for r in R.registration_checks(report, runs, names).collect() if not r["passed"]}
    assert failed() == set()
    assert failed(report.withColumn("version", F.lit(3).cast("long"))) == {"version_matches_run"}
    assert failed(report.withColumn("commit", F.lit("b" * 40))) == {"commit_matches"}
    assert "commit_valid" in failed(report.withColumn("commit", F.lit("not a commit!")))
    assert failed(report.withColumn("run_id", F.lit("unknown"))) >= {"run_logged", "alias_matches"}
    assert failed(names=names.where("false")) == {"alias_matches"}
    assert failed(report.withColumn("run_id", F.lit(None).cast("string"))) >= {"ids_present"}


def test_writers_at_once_take_distinct_versions(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    path = str(tmp_path / "log")
    metrics = spark.createDataFrame([("m1", 0.9, 0.8, 0.7), ("m2", 0.8, 0.9, 0.7)], "model string, accuracy double, f1_macro double, urgent_recall double")
    with ThreadPoolExecutor(6) as pool:
        firsts = list(pool.map(lambda k: R.append(spark, path, metrics, commit=f"{k:040x}"), range(6)))
    rows = R.runs(spark, path).collect()
    assert sorted(firsts) == [1, 3, 5, 7, 9, 11] and sorted(r["version"] for r in rows) == list(range(1, 13))
    for k, first in enumerate(firsts):  # a commit is whole
        assert sorted((r["version"], r["model"]) for r in rows if r["commit"] == f"{k:040x}") == [(first, "m1"), (first + 1, "m2")]
    assert len({r["run_id"] for r in rows}) == 12
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda v: R.name_version(spark, path, "champion", v), (1, 2, 3, 4)))
    turns = {r["set_at"]: r["version"] for r in R.aliases(spark, path).collect()}
    assert sorted(turns) == [1, 2, 3, 4] and R.named_version(spark, path) == turns[4]
    assert not [p for p in (tmp_path / "log" / "runs").iterdir() if p.name.startswith("_")]


def test_a_commit_in_the_making_is_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    metrics = spark.createDataFrame([("m1", 0.9, 0.8, 0.7)], "model string, accuracy double, f1_macro double, urgent_recall double")
    R.append(spark, path, metrics, commit="a" * 40)
    (tmp_path / "log" / "runs" / "_halfway").write_text('{"run_id": "x", "version": 2')
    assert [r["version"] for r in R.runs(spark, path).collect()] == [1]
    assert R.append(spark, path, metrics, commit="a" * 40) == 2
    assert not R._create(spark, f"{path}/runs/{1:019d}.json", "other") and R.runs(spark, path).count() == 2


@pytest.mark.parametrize("group, field, value", [
    ("metrics", "f1_macro", 0.5499996), ("metrics", "urgent_recall", 0.1), ("benchmark", "agreement", 0.9999999),
    ("benchmark", "runs", 29), ("benchmark", "speedup", 1.0)])
def test_report_gate_can_fail(spark, group, field, value):
    good = {"metrics": {"accuracy": 0.9, "f1_macro": 0.8, "urgent_recall": 0.8}, "benchmark": {"agreement": 1.0, "runs": 30, "speedup": 1.5}}
    schema = ("metrics struct<accuracy:double,f1_macro:double,urgent_recall:double>, "
              "benchmark struct<agreement:double,runs:long,speedup:double>")

    def failed(report):
        return {r["check"] for r in R.report_checks(spark.createDataFrame([report], schema)).collect() if not r["passed"]}
    assert failed(good) == set()
    assert failed({k: v | ({field: value} if k == group else {}) for k, v in good.items()}) == {field}
    assert field in failed({k: v | ({field: None} if k == group else {}) for k, v in good.items()})


def test_checksums_notice_a_change(spark, tmp_path):
    base, stored = tmp_path / "data", str(tmp_path / "manifest")
    (base / "t.parquet").mkdir(parents=True)
    (base / "t.parquet" / "a.parquet").write_bytes(b"one")
    (base / "b.parquet").write_bytes(b"two")
    (base / "c.parquet").write_bytes(b"three")

    def verdict():
        manifest = FS.landed_manifest(spark, str(base), stored, "*.parquet")
        return {r["file"]: r["valid"] for r in FS.verify_checksums(FS.file_checksums(spark, str(base), "*.parquet"), manifest).collect()}
    assert verdict() == {"t.parquet/a.parquet": True, "b.parquet": True, "c.parquet": True}
    shutil.copy(base / "b.parquet", base / "t.parquet" / "a.parquet")
    (base / "new.parquet").write_bytes(b"three")
    (base / "c.parquet").write_bytes(b"")
    assert verdict() == {"t.parquet/a.parquet": False, "b.parquet": True, "c.parquet": False, "new.parquet": False}


def test_a_rewritten_file_of_the_same_name_is_a_new_source(spark, tmp_path):
    copy = tmp_path / "sf"
    shutil.copytree(SF_SMALL, copy)
    key = TT.source_key(spark, str(copy))
    assert key == TT.source_key(spark, str(copy))
    rows = TT.training_table(spark, str(copy)).count()
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey % 2 = 0").coalesce(1).write.parquet(str(tmp_path / "half"))
    shutil.copy(next((tmp_path / "half").glob("part-*")), copy / "orders.parquet")
    assert TT.source_key(spark, str(copy)) != key
    assert 0 < TT.training_table(spark, str(copy)).count() < rows


def test_a_file_has_one_digest_however_it_is_dealt_to_tasks(spark, tmp_path):
    import hashlib
    import random
    content = random.Random(3).randbytes(10_001)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "one").write_bytes(content)
    whole = lambda data: hashlib.sha256("".join(hashlib.sha256(data[k:k + 1000]).hexdigest()
                                                for k in range(0, len(data), 1000)).encode()).hexdigest()
    for task_blocks in (1, 2, 3, 11, 50):
        got = {r["file"]: (r["bytes"], r["digest"]) for r in FS.file_checksums(
            spark, str(tmp_path / "d"), task_blocks=task_blocks, block_bytes=1000).collect()}
        assert got == {"one": (10_001, whole(content))}


def test_the_last_line_of_a_code_wins_across_blocks_and_files(spark, tmp_path):
    import random
    rng, want = random.Random(4), {}
    (tmp_path / "ref").mkdir()
    for part in range(3):
        with open(tmp_path / "ref" / f"part-{part:05d}", "w") as f:
            for k in range(2000):
                code, text = f"C{rng.randrange(300)}", f"text {part} {k}"
                f.write(f"{'REF':6}{code:7}{'':64}{text}\n")
                want[code] = text
            f.write(f"{'REF':6}{code:7}{'':64}\n")  # without a text: no line of the code
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = FS.fixed_width_reference(spark, str(tmp_path / "ref")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r["code"]: r["description"] for r in got} == want
    assert sum(r["n_lines"] for r in got) == 6000 and all(r["conflicting"] for r in got if r["n_lines"] > 1)


def test_the_package_travels_as_a_zip(tmp_path):
    import io
    import os
    import zipfile

    from vitalis import ship
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    names = zipfile.ZipFile(io.BytesIO(ship.archive(root))).namelist()
    assert {"vitalis/__init__.py", "vitalis/ship.py", "vitalis/streaming/alerts.py"} <= set(names)
    assert all(n.startswith("vitalis/") and n.endswith(".py") for n in names)
