"""Streaming alert evaluation with hold-for state.

Query 1 turns the event stream into the per-window rule series (sliding
event-time windows, watermark, append mode: a window is emitted once the
watermark closes it). Query 2 reads that series as a stream and keeps, per
rule, the start and length of the current run of true windows in
``applyInPandasWithState``; a rule fires once its run exceeds the hold.
Both queries checkpoint, so a restart resumes instead of recounting.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vitalis.session import checkpoint_dir
from vitalis.streaming import monitor as MO

OUT_SCHEMA = "rule string, window_start timestamp, value double, run_length long"
STATE_SCHEMA = "last_k long, run long"


def _hold_step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rule = key[0]
    hold = MO.HOLD_STEPS[rule]
    last_k, run = state.get if state.exists else (None, 0)
    rows = []
    # The whole group in order of time, however many batches it comes in: one row
    # per closed window of the rule, so it is bounded by time span / slide.
    for r in pd.concat(list(pdfs)).sort_values("window_start").itertuples(index=False):
        k = int(pd.Timestamp(r.window_start).value // 1_000_000_000 // MO.SLIDE_SECONDS)
        if r.condition:
            run = run + 1 if last_k is not None and k == last_k + 1 else 1
            last_k = k
            if run > hold:
                rows.append((rule, r.window_start, float(r.value), run))
        else:
            last_k, run = k, 0
    state.update((last_k, run))
    yield pd.DataFrame(rows, columns=["rule", "window_start", "value", "run_length"])


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = checkpoint_dir(spark).rstrip("/") + f"/vitalis-alerts-{uuid.uuid4().hex}"
    st = MO.stream_requests(spark, sf_dir).withWatermark("ts", MO.WATERMARK)
    series = MO.rule_series(st)
    MO.run_to_parquet(series, f"{base}/series", f"{base}/series-ckpt", "append")

    s2 = spark.readStream.schema(spark.read.parquet(f"{base}/series").schema).parquet(f"{base}/series")
    fired = s2.groupBy("rule").applyInPandasWithState(
        _hold_step, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
    MO.run_to_parquet(fired, f"{base}/alerts", f"{base}/alerts-ckpt", "append")
    return spark.read.parquet(f"{base}/alerts")
