"""Monitoring over request/prediction events (inventory 2.13).

The same expressions serve the batch form (oracle-checked) and the
Structured Streaming form: event-time ``window`` aggregates with a
watermark, conditional counts for histograms, bucket-interpolated
quantiles, threshold rules, and a hold-for rule (gaps and islands in batch,
event-time state in streaming).

Production windows are minutes; the fixture stream is sparse (10k events
in 30 days at sf0.01), so sizes are parameters (6 h windows, 1 h slide).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis import schemas as S

WINDOW = "6 hours"
SLIDE = "1 hour"
WATERMARK = "10 minutes"


def status_class(c: str = "status") -> Column:
    return F.concat((F.col(c) / 100).cast("int").cast("string"), F.lit("xx"))


def is_error(c: str = "status") -> Column:
    return F.col(c) >= 400


def windowed(df: DataFrame, size: str = WINDOW, slide: str | None = None) -> Column:
    return F.window("ts", size, slide) if slide else F.window("ts", size)


def request_counts(df: DataFrame, size: str = WINDOW) -> DataFrame:
    """``mon_request_count``: requests per window, handler, status class."""
    return (df.groupBy(windowed(df, size).alias("w"), "handler", status_class().alias("status_class"))
              .agg(F.count(F.lit(1)).alias("requests"))
              .select(F.col("w.start").alias("window_start"), "handler", "status_class", "requests"))


def error_counts(df: DataFrame, size: str = WINDOW, slide: str | None = None) -> DataFrame:
    """``mon_error_count``: errors (status >= 400) and requests per window."""
    return (df.groupBy(windowed(df, size, slide).alias("w"))
              .agg(F.count_if(is_error()).alias("errors"), F.count(F.lit(1)).alias("requests"))
              .select(F.col("w.start").alias("window_start"), "errors", "requests"))


def _bounds(buckets: Sequence[float]) -> list[float]:
    return [float(b) for b in buckets] + [float("inf")]


def cumulative_hist(df: DataFrame, value: str, buckets: Sequence[float], size: str = WINDOW,
                    slide: str | None = None) -> DataFrame:
    """``mon_duration_hist`` / ``mon_confidence_hist``: cumulative ``le``
    counts per window in one conditional-count pass, then one row per bound."""
    bounds = _bounds(buckets)
    aggs = [F.count_if(F.col(value) <= F.lit(b)).alias(f"c{i}") for i, b in enumerate(bounds)]
    g = df.groupBy(windowed(df, size, slide).alias("w")).agg(*aggs, F.count(F.lit(1)).alias("n"))
    pairs = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"c{i}").alias("count")) for i, b in enumerate(bounds)])
    return g.select(F.col("w.start").alias("window_start"), F.inline(pairs))


def _bucket_quantile(q: float, bounds: list[float], n: str = "n") -> Column:
    """Quantile estimate from cumulative ``le`` count columns ``c0..ck``:
    linear interpolation inside the first bucket whose cumulative count
    reaches ``q * n`` (lower bound 0 for the first bucket; the open top
    bucket returns the highest finite bound)."""
    cum = F.array(*[F.col(f"c{i}").cast("double") for i in range(len(bounds))])
    ub = F.array(*[F.lit(b) for b in bounds])
    lb = F.array(F.lit(0.0), *[F.lit(b) for b in bounds[:-1]])
    prev = F.array(F.lit(0.0), *[F.col(f"c{i}").cast("double") for i in range(len(bounds) - 1)])
    rank = F.lit(q) * F.col(n)
    b = F.array_position(F.transform(cum, lambda c: c >= rank), True).cast("int")
    top = F.lit(float(bounds[-2]))
    lo, hi = F.element_at(lb, b), F.element_at(ub, b)
    cp, cb = F.element_at(prev, b), F.element_at(cum, b)
    return F.when(b == len(bounds), top).otherwise(lo + (hi - lo) * (rank - cp) / (cb - cp))


def hist_quantile(df: DataFrame, value: str, q: float, buckets: Sequence[float], size: str = WINDOW,
                  slide: str | None = None, exact: bool = True) -> DataFrame:
    """``mon_p95_duration``: bucket-interpolated quantile per window (see
    :func:`_bucket_quantile`) from one conditional-count pass, plus the
    exact percentile for comparison."""
    bounds = _bounds(buckets)
    aggs = [F.count_if(F.col(value) <= F.lit(b)).alias(f"c{i}") for i, b in enumerate(bounds)]
    ex = F.percentile(value, q) if exact else F.lit(None).cast("double")
    g = df.groupBy(windowed(df, size, slide).alias("w")).agg(*aggs, F.count(F.lit(1)).alias("n"), ex.alias("exact"))
    return g.select(F.col("w.start").alias("window_start"), F.col("n").alias("requests"),
                    # unrounded: the same IEEE arithmetic in any engine gives the
                    # same double, while engine-side rounding differs at ties
                    _bucket_quantile(q, bounds).alias(f"p{int(q * 100)}_bucket"),
                    F.round("exact", 6).alias(f"p{int(q * 100)}_exact"))


def avg_confidence(df: DataFrame, size: str = WINDOW, slide: str | None = SLIDE) -> DataFrame:
    """``mon_avg_confidence``: sum / count of confidence per sliding window."""
    g = df.groupBy(windowed(df, size, slide).alias("w")).agg(
        F.sum("confidence").alias("_s"), F.count(F.lit(1)).alias("predictions"))
    return g.select(F.col("w.start").alias("window_start"), "predictions",
                    F.round(F.col("_s") / F.col("predictions"), 6).alias("avg_confidence"))


def rule_series(df: DataFrame, size: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Per sliding window, the value and condition of each alert rule:
    errors > 5, bucket p95 of duration > 1 s, mean confidence < 0.5. One
    windowed aggregate feeds all three rules (one pass over the events, one
    state store when streaming); an empty window has no row, hence no value
    and no alert."""
    bounds = _bounds(S.DURATION_BUCKETS)
    g = df.groupBy(windowed(df, size, slide).alias("w")).agg(
        F.count_if(is_error()).alias("errors"),
        *[F.count_if(F.col("duration_s") <= F.lit(b)).alias(f"c{i}") for i, b in enumerate(bounds)],
        F.count(F.lit(1)).alias("n"), F.sum("confidence").alias("_conf"))
    p95 = _bucket_quantile(0.95, bounds)
    avg = F.col("_conf") / F.col("n")  # the rule tests the raw mean; only the shown value is rounded
    errors = F.col("errors").cast("double")
    rules = F.array(
        F.struct(F.lit("HighErrorRate").alias("rule"), errors.alias("value"),
                 (F.col("errors") > S.ALERT_ERROR_INCREASE).alias("condition")),
        F.struct(F.lit("HighPredictionDuration").alias("rule"), p95.alias("value"),
                 (p95 > S.ALERT_P95_SECONDS).alias("condition")),
        F.struct(F.lit("LowAverageConfidence").alias("rule"), F.round(avg, 6).alias("value"),
                 (avg < S.ALERT_MIN_CONFIDENCE).alias("condition")))
    return (g.select(F.col("w.start").alias("window_start"), F.explode(rules).alias("r"))
             .select("r.rule", "window_start", "r.value", "r.condition"))


# Hold times per rule, in slide steps (1 minute of 5 -> 1 step; 5 of 5 -> 6).
HOLD_STEPS = {"HighErrorRate": 1, "HighPredictionDuration": 6, "LowAverageConfidence": 6}
SLIDE_SECONDS = 3600


def hour_index(c: str, slide_seconds: int = SLIDE_SECONDS) -> Column:
    """Slide-step index of a zone-free window start (no session time zone
    involved, so DST or cluster zone settings cannot shift it)."""
    secs = F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")
    return F.floor(secs / slide_seconds).cast("long")


def hold_for(series: DataFrame, hold_steps: dict[str, int] = HOLD_STEPS, slide_seconds: int = SLIDE_SECONDS
             ) -> DataFrame:
    """``mon_hold_for``: gaps and islands. Consecutive true windows (no gap
    larger than one slide) form an island; the rule fires from the window
    where it has been true for ``hold`` steps. The window is per rule,
    whose row count is bounded by time span / slide, not by events."""
    t = series.where(F.col("condition"))
    w = Window.partitionBy("rule").orderBy("window_start")
    t = t.withColumn("_k", hour_index("window_start", slide_seconds))
    t = t.withColumn("_island", F.col("_k") - F.row_number().over(w))
    isl = t.groupBy("rule", "_island").agg(F.min("window_start").alias("island_start"),
                                           F.max("window_start").alias("island_end"),
                                           F.count(F.lit(1)).alias("windows"))
    hold = F.create_map(*[x for k, v in hold_steps.items() for x in (F.lit(k), F.lit(v))])
    h = hold[F.col("rule")]
    return isl.select("rule", "island_start", "island_end", "windows",
                      (F.col("windows") > h).alias("fires"),
                      F.when(F.col("windows") > h, F.col("island_start") + F.make_dt_interval(
                          hours=F.lit(0), mins=F.lit(0), secs=(h * slide_seconds).cast("decimal(18,6)")))
                       .alias("fires_at"))


def alerts(series: DataFrame, rule: str, hold_steps: dict[str, int] = HOLD_STEPS) -> DataFrame:
    """``mon_alert_*``: windows where ``rule`` is firing (true for longer
    than its hold)."""
    s = series.where(F.col("rule") == rule)
    w = Window.partitionBy("rule").orderBy("window_start")
    t = s.where(F.col("condition")).withColumn("_k", hour_index("window_start", SLIDE_SECONDS))
    t = t.withColumn("_island", F.col("_k") - F.row_number().over(w))
    t = t.withColumn("_pos", F.row_number().over(Window.partitionBy("rule", "_island").orderBy("window_start")))
    return t.where(F.col("_pos") > hold_steps[rule]).select("rule", "window_start", "value")


def model_info(df: DataFrame) -> DataFrame:
    """``mon_model_info``: current model version per handler (latest event)."""
    return df.groupBy("handler").agg(F.max_by("model_version", F.struct("ts", "event_id")).alias("model_version"),
                                     F.max("ts").alias("last_seen"))


def totals(df: DataFrame) -> DataFrame:
    """``mon_totals``: all-time request and error totals."""
    return df.agg(F.count(F.lit(1)).alias("requests"), F.count_if(is_error()).alias("errors"))


# --- Structured Streaming ---------------------------------------------------------

def stream_requests(spark, sf_dir: str) -> DataFrame:
    """Event stream over the landed ``events`` parquet: same columns as the
    batch view, ``ts`` cast to ``timestamp`` for the watermark."""
    from vitalis.sources.tables import table
    schema = table(spark, sf_dir, "events").schema
    # A pattern, as a stream's path may be one file or a folder of part files.
    ev = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    return ev.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("handler"),
        F.when(F.col("event_type") == "error", 500).when(F.col("event_id") % 10 == 0, 422).otherwise(200).alias("status"),
        (F.col("value") / 100.0).alias("duration_s"),
        F.when(F.col("value") > 150, 1.0).otherwise(0.25 + F.col("value") / 200.0).alias("confidence"),
        F.when(F.col("event_id") % 3 == 0, "v2").otherwise("v1").alias("model_version"))


def run_to_parquet(stream_df: DataFrame, out_path: str, ckpt: str, mode: str = "append") -> int:
    """Drain what has landed (``availableNow``) into a parquet sink with a
    checkpoint, so a restarted query resumes instead of recounting. Returns
    how many rows the watermark dropped as too late."""
    q = (stream_df.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", ckpt)
                  .trigger(availableNow=True).start(out_path))
    q.awaitTermination()
    return late_rows(q)


def run_latest(stream_df: DataFrame, out_path: str, ckpt: str) -> int:
    """As :func:`run_to_parquet` for a result that is updated as a whole
    (complete mode): each batch writes it anew, in a folder of its own that a
    repeated batch overwrites. Returns the number of the last batch."""
    last = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        last.append(number)

    q = (stream_df.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", ckpt)
                  .trigger(availableNow=True).start())
    q.awaitTermination()
    return last[-1] if last else -1


def late_rows(query) -> int:
    """Rows that a finished query's stateful operators dropped as too late."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in json.loads(p.json)["stateOperators"])
