"""Monitoring queries (2.13): batch forms with oracles, streaming forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.plans.registry import register
from vitalis.session import scratch
from vitalis.sources import fixtures as FX
from vitalis.streaming import monitor as MO

TUMBLE = "SELECT *, time_bucket(INTERVAL '6 hours', ts) AS window_start FROM requests"
SLIDE = ("SELECT r.*, time_bucket(INTERVAL '1 hour', r.ts) - to_hours(k.k) AS window_start "
         "FROM requests r, (SELECT unnest(range(6)) AS k) k")
DUR = [float(b) for b in S.DURATION_BUCKETS]
CONF = [float(b) for b in S.CONFIDENCE_BUCKETS]


def _lst(xs):
    return "[" + ", ".join(repr(x) for x in xs) + ", 'inf'::DOUBLE]"


def _hist_sql(src: str, value: str, bounds: list[float]) -> str:
    return f"""
WITH w AS ({src})
SELECT window_start, le, count(*) FILTER (WHERE {value} <= le) AS count
FROM w, (SELECT unnest({_lst(bounds)}) AS le) b GROUP BY window_start, le"""


def _p95_cte(src: str) -> str:
    b = DUR + [float("inf")]
    cnt = ", ".join(f"count(*) FILTER (WHERE duration_s <= {x!r})" if x != float("inf") else "count(*)" for x in b)
    ub = _lst(DUR)
    lb = "[0.0, " + ", ".join(repr(x) for x in DUR) + "]"
    return f"""
g AS (SELECT window_start, count(*) AS n, quantile_cont(duration_s, 0.95) AS exact, [{cnt}] AS c FROM ({src}) s
      GROUP BY window_start),
h AS (SELECT *, list_position(list_transform(c, lambda x: x >= 0.95E0 * n), true) AS b,
        list_concat([0], c[1:{len(b) - 1}]) AS prev FROM g),
p AS (SELECT window_start, n AS requests,
        CASE WHEN b = {len(b)} THEN {DUR[-1]!r}
          ELSE {lb}[b] + ({ub}[b] - {lb}[b]) * (0.95E0 * n - prev[b]) / (c[b] - prev[b]) END AS p95_bucket,
        round(exact, 6) AS p95_exact FROM h)"""


def _avg_conf_cte(src: str) -> str:
    return f"""
ac AS (SELECT window_start, count(*) AS predictions, round(sum(confidence) / count(*), 6) AS avg_confidence,
       sum(confidence) / count(*) AS raw_confidence
       FROM ({src}) s GROUP BY window_start)"""


def _series_sql() -> str:
    return f"""
WITH ec AS (SELECT window_start, count(*) FILTER (WHERE status >= 400) AS errors FROM ({SLIDE}) s GROUP BY window_start),
{_p95_cte(SLIDE)},
{_avg_conf_cte(SLIDE)},
ser AS (
  SELECT 'HighErrorRate' AS rule, window_start, CAST(errors AS DOUBLE) AS value, errors > 5 AS condition FROM ec
  UNION ALL SELECT 'HighPredictionDuration', window_start, p95_bucket, p95_bucket > 1.0 FROM p
  UNION ALL SELECT 'LowAverageConfidence', window_start, avg_confidence, raw_confidence < 0.5 FROM ac),
t AS (SELECT rule, window_start, value,
        CAST(epoch(window_start) / 3600 AS BIGINT) - row_number() OVER (PARTITION BY rule ORDER BY window_start) AS island
      FROM ser WHERE condition),
tp AS (SELECT *, row_number() OVER (PARTITION BY rule, island ORDER BY window_start) AS pos,
         CASE rule WHEN 'HighErrorRate' THEN 1 ELSE 6 END AS hold FROM t)
"""


@register("mon_request_count", ["requests"], f"""
SELECT window_start, handler, CAST(CAST(floor(status / 100) AS INT) AS VARCHAR) || 'xx' AS status_class,
  count(*) AS requests FROM ({TUMBLE}) w GROUP BY ALL""")
def q_mon_request_count(spark, sf):
    return MO.request_counts(FX.requests(spark, sf))


@register("mon_error_count", ["requests"], f"""
SELECT window_start, count(*) FILTER (WHERE status >= 400) AS errors, count(*) AS requests FROM ({TUMBLE}) w
GROUP BY window_start""")
def q_mon_error_count(spark, sf):
    return MO.error_counts(FX.requests(spark, sf))


@register("mon_duration_hist", ["requests"], _hist_sql(TUMBLE, "duration_s", DUR))
def q_mon_duration_hist(spark, sf):
    return MO.cumulative_hist(FX.requests(spark, sf), "duration_s", S.DURATION_BUCKETS)


@register("mon_confidence_hist", ["requests"], _hist_sql(TUMBLE, "confidence", CONF))
def q_mon_confidence_hist(spark, sf):
    return MO.cumulative_hist(FX.requests(spark, sf), "confidence", S.CONFIDENCE_BUCKETS)


@register("mon_p95_duration", ["requests"], "WITH " + _p95_cte(TUMBLE).strip() + "\nSELECT * FROM p")
def q_mon_p95_duration(spark, sf):
    return MO.hist_quantile(FX.requests(spark, sf), "duration_s", 0.95, S.DURATION_BUCKETS)


@register("mon_avg_confidence", ["requests"], "WITH " + _avg_conf_cte(SLIDE).strip() + "\nSELECT window_start, predictions, avg_confidence FROM ac")
def q_mon_avg_confidence(spark, sf):
    return MO.avg_confidence(FX.requests(spark, sf))


def _alert(rule):
    return _series_sql() + f"SELECT rule, window_start, value FROM tp WHERE rule = '{rule}' AND pos > hold"


@register("mon_alert_errors", ["requests"], _alert("HighErrorRate"))
def q_mon_alert_errors(spark, sf):
    return MO.alerts(MO.rule_series(FX.requests(spark, sf)), "HighErrorRate")


@register("mon_alert_duration", ["requests"], _alert("HighPredictionDuration"))
def q_mon_alert_duration(spark, sf):
    return MO.alerts(MO.rule_series(FX.requests(spark, sf)), "HighPredictionDuration")


@register("mon_alert_confidence", ["requests"], _alert("LowAverageConfidence"))
def q_mon_alert_confidence(spark, sf):
    return MO.alerts(MO.rule_series(FX.requests(spark, sf)), "LowAverageConfidence")


@register("mon_hold_for", ["requests"], _series_sql() + """
SELECT rule, min(window_start) AS island_start, max(window_start) AS island_end, count(*) AS windows,
  count(*) > max(hold) AS fires,
  CASE WHEN count(*) > max(hold) THEN min(window_start) + to_seconds(max(hold) * 3600) END AS fires_at
FROM tp GROUP BY rule, island""")
def q_mon_hold_for(spark, sf):
    return MO.hold_for(MO.rule_series(FX.requests(spark, sf)))


@register("mon_model_info", ["requests"], """
SELECT handler, max_by(model_version, (ts, event_id)) AS model_version, max(ts) AS last_seen FROM requests GROUP BY handler""")
def q_mon_model_info(spark, sf):
    return MO.model_info(FX.requests(spark, sf))


@register("mon_totals", ["requests"], """
SELECT count(*) AS requests, count(*) FILTER (WHERE status >= 400) AS errors FROM requests""")
def q_mon_totals(spark, sf):
    return MO.totals(FX.requests(spark, sf))


#: Windows that the watermark has closed once all events are read: the stream's answer.
CLOSED = "window_start + INTERVAL {hours} HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM requests)"


def _closed(sql: str, hours: int = 6) -> str:
    return f"SELECT * FROM ({sql}) x WHERE " + CLOSED.format(hours=hours)


def _streamed(spark, sf, make, name):
    """Drain a windowed aggregate of the event stream in append mode: the
    windows that the watermark closed, and the number of rows it dropped."""
    out = scratch(spark, name)
    late = MO.run_to_parquet(make(MO.stream_requests(spark, sf).withWatermark("ts", MO.WATERMARK)), out, out + "-ckpt")
    df = spark.read.parquet(out)
    return df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), late


@register("mon_stream_errors", ["requests"], _closed(f"""
SELECT window_start, count(*) FILTER (WHERE status >= 400) AS errors, count(*) AS requests FROM ({TUMBLE}) w
GROUP BY window_start"""))
def q_mon_stream_errors(spark, sf):
    """Streaming form of ``mon_error_count``: watermark 10 minutes, append
    mode, so only windows closed by the watermark are emitted; late rows
    are counted by ``mon_stream_late_rows``."""
    return _streamed(spark, sf, MO.error_counts, "stream-errors")[0]


@register("mon_stream_request_count", ["requests"], _closed(f"""
SELECT window_start, handler, CAST(CAST(floor(status / 100) AS INT) AS VARCHAR) || 'xx' AS status_class,
  count(*) AS requests FROM ({TUMBLE}) w GROUP BY ALL"""))
def q_mon_stream_request_count(spark, sf):
    return _streamed(spark, sf, MO.request_counts, "stream-requests")[0]


@register("mon_stream_duration_hist", ["requests"], _closed(_hist_sql(TUMBLE, "duration_s", DUR)))
def q_mon_stream_duration_hist(spark, sf):
    return _streamed(spark, sf, lambda d: MO.cumulative_hist(d, "duration_s", S.DURATION_BUCKETS), "stream-durations")[0]


@register("mon_stream_confidence_hist", ["requests"], _closed(_hist_sql(TUMBLE, "confidence", CONF)))
def q_mon_stream_confidence_hist(spark, sf):
    return _streamed(spark, sf, lambda d: MO.cumulative_hist(d, "confidence", S.CONFIDENCE_BUCKETS), "stream-confidences")[0]


@register("mon_stream_p95_duration", ["requests"], _closed(
    "WITH " + _p95_cte(TUMBLE).strip() + "\nSELECT window_start, requests, p95_bucket FROM p"))
def q_mon_stream_p95_duration(spark, sf):
    return _streamed(spark, sf, lambda d: MO.hist_quantile(d, "duration_s", 0.95, S.DURATION_BUCKETS, exact=False)
                     .drop("p95_exact"), "stream-p95")[0]


@register("mon_stream_avg_confidence", ["requests"], _closed(
    "WITH " + _avg_conf_cte(SLIDE).strip() + "\nSELECT window_start, predictions, avg_confidence FROM ac"))
def q_mon_stream_avg_confidence(spark, sf):
    return _streamed(spark, sf, MO.avg_confidence, "stream-avg-confidence")[0]


@register("mon_stream_late_rows")
def q_mon_stream_late_rows(spark, sf):
    """How many rows of the landed events the watermark dropped."""
    late = _streamed(spark, sf, MO.error_counts, "stream-late")[1]
    return spark.createDataFrame([("error_count", late)], "stream string, late_rows long")


def _latest(spark, sf, make, name):
    """Drain an all-time aggregate (complete mode) and read its last state."""
    out = scratch(spark, name)
    last = MO.run_latest(make(MO.stream_requests(spark, sf)), out, out + "-ckpt")
    return spark.read.parquet(f"{out}/batch={last}")


@register("mon_stream_model_info", ["requests"], """
SELECT handler, max_by(model_version, (ts, event_id)) AS model_version, max(ts) AS last_seen FROM requests GROUP BY handler""")
def q_mon_stream_model_info(spark, sf):
    return _latest(spark, sf, MO.model_info, "stream-model-info").withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))


@register("mon_stream_totals", ["requests"], """
SELECT count(*) AS requests, count(*) FILTER (WHERE status >= 400) AS errors FROM requests""")
def q_mon_stream_totals(spark, sf):
    """Streaming ``mon_totals``: a stateful running count in complete mode."""
    return _latest(spark, sf, MO.totals, "stream-totals")


@register("mon_stream_alerts", ["requests"], _closed(
    _series_sql() + "SELECT rule, window_start, value, pos AS run_length FROM tp WHERE pos > hold"))
def q_mon_stream_alerts(spark, sf):
    """Streaming hold-for: per rule, event-time state keeps the start of
    the current run of true windows; output when the hold is exceeded."""
    from vitalis.streaming.alerts import stream_alerts
    out = stream_alerts(spark, sf)
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
