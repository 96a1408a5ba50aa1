"""Section O: Structured Streaming jobs, driven with availableNow over the
fixture folder; each result is compared with the batch SQL answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialflow.functions.stats import rnd, rnd_half_up
from vialflow.plans.registry import register
from vialflow.streaming import streams as S


@register("stream_latest_per_source", sql="""
WITH l AS (SELECT user_id, max(ts) AS last_ts, arg_max(event_type, (ts, event_id)) AS last_kind, count(*) AS n_events
           FROM events GROUP BY user_id)
SELECT user_id, epoch_us(last_ts) AS last_ts_us, last_kind, n_events,
       last_ts < (SELECT max(last_ts) FROM l) - INTERVAL 1 DAY AS silent FROM l
""")
def stream_latest_per_source(spark, sf):
    ev = S.table_stream(spark, sf, "events")
    latest = S.run_updates(S.latest_per_source(ev, "user_id", "ts", "event_type", "event_id"), ["user_id"], "latest")
    out = S.silent_flag(latest, "1 day")
    return out.select("user_id", F.unix_micros(F.col("last_ts").cast("timestamp")).alias("last_ts_us"), "last_kind",
                      "n_events", "silent")


@register("stream_window_counts", sql="""
SELECT epoch_us(w) AS window_start_us, event_type, count(*) AS n
FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, event_type FROM events)
WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
GROUP BY w, event_type
""")
def stream_window_counts(spark, sf):
    ev = S.table_stream(spark, sf, "events")
    w = S.run_available(S.windowed_counts(ev, "ts", "event_type", "1 hour", "10 minutes"), "windows")
    return w.select(F.unix_micros("window_start").alias("window_start_us"), "event_type", "n")


@register("stream_arm_state", sql="""
SELECT user_id, event_type AS arm, count(*) AS pulls, round(sum(value / 500.0), 6) AS total,
       round(avg(value / 500.0) + sign(avg(value / 500.0)) * 1e-9, 6) AS mean FROM events GROUP BY user_id, event_type
""")
def stream_arm_state(spark, sf):
    ev = S.table_stream(spark, sf, "events").withColumnRenamed("event_type", "arm")
    st = S.run_updates(S.arm_state(ev, "user_id", "arm", F.col("value") / 500.0), ["user_id", "arm"], "arms")
    return st.select("user_id", "arm", "pulls", rnd("total").alias("total"), rnd_half_up("mean").alias("mean"))


@register("stream_best_alerts", sql="""
WITH r AS (SELECT user_id, event_id, value, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_best
           FROM events WHERE value IS NOT NULL)
SELECT user_id, event_id, value, previous_best FROM r WHERE previous_best IS NULL OR value > previous_best
""")
def stream_best_alerts(spark, sf):
    ev = S.table_stream(spark, sf, "events")
    return S.best_alerts(ev)
