"""Window queries on events (beyond the parity operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestack.plans.registry import query
from lodestack.plans.views import table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS events FROM events GROUP BY ALL")
def ext_tumbling(spark, sf_dir):
    rows = _events(spark, sf_dir).groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return rows.select("event_type", F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("window_start"), "events")


@query("SELECT strftime(s, '%Y-%m-%d %H:%M') AS window_start, count(*) AS events FROM (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS s FROM events) GROUP BY ALL")
def ext_sliding(spark, sf_dir):
    rows = _events(spark, sf_dir).groupBy(F.window("ts", "2 hours", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return rows.select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("window_start"), "events")


@query("""WITH marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
  numbered AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM marked)
  SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS events FROM numbered GROUP BY user_id, n""")
def ext_session(spark, sf_dir):
    rows = _events(spark, sf_dir).groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return rows.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "events")
