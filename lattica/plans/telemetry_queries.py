"""Telemetry queries: events stand in for a step log, one run per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.operators import telemetry as M
from lattica.plans.registry import query, table

RUN = ["user_id"]


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


@query("with e as (select event_id, user_id, value, count(*) over w as n, quantile_cont(value, 0.95) over w as p from events window w as (partition by user_id order by event_id rows between 4 preceding and current row)) select event_id, round(case when n = 5 then least(p, 90) end, 6) as clip from e")
def rolling_p95(spark: SparkSession, sf: str) -> DataFrame:
    """Percentile of the last five values, once there are five, capped."""
    return M.rolling_percentile(_events(spark, sf), "value", ["event_id"], 5, 0.95, 90.0, RUN).select("event_id", F.round("clip", 6).alias("clip"))


@query("with e as (select event_id, user_id, row_number() over (partition by user_id order by event_id) as step, event_id % 10 as x, round(value * 10)::bigint as y from events), f as (select event_id, step, regr_slope(y, x) over w as s, regr_intercept(y, x) over w as i from e window w as (partition by user_id order by event_id rows between 7 preceding and current row)) select event_id, round(s, 9) as slope, round(i, 9) as intercept from f where step % 4 = 0")
def rolling_regr(spark: SparkSession, sf: str) -> DataFrame:
    """Regression over the last eight rows, at every fourth."""
    rows = _events(spark, sf).select("event_id", "user_id", (F.col("event_id") % 10).alias("x"), F.round(F.col("value") * 10).cast("long").alias("y"))
    return M.rolling_regression(rows, "x", "y", ["event_id"], 8, 4, RUN).select("event_id", F.round("slope", 9).alias("slope"), F.round("intercept", 9).alias("intercept"))


@query("with recursive e as (select user_id, value, row_number() over (partition by user_id order by event_id) as i, count(*) over (partition by user_id) as n from events), r as (select user_id, i, n, value as ema from e where i = 1 union all select e.user_id, e.i, e.n, r.ema * 0.9 + e.value * 0.1 from r join e on e.user_id = r.user_id and e.i = r.i + 1) select user_id, round(ema, 6) as ema from r where i = n")
def ema(spark: SparkSession, sf: str) -> DataFrame:
    """W12."""
    return M.ema(_events(spark, sf), "value", ["event_id"], 0.9, RUN).withColumn("ema", F.round("ema", 6))


@query("with e as (select event_id, user_id, floor(epoch(ts))::bigint as t, count(*) over w as done, max(floor(epoch(ts))::bigint) over w - min(floor(epoch(ts))::bigint) over w as spent from events window w as (partition by user_id order by event_id rows unbounded preceding)) select event_id, done::bigint as done, round(spent / done, 5) as avg, round(spent / done * (500 - done), 5) as eta from e")
def progress(spark: SparkSession, sf: str) -> DataFrame:
    """Rate and time left."""
    rows = _events(spark, sf).withColumn("t", F.unix_timestamp("ts"))
    return M.progress(rows, "t", ["event_id"], 500, RUN).select("event_id", "done", F.round("avg", 5).alias("avg"), F.round("eta", 5).alias("eta"))


@query("select least(floor((event_id % 1000) / 1000.0::double * 10), 9)::int as bin, round(avg(round(value * 100)::bigint), 4) as mean, count(*)::bigint as n from events group by 1")
def time_bins(spark: SparkSession, sf: str) -> DataFrame:
    """A19."""
    rows = _events(spark, sf).select((F.col("event_id") % 1000 / 1000).alias("t"), F.round(F.col("value") * 100).cast("long").alias("v"))
    return M.time_bins(rows, "t", "v").withColumn("mean", F.round("mean", 4))


@query("""
with m as (select event_type, unnest(['loss/mse', 'loss/min', 'time/max']) as key, unnest([round(value * 100)::bigint, event_id % 17, case when event_id % 3 = 0 then event_id end]) as v from events)
select event_type, key, round(case when key like '%min' then min(v) when key like '%max' then max(v) else avg(v) end, 4) as value, count(*)::bigint as n from m where v is not null group by event_type, key
""")
def nested_reduce(spark: SparkSession, sf: str) -> DataFrame:
    """Nested metrics reduced by leaf name."""
    i = F.col("event_id")
    metrics = F.map_filter(
        F.create_map(F.lit("loss/mse"), F.round(F.col("value") * 100).cast("long"), F.lit("loss/min"), i % 17, F.lit("time/max"), F.when(i % 3 == 0, i)), lambda k, v: v.isNotNull()
    )
    rows = M.reduce_metrics(_events(spark, sf).select("event_type", metrics.alias("m")), "m", ["event_type"])
    return rows.withColumn("value", F.round(F.col("value").cast("double"), 4))


@query("select event_type, (json_extract(props, '$.page'))::varchar is not null as has_page, count(*)::bigint as n from events group by 1, 2")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    """JSON text."""
    rows = _events(spark, sf).select("event_type", F.get_json_object("props", "$.page").isNotNull().alias("has_page"))
    return rows.groupBy("event_type", "has_page").agg(F.count("*").alias("n"))


@query("""
with p as (select l_discount as x, l_tax as y from lineitem)
select round(avg(abs(x - y)), 8) as l1, round(avg((x - y) * (x - y)), 8) as l2, round(avg(case when abs(x - y) < 0.05 then (x - y) * (x - y) * 0.5 / 0.05 else abs(x - y) - 0.025 end), 8) as huber,
    round(20 * log10(1 / sqrt(avg((x - y) * (x - y)))), 5) as psnr, round(avg(0.5 * (x * x + exp(y) - y - 1)), 8) as kl, round(avg(greatest(x, 0) - x * y + ln(1 + exp(-abs(x)))), 8) as bce,
    round(1 - (2 * sum(x * y) + 1) / (sum(x) + sum(y) + 1), 8) as dice from p
""")
def losses(spark: SparkSession, sf: str) -> DataFrame:
    """A24, A25."""
    x, y = F.col("l_discount"), F.col("l_tax")
    out = {"l1": M.l1(x, y), "l2": M.l2(x, y), "huber": M.smooth_l1(x, y, 0.05), "psnr": M.psnr(x, y), "kl": M.kl(x, y), "bce": M.bce_logits(x, y), "dice": M.dice(x, y)}
    return table(spark, sf, "lineitem").agg(*[F.round(c, 5 if k == "psnr" else 8).alias(k) for k, c in out.items()])
