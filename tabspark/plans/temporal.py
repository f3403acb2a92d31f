"""Strict-past features, as-of lookups, densities and runs over events, orders and the schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabspark.functions.times import micros
from tabspark.operators import temporal as t
from tabspark.operators.evaluation import calibrated, cohort, interval_metrics
from tabspark.plans.registry import Catalogue
from tabspark.session import table

CATALOGUE = Catalogue()
_E = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us FROM events)"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", micros(F.col("ts")).alias("us"))




@CATALOGUE.add(f"""WITH {_E} SELECT event_id, lag(value, 1) OVER w AS lag_1, lag(value, 2) OVER w AS lag_2, lag(value, 3) OVER w AS lag_3, lag(value, 5) OVER w AS lag_5,
row_number() OVER w - 1 AS prior_count,
CASE WHEN lag(us, 1) OVER w IS NOT NULL THEN round(least((us - lag(us, 1) OVER w) / 86400000000.0, 180.0), 6) END AS days_since_1,
CASE WHEN lag(us, 3) OVER w IS NOT NULL THEN round(least((us - lag(us, 3) OVER w) / 86400000000.0, 365.0), 6) END AS days_since_3,
CASE WHEN us // 86400000000 - lag(us // 86400000000, 1) OVER w = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS next_day
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)""")
def lag_chain(spark: SparkSession, d: str) -> DataFrame:
    """WIN-01, 02, 06, 07."""
    cut = t.sliced(_events(spark, d), "user_id", "us", "event_id", 5)
    w = t.slice_window("user_id")
    out = cut.select(
        "event_id", "user_id", "__own", "__slice", "__pos",
        *[F.lag("value", n).over(w).alias(f"lag_{n}") for n in (1, 2, 3, 5)],
        F.col("__pos").alias("prior_count"),
        F.round(t.days_since(F.col("us"), w, 1, 180), 6).alias("days_since_1"),
        F.round(t.days_since(F.col("us"), w, 3, 365), 6).alias("days_since_3"),
        t.next_calendar_day(F.col("us"), w).alias("next_day"),
    )
    return t.drop_halo(out).drop("user_id")


@CATALOGUE.add(f"""WITH {_E} SELECT event_id, round(avg(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS mean_3,
round(avg(value) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS mean_10, round(avg(value) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 6) AS mean_20,
CASE WHEN count(value) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) >= 3 THEN round(stddev_samp(value) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) END AS std_10
FROM (SELECT * REPLACE (nullif(value, round(value)) AS value) FROM e) WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)""")
def lagged_rolling_mean_std(spark: SparkSession, d: str) -> DataFrame:
    """WIN-03, 04; whole values count as unknown."""
    events = _events(spark, d).withColumn("value", F.nullif(F.col("value"), F.round("value")))
    cut = t.sliced(events, "user_id", "us", "event_id", 20)
    w, x = t.slice_window("user_id"), F.col("value")
    out = cut.select("event_id", "__own", "__slice", "__pos", *[F.round(t.lagged_mean(x, w, n), 6).alias(f"mean_{n}") for n in (3, 10, 20)], F.round(t.lagged_std(x, w, 10), 6).alias("std_10"))
    return t.drop_halo(out)


@CATALOGUE.add("""WITH g AS (SELECT c_nationkey, o_orderdate, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
r AS (SELECT *, round(avg(total) OVER (PARTITION BY c_nationkey ORDER BY o_orderdate ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 4) AS allowed_mean_10 FROM g)
SELECT o_orderkey, allowed_mean_10 FROM orders JOIN customer ON o_custkey = c_custkey JOIN r USING (c_nationkey, o_orderdate)""")
def opponent_allowed(spark: SparkSession, d: str) -> DataFrame:
    """WIN-05, AGG-01, JN-01: what a nation's customers ordered on earlier days, back on each order."""
    orders = table(spark, d, "orders").join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    days = orders.groupBy("c_nationkey", "o_orderdate").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    cut = t.sliced(days.withColumn("us", micros(F.col("o_orderdate"))), "c_nationkey", "us", "o_orderdate", 10)
    past = t.drop_halo(cut.withColumn("allowed_mean_10", F.round(t.lagged_mean(F.col("total"), t.slice_window("c_nationkey"), 10), 4)))
    return orders.join(past.select("c_nationkey", "o_orderdate", "allowed_mean_10"), ["c_nationkey", "o_orderdate"]).select("o_orderkey", "allowed_mean_10")


_CUT = "least(us // 86400000000 * 86400000000, us - 43200000000)"


@CATALOGUE.add(f"""WITH {_E}, h AS (SELECT user_id, us FROM e WHERE event_type = 'purchase'),
u AS (SELECT user_id, us AS k, 1 AS o, NULL AS event_id FROM h UNION ALL SELECT user_id, {_CUT}, 0, event_id FROM e WHERE event_type <> 'purchase'),
r AS (SELECT event_id, sum(o) OVER (PARTITION BY user_id ORDER BY k, o ROWS UNBOUNDED PRECEDING) AS n FROM u)
SELECT event_id, CAST(n AS BIGINT) AS n_before FROM r WHERE event_id IS NOT NULL""")
def asof_prefix_counts(spark: SparkSession, d: str) -> DataFrame:
    """WIN-09: purchases of the user before the cutoff of every other event."""
    events = _events(spark, d)
    asked = events.filter("event_type <> 'purchase'").withColumn("cut", t.asof_cutoff(F.col("us")))
    return t.asof_prefix(events.filter("event_type = 'purchase'"), asked, "user_id", "us", "cut", "event_id").select("event_id", "n_before")


_LAST_W = f"""WITH {_E}, h AS (SELECT user_id, us, event_id, value, row_number() OVER w AS i, {{stats}} FROM e WHERE event_type = 'purchase'
  WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id), f AS (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
u AS (SELECT user_id, us AS k, 1 AS o, NULL AS event_id FROM h UNION ALL SELECT user_id, {_CUT}, 0, event_id FROM e WHERE event_type <> 'purchase'),
r AS (SELECT user_id, event_id, sum(o) OVER (PARTITION BY user_id ORDER BY k, o ROWS UNBOUNDED PRECEDING) AS n FROM u)
SELECT r.event_id, CAST(n AS BIGINT) AS n_before, {{names}} FROM r LEFT JOIN h ON r.user_id = h.user_id AND r.n = h.i WHERE r.event_id IS NOT NULL"""


@CATALOGUE.add(_LAST_W.format(stats="round(avg(value) OVER f, 6) AS mean_10, count(value) OVER f AS known_10", names="mean_10, known_10"))
def asof_last_w_means(spark: SparkSession, d: str) -> DataFrame:
    """WIN-10."""
    events = _events(spark, d)
    asked = events.filter("event_type <> 'purchase'").withColumn("cut", t.asof_cutoff(F.col("us")))
    stats = {"mean_10": F.avg("value"), "known_10": F.count("value")}
    out = t.asof_stats(events.filter("event_type = 'purchase'"), asked, "user_id", "us", "event_id", "cut", "event_id", stats, 10)
    return out.select("event_id", "n_before", F.round("mean_10", 6).alias("mean_10"), "known_10")


@CATALOGUE.add(_LAST_W.format(stats="round(sum(value) OVER f / nullif(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) OVER f, 0), 6) AS value_per_large", names="value_per_large"))
def asof_pooled_ratio(spark: SparkSession, d: str) -> DataFrame:
    """WIN-11, AGG-11: value over the number of large purchases, pooled over the last ten."""
    events = _events(spark, d)
    asked = events.filter("event_type <> 'purchase'").withColumn("cut", t.asof_cutoff(F.col("us")))
    stats = {"total": F.sum("value"), "large": F.sum((F.col("value") > 50).cast("int"))}
    out = t.asof_stats(events.filter("event_type = 'purchase'"), asked, "user_id", "us", "event_id", "cut", "event_id", stats, 10)
    return out.select("event_id", "n_before", F.round(F.when(F.col("large") > 0, F.col("total") / F.col("large")), 6).alias("value_per_large"))


@CATALOGUE.add(f"""WITH {_E}, h AS (SELECT user_id, us // 60000000 * 60000000 AS m, value, event_id FROM e WHERE event_type <> 'signup'),
g AS (SELECT user_id, m, count(*) AS n, bool_and(value >= 2) AS complete, min(event_id) AS latest_id FROM h GROUP BY ALL),
q AS (SELECT event_id, user_id, o.offset_us, us - o.offset_us AS cut FROM e, (VALUES (1800000000), (3600000000), (7200000000)) o(offset_us) WHERE event_type = 'signup'),
j AS (SELECT q.event_id, q.offset_us, g.n, g.complete, g.latest_id, row_number() OVER (PARTITION BY q.event_id, q.offset_us ORDER BY m DESC NULLS LAST) AS k FROM q LEFT JOIN g ON q.user_id = g.user_id AND g.m < q.cut)
SELECT event_id, CAST(offset_us AS BIGINT) AS offset_us, CASE WHEN n IS NULL THEN 'none' WHEN n > 1 THEN 'tied' WHEN NOT complete THEN 'incomplete' ELSE 'found' END AS status,
CASE WHEN n = 1 AND complete THEN latest_id END AS latest_id FROM j WHERE k = 1""")
def asof_latest_unique(spark: SparkSession, d: str) -> DataFrame:
    """WIN-12, JX-10: the last event, by minute, before three cutoffs; ties and incomplete newest rows block."""
    events = _events(spark, d)
    history = events.filter("event_type <> 'signup'").select("user_id", (F.floor(F.col("us") / 60_000_000) * 60_000_000).cast("long").alias("m"), "value", F.col("event_id").alias("latest_id"))
    asked = events.filter("event_type = 'signup'")
    return t.asof_latest(history, asked, "user_id", "m", "us", "event_id", [1_800_000_000, 3_600_000_000, 7_200_000_000], F.col("value") >= 2, ["latest_id"])


@CATALOGUE.add(f"""WITH {_E} SELECT event_id, {", ".join(f"count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {h * 3600000000} PRECEDING AND 1 PRECEDING) AS n_{h}h, us - {h * 3600000000} <= min(us) OVER (PARTITION BY user_id) AS censored_{h}h" for h in (72, 168, 336))} FROM e""")
def trailing_density(spark: SparkSession, d: str) -> DataFrame:
    """WIN-13, 14."""
    return t.densities(_events(spark, d), "user_id", "us", [72, 168, 336]).drop("user_id", "event_type", "value", "us")


@CATALOGUE.add(f"""WITH {_E}, v AS (SELECT *, nullif(event_type, 'error') AS kind FROM e),
n AS (SELECT *, CASE WHEN kind = lag(kind) OVER w THEN 0 ELSE 1 END AS new, kind = lag(kind) OVER w AS same FROM v WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS island FROM n)
SELECT event_id, row_number() OVER w AS run_length, CASE WHEN kind IS NOT NULL THEN row_number() OVER w - 1 END AS prior_run, same AS same_as_before, island = 1 AS touches_start
FROM i WINDOW w AS (PARTITION BY user_id, island ORDER BY us, event_id)""")
def run_lengths(spark: SparkSession, d: str) -> DataFrame:
    """WIN-15, 16, 17: runs of event types; errors are unknown and stand alone."""
    events = _events(spark, d).withColumn("kind", F.nullif(F.col("event_type"), F.lit("error")))
    runs = t.run_length(events, "user_id", "us", "event_id", "kind", 7 * t.DAY_US)
    return runs.select("event_id", "run_length", "prior_run", "same_as_before", "touches_start")


@CATALOGUE.add(f"""WITH {_E} SELECT event_id, sum(CASE WHEN value < 0.2 THEN 1 ELSE 0 END) OVER r = 0 AS still_valid, CAST(coalesce(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER b, 0) AS BIGINT) AS clicks_before,
last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER r AS last_purchase
FROM e WINDOW r AS (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def prefix_fill_running(spark: SparkSession, d: str) -> DataFrame:
    """WIN-18, 19, 20."""
    events = _events(spark, d).withColumn("bought", F.when(F.col("event_type") == "purchase", F.col("value")))
    key = ("user_id", "us", "event_id")
    out = t.valid_prefix(events, *key, F.col("value") < 0.2)
    out = t.running_sums(out, *key, {"clicks_before": (F.col("event_type") == "click").cast("long")})
    return t.last_known(out, *key, {"last_purchase": "bought"}).select("event_id", "still_valid", "clicks_before", "last_purchase")


@CATALOGUE.add(f"""WITH {_E} SELECT event_id, coalesce(lag(event_type) OVER w, '') AS from_type, coalesce(NOT (lag(event_type) OVER w = 'error' AND event_type = 'purchase') AND NOT (lag(event_type) OVER w = 'signup' AND event_type = 'signup'), TRUE) AS allowed
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)""")
def transition_check(spark: SparkSession, d: str) -> DataFrame:
    """WIN-21."""
    cut, w = t.sliced(_events(spark, d), "user_id", "us", "event_id", 1), t.slice_window("user_id")
    before, now = F.lag("event_type").over(w), F.col("event_type")
    bad = ((before == "error") & (now == "purchase")) | ((before == "signup") & (now == "signup"))
    return t.drop_halo(cut.select("event_id", "__own", "__slice", "__pos", F.coalesce(before, F.lit("")).alias("from_type"), F.coalesce(~bad, F.lit(True)).alias("allowed")))


@CATALOGUE.add("""WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events), d AS (SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS prior FROM (SELECT DISTINCT user_id, day FROM e))
SELECT event_id, date_diff('day', prior, e.day) AS days_since_prior_day FROM e JOIN d ON e.user_id = d.user_id AND e.day = d.day""")
def prior_distinct_day(spark: SparkSession, d: str) -> DataFrame:
    """WIN-24."""
    events = table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"))
    return t.prior_distinct_day(events, "user_id", "day").select("event_id", F.datediff("day", "prior_day").cast("long").alias("days_since_prior_day"))


@CATALOGUE.add("SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY ALL")
def first_last_row(spark: SparkSession, d: str) -> DataFrame:
    """WIN-22: one aggregate instead of two sorts."""
    at = F.struct("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", at).alias("first_order"), F.max_by("o_orderkey", at).alias("last_order"))


@CATALOGUE.add(f"""WITH {_E}, a AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM e)
SELECT user_id, count(*) AS n_rows, count(*) FILTER (WHERE step < 0) AS n_reversed, count(*) FILTER (WHERE step > 3600000000) AS n_gaps FROM a GROUP BY ALL""")
def event_gaps(spark: SparkSession, d: str) -> DataFrame:
    """STR-05, WIN-26."""
    marked = t.arrival_gaps(_events(spark, d), "user_id", "event_id", "us", 3_600_000_000)
    return marked.groupBy("user_id").agg(F.count("*").alias("n_rows"), F.count_if("reversed").alias("n_reversed"), F.count_if("gap").alias("n_gaps"))


@CATALOGUE.add(f"""WITH {_E}, f AS (SELECT event_id, value, us, row_number() OVER w - 1 AS prior, avg(value) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS p FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
k AS (SELECT *, CAST(strftime(make_timestamp(us), '%d') AS BIGINT) // 10 AS part FROM f WHERE prior >= 10)
SELECT part, count(*) AS n, round(avg(abs(p - value)), 6) AS mae, round(sqrt(avg((p - value) ** 2)), 6) AS rmse, round(avg(p - value), 6) AS bias FROM k GROUP BY ALL""")
def error_metrics_by_part(spark: SparkSession, d: str) -> DataFrame:
    """AGG-25, ML-03, 05, 07: the last-ten mean as forecast, by tens of days of the month."""
    from tabspark.operators.aggs import error_metrics

    scored = _forecasts(spark, d).filter("usable").withColumn("part", F.floor(F.dayofmonth(F.timestamp_micros("us")) / 10).cast("long"))
    out = scored.groupBy("part").agg(*error_metrics(F.col("value"), F.col("predicted")))
    return out.select("part", "n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "bias")])


def _forecasts(spark: SparkSession, d: str) -> DataFrame:
    cut = t.sliced(_events(spark, d), "user_id", "us", "event_id", 10)
    w, x = t.slice_window("user_id"), F.col("value")
    out = t.drop_halo(cut.withColumns({"predicted": t.lagged_mean(x, w, 10), "std_10": t.lagged_std(x, w, 10), "prior": F.col("__pos")}))
    return out.withColumn("usable", cohort(F.col("prior"), x, F.col("predicted")))


@CATALOGUE.add(f"""WITH {_E}, f AS (SELECT event_id, value, us, row_number() OVER w - 1 AS prior, avg(value) OVER r AS p, CASE WHEN count(value) OVER r >= 3 THEN stddev_samp(value) OVER r END AS s
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id), r AS (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, CASE WHEN us < epoch_us(TIMESTAMP '2024-01-11') THEN 'fit' WHEN us < epoch_us(TIMESTAMP '2024-01-21') THEN 'calibration' ELSE 'holdout' END AS split FROM f WHERE prior >= 10),
b AS (SELECT sqrt(avg((value - p) ** 2)) AS fallback FROM k WHERE split = 'calibration'),
z AS (SELECT k.*, greatest(coalesce(s, fallback), 0.5, 0.25 * fallback) AS scale FROM k, b),
q AS (SELECT quantile_cont((value - p) / scale, 0.1) AS lo, quantile_cont((value - p) / scale, 0.9) AS hi FROM z WHERE split = 'calibration'),
t AS (SELECT value, p, greatest(p + lo * scale, 0) AS low, greatest(p + hi * scale, 0) AS high FROM z, q WHERE split = 'holdout')
SELECT count(*) AS n, round(avg(abs(p - value)), 6) AS mae, round(sqrt(avg((p - value) ** 2)), 6) AS rmse, round(avg(p - value), 6) AS bias,
round(avg(CASE WHEN value BETWEEN low AND high THEN 1.0 ELSE 0.0 END), 6) AS coverage, round(avg(high - low), 6) AS width FROM t""")
def conformal_interval(spark: SparkSession, d: str) -> DataFrame:
    """AGG-26, MTH-15, 16, ML-06: an 80 % interval calibrated on the second third of January."""
    from tabspark.functions.times import calendar_split

    split = calendar_split(F.timestamp_micros("us"), ["2024-01-11", "2024-01-21"], ["fit", "calibration", "holdout"])
    scored = calibrated(_forecasts(spark, d).filter("usable").withColumn("split", split), "split", "calibration", "holdout", "value", "predicted", "std_10")
    return interval_metrics(scored, "value", "predicted").select("n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "bias", "coverage", "width")])


_SCHEDULE = """s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY game_id, team ORDER BY source_row_id) AS k FROM nfl_schedule) WHERE k = 1),
r AS (SELECT game_id, team, opponent, season, is_home, source_coach_name AS coach, TRY_CAST(split_part(game_id, '_', 2) AS BIGINT) AS week FROM s)"""


@CATALOGUE.add(f"""WITH {_SCHEDULE}, n AS (SELECT *, CASE WHEN is_home = lag(is_home) OVER w THEN 0 ELSE 1 END AS new, week - lag(week) OVER w AS weeks_since, coach <> lag(coach) OVER w AS coach_changed FROM r WINDOW w AS (PARTITION BY team, season ORDER BY week, game_id)),
i AS (SELECT *, sum(new) OVER (PARTITION BY team, season ORDER BY week, game_id ROWS UNBOUNDED PRECEDING) AS island FROM n),
f AS (SELECT game_id, team, opponent, weeks_since, coach_changed, row_number() OVER (PARTITION BY team, season, island ORDER BY week, game_id) AS side_run FROM i)
SELECT a.game_id, a.team, a.weeks_since, a.coach_changed, a.side_run, a.side_run - b.side_run AS side_run_gap FROM f a LEFT JOIN f b ON a.game_id = b.game_id AND a.opponent = b.team""")
def schedule_context(spark: SparkSession, d: str) -> DataFrame:
    """Schedule features per team and season, and against the opponent of the same game (WIN-08, 15, 17, 25, 28, JN-23)."""
    from tabspark.operators.quality import keep_first

    games = keep_first(table(spark, d, "nfl_schedule"), ["game_id", "team"], ["source_row_id"])
    games = games.select("game_id", "team", "opponent", "season", "is_home", F.col("source_coach_name").alias("coach"), F.split("game_id", "_")[1].try_cast("long").alias("week"))
    w = W.partitionBy("team", "season").orderBy("week", "game_id")
    games = games.withColumns({"weeks_since": F.col("week") - F.lag("week").over(w), "coach_changed": ~t.same_as_before("coach", w), "team_season": F.concat_ws("|", "team", "season")})
    runs = t.run_length(games, "team_season", "week", "game_id", "is_home", 52)
    mine = runs.select("game_id", "team", "opponent", "weeks_since", "coach_changed", F.col("run_length").cast("long").alias("side_run"))
    other = mine.select("game_id", F.col("team").alias("opponent"), F.col("side_run").alias("__run"))
    return mine.join(other, ["game_id", "opponent"], "left").select("game_id", "team", "weeks_since", "coach_changed", "side_run", (F.col("side_run") - F.col("__run")).alias("side_run_gap"))


