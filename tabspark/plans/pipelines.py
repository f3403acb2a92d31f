"""Pipelines over the domain tables: pregame features, play styles, point states, identities, quote cutoffs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.functions import mathx, normalize, times
from tabspark.operators import aggs, identity, quality
from tabspark.operators import temporal as t
from tabspark.plans import data_quality
from tabspark.plans.registry import Catalogue
from tabspark.session import table

CATALOGUE = Catalogue()

_BOX = """b AS (SELECT game_id, player_id, opponent_id, epoch_us(CAST(game_date AS TIMESTAMPTZ)) AS us, CASE WHEN regexp_full_match(points, '[0-9]+') THEN CAST(points AS DOUBLE) END AS points, CASE WHEN regexp_full_match(minutes, '[0-9]+([.][0-9]+)?') THEN CAST(minutes AS DOUBLE) END AS minutes FROM nba_player_games),
k AS (SELECT game_id, player_id, min(opponent_id) AS opponent_id, min(us) AS us, min(points) AS points, min(minutes) AS minutes FROM b GROUP BY game_id, player_id
  HAVING count(DISTINCT coalesce(CAST(points AS VARCHAR), '') || '|' || coalesce(CAST(minutes AS VARCHAR), '') || '|' || opponent_id || '|' || us) = 1)"""


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    """One row per game and player; keys whose repeated rows disagree are left out as a whole (DUP-05)."""
    number = lambda c, p: normalize.matching(F.col(c), p).try_cast("double")
    rows = table(spark, d, "nba_player_games").select("game_id", "player_id", "opponent_id", times.micros(times.instant(F.col("game_date"))).alias("us"), number("points", "[0-9]+").alias("points"), number("minutes", r"[0-9]+(\.[0-9]+)?").alias("minutes"))
    same = F.count_distinct(F.struct("opponent_id", "us", F.coalesce(F.col("points").cast("string"), F.lit("")), F.coalesce(F.col("minutes").cast("string"), F.lit(""))))
    out = rows.groupBy("game_id", "player_id").agg(same.alias("versions"), *[F.min(c).alias(c) for c in ("opponent_id", "us", "points", "minutes")])
    return out.filter("versions = 1").drop("versions")


@CATALOGUE.add(f"""WITH {_BOX}, a AS (SELECT opponent_id, us, game_id, sum(points) AS allowed FROM k GROUP BY ALL), r AS (SELECT *, round(avg(allowed) OVER (PARTITION BY opponent_id ORDER BY us, game_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS opponent_allowed_10 FROM a)
SELECT k.game_id, player_id, row_number() OVER w - 1 AS prior_appearances, lag(points) OVER w AS points_lag_1, round(avg(points) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS points_mean_3, round(avg(points) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS points_mean_10,
round(avg(minutes) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS minutes_mean_10, CASE WHEN count(points) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) >= 3 THEN round(stddev_samp(points) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) END AS points_std_10,
CASE WHEN lag(k.us) OVER w IS NOT NULL THEN round(least((k.us - lag(k.us) OVER w) / 86400000000.0, 180.0), 6) END AS days_since_1, opponent_allowed_10, CASE WHEN k.us < epoch_us(TIMESTAMP '2024-01-01') THEN 'fit' WHEN k.us < epoch_us(TIMESTAMP '2025-01-01') THEN 'calibration' ELSE 'holdout' END AS split
FROM k LEFT JOIN r ON k.opponent_id = r.opponent_id AND k.us = r.us AND k.game_id = r.game_id WINDOW w AS (PARTITION BY player_id ORDER BY k.us, k.game_id)""")
def box_features(spark: SparkSession, d: str) -> DataFrame:
    """Pregame features of each player's game, all from earlier games (WIN-01 to 06, AGG-01, K1, K7)."""
    boxes = _boxes(spark, d)
    cut, w = t.sliced(boxes, "player_id", "us", "game_id", 10), t.slice_window("player_id")
    points, us = F.col("points"), F.col("us")
    mine = t.drop_halo(cut.withColumns({
        "prior_appearances": F.col("__pos"), "points_lag_1": F.lag("points").over(w), "points_mean_3": F.round(t.lagged_mean(points, w, 3), 6), "points_mean_10": F.round(t.lagged_mean(points, w, 10), 6),
        "minutes_mean_10": F.round(t.lagged_mean(F.col("minutes"), w, 10), 6), "points_std_10": F.round(t.lagged_std(points, w, 10), 6), "days_since_1": F.round(t.days_since(us, w, 1, 180), 6),
    }))
    allowed = boxes.groupBy("opponent_id", "us", "game_id").agg(F.sum("points").alias("allowed"))
    cut, w = t.sliced(allowed, "opponent_id", "us", "game_id", 10), t.slice_window("opponent_id")
    theirs = t.drop_halo(cut.withColumn("opponent_allowed_10", F.round(t.lagged_mean(F.col("allowed"), w, 10), 6))).drop("allowed")
    split = times.calendar_split(F.timestamp_micros("us"), ["2024-01-01", "2025-01-01"], ["fit", "calibration", "holdout"])
    return mine.join(theirs, ["opponent_id", "us", "game_id"], "left").withColumn("split", split).drop("opponent_id", "us", "points", "minutes")


@CATALOGUE.add("""WITH d AS (SELECT DISTINCT game_id, play_id, season, week, posteam, play_type, down, yards_gained, air_yards FROM nfl_plays WHERE posteam IS NOT NULL),
c AS (SELECT game_id, play_id FROM d GROUP BY ALL HAVING count(*) > 1), g AS (SELECT DISTINCT game_id FROM c), p AS (SELECT * FROM d WHERE game_id NOT IN (SELECT game_id FROM g)),
s AS (SELECT game_id, posteam AS team, season, week, count(*) FILTER (WHERE play_type IN ('pass', 'run')) AS plays, count(*) FILTER (WHERE play_type = 'pass') AS passes, sum(yards_gained) FILTER (WHERE play_type IN ('pass', 'run')) AS yards, count(air_yards > 15) AS deep_known, count(*) FILTER (WHERE air_yards > 15) AS deep_yes FROM p GROUP BY ALL)
SELECT game_id, team, plays, passes, CAST(yards AS BIGINT) AS yards, deep_known, deep_yes, round(sum(passes) OVER w / nullif(sum(plays) OVER w, 0), 6) AS pass_share_5, round(sum(yards) OVER w / nullif(sum(plays) OVER w, 0), 6) AS yards_per_play_5
FROM s WINDOW w AS (PARTITION BY team ORDER BY season * 100 + week, game_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""")
def team_play_styles(spark: SparkSession, d: str) -> DataFrame:
    """Play counters per team's game and pooled shares of its five games before (AGG-10, 11, WIN-11, 28, DUP-06, MTH-14).

    Games with plays that disagree between deliveries are left out whole; styles run on across seasons.
    """
    columns = ["game_id", "play_id", "season", "week", "posteam", "play_type", "down", "yards_gained", "air_yards"]
    plays = table(spark, d, "nfl_plays").select(*columns).filter("posteam is not null").distinct()
    conflicts = plays.groupBy("game_id", "play_id").agg(F.count("*").alias("n")).filter("n > 1").select("game_id").distinct()
    sound = plays.join(conflicts, "game_id", "left_anti")
    run_or_pass = F.col("play_type").isin("pass", "run")
    games = sound.groupBy("game_id", F.col("posteam").alias("team"), "season", "week").agg(
        F.count_if(run_or_pass).alias("plays"), F.count_if(F.col("play_type") == "pass").alias("passes"), F.sum(F.when(run_or_pass, F.col("yards_gained"))).alias("yards"), *aggs.known_yes({"deep": F.col("air_yards") > 15})
    )
    cut, w = t.sliced(games.withColumn("at", F.col("season") * 100 + F.col("week")), "team", "at", "game_id", 5, chunk_us=1000), t.slice_window("team")
    pooled = lambda n: F.round(F.sum(n).over(t.past(w, 5)) / F.nullif(F.sum("plays").over(t.past(w, 5)), F.lit(0)), 6)
    return t.drop_halo(cut.withColumns({"pass_share_5": pooled("passes"), "yards_per_play_5": pooled("yards")})).drop("season", "week", "at")


@CATALOGUE.add(
    "WITH l AS (" + data_quality.ORACLES["p5_loaded"] + """), s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY match_id, point_no ORDER BY line_id) AS k FROM l WHERE point_no IS NOT NULL) WHERE k = 1),
n AS (SELECT *, coalesce(point_no - lag(point_no) OVER w <> 1, point_no <> 1) OR coalesce((set1 + set2) < lag(set1 + set2) OVER w, FALSE) AS bad FROM s WINDOW w AS (PARTITION BY match_id ORDER BY point_no))
SELECT match_id, point_no, sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER u = 0 AS still_valid, CAST(coalesce(sum(CASE WHEN svr = ptwinner THEN 1 ELSE 0 END) OVER b, 0) AS BIGINT) AS serve_points_won_before, last_value(svr IGNORE NULLS) OVER u AS last_server
FROM n WINDOW u AS (PARTITION BY match_id ORDER BY point_no ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY match_id ORDER BY point_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def point_states(spark: SparkSession, d: str) -> DataFrame:
    """States of charted points: a gap or a falling score makes everything later invalid (WIN-18 to 21)."""
    points = data_quality.p5_loaded(spark, d).filter("point_no is not null").select("line_id", "match_id", "point_no", "svr", "ptwinner", (F.col("set1") + F.col("set2")).alias("sets"))
    points = quality.keep_first(points, ["match_id", "point_no"], ["line_id"])
    key = ("match_id", "point_no", "point_no")
    cut, w = t.sliced(points, *key, 1, chunk_us=100_000), t.slice_window("match_id")
    step, sets = F.col("point_no") - F.lag("point_no").over(w), F.lag("sets").over(w)
    bad = F.coalesce(step != 1, F.col("point_no") != 1) | F.coalesce(F.col("sets") < sets, F.lit(False))
    checked = t.drop_halo(cut.withColumn("bad", bad))
    out = t.valid_prefix(checked, *key, F.col("bad"), chunk_us=100_000)
    won = F.coalesce(F.col("svr") == F.col("ptwinner"), F.lit(False)).cast("long")
    out = t.running_sums(out, *key, {"serve_points_won_before": won}, 100_000)
    return t.last_known(out, *key, {"last_server": "svr"}, 100_000).select("match_id", "point_no", "still_valid", "serve_points_won_before", "last_server")


@CATALOGUE.add("""WITH p AS (SELECT DISTINCT lower(trim(player_name)) AS name, player_id FROM nba_player_games WHERE player_name IS NOT NULL AND player_id IS NOT NULL), a AS (SELECT name, count(*) AS n FROM p GROUP BY ALL), b AS (SELECT player_id, count(*) AS m FROM p GROUP BY ALL)
SELECT name, player_id, CASE WHEN n = 1 AND m = 1 THEN 'unique' ELSE 'several' END AS status FROM p JOIN a USING (name) JOIN b USING (player_id)""")
def unique_name_match(spark: SparkSession, d: str) -> DataFrame:
    """JX-01, 03, 07, 08: names and ids that belong to each other alone."""
    rows = table(spark, d, "nba_player_games").select(F.lower(F.trim("player_name")).alias("name"), "player_id")
    pairs = rows.withColumn("k", F.concat_ws("|", "name", "player_id"))
    return identity.unique_match(pairs.filter("name is not null and player_id is not null").select("k", "name"), pairs.filter("name is not null").select("k", "player_id"), ["k"], "name", "player_id")


@CATALOGUE.add("""WITH r AS (SELECT posteam, game_id, count(DISTINCT defteam) AS n, min(defteam) AS opp FROM nfl_plays WHERE posteam IS NOT NULL GROUP BY ALL)
SELECT (SELECT count(*) FROM nfl_schedule) AS n_rows, count(*) FILTER (WHERE n = 1 AND s.opponent = r.opp) AS n_agree, count(*) FILTER (WHERE n = 1 AND s.opponent <> r.opp) AS n_differ FROM (SELECT DISTINCT game_id, team, opponent FROM nfl_schedule) s JOIN r ON s.game_id = r.game_id AND s.team = r.posteam""")
def lookup_agreement(spark: SparkSession, d: str) -> DataFrame:
    """JX-02, NRM-26: the opponent by a lookup without ambiguous keys against the stated one."""
    plays = table(spark, d, "nfl_plays").filter("posteam is not null").select("game_id", F.col("posteam").alias("team"), F.col("defteam").alias("seen")).distinct()
    once = identity.unambiguous(plays, ["game_id", "team"])
    schedule = table(spark, d, "nfl_schedule")
    joined = schedule.select("game_id", "team", "opponent").distinct().join(once, ["game_id", "team"])
    counts = joined.agg(F.count_if(F.col("opponent") == F.col("seen")).alias("n_agree"), F.count_if(F.col("opponent") != F.col("seen")).alias("n_differ"))
    return schedule.agg(F.count("*").alias("n_rows")).crossJoin(counts)  # two single rows


@CATALOGUE.add("""WITH q AS (SELECT DISTINCT update_id, token_id, CAST(source_time_utc AS TIMESTAMPTZ) AS s, CAST(received_time_utc AS TIMESTAMPTZ) AS r FROM quote_updates), c AS (SELECT token_id, make_timestamptz((min(epoch_us(r)) + max(epoch_us(r))) // 2) AS cut FROM q GROUP BY ALL)
SELECT token_id, count(*) AS n_before FROM q JOIN c USING (token_id) WHERE r < cut AND coalesce(s < cut, TRUE) GROUP BY ALL""")
def quotes_before_cutoff(spark: SparkSession, d: str) -> DataFrame:
    """WIN-27: updates before the middle of their token's span on both clocks."""
    us = lambda c: times.micros(F.col(c).try_cast("timestamp"))
    rows = table(spark, d, "quote_updates").select("update_id", "token_id", us("source_time_utc").alias("s"), us("received_time_utc").alias("r")).distinct()
    cuts = rows.groupBy("token_id").agg(F.floor((F.min("r") + F.max("r")) / 2).cast("long").alias("cut"))
    return identity.before_cutoff(rows, cuts, "token_id", "s", "r", "cut").groupBy("token_id").agg(F.count("*").alias("n_before"))


@CATALOGUE.add("""SELECT metric, n FROM (UNPIVOT (SELECT count(*) AS n_rows, count(*) FILTER (WHERE tournament IS NULL) AS n_null_tournament, count(*) FILTER (WHERE trim(match_date) = '') AS n_empty_date, count(*) - count(DISTINCT match_id) AS n_repeated FROM tennis_matches) ON n_rows, n_null_tournament, n_empty_date, n_repeated INTO NAME metric VALUE n)""")
def profile_counts_long(spark: SparkSession, d: str) -> DataFrame:
    """AGG-30."""
    checks = {"n_rows": F.count("*"), "n_null_tournament": F.count_if(F.col("tournament").isNull()), "n_empty_date": F.count_if(F.coalesce(F.trim("match_date") == "", F.lit(False))), "n_repeated": F.count("*") - F.count_distinct("match_id")}
    return identity.profile_long(table(spark, d, "tennis_matches"), checks)


@CATALOGUE.add("""SELECT play_type, '{"n":' || count(*) || ',"passers":' || count(DISTINCT passer_player_id) || '}' AS metrics FROM nfl_plays GROUP BY ALL""")
def nested_rollup(spark: SparkSession, d: str) -> DataFrame:
    """AGG-29, ARR-04: metrics as one JSON object with sorted keys."""
    wide = table(spark, d, "nfl_plays").groupBy("play_type").agg(F.count("*").alias("n"), F.count_distinct("passer_player_id").alias("passers"))
    long = wide.select("play_type", F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in ("n", "passers")])))
    return identity.rollup_json(long, "play_type", "metric", "value")


@CATALOGUE.add("""WITH b AS (SELECT competition_group, lower(trim(player1_name)) AS player, best_of FROM tennis_matches), g AS (SELECT competition_group, player, count(*) AS n, count(*) FILTER (WHERE TRY_CAST(best_of AS DOUBLE) = 5) AS wins FROM b GROUP BY ALL)
SELECT competition_group, player, n, round((wins + 20 * 0.3) / (n + 20), 6) AS shrunk FROM (SELECT *, row_number() OVER (PARTITION BY competition_group ORDER BY (wins + 20 * 0.3) / (n + 20) DESC, n DESC, player) AS k FROM g WHERE n >= 1) WHERE k <= 5""")
def ranked_screen(spark: SparkSession, d: str) -> DataFrame:
    """AGG-28, MTH-08, JN-30: the five highest shrunken shares of each group."""
    from pyspark.sql import Window as W

    rows = table(spark, d, "tennis_matches").select("competition_group", F.lower(F.trim("player1_name")).alias("player"), F.col("best_of").try_cast("double").alias("best_of"))
    g = rows.groupBy("competition_group", "player").agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("best_of") == 5, F.lit(False))).alias("wins"))
    score = mathx.shrink(F.col("wins"), F.col("n"), F.lit(0.3))
    k = F.row_number().over(W.partitionBy("competition_group").orderBy(F.desc("score"), F.desc("n"), "player"))
    return g.withColumn("score", score).withColumn("k", k).filter("k <= 5").select("competition_group", "player", "n", F.round("score", 6).alias("shrunk"))
