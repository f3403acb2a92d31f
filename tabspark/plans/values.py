"""Scalar functions, calendar splits, text extraction, order books and minute activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.functions import mathx as m
from tabspark.functions import normalize as n
from tabspark.functions import text as x
from tabspark.functions import times
from tabspark.operators.reshape import claim_rows
from tabspark.plans.registry import Catalogue
from tabspark.session import scratch_path, table
from tabspark.sources import readers, writers
from tabspark.streaming import minutes

CATALOGUE = Catalogue()


@CATALOGUE.add("""SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'fit' WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'calibration' ELSE 'holdout' END AS split, count(*) AS n FROM orders GROUP BY ALL""")
def calendar_split_3way(spark: SparkSession, d: str) -> DataFrame:
    """K7, DT-13."""
    split = times.calendar_split(F.col("o_orderdate").cast("timestamp"), ["1998-01-01", "2000-01-01"], ["fit", "calibration", "holdout"])
    return table(spark, d, "orders").groupBy(split.alias("split")).agg(F.count("*").alias("n"))


def _split_sql() -> str:
    rows = """o AS (SELECT CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS ts, CASE o_orderkey % 3 WHEN 0 THEN 'source_calendar_date' WHEN 1 THEN 'unknown' ELSE 'source_timestamp' END AS p FROM orders)"""
    three = "CASE WHEN ts < TIMESTAMP '1995-01-01' THEN 'fit' WHEN ts < TIMESTAMP '1996-01-01' THEN 'calibration' ELSE 'holdout' END"
    two = "CASE WHEN ts < TIMESTAMP '1996-01-01' THEN 'development' ELSE 'holdout' END"
    four, pair = "strftime(ts, '%Y-%m-%d') IN ('1994-12-31', '1995-01-01', '1995-12-31', '1996-01-01')", "strftime(ts, '%Y-%m-%d') IN ('1995-12-31', '1996-01-01')"
    doubt = "THEN 'date_precision_unresolved'"
    of = {
        "context": f"CASE WHEN ts IS NULL THEN 'unknown_date' WHEN {four} AND p = 'source_calendar_date' {doubt} ELSE {three} END",
        "team_styles": f"CASE WHEN ts IS NULL THEN 'date_unresolved' WHEN {four} AND p <> 'source_timestamp' {doubt} ELSE {three} END",
        "injury_views": f"CASE WHEN ts IS NULL THEN 'unresolved_game_time' ELSE {three} END",
        "injury_entries": f"CASE WHEN ts IS NULL THEN 'unresolved_game_time' ELSE {three} END",
        "schedule_density": f"CASE WHEN ts IS NOT NULL THEN {three} END",
        "points": f"CASE WHEN ts IS NULL THEN 'date_unresolved' WHEN {four} {doubt} ELSE {three} END",
        "air_quality": "CASE WHEN year(ts) < 1995 THEN 'fit' WHEN year(ts) < 1996 THEN 'calibration' WHEN ts IS NOT NULL THEN 'holdout' END",
        "attendance": f"CASE WHEN ts IS NOT NULL THEN {two} END",
        "play_styles": f"CASE WHEN ts IS NULL THEN 'unknown_date' WHEN {pair} AND p <> 'source_timestamp' {doubt} ELSE {two} END",
        "officials": f"CASE WHEN ts IS NULL THEN 'unknown_game_date' WHEN {pair} AND p <> 'source_timestamp' {doubt} ELSE {two} END",
        "weather": f"CASE WHEN ts IS NULL THEN NULL WHEN {pair} AND p <> 'source_timestamp' {doubt} ELSE {two} END",
        "plays": f"CASE WHEN ts IS NULL THEN 'unmatched_game_date' ELSE {two} END",
        "match_weather": two,
        "shots": f"CASE WHEN ts IS NULL THEN 'date_unresolved' WHEN strftime(ts, '%Y-%m-%d') = '1995-12-31' AND p <> 'source_timestamp' THEN 'boundary_unresolved' ELSE {two} END",
        "odds": f"CASE WHEN ts IS NOT NULL THEN {two} END",
        "profiles": "CASE WHEN ts IS NULL THEN 'unresolved_year' WHEN year(ts) < 1996 THEN 'development' ELSE 'holdout' END",
        "spectators": "CASE WHEN strftime(ts, '%Y-%m-%d') < '1996-01-01' THEN 'development' WHEN ts IS NOT NULL THEN 'holdout' END",
        "model": f"CASE WHEN ts IS NOT NULL THEN {three} END",
    }
    return f"WITH {rows} SELECT variant, split, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS variant, {v} AS split FROM o" for k, v in of.items()) + ") GROUP BY ALL"


@CATALOGUE.add(_split_sql())
def split_variants(spark: SparkSession, d: str) -> DataFrame:
    """K7, DT-13 and all splits of section 2.13: rows per class of each, one scan."""
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.when(key % 11 != 0, F.col("o_orderdate").cast("timestamp")).alias("ts"), F.when(key % 3 == 0, "source_calendar_date").when(key % 3 == 1, "unknown").otherwise("source_timestamp").alias("p"))
    edges = {3: ["1995-01-01", "1996-01-01"], 2: ["1996-01-01"]}
    cells = F.array(*[F.struct(F.lit(name).alias("variant"), times.split_as(s, F.col("ts"), F.col("p"), edges[s.classes]).alias("split")) for name, s in times.SPLITS.items()])
    return rows.select(F.inline(cells)).groupBy("variant", "split").agg(F.count("*").alias("n"))


def _boundary_split(rows: DataFrame) -> DataFrame:
    ts, kind = times.instant(F.col("game_date")), times.precision_class(F.col("game_date"))
    days = [f"{y}-{md}" for y in range(1999, 2031) for md in ("12-31", "01-01")]
    split = times.calendar_split(ts, ["2020-01-01"], ["development", "holdout"], boundary_days=days, boundary_when=kind == "source_calendar_date")
    return rows.select("source_row_id", split.alias("split"), kind.alias("precision_class"))


@CATALOGUE.add("""WITH c AS (SELECT source_row_id, regexp_replace(trim(game_date), '^([0-9]{4})([0-9]{2})([0-9]{2})T([0-9]{2})([0-9]{2})([0-9]{2})', '\\1-\\2-\\3T\\4:\\5:\\6') AS clean FROM nfl_schedule),
z AS (SELECT source_row_id, clean, regexp_full_match(clean, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AS bare, regexp_replace(clean, '([+-][0-9]{2})([0-9]{2})$', '\\1:\\2') AS zoned FROM c),
s AS (SELECT source_row_id, bare, CASE WHEN bare THEN CAST(TRY_CAST(clean AS DATE) AS TIMESTAMP) WHEN regexp_full_match(zoned, '[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?') THEN TRY_CAST(TRY_CAST(zoned AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) END AS ts FROM z)
SELECT source_row_id, CASE WHEN ts IS NULL THEN 'unknown_date' WHEN strftime(ts, '%m-%d') IN ('12-31', '01-01') AND bare THEN 'date_precision_unresolved' WHEN ts < TIMESTAMP '2020-01-01' THEN 'development' ELSE 'holdout' END AS split,
CASE WHEN ts IS NULL THEN 'unknown' WHEN bare THEN 'source_calendar_date' ELSE 'source_timestamp' END AS precision_class FROM s""")
def calendar_split_boundary(spark: SparkSession, d: str) -> DataFrame:
    """K7, DT-03: every row; what is no ISO text (epochs, month names, slashes, bare times and months) is unknown_date (p6_readings reads those)."""
    return _boundary_split(table(spark, d, "nfl_schedule"))


@CATALOGUE.add("""WITH p AS (SELECT *, CASE WHEN regexp_full_match(trim(minutes), '[+-]?[0-9]+([.][0-9]*)?') THEN TRY_CAST(minutes AS DOUBLE) END AS mins FROM nba_player_games)
SELECT box_row_id, CASE WHEN mins = floor(mins) THEN CAST(CAST(mins AS BIGINT) AS VARCHAR) END AS minutes_id, mins AS minutes, CASE WHEN lower(trim(is_home)) IN ('true', '1', '1.0', 't', 'yes') THEN TRUE WHEN lower(trim(is_home)) IN ('false', '0', '0.0', 'f', 'no') THEN FALSE END AS is_home,
CASE WHEN regexp_full_match(player_id, '[1-9][0-9]*') THEN player_id END AS player_id, lpad(regexp_replace(trim(game_id), '[.]0$', ''), 10, '0') AS game_key, CASE WHEN regexp_full_match(trim(points), '[0-9]{1,18}') THEN CAST(trim(points) AS BIGINT) END AS points FROM p""")
def normalised_box_scores(spark: SparkSession, d: str) -> DataFrame:
    """NRM-01, 02, 03, 06, 07, 08, 11."""
    minutes = n.matching(F.trim("minutes"), r"[+-]?[0-9]+(\.[0-9]*)?")
    return table(spark, d, "nba_player_games").select(
        "box_row_id",
        n.identifier(minutes).alias("minutes_id"),
        n.number(minutes).alias("minutes"),
        n.flag(F.col("is_home")).alias("is_home"),
        n.digit_id(F.col("player_id")).alias("player_id"),
        n.suffix_id(F.col("game_id"), 10).alias("game_key"),
        n.unsigned(F.col("points")).alias("points"),
    )


@CATALOGUE.add("""SELECT play_row_id, coalesce(CASE posteam WHEN 'ZAM' THEN 'ZMB' WHEN 'TUM' THEN 'TMB' ELSE posteam END, 'none') AS team, coalesce(regexp_full_match(passer_player_id, '00-[0-9]{7}'), FALSE) AS passer_valid,
coalesce(passer_player_id, receiver_player_id) AS first_id, CASE WHEN air_yards >= 0 AND air_yards <= 60 THEN CASE WHEN air_yards = 0 THEN 0.0 ELSE air_yards END END AS bounded FROM nfl_plays""")
def normalised_plays(spark: SparkSession, d: str) -> DataFrame:
    """NRM-05, 09, 14, 19, FLT-08, 09."""
    return table(spark, d, "nfl_plays").select(
        "play_row_id",
        F.coalesce(n.alias(F.col("posteam"), {"ZAM": "ZMB", "TUM": "TMB"}), F.lit("none")).alias("team"),
        n.gsis_valid(F.col("passer_player_id")).alias("passer_valid"),
        n.first_known(F.col("passer_player_id"), F.col("receiver_player_id")).alias("first_id"),
        n.bounded_decimal(F.col("air_yards"), 60).cast("double").alias("bounded"),
    )


@CATALOGUE.add("SELECT event_id, " + ", ".join(f"CASE WHEN event_type = '{k}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_{k}" for k in ("click", "purchase", "signup")) + ", TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def one_hot_props(spark: SparkSession, d: str) -> DataFrame:
    """SET-12, NRM-23, ARR-03: one-hot types and a JSON field."""
    return table(spark, d, "events").select("event_id", *n.one_hot(F.col("event_type"), ["click", "purchase", "signup"], "is_"), F.get_json_object("props", "$.k").try_cast("long").alias("k"))


_WINS = "SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS wins FROM events GROUP BY ALL"


@CATALOGUE.add(f"""WITH u AS ({_WINS}), z AS (SELECT 1.959963984540054 AS z), p AS (SELECT sum(wins) / sum(n) AS prior FROM u)
SELECT user_id, round((wins / n + z * z / (2 * n) - z * sqrt(wins / n * (1 - wins / n) / n + z * z / (4 * n * n))) / (1 + z * z / n), 6) AS low,
round((wins / n + z * z / (2 * n) + z * sqrt(wins / n * (1 - wins / n) / n + z * z / (4 * n * n))) / (1 + z * z / n), 6) AS high, round((wins + 20 * prior) / (n + 20), 6) AS shrunk, round((wins + 1) / (n + 2), 6) AS laplace FROM u, z, p""")
def wilson_shrinkage(spark: SparkSession, d: str) -> DataFrame:
    """MTH-07, 08."""
    users = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("wins"))
    prior = users.agg((F.sum("wins") / F.sum("n")).alias("prior"))  # one row
    low, high = m.wilson(F.col("wins"), F.col("n"))
    shrunk = m.shrink(F.col("wins"), F.col("n"), F.col("prior"))
    return users.crossJoin(F.broadcast(prior)).select("user_id", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"), F.round(shrunk, 6).alias("shrunk"), F.round(m.laplace(F.col("wins"), F.col("n")), 6).alias("laplace"))


@CATALOGUE.add("""WITH s AS (SELECT s_suppkey, CAST(s_suppkey % 170 AS DOUBLE) - 85 AS a, CAST(s_suppkey % 350 AS DOUBLE) - 175 AS o FROM supplier)
SELECT s_suppkey, round(2 * 6371000.0 * asin(least(1.0, sqrt(sin((radians(0.0) - radians(a)) / 2) ** 2 + cos(radians(a)) * cos(radians(0.0)) * sin((radians(10.0) - radians(o)) / 2) ** 2))), 2) AS metres,
abs(a - 0.0) <= 500 / 111.32 AND abs(o - 10.0) <= 500 / 111.32 / cos(radians(0.0)) AS near FROM s""")
def haversine(spark: SparkSession, d: str) -> DataFrame:
    """MTH-05, 06, JX-13."""
    lat, lon = (F.col("s_suppkey") % 170).cast("double") - 85, (F.col("s_suppkey") % 350).cast("double") - 175
    zero, ten = F.lit(0.0), F.lit(10.0)
    return table(spark, d, "supplier").select("s_suppkey", F.round(m.haversine_m(lat, lon, zero, ten), 2).alias("metres"), m.in_box(lat, lon, zero, ten, 500).alias("near"))


@CATALOGUE.add("""SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN 1 + c_acctbal / 100 WHEN c_acctbal < 0 THEN 1 - 100 / c_acctbal END, 6) AS decimal_odds, round(least(greatest(c_acctbal, 0.0), 5000.0), 2) AS clipped, round((c_acctbal - 32) * 5 / 9, 6) AS celsius,
CASE WHEN c_acctbal <= 0 THEN 'a' WHEN c_acctbal <= 5000 THEN 'b' ELSE 'c' END AS band, c_acctbal = floor(c_acctbal) AS is_integral, round(CASE WHEN c_nationkey > 0 THEN c_acctbal / c_nationkey END, 6) AS per_nation FROM customer""")
def scalar_math(spark: SparkSession, d: str) -> DataFrame:
    """MTH-01, 04, 09, 10, 11, 12."""
    b = F.col("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey",
        F.round(m.decimal_odds(b), 6).alias("decimal_odds"),
        F.round(m.clip(b, 0, 5000), 2).alias("clipped"),
        F.round(m.celsius(b), 6).alias("celsius"),
        m.bins(b, [0, 5000], ["a", "b", "c"], closed="right").alias("band"),
        m.is_integral(b).alias("is_integral"),
        F.round(m.safe_ratio(b, F.col("c_nationkey")), 6).alias("per_nation"),
    )


_STAT = lambda c: f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN CAST({c} AS DOUBLE) END"


@CATALOGUE.add(f"""WITH p AS (SELECT team_id, season, {_STAT('points')} AS pts, {_STAT('field_goals_attempted')} AS fga, {_STAT('free_throws_attempted')} AS fta, {_STAT('threes')} AS th, {_STAT('turnovers')} AS tov FROM nba_player_games)
SELECT team_id, season, round(sum(pts), 2) AS points, round(CASE WHEN sum(fga) > 0 THEN sum(th) / sum(fga) END, 6) AS three_share, round(CASE WHEN sum(fga) + 0.44 * sum(fta) + sum(tov) > 0 THEN 100 * sum(pts) / (sum(fga) + 0.44 * sum(fta) + sum(tov)) END, 6) AS per_100,
CASE WHEN NOT coalesce(count(DISTINCT season) >= 1 AND count(*) >= 20, FALSE) OR sum(th) / nullif(sum(fga), 0) IS NULL THEN 'insufficient' WHEN sum(th) / sum(fga) >= 0.3 THEN 'high' WHEN sum(th) / sum(fga) <= 0.15 THEN 'low' ELSE 'balanced' END AS style FROM p GROUP BY ALL""")
def team_style(spark: SparkSession, d: str) -> DataFrame:
    """MTH-02, 14: pooled shooting style of a team's season from its players' lines."""
    stat = lambda c: n.matching(F.col(c), "[0-9]+").try_cast("double")
    rows = table(spark, d, "nba_player_games").select("team_id", "season", *[stat(c).alias(c) for c in ("points", "field_goals_attempted", "free_throws_attempted", "threes", "turnovers")])
    t = rows.groupBy("team_id", "season").agg(F.sum("points").alias("pts"), F.sum("field_goals_attempted").alias("fga"), F.sum("free_throws_attempted").alias("fta"), F.sum("threes").alias("th"), F.sum("turnovers").alias("tov"), F.count("*").alias("n"))
    share = m.safe_ratio(F.col("th"), F.col("fga"))
    poss = m.possessions(F.col("fga"), F.col("fta"), F.lit(0.0), F.col("tov"))
    style = m.style_class(share, F.lit(1), F.col("n"), 0.3, 0.15, 1, 20)
    return t.select("team_id", "season", F.round("pts", 2).alias("points"), F.round(share, 6).alias("three_share"), F.round(m.per_100(F.col("pts"), poss), 6).alias("per_100"), style.alias("style"))


@CATALOGUE.add("""SELECT source_row_id, CASE WHEN source_published_at_utc IS NULL THEN FALSE ELSE regexp_matches(lower(trim(source_published_at_utc)), '(z|[+-][0-9]{2}:?[0-9]{2})$') AND regexp_matches(source_published_at_utc, '[0-9]:[0-9]{2}') END AS has_zone,
CASE WHEN regexp_matches(source_published_at_utc, '^\\s*[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN CAST(TRY_CAST(regexp_extract(source_published_at_utc, '^\\s*([0-9]{4}-[0-9]{2}-[0-9]{2})', 1) AS DATE) AS VARCHAR) END AS written_day FROM source_annotations""")
def zone_and_day(spark: SparkSession, d: str) -> DataFrame:
    """DT-02, 04."""
    c = F.col("source_published_at_utc")
    return table(spark, d, "source_annotations").select("source_row_id", times.has_zone(c).alias("has_zone"), times.calendar_date(c).cast("string").alias("written_day"))


@CATALOGUE.add("""SELECT season, count(*) AS n_hours, count(*) FILTER (WHERE season > 2015) AS n_late FROM nfl_ngs GROUP BY ALL""")
def season_counts(spark: SparkSession, d: str) -> DataFrame:
    """AGG-08: null seasons are a group."""
    return table(spark, d, "nfl_ngs").groupBy("season").agg(F.count("*").alias("n_hours"), F.count_if(F.col("season") > 2015).alias("n_late"))


def local_times(spark: SparkSession, d: str) -> DataFrame:
    """DT-05: every half hour of 2024 as Eastern wall time; times in the gap or the fold have no instant."""
    wall = spark.range(366 * 48).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("wall"))
    utc = times.local_to_utc(F.col("wall"), "America/New_York")
    return wall.select(F.date_format("wall", "yyyy-MM-dd HH:mm").alias("wall"), F.date_format(utc, "yyyy-MM-dd HH:mm").alias("utc"))


CATALOGUE.add("""WITH w AS (SELECT TIMESTAMP '2024-01-01' + to_minutes(CAST(30 * i AS BIGINT)) AS wall FROM range(366 * 48) t(i))
SELECT strftime(wall, '%Y-%m-%d %H:%M') AS wall, CASE WHEN wall >= TIMESTAMP '2024-03-10 02:00' AND wall < TIMESTAMP '2024-03-10 03:00' THEN NULL WHEN wall >= TIMESTAMP '2024-11-03 01:00' AND wall < TIMESTAMP '2024-11-03 02:00' THEN NULL
WHEN wall >= TIMESTAMP '2024-03-10 03:00' AND wall < TIMESTAMP '2024-11-03 01:00' THEN strftime(wall + INTERVAL 4 HOUR, '%Y-%m-%d %H:%M') ELSE strftime(wall + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M') END AS utc FROM w""")(local_times)

# What a note of each category says, and the words that turn a mention around or into the past.
CATEGORIES = {
    "medical_or_timeout": r"\b(?:medical|physio(?:therapist)?|trainer|MTO|treatment|injur(?:y|ed)|cramp(?:s|ing)?|time[ -]?out)\b",
    "weather": r"\b(?:rain(?:ing|y)?|wind(?:y)?|gust(?:s|y)?|humid(?:ity)?|heat|hot|cold|weather|sun(?:ny)?|temperature)\b",
    "roof": r"\b(?:roof|covered court|indoor(?:s)?)\b",
    "light_or_visibility": r"\b(?:light(?:s|ing)?|dark(?:ness)?|shadow(?:s)?|glare|visibility|floodlight(?:s)?)\b",
    "noise_or_crowd": r"\b(?:crowd|spectator(?:s)?|noise|noisy|heckl(?:e|er|ing)|boo(?:ing|ed)?|cheer(?:s|ing)?|shout(?:s|ing)?)\b",
    "time_violation_or_serve_clock": r"\b(?:time violation|serve clock|shot clock|time warning|slow play|delay of game|25[ -]second)\b",
    "equipment": r"\b(?:racket|racquet|string(?:s|ing)?|grip|dampener|broken racket|broken racquet|equipment)\b",
    "underarm_serve": r"\bunder[ -]?(?:arm|hand)(?:[ -]serve)?\b",
    "interruption": r"\b(?:interruption|interrupt(?:ed|ion|ions)?|delay(?:ed|s)?|suspend(?:ed)?|suspension|toilet|bathroom|change of clothes|stoppage|stop(?:ped)? play)\b",
}
NEGATION = ["no", "not", "never", "without", "denied", "didn't", "wasn't", "isn't"]
RETROSPECTIVE = ["previous", "earlier", "yesterday", "last (?:point|game|set|match)", "before this"]


def _mention_sql() -> str:
    parts = [f"SELECT doc_id, '{name}' AS category, list_sort(list_distinct(list_transform(regexp_extract_all(text, '(?i){p}'), lambda w: lower(w)))) AS ph, text FROM documents" for name, p in CATEGORIES.items()]
    has = lambda words: "coalesce(regexp_matches(text, '(?i)" + x.whole_words(words).replace("'", "''") + "'), FALSE)"
    return f"""WITH c AS ({' UNION ALL '.join(parts)}) SELECT doc_id, category, CAST(len(ph) AS INTEGER) AS n_phrases, array_to_string(ph[1:20], '|') AS phrases, {has(NEGATION)} AS negated, {has(RETROSPECTIVE)} AS retrospective FROM c WHERE len(ph) > 0"""


@CATALOGUE.add(_mention_sql())
def keyword_mentions(spark: SparkSession, d: str) -> DataFrame:
    """TXT-01, SET-11, STRF-05, 07, UDTF-01."""
    return x.mentions(table(spark, d, "documents").select("doc_id", "text"), "text", CATEGORIES, ["doc_id"], NEGATION, RETROSPECTIVE)


@CATALOGUE.add("""WITH f AS (SELECT doc_id, 'attendance' AS fact, list_distinct(regexp_extract_all(text, 'crowd of ([0-9,]+)', 1)) AS vs FROM documents UNION ALL SELECT doc_id, 'upper_tier_since', list_distinct(regexp_extract_all(text, 'first time since ([0-9]{4})', 1)) FROM documents)
SELECT doc_id, fact, vs[1] AS value FROM f WHERE len(vs) = 1""")
def rule_facts(spark: SparkSession, d: str) -> DataFrame:
    """TXT-02, 05, 06, 08: one value per rule and text, or none."""
    rules = {"attendance": "crowd of ([0-9,]+)", "upper_tier_since": "first time since ([0-9]{4})"}
    return x.rule_facts(table(spark, d, "documents").select("doc_id", "text"), "text", rules, ["doc_id"])


@CATALOGUE.add("SELECT count(*) AS n, count(DISTINCT sha256(coalesce(text, ''))) AS n_hashes, min(sha256(coalesce(text, ''))) AS first_hash FROM documents")
def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    """STRF-10, SRC-08."""
    h = F.sha2(F.coalesce("text", F.lit("")), 256)
    return table(spark, d, "documents").select(h.alias("h")).agg(F.count("*").alias("n"), F.count_distinct("h").alias("n_hashes"), F.min("h").alias("first_hash"))


@CATALOGUE.add("""SELECT listing_id, trim(regexp_replace(lower(translate(coalesce(player1_name, ''), '‘’', '''''')), '\\s+', ' ', 'g')) AS name, regexp_extract(match_date, '^([0-9]{4})-', 1) AS iso_year, coalesce(regexp_matches(tournament, '(?i)open'), FALSE) AS is_open FROM match_listings""")
def text_cleaning(spark: SparkSession, d: str) -> DataFrame:
    """STRF-03, 04, 05, 06, 08."""
    name = F.lower(n.squeeze(F.coalesce("player1_name", F.lit(""))))
    year = F.regexp_extract("match_date", "^([0-9]{4})-", 1)
    return table(spark, d, "match_listings").select("listing_id", name.alias("name"), year.alias("iso_year"), n.contains(F.col("tournament"), "open").alias("is_open"))


@CATALOGUE.add("""SELECT snapshot_id, CAST(best_ask - best_bid AS DOUBLE) AS spread, best_ask >= best_bid AS uncrossed, CAST(1 - best_bid AS DOUBLE) AS other_price FROM (SELECT DISTINCT snapshot_id, best_bid, best_ask FROM book_snapshots)""")
def book_spreads(spark: SparkSession, d: str) -> DataFrame:
    """ARR-02, MTH-09, in exact decimals."""
    rows = table(spark, d, "book_snapshots").select("snapshot_id", "best_bid", "best_ask").distinct()
    return rows.select("snapshot_id", (F.col("best_ask") - F.col("best_bid")).cast("double").alias("spread"), (F.col("best_ask") >= F.col("best_bid")).alias("uncrossed"), m.complement_price(F.col("best_bid")).cast("double").alias("other_price"))


@CATALOGUE.add("""WITH g AS (SELECT l_orderkey, list_distinct(list(l_linenumber)) AS ns, list(l_quantity) AS qs FROM lineitem GROUP BY ALL) SELECT l_orderkey, list_min(qs) AS best_low, list_max(qs) AS best_high, round(list_sum(qs), 2) AS depth, CAST(len(qs) AS INTEGER) AS levels, CAST(len(ns) AS INTEGER) AS distinct_lines FROM g""")
def array_stats(spark: SparkSession, d: str) -> DataFrame:
    """ARR-01, 02, 05: arrays of an order's lines."""
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("ns"), F.collect_list("l_quantity").alias("qs"))
    total = F.aggregate("qs", F.lit(0.0), lambda a, q: a + q)
    return g.select("l_orderkey", F.array_min("qs").alias("best_low"), F.array_max("qs").alias("best_high"), F.round(total, 2).alias("depth"), F.size("qs").alias("levels"), F.size("ns").alias("distinct_lines"))


_KINDS = ["price_change", "last_trade_price", "tick_size_change"]
_MINUTE_SQL = f"""WITH q AS (SELECT DISTINCT ON (update_id) token_id, event_type, price, quote_size, CAST(received_time_utc AS TIMESTAMPTZ) AS r, CAST(source_time_utc AS TIMESTAMPTZ) AS s FROM quote_updates ORDER BY update_id)
SELECT token_id, epoch_us(date_trunc('minute', r)) // 1000000 AS minute_s, count(*) AS n_rows, {", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS n_{k}" for k in _KINDS)}, CAST(sum(CAST(quote_size AS DECIMAL(18, 6))) AS DOUBLE) AS size_sum,
round(CAST(sum(CAST(price AS DECIMAL(18, 6)) * CAST(quote_size AS DECIMAL(18, 6))) AS DOUBLE), 4) AS notional, round(max((epoch_us(r) - epoch_us(s)) / 1000000.0), 6) AS lag_max, count(*) FILTER (WHERE epoch_us(r) < epoch_us(s)) AS n_negative_lag FROM q GROUP BY ALL"""


@CATALOGUE.add(_MINUTE_SQL)
def minute_activity(spark: SparkSession, d: str) -> DataFrame:
    """STR-02, 03, 04, 07, AGG-22, DT-08, DUP-09: quotes per token and minute of receipt."""
    ts = lambda c: F.col(c).try_cast("timestamp")
    rows = table(spark, d, "quote_updates").select("update_id", "token_id", "event_type", "price", "quote_size", ts("received_time_utc").alias("r"), ts("source_time_utc").alias("s")).dropDuplicates(["update_id"])
    lag = (F.unix_micros("r") - F.unix_micros("s")) / 1_000_000
    out = minutes.minute_activity(rows, ["token_id"], "r", "event_type", _KINDS, F.col("price"), F.col("quote_size"), lag)
    return out.select("token_id", F.unix_seconds("minute_start").alias("minute_s"), "n_rows", *[f"n_{k}" for k in _KINDS], F.col("size_sum").cast("double").alias("size_sum"), F.round(F.col("notional").cast("double"), 4).alias("notional"), F.round("lag_max", 6).alias("lag_max"), "n_negative_lag")


@CATALOGUE.add("SELECT user_id, epoch_us(date_trunc('minute', ts)) // 1000000 AS minute_s, count(*) AS n_rows, count(*) FILTER (WHERE event_type = 'click') AS n_click, count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase, CAST(sum(CAST(value AS DECIMAL(18, 6))) AS DOUBLE) AS size_sum FROM events GROUP BY ALL")
def minute_activity_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same expressions over a stream of the events, run to its end (STR-02, 03): append mode, one row per closed minute.

    A last row far in the future closes all minutes and stays open itself.
    """
    work = scratch_path(spark, "minutes")
    events = table(spark, d, "events").select("user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("received"))
    events.write.parquet(f"{work}/in/a")
    last = events.agg(F.lit(-1).cast("long").alias("user_id"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value"), (F.max("received") + F.expr("interval 1 day")).alias("received"))
    last.write.parquet(f"{work}/in/b")
    stream = spark.readStream.schema(events.schema).parquet(f"{work}/in/*")
    out = minutes.minute_activity(stream, ["user_id"], "received", "event_type", ["click", "purchase"], F.lit(1), F.col("value"), F.lit(0.0), "1 hour")
    query = out.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    done = spark.read.schema(out.schema).parquet(f"{work}/out")
    return done.select("user_id", F.unix_seconds("minute_start").alias("minute_s"), "n_rows", "n_click", "n_purchase", F.col("size_sum").cast("double").alias("size_sum"))


@CATALOGUE.add("""SELECT source_row_id, source_coach_name AS coach, nullif(game_date, '') AS game_date, game_date = '' AS was_empty, source_stadium || chr(10) || ' "' || coalesce(source_timezone, '') || '", ' AS remark FROM nfl_schedule""")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """SNK-01, 02, SRC-05: written as CSV and read again; null and empty text stay apart, line breaks, quotes and commas stay inside their cells."""
    path = scratch_path(spark, "csv")
    remark = F.concat("source_stadium", F.lit('\n "'), F.coalesce("source_timezone", F.lit("")), F.lit('", '))
    rows = table(spark, d, "nfl_schedule").select(F.col("source_row_id").cast("string").alias("source_row_id"), F.col("source_coach_name").alias("coach"), "game_date", remark.alias("remark"))
    writers.write_csv(rows, path)
    back = readers.csv_text(spark, path, rows.columns)
    return back.select(F.col("source_row_id").cast("long").alias("source_row_id"), "coach", F.nullif("game_date", F.lit("")).alias("game_date"), (F.col("game_date") == "").alias("was_empty"), "remark")


@CATALOGUE.add("""SELECT record_id, k.property, k.value FROM (SELECT record_id, unnest([{'property': 'week', 'value': json_extract_string(body, '$.week')}, {'property': 'round', 'value': json_extract_string(body, '$.round')}]) AS k FROM source_records) WHERE k.value IS NOT NULL""")
def nested_claims(spark: SparkSession, d: str) -> DataFrame:
    """SET-09, NRM-20: nested statements as rows; deprecated ones are left out."""
    field = lambda name: F.get_json_object("body", f"$.{name}")
    statement = lambda name: F.array(F.struct(field(name).alias("value"), F.lit("normal").alias("rank")), F.struct(F.lit("old").alias("value"), F.lit("deprecated").alias("rank")))
    rows = table(spark, d, "source_records").select("record_id", F.create_map(F.lit("week"), statement("week"), F.lit("round"), statement("round")).alias("claims"))
    return claim_rows(rows, "record_id", "claims").filter("value is not null").select("record_id", "property", "value")


@CATALOGUE.add("""SELECT doc_id, CASE WHEN text IS NULL THEN 'null' WHEN text = '' THEN 'empty' WHEN regexp_full_match(text, '\\s+') THEN 'blank' ELSE 'text' END AS kind FROM documents""")
def text_kinds(spark: SparkSession, d: str) -> DataFrame:
    """K5, NRM-10, 24: null, empty, blank and text stay apart."""
    c = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.when(c.isNull(), "null").when(c == "", "empty").when(n.blank_to_null(c).isNull(), "blank").otherwise("text").alias("kind"))


