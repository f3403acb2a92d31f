"""Joins, duplicates, aggregates, reshaping over the order tables and the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabspark.functions.mathx import bins
from tabspark.functions.times import micros
from tabspark.operators import aggs, joins, quality, reshape
from tabspark.plans.registry import Catalogue
from tabspark.session import table

CATALOGUE = Catalogue()


@CATALOGUE.add("SELECT c_mktsegment, c_custkey, total, rank FROM (SELECT c_mktsegment, c_custkey, total, row_number() OVER (PARTITION BY c_mktsegment ORDER BY total DESC, c_custkey) AS rank FROM (SELECT c_mktsegment, c_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)) WHERE rank <= 5")
def topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    """TOP-01, AGG-28: totals first, then the five largest of each segment."""
    spent = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    joined = spent.join(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    rank = F.row_number().over(W.partitionBy("c_mktsegment").orderBy(F.desc("total"), "c_custkey"))
    return joined.select("c_mktsegment", "c_custkey", "total", rank.alias("rank")).filter("rank <= 5")


@CATALOGUE.add("SELECT p_brand, count(*) AS n_lines, count(p_partkey) AS n_matched, round(sum(l_quantity), 2) AS quantity FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL")
def validated_join_m1(spark: SparkSession, d: str) -> DataFrame:
    """JN many-to-one, checked while it runs."""
    lines = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    parts = table(spark, d, "part").select("p_partkey", "p_brand")
    joined = joins.validated_join(lines, parts, ["p_partkey"], "left", "m:1", "side")
    return joined.groupBy("p_brand").agg(F.count("*").alias("n_lines"), F.count_if(F.col("side") == "both").alias("n_matched"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@CATALOGUE.add("""WITH a AS (SELECT o_orderkey, o_totalprice FROM orders), b AS (SELECT l_orderkey AS o_orderkey, count(*) AS n_lines FROM lineitem GROUP BY ALL)
SELECT o_orderkey, coalesce(n_lines, 0) AS n_lines, CASE WHEN n_lines IS NULL THEN 'left_only' ELSE 'both' END AS side FROM a LEFT JOIN b USING (o_orderkey)""")
def validated_join_11(spark: SparkSession, d: str) -> DataFrame:
    """JN one-to-one with indicator, counts filled with 0 (JN-26)."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    joined = joins.validated_join(table(spark, d, "orders").select("o_orderkey"), lines, ["o_orderkey"], "left", "1:1", "side")
    return joined.select("o_orderkey", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), "side")


@CATALOGUE.add("""WITH g AS (SELECT DISTINCT game_id, team, opponent, is_home FROM nfl_schedule), p AS (SELECT game_id, posteam AS team, count(*) AS n, CAST(sum(yards_gained) AS BIGINT) AS yards FROM nfl_plays WHERE posteam IS NOT NULL GROUP BY ALL),
t AS (SELECT g.*, n, yards FROM g LEFT JOIN p USING (game_id, team))
SELECT a.game_id, a.team, a.yards, b.yards AS opponent_yards, a.yards - b.yards AS yards_gap FROM t a JOIN t b ON a.game_id = b.game_id AND a.opponent = b.team""")
def self_pair_join(spark: SparkSession, d: str) -> DataFrame:
    """JN-15, 16, 20: each team's game with the opponent's row of the same game."""
    games = table(spark, d, "nfl_schedule").select("game_id", "team", "opponent", "is_home").distinct()
    plays = table(spark, d, "nfl_plays").filter("posteam is not null").groupBy("game_id", F.col("posteam").alias("team")).agg(F.sum("yards_gained").alias("yards"))
    teams = games.join(plays, ["game_id", "team"], "left")
    other = teams.select("game_id", F.col("team").alias("opponent"), F.col("yards").alias("opponent_yards"))
    return joins.validated_join(teams, other, ["game_id", "opponent"], "inner", "m:1").select("game_id", "team", "yards", "opponent_yards", (F.col("yards") - F.col("opponent_yards")).alias("yards_gap"))


@CATALOGUE.add("""SELECT game_id, max(CASE WHEN is_home THEN team END) AS first_team, max(CASE WHEN is_home THEN source_coach_name END) AS first_source_coach_name, max(CASE WHEN NOT is_home THEN team END) AS second_team, max(CASE WHEN NOT is_home THEN source_coach_name END) AS second_source_coach_name
FROM (SELECT DISTINCT ON (game_id, team) * FROM nfl_schedule ORDER BY game_id, team, source_row_id) GROUP BY game_id HAVING count(*) FILTER (WHERE is_home) = 1 AND count(*) FILTER (WHERE NOT is_home) = 1""")
def home_away_pairs(spark: SparkSession, d: str) -> DataFrame:
    """JN-17, SET-07: two rows of a game as one."""
    rows = quality.keep_first(table(spark, d, "nfl_schedule"), ["game_id", "team"], ["source_row_id"])
    return reshape.pair_rows(rows, "game_id", "is_home", ["team", "source_coach_name"])


@CATALOGUE.add("""WITH a AS (SELECT l_partkey, sum(l_quantity) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL), b AS (SELECT l_partkey, sum(l_quantity) AS accepted FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL)
SELECT l_partkey, round(returned, 2) AS returned, round(accepted, 2) AS accepted, CASE WHEN returned IS NULL THEN 'right_only' WHEN accepted IS NULL THEN 'left_only' ELSE 'both' END AS side FROM a FULL JOIN b USING (l_partkey)""")
def full_outer_pair(spark: SparkSession, d: str) -> DataFrame:
    """JN-18."""
    side = lambda flag, name: table(spark, d, "lineitem").filter(F.col("l_returnflag") == flag).groupBy("l_partkey").agg(F.round(F.sum("l_quantity"), 2).alias(name))
    return joins.validated_join(side("R", "returned"), side("A", "accepted"), ["l_partkey"], "full_outer", "1:1", "side")


@CATALOGUE.add("""SELECT (SELECT count(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS without_orders, (SELECT count(*) FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS with_orders,
(SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)) AS orphan_lines""")
def anti_semi_counts(spark: SparkSession, d: str) -> DataFrame:
    """JN-22, JX-04, JX-05, FLT-04."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, d, "orders").select("o_custkey", F.col("o_orderkey").alias("l_orderkey"))
    without = customers.join(orders, "o_custkey", "left_anti").agg(F.count("*").alias("without_orders"))
    have = customers.join(orders, "o_custkey", "left_semi").agg(F.count("*").alias("with_orders"))
    orphans = table(spark, d, "lineitem").select("l_orderkey").distinct().join(orders, "l_orderkey", "left_anti").agg(F.count("*").alias("orphan_lines"))
    return without.crossJoin(have).crossJoin(orphans)  # three single rows


@CATALOGUE.add("""WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS us FROM events),
j AS (SELECT a.event_id, b.event_id AS click_id, count(*) OVER (PARTITION BY a.event_id) AS n FROM e a JOIN e b ON a.user_id = b.user_id AND abs(a.us - b.us) <= 3600000000 WHERE a.event_type = 'purchase' AND b.event_type = 'click')
SELECT event_id, click_id FROM j WHERE n = 1""")
def band_join_unique(spark: SparkSession, d: str) -> DataFrame:
    """JX-06: purchases with exactly one click of the user within an hour."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", micros(F.col("ts")).alias("us"))
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("us").alias("click_us"))
    return joins.band_join_unique(events.filter("event_type = 'purchase'"), clicks, ["user_id"], "us", "click_us", 3_600_000_000, "event_id").select("event_id", "click_id")


@CATALOGUE.add("""WITH m AS (SELECT match_id, least(lower(trim(player1_name)), lower(trim(player2_name))) AS low, greatest(lower(trim(player1_name)), lower(trim(player2_name))) AS high FROM tennis_matches)
SELECT low, high, count(DISTINCT match_id) AS n_matches FROM m GROUP BY ALL HAVING count(DISTINCT match_id) > 1""")
def unordered_pair_match(spark: SparkSession, d: str) -> DataFrame:
    """JX-09: pairs of players that met more than once, in either order."""
    name = lambda c: F.lower(F.trim(F.col(c)))
    pairs = table(spark, d, "tennis_matches").select("match_id", joins.unordered_pair(name("player1_name"), name("player2_name")).alias("p"))
    return pairs.groupBy("p.low", "p.high").agg(F.count_distinct("match_id").alias("n_matches")).filter("n_matches > 1")


@CATALOGUE.add("""WITH s AS (SELECT user_id, epoch_us(min(ts)) AS a, epoch_us(max(ts)) AS b FROM events GROUP BY ALL), x AS (SELECT user_id, a, b, unnest(generate_series(a // 86400000000, (b - 1) // 86400000000)) AS day_no FROM s WHERE b > a)
SELECT user_id, day_no, round((least(b, (day_no + 1) * 86400000000) - greatest(a, day_no * 86400000000)) / 1000000.0, 6) AS overlap_s FROM x""")
def overlap_seconds(spark: SparkSession, d: str) -> DataFrame:
    """JX-12: the span of each user's events on each UTC day."""
    spans = table(spark, d, "events").groupBy("user_id").agg(micros(F.min("ts")).alias("a"), micros(F.max("ts")).alias("b"))
    return joins.day_overlaps(spans, "a", "b").select("user_id", "day_no", F.round("overlap_s", 6).alias("overlap_s"))


@CATALOGUE.add("""WITH g AS (SELECT DISTINCT game_id, team, opponent FROM nfl_schedule) SELECT a.game_id, a.team, coalesce(b.opponent = a.team, FALSE) AS agrees FROM g a LEFT JOIN g b ON a.game_id = b.game_id AND a.opponent = b.team""")
def reciprocal_pair(spark: SparkSession, d: str) -> DataFrame:
    """JX-14, DUP-07: each team's row must be named by its opponent's row."""
    games = table(spark, d, "nfl_schedule").select("game_id", "team", F.concat_ws("|", "game_id", "team").alias("me"), F.concat_ws("|", "game_id", "opponent").alias("other")).distinct()
    linked = joins.reciprocal(games, "me", "other", "other")
    return games.join(linked.select("me", "agrees"), "me").select("game_id", "team", "agrees")


@CATALOGUE.add("SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM tennis_matches)) AS n_distinct_rows, (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (source_row_id) FROM tennis_matches)) AS n_distinct_content FROM tennis_matches")
def dedupe_exact(spark: SparkSession, d: str) -> DataFrame:
    """DUP-01."""
    df = table(spark, d, "tennis_matches")
    parts = [df.agg(F.count("*").alias("n_rows")), df.dropDuplicates().agg(F.count("*").alias("n_distinct_rows")), df.drop("source_row_id").dropDuplicates().agg(F.count("*").alias("n_distinct_content"))]
    return parts[0].crossJoin(parts[1]).crossJoin(parts[2])  # three single rows


@CATALOGUE.add("SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY text")
def keep_first_text(spark: SparkSession, d: str) -> DataFrame:
    """DUP-02: the first document of each text; texts meet by their hash and length of content, then by the text itself."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return docs.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies")).select("doc_id", "n_copies")


@CATALOGUE.add("""WITH l AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL), q AS (SELECT l_orderkey, bool_or(n > 1) AS bad FROM l GROUP BY ALL)
SELECT l_orderkey, count(*) AS n_lines, count(*) FILTER (WHERE n > 1) AS n_duplicated, bool_or(bad) AS is_quarantined FROM lineitem JOIN l USING (l_orderkey, l_linenumber) JOIN q USING (l_orderkey) GROUP BY ALL""")
def whole_group_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """DUP-03, 05, 06: a repeated line number puts its whole order into quarantine."""
    out = quality.quarantine_summary(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_orderkey"])
    return out.withColumnRenamed("n_rows", "n_lines")


@CATALOGUE.add("""WITH r AS (SELECT o_orderkey, nullif(concat_ws('|', CASE WHEN o_totalprice < 10000 THEN 'small' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'low' END), '') AS reason FROM orders)
SELECT coalesce(reason, 'sound') AS reason, count(*) AS n FROM r GROUP BY ALL""")
def quarantine_reasons(spark: SparkSession, d: str) -> DataFrame:
    """DUP-05, FLT-11: sound and quarantined rows are disjoint and complete."""
    rules = {"small": F.col("o_totalprice") < 10000, "pending": F.col("o_orderstatus") == "P", "low": F.col("o_orderpriority") == "5-LOW"}
    sound, bad = quality.quarantine_split(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"), quality.reasons(rules))
    return sound.select(F.lit("sound").alias("reason")).unionByName(bad.select("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@CATALOGUE.add("""SELECT CASE WHEN NOT coalesce(air_yards IS NOT NULL, FALSE) THEN 'has_air_yards' WHEN NOT coalesce(down BETWEEN 1 AND 4, FALSE) THEN 'has_down' WHEN NOT coalesce(regexp_full_match(passer_player_id, '00-[0-9]{7}'), FALSE) THEN 'has_passer' ELSE 'all' END AS first_failure,
count(*) AS n FROM nfl_plays GROUP BY ALL""")
def first_failure_gates(spark: SparkSession, d: str) -> DataFrame:
    """FLT-13: the first gate that each play fails."""
    gates = {"has_air_yards": F.col("air_yards").isNotNull(), "has_down": F.col("down").between(1, 4), "has_passer": F.col("passer_player_id").rlike(r"\A00-[0-9]{7}\z")}
    return table(spark, d, "nfl_plays").groupBy(F.coalesce(quality.first_failure(gates), F.lit("all")).alias("first_failure")).agg(F.count("*").alias("n"))


@CATALOGUE.add("""SELECT play_type, count(air_yards > 10) AS deep_known, count(*) FILTER (WHERE air_yards > 10) AS deep_yes, count(down = 3) AS third_known, count(*) FILTER (WHERE down = 3) AS third_yes,
count(receiver_player_id = passer_player_id) AS self_known, count(*) FILTER (WHERE receiver_player_id = passer_player_id) AS self_yes FROM nfl_plays GROUP BY ALL""")
def known_yes_counters(spark: SparkSession, d: str) -> DataFrame:
    """AGG-10."""
    flags = {"deep": F.col("air_yards") > 10, "third": F.col("down") == 3, "self": F.col("receiver_player_id") == F.col("passer_player_id")}
    return table(spark, d, "nfl_plays").groupBy("play_type").agg(*aggs.known_yes(flags))


@CATALOGUE.add("""SELECT posteam, season, round(sum(air_yards), 2) AS air_or_null, round(coalesce(sum(air_yards), 0), 2) AS air_or_zero, count(*) AS n_rows, count(air_yards) AS n_known, count(DISTINCT passer_player_id) AS n_passers
FROM nfl_plays WHERE posteam IS NOT NULL GROUP BY ALL""")
def sum_min1_vs_zero(spark: SparkSession, d: str) -> DataFrame:
    """AGG-01, 02, 03, 04, 09."""
    plays = aggs.drop_null_keys(table(spark, d, "nfl_plays"), ["posteam"])
    air = F.col("air_yards")
    return plays.groupBy("posteam", "season").agg(F.round(aggs.sum_known(air), 2).alias("air_or_null"), F.round(aggs.sum_or_zero(air), 2).alias("air_or_zero"), F.count("*").alias("n_rows"), F.count(air).alias("n_known"), F.count_distinct("passer_player_id").alias("n_passers"))


@CATALOGUE.add("SELECT l_returnflag, round(sum(CASE WHEN l_discount > 0 AND l_tax <> 0 THEN l_tax END) / nullif(sum(CASE WHEN l_discount > 0 AND l_tax <> 0 THEN l_discount END), 0), 6) AS paired, round(sum(l_tax) / sum(l_discount), 6) AS pooled FROM lineitem GROUP BY ALL")
def paired_ratio(spark: SparkSession, d: str) -> DataFrame:
    """AGG-11, 12: a tax of zero is unknown."""
    tax = F.nullif(F.col("l_tax"), F.lit(0.0))
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(aggs.paired_ratio(tax, F.col("l_discount")), 6).alias("paired"), F.round(aggs.pooled_ratio(F.col("l_tax"), F.col("l_discount")), 6).alias("pooled"))


@CATALOGUE.add("""SELECT l_returnflag, metric, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(median(value), 6) AS median, round(sum(value), 2) AS total
FROM (UNPIVOT (SELECT l_returnflag, l_quantity, l_extendedprice, l_discount FROM lineitem) ON l_quantity, l_extendedprice, l_discount INTO NAME metric VALUE value) GROUP BY ALL""")
def long_metrics(spark: SparkSession, d: str) -> DataFrame:
    """AGG-05, 13, 20."""
    out = aggs.long_metrics(table(spark, d, "lineitem"), ["l_returnflag"], ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("l_returnflag", "metric", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std", "median")], F.round("total", 2).alias("total"))


@CATALOGUE.add("""WITH p AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL), a AS (SELECT l_partkey, count(*) AS a_degree FROM p GROUP BY ALL), b AS (SELECT l_suppkey, count(*) AS b_degree FROM p GROUP BY ALL)
SELECT l_partkey, l_suppkey, a_degree, b_degree, a_degree = 1 AND b_degree = 1 AS is_bijective FROM p JOIN a USING (l_partkey) JOIN b USING (l_suppkey)""")
def bijectivity(spark: SparkSession, d: str) -> DataFrame:
    """AGG-14, JX-03 over every line item."""
    return aggs.bijectivity(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@CATALOGUE.add("""SELECT o_custkey, count(*) AS n_orders, """ + ", ".join(f"CASE WHEN count(*) >= 5 THEN count(*) FILTER (WHERE o_orderpriority = '{p}') END AS n_{c}" for p, c in (("1-URGENT", "1_urgent"), ("2-HIGH", "2_high"), ("5-LOW", "5_low"))) + " FROM orders GROUP BY ALL")
def vocabulary_counts(spark: SparkSession, d: str) -> DataFrame:
    """AGG-16: counts per priority; null below five orders."""
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), *aggs.vocabulary_counts(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH", "5-LOW"], F.count("*") >= 5))


@CATALOGUE.add("SELECT l_orderkey, CASE WHEN min(l_returnflag) = max(l_returnflag) THEN min(l_returnflag) END AS only_flag, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN min(l_linestatus) END AS only_status FROM lineitem GROUP BY ALL")
def exactly_one_value(spark: SparkSession, d: str) -> DataFrame:
    """AGG-18."""
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(aggs.only_value(F.col("l_returnflag")).alias("only_flag"), aggs.only_value(F.col("l_linestatus")).alias("only_status"))


@CATALOGUE.add("""WITH o AS (SELECT o_orderkey, CASE WHEN o_totalprice IS NULL THEN 'unknown' WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'middle' ELSE 'high' END AS band FROM orders),
l AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY ALL)
SELECT band, count(*) AS n_orders, count(n) AS n_orders_with_lines, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_lines, round(sum(q) / sum(n), 6) AS mean_quantity FROM o LEFT JOIN l ON o_orderkey = l_orderkey GROUP BY ALL""")
def two_level_denominators(spark: SparkSession, d: str) -> DataFrame:
    """AGG-17, 19, 20, MTH-10: orders and lines per price band."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    band = bins(F.col("o_totalprice"), [100000, 300000], ["low", "middle", "high"])
    orders = table(spark, d, "orders").select("o_orderkey", band.alias("band")).join(lines, "o_orderkey", "left")
    return orders.groupBy("band").agg(F.count("*").alias("n_orders"), F.count("n").alias("n_orders_with_lines"), aggs.sum_or_zero(F.col("n")).alias("n_lines"), F.round(F.sum("q") / F.sum("n"), 6).alias("mean_quantity"))


@CATALOGUE.add("""WITH l AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS lines_total FROM lineitem GROUP BY ALL)
SELECT o_orderkey, round(lines_total - o_totalprice, 2) AS gap, coalesce(lines_total = o_totalprice, FALSE) AS agrees FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def reconciliation_gap(spark: SparkSession, d: str) -> DataFrame:
    """AGG-24."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("t"))
    return table(spark, d, "orders").join(lines, "o_orderkey", "left").select("o_orderkey", F.round(F.col("t") - F.col("o_totalprice"), 2).alias("gap"), F.coalesce(F.col("t") == F.col("o_totalprice"), F.lit(False)).alias("agrees"))


@CATALOGUE.add("""SELECT count(*) > 0 AS has_rows, count(DISTINCT o_orderkey) = count(*) AS unique_key, coalesce(min(o_totalprice) >= 0, FALSE) AS not_negative, bool_and(o_orderstatus IN ('O', 'F', 'P')) AS known_status, avg(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0.0 END) <= 0.01 AS priority_known,
count(*) > 0 AND count(DISTINCT o_orderkey) = count(*) AND coalesce(min(o_totalprice) >= 0, FALSE) AND bool_and(o_orderstatus IN ('O', 'F', 'P')) AND avg(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0.0 END) <= 0.01 AS all_pass FROM orders""")
def quality_gates(spark: SparkSession, d: str) -> DataFrame:
    """AGG-23, 31."""
    checks = {
        "has_rows": F.count("*") > 0,
        "unique_key": F.count_distinct("o_orderkey") == F.count("*"),
        "not_negative": F.min("o_totalprice") >= 0,
        "known_status": F.bool_and(F.col("o_orderstatus").isin("O", "F", "P")),
        "priority_known": F.avg(F.col("o_orderpriority").isNull().cast("double")) <= 0.01,
    }
    return quality.gates(table(spark, d, "orders"), checks)


@CATALOGUE.add("SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS n_customers, CAST(min(o_orderkey) AS BIGINT) AS first_order FROM orders GROUP BY ALL")
def coverage_inventory(spark: SparkSession, d: str) -> DataFrame:
    """AGG-07, 15, 27: month histogram per series."""
    return table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("n_customers"), F.min("o_orderkey").alias("first_order"))


@CATALOGUE.add("SELECT 'orders' AS table_name, column_name, n_rows, n_null, n_distinct FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct FROM orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")) + ")")
def table_report(spark: SparkSession, d: str) -> DataFrame:
    """SNK-07."""
    return quality.table_report(table(spark, d, "orders"), "orders").drop("data_type")


@CATALOGUE.add("""SELECT game_id, team, side FROM (SELECT DISTINCT game_id, posteam AS team, 'offense' AS side FROM nfl_plays UNION ALL SELECT DISTINCT game_id, defteam, 'defense' FROM nfl_plays) WHERE team IS NOT NULL""")
def two_sided_unpivot(spark: SparkSession, d: str) -> DataFrame:
    """SET-05, 08: each play's two teams as rows."""
    rows = reshape.two_sided(table(spark, d, "nfl_plays"), ["game_id"], {"offense": {"team": F.col("posteam")}, "defense": {"team": F.col("defteam")}})
    return rows.filter("team is not null").distinct()


@CATALOGUE.add("""SELECT person_id, count(*) FILTER (WHERE role = 'passer') AS n_passer, count(*) FILTER (WHERE role = 'receiver') AS n_receiver FROM (SELECT 'passer' AS role, passer_player_id AS person_id FROM nfl_plays UNION ALL SELECT 'receiver', receiver_player_id FROM nfl_plays)
WHERE person_id IS NOT NULL GROUP BY ALL""")
def role_unpivot(spark: SparkSession, d: str) -> DataFrame:
    """SET-06: passers and receivers as rows; partial counts meet before the shuffle, so the passer with a tenth of all plays is cheap."""
    rows = reshape.roles(table(spark, d, "nfl_plays"), [], {"passer": "passer_player_id", "receiver": "receiver_player_id"})
    return rows.groupBy("person_id").agg(F.count_if(F.col("role") == "passer").alias("n_passer"), F.count_if(F.col("role") == "receiver").alias("n_receiver"))


@CATALOGUE.add("SELECT n_nationkey AS key, n_name AS name, CAST(n_regionkey AS BIGINT) AS parent FROM nation UNION ALL SELECT r_regionkey, r_name, NULL FROM region")
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    """SET-01: a missing column is null."""
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("parent"))
    regions = table(spark, d, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    return reshape.union_all(nations, regions)


@CATALOGUE.add("""WITH a AS (SELECT l_partkey AS k, string_agg(DISTINCT l_suppkey, ',' ORDER BY l_suppkey) AS v FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL), b AS (SELECT l_partkey AS k, string_agg(DISTINCT l_suppkey, ',' ORDER BY l_suppkey) AS v FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL)
SELECT count(*) FILTER (WHERE b.v IS NULL) AS only_a, count(*) FILTER (WHERE a.v IS NULL) AS only_b, count(*) FILTER (WHERE a.v = b.v) AS agree, count(*) FILTER (WHERE a.v <> b.v) AS conflict FROM a FULL JOIN b USING (k)""")
def set_difference_counts(spark: SparkSession, d: str) -> DataFrame:
    """SET-03, 04: suppliers of returned against those of other parts."""
    lines = table(spark, d, "lineitem")
    return reshape.set_difference_counts(lines.filter("l_returnflag = 'R'"), lines.filter("l_returnflag = 'N'"), "l_partkey", "l_suppkey")
