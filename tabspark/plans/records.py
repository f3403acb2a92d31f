"""Records with reasons and statuses, readers and writers, identities, arrays, texts, streams: queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabspark.functions import mathx as m
from tabspark.functions import normalize as n
from tabspark.functions import text as x
from tabspark.functions import times
from tabspark.operators import contracts, evaluation, identity, joins, quality, reshape, temporal
from tabspark.operators import records as r
from tabspark.plans.registry import Catalogue
from tabspark.session import scratch_path, table
from tabspark.sources import readers, writers
from tabspark.streaming import minutes

CATALOGUE = Catalogue()


# readers and writers


@CATALOGUE.add("SELECT source_row_id, source_coach_name AS coach, nullif(game_date, '') AS game_date, nullif(source_timezone, '') AS zone FROM nfl_schedule")
def csv_empty_is_null(spark: SparkSession, d: str) -> DataFrame:
    """SRC-06, SRC-07: written as CSV and read with empty text as null."""
    path = scratch_path(spark, "csv")
    rows = table(spark, d, "nfl_schedule").select(F.col("source_row_id").cast("string").alias("source_row_id"), F.col("source_coach_name").alias("coach"), "game_date", F.col("source_timezone").alias("zone"))
    writers.write_csv(rows, path)
    return readers.csv_text(spark, path, rows.columns, empty_is_null=True).withColumn("source_row_id", F.col("source_row_id").cast("long"))


@CATALOGUE.add("SELECT team_abbr, season, count(*) AS n, round(sum(avg_time_to_throw), 4) AS total FROM nfl_ngs GROUP BY ALL")
def parquet_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """SNK-03, SNK-04, SNK-11, SRC-02: written by season, read again with two columns more than needed pruned away."""
    path = scratch_path(spark, "parquet")
    rows = table(spark, d, "nfl_ngs").withColumn("part", F.coalesce("season", F.lit(0)))
    writers.write_parquet(rows, path, ["part"])
    back = readers.parquet_table(spark, path, columns=["team_abbr", "season", "avg_time_to_throw", "not_there"])
    return back.groupBy("team_abbr", "season").agg(F.count("*").alias("n"), F.round(F.sum("avg_time_to_throw"), 4).alias("total"))


@CATALOGUE.add("SELECT p_partkey, p_brand, CASE WHEN p_retailprice > 950 THEN p_retailprice END AS price FROM part")
def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """SNK-05, SRC-12: JSON lines; what is no number is null."""
    path = scratch_path(spark, "jsonl")
    price = F.when(F.col("p_retailprice") > 950, F.col("p_retailprice")).otherwise(F.lit(float("nan")))
    writers.write_jsonl(table(spark, d, "part").select("p_partkey", "p_brand", price.alias("price")), path)
    return readers.jsonl(spark, path, "p_partkey bigint, p_brand string, price double")


@CATALOGUE.add("SELECT n_regionkey AS region, CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation")
def binding_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-13: query results in JSON as rows."""
    value = lambda c: F.struct(F.col(c).cast("string").alias("value"))
    docs = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(F.to_json(F.struct(F.struct(F.collect_list(F.struct(value("n_nationkey").alias("key"), value("n_name").alias("name"), value("n_regionkey").alias("region"))).alias("bindings")).alias("results"))).alias("doc"))
    out = readers.bindings(docs, "doc", ["region", "key", "name"])
    return out.withColumn("region", F.col("region").cast(table(spark, d, "nation").schema["n_regionkey"].dataType))


@CATALOGUE.add("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line, l_quantity AS quantity FROM lineitem")
def array_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-14: a record of equally long arrays as rows."""
    packed = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").cast("long").alias("line"), F.col("l_quantity").alias("quantity")))).alias("a"))
    arrays = packed.select("l_orderkey", F.col("a.line").alias("line"), F.col("a.quantity").alias("quantity"))
    return readers.column_arrays(arrays, ["l_orderkey"], ["line", "quantity"])


@CATALOGUE.add("SELECT CAST(box_row_id AS VARCHAR) AS box, TRY_CAST(season AS INTEGER) AS season, CAST(TRY_CAST(minutes AS DOUBLE) AS FLOAT) AS minutes, CAST(NULL AS VARCHAR) AS note, (SELECT count(*) FROM nba_player_games) AS n_rows FROM nba_player_games")
def contract_projection(spark: SparkSession, d: str) -> DataFrame:
    """SRC-21, SRC-22, FLT-05, FLT-06, NRM-30, ML-08: an alias, types, an optional column that is missing, and the agreed number of rows."""
    df = table(spark, d, "nba_player_games")
    stats = contracts.columns_with_prefix(df, "minutes", "season")
    contract = contracts.Contract({"box": "string", "season": "int", "minutes": "float"}, {"note": "string"}, {"box": ["Box Row Id"]})
    counted = contracts.check_rows(df, df.count())
    return contract.apply(counted.select("box_row_id", *[c for c in stats if c != "season_type"])).withColumn("n_rows", F.lit(df.count()))


@CATALOGUE.add("SELECT count(*) AS n_rows, count(*) FILTER (WHERE game_date IS NULL) AS n_null_date, count(DISTINCT game_id) AS n_games, min(season) AS first_season, max(season) AS last_season, sha256(string_agg(DISTINCT game_id, '|' ORDER BY game_id)) AS games_digest FROM nfl_schedule")
def table_digest(spark: SparkSession, d: str) -> DataFrame:
    """SNK-07: rows, nulls, games, range and a digest of the different games. The digest sorts a set of keys, not rows."""
    rows = table(spark, d, "nfl_schedule")
    about = rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col("game_date").isNull()).alias("n_null_date"), F.count_distinct("game_id").alias("n_games"), F.min("season").alias("first_season"), F.max("season").alias("last_season"))
    digest = rows.select("game_id").distinct().agg(F.sha2(F.array_join(F.array_sort(F.collect_list("game_id")), "|"), 256).alias("games_digest"))
    return about.crossJoin(digest)  # two single rows


@CATALOGUE.add("""SELECT 'r' || n_regionkey AS archive, n_name || '.txt' AS member, CASE WHEN n_nationkey % 5 = 0 THEN 'missing' WHEN n_nationkey % 5 = 1 THEN 'digest' ELSE 'ok' END AS status FROM nation UNION ALL SELECT 'r' || r_regionkey, 'about', 'extra' FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)""")
def archive_checks(spark: SparkSession, d: str) -> DataFrame:
    """SRC-08, SRC-10, SRC-19, SRC-20: members of archives against a manifest of sizes and digests; one archive per region."""
    from pyspark.sql.types import BinaryType

    @F.pandas_udf(BinaryType())
    def pack(names):  # an archive from a list of names
        import io
        import zipfile

        import pandas as pd

        out = []
        for members in names:
            data = io.BytesIO()
            with zipfile.ZipFile(data, "w") as z:
                for member in members:
                    z.writestr(f"{member}.txt", member)
                z.writestr("about", "x")
            out.append(data.getvalue())
        return pd.Series(out)

    nations = table(spark, d, "nation").withColumn("archive", F.concat(F.lit("r"), F.col("n_regionkey").cast("string")))
    archives = nations.groupBy(F.col("archive").alias("path")).agg(F.collect_list(F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name"))).alias("names")).select("path", pack("names").alias("content"))
    digest = F.when(F.col("n_nationkey") % 5 == 1, F.lit("0" * 64)).otherwise(F.sha2("n_name", 256))
    manifest = nations.select("archive", F.concat("n_name", F.lit(".txt")).alias("member"), F.length("n_name").cast("long").alias("size"), digest.alias("sha256"))
    return readers.checked_members(readers.members_of(archives), manifest)


# normalising


@CATALOGUE.add("SELECT play_row_id, CASE WHEN play_id = floor(play_id) THEN CAST(CAST(play_id AS BIGINT) AS VARCHAR) END AS play, CASE WHEN air_yards = floor(air_yards) THEN CAST(CAST(air_yards AS BIGINT) AS VARCHAR) END AS air, nullif(trim(posteam), '') AS team FROM nfl_plays")
def identities_by_type(spark: SparkSession, d: str) -> DataFrame:
    """NRM-04."""
    df = table(spark, d, "nfl_plays")
    return df.select("play_row_id", r.typed_identity(df, "play_id").alias("play"), r.typed_identity(df, "air_yards").alias("air"), r.typed_identity(df, "posteam").alias("team"))


_BOX_STATS = ["points", "rebounds", "assists", "threes", "steals", "blocks", "turnovers", "field_goals_attempted", "free_throws_attempted"]
_FLAG = "CASE WHEN lower(trim({0})) IN ('true', '1', '1.0', 't', 'yes') THEN TRUE WHEN lower(trim({0})) IN ('false', '0', '0.0', 'f', 'no') THEN FALSE END AS {0}"


@CATALOGUE.add("SELECT box_row_id, game_id, player_id, team_id, opponent_id, TRY_CAST(season AS INTEGER) AS season, " + ", ".join(_FLAG.format(c) for c in ("is_home", "did_not_play", "boxscore_observed")) + ", " + ", ".join(f"CASE WHEN regexp_full_match(trim({c}), '[0-9]{{1,18}}') THEN CAST(trim({c}) AS BIGINT) END AS {c}" for c in _BOX_STATS) + " FROM nba_player_games")
def box_projection(spark: SparkSession, d: str) -> DataFrame:
    """NRM-11: the whole canonical projection of a box score from one mapping."""
    columns = {c: F.col(c) for c in ("box_row_id", "game_id", "player_id", "team_id", "opponent_id")} | {"season": F.col("season").try_cast("int")}
    columns |= {c: n.flag(F.col(c)) for c in ("is_home", "did_not_play", "boxscore_observed")} | {c: n.unsigned(F.col(c)) for c in _BOX_STATS}
    return table(spark, d, "nba_player_games").select(*[c.alias(name) for name, c in columns.items()])


@CATALOGUE.add("""WITH g AS (SELECT team, TRY_CAST(season AS BIGINT) AS season, count(DISTINCT game_id) AS n_games FROM nfl_schedule GROUP BY ALL)
SELECT ngs_row_id, coalesce(regexp_full_match(player_gsis_id, '00-[0-9]{7}'), FALSE) AS id_valid, CASE s.season_type WHEN 'REG' THEN 'regular' WHEN 'POST' THEN 'post' ELSE 'other' END AS kind, week BETWEEN 1 AND 22 AS week_valid,
CASE WHEN source_snapshot_at_utc IS NULL THEN 'unknown' WHEN source_snapshot_at_utc >= TIMESTAMP '2025-03-15' THEN 'after_cutoff' ELSE 'known' END AS snapshot_status, coalesce(n_games, 0) AS n_games
FROM nfl_ngs s LEFT JOIN g ON s.team_abbr = g.team AND s.season = g.season""")
def context_records(spark: SparkSession, d: str) -> DataFrame:
    """NRM-13, NRM-28, DT-12: ids, season, week and snapshot of a context table, with the schedule of the same season attached."""
    games = table(spark, d, "nfl_schedule").groupBy(F.col("team").alias("team_abbr"), F.col("season").try_cast("long").alias("season")).agg(F.count_distinct("game_id").alias("n_games"))
    rows = r.not_after_snapshot(table(spark, d, "nfl_ngs"), "source_snapshot_at_utc", F.lit("2025-03-14 23:59:59.999999").cast("timestamp"))
    kind = n.alias(F.when(F.col("season_type").isin("REG", "POST"), F.col("season_type")).otherwise("other"), {"REG": "regular", "POST": "post"})
    status = F.when(F.col("source_snapshot_at_utc").isNull(), "unknown").when(F.col("in_snapshot"), "known").otherwise("after_cutoff")
    out = joins.validated_join(rows.withColumn("season", F.col("season").cast("long")), games, ["team_abbr", "season"], "left", "m:1")
    return out.select("ngs_row_id", n.gsis_valid(F.col("player_gsis_id")).alias("id_valid"), kind.alias("kind"), F.col("week").between(1, 22).alias("week_valid"), status.alias("snapshot_status"), F.coalesce("n_games", F.lit(0)).alias("n_games"))


@CATALOGUE.add("""SELECT play_row_id, coalesce(regexp_extract(game_id, '^([0-9]{4})_', 1) = CAST(season AS VARCHAR), FALSE) AS season_agrees, CASE WHEN play_type IN ('pass', 'run') THEN 'scrimmage' WHEN play_type IN ('punt', 'kickoff', 'field_goal', 'extra_point') THEN 'kicking' ELSE 'other' END AS category,
CASE WHEN air_yards IS NOT NULL AND passer_player_id IS NOT NULL AND receiver_player_id IS NOT NULL THEN 'full' WHEN air_yards IS NOT NULL OR passer_player_id IS NOT NULL OR receiver_player_id IS NOT NULL THEN 'partial' ELSE 'none' END AS charting FROM nfl_plays""")
def charted_plays(spark: SparkSession, d: str) -> DataFrame:
    """NRM-14: participation and charting columns of plays: season equality, category, how much was charted."""
    known = [F.col(c).isNotNull() for c in ("air_yards", "passer_player_id", "receiver_player_id")]
    category = F.when(F.col("play_type").isin("pass", "run"), "scrimmage").when(F.col("play_type").isin("punt", "kickoff", "field_goal", "extra_point"), "kicking").otherwise("other")
    agrees = F.coalesce(n.extract(F.col("game_id"), "^([0-9]{4})_") == F.col("season").cast("string"), F.lit(False))
    return table(spark, d, "nfl_plays").select("play_row_id", agrees.alias("season_agrees"), category.alias("category"), F.when(known[0] & known[1] & known[2], "full").when(known[0] | known[1] | known[2], "partial").otherwise("none").alias("charting"))


# What an injury report says of a player.
STATUSES = ["Available", "Probable", "Questionable", "Doubtful", "Out"]


@CATALOGUE.add("""WITH p AS (SELECT doc_id, coalesce(regexp_extract(text, '([A-Z][^ .()]+) \\([a-z ]+\\) is listed as', 1), '') AS person, upper(regexp_extract(text, 'is listed as ([a-z]+)', 1)[1]) || regexp_extract(text, 'is listed as ([a-z]+)', 1)[2:] AS status, coalesce(regexp_extract(text, '[0-9]{4}_[0-9]{2}_[A-Z]{3}_[A-Z]{3}', 0), '') AS game FROM documents WHERE text IS NOT NULL),
e AS (SELECT *, CASE WHEN person <> '' AND status IN ('Available', 'Probable', 'Questionable', 'Doubtful', 'Out') THEN 'player_status' ELSE 'unresolved' END AS entry_type FROM p)
SELECT doc_id, person, status, game, entry_type, entry_type <> 'unresolved' AND game <> '' AS parse_valid FROM e""")
def injury_entries(spark: SparkSession, d: str) -> DataFrame:
    """NRM-15: person, status and game of a report, its kind of entry and whether it parses."""
    rows = table(spark, d, "documents").filter("text is not null").select(
        "doc_id",
        F.regexp_extract("text", r"([A-Z][^ .()]+) \([a-z ]+\) is listed as", 1).alias("person"),
        F.initcap(F.regexp_extract("text", "is listed as ([a-z]+)", 1)).alias("status"),
        F.regexp_extract("text", "[0-9]{4}_[0-9]{2}_[A-Z]{3}_[A-Z]{3}", 0).alias("game"),
    )
    out = r.report_entries(rows, F.col("person"), F.col("status"), F.lit(None).cast("string"), [F.col("game")], STATUSES)
    return out.select("doc_id", "person", "status", "game", "entry_type", "parse_valid")


_BANDS = ["Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy", "Hazardous"]  # Fixed values: bands of the index
_BAND_EDGES = [50, 100, 150, 200, 300]


@CATALOGUE.add("""WITH s AS (SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS place, CAST(o_orderdate AS DATE) AS day, CAST(floor(o_totalprice / 1000) AS BIGINT) AS reading FROM orders WHERE o_custkey BETWEEN 1 AND 99999),
c AS (SELECT *, count(*) OVER (PARTITION BY place, day) AS n FROM s)
SELECT o_orderkey, place, reading, CASE WHEN reading <= 50 THEN 'Good' WHEN reading <= 100 THEN 'Moderate' WHEN reading <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN reading <= 200 THEN 'Unhealthy' WHEN reading <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS band,
CASE WHEN reading <= 100 AND reading > 50 THEN 'matches' ELSE 'differs' END AS band_check, concat_ws(';', CASE WHEN year(day) <> 1997 THEN 'other_year' END, CASE WHEN n > 1 THEN 'conflicting_rows' END) AS exclusion_reason FROM c
UNION ALL SELECT o_orderkey, NULL, CAST(floor(o_totalprice / 1000) AS BIGINT), CASE WHEN o_totalprice < 51000 THEN 'Good' WHEN o_totalprice < 101000 THEN 'Moderate' WHEN o_totalprice < 151000 THEN 'Unhealthy for Sensitive Groups' WHEN o_totalprice < 201000 THEN 'Unhealthy' WHEN o_totalprice < 301000 THEN 'Very Unhealthy' ELSE 'Hazardous' END,
CASE WHEN o_totalprice >= 51000 AND o_totalprice < 101000 THEN 'matches' ELSE 'differs' END, concat_ws(';', 'invalid_codes', CASE WHEN year(o_orderdate) <> 1997 THEN 'other_year' END) FROM orders WHERE NOT coalesce(o_custkey BETWEEN 1 AND 99999, FALSE)""")
def banded_readings(spark: SparkSession, d: str) -> DataFrame:
    """NRM-16, MTH-10: whole readings per place and day with their band, the band stated, and what excludes them."""
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("code"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.floor(F.col("o_totalprice") / 1000).cast("string").alias("value"))
    out = r.banded_readings(rows, F.col("code"), F.col("date"), F.col("value"), F.lit("moderate"), F.lit("3"), _BAND_EDGES, _BANDS, F.lit(1997))
    return out.select("o_orderkey", "place", "reading", "band", "band_check", "exclusion_reason")


@CATALOGUE.add("""WITH p AS (SELECT p_partkey, (4 + p_size % 4) AS feet, (p_size % 13) AS inches, p_retailprice AS pounds FROM part) SELECT p_partkey, round(CAST(feet * 30.48 + inches * 2.54 AS DOUBLE), 4) AS height_cm, round(pounds * 0.45359237, 4) AS weight_kg FROM p""")
def combine_measures(spark: SparkSession, d: str) -> DataFrame:
    """NRM-17, MTH-12: feet and inches, pounds."""
    height = F.concat((4 + F.col("p_size") % 4).cast("string"), F.lit("-"), (F.col("p_size") % 13).cast("string"))
    return table(spark, d, "part").select("p_partkey", F.round(n.height_cm(height), 4).alias("height_cm"), F.round(m.kilograms(F.col("p_retailprice")), 4).alias("weight_kg"))


@CATALOGUE.add("""WITH s AS (SELECT s_suppkey, s_suppkey % 5 AS k, CAST(s_acctbal AS VARCHAR) AS amount, s_acctbal FROM supplier)
SELECT s_suppkey, CASE k WHEN 0 THEN 'missing' WHEN 1 THEN 'unit' WHEN 2 THEN 'bounds' ELSE CASE WHEN s_acctbal <> floor(s_acctbal) THEN 'fraction' WHEN s_acctbal < 0 THEN 'negative' END END AS count_reason,
CASE WHEN k > 2 AND s_acctbal = floor(s_acctbal) AND s_acctbal >= 0 THEN CAST(CAST(s_acctbal AS BIGINT) AS VARCHAR) END AS count_value, CASE WHEN k = 3 THEN 'precision' END AS day_reason, CASE WHEN k <> 3 THEN '2001-02-03' END AS day_value FROM s""")
def typed_statements(spark: SparkSession, d: str) -> DataFrame:
    """NRM-18: whole counts without a unit and with exact bounds, days of full precision; else a reason."""
    k, amount = F.col("s_suppkey") % 5, F.col("s_acctbal").cast("string")
    value = F.when(k != 0, F.to_json(F.struct(amount.alias("amount"), F.when(k == 1, "metre").otherwise("1").alias("unit"), F.when(k == 2, F.lit("-7")).alias("upperBound"))))
    count = identity.typed_statement(value, F.lit(None).cast("int"), "count")
    day = identity.typed_statement(F.lit("+2001-02-03T00:00:00Z"), F.when(k == 3, 9).otherwise(11), "day")
    return table(spark, d, "supplier").select("s_suppkey", count["reason"].alias("count_reason"), count["value"].alias("count_value"), day["reason"].alias("day_reason"), day["value"].alias("day_value"))


@CATALOGUE.add("""WITH v AS (SELECT DISTINCT record_id, json_extract_string(body, '$.team') AS team, json_extract_string(body, '$.formation') AS formation FROM source_records)
SELECT record_id, CASE WHEN team IS NULL THEN '' ELSE team END AS team, CASE WHEN team IS NULL THEN 'missing' END AS reason, CASE WHEN team IS NULL OR formation IS NULL THEN 'incomplete' ELSE 'valid' END AS shape FROM v""")
def known_statements(spark: SparkSession, d: str) -> DataFrame:
    """NRM-20, NRM-22: statements of a record without the deprecated ones, a mandatory one, and the shape of its payload."""
    field = lambda name: F.get_json_object("body", f"$.{name}")
    claims = F.array(F.struct(field("team").alias("value"), F.lit("normal").alias("rank")), F.struct(F.lit("old").alias("value"), F.lit("deprecated").alias("rank")), F.struct(field("team").alias("value"), F.lit("preferred").alias("rank")))
    known = r.known_statements(claims)
    shape = r.payload_shape(F.col("body"), "team string, formation string", ["team", "formation"])
    return table(spark, d, "source_records").select("record_id", F.array_join(known["values"], "|").alias("team"), known["reason"].alias("reason"), shape.alias("shape")).distinct()


@CATALOGUE.add("SELECT listing_id, provider, coalesce(nullif(trim(tournament), ''), nullif(trim(tour_label), '')) AS label, CASE WHEN nullif(trim(tournament), '') IS NOT NULL THEN 'en' WHEN nullif(trim(tour_label), '') IS NOT NULL THEN 'mul' END AS language FROM match_listings")
def label_languages(spark: SparkSession, d: str) -> DataFrame:
    """NRM-21."""
    best = n.language_fallback(F.col("tournament"), F.col("tour_label"))
    return table(spark, d, "match_listings").select("listing_id", "provider", best["label"].alias("label"), best["language"].alias("language"))


@CATALOGUE.add("""SELECT game_id, CASE WHEN count(DISTINCT source_stadium) = 1 THEN min(source_stadium) END AS stadium, CASE WHEN count(DISTINCT source_coach_name) = 1 THEN min(source_coach_name) END AS coach, CASE WHEN count(DISTINCT season) = 1 THEN min(season) END AS season,
concat_ws('|', CASE WHEN count(DISTINCT source_stadium) > 1 THEN 'stadium_conflict' WHEN count(source_stadium) = 0 THEN 'stadium_missing' END, CASE WHEN count(DISTINCT source_coach_name) > 1 THEN 'coach_conflict' END, CASE WHEN count(DISTINCT season) > 1 THEN 'season_conflict' WHEN count(season) = 0 THEN 'season_missing' END) AS problems,
CASE WHEN count(DISTINCT source_stadium) <> 1 OR count(DISTINCT season) <> 1 THEN 'unusable' WHEN count(DISTINCT source_coach_name) > 1 THEN 'partial' ELSE 'complete' END AS status FROM nfl_schedule GROUP BY game_id""")
def consolidated_games(spark: SparkSession, d: str) -> DataFrame:
    """NRM-23, AGG-18, AGG-31: one row per game from its statements, with its problems and its status."""
    return r.consolidated_events(table(spark, d, "nfl_schedule"), "game_id", {"stadium": F.col("source_stadium"), "coach": F.col("source_coach_name"), "season": F.col("season")}, ["stadium", "season"])


@CATALOGUE.add("WITH c AS (SELECT condition_id, min(token_id) AS a, max(token_id) AS b, count(DISTINCT token_id) AS n_tokens FROM quote_updates GROUP BY condition_id) SELECT condition_id, coalesce(regexp_full_match(condition_id, '0x[0-9a-f]{64}'), FALSE) AND coalesce(regexp_full_match(a, '[0-9]+'), FALSE) AND coalesce(regexp_full_match(b, '[0-9]+'), FALSE) AND coalesce(a <> b, FALSE) AS is_contract, n_tokens FROM c")
def contract_identities(spark: SparkSession, d: str) -> DataFrame:
    """NRM-25, TXT-09: a condition with its two different tokens."""
    per = table(spark, d, "quote_updates").groupBy("condition_id").agg(F.min("token_id").alias("a"), F.max("token_id").alias("b"), F.count_distinct("token_id").alias("n_tokens"))
    return per.select("condition_id", n.contract_identity(F.col("condition_id"), F.col("a"), F.col("b")).alias("is_contract"), "n_tokens")


@CATALOGUE.add("""WITH e AS (SELECT event_slug, outcome_player, token_id FROM book_snapshots WHERE outcome_player IS NOT NULL GROUP BY ALL), u AS (SELECT event_slug, count(DISTINCT token_id) AS n_tokens, count(DISTINCT outcome_player) AS n_players FROM e GROUP BY ALL)
SELECT e.event_slug, e.outcome_player, e.token_id, n_tokens = 2 AND n_players = 2 AS is_verified FROM e JOIN u USING (event_slug)""")
def event_contracts(spark: SparkSession, d: str) -> DataFrame:
    """TXT-09: the tokens of an event's players, verified where each of exactly two has one."""
    pairs = table(spark, d, "book_snapshots").filter("outcome_player is not null").select("event_slug", "outcome_player", "token_id").distinct()
    sizes = pairs.groupBy("event_slug").agg(F.count_distinct("token_id").alias("t"), F.count_distinct("outcome_player").alias("p"))
    return pairs.join(sizes, "event_slug").select("event_slug", "outcome_player", "token_id", ((F.col("t") == 2) & (F.col("p") == 2)).alias("is_verified"))


@CATALOGUE.add("""WITH p AS (SELECT DISTINCT team_id, TRY_CAST(game_local_date AS DATE) AS day FROM nba_player_games), b AS (SELECT * FROM p WHERE day BETWEEN DATE '2015-01-01' AND DATE '2019-12-31'), c AS (SELECT team_id, count(*) AS n_days FROM b GROUP BY ALL)
SELECT b.team_id, CAST(b.day AS VARCHAR) AS day, n_days, n_days <= 200 AS within_cap FROM b JOIN c USING (team_id)""")
def dates_in_bounds(spark: SparkSession, d: str) -> DataFrame:
    """NRM-27: a team's days inside the bounds, and whether they are as few as agreed."""
    rows = table(spark, d, "nba_player_games").select("team_id", F.col("game_local_date").try_cast("date").alias("day"))
    return r.dates_in_bounds(rows, "team_id", "day", "2015-01-01", "2019-12-31", 200).withColumn("day", F.col("day").cast("string"))


@CATALOGUE.add("SELECT * FROM (VALUES (0, 'doc_id', 'bigint', 'number of the document'), (1, 'text', 'string', 'the whole text'), (2, 'lang', 'string', 'its language')) t(position, column_name, data_type, meaning)")
def column_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """NRM-29: what each column means, from the columns' own comments."""
    df = r.with_meanings(table(spark, d, "documents").select("doc_id", "text", "lang"), {"doc_id": "number of the document", "text": "the whole text", "lang": "its language"})
    return r.dictionary(df)


@CATALOGUE.add("""SELECT source_row_id, CASE WHEN game_date IS NULL THEN 'null' WHEN trim(game_date) = '' THEN 'empty' ELSE 'text' END AS kind, coalesce(regexp_matches(lower(trim(game_date)), '(z|[+-][0-9]{2}:?[0-9]{2})$') AND regexp_matches(game_date, '[0-9]:[0-9]{2}'), FALSE) AS zoned FROM nfl_schedule""")
def date_kinds(spark: SparkSession, d: str) -> DataFrame:
    """NRM-24: how dates are written; readable texts and others are one class here, as the twin reads other spellings."""
    kind = times.date_class(F.col("game_date"))
    return table(spark, d, "nfl_schedule").select("source_row_id", F.when(kind.isin("null", "empty"), kind).otherwise("text").alias("kind"), times.has_zone(F.col("game_date")).alias("zoned"))


# gates, duplicates, joins


@CATALOGUE.add("SELECT o_orderkey, '[' || concat_ws(',', CASE WHEN o_totalprice < 10000 THEN '\"small\"' END, CASE WHEN o_orderstatus = 'P' THEN '\"pending\"' END) || ']' AS reasons FROM orders")
def reason_lists(spark: SparkSession, d: str) -> DataFrame:
    """FLT-12."""
    rules = {"small": F.col("o_totalprice") < 10000, "pending": F.col("o_orderstatus") == "P"}
    return table(spark, d, "orders").select("o_orderkey", quality.reasons_json(rules).alias("reasons"))


@CATALOGUE.add("""WITH g AS (SELECT air_yards IS NULL AS a, NOT coalesce(down BETWEEN 1 AND 4, FALSE) AS b, NOT coalesce(regexp_full_match(passer_player_id, '00-[0-9]{7}'), FALSE) AS c FROM nfl_plays)
SELECT 'has_air_yards' AS gate, count(*) FILTER (WHERE a) AS n_failed, count(*) FILTER (WHERE a) AS n_first, count(*) FILTER (WHERE NOT a) AS n_left FROM g
UNION ALL SELECT 'has_down', count(*) FILTER (WHERE b), count(*) FILTER (WHERE NOT a AND b), count(*) FILTER (WHERE NOT a AND NOT b) FROM g
UNION ALL SELECT 'has_passer', count(*) FILTER (WHERE c), count(*) FILTER (WHERE NOT a AND NOT b AND c), count(*) FILTER (WHERE NOT a AND NOT b AND NOT c) FROM g""")
def gate_counts(spark: SparkSession, d: str) -> DataFrame:
    """FLT-13: each gate by itself and in order."""
    gates = {"has_air_yards": F.col("air_yards").isNotNull(), "has_down": F.col("down").between(1, 4), "has_passer": n.gsis_valid(F.col("passer_player_id"))}
    return r.gate_counts(table(spark, d, "nfl_plays"), gates)


@CATALOGUE.add("""WITH u AS (SELECT player_gsis_id, season, min(team_abbr) AS team FROM (SELECT DISTINCT player_gsis_id, season, team_abbr FROM nfl_ngs WHERE player_gsis_id IS NOT NULL AND season IS NOT NULL AND team_abbr IS NOT NULL) GROUP BY ALL HAVING count(*) = 1)
SELECT play_row_id, coalesce(posteam, u.team) AS team FROM nfl_plays p LEFT JOIN u ON p.passer_player_id = u.player_gsis_id AND p.season = u.season""")
def repaired_teams(spark: SparkSession, d: str) -> DataFrame:
    """JX-01: a missing team from the one team that the player has in that season."""
    plays = table(spark, d, "nfl_plays").select("play_row_id", F.col("passer_player_id").alias("player"), "season", F.col("posteam").alias("team"))
    roster = table(spark, d, "nfl_ngs").select(F.col("player_gsis_id").alias("player"), "season", F.col("team_abbr").alias("roster_team")).dropna()
    return identity.repair(plays, "team", roster, ["player", "season"], "roster_team").select("play_row_id", "team")


@CATALOGUE.add("""WITH a AS (SELECT DISTINCT match_id, match_date AS day, lower(trim(player1_name)) AS p, lower(trim(player2_name)) AS q FROM tennis_matches), b AS (SELECT DISTINCT listing_id, match_date AS day, lower(trim(player1_name)) AS p, lower(trim(player2_name)) AS q FROM match_listings WHERE match_date IS NOT NULL AND player1_name IS NOT NULL AND player2_name IS NOT NULL),
j AS (SELECT DISTINCT match_id, listing_id FROM a JOIN b ON a.day = b.day AND least(a.p, a.q) = least(b.p, b.q) AND greatest(a.p, a.q) = greatest(b.p, b.q)),
l AS (SELECT match_id, count(*) AS n, min(listing_id) AS listing_id FROM j GROUP BY ALL), k AS (SELECT listing_id, count(*) AS n FROM j GROUP BY ALL)
SELECT m.match_id, CASE WHEN l.n = 1 AND k.n = 1 THEN l.listing_id END AS listing_id, coalesce(l.n, 0) AS n_partners, CASE WHEN l.n IS NULL THEN 'unmatched' WHEN l.n = 1 AND k.n = 1 THEN 'matched' ELSE 'demoted' END AS status
FROM (SELECT DISTINCT match_id FROM tennis_matches) m LEFT JOIN l USING (match_id) LEFT JOIN k ON l.listing_id = k.listing_id""")
def dated_pairs(spark: SparkSession, d: str) -> DataFrame:
    """JX-08, JX-09: matches and listings of one day and pair; those with several partners on a side are demoted."""
    name = lambda c: F.lower(F.trim(F.col(c)))
    side = lambda t, key: table(spark, d, t).select(key, F.col("match_date").alias("day"), joins.unordered_pair(name("player1_name"), name("player2_name")).alias("p")).select(key, "day", "p.low", "p.high")
    return r.dated_pair_matches(side("tennis_matches", "match_id"), side("match_listings", "listing_id"), ["day", "low", "high"], "match_id", "listing_id")


@CATALOGUE.add("""WITH s AS (SELECT DISTINCT game_id, source_stadium FROM nfl_schedule), u AS (SELECT game_id, min(source_stadium) AS stadium FROM s GROUP BY ALL HAVING count(*) = 1)
SELECT play_row_id, u.game_id, stadium FROM nfl_plays JOIN u USING (game_id)""")
def linked_games(spark: SparkSession, d: str) -> DataFrame:
    """JX-15: the one game that a link names."""
    pattern, keys = "/games/([0-9]{4})_([0-9]{2})_([A-Z]{3})_([A-Z]{3})(?:[/?#]|$)", ["y", "w", "a", "b"]
    links = table(spark, d, "nfl_plays").select("play_row_id", F.concat(F.lit("https://news.test/games/"), "game_id", F.lit("/recap")).alias("link"))
    games = table(spark, d, "nfl_schedule").select("game_id", F.col("source_stadium").alias("stadium")).distinct()
    lookup = games.select("game_id", "stadium", *[n.extract(F.concat(F.lit("/games/"), "game_id"), pattern, i + 1).alias(k) for i, k in enumerate(keys)])
    return identity.linked_by_pattern(links, "link", pattern, keys, lookup, ["play_row_id"]).select("play_row_id", "game_id", "stadium")


@CATALOGUE.add("""WITH c AS (SELECT c_custkey, c_nationkey AS place, CAST(c_custkey % 170 AS DOUBLE) - 85 AS lat, CAST(c_custkey % 350 AS DOUBLE) - 175 AS lon FROM customer),
s AS (SELECT s_nationkey AS place, count(DISTINCT (s_suppkey % 2)) AS n, min(s_suppkey % 2) AS k FROM supplier GROUP BY ALL)
SELECT c_custkey, c.place, CASE WHEN c.place IS NULL THEN 'no_identity' WHEN n IS NULL THEN 'no_row' WHEN n > 1 THEN 'several_coordinates' WHEN lat = k AND lon = k THEN 'same_point' ELSE 'too_far' END AS status FROM c LEFT JOIN s USING (place)""")
def place_ladder(spark: SparkSession, d: str) -> DataFrame:
    """JX-16: identity first, then distance; nearness never picks another place."""
    a = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("place"), ((F.col("c_custkey") % 170).cast("double") - 85).alias("lat"), ((F.col("c_custkey") % 350).cast("double") - 175).alias("lon"))
    b = table(spark, d, "supplier").select(F.col("s_nationkey").alias("place"), (F.col("s_suppkey") % 2).cast("double").alias("lat"), (F.col("s_suppkey") % 2).cast("double").alias("lon"))
    return r.place_ladder(a, b, "place", "c_custkey").select("c_custkey", "place", "status")


@CATALOGUE.add("""WITH s AS (SELECT doc_id, string_split(text, '. ') AS bs FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, unnest(range(len(bs))) AS pos, bs FROM s)
SELECT doc_id, pos, bs[pos + 1] AS block FROM u WHERE (pos >= 1 AND contains(bs[pos], 'crowd')) OR (pos >= 2 AND contains(bs[pos - 1], 'crowd'))""")
def adjacent_evidence(spark: SparkSession, d: str) -> DataFrame:
    """JX-17, TXT-12: the two sentences after one about the crowd."""
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", F.split("text", r"\. ").alias("blocks"))
    return identity.adjacent_blocks(docs, "blocks", ["doc_id"], "crowd").select("doc_id", F.col("pos").cast("long").alias("pos"), "block")


@CATALOGUE.add("""WITH g AS (SELECT game_id, count(*) AS n, list_sort(list(DISTINCT team)) AS t, list_sort(list(DISTINCT opponent)) AS o, count(DISTINCT is_home) AS sides, count(DISTINCT season) AS seasons FROM nfl_schedule GROUP BY ALL)
SELECT source_row_id, s.game_id, n = 2 AND len(t) = 2 AND t = o AND sides = 2 AND seasons = 1 AS is_valid FROM nfl_schedule s JOIN g USING (game_id)""")
def game_pair_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """DUP-07: a game holds only with exactly two rows that name each other."""
    return r.pair_quarantine(table(spark, d, "nfl_schedule"), "game_id", "team", "opponent", "is_home", ["season"]).select("source_row_id", "game_id", "is_valid")


@CATALOGUE.add("SELECT posteam, play_type, CAST(yards_gained AS BIGINT) AS yards_gained, string_agg(load_no, ',' ORDER BY load_no) AS loads FROM (SELECT DISTINCT posteam, play_type, yards_gained, load_no FROM nfl_plays) GROUP BY ALL HAVING count(*) > 1")
def payload_loads(spark: SparkSession, d: str) -> DataFrame:
    """DUP-08, UDF-03: equal payloads of several loads as one row, with the sorted loads."""
    payload = ["posteam", "play_type", "yards_gained"]
    out = quality.collapse_payload(table(spark, d, "nfl_plays"), payload, "load_no", "loads")
    return out.filter(F.size("loads") > 1).select(*payload, F.array_join(F.transform("loads", lambda v: v.cast("string")), ",").alias("loads"))


@CATALOGUE.add("SELECT count(*) AS n_rows, count(DISTINCT row(update_id, event_slug, condition_id, token_id, outcome_player, event_type, source_time_utc, received_time_utc, price, quote_size)) AS n_fingerprints FROM quote_updates")
def fingerprint_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """DUP-09, STRF-10: rows by a digest of all their fields."""
    rows = table(spark, d, "quote_updates")
    marks = rows.select(n.evidence_hash(*[F.col(c) for c in rows.columns]).alias("h"))
    return marks.groupBy("h").agg(F.count("*").alias("n")).agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_fingerprints"))


@CATALOGUE.add("SELECT provider, count(DISTINCT regexp_replace(lower(strip_accents(player1_name)), '[^a-z0-9]', '', 'g')) AS n_names, count(DISTINCT player1_name) AS n_spellings FROM match_listings GROUP BY ALL")
def folded_names(spark: SparkSession, d: str) -> DataFrame:
    """DUP-10, STRF-01: different names without accents, case and signs."""
    return table(spark, d, "match_listings").groupBy("provider").agg(F.count_distinct(n.latin_fold(F.col("player1_name"))).alias("n_names"), F.count_distinct("player1_name").alias("n_spellings"))


@CATALOGUE.add("SELECT DISTINCT player1_name AS raw, lower(regexp_replace(trim(player1_name), '\\s+', ' ', 'g')) AS folded FROM match_listings WHERE player1_name IS NOT NULL")
def casefolded_names(spark: SparkSession, d: str) -> DataFrame:
    """STRF-02, UDF-04: in Python on the different names only."""
    names = table(spark, d, "match_listings").select(F.col("player1_name").alias("raw")).dropna().distinct()
    return names.select("raw", n.casefold_nfc("raw").alias("folded"))


@CATALOGUE.add("""WITH c AS (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer), k AS (SELECT c_mktsegment, c_nationkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey) AS pick FROM c)
SELECT c_mktsegment, CAST(pick AS INTEGER) AS pick, (SELECT min(c_custkey) FROM customer x WHERE x.c_mktsegment = k.c_mktsegment AND x.c_nationkey = k.c_nationkey) AS first_key, c_nationkey FROM k WHERE pick <= 0
UNION ALL SELECT c_mktsegment, CAST(pick AS INTEGER), c_custkey, c_nationkey FROM (SELECT c_mktsegment, c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS pick FROM (SELECT c_mktsegment, c_nationkey, min(c_custkey) AS c_custkey FROM customer GROUP BY ALL)) WHERE pick <= 3""")
def greedy_places(spark: SparkSession, d: str) -> DataFrame:
    """DUP-11: the first three customers of each segment that share no nation."""
    out = r.greedy_distinct(table(spark, d, "customer").select("c_mktsegment", "c_nationkey", "c_custkey"), "c_mktsegment", ["c_custkey"], ["c_nationkey"], 3)
    return out.select("c_mktsegment", "pick", F.col("c_custkey").alias("first_key"), "c_nationkey")


# aggregates, windows, orders, sets

_CUBE = ["season", "season_type", "is_home", "did_not_play", "boxscore_observed", "load_no", "team_id"]
_CUBE_STATS = ["points", "rebounds", "assists", "turnovers"]


@CATALOGUE.add("WITH b AS (SELECT " + ", ".join(_CUBE) + ", game_id, " + ", ".join(f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN CAST({c} AS DOUBLE) END AS {c}" for c in _CUBE_STATS) + " FROM nba_player_games) SELECT " + ", ".join(_CUBE) + ", count(*) AS n_rows, count(DISTINCT game_id) AS n_games, " + ", ".join(f"count({c}) AS {c}_n, sum({c}) AS {c}_sum, round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std" for c in _CUBE_STATS) + " FROM b GROUP BY ALL")
def descriptive_cube(spark: SparkSession, d: str) -> DataFrame:
    """AGG-20: counts and four statistics of each measure by seven keys, in one aggregate."""
    rows = table(spark, d, "nba_player_games").select(*_CUBE, "game_id", *[n.matching(F.col(c), "[0-9]+").try_cast("double").alias(c) for c in _CUBE_STATS])
    stats = [f for c in _CUBE_STATS for f in (F.count(c).alias(f"{c}_n"), F.sum(c).alias(f"{c}_sum"), F.round(F.avg(c), 6).alias(f"{c}_mean"), F.round(F.stddev_samp(c), 6).alias(f"{c}_std"))]
    return rows.groupBy(*_CUBE).agg(F.count("*").alias("n_rows"), F.count_distinct("game_id").alias("n_games"), *stats)


@CATALOGUE.add("""WITH s AS (SELECT season, count(*) AS n_rows, count(*) FILTER (WHERE source_game_date_time_known) AS n_known FROM nfl_schedule GROUP BY ALL) SELECT season, n_rows, n_known, CASE WHEN n_known > 0 AND n_known >= n_rows THEN 'complete' WHEN n_known > 0 AND n_rows > 0 THEN 'partial' ELSE 'audit_only' END AS status FROM s""")
def coverage_statuses(spark: SparkSession, d: str) -> DataFrame:
    """AGG-31, AGG-32: what is known per season, without any row's content."""
    per = table(spark, d, "nfl_schedule").groupBy("season").agg(F.count("*").alias("n_rows"), F.count_if(F.coalesce("source_game_date_time_known", F.lit(False))).alias("n_known"))
    return per.withColumn("status", r.coverage_status(F.col("n_known"), F.col("n_rows")))


@CATALOGUE.add("""WITH g AS (SELECT DISTINCT game_id, team_id, epoch_us(CAST(game_date AS TIMESTAMPTZ)) AS us, CAST(game_local_date AS DATE) AS day FROM nba_player_games),
l AS (SELECT *, lag(us) OVER w AS before_us, lag(day) OVER w AS before_day, game_id AS g FROM g WINDOW w AS (PARTITION BY team_id ORDER BY us, game_id))
SELECT team_id, game_id, CASE WHEN us % 3600000000 = 0 OR before_us % 3600000000 = 0 THEN NULL ELSE round((us - before_us) / 3600000000.0, 6) END AS hours_since, CAST(us // 86400000000 - before_us // 86400000000 AS BIGINT) AS days_since FROM l""")
def rest_intervals(spark: SparkSession, d: str) -> DataFrame:
    """WIN-08, DT-06: hours since the team's last game only where both times are precise (here: not a full hour); days always."""
    games = table(spark, d, "nba_player_games").select("game_id", "team_id", times.micros(times.instant(F.col("game_date"))).alias("us")).distinct()
    out = r.hours_since_last(games, "team_id", "us", "game_id", F.col("us") % 3_600_000_000 != 0)
    return out.select("team_id", "game_id", F.round("hours_since", 6).alias("hours_since"), "days_since")


@CATALOGUE.add("""SELECT event_id, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), 'OTHER') AS previous_role FROM events""")
def previous_roles(spark: SparkSession, d: str) -> DataFrame:
    """WIN-23: the role of the last appearance, OTHER before the first; users' events are sliced."""
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type", times.micros(F.col("ts")).alias("us"))
    return r.lagged_role(rows, "user_id", "us", "event_id", "event_type").select("event_id", "previous_role")


@CATALOGUE.add("SELECT game_id, play_id, air_yards, yards_gained, position FROM (SELECT game_id, play_id, air_yards, yards_gained, row_number() OVER (ORDER BY air_yards DESC NULLS LAST, yards_gained DESC, play_row_id) AS position FROM nfl_plays) WHERE position <= 50")
def longest_passes(spark: SparkSession, d: str) -> DataFrame:
    """ORD-01, ORD-02, TOP-01: the fifty longest passes (a top-k report), nulls last, ties by the row."""
    top = table(spark, d, "nfl_plays").orderBy(F.desc_nulls_last("air_yards"), F.desc("yards_gained"), "play_row_id").limit(50)
    place = F.row_number().over(W.orderBy(F.desc_nulls_last("air_yards"), F.desc("yards_gained"), "play_row_id"))  # fifty rows
    return top.select("game_id", "play_id", "air_yards", "yards_gained", place.cast("long").alias("position"))


@CATALOGUE.add("SELECT box_row_id, minutes FROM nba_player_games WHERE minutes IS NOT NULL AND NOT regexp_full_match(minutes, '[0-9]+') ORDER BY minutes, box_row_id LIMIT 20")
def bad_examples(spark: SparkSession, d: str) -> DataFrame:
    """TOP-03, ORD-03: the first twenty values that are no whole number, for the text of an error."""
    bad = table(spark, d, "nba_player_games").filter(F.col("minutes").isNotNull() & ~n.full_match(F.col("minutes"), "[0-9]+")).select("box_row_id", "minutes")
    return r.first_examples(bad, ["minutes", "box_row_id"])


@CATALOGUE.add("SELECT team AS name FROM nfl_schedule UNION SELECT posteam FROM nfl_plays UNION SELECT team_abbr FROM nfl_ngs")
def union_of_teams(spark: SparkSession, d: str) -> DataFrame:
    """SET-02."""
    return reshape.union_distinct(*[table(spark, d, t).select(F.col(c).alias("name")) for t, c in (("nfl_schedule", "team"), ("nfl_plays", "posteam"), ("nfl_ngs", "team_abbr"))])


@CATALOGUE.add("SELECT count(*) AS n_rows FROM (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def disjoint_union(spark: SparkSession, d: str) -> DataFrame:
    """SET-03: two inputs that may share no key."""
    side = lambda s: table(spark, d, "customer").filter(F.col("c_mktsegment") == s).select("c_custkey")
    r.reject_overlap(side("BUILDING"), side("MACHINERY"), ["c_custkey"])
    return reshape.union_all(side("BUILDING"), side("MACHINERY")).agg(F.count("*").alias("n_rows"))


@CATALOGUE.add("SELECT p_partkey, CAST(count(DISTINCT l_linenumber) AS BIGINT) AS n_properties FROM (SELECT l_partkey AS p_partkey, l_linenumber FROM lineitem) GROUP BY ALL")
def replayed_claims(spark: SparkSession, d: str) -> DataFrame:
    """SET-09, SET-10: rows to nested claims."""
    lines = table(spark, d, "lineitem").select("l_partkey", F.concat(F.lit("P"), F.col("l_linenumber").cast("string")).alias("property"), F.col("l_orderkey").cast("int").alias("statement_no"), F.col("l_quantity").cast("string").alias("value"), F.lit("normal").alias("rank"))
    return reshape.claims_of(lines, "l_partkey").select(F.col("l_partkey").alias("p_partkey"), F.size("claims").cast("long").alias("n_properties"))


# texts, dates, numbers


@CATALOGUE.add("SELECT o_orderkey, dayname(o_orderdate) = 'Monday' AS is_monday, CAST(date_trunc('day', o_orderdate) AS DATE) AS day FROM orders")
def weekdays(spark: SparkSession, d: str) -> DataFrame:
    """STRF-11, DT-06."""
    return table(spark, d, "orders").select("o_orderkey", n.weekday_agrees(F.col("o_orderdate"), F.lit(" monday ")).alias("is_monday"), times.day_floor(F.col("o_orderdate")).cast("date").alias("day"))


@CATALOGUE.add("SELECT column_name, regexp_replace(lower(column_name), '[^a-z0-9]', '', 'g') AS key FROM (VALUES ('box_row_id'), ('game_id'), ('player_id'), ('player_name'), ('team_id'), ('opponent_id'), ('game_date'), ('game_local_date'), ('season'), ('season_type'), ('is_home'), ('did_not_play'), ('boxscore_observed'), ('minutes'), ('points'), ('rebounds'), ('assists'), ('threes'), ('steals'), ('blocks'), ('turnovers'), ('field_goals_attempted'), ('free_throws_attempted'), ('load_no')) t(column_name)")
def header_keys(spark: SparkSession, d: str) -> DataFrame:
    """STRF-09, STRF-12: keys of a table's header, and the header back from camel case."""
    names = table(spark, d, "nba_player_games").columns
    camel = ["".join([p if i == 0 else p.capitalize() for i, p in enumerate(c.split("_"))]) for c in names]
    return spark.createDataFrame([(n.snake_case(c), n.header_key(c)) for c in camel], "column_name string, key string")


@CATALOGUE.add("SELECT source_row_id, CASE lower(team) WHEN 'zam' THEN 'Zamora' WHEN 'mux' THEN 'Muxton' WHEN 'tal' THEN 'Talbury' END AS resolved FROM nfl_schedule")
def resolved_teams(spark: SparkSession, d: str) -> DataFrame:
    """STRF-13: one team per spelling, nothing fuzzy."""
    return table(spark, d, "nfl_schedule").select("source_row_id", r.resolve_team(F.col("team"), {"ZAM": "Zamora", "Mux.": "Muxton", "tal": "Talbury"}).alias("resolved"))


@CATALOGUE.add("SELECT source_row_id, nullif(regexp_extract(trim(best_of), '^0*([1-9][0-9]*)([.]0+)?$', 1), '') AS best_of FROM tennis_matches")
def integral_keys(spark: SparkSession, d: str) -> DataFrame:
    """STRF-14."""
    return table(spark, d, "tennis_matches").select("source_row_id", n.integral_key(F.col("best_of")).alias("best_of"))


@CATALOGUE.add("SELECT snapshot_id, CASE WHEN snapshot_id BETWEEN 1577836800000 AND 4133980799999 THEN epoch_us(make_timestamp(snapshot_id * 1000)) END AS us FROM book_snapshots")
def epoch_instants(spark: SparkSession, d: str) -> DataFrame:
    """DT-07: milliseconds since 1970, within the years 2020 to 2100."""
    return table(spark, d, "book_snapshots").select("snapshot_id", F.unix_micros(times.epoch_ms(F.col("snapshot_id"))).alias("us"))


@CATALOGUE.add("""WITH w AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '1996-12-31', INTERVAL 1 DAY)) AS DATE) AS day), h AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL)
SELECT day, coalesce(n, 0) AS n, CASE WHEN w.day IS NULL THEN 'outside' WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'repeated' END AS problem FROM w FULL JOIN h USING (day) WHERE w.day IS NULL OR n IS NULL OR n > 1""")
def calendar_gaps(spark: SparkSession, d: str) -> DataFrame:
    """DT-10: each day of two years exactly once."""
    return r.calendar_gaps(table(spark, d, "orders"), "o_orderdate", "1995-01-01", "1996-12-31")


@CATALOGUE.add("""WITH t AS (SELECT o_orderkey, o_orderdate AS d, CASE o_orderkey % 3 WHEN 0 THEN ' EDT' WHEN 1 THEN ' UTC' ELSE '' END AS z FROM orders)
SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS day, CASE WHEN z = '' THEN 'date' ELSE 'minute' END AS precision, CASE z WHEN ' EDT' THEN epoch_us(CAST(CAST(d AS DATE) AS TIMESTAMP) + INTERVAL 19 HOUR + INTERVAL 5 MINUTE) WHEN ' UTC' THEN epoch_us(CAST(CAST(d AS DATE) AS TIMESTAMP) + INTERVAL 15 HOUR + INTERVAL 5 MINUTE) END AS us FROM t""")
def prose_dates(spark: SparkSession, d: str) -> DataFrame:
    """DT-11, TXT-05: a date in words, with clock and zone label where there are any."""
    zone = F.when(F.col("o_orderkey") % 3 == 0, " EDT").when(F.col("o_orderkey") % 3 == 1, " UTC").otherwise("")
    text = F.concat(F.lit("Updated "), F.date_format("o_orderdate", "MMMM d, yyyy"), F.when(zone != "", F.concat(F.lit(", at 3:05 p.m."), zone)).otherwise(""), F.lit(" by the desk"))
    read = times.spoken_instant(text)
    return table(spark, d, "orders").select("o_orderkey", read["day"].cast("string").alias("day"), read["precision"].alias("precision"), F.unix_micros(read["instant"]).alias("us"))


@CATALOGUE.add("""SELECT o_orderkey, 'Player ' || o_custkey AS subject, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 4 <> 0 AS agrees FROM orders WHERE o_orderkey % 5 <> 0""")
def dated_captions(spark: SparkSession, d: str) -> DataFrame:
    """TXT-05: who a caption shows and when, and whether its date is that of the page; captions without a date or a subject give none."""
    shown = F.when(F.col("o_orderkey") % 5 == 0, "Fans").otherwise(F.concat(F.lit("Player "), F.col("o_custkey").cast("string"), F.lit(" warms up before the game on "), F.date_format("o_orderdate", "MMMM d, yyyy")))
    page = F.when(F.col("o_orderkey") % 4 == 0, F.date_add(F.col("o_orderdate").cast("date"), 1)).otherwise(F.col("o_orderdate").cast("date"))
    rows = table(spark, d, "orders").select("o_orderkey", shown.alias("caption"), page.alias("page_day"))
    return x.dated_captions(rows, "caption", r"^([\p{L}0-9 .'’-]+?) (?:warms up|arrives|plays)\b", F.col("page_day"), ["o_orderkey"])


@CATALOGUE.add("SELECT box_row_id, CASE WHEN pts = 2 * mk + th + ft THEN TRUE WHEN pts <> 2 * mk + th + ft THEN FALSE END AS adds_up, CAST(CASE WHEN mk <> 0 THEN pts / mk END AS FLOAT) AS per_made FROM (SELECT box_row_id, TRY_CAST(points AS DOUBLE) AS pts, TRY_CAST(field_goals_attempted AS DOUBLE) AS mk, TRY_CAST(threes AS DOUBLE) AS th, TRY_CAST(free_throws_attempted AS DOUBLE) AS ft FROM nba_player_games)")
def shooting_identity(spark: SparkSession, d: str) -> DataFrame:
    """MTH-03, MTH-13: the points identity (unknown where a part is), and a feature without infinities."""
    v = lambda c: F.col(c).try_cast("double")
    per = m.as_feature(F.coalesce(F.try_divide(v("points"), v("field_goals_attempted")), F.when(v("points").isNotNull() & (v("field_goals_attempted") == 0), F.lit(float("inf")))))
    return table(spark, d, "nba_player_games").select("box_row_id", m.points_add_up(v("points"), v("field_goals_attempted"), v("threes"), v("free_throws_attempted")).alias("adds_up"), per.alias("per_made"))


@CATALOGUE.add("""WITH b AS (SELECT DISTINCT snapshot_id, best_bid, best_ask, bid_total_size AS bs, ask_total_size AS sz FROM book_snapshots WHERE best_bid BETWEEN 0.01 AND 0.99 AND best_ask BETWEEN 0 AND 1 AND bs > 0 AND sz > 0)
SELECT snapshot_id, CAST(best_bid AS DOUBLE) AS best_bid, CAST(best_ask AS DOUBLE) AS best_ask, CAST(bs + 1 AS DOUBLE) AS bid_size, CAST(sz AS DOUBLE) AS ask_size, 2 AS bid_levels, 1 AS ask_levels, CASE WHEN best_ask >= best_bid THEN CAST(best_ask - best_bid AS DOUBLE) END AS spread FROM b""")
def parsed_books(spark: SparkSession, d: str) -> DataFrame:
    """ARR-01, ARR-02: order books from their JSON levels; a level without size is none."""
    known = "best_bid between 0.01 and 0.99 and best_ask between 0 and 1 and bid_total_size > 0 and ask_total_size > 0"
    rows = table(spark, d, "book_snapshots").filter(known).select("snapshot_id", "best_bid", "best_ask", "bid_total_size", "ask_total_size").distinct()
    s = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    lower = F.col("best_bid") - F.lit("0.005").cast("decimal(38,18)")
    bids = F.to_json(F.array(F.array(s(lower), F.lit("1")), F.array(s("best_bid"), s("bid_total_size")), F.array(F.lit("1"), F.lit("0"))))
    asks = F.to_json(F.array(F.array(s("best_ask"), s("ask_total_size"))))
    book = m.book_stats(m.book_levels(bids), m.book_levels(asks))
    number = lambda c: book[c].cast("double").alias(c)
    return rows.select("snapshot_id", *[number(c) for c in ("best_bid", "best_ask", "bid_size", "ask_size")], book["bid_levels"].alias("bid_levels"), book["ask_levels"].alias("ask_levels"), number("spread"))


@CATALOGUE.add("""WITH a AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS f, count(*) AS n FROM lineitem GROUP BY ALL) SELECT l_orderkey, '["' || array_to_string(f, '","') || '"]' AS flags, CAST(len(f) AS INTEGER) AS n_flags, len(list_intersect(f, ['A', 'R'])) > 0 AS was_sent FROM a""")
def flag_sets(spark: SparkSession, d: str) -> DataFrame:
    """ARR-03, ARR-05, ARR-07, UDF-03: sorted sets as JSON, read back, and what they share with another set."""
    per = table(spark, d, "lineitem").groupBy("l_orderkey").agg(m.sorted_set_json(F.collect_set("l_returnflag")).alias("flags"))
    read = m.json_list(F.col("flags"))
    return per.select("l_orderkey", "flags", F.size(read).alias("n_flags"), (F.size(m.shared_names(read, F.array(F.lit("A"), F.lit("R")))) > 0).alias("was_sent"))


@CATALOGUE.add("""WITH k AS (SELECT record_id, body, unnest(json_keys(body)) AS k FROM source_records) SELECT DISTINCT record_id, '$.' || k AS path, json_extract_string(body, '$."' || k || '"') AS value FROM k WHERE k <> 'week' AND json_type(body, '$."' || k || '"') NOT IN ('NULL', 'DOUBLE')""")
def json_walk(spark: SparkSession, d: str) -> DataFrame:
    """ARR-06: every scalar of a document with its path, but for excluded keys; depth is no limit."""
    rows = x.json_scalars(table(spark, d, "source_records"), "body", ["record_id"], exclude=["week"])
    return rows.filter("kind not in ('null', 'real')").select("record_id", "path", "value").distinct()


@CATALOGUE.add("""SELECT doc_id, CAST(nullif(regexp_extract(lower(text), '\\b([0-9]{1,2})[- ]?(?:foot|feet|ft)\\b', 1), '') AS INTEGER) AS feet, coalesce(regexp_matches(text, '(?i)three[- ]point|3[- ]?pt'), FALSE) AS is_three FROM documents""")
def shot_texts(spark: SparkSession, d: str) -> DataFrame:
    """TXT-02."""
    c = F.col("text")
    return table(spark, d, "documents").select("doc_id", x.shot_distance(c).alias("feet"), x.is_three(c).alias("is_three"))


@CATALOGUE.add("""SELECT listing_id, provider, coalesce(regexp_matches(tournament, '(?i)open|cup') AND NOT regexp_matches(tournament, '(?i)grand|masters'), FALSE) AS is_included FROM match_listings""")
def label_filter(spark: SparkSession, d: str) -> DataFrame:
    """TXT-10: labels that hold one pattern and not another."""
    return table(spark, d, "match_listings").select("listing_id", "provider", x.label_included(F.col("tournament"), "open|cup", "grand|masters").alias("is_included"))


@CATALOGUE.add("""SELECT doc_id, 1 AS n_blocks, regexp_replace(trim(replace(replace(replace(text, '<', ''), '>', ''), '&', '')), '\\s+', ' ', 'g') AS block, 'note ' || doc_id AS headline FROM documents WHERE text IS NOT NULL AND NOT regexp_full_match(replace(replace(replace(text, '<', ''), '>', ''), '&', ''), '[\\s\\p{Z}]*') AND NOT regexp_matches(text, '[^\\x09\\x0a\\x0d\\x20-\\x7e]')""")
def page_contents(spark: SparkSession, d: str) -> DataFrame:
    """SRC-15, TXT-07, TXT-11, UDF-07: the main text of a page and its headline from JSON-LD; navigation, asides and cards of other pages stay out."""
    clean = F.regexp_replace("text", "[<>&]", "")
    plain = table(spark, d, "documents").filter(F.col("text").isNotNull() & ~clean.rlike(r"\A[\s\p{Z}]*\z") & ~F.col("text").rlike(r"[^\x09\x0a\x0d\x20-\x7e]"))
    name = F.concat(F.lit("note "), F.col("doc_id").cast("string"))
    page = F.concat(F.lit('<html><head><script type="application/ld+json">{"headline": "'), name, F.lit('"}</script></head><body><nav><p>Home</p></nav><p>outside</p><article class="main"><p>'), clean, F.lit('</p><div class="card related"><p>other</p></div><aside><p>ad</p></aside></article><footer><p>end</p></footer></body></html>'))
    read = x.page_content(page)
    return plain.select("doc_id", F.size(read["blocks"]).alias("n_blocks"), F.get(read["blocks"], F.lit(0)).alias("block"), read["headline"].alias("headline"))


@CATALOGUE.add("""WITH p AS (SELECT p_partkey, 'Player ' || p_partkey AS who, p_size AS v, p_partkey % 4 AS k FROM part)
SELECT p_partkey, CASE WHEN k IN (0, 1) THEN who END AS player, CASE k WHEN 0 THEN 'points' WHEN 1 THEN 'passing yards' END AS stat, CASE WHEN k IN (0, 1) THEN CAST(v + 0.5 * (1 - k) AS DOUBLE) END AS threshold, CASE k WHEN 0 THEN 'more_than' WHEN 1 THEN 'at_least' END AS comparator, CASE k WHEN 2 THEN 'partial_game' WHEN 3 THEN 'no_rule' END AS rejected FROM p""")
def prop_rules(spark: SparkSession, d: str) -> DataFrame:
    """TXT-08: player, measure and threshold of a contract's rule; rules about halves and quarters are refused."""
    who, v, k = F.concat(F.lit("Player "), F.col("p_partkey").cast("string")), F.col("p_size").cast("string"), F.col("p_partkey") % 4
    rule = F.when(k == 0, F.concat(who, F.lit(" scores more than "), v, F.lit(".5 points in the game"))).when(k == 1, F.concat(who, F.lit(" records "), v, F.lit(" or more passing yards"))).when(k == 2, F.concat(who, F.lit(" scores more than "), v, F.lit(".5 points in the first half"))).otherwise(F.concat(who, F.lit(" wins")))
    read = x.prop_rule(rule)
    return table(spark, d, "part").select("p_partkey", *[read[c].alias(c) for c in ("player", "stat", "threshold", "comparator", "rejected")])


@CATALOGUE.add("""WITH b AS (SELECT doc_id, string_split(text, '. ') AS bs FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, unnest(range(len(bs))) AS pos, bs FROM b), r AS (SELECT doc_id, pos, bs[pos + 1] AS block FROM u),
s AS (SELECT *, contains(block, 'listed as') AS starts, contains(block, 'coach') AS stops FROM r), w AS (SELECT *, last_value(CASE WHEN starts THEN 1 WHEN stops THEN 0 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS is_on FROM (SELECT DISTINCT * FROM s))
SELECT doc_id, count(*) AS n_blocks FROM w WHERE is_on = 1 AND NOT starts GROUP BY ALL""")
def text_sections(spark: SparkSession, d: str) -> DataFrame:
    """TXT-03, WIN-20: what stands between a start and a stop heading."""
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", F.split("text", r"\. ").alias("blocks")).distinct()
    return x.sections(docs, "blocks", ["doc_id"], "listed as", "coach").groupBy("doc_id").agg(F.count("*").alias("n_blocks"))


# streams


def _run(spark: SparkSession, out: DataFrame, work: str) -> DataFrame:
    query = out.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{work}/out")


@CATALOGUE.add("SELECT count(*) AS n_rows, count(DISTINCT update_id) AS n_ids FROM (SELECT DISTINCT update_id, token_id, event_type, received_time_utc FROM quote_updates)")
def stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """STR-01: a stream of quotes without exact repeats."""
    work = scratch_path(spark, "dedupe")
    rows = table(spark, d, "quote_updates").select("update_id", "token_id", "event_type", "received_time_utc", F.col("received_time_utc").try_cast("timestamp").alias("received"))
    rows.write.parquet(f"{work}/in")
    once = minutes.without_repeats(spark.readStream.schema(rows.schema).parquet(f"{work}/in"), ["update_id", "token_id", "event_type", "received_time_utc"], "received", "1 hour")
    return _run(spark, once, work).agg(F.count("*").alias("n_rows"), F.count_distinct("update_id").alias("n_ids"))


@CATALOGUE.add("""WITH e AS (SELECT CAST(user_id AS VARCHAR) AS entity, epoch_us(ts) AS us, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM events)
SELECT entity, count(*) AS n_rows, count(*) FILTER (WHERE step < 0) AS n_reversed, count(*) FILTER (WHERE step > 3600000000) AS n_gaps FROM e WHERE us IS NOT NULL GROUP BY ALL""")
def stream_gaps(spark: SparkSession, d: str) -> DataFrame:
    """STR-05, WIN-26: rows, reversals and gaps per user in order of arrival, from keyed state."""
    work = scratch_path(spark, "gaps")
    rows = table(spark, d, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("at"))
    rows.write.parquet(f"{work}/in")
    out = minutes.gap_counts(spark.readStream.schema(rows.schema).parquet(f"{work}/in"), "user_id", "at", "event_id", 3600)
    return _run(spark, out, work).groupBy("entity").agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_reversed", "n_gaps")])


@CATALOGUE.add("SELECT count(*) FILTER (WHERE ok) AS n_kept, count(*) FILTER (WHERE NOT ok) AS n_rejected FROM (SELECT coalesce(date_trunc('hour', CAST(received_time_utc AS TIMESTAMPTZ)) = date_trunc('hour', CAST(source_time_utc AS TIMESTAMPTZ)), FALSE) AS ok FROM quote_updates)")
def stream_hour_split(spark: SparkSession, d: str) -> DataFrame:
    """STR-06, SNK-06: receipts outside the hour of their source go to a table of their own."""
    work = scratch_path(spark, "hours")
    at = lambda c: F.col(c).try_cast("timestamp")
    rows = table(spark, d, "quote_updates").select("update_id", at("received_time_utc").alias("received"), F.date_trunc("hour", at("source_time_utc")).alias("hour"))
    rows.write.parquet(f"{work}/in")
    split = minutes.split_writer(minutes.in_archive_hour(F.col("received"), F.col("hour")), f"{work}/good", f"{work}/bad")
    query = spark.readStream.schema(rows.schema).parquet(f"{work}/in").writeStream.foreachBatch(split).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    count = lambda p, name: spark.read.schema(rows.schema).parquet(f"{work}/{p}").agg(F.count("*").alias(name))
    return count("good", "n_kept").crossJoin(count("bad", "n_rejected"))  # two single rows


# forecasts

_FORECAST = "SELECT user_id, ts, value, avg(value) OVER w AS baseline, count(value) OVER w AS n_prior FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)"


@CATALOGUE.add(f"""WITH f AS ({_FORECAST}), e AS (SELECT * FROM f WHERE n_prior >= 10 AND value IS NOT NULL)
SELECT year(ts) AS year, count(*) AS n, round(avg(abs(baseline - value)), 6) AS baseline_mae, round(avg(abs(0.9 * baseline - value)), 6) AS model_mae, round(100 * (1 - avg(abs(0.9 * baseline - value)) / avg(abs(baseline - value))), 4) AS mae_gain_pct, count(*) >= 50 AS enough FROM e GROUP BY ALL""")
def yearly_gain(spark: SparkSession, d: str) -> DataFrame:
    """ML-03, ML-04, ML-05, ML-07: rows with enough history, the gain over the mean of the last ten per year, and whether a year has enough rows."""
    rows = table(spark, d, "events").select("event_id", "user_id", "value", F.col("ts").cast("timestamp").alias("at"), times.micros(F.col("ts")).alias("us"))
    frame = temporal.past(temporal.slice_window("user_id"), 10)
    rows = temporal.sliced(rows, "user_id", "us", "event_id", 10).withColumns({"baseline": F.avg("value").over(frame), "n_prior": F.count("value").over(frame)})
    return evaluation.yearly_gain(temporal.drop_halo(rows), "at", "value", "baseline", 0.9 * F.col("baseline"), F.col("n_prior") >= 10)
