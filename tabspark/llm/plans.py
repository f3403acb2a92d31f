"""Queries p2, p3, p7, p8 and p9 and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import linkage, mixing, nearest_time, packing, pii, tokens
from tabspark.llm.partitions import spread
from tabspark.operators import timestamps
from tabspark.session import materialise, table

TOLERANCE_US = 2_000_000


def _records(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(F.col("token_id").alias("entity"), F.col(id_col).alias("id"), nearest_time.time_of(F.col("source_time_utc"), F.col("received_time_utc")).alias("t_us"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots, updates = _records(table(spark, sf_dir, "book_snapshots"), "snapshot_id"), _records(table(spark, sf_dir, "quote_updates"), "update_id")
    return nearest_time.replay_nearest_join(snapshots, updates, TOLERANCE_US).select(F.col("left_id").alias("snapshot_id"), F.col("right_id").alias("update_id"))


def _days(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """df with days: every real reading of match_date in days since 1970, in the stated order or, where that gives none, in any."""
    read = timestamps.day_readings(df, "match_date")
    stated = F.col("date_order").isNull() | ~F.coalesce(F.col("spelling").isin("day_first", "month_first"), F.lit(False)) | ((F.col("spelling") == "day_first") == (F.col("date_order") == "dmy"))
    day = F.unix_date("reading")
    both = read.groupBy(key, *columns).agg(F.array_sort(F.collect_set(F.when(stated, day))).alias("by_order"), F.array_sort(F.collect_set(day)).alias("any"))
    return both.select(key, *columns, F.when(F.size("by_order") > 0, F.col("by_order")).otherwise(F.col("any")).alias("days"))


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linked pairs with their confidence."""
    who = ["player1_name", "player2_name", "tournament"]
    matches = _days(table(spark, sf_dir, "tennis_matches").select("match_id", *who, "match_date", "date_order"), "match_id", who)
    listings = _days(table(spark, sf_dir, "match_listings").select("listing_id", *who, "match_date", F.lit(None).cast("string").alias("date_order")), "listing_id", who)
    left = linkage.records(matches, "match_id", *who, F.col("days"))
    right = linkage.records(listings, "listing_id", *who, F.col("days"))
    return linkage.link(left, right).select(F.col("left_id").alias("match_id"), F.col("right_id").alias("listing_id"), "confidence")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_links(spark, sf_dir).select("match_id", "listing_id")


_P2_FOUND = """WITH u AS (SELECT DISTINCT token_id, update_id, epoch_us(coalesce(CAST(source_time_utc AS TIMESTAMPTZ), CAST(received_time_utc AS TIMESTAMPTZ))) AS t FROM quote_updates),
s AS (SELECT DISTINCT token_id, snapshot_id, epoch_us(coalesce(CAST(source_time_utc AS TIMESTAMPTZ), CAST(received_time_utc AS TIMESTAMPTZ))) AS t FROM book_snapshots),
j AS (SELECT snapshot_id, update_id, row_number() OVER (PARTITION BY snapshot_id, s.t ORDER BY abs(u.t - s.t), update_id) AS k
      FROM s JOIN u ON s.token_id = u.token_id AND u.t BETWEEN s.t - 2000000 AND s.t + 2000000)
SELECT snapshot_id, update_id FROM j WHERE k = 1"""

def _sized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens) of all documents, written once: every text is encoded once."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return materialise(tokens.with_token_counts(docs).select("doc_id", "source", "n_tokens"), "document-sizes")


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, or piece of one, with its container of each kind. The kinds are a fixed handful."""
    sizes = _sized_documents(spark, sf_dir)
    out = None
    for kind, capacity in sorted(tuple(r) for r in table(spark, sf_dir, "pack_capacities").select("container_kind", "capacity_tokens").distinct().collect()):
        part = packing.pack(sizes, "doc_id", "n_tokens", int(capacity)).select(F.lit(kind).alias("container_kind"), F.lit(capacity).cast("long").alias("capacity_tokens"), "container_id", "slot", "doc_id", "piece_no", "first_token", "n_tokens")
        out = part if out is None else out.unionByName(part)
    return out


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill_report(p7_packed(spark, sf_dir), "container_kind")


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sized_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares reached."""
    docs, targets = _sized_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets")
    return mixing.mix_report(mixing.mix(docs, targets), docs, targets)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surfaces(pii.findings(table(spark, sf_dir, "documents")))


def p9_sanitised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with typed placeholders."""
    return pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


# parts of the results that SQL can say, and what must hold of the whole


def p3_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links among pairs that agree in both names, but for case and blanks, and in a day that both write year first, where these name one match and one listing."""
    name = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))).alias(c)
    day = F.when(F.col("match_date").rlike(r"\A\d{4}-\d{2}-\d{2}\z"), F.col("match_date").try_cast("date")).alias("day")
    same = ["player1_name", "player2_name", "day"]
    once = lambda t, key: table(spark, sf_dir, t).select(key, name("player1_name"), name("player2_name"), day).dropna(subset=same).groupBy(*same).agg(F.count_distinct(key).alias("n"), F.min(key).alias(key)).filter("n = 1").drop("n")
    pairs = once("tennis_matches", "match_id").join(once("match_listings", "listing_id"), same).select("match_id", "listing_id")
    return p3_found(spark, sf_dir).join(pairs, ["match_id", "listing_id"])


_P3_EXACT = r"""WITH n AS (SELECT match_id, lower(trim(regexp_replace(player1_name, '\s+', ' ', 'g'))) AS a, lower(trim(regexp_replace(player2_name, '\s+', ' ', 'g'))) AS b, CASE WHEN regexp_full_match(match_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(match_date AS DATE) END AS day FROM tennis_matches),
k AS (SELECT listing_id, lower(trim(regexp_replace(player1_name, '\s+', ' ', 'g'))) AS a, lower(trim(regexp_replace(player2_name, '\s+', ' ', 'g'))) AS b, CASE WHEN regexp_full_match(match_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(match_date AS DATE) END AS day FROM match_listings),
m AS (SELECT a, b, day, min(match_id) AS match_id FROM n WHERE day IS NOT NULL GROUP BY ALL HAVING count(DISTINCT match_id) = 1), l AS (SELECT a, b, day, min(listing_id) AS listing_id FROM k WHERE day IS NOT NULL GROUP BY ALL HAVING count(DISTINCT listing_id) = 1)
SELECT match_id, listing_id FROM m JOIN l USING (a, b, day)"""


def p3_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of all links: known records, one match a listing, a confidence."""
    links = materialise(p3_links(spark, sf_dir), "links")
    known = links.join(table(spark, sf_dir, "tennis_matches").select("match_id").distinct(), "match_id").join(table(spark, sf_dir, "match_listings").select("listing_id").distinct(), "listing_id")
    twice = links.groupBy("listing_id").agg(F.count_distinct("match_id").alias("n")).agg(F.count_if(F.col("n") > 1).alias("n_listings_of_several"))
    whole = links.agg(F.count_if(~F.coalesce(F.col("confidence").between(0.72, 1.0), F.lit(False))).alias("n_without_confidence"), F.count("*").alias("n"))
    return twice.crossJoin(whole).crossJoin(known.agg(F.count("*").alias("k"))).select("n_listings_of_several", "n_without_confidence", (F.col("n") - F.col("k")).alias("n_unknown"))  # single rows


_ZERO = "CAST(0 AS BIGINT)"
_P3_SOUND = f"SELECT {_ZERO} AS n_listings_of_several, {_ZERO} AS n_without_confidence, {_ZERO} AS n_unknown"


def p7_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kind of container: every document is placed, no token twice or left out, none beyond the capacity, no text split that would fit."""
    packed = materialise(p7_packed(spark, sf_dir), "packed")
    sizes = packed.groupBy("container_kind", "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("t")).groupBy("container_kind", "capacity_tokens").agg(F.count_if(F.col("t") > F.col("capacity_tokens")).alias("n_overfull"))
    docs = packed.groupBy("container_kind", "doc_id").agg(F.count("*").alias("n"), F.count_distinct("piece_no").alias("d"), F.sum("n_tokens").alias("t"), F.max(F.col("first_token") + F.col("n_tokens")).alias("last"), F.max("capacity_tokens").alias("c"))
    per = docs.groupBy("container_kind").agg(F.count("*").alias("n_documents"), F.count_if((F.col("n") != F.col("d")) | (F.col("t") != F.col("last"))).alias("n_wrong_tokens"), F.count_if((F.col("n") > 1) & (F.col("t") <= F.col("c"))).alias("n_split_in_vain"))
    return sizes.join(per, "container_kind")


_P7_SOUND = f"SELECT DISTINCT container_kind, capacity_tokens, {_ZERO} AS n_overfull, (SELECT count(DISTINCT doc_id) FROM documents) AS n_documents, {_ZERO} AS n_wrong_tokens, {_ZERO} AS n_split_in_vain FROM pack_capacities"


def p8_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source of the targets: whether it has its share of what the sources with documents can have, within a per cent, and no document more often than allowed."""
    docs, targets = _sized_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets")
    mixed = materialise(mixing.mix(docs, targets), "mix")
    report = mixing.mix_report(mixed, docs, targets).filter("target_share > 0")
    most = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("n")).groupBy("source").agg(F.max("n").alias("n")).join(targets, "source").select("source", (F.col("n") <= F.col("max_repeats")).alias("ok"))
    reachable = report.agg(F.sum(F.when(F.col("available_tokens") > 0, F.col("target_share"))).alias("reachable"))
    near = F.abs(F.col("actual_share") * F.col("reachable") / F.col("target_share") - 1) <= 0.01
    return report.crossJoin(F.broadcast(reachable)).join(most, "source", "left").select("source", (near | (F.col("available_tokens") == 0)).alias("has_its_share"), F.coalesce("ok", F.lit(True)).alias("within_repeats"))


_P8_SOUND = "SELECT DISTINCT source, TRUE AS has_its_share, TRUE AS within_repeats FROM mix_targets WHERE target_share > 0"


def p9_plain_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The undisguised addresses among the findings."""
    return p9_found(spark, sf_dir).filter("pii_type = 'email' and surface rlike '^[^ ()]+@[^ ()]+$'").select("doc_id", "surface")


_P9_PLAIN_EMAILS = "SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9_%+-]+(?:[.][A-Za-z0-9_%+-]+)*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:[.][A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+')) AS surface FROM documents WHERE contains(text, '@')"


def p9_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After sanitising: all documents are there, no address with an at sign and no international number is left."""
    clean = p9_sanitised(spark, sf_dir)
    has = lambda p: F.count_if(F.coalesce(F.col("text").rlike(p), F.lit(False)))
    return clean.agg(F.count("*").alias("n_documents"), has(r"[A-Za-z0-9]@[A-Za-z0-9-]+[.][a-z]").alias("n_with_email"), has(r"(?:^|[^\w@.+/-])[+]\d{9,15}\b").alias("n_with_number"))


_P9_LEFT = f"SELECT count(*) AS n_documents, {_ZERO} AS n_with_email, {_ZERO} AS n_with_number FROM documents"


QUERIES = {f.__name__: f for f in (p2_found, p3_found, p3_links, p3_exact, p3_sound, p7_packed, p7_fill, p7_sound, p8_mix, p8_shares, p8_sound, p9_found, p9_sanitised, p9_plain_emails, p9_left)}
ORACLES = {"p2_found": _P2_FOUND, "p3_exact": _P3_EXACT, "p3_sound": _P3_SOUND, "p7_sound": _P7_SOUND, "p8_sound": _P8_SOUND, "p9_plain_emails": _P9_PLAIN_EMAILS, "p9_left": _P9_LEFT}
