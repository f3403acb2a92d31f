"""Linking the same matches in two sources that share no identifier.

1. Attributes of both sides become blocking keys that combine what is rare: a surname with a day, both surnames, initials
   and place with a day. Pairs that share keys are the candidate graph, each edge weighted by the rarity of its keys.
   The size of every block is known before its pairs are made; a key that is too common is joined by finer ones.
2. Meta-blocking: an edge stays if its weight reaches a share of the best edge of either of its ends.
3. Each edge gets a score from names, day and tournament. Then neighbours speak: how the currently best edges pair the
   same spellings of players and tournaments raises the similarity of those spellings on all edges, until no best edge changes
   (of edges that go in a cycle, the round of the highest total score counts).
4. A listing goes to its best match if the score reaches the threshold; the score is the confidence.

Defined results: records with neither player name link to nothing; a null tournament or day is neutral; days that may be
read in two ways count as either; repeated rows of one id are one record whose attributes are all kept; equal scores go
to the smaller match id; empty tables give no links.
"""

from __future__ import annotations

import logging
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabspark.session import materialise

_log = logging.getLogger(__name__)


def _accent_table() -> tuple[str, str]:
    """Letters of the Latin blocks that decompose into a base letter and marks, and their base letters."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if b.isascii() and b.isalpha()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold(text: Column) -> Column:
    """Lower case without accents, underscores as blanks, single blanks."""
    accented, plain = _accent_table()
    return F.trim(F.regexp_replace(F.lower(F.translate(text, accented, plain)), r"[\s_ ]+", " "))


def name_parts(text: Column) -> Column:
    """STRUCT(first, last, tail) of 'First Last', 'F. Last', 'Last F.', 'Last, First', 'Last'; tail ends a double surname; null where nothing is left."""
    clean = fold(text)
    comma = F.split(clean, ",", 2)
    words = F.filter(F.split(F.regexp_replace(clean, r"\.", " "), " "), lambda w: F.length(w) > 0)
    n = F.size(words)
    first_word, last_word = F.get(words, F.lit(0)), F.get(words, n - 1)
    rest = lambda a, k: F.array_join(F.slice(words, a, k), " ")
    trailing_initial = (F.length(last_word) == 1) & (F.length(first_word) > 1)
    first = F.when(F.size(comma) == 2, F.get(comma, F.lit(1))).when(n <= 1, "").when(trailing_initial, last_word).otherwise(first_word)
    last = F.when(F.size(comma) == 2, F.get(comma, F.lit(0))).when(n <= 1, first_word).when(trailing_initial, rest(1, n - 1)).otherwise(rest(2, n - 1))
    letters = lambda c: F.regexp_replace(c, "[^a-z]", "")
    tail = F.element_at(F.split(F.trim(last), "[ -]+"), -1)
    return F.when(n > 0, F.struct(letters(first).alias("first"), letters(last).alias("last"), letters(tail).alias("tail")))


def tournament_words(text: Column) -> Column:
    """Words of a tournament's name without its year and sponsor line."""
    clean = F.regexp_replace(fold(text), r"\b(?:19|20)\d\d\b|presented by .*$", " ")
    return F.coalesce(F.filter(F.split(F.regexp_replace(clean, "[^a-z ]", " "), " +"), lambda w: F.length(w) > 1), F.array().cast("array<string>"))


def stated_year(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1), F.lit("")).try_cast("int")


def likeness(a: Column, b: Column) -> Column:
    """1 minus the edit distance over the longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def person_score(a_first: Column, a_last: Column, b_first: Column, b_last: Column) -> Column:
    """Likeness of the surnames, lowered where the first names contradict each other."""
    # one slip of the pen is at most two edits; more is another name
    alike = likeness(a_last, b_last) * F.when(F.levenshtein(a_last, b_last) > 2, 0.6).otherwise(1.0)
    last = F.greatest(alike, F.when((F.length(a_last) >= 4) & (F.length(b_last) >= 4) & (a_last.contains(b_last) | b_last.contains(a_last)), 0.85).otherwise(0.0))
    same_initial = F.substring(a_first, 1, 1) == F.substring(b_first, 1, 1)
    full = (F.length(a_first) > 1) & (F.length(b_first) > 1)
    first = (
        F.when((a_first == "") | (b_first == ""), -0.04)
        .when(full & (likeness(a_first, b_first) >= 0.6), F.lit(0.0))
        .when(full, -0.6)
        .when(same_initial, -0.02)
        .otherwise(-0.6)
    )
    # 'Last Last' of a double surname reads like 'First Last'
    double = F.when((F.length(b_first) > 1) & (F.length(a_last) > F.length(b_last)), likeness(a_last, F.concat(b_first, b_last)) - 0.04)
    return F.greatest(last + first, double, F.lit(0.0))


def _blocks(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides' rows per key, and the counts of each key that both have: known before any pair is made."""
    a = materialise(left.select(F.col("id").alias("left_id"), F.explode("keys").alias("key")).distinct(), "link-keys")
    b = materialise(right.select(F.col("id").alias("right_id"), F.explode("keys").alias("key")).distinct(), "link-keys")
    counts = a.groupBy("key").agg(F.count("*").alias("na")).join(b.groupBy("key").agg(F.count("*").alias("nb")), "key")
    return a, b, materialise(counts, "link-blocks")


def _finer(rows: DataFrame, id_col: str, common: DataFrame, tokens: DataFrame) -> DataFrame:
    """(id, keys): the rows of common keys, by the key and each token of their record that it doesn't hold."""
    held = rows.join(common, "key").select(F.col(id_col).alias("id"), "key").join(tokens, "id")
    return materialise(held.select("id", F.transform(F.filter("tokens", lambda t: F.instr(F.col("key"), t) == 0), lambda t: F.concat_ws("|", "key", t)).alias("keys")), "link-finer")


def _pairs_by_rare_keys(left: DataFrame, right: DataFrame, keep_share: float, block_pairs: int = 1000, levels: int = 3) -> DataFrame:
    """(left_id, right_id, weight): the candidate graph after meta-blocking. left, right: (id, keys ARRAY<STRING>, tokens ARRAY<STRING>).

    A key whose block would make more than ``block_pairs`` pairs is not rare. It is refined: its records meet by the key and
    one more thing they share (a token that the key doesn't hold), and by one more again where that is still too common. Of
    a block so refined only pairs are left out that share nothing but the key. After the last level a block stays as it is.
    """
    edges, level = None, 0
    tokens = [df.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("tokens"))).alias("tokens")) for df in (left, right)]
    while True:
        a, b, counts = _blocks(left, right)
        pairs = F.col("na") * F.col("nb")
        more = level < levels and bool(counts.filter(pairs > block_pairs).head(1))
        rarity = (counts.filter(pairs <= block_pairs) if more else counts).select("key", (1 / F.log2(2 + pairs)).alias("rarity"))
        found = a.join(rarity, "key").join(b, "key").select("left_id", "right_id", "rarity")
        edges = found if edges is None else edges.unionByName(found)
        if not more:
            break
        common = counts.filter(pairs > block_pairs).select("key")
        left, right, level = _finer(a, "left_id", common, tokens[0]), _finer(b, "right_id", common, tokens[1]), level + 1
        _log.info("blocks of over %d pairs refined, level %d", block_pairs, level)
    edges = edges.groupBy("left_id", "right_id").agg(F.sum("rarity").alias("weight"))
    top = lambda c: F.max("weight").over(W.partitionBy(c))
    return edges.withColumn("l", top("left_id")).withColumn("r", top("right_id")).filter((F.col("weight") >= keep_share * F.col("l")) | (F.col("weight") >= keep_share * F.col("r"))).select("left_id", "right_id", "weight")


def records(df: DataFrame, id_col: str, one: str, two: str, tournament: str, days: Column) -> DataFrame:
    """One row per different reading of a record: names, words, days (ARRAY<INT>, days since 1970), stated year."""
    out = df.select(
        F.col(id_col).alias("id"),
        name_parts(F.col(one)).alias("p"),
        name_parts(F.col(two)).alias("q"),
        tournament_words(F.col(tournament)).alias("words"),
        stated_year(F.col(tournament)).alias("year"),
        F.array_sort(days).alias("days"),
    )
    return out.filter("id is not null and p is not null and q is not null").distinct()


def _keys(df: DataFrame, reach: int, is_left: bool) -> DataFrame:
    """Blocking keys. reach widens the days of one side, so that days within reach meet."""
    near = F.flatten(F.transform("days", lambda d: F.transform(F.sequence(F.lit(-reach), F.lit(reach)), lambda k: d + k)))
    surnames = F.array_distinct(F.filter(F.array("p.last", "q.last", "p.tail", "q.tail"), lambda x: F.length(x) > 0))
    tails = F.filter(F.array("p.tail", "q.tail"), lambda x: F.length(x) > 0)
    initials = F.filter(F.array(F.substring("p.first", 1, 1), F.substring("q.first", 1, 1)), lambda x: F.length(x) > 0)
    starts = F.array_join(F.array_sort(F.transform(tails, lambda x: F.substring(x, 1, 2))), "+")
    places = F.array_distinct(F.transform("words", lambda w: F.substring(w, 1, 4)))
    each = lambda xs, tag, f: F.transform(xs, lambda x: F.concat(F.lit(tag), f(x)))
    by_day = F.flatten(F.transform(near, lambda d: F.concat(each(surnames, "d", lambda x: F.concat_ws("|", x, d.cast("string"))), F.array(F.concat_ws("|", F.lit("s"), starts, d.cast("string"))))))
    by_place = F.flatten(F.transform(near, lambda d: F.transform(places, lambda w: F.concat_ws("|", F.lit("t"), w, F.array_join(F.array_sort(initials), ""), d.cast("string")))))
    both = F.array(F.concat(F.lit("b"), F.array_join(F.array_sort(tails), "|")))
    undated = F.flatten(F.transform(surnames, lambda x: F.transform(places, lambda w: F.concat_ws("|", F.lit("u"), x, w))))
    by_initials = F.when(F.size(initials) == 2, F.transform(places, lambda w: F.concat_ws("|", F.lit("i"), w, F.array_join(F.array_sort(initials), "")))).otherwise(F.array().cast("array<string>"))
    other = lambda a, b: F.when((F.length(f"{a}.tail") > 0) & (F.length(f"{b}.first") > 0), F.concat_ws("|", F.lit("c"), f"{a}.tail", F.substring(f"{b}.first", 1, 1)))
    crossed = F.filter(F.array(other("p", "q"), other("q", "p")), lambda x: x.isNotNull())
    # keys without a day are for pairs of which one side has none: 'A' where the left has none, 'B' where the right has none
    loose, undated_row = F.concat(undated, by_initials, crossed), F.size("days") == 0
    tagged = lambda tag, wanted: F.when(wanted, F.transform(loose, lambda x: F.concat(F.lit(tag), x))).otherwise(F.array().cast("array<string>"))
    both_sides = F.concat(tagged("A", undated_row if is_left else F.lit(True)), tagged("B", F.lit(True) if is_left else undated_row))
    # what else two records may share, for keys that are too common: both ends of each surname, places, initials, months
    ends = F.flatten(F.transform(tails, lambda x: F.array(F.concat(F.lit("^"), F.substring(x, 1, 3)), F.concat(F.substring(x, -3, 3), F.lit("$")))))
    months = F.transform(near, lambda d: F.date_format(F.date_from_unix_date(d), "yyyy-MM"))
    tokens = F.concat(ends, places, F.transform(initials, lambda x: F.concat(F.lit("."), x)), months)
    return df.select("id", F.array_distinct(F.concat(by_day, by_place, both, both_sides)).alias("keys"), F.array_sort(F.array_distinct(tokens)).alias("tokens"))


def _word_weights(left: DataFrame) -> DataFrame:
    """(words, weights): rarity of each word among the different tournaments of the left side, aligned with words."""
    names = left.select("words").filter(F.size("words") > 0).distinct()
    spread = names.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    weights = spread.select("word", (1 / F.log2(1 + F.col("n"))).alias("w"))
    placed = names.select("words", F.posexplode("words").alias("at", "word")).join(weights, "word")
    return placed.groupBy("words").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "w"))), lambda x: x["w"]).alias("weights"))


def _tournament_score(words: Column, weights: Column, others: Column) -> Column:
    """Weighted share of the left words that the right side has, spelled alike or cut to four letters or more."""
    alike = lambda w, o: F.when(w == o, 1.0).when((F.length(o) >= 4) & w.startswith(o), 0.9).when((F.length(w) >= 5) & (likeness(w, o) >= 0.7), 0.9).otherwise(0.0)
    best = F.transform(F.arrays_zip(words.alias("word"), weights.alias("weight")), lambda z: z["weight"] * F.array_max(F.transform(others, lambda o: alike(z["word"], o))))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    return F.when((F.size(words) > 0) & (F.size(others) > 0), total(best) / total(weights))


def link(left: DataFrame, right: DataFrame, threshold: float = 0.72, keep_share: float = 0.4, reach: int = 1, block_pairs: int = 1000) -> DataFrame:
    """(left_id, right_id, confidence): left and right are results of records()."""
    left, right = materialise(left, "link-left"), materialise(right, "link-right")
    edges = _pairs_by_rare_keys(_keys(left, reach, True), _keys(right, 0, False), keep_share, block_pairs)
    side = lambda df, tag: df.select(*[F.col(c).alias(f"{tag}_{c}") for c in df.columns])
    weights = _word_weights(left).select(F.col("words").alias("l_words"), F.col("weights").alias("l_weights"))
    both = edges.join(side(left, "l"), F.col("left_id") == F.col("l_id")).join(side(right, "r"), F.col("right_id") == F.col("r_id")).join(weights, "l_words", "left")
    gap = F.array_min(F.flatten(F.transform("l_days", lambda a: F.transform("r_days", lambda b: F.abs(a - b)))))
    year_of = lambda d: F.year(F.date_from_unix_date(d))
    wrong_year = F.col("r_year").isNotNull() & (F.size("l_days") > 0) & ~F.exists("l_days", lambda d: (year_of(d + 5) == F.col("r_year")) | (year_of(d - 5) == F.col("r_year")))
    score = lambda a, b: person_score(F.col(f"l_{a}.first"), F.col(f"l_{a}.last"), F.col(f"r_{b}.first"), F.col(f"r_{b}.last"))
    scored = both.select(
        "left_id",
        "right_id",
        gap.alias("gap"),
        wrong_year.alias("wrong_year"),
        score("p", "p").alias("pp"),
        score("q", "q").alias("qq"),
        score("p", "q").alias("pq"),
        score("q", "p").alias("qp"),
        _tournament_score(F.col("l_words"), F.col("l_weights"), F.col("r_words")).alias("tour"),
        *[F.concat_ws(" ", f"{s}_{n}.first", f"{s}_{n}.last").alias(f"{s}_{n}") for s in "lr" for n in "pq"],
        F.array_join("l_words", " ").alias("l_tour"),
        F.array_join("r_words", " ").alias("r_tour"),
    ).filter("not wrong_year and coalesce(gap, 0) <= " + str(reach))
    straight = F.col("pp") + F.col("qq") >= F.col("pq") + F.col("qp")
    scored = scored.select(
        "left_id", "right_id", "gap", "tour", "l_tour", "r_tour", "l_p", "l_q",
        F.when(straight, F.col("pp")).otherwise(F.col("pq")).alias("s1"),
        F.when(straight, F.col("qq")).otherwise(F.col("qp")).alias("s2"),
        F.when(straight, F.col("r_p")).otherwise(F.col("r_q")).alias("r1"),
        F.when(straight, F.col("r_q")).otherwise(F.col("r_p")).alias("r2"),
    ).filter("least(s1, s2) >= 0.3")
    scored = materialise(scored, "link-edges")
    best = _best(scored.select("left_id", "right_id", _score(F.col("s1"), F.col("s2"), F.col("gap"), F.col("tour")).alias("score")), threshold)
    best, _ = _settled(best, lambda current: _best(_propagate(scored, current), threshold))
    return best.select("left_id", "right_id", F.round("score", 4).alias("confidence"))


def _settled(best: DataFrame, step: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int]:
    """step applied until no edge changes, and the number of rounds. If the edges go in a cycle, its round of the highest total score.

    A round depends only on the edges before it, so edges that were there before close a cycle, and the loop ends.
    """
    rounds: list[tuple[DataFrame, tuple, float]] = []
    while True:
        now = materialise(best, "link-best")
        mark = F.xxhash64("left_id", "right_id")
        n, xor, total, score = now.agg(F.count("*"), F.bit_xor(mark), F.sum(mark.cast("decimal(20,0)")), F.round(F.sum("score"), 6)).first()
        edges = (n, xor, total)
        before = next((i for i, r in enumerate(rounds) if r[1] == edges), None)
        rounds.append((now, edges, score or 0.0))
        if before is not None:
            cycle = rounds[before + 1 :]
            _log.info("links settled after %d rounds, cycle of %d", len(rounds) - 1, len(cycle))
            return max(cycle, key=lambda r: (r[2], str(r[1])))[0], len(rounds) - 1
        best = step(now)


def _score(s1: Column, s2: Column, gap: Column, tour: Column) -> Column:
    day = F.when(gap.isNull(), 0.5).when(gap == 0, 1.0).otherwise(0.85)
    place = F.coalesce(tour, F.lit(0.5))
    whole = 0.25 * s1 + 0.25 * s2 + 0.25 * F.least(s1, s2) + 0.125 * day + 0.125 * place
    # where nothing places the match in time, the tournament has to
    weak = F.least(s1, s2) < 0.5
    return F.when(weak | (gap.isNull() & (place < 0.4)), whole - 0.2).otherwise(whole)


def _best(edges: DataFrame, threshold: float) -> DataFrame:
    """The best edge of each right record, if it reaches the threshold."""
    pick = edges.groupBy("right_id", "left_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("right_id").orderBy(F.desc("score"), "left_id")
    return pick.withColumn("k", F.row_number().over(order)).filter((F.col("k") == 1) & (F.col("score") >= threshold)).select("left_id", "right_id", "score")


def _propagate(scored: DataFrame, best: DataFrame) -> DataFrame:
    """Scores with the spellings' similarity raised by how the best edges pair them.

    An alias is a pair of spellings; its support is the share of best edges with the right spelling that pair it with
    this left one, damped by their number. An edge's own vote is taken out first.
    """
    voted = scored.join(best.select("left_id", "right_id"), ["left_id", "right_id"])
    votes = voted.select(F.inline(F.array(F.struct(F.col("l_p").alias("a"), F.col("r1").alias("b")), F.struct(F.col("l_q").alias("a"), F.col("r2").alias("b")), F.struct(F.concat(F.lit("@"), "l_tour").alias("a"), F.concat(F.lit("@"), "r_tour").alias("b")))))
    pairs = votes.groupBy("a", "b").agg(F.count("*").alias("n"))
    alias = pairs.join(pairs.groupBy("b").agg(F.sum("n").alias("total")), "b").select("a", "b", "n", "total")
    mine = best.select("left_id", "right_id", F.lit(1).alias("own"))
    out = scored.join(mine, ["left_id", "right_id"], "left").withColumn("own", F.coalesce("own", F.lit(0)))
    for i, (a, b) in enumerate((("l_p", "r1"), ("l_q", "r2"), ("l_tour", "r_tour"))):
        tag = "@" if i == 2 else ""
        one = alias.select(F.expr(f"substring(a, {len(tag) + 1})").alias(a), F.expr(f"substring(b, {len(tag) + 1})").alias(b), F.col("n").alias(f"n{i}"), F.col("total").alias(f"t{i}"), F.col("a").startswith("@").alias("is_tour")).filter(F.col("is_tour") if tag else ~F.col("is_tour")).drop("is_tour")
        out = out.join(one, [a, b], "left")

    def support(i: int) -> Column:
        n, t = F.coalesce(f"n{i}", F.lit(0)) - F.col("own"), F.coalesce(f"t{i}", F.lit(0)) - F.col("own")
        return F.when(t > 0, n / t * (n / (n + 2.0))).otherwise(0.0)

    raise_by = lambda s, i: F.greatest(s, F.least(F.lit(0.95), s + 0.3 * support(i)))
    tour = F.when(F.col("tour").isNotNull(), F.greatest(F.col("tour"), F.least(F.lit(1.0), F.col("tour") + 0.5 * support(2))))
    return out.select("left_id", "right_id", _score(raise_by(F.col("s1"), 0), raise_by(F.col("s2"), 1), F.col("gap"), tour).alias("score"))

