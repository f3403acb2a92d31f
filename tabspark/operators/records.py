"""Normalising records of a source with reasons, statuses and checks: reports, readings, statements, calendars, keys.

Every function keeps all rows: what can't be used is marked with its reasons, never dropped. Null inputs fail the check that
needs them; repeated rows are marked together; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.functions.mathx import bins, haversine_m
from tabspark.operators.quality import null_safe_join, reasons
from tabspark.operators.temporal import DAY_US, drop_halo, slice_window, sliced


def typed_identity(df: DataFrame, column: str) -> Column:
    """An identifier by the column's type: numbers have to be whole ('12'; fractions are null), texts are trimmed, empty ones null."""
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(kind, T.NumericType):
        exact = c.cast("decimal(38,6)")
        return F.when(exact == F.floor(exact), F.floor(exact).cast("decimal(32,0)").cast("string"))
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def report_entries(df: DataFrame, person: Column, status: Column, reason: Column, keys: Sequence[Column], statuses: Sequence[str], not_submitted: str = "not yet submitted") -> DataFrame:
    """df with entry_type ('player_status', 'team_not_submitted', 'unresolved') and parse_valid (resolved, and all keys known)."""
    present = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    open_team = F.coalesce(F.lower(F.trim(F.regexp_replace(reason, r"\s+", " "))) == not_submitted, F.lit(False))
    kind = F.when(present(person) & F.coalesce(F.trim(status).isin(*statuses), F.lit(False)), "player_status").when(open_team & ~present(person), "team_not_submitted").otherwise("unresolved")
    known = F.lit(True)
    for k in keys:
        known = known & present(k.cast("string"))
    return df.withColumn("entry_type", kind).withColumn("parse_valid", known & (F.col("entry_type") != "unresolved"))


def banded_readings(df: DataFrame, codes: Column, day: Column, value: Column, stated: Column, count: Column, edges: Sequence[float], labels: Sequence[str], year: Column) -> DataFrame:
    """Readings per place and day with what is wrong about them.

    Adds place, day, reading (a whole number of at least 0), band (from the reading), band_check (the stated band against it),
    count_check and exclusion_reason: names joined by ';', empty for sound rows. Of rows of one place and day all are excluded.
    """
    clean = lambda c: F.trim(c.cast("string"))
    place = F.when(clean(codes).rlike(r"\A[0-9]{1,5}\z") & ~clean(codes).rlike(r"\A0+\z"), F.lpad(clean(codes), 5, "0"))
    date = F.when(clean(day).rlike(r"\A\d{4}-\d{2}-\d{2}\z"), clean(day).try_cast("date"))
    whole = lambda c: F.when(clean(c).rlike(r"\A[0-9]{1,9}(?:\.0+)?\z"), clean(c).try_cast("double").cast("long"))
    rows = df.withColumns({"place": place, "day": date, "reading": whole(value), "n_sites": whole(count), "__stated": F.lower(clean(stated)), "__count": clean(count), "__year": year})
    rows = rows.withColumn("band", F.when(F.col("reading").isNotNull(), bins(F.col("reading"), edges, labels, closed="right")))
    known = F.col("__stated").isin(*[x.lower() for x in labels])
    rows = rows.withColumn("band_check", F.when(F.coalesce(F.col("__stated"), F.lit("")) == "", "missing").when(~known, "unrecognised").when(F.col("reading").isNull(), "no_reading").when(F.col("__stated") == F.lower("band"), "matches").otherwise("differs"))
    rows = rows.withColumn("count_check", F.when(F.coalesce(F.col("__count"), F.lit("")) == "", "missing").when(F.col("n_sites").isNull(), "invalid").when(F.col("n_sites") == 0, "none").otherwise("valid"))
    usable = rows.filter("place is not null and day is not null").groupBy("place", "day").agg(F.count("*").alias("__n"))
    rows = rows.join(usable, ["place", "day"], "left") if set(df.columns).isdisjoint({"place", "day"}) else null_safe_join(rows, usable, ["place", "day"])
    wrong = {"invalid_codes": F.col("place").isNull(), "invalid_date": F.col("day").isNull(), "other_year": F.year("day") != F.col("__year"), "invalid_reading": F.col("reading").isNull(), "conflicting_rows": F.col("__n") > 1}
    return rows.withColumn("exclusion_reason", F.coalesce(reasons(wrong, ";"), F.lit(""))).drop("__stated", "__count", "__year", "__n")


def consolidated_events(df: DataFrame, key: str, values: Mapping[str, Column], required: Sequence[str]) -> DataFrame:
    """(key, values..., problems, status): one row per event from all its statements.

    A value that the statements agree on is taken; one they contradict each other on is null and a problem ('name_conflict'),
    as is a required one that none has ('name_missing'). status: 'complete', 'partial' (only optional ones in doubt), 'unusable'.
    """
    rows = df.groupBy(key).agg(*[F.when(F.min(c) == F.max(c), F.min(c)).alias(n) for n, c in values.items()], *[F.count_distinct(c).alias(f"__n_{n}") for n, c in values.items()])
    problem = [F.when(F.col(f"__n_{n}") > 1, f"{n}_conflict").when((F.col(f"__n_{n}") == 0) & F.lit(n in required), f"{n}_missing") for n in values]
    hard = F.lit(False)
    for n in required:
        hard = hard | (F.col(f"__n_{n}") != 1)
    listed = F.concat_ws("|", *problem)
    return rows.select(key, *values, listed.alias("problems"), F.when(hard, "unusable").when(listed != "", "partial").otherwise("complete").alias("status"))


def payload_shape(text: Column, schema: str, required: Sequence[str]) -> Column:
    """'absent' (no payload), 'invalid' (not of the schema), 'incomplete' (a required part is null), 'valid'."""
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    shaped = F.coalesce(F.trim(text).startswith("{"), F.lit(False)) & F.try_parse_json(text).isNotNull()
    whole = F.lit(True)
    for name in required:
        whole = whole & parsed[name].isNotNull()
    return F.when(text.isNull(), "absent").when(~shaped, "invalid").when(whole, "valid").otherwise("incomplete")


def known_statements(claims: Column, mandatory: bool = True) -> Column:
    """STRUCT(values ARRAY, reason): different values of an array of (value, rank) that aren't deprecated; reason 'missing' where a mandatory one has none."""
    kept = F.array_sort(F.array_distinct(F.transform(F.filter(claims, lambda s: (F.coalesce(s["rank"], F.lit("")) != "deprecated") & s["value"].isNotNull()), lambda s: s["value"])))
    return F.struct(F.coalesce(kept, F.array().cast("array<string>")).alias("values"), F.when(F.lit(mandatory) & (F.coalesce(F.size(kept), F.lit(0)) == 0), "missing").alias("reason"))


def dates_in_bounds(df: DataFrame, entity: str, day: str, low: str, high: str, most: int) -> DataFrame:
    """Different (entity, day) inside the bounds, with whether the entity has at most ``most`` of them (a gate: nothing is cut off)."""
    pairs = df.select(entity, day).filter(F.col(day).between(F.lit(low).cast("date"), F.lit(high).cast("date"))).distinct()
    sizes = pairs.groupBy(entity).agg(F.count("*").alias("n_days"))
    return pairs.join(sizes, entity).withColumn("within_cap", F.col("n_days") <= most)


def with_meanings(df: DataFrame, meanings: Mapping[str, str]) -> DataFrame:
    """df with the meaning of each column as its comment; a column without one fails."""
    missing = sorted(set(df.columns) - set(meanings))
    if missing:
        raise ValueError(f"columns without a meaning: {missing}")
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={"comment": meanings[c]}) for c in df.columns])


def dictionary(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, meaning) of a table's columns."""
    rows = [(i, f.name, f.dataType.simpleString(), f.metadata.get("comment")) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, meaning string")


def gate_counts(df: DataFrame, gates: Mapping[str, Column]) -> DataFrame:
    """(gate, n_failed, n_first, n_left): rows that fail each gate by itself, that it is the first to stop, and that are left after it. One aggregate."""
    failed = {n: ~F.coalesce(c, F.lit(False)) for n, c in gates.items()}
    aggregates, before = [], F.lit(True)
    for n, bad in failed.items():
        aggregates += [F.count_if(bad).alias(f"f:{n}"), F.count_if(before & bad).alias(f"s:{n}")]
        before = before & ~bad
        aggregates.append(F.count_if(before).alias(f"l:{n}"))
    row = df.agg(*aggregates)
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("gate"), F.col(f"`f:{n}`").alias("n_failed"), F.col(f"`s:{n}`").alias("n_first"), F.col(f"`l:{n}`").alias("n_left")) for n in gates])))


def coverage_status(n_found: Column, n_expected: Column) -> Column:
    """'complete', 'partial', or 'audit_only' where nothing was found or nothing expected."""
    return F.when((n_found > 0) & (n_found >= n_expected), "complete").when((n_found > 0) & (n_expected > 0), "partial").otherwise("audit_only")


def dated_pair_matches(left: DataFrame, right: DataFrame, on: Sequence[str], left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id, n_partners, status): each left row by its day and pair; 'matched' if both have one partner only, else 'demoted', 'unmatched' without any."""
    a, b = left.select(left_id, *on).distinct(), right.select(right_id, *on).dropna().distinct()
    pairs = a.dropna().join(b, list(on)).select(left_id, right_id).distinct()
    by_left, by_right = pairs.groupBy(left_id).agg(F.count("*").alias("__l"), F.min(right_id).alias(right_id)), pairs.groupBy(right_id).agg(F.count("*").alias("__r"))
    out = a.select(left_id).distinct().join(by_left, left_id, "left").join(by_right, right_id, "left")
    alone = (F.col("__l") == 1) & (F.col("__r") == 1)
    return out.select(left_id, F.when(alone, F.col(right_id)).alias(right_id), F.coalesce("__l", F.lit(0)).alias("n_partners"), F.when(F.col("__l").isNull(), "unmatched").when(alone, "matched").otherwise("demoted").alias("status"))


def place_ladder(a: DataFrame, b: DataFrame, identity: str, a_id: str, point_m: float = 2.0, facility_m: float = 500.0) -> DataFrame:
    """(a_id, identity, metres, status): a's rows against b's row of the same identity; nearness never picks another.

    status: 'no_identity', 'no_row', 'several_coordinates' (b's rows of the identity disagree), 'no_coordinate', 'same_point',
    'same_facility', 'too_far'. Columns lat and lon on both sides.
    """
    once = b.filter(F.col(identity).isNotNull()).groupBy(identity).agg(F.count_distinct(F.struct("lat", "lon")).alias("__n"), F.min("lat").alias("__lat"), F.min("lon").alias("__lon"))
    out = a.join(once, identity, "left")
    metres = F.when(F.col("__n") == 1, haversine_m(F.col("lat"), F.col("lon"), F.col("__lat"), F.col("__lon")))
    status = F.when(F.col(identity).isNull(), "no_identity").when(F.col("__n").isNull(), "no_row").when(F.col("__n") > 1, "several_coordinates").when(metres.isNull(), "no_coordinate").when(metres <= point_m, "same_point").when(metres <= facility_m, "same_facility").otherwise("too_far")
    return out.select(a_id, identity, metres.alias("metres"), status.alias("status"))


def greedy_distinct(df: DataFrame, group: str, order: Sequence[str], marks: Sequence[str], most: int) -> DataFrame:
    """Per group the first ``most`` rows in order that share none of the marks with one picked before.

    A fold over the group's rows in order that keeps no more than what is picked; only marks and order are gathered, after
    rows of equal marks have become the first of them.
    """
    first = df.groupBy(group, *marks).agg(F.min(F.struct(*order)).alias("__o"))
    kinds = {m: df.schema[m].dataType.simpleString() for m in marks}
    item = "struct<" + ",".join([f"o:{first.schema['__o'].dataType.simpleString()}", *[f"m{i}:{kinds[m]}" for i, m in enumerate(marks)]]) + ">"
    rows = first.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col("__o").alias("o"), *[F.col(m).alias(f"m{i}") for i, m in enumerate(marks)]))).alias("__rows"))
    clash = lambda acc, x: F.exists(acc, lambda y: _any([F.equal_null(y[f"m{i}"], x[f"m{i}"]) for i in range(len(marks))]))
    picked = F.aggregate("__rows", F.array().cast(f"array<{item}>"), lambda acc, x: F.when((F.size(acc) >= most) | clash(acc, x), acc).otherwise(F.concat(acc, F.array(x))))
    out = rows.select(group, F.posexplode(picked).alias("pick", "x"))
    return out.select(group, (F.col("pick") + 1).alias("pick"), "x.o.*", *[F.col(f"x.m{i}").alias(m) for i, m in enumerate(marks) if m not in order])


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def pair_quarantine(df: DataFrame, key: str, me: str, other: str, side: str, same: Sequence[str]) -> DataFrame:
    """df with is_valid: a key holds if it has exactly two rows that name each other, stand on different sides and agree in ``same``. One aggregate."""
    known = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("__n"), F.array_sort(F.collect_set(me)).alias("__me"), F.array_sort(F.collect_set(other)).alias("__other"), F.count_distinct(side).alias("__sides"), *[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(f"__{c}") for c in same]
    )
    agree = (F.col("__n") == 2) & (F.size("__me") == 2) & (F.col("__me") == F.col("__other")) & (F.col("__sides") == 2)
    for c in same:
        agree = agree & (F.col(f"__{c}") == 1)
    return df.join(known.select(key, agree.alias("is_valid")), key, "left").withColumn("is_valid", F.coalesce("is_valid", F.lit(False)))


def calendar_gaps(df: DataFrame, day: str, low: str, high: str) -> DataFrame:
    """(day, n, problem): days of the range that are missing or occur several times, and days outside it ('missing', 'repeated', 'outside')."""
    have = df.filter(F.col(day).isNotNull()).groupBy(F.col(day).cast("date").alias("day")).agg(F.count("*").alias("n"))
    wanted = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(low).cast("date"), F.lit(high).cast("date"))).alias("day"), F.lit(1).alias("__w"))
    both = wanted.join(have, "day", "full_outer")
    problem = F.when(F.col("__w").isNull(), "outside").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated")
    return both.select("day", F.coalesce("n", F.lit(0)).alias("n"), problem.alias("problem")).filter("problem is not null")


def not_after_snapshot(df: DataFrame, edited: str, snapshot: Column) -> DataFrame:
    """df with in_snapshot: whether a record was last edited before or at the snapshot; unknown counts as no."""
    return df.withColumn("in_snapshot", F.coalesce(F.col(edited) <= snapshot, F.lit(False)))


def reject_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> None:
    """Raise if two inputs share a key. One semi join that stops at the first."""
    if a.select(*keys).join(b.select(*keys).distinct(), list(keys), "left_semi").limit(1).count():
        raise ValueError(f"the inputs share keys of {list(keys)}")


def first_examples(df: DataFrame, order: Sequence[str], most: int = 20) -> DataFrame:
    """The first rows in order, for the text of an error (the bound is the feature)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(most)


def in_order(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """df sorted by all keys, nulls last. The sort is global, by ranges of the keys."""
    return df.orderBy(*[k.asc_nulls_last() for k in keys])


def lagged_role(df: DataFrame, entity: str, at_us: str, tie: str, role: str, default: str = "OTHER") -> DataFrame:
    """df with previous_role: the role of the entity's last appearance, the default where there is none or none known. In slices of an entity."""
    last = F.lag(role).over(slice_window(entity))
    return drop_halo(sliced(df, entity, at_us, tie, 1).withColumn("previous_role", F.coalesce(last, F.lit(default))))


def hours_since_last(df: DataFrame, entity: str, at_us: str, tie: str, is_precise: Column) -> DataFrame:
    """df with hours_since (only where this row's time and the last one's are precise) and days_since (calendar days in UTC). In slices of an entity."""
    w = slice_window(entity)
    out = sliced(df.withColumn("__precise", is_precise), entity, at_us, tie, 1)
    before, sure = F.lag(at_us).over(w), F.lag("__precise").over(w) & F.col("__precise")
    hours = F.when(F.coalesce(sure, F.lit(False)), (F.col(at_us) - before) / 3_600_000_000.0)
    days = (F.floor(F.col(at_us) / DAY_US) - F.floor(before / DAY_US)).cast("long")
    return drop_halo(out.withColumns({"hours_since": hours, "days_since": days})).drop("__precise")


def resolve_team(name: Column, aliases: Mapping[str, str]) -> Column:
    """The one team that a spelling stands for, without case and signs; null where none does. aliases maps spellings to teams."""
    plain = lambda s: "".join(ch for ch in s.lower() if ch.isalnum())
    table = {plain(k): v for k, v in aliases.items()}
    if len(table) != len({plain(k) for k in aliases}) or any(table[plain(k)] != v for k, v in aliases.items()):
        raise ValueError("a spelling stands for several teams")
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.regexp_replace(F.lower(name), "[^a-z0-9]", ""))
