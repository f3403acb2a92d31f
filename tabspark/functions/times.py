"""Instants, calendar days, local times and calendar splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_zone(text: Column) -> Column:
    return F.coalesce(F.trim(text).rlike(r"(?i)(z|[+-]\d{2}:?\d{2})$") & text.rlike(r"\d:\d{2}"), F.lit(False))


def _iso(text: Column) -> Column:
    """ISO text with a whole day, the basic form (20210101T100000Z) as the extended one; else null.

    A cast alone takes a bare time ('10:15') as today's and a bare month as its first day.
    """
    clean = F.regexp_replace(F.trim(text), r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})", "$1-$2-$3T$4:$5:$6")
    return F.when(clean.rlike(r"^\d{4}-\d{2}-\d{2}"), clean)


def instant(text: Column, need_zone: bool = False) -> Column:
    """TIMESTAMP of ISO text; null where unreadable, and, if so asked, where no zone is given."""
    read = _iso(text).try_cast("timestamp")
    return F.when(has_zone(text), read) if need_zone else read


def precision_class(text: Column) -> Column:
    """'source_timestamp', 'source_calendar_date' or 'unknown'."""
    clean = _iso(text)
    return F.when(clean.try_cast("timestamp").isNull(), "unknown").when(clean.rlike(r"\d{2}:\d{2}"), "source_timestamp").otherwise("source_calendar_date")


def calendar_date(text: Column) -> Column:
    """The day as written, never shifted through a zone."""
    return F.nullif(F.regexp_extract(text, r"^\s*(\d{4}-\d{2}-\d{2})", 1), F.lit("")).try_cast("date")


def date_class(text: Column) -> Column:
    """How a date is written: null, empty, invalid, offset, timed or calendar."""
    read, clean = F.trim(text).try_cast("timestamp"), F.trim(text)
    return (
        F.when(text.isNull(), "null")
        .when(clean == "", "empty")
        .when(read.isNull(), "invalid")
        .when(has_zone(text), "offset")
        .when(clean.rlike(r"\d:\d{2}") & ~clean.rlike(r"00:00(:00(\.0+)?)?$"), "timed")
        .otherwise("calendar")
    )


def local_to_utc(local: Column, zone: str) -> Column:
    """Wall time in zone as instant; null for times in a daylight-saving gap or fold."""
    wall = local.cast("timestamp")
    utc = F.to_utc_timestamp(wall, zone)
    shown = lambda seconds: F.from_utc_timestamp(utc + F.make_dt_interval(secs=F.lit(seconds)), zone) == wall
    return F.when(shown(0) & ~shown(3600) & ~shown(-3600), utc)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def day_floor(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def minute_floor(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def epoch_ms(c: Column, first_year: int = 2020, last_year: int = 2100) -> Column:
    """Milliseconds since 1970 as instant; null outside the years."""
    read = F.timestamp_millis(c.try_cast("long"))
    return F.when(F.year(read).between(first_year, last_year), read)


def spoken_date(text: Column) -> Column:
    """'March 5, 2021' anywhere in a text as DATE."""
    month = "January|February|March|April|May|June|July|August|September|October|November|December"
    found = F.regexp_extract(text, rf"\b((?:{month}) \d{{1,2}}, \d{{4}})\b", 1)
    return F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("MMMM d, yyyy")).cast("date")


# Zone labels of prose dates with their offsets in hours.
PROSE_ZONES = {"EDT": -4, "EST": -5, "UTC": 0, "GMT": 0}


def spoken_instant(text: Column) -> Column:
    """STRUCT(day, instant, precision) of 'March 5, 2021, at 3:05 p.m. EDT' anywhere in a text; without clock and zone the day alone ('date')."""
    clock = rf"\b(\d{{1,2}}):(\d{{2}})\s*([ap])\.?m\.?\s+({'|'.join(PROSE_ZONES)})\b"
    part = lambda g: F.nullif(F.regexp_extract(text, f"(?i){clock}", g), F.lit(""))
    day, hour, minute = spoken_date(text), part(1).try_cast("int"), part(2).try_cast("int")
    offset = F.try_element_at(F.create_map(*[F.lit(x) for kv in PROSE_ZONES.items() for x in kv]), F.upper(part(4)))
    sound = hour.between(1, 12) & minute.between(0, 59) & offset.isNotNull()
    seconds = ((hour % 12 + F.when(F.lower(part(3)) == "p", 12).otherwise(0) - offset) * 60 + minute) * 60
    at = F.when(F.coalesce(sound, F.lit(False)), F.timestamp_seconds(F.unix_date(day).cast("long") * 86400 + seconds))
    return F.struct(day.alias("day"), at.alias("instant"), F.when(day.isNull(), "none").when(at.isNull(), "date").otherwise("minute").alias("precision"))


def calendar_split(
    ts: Column,
    edges: Sequence[str],
    labels: Sequence[str],
    unknown: str | None = "unknown_date",
    boundary_days: Sequence[str] = (),
    boundary_when: Column | None = None,
    boundary_label: str = "date_precision_unresolved",
) -> Column:
    """Label by calendar: labels[i] up to edges[i], the last label from the last edge on.

    Rows on a boundary day whose precision can't tell the side (boundary_when; all rows if it isn't given) get a label of
    their own; a null time gets ``unknown``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges")
    out = F.when(ts.isNull(), F.lit(unknown))
    if boundary_days:
        on = F.date_format(ts, "yyyy-MM-dd").isin(*boundary_days)
        out = out.when(on & (F.coalesce(boundary_when, F.lit(False)) if boundary_when is not None else F.lit(True)), boundary_label)
    for edge, label in zip(edges, labels, strict=False):
        out = out.when(ts < F.lit(edge).cast("timestamp"), label)
    return out.otherwise(labels[-1])


@dataclass(frozen=True)
class Split:
    """A split by calendar: classes, the label of an unknown time, and when a boundary day can't tell the side.

    doubt: 'never', 'always', 'calendar_date' (the day alone is known), 'no_timestamp' (anything but a timestamp).
    by: 'instant', 'year' (whole years), 'text' (ISO text, compared as text).
    """

    classes: int
    unknown: str | None = None
    doubt: str = "never"
    doubt_label: str = "date_precision_unresolved"
    sides: str = "both"  # of an edge: its day and the one before, or the day before alone
    by: str = "instant"


# The splits in use. Three classes are fit, calibration and holdout; two are development and holdout.
SPLITS = {
    "context": Split(3, "unknown_date", "calendar_date"),
    "team_styles": Split(3, "date_unresolved", "no_timestamp"),
    "injury_views": Split(3, "unresolved_game_time"),
    "injury_entries": Split(3, "unresolved_game_time"),
    "schedule_density": Split(3),
    "points": Split(3, "date_unresolved", "always"),
    "air_quality": Split(3, by="year"),
    "attendance": Split(2),
    "play_styles": Split(2, "unknown_date", "no_timestamp"),
    "officials": Split(2, "unknown_game_date", "no_timestamp"),
    "weather": Split(2, doubt="no_timestamp"),
    "plays": Split(2, "unmatched_game_date"),
    "match_weather": Split(2, "holdout"),
    "shots": Split(2, "date_unresolved", "no_timestamp", "boundary_unresolved", "before"),
    "odds": Split(2),
    "profiles": Split(2, "unresolved_year", by="year"),
    "spectators": Split(2, by="text"),
    "model": Split(3),
}


def split_as(split: Split, ts: Column, precision: Column, edges: Sequence[str]) -> Column:
    """The class of a time under a split. edges: one day less than classes, as ISO dates; the precision is that of precision_class."""
    labels = ["fit", "calibration", "holdout"] if split.classes == 3 else ["development", "holdout"]
    if split.by == "year":
        out, year = F.when(ts.isNull(), F.lit(split.unknown)), F.year(ts)
        for edge, label in zip(edges, labels, strict=False):
            out = out.when(year < int(edge[:4]), label)
        return out.otherwise(labels[-1])
    if split.by == "text":
        text, out = F.date_format(ts, "yyyy-MM-dd"), F.when(ts.isNull(), F.lit(split.unknown))
        for edge, label in zip(edges, labels, strict=False):
            out = out.when(text < edge, label)
        return out.otherwise(labels[-1])
    days = [d for e in edges for d in ([str(date.fromisoformat(e) - timedelta(1))] + ([e] if split.sides == "both" else []))] if split.doubt != "never" else []
    when = {"always": F.lit(True), "calendar_date": precision == "source_calendar_date", "no_timestamp": precision != "source_timestamp"}.get(split.doubt)
    return calendar_split(ts, edges, labels, split.unknown, days, when, split.doubt_label)
