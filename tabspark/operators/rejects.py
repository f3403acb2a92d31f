"""Rows that fail to parse: cells against a rule table, errors aggregated, clean rows anti-joined.

Each delimited line becomes cells (row, column, value). Two further cells say how the line itself parsed:
``#quoting`` ('sound' or 'broken') and ``#width`` (number of fields). A rule names a column, a pattern that its
trimmed value must match as a whole, and a reason; the rule with the lowest priority that fails gives the reason.

Defined results: rows with a null key are judged together like any other key; a null line has broken no quote and has no fields, so it fails ``#width``; an empty line has one
empty field; a null cell fails its rule; rows with the same key are judged together (lowest priority wins); columns
named like the operator's own are never read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.session import materialise

#: A line is sound if each field is either free of quotes or quoted as a whole, inner quotes doubled.
SOUND_LINE = r'\A(?:"(?:[^"]++|"")*+"|[^",]*+)(?:,(?:"(?:[^"]++|"")*+"|[^",]*+))*+\z'
FIELD = r',("(?:[^"]++|"")*+"|[^",]*+)'


@dataclass(frozen=True)
class Rule:
    column: str
    pattern: str
    reason: str


RULE_SCHEMA = T.StructType(
    [
        T.StructField("rule_column", T.StringType()),
        T.StructField("rule_pattern", T.StringType()),
        T.StructField("rule_reason", T.StringType()),
        T.StructField("rule_priority", T.IntegerType()),
    ]
)


def structural_rules(width: int) -> list[Rule]:
    return [Rule("#quoting", "sound", "quoting"), Rule("#width", str(width), "column_count")]


def fields_of(line: Column) -> Column:
    """The unquoted fields of a sound line. The leading comma lets an empty first field match."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(FIELD), F.lit(1))
    return F.transform(raw, lambda x: F.when(x.startswith('"'), F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), '""', '"')).otherwise(x))


def parse_lines(df: DataFrame, key: str, line: str, header: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., line_sound, line_fields); line_fields is null where quoting is broken."""
    text = F.col(line)
    sound = F.coalesce(text.rlike(SOUND_LINE), F.lit(True))
    return df.select(key, *keep, sound.alias("line_sound"), F.when(text.isNotNull() & sound, fields_of(text)).alias("line_fields"))


def explode_cells(parsed: DataFrame, key: str, header: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(key, cell_column, cell_value) for the named columns: those without a rule are pruned before the explode."""
    wanted = [F.struct(F.lit(name).alias("cell_column"), F.get(F.col("line_fields"), F.lit(i)).alias("cell_value")) for i, name in enumerate(header) if name in set(columns)]
    about = [
        F.struct(F.lit("#quoting").alias("cell_column"), F.when(F.col("line_sound"), "sound").otherwise("broken").alias("cell_value")),
        F.struct(F.lit("#width").alias("cell_column"), F.coalesce(F.size("line_fields"), F.lit(0)).cast("string").alias("cell_value")),
    ]
    return parsed.select(key, F.inline(F.array(*about, *wanted)))


def rule_table(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.sparkSession.createDataFrame([(r.column, rf"\A(?:{r.pattern})\z", r.reason, i) for i, r in enumerate(rules)], RULE_SCHEMA)


def _judged(parsed: DataFrame, key: str, header: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    rules = [*structural_rules(len(header)), *rules]
    cells = explode_cells(parsed, key, header, [r.column for r in rules])
    judged = cells.join(F.broadcast(rule_table(parsed, rules)), F.col("cell_column") == F.col("rule_column"))  # the rules are a literal list
    bad = judged.filter(~F.coalesce(F.expr(r"regexp_replace(cell_value, '^\\s+|\\s+$', '') rlike rule_pattern"), F.lit(False)))
    return bad.groupBy(key).agg(F.min(F.struct("rule_priority", "rule_reason")).alias("first"), F.count("*").alias("n_errors")).select(key, F.col("first.rule_reason").alias("reason"), "n_errors")


def failed_lines(df: DataFrame, key: str, line: str, header: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """(key, reason, n_errors): one row per key that fails at least one rule."""
    return _judged(parse_lines(df, key, line, header), key, header, rules)


def sound_lines(df: DataFrame, key: str, line: str, header: Sequence[str], rules: Sequence[Rule], keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., one text column per header name): the rows that fail no rule.

    The lines are read and parsed once, into the shared folder; their errors are then anti-joined, null keys with null keys.
    """
    parsed = materialise(parse_lines(df, key, line, header, keep), "parsed-lines")
    failed = _judged(parsed, key, header, rules).select(F.col(key).alias("__failed"))
    clean = parsed.join(failed, F.col(key).eqNullSafe(F.col("__failed")), "left_anti")
    return clean.select(key, *keep, *[F.get("line_fields", F.lit(i)).alias(name) for i, name in enumerate(header)])
