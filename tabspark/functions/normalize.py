"""Normalising identifiers, flags, numbers, text and headers. A value that can't be read becomes null, never an error."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings of flags.
TRUE_WORDS, FALSE_WORDS = ("true", "1", "1.0", "t", "yes"), ("false", "0", "0.0", "f", "no")
GSIS_PATTERN = "00-[0-9]{7}"


def number(c: Column) -> Column:
    """Text or number as DOUBLE; NaN and infinities become null."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def identifier(c: Column) -> Column:
    """'401.0' and 401 as '401'; fractions and text become null. Exact up to 38 digits."""
    exact = F.trim(c.cast("string")).try_cast("decimal(38,6)")
    return F.when(exact == F.floor(exact), F.floor(exact).cast("decimal(32,0)").cast("string"))


def suffix_id(c: Column, width: int = 0) -> Column:
    """Text without a trailing '.0', padded with zeros to width; longer values stay whole."""
    text = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text) if width else text


def matching(c: Column, pattern: str) -> Column:
    """c where it matches as a whole, else null."""
    return F.when(c.rlike(rf"\A(?:{pattern})\z"), c)


def full_match(c: Column, pattern: str) -> Column:
    """Whether c matches as a whole; null counts as no."""
    return F.coalesce(c.rlike(rf"\A(?:{pattern})\z"), F.lit(False))


def contains(c: Column, pattern: str) -> Column:
    """Whether c holds the pattern in any case; null counts as no."""
    return F.coalesce(c.rlike(f"(?i){pattern}"), F.lit(False))


def digit_id(c: Column) -> Column:
    return matching(c, "[1-9][0-9]*")


def gsis_valid(c: Column) -> Column:
    return full_match(c, GSIS_PATTERN)


def flag(c: Column, true_words: Sequence[str] = TRUE_WORDS, false_words: Sequence[str] = FALSE_WORDS) -> Column:
    """Text as BOOLEAN; unknown words are null."""
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin(*true_words), F.lit(True)).when(word.isin(*false_words), F.lit(False))


def unsigned(c: Column) -> Column:
    """Plain digits below 2**63 as BIGINT."""
    wide = matching(F.trim(c.cast("string")), "[0-9]{1,19}").try_cast("decimal(38,0)")
    return F.when(wide <= F.lit("9223372036854775807").cast("decimal(38,0)"), wide.cast("long"))


def bounded_decimal(c: Column, high: float | None = None) -> Column:
    """DECIMAL(38,18) at least 0 and at most high; other values are null."""
    x = c.cast("string").try_cast("decimal(38,18)")
    inside = x >= 0
    return F.when(inside & (x <= high) if high is not None else inside, x)


def alias(c: Column, names: Mapping[str, str]) -> Column:
    """c with the names in the mapping replaced; others stay."""
    if not names:
        return c
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), c), c)


def blank_to_null(c: Column) -> Column:
    """Null for text of white space only; other text stays as it is."""
    return F.when(~c.rlike(r"\A\s*\z"), c)


def first_known(*columns: Column) -> Column:
    return F.coalesce(*columns)


def language_fallback(preferred: Column, other: Column) -> Column:
    """STRUCT(label, language): the preferred label, else the multilingual one."""
    a, b = F.nullif(F.trim(preferred), F.lit("")), F.nullif(F.trim(other), F.lit(""))
    return F.struct(F.coalesce(a, b).alias("label"), F.when(a.isNotNull(), "en").when(b.isNotNull(), "mul").alias("language"))


def contract_identity(condition: Column, token_one: Column, token_two: Column) -> Column:
    """Whether condition is 0x and 64 hex digits and the tokens are two different decimal strings."""
    return full_match(condition, "0x[0-9a-f]{64}") & full_match(token_one, "[0-9]+") & full_match(token_two, "[0-9]+") & F.coalesce(token_one != token_two, F.lit(False))


def height_cm(c: Column) -> Column:
    """'6-2' in feet and inches as centimetres."""
    feet, inches = (F.nullif(F.regexp_extract(c, "^([0-9])-([0-9]{1,2})$", i), F.lit("")).try_cast("int") for i in (1, 2))
    return (feet * 12 + inches) * 2.54


def one_hot(c: Column, values: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 DOUBLE column per value; all 0 for null."""
    return [F.when(c == v, 1.0).otherwise(0.0).alias(f"{prefix}{v}") for v in values]


def latin_fold(c: Column) -> Column:
    """Lower case, accents off Latin letters, everything else than letters and digits out."""
    pairs = [(chr(i), unicodedata.normalize("NFKD", chr(i))[0]) for i in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if b.isascii() and b.isalpha()]
    folded = F.translate(c, "".join(a for a, _ in pairs), "".join(b for _, b in pairs))
    return F.regexp_replace(F.lower(folded), "[^a-z0-9]", "")


@F.pandas_udf(T.StringType())
def casefold_nfc(values: pd.Series) -> pd.Series:
    """NFC, case folded, single blanks. In Python: Spark has no Unicode normaliser; use it on distinct values."""
    return values.map(lambda v: None if v is None else " ".join(unicodedata.normalize("NFC", v).casefold().split()))


def squeeze(c: Column) -> Column:
    """Single blanks and straight apostrophes."""
    return F.trim(F.regexp_replace(F.translate(c, "‘’", "''"), r"\s+", " "))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """The group, or null where the pattern doesn't match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def phrases(c: Column, pattern: str, most: int = 20) -> Column:
    """Different matches in lower case, sorted, the first ``most`` of them (part of the definition of the feature)."""
    return F.slice(F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda x: F.lower(x)))), 1, most)


def evidence_hash(*parts: Column) -> Column:
    """SHA-256 over the parts as a JSON list; nulls are part of it."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts]), {"ignoreNullFields": "false"}), 256)


def weekday_agrees(day: Column, name: Column) -> Column:
    return F.lower(F.date_format(day, "EEEE")) == F.lower(F.trim(name))


def integral_key(c: Column) -> Column:
    """'12' and '12.0' as '12'; at least 1."""
    whole = extract(F.trim(c), r"^0*([1-9][0-9]*)(?:\.0+)?$")
    return whole


def header_key(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", unicodedata.normalize("NFKC", name).casefold())


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).replace(" ", "_").lower()
