"""Text extraction: keyword mentions, sections, rule facts, HTML blocks."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.functions.normalize import contains, phrases
from tabspark.functions.times import spoken_date


def whole_words(words: Sequence[str]) -> str:
    """A pattern for any of the words (patterns themselves), not inside a longer word of any script."""
    return rf"(?:^|[^\p{{L}}\p{{N}}_])(?:{'|'.join(words)})(?:$|[^\p{{L}}\p{{N}}_])"


def mentions(df: DataFrame, text: str, categories: Mapping[str, str], keep: list[str], negation: Sequence[str], retrospective: Sequence[str], most: int = 20) -> DataFrame:
    """(keep..., category, n_phrases, phrases, negated, retrospective): one row per category that a text mentions.

    The words that turn a mention around, or into the past, are the caller's.
    """
    c = F.col(text)
    found = F.array(*[F.struct(F.lit(name).alias("category"), phrases(c, f"(?i){pattern}", most).alias("phrases")) for name, pattern in categories.items()])
    rows = df.select(*keep, contains(c, whole_words(negation)).alias("negated"), contains(c, whole_words(retrospective)).alias("retrospective"), F.inline(F.filter(found, lambda x: F.size(x["phrases"]) > 0)))
    return rows.select(*keep, "category", F.size("phrases").alias("n_phrases"), F.array_join("phrases", "|").alias("phrases"), "negated", "retrospective")


def shot_distance(text: Column) -> Column:
    """Feet in '24-foot' or '24 ft'."""
    return F.nullif(F.regexp_extract(F.lower(text), r"\b([0-9]{1,2})[- ]?(?:foot|feet|ft)\b", 1), F.lit("")).try_cast("int")


def is_three(text: Column) -> Column:
    return contains(text, r"three[- ]point|3[- ]?pt")


def sections(df: DataFrame, blocks: str, keep: list[str], start: str, stop: str) -> DataFrame:
    """(keep..., pos, block): the blocks between a heading that matches start and the next that matches stop, headings out."""
    inside = F.aggregate(
        F.col(blocks),
        F.struct(F.lit(False).alias("on"), F.array().cast("array<string>").alias("out")),
        lambda acc, b: F.when(contains(b, start), F.struct(F.lit(True).alias("on"), acc["out"].alias("out")))
        .when(contains(b, stop), F.struct(F.lit(False).alias("on"), acc["out"].alias("out")))
        .when(acc["on"], F.struct(F.lit(True).alias("on"), F.concat(acc["out"], F.array(b)).alias("out")))
        .otherwise(acc),
    )["out"]
    return df.select(*keep, F.posexplode(inside).alias("pos", "block"))


def rule_facts(df: DataFrame, text: str, rules: Mapping[str, str], keep: list[str]) -> DataFrame:
    """(keep..., fact, value): the value of each rule whose pattern gives exactly one different value in a text."""
    c = F.col(text)
    found = F.array(*[F.struct(F.lit(name).alias("fact"), F.array_distinct(F.regexp_extract_all(c, F.lit(p), F.lit(1))).alias("vs")) for name, p in rules.items()])
    return df.select(*keep, F.inline(F.filter(found, lambda x: F.size(x["vs"]) == 1))).select(*keep, "fact", F.get("vs", F.lit(0)).alias("value"))


class _Blocks(HTMLParser):
    KEEP, DROP = {"p", "h1", "h2", "h3", "h4", "li", "td", "th", "title"}, {"script", "style", "nav", "aside", "footer", "header"}

    def __init__(self) -> None:
        super().__init__()
        self.blocks: list[str] = []
        self.text: list[str] = []
        self.dropped = 0

    def flush(self) -> None:
        if block := " ".join("".join(self.text).split()):
            self.blocks.append(block)
        self.text = []

    def handle_starttag(self, tag, attrs) -> None:
        self.dropped += tag in self.DROP
        if tag in self.KEEP:
            self.flush()

    def handle_endtag(self, tag) -> None:
        self.dropped -= tag in self.DROP and self.dropped > 0
        if tag in self.KEEP:
            self.flush()

    def handle_data(self, data) -> None:
        if not self.dropped:
            self.text.append(data)


def blocks_of(html: str | None) -> list[str] | None:
    if html is None:
        return None
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


@F.pandas_udf(T.ArrayType(T.StringType()))
def html_blocks(pages: pd.Series) -> pd.Series:
    """Text blocks of HTML without navigation and other secondary content. In Python: HTML needs a parser."""
    return pages.map(blocks_of)


_ASIDE = ("related", "card", "sidebar", "promo", "newsletter", "recommend")


class _Page(_Blocks):
    """The blocks of the main container (main, article, else the whole page) without cards of other pages; meta and JSON-LD."""

    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self) -> None:
        super().__init__()
        self.open: list[tuple[str, bool, bool]] = []  # tag, is left out, is main
        self.main: list[str] = []
        self.meta: dict[str, str] = {}
        self.linked: list[str] = []
        self.data_json: list[str] | None = None

    def handle_starttag(self, tag, attrs) -> None:
        about = {k: v or "" for k, v in attrs}
        if tag == "meta":
            name = about.get("property") or about.get("name")
            if name and "content" in about:
                self.meta.setdefault(name.lower(), about["content"])
        if tag == "script" and about.get("type", "").lower() == "application/ld+json":
            self.data_json = []
        if tag in self.VOID:
            return
        out = tag in self.DROP or any(w in about.get("class", "").lower() for w in _ASIDE)
        if tag in self.KEEP or tag in ("main", "article"):
            self.flush()
        self.open.append((tag, out, tag in ("main", "article")))

    def handle_endtag(self, tag) -> None:
        if tag == "script" and self.data_json is not None:
            self.linked.append("".join(self.data_json))
            self.data_json = None
        if tag in self.KEEP or tag in ("main", "article"):
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def flush(self) -> None:
        before = len(self.blocks)
        super().flush()
        if len(self.blocks) > before and any(m for _, _, m in self.open):
            self.main.append(self.blocks[-1])

    def handle_data(self, data) -> None:
        if self.data_json is not None:
            self.data_json.append(data)
        elif not any(out for _, out, _ in self.open):
            self.text.append(data)


def _walk(value, path: str, exclude: frozenset[str]) -> Iterator[tuple[str, str | None, str]]:
    """(path, text, kind) of every scalar. Depth is bounded by memory, not by the call stack."""
    todo = [(path, value)]
    while todo:
        at, x = todo.pop()
        if isinstance(x, dict):
            todo += [(f"{at}.{k}", v) for k, v in x.items() if k not in exclude]
        elif isinstance(x, list):
            todo += [(f"{at}[{i}]", v) for i, v in enumerate(x)]
        elif x is None:
            yield at, None, "null"
        elif isinstance(x, bool):
            yield at, "true" if x else "false", "flag"
        else:
            yield at, str(x), "text" if isinstance(x, str) else "real" if isinstance(x, float) else "whole"


def page_of(html: str | None) -> dict | None:
    if html is None:
        return None
    page = _Page()
    page.feed(html)
    page.close()
    page.flush()
    headline = None
    for text in page.linked:
        try:
            scalars = dict((p, v) for p, v, _ in _walk(json.loads(text), "$", frozenset()))
        except ValueError:
            continue
        headline = headline or next((v for p, v in scalars.items() if p.rpartition(".")[2] == "headline"), None)
    return {"blocks": page.main or page.blocks, "headline": headline or page.meta.get("og:title"), "published": page.meta.get("article:published_time")}


_PAGE = T.StructType([T.StructField("blocks", T.ArrayType(T.StringType())), T.StructField("headline", T.StringType()), T.StructField("published", T.StringType())])


@F.pandas_udf(_PAGE)
def page_content(pages: pd.Series) -> pd.DataFrame:
    """STRUCT(blocks, headline, published) of a page: its main container, what JSON-LD or meta say of it. In Python: HTML needs a parser."""
    rows = [page_of(p) or {"blocks": None, "headline": None, "published": None} for p in pages]
    return pd.DataFrame(rows, columns=["blocks", "headline", "published"])


def json_scalars(df: DataFrame, body: str, keep: list[str], exclude: Sequence[str] = ()) -> DataFrame:
    """(keep..., path, value, kind): every scalar of a JSON text at any depth, but for what lies under excluded keys; broken texts have none."""
    left_out = frozenset(exclude)

    @F.pandas_udf("array<struct<path:string,value:string,kind:string>>")
    def walk(bodies: pd.Series) -> pd.Series:
        out = []
        for text in bodies:
            try:
                out.append([{"path": p, "value": v, "kind": k} for p, v, k in _walk(json.loads(text), "$", left_out)] if text else [])
            except ValueError:
                out.append([])
        return pd.Series(out)

    return df.select(*keep, F.inline(walk(F.col(body))))


def label_included(label: Column, include: str, exclude: str) -> Column:
    """Whether a label holds the one pattern and not the other, in any case; null counts as no."""
    return contains(label, include) & ~contains(label, exclude)


def dated_captions(df: DataFrame, caption: str, subject: str, page_day: Column, keep: list[str]) -> DataFrame:
    """(keep..., subject, day, agrees): captions with a subject (the pattern's group) and a date in words, and whether that is the page's day."""
    who, day = F.nullif(F.regexp_extract(caption, subject, 1), F.lit("")), spoken_date(F.col(caption))
    out = df.select(*keep, who.alias("subject"), day.alias("day"), F.coalesce(day == page_day, F.lit(False)).alias("agrees"))
    return out.filter("subject is not null and day is not null").withColumn("day", F.col("day").cast("string"))


def prop_rule(rule: Column) -> Column:
    """STRUCT(player, stat, threshold, comparator, rejected) of a contract's rule about one player's number.

    rejected: 'partial_game' for rules about a half or a quarter, 'no_rule' where none or several are stated.
    """
    part = contains(rule, r"\b(?:first|second|1st|2nd)\s+half\b|\bquarter\b")
    above = r"([\p{L}0-9.'’ -]+?)\s+(?:scores|records)\s+more\s+than\s+([0-9]+(?:\.[0-9]+)?)\s+(points)\b"
    reach = r"([\p{L}0-9.'’ -]+?)\s+records\s+([0-9]+(?:\.[0-9]+)?)\s+or\s+more\s+(passing\s+yards)\b"
    found = lambda p: F.regexp_count(rule, F.lit(p))
    one = found(above) + found(reach) == 1
    pick = lambda g: F.when(found(above) == 1, F.regexp_extract(rule, above, g)).otherwise(F.regexp_extract(rule, reach, g))
    rejected = F.when(part, "partial_game").when(~F.coalesce(one, F.lit(False)), "no_rule")
    kept = lambda c: F.when(rejected.isNull(), c)
    comparator = F.when(found(above) == 1, "more_than").otherwise("at_least")
    return F.struct(kept(F.trim(pick(1))).alias("player"), kept(F.regexp_replace(pick(3), r"\s+", " ")).alias("stat"), kept(pick(2).try_cast("double")).alias("threshold"), kept(comparator).alias("comparator"), rejected.alias("rejected"))
