"""Personal information in free text: found by what the corpus discloses, and replaced by placeholders of its type.

Candidates are terms with what stands beside them: every run of capitalised words, every piece with the form of an e-mail
address, a phone or identity number or a street address, and bare numbers. Some candidates are protected entities for
certain (names with initials, forms that nothing else has). From them the corpus says how often each context holds a protected
entity, from the contexts how strongly each other term reveals one, and so on for a few rounds.

A term's disclosure is its pointwise mutual information with the protected entity, in bits. The entity itself has
-log2(base) bits of information, where base is the share of protected entities among all candidates of the kind; a term
is removed if it leaves at most ``doubt`` bits of that open, and generalised if it leaves at most ``wide_doubt``. Removing puts
the type in its place ([NAME], [EMAIL], ...), generalising says only of what kind the term was ([WORD], [NUMBER]). Terms that
stand before whole names ('Inhaber Bo Li') are lead-ins, not names.

All counts are over the whole corpus and stay distributed; nothing of the vocabulary is sent to the driver or to all tasks.

Defined results: null and empty texts have no findings; overlapping forms go to the first of address, email, id_number,
phone; the same surface twice in a text is one finding; a document is a row, so documents without an id and different texts
under one id each have their own findings; an empty table gives none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabspark.llm.partitions import spread
from tabspark.session import materialise

_UPPER = "A-Z" + "".join(chr(c) for c in range(0xC0, 0x250) if chr(c).isupper())
_WORD = rf"[{_UPPER}]\w+(?:['’-]\w+)*"
_TOWN = rf"[{_UPPER}][\w'’-]+(?:[ ][{_UPPER}][\w'’-]+)?"

# Words that make a street, a unit or a title.
STREETS = r"Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Court|Ct|Crescent|Cres|Terrace|Way|Drive|Close|Place|Pl|Square|Sq|Boulevard|Blvd|Gardens|Row|Walk|Mews|Grove"
UNITS = r"Flat|Apartment|Apt|Unit|Suite|Ste|Room"
TITLES = "dr mr mrs ms miss prof sr sra herr frau mme mlle monsieur madame señor señora don doña sir".split()

_ADDRESS = "|".join(
    [
        # English: [unit,] number name street[, unit][, town [postcode]]
        rf"(?:(?:{UNITS})\.? \w+, )?\b\d{{1,5}}[A-Za-z]? (?:[{_UPPER}][\w'’-]+ ){{1,3}}(?:(?:Street|Avenue|Road|Lane|Court|Crescent|Terrace|Way|Drive|Close|Place|Square|Boulevard|Gardens|Row|Walk|Mews|Grove)\b|(?:{STREETS})\b\.?)(?:, (?:{UNITS})\.? ?\w+)?(?:, {_TOWN}(?: \d{{4,6}}\b)?)?",
        # Spanish: street number[, floor][, [postcode] town]
        rf"\b(?:Calle|Avenida|Avda\.?|Plaza|Paseo|Camino|Ronda|C/) (?:de (?:la |las |los |el )?|del )?[{_UPPER}][\w'’-]+(?: [{_UPPER}][\w'’-]+)?,? \d{{1,4}}(?:, (?:piso \d+|\d+ ?[ºª°] ?\w?|bajo))?(?:, (?:\d{{5}} )?{_TOWN})?",
        # French: number [bis,] street[, postcode town]
        rf"\b\d{{1,4}}(?: (?:bis|ter))?,? (?:rue|avenue|boulevard|place|chemin|allée|impasse|quai|cours|route) (?:de (?:la |l['’])?|du |des |d['’])?[{_UPPER}][\w'’-]+(?: [{_UPPER}][\w'’-]+)?(?:, (?:apt|bât|étage)\.? ?\w+)?(?:, \d{{5}} {_TOWN})?",
        # German: street number, postcode town
        rf"\b(?:[{_UPPER}][\w'’-]+ ){{0,3}}[{_UPPER}][\w'’-]+ \d{{1,4}}[a-z]?, \d{{5}} {_TOWN}",
    ]
)
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_AT, _DOT = r"(?:@| ?[\[({<] ?at ?[\])}>] ?)", r"(?:\.| ?[\[({<] ?dot ?[\])}>] ?)"
_EMAIL = rf"[A-Za-z0-9_%+-]+(?:{_DOT}[A-Za-z0-9_%+-]+)*{_AT}{_LABEL}(?:{_DOT}{_LABEL})+"
_ID = "|".join(
    [
        r"\b\d{3}-\d{2}-\d{4}\b(?!-)",
        r"\b\d{3} \d{2} \d{4}\b",
        r"\b\d{3}-\d{3}-\d{3}\b(?!-)",
        r"\b[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]\b",
        r"\b[A-Z]<\d{7,9}",
        r"\b[XYZ]-?\d{7}-?[A-Z]\b",
        r"\b\d{8}-?[A-Z]\b",
    ]
)
_PHONE = "|".join(
    [
        r"\+\d{9,15}\b",
        r"\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){1,4}[ .-]\d{2,4}\b",
        r"\(\d{3}\) ?\d{3}[ .-]\d{4}\b",
        r"\b\d{3}([ .-])\d{3}\1\d{4}\b",
        r"\b0\d{2,4}[ -]\d{3,4}[ -]?\d{3,4}\b",
        r"\b1\d{10}\b",
    ]
)
_GUARD = r"(?<![\w@.+/-])"
#: (kind, whether the form alone is certain, form, what a text must have for it: cheap to look for)
FORMS = [
    ("address", True, _ADDRESS, r"\d[A-Za-z]? [A-ZÀ-Þ][\w'’-]+ |(?:Calle|Avenida|Avda|Plaza|Paseo|Camino|Ronda|C/) |\d (?:bis |ter )?(?:rue|avenue|boulevard|place|chemin|allée|impasse|quai|cours|route) |\d, (?:rue|avenue|boulevard|place|chemin|allée|impasse|quai|cours|route) |, \d{5} "),
    ("email", True, _EMAIL, r"@|[\[({<] ?at ?[\])}>]"),
    ("id_number", True, _ID, r"\d\d[ -]?\d\d|<\d|[A-Z]-?\d{7}"),
    ("phone", True, _PHONE, r"\d\d[ .)-]{0,2}\d\d"),
    ("id_number", False, r"\d{9}\b", r"\d{9}"),
]
FORMS = [(kind, sure, re.compile(f"{_GUARD}(?:{p})"), re.compile(need)) for kind, sure, p, need in FORMS]
_INITIALS = rf"(?:[{_UPPER}]\.[ \t]?)+"
_RUN = re.compile(rf"(?<![\w@#_./-])(?:{_INITIALS}[ \t]*)?{_WORD}(?:[ \t]+(?:{_INITIALS}[ \t]*)?{_WORD})*")
_INVERTED = re.compile(rf"(?<![\w@#_./-])((?:[{_UPPER}]{{2,}})(?:[-'’][{_UPPER}]{{2,}})*), ({_WORD})(?=\W)")
_PARTS = re.compile(rf"[{_UPPER}]\.|{_WORD}")
_AFTER = re.compile(r"[ \t]*(['’]s\b|[^\W\d]+|\d|[^\w\s]|\n|\Z)[ \t]*([^\W\d]+|\d|[^\w\s]|\n|\Z)?")
_LOWER = re.compile(r"(?<!\w)[a-zß-öø-ÿ]\w+")
_TITLES = frozenset(TITLES)

_BEFORE = re.compile(r"([^\W\d_]+)\W{0,4}\Z")
SCAN_SCHEMA = "row long, doc_id long, kind string, sure boolean, start int, end int, surface string, parts string, left string, right string"
_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("kind", pa.string()), ("sure", pa.bool_()), ("start", pa.int32()), ("end", pa.int32()), ("surface", pa.string()), ("parts", pa.string()), ("left", pa.string()), ("right", pa.string())])
_SEPARATOR = "\x1f"


def mask_forms(text: str) -> tuple[list[tuple[str, bool, int, int]], str]:
    """(kind, sure, start, end) of what has a form, and the text with those spans blotted out. One copy of the text per kind that occurs."""
    spans: list[tuple[str, bool, int, int]] = []
    for kind, sure, pattern, need in FORMS:
        if not need.search(text):
            continue
        found = [m.span() for m in pattern.finditer(text)]
        if found:
            pieces, at = [], 0
            for a, b in found:
                spans.append((kind, sure, a, b))
                pieces += (text[at:a], "\ue000" * (b - a))
                at = b
            text = "".join(pieces) + text[at:]
    return spans, text


def _context(text: str, start: int, end: int) -> tuple[str, str]:
    i = start
    while i and text[i - 1] in " \t":
        i -= 1
    left = "^"
    if i:
        last = text[i - 1]
        j = k = i - (last == ".")
        while k and text[k - 1].isalpha():
            k -= 1
        word = text[k:j].lower()
        if word in _TITLES:
            left = "TITLE"
        elif last not in ".!?\n":
            left = word or ("#" if last.isdigit() else last)
    m = _AFTER.match(text, end)
    return left, " ".join(_token_class(x) for x in m.groups()) if m else "?"


def _token_class(token: str | None) -> str:
    if not token:
        return "$"
    return "#" if token.isdigit() else "C" if token[0].isupper() else token


def capital_runs(text: str) -> Iterator[tuple[int, int, list[str], str, str]]:
    """(start, end, words, left, right) of each run of capitalised words, without titles before it and the ending of a possessive."""
    taken = [m.span() for m in _INVERTED.finditer(text)] if ", " in text else []
    for start, end in taken:
        last, _, first = text[start:end].partition(", ")
        yield start, end, [last, first], *_context(text, start, end)
    for m in _RUN.finditer(text):
        start, end = m.span()
        if taken and any(a < end and start < b for a, b in taken):
            continue
        run = m[0]
        words = _PARTS.findall(run) if "." in run else run.split()
        while len(words) > 1 and words[0].rstrip(".").lower() in _TITLES:
            start = text.index(words[1], start + len(words[0]))
            words.pop(0)
        key = words[-1]
        if key.endswith(("'s", "’s")):
            words[-1], end = key[:-2], end - 2
        elif key[-1] in "'’":
            words[-1], end = key[:-1], end - 1
        yield start, end, words, *_context(text, start, end)


def scan(docs: DataFrame) -> DataFrame:
    """The candidates of each text, SCAN_SCHEMA: pieces with a form, capitalised runs (kind 'run', their words in parts) with
    their context, and how often each word is written in lower case (kind 'lower', the count under start). docs: (row, doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in _ARROW]
        row, doc, kind, sure, start, end, surface, parts, lefts, rights = (c.append for c in columns)

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)
            for c in columns:
                c.clear()
            return out

        for batch in batches:
            lower: Counter = Counter()
            size = 0
            for r, d, body in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                if not body:
                    continue
                spans, masked = mask_forms(body)
                for k, certain, a, b in spans:
                    before = _BEFORE.search(body, max(0, a - 24), a)
                    row(r), doc(d), kind(k), sure(certain), start(a), end(b), surface(body[a:b]), parts(None), lefts(before[1].lower() if before else "^"), rights(None)
                for a, b, words, left, right in capital_runs(masked):
                    row(r), doc(d), kind("run"), sure(None), start(a), end(b), surface(masked[a:b]), parts(_SEPARATOR.join(words)), lefts(left), rights(right)
                lower.update(_LOWER.findall(masked))
                size += len(body)
                if size > 2_000_000:  # a batch out holds the findings of about so much text
                    yield flush()
                    size = 0
            for word, n in lower.items():
                row(None), doc(None), kind("lower"), sure(None), start(n), end(None), surface(word), parts(None), lefts(None), rights(None)
            yield flush()

    return docs.select("row", "doc_id", "text").mapInArrow(run, SCAN_SCHEMA)


def with_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, doc_id, text): a number of its own for every document. It holds only where what is made from it is written at once."""
    return spread(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))).withColumn("row", F.monotonically_increasing_id())


def term_contexts(spans: DataFrame) -> DataFrame:
    """(term, left, right, n, n_initial, n_lead, n_front): the corpus counts. Equal runs in equal contexts are counted before they are taken apart."""
    runs = spans.filter("kind = 'run'").groupBy("parts", "left", "right").agg(F.count("*").alias("n"))
    words = F.split("parts", _SEPARATOR)
    initial = lambda w: (F.length(w) == 2) & w.endswith(".")
    runs = runs.select("left", "right", "n", words.alias("words"), F.exists(words, initial).alias("has_initial"))
    each = runs.select("left", "right", "n", "has_initial", "words", F.posexplode("words").alias("i", "word")).filter(~initial(F.col("word")))
    follow = F.size(F.filter(F.slice("words", F.col("i") + 2, F.size("words")), lambda w: ~initial(w)))
    counted = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.withColumn("follow", follow).groupBy(F.lower("word").alias("term"), "left", "right").agg(
        F.sum("n").alias("n"), counted(F.col("has_initial")).alias("n_initial"), counted(F.col("follow") >= 2).alias("n_lead"), counted(F.col("follow") >= 1).alias("n_front")
    )


def disclosure(contexts: DataFrame, lower: DataFrame, rounds: int = 4, damping: float = 3.0) -> DataFrame:
    """(term, n, score, bits, entity_bits, lead_share): how strongly each term reveals a person.

    score is the mean probability of a person over the term's occurrences, bits its pointwise mutual information with
    'person', entity_bits what there is to learn. Context probabilities are those of the pair of neighbours, backed by those
    of each neighbour alone.
    """
    totals = contexts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_initial").alias("n_initial"), (F.sum("n_lead") / F.greatest(F.sum("n_front"), F.lit(1))).alias("lead_share"))
    # words that are mostly written in lower case are words, however they stand at the start of a sentence
    about = materialise(totals.join(lower, "term", "left").withColumn("as_name", F.col("n") / (F.col("n") + F.coalesce("n_lower", F.lit(0)))), "disclosure-terms")
    scores = about.select("term", F.when(F.col("n_initial") > 0, F.col("as_name")).otherwise(0.0).alias("p"))
    for i in range(rounds):
        marked = contexts.join(scores, "term")
        base = marked.agg(F.greatest(F.sum(F.col("n") * F.col("p")) / F.sum("n"), F.lit(1e-9)).alias("base"))

        def share(names: list[str], out: str, marked: DataFrame = marked) -> DataFrame:
            return marked.groupBy(*names).agg(F.sum("n").alias(f"n_{out}"), (F.sum(F.col("n") * F.col("p")) / F.sum("n")).alias(out))

        alone = F.greatest("q_left", "q_right") * 0.5 + F.least("q_left", "q_right") * 0.5
        joined = contexts.join(share(["left", "right"], "q"), ["left", "right"]).join(share(["left"], "q_left"), "left").join(share(["right"], "q_right"), "right")
        q = (F.col("n_q") * F.col("q") + damping * alone) / (F.col("n_q") + damping)
        found = joined.groupBy("term").agg((F.sum(F.col("n") * q) / F.sum("n")).alias("in_context")).join(about, "term").withColumn("score", F.col("in_context") * F.col("as_name"))
        if i < rounds - 1:
            scores = materialise(found.select("term", F.when(F.col("score") >= 0.5, 1.0).otherwise(F.col("score") * 0.5).alias("p")), "disclosure")
    return found.crossJoin(F.broadcast(base)).select("term", "n", "score", F.log2(F.col("score") / F.col("base")).alias("bits"), (-F.log2("base")).alias("entity_bits"), "lead_share")  # base is one row


def form_disclosure(spans: DataFrame, rounds: int = 6, damping: float = 1.0) -> DataFrame:
    """(kind, sure, left, score, bits, entity_bits): how strongly a piece with the form of a kind reveals one after this word.

    Forms that are certain are the protected entities; a form that isn't (a bare number) is one as far as the word before it
    stands before protected entities of the kind. Each round counts what the last one found likely.
    """
    counts = materialise(spans.filter("kind not in ('run', 'lower')").groupBy("kind", "sure", "left").agg(F.count("*").alias("n")), "form-contexts")
    per = counts.groupBy("kind", "left").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("sure"), F.col("n")).otherwise(0)).alias("certain"))
    q = F.lit(0.0)
    for _ in range(rounds):  # the uncertain ones count with the probability of the round before
        q = (F.col("certain") + (F.col("n") - F.col("certain")) * q) / (F.col("n") + damping)
    shares = per.select("kind", "left", "n", q.alias("q"))
    scored = counts.join(shares.drop("n"), ["kind", "left"]).withColumn("score", F.when(F.col("sure"), 1.0).otherwise(F.col("q")))
    base = scored.groupBy("kind").agg((F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("share"), F.sum("n").alias("of_kind"))
    # the share of the kind among all pieces of text that have any form
    total = F.sum("of_kind").over(W.partitionBy(F.lit(1)))  # one row per kind
    base = base.withColumn("base", F.greatest(F.col("share") * F.col("of_kind") / total, F.lit(1e-9)))
    return scored.join(base.select("kind", "base"), "kind").select("kind", "sure", "left", "score", F.log2(F.col("score") / F.col("base")).alias("bits"), (-F.log2("base")).alias("entity_bits"))


def _action(doubt: float, wide_doubt: float) -> Column:
    """'remove', 'generalise' or null, by how many of the entity's bits a term leaves open."""
    left_open = F.col("entity_bits") - F.col("bits")
    return F.when(left_open <= doubt, "remove").when(left_open <= wide_doubt, "generalise")


def names(spans: DataFrame, terms: DataFrame, doubt: float = 1.0, wide_doubt: float = 1.0, lead_limit: float = 0.3, salts: int = 16) -> DataFrame:
    """(row, doc_id, kind, start, end, surface): the names and, of kind 'word', generalised terms.

    Which words of a run are names is settled once per different run; the occurrences meet it salted, so that a name in a
    third of all texts is many groups.
    """
    lexicon = terms.filter(F.col("lead_share") < lead_limit).select("term", _action(doubt, wide_doubt).alias("action")).filter("action is not null")
    runs = spans.filter("kind = 'run'")
    each = runs.select("parts").distinct().select("parts", F.posexplode(F.split("parts", _SEPARATOR)).alias("i", "word"))
    is_initial = (F.length("word") == 2) & F.col("word").endswith(".")
    known = each.withColumn("term", F.lower("word")).join(lexicon, "term", "left")
    level = F.when(is_initial, "initial").otherwise(F.coalesce("action", F.lit("keep")))
    levels = known.groupBy("parts").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", level.alias("level")))), lambda x: x["level"]).alias("levels"))
    # stretches of words at one level; initials go with a name beside them
    text = F.concat_ws("", F.transform("levels", lambda v: F.when(v == "remove", "r").when(v == "initial", "i").when(v == "generalise", "g").otherwise("k")))
    settled = levels.filter(F.exists("levels", lambda v: v.isin("remove", "generalise"))).select("parts", text.alias("code"))
    salted = settled.select("parts", "code", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    met = runs.select("row", "doc_id", "start", "surface", "parts", F.pmod(F.hash("row", "start"), F.lit(salts)).alias("salt")).join(salted, ["parts", "salt"])
    words = F.split("parts", _SEPARATOR)
    places = F.expr(
        "aggregate(words, named_struct('pos', 1, 'at', cast(array() as array<int>)), (acc, w) -> named_struct('pos', locate(w, surface, acc.pos) + char_length(w), 'at', concat(acc.at, array(locate(w, surface, acc.pos))))).at"
    )
    met = met.withColumn("words", words).withColumn("at", places)
    # (kind, first word, last word) of each stretch, from the code of the run
    cut = F.expr("filter(transform(sequence(1, length(code)), i -> named_struct('first', i, 'code', regexp_extract(substring(code, i), '^(?:[ri]*r[ri]*|g+)', 0), 'opens', i = 1 or not regexp_like(substring(code, i - 1, 2), '^(?:[ri][ri]|gg)$'))), x -> x.opens and length(x.code) > 0)")
    out = met.withColumn("s", F.explode(cut)).withColumn("last", F.col("s.first") + F.length("s.code") - 1)
    first_at, last_at = F.expr("at[s.first - 1]"), F.expr("at[last - 1]")
    end_at = last_at + F.expr("char_length(words[last - 1])")
    kind = F.when(F.col("s.code").startswith("g"), "word").otherwise("name")
    return out.select("row", "doc_id", kind.alias("kind"), (F.col("start") + first_at - 1).cast("int").alias("start"), (F.col("start") + end_at - 1).cast("int").alias("end"), F.col("surface").substr(first_at, end_at - first_at).alias("surface"))


def find(numbered: DataFrame, doubt: float = 1.0, wide_doubt: float = 1.0) -> DataFrame:
    """(row, doc_id, kind, start, end, surface) of all personal information, by character position. numbered: result of with_rows.

    With wide_doubt above doubt, terms between the two are there as 'word' and 'number'.
    """
    spans = materialise(scan(numbered), "pii-spans")
    contexts = materialise(term_contexts(spans), "pii-contexts")
    lower = spans.filter("kind = 'lower'").groupBy(F.col("surface").alias("term")).agg(F.sum("start").alias("n_lower"))
    terms = materialise(disclosure(contexts, lower), "pii-terms")
    forms = form_disclosure(spans).select("kind", "sure", "left", _action(doubt, wide_doubt).alias("action")).filter("action is not null")
    # certain forms need no context: only the others meet their words
    certain = spans.filter("sure").join(F.broadcast(forms.filter("sure").select("kind", "action").distinct()), "kind")  # a row per kind
    open_ones = spans.filter("not sure").join(forms.filter("not sure").select("kind", "left", "action"), ["kind", "left"])
    columns = ["row", "doc_id", F.when(F.col("action") == "remove", F.col("kind")).otherwise("number").alias("kind"), "start", "end", "surface"]
    return certain.select(*columns).unionByName(open_ones.select(*columns)).unionByName(names(spans, terms, doubt, wide_doubt))


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, kind, start, end, surface): see find. The row is a document's number within this result."""
    return find(with_rows(docs, key, text))


def surfaces(found: DataFrame) -> DataFrame:
    """(doc_id, pii_type, surface): each different piece of a text, as written."""
    return found.filter("kind not in ('word', 'number')").select("doc_id", F.col("kind").alias("pii_type"), "surface").distinct()


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", doubt: float = 1.0, wide_doubt: float = 1.0) -> DataFrame:
    """docs with the text's personal information replaced by placeholders of its type; all other text stays as it is."""

    @F.pandas_udf("string")
    def replace(bodies: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for body, marks in zip(bodies, spans, strict=True):
            if body and marks is not None:
                pieces, at = [], 0
                for m in sorted(marks, key=lambda s: (s["start"], -s["end"])):
                    if m["start"] >= at:
                        pieces += [body[at : m["start"]], f"[{m['kind'].upper()}]"]
                        at = m["end"]
                body = "".join(pieces) + body[at:]
            out.append(body)
        return pd.Series(out, dtype="object")

    numbered = materialise(spread(docs).withColumn("__row", F.monotonically_increasing_id()), "pii-documents")
    found = find(numbered.select(F.col("__row").alias("row"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), doubt, wide_doubt)
    packed = found.groupBy(F.col("row").alias("__row")).agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("__spans"))
    return numbered.join(packed, "__row", "left").withColumn(text, replace(F.col(text), F.col("__spans"))).drop("__spans", "__row")
