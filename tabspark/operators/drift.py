"""Schemas that drift between files: every change of fields between the files of a feed, and one table over all of them.

Each JSON object becomes cells (field, JSON type, value). Per feed and file the fields are known with their types; only
fields that went or came need sketches. A sketch holds hashed elements with their counts: the values, and the values with
their row number; columns with more than ``sketch_size`` different elements keep those with the smallest hashes of either
side, so that both sides keep the same ones. Shared elements, the likeness of the names and the types weigh the edges
between the fields that went and came; a maximum-weight bipartite matching per file decides which of them are one attribute.
Renames are followed to give each attribute a lineage, on which type changes are judged.

A sketch of k elements errs on a shared part s by about sqrt(s * (1 - s) / k): under 0.8 % at 4,096; smaller columns are exact.

Defined results: a body that is no JSON object has no fields; a field that is only ever null has no type and can be
matched by its name alone; repeated rows count once per row number; ties of the matching go to the names in order; an
empty table has no changes. A name that comes back after it was removed counts as added and goes on with its old lineage.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tabspark.session import materialise


def json_cells(df: DataFrame, feed: str, file_no: str, row_no: str, body: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(feed_id, file_no, row_no, keep..., field, json_type, value): one row per key of each object; json_type null for a null."""
    spark = df.sparkSession
    parsed = df.select(F.col(feed).alias("feed_id"), F.col(file_no).alias("file_no"), F.col(row_no).alias("row_no"), *keep, F.try_parse_json(F.col(body)).alias("v"))
    parsed = parsed.filter(F.schema_of_variant("v").startswith("OBJECT"))
    cells = parsed.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    kind = F.schema_of_variant("value")
    json_type = F.when(kind == "VOID", None).when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").otherwise("number")
    text = F.when(kind == "VOID", None).otherwise(F.try_variant_get("value", "$", "string"))
    return cells.select("feed_id", "file_no", "row_no", *keep, F.col("key").alias("field"), json_type.alias("json_type"), text.alias("value"))


def field_presence(cells: DataFrame) -> DataFrame:
    """(feed_id, file_no, field, types, prev_no, next_no): the fields of each file with its neighbours in the feed."""
    fields = cells.groupBy("feed_id", "file_no", "field").agg(F.array_join(F.array_sort(F.collect_set("json_type")), "|").alias("types"))
    order = W.partitionBy("feed_id").orderBy("file_no")
    files = fields.select("feed_id", "file_no").distinct().select("feed_id", "file_no", F.lag("file_no").over(order).alias("prev_no"), F.lead("file_no").over(order).alias("next_no"))
    return fields.join(files, ["feed_id", "file_no"])


def _turnover(presence: DataFrame) -> DataFrame:
    """(feed_id, file_no, field, types, side, at_file): fields that came with file at_file ('came') or went with it ('went')."""
    now = presence.alias("a")
    before = presence.select("feed_id", F.col("file_no").alias("prev_no"), "field")
    after = presence.select("feed_id", F.col("file_no").alias("next_no"), "field")
    came = now.filter("prev_no is not null").join(before, ["feed_id", "prev_no", "field"], "left_anti").select("feed_id", "file_no", "field", "types", F.lit("came").alias("side"), F.col("file_no").alias("at_file"))
    went = now.filter("next_no is not null").join(after, ["feed_id", "next_no", "field"], "left_anti").select("feed_id", "file_no", "field", "types", F.lit("went").alias("side"), F.col("next_no").alias("at_file"))
    return came.unionByName(went)


def name_likeness(a: Column, b: Column) -> Column:
    """0 to 1: likeness of two field names without case and signs, as letters or as sets of words; 0 where their digits differ."""
    words = lambda x: F.array_sort(F.array_distinct(F.filter(F.split(F.lower(F.regexp_replace(x, "(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])", "_")), "[^a-z0-9]+"), lambda w: F.length(w) > 0)))
    plain, digits = (lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]", "")), (lambda x: F.regexp_replace(x, "[^0-9]", ""))
    letters = 1 - F.levenshtein(plain(a), plain(b)) / F.greatest(F.length(plain(a)), F.length(plain(b)), F.lit(1))
    shared = F.size(F.array_intersect(words(a), words(b))) / F.greatest(F.size(F.array_union(words(a), words(b))), F.lit(1))
    return F.when(digits(a) == digits(b), F.greatest(letters, shared)).otherwise(F.lit(0.0))


def column_sketches(cells: DataFrame, turnover: DataFrame, sketch_size: int) -> DataFrame:
    """(feed_id, at_file, side, field, kind, element, n, of): bottom-k sketches of the fields that went or came."""
    once = cells.join(turnover.drop("types"), ["feed_id", "file_no", "field"]).groupBy("feed_id", "at_file", "side", "field", "row_no").agg(F.min("value").alias("value"))
    text = F.lower(F.trim("value"))
    elements = F.array(
        F.when(F.col("value").isNotNull(), F.struct(F.lit("value").alias("kind"), F.xxhash64(text).alias("element"))),
        F.when(F.col("value").isNotNull(), F.struct(F.lit("row").alias("kind"), F.xxhash64(text, "row_no").alias("element"))),
    )
    counted = once.select("feed_id", "at_file", "side", "field", F.inline(F.filter(elements, lambda x: x.isNotNull()))).groupBy("feed_id", "at_file", "side", "field", "kind", "element").agg(F.count("*").alias("n"))
    smallest = W.partitionBy("feed_id", "at_file", "side", "field", "kind").orderBy("element")
    kept = counted.withColumn("k", F.row_number().over(smallest)).filter(F.col("k") <= sketch_size).drop("k")
    # two sketches compare up to the smaller of their largest hashes: 'upto' is that bound, open where a sketch is complete
    bound = kept.groupBy("feed_id", "at_file", "side", "field", "kind").agg(F.when(F.count("*") >= sketch_size, F.max("element")).alias("upto"))
    return kept.join(bound, ["feed_id", "at_file", "side", "field", "kind"])


def rename_candidates(sketches: DataFrame) -> DataFrame:
    """(feed_id, at_file, old_name, new_name, score): went and came fields that share elements, with the shared part of each sketch."""
    went, came = (sketches.filter(F.col("side") == s).select("feed_id", "at_file", "kind", "element", F.col("field").alias(a), F.col("n").alias(f"n_{a}"), F.col("upto").alias(f"upto_{a}")) for s, a in (("went", "old_name"), ("came", "new_name")))
    pair = ["feed_id", "at_file", "old_name", "new_name", "kind"]
    shared = went.join(came, ["feed_id", "at_file", "kind", "element"]).groupBy(*pair).agg(F.sum(F.least("n_old_name", "n_new_name")).alias("both"), F.min(F.least("upto_old_name", "upto_new_name")).alias("upto"))
    sizes = shared
    for side, table in (("old_name", went), ("new_name", came)):
        inside = F.col("upto").isNull() | (F.col("element") <= F.col("upto"))
        sums = shared.join(table, ["feed_id", "at_file", "kind", side]).filter(inside).groupBy(*pair).agg(F.sum(f"n_{side}").alias(f"size_{side}"))
        sizes = sizes.join(sums, pair)
    part = F.col("both") / F.least("size_old_name", "size_new_name")
    score = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, part)), F.lit(0.0))
    return sizes.groupBy("feed_id", "at_file", "old_name", "new_name").agg(score("value").alias("by_value"), score("row").alias("by_row"))


def edge_weights(turnover: DataFrame, candidates: DataFrame, name_alone: float = 0.75) -> DataFrame:
    """(feed_id, at_file, old_name, new_name, weight): every field that went with every one that came in the same file.

    The weight is what they share in values, above all row by row, raised by the likeness of their names and by one type.
    Where they share no value the name has to speak alone: it counts from ``name_alone`` on, less where the types differ.
    """
    went, came = (turnover.filter(F.col("side") == side).select("feed_id", "at_file", F.col("field").alias(name), F.col("types").alias(f"types_{name}")) for side, name in (("went", "old_name"), ("came", "new_name")))
    pairs = went.join(came, ["feed_id", "at_file"]).join(candidates, ["feed_id", "at_file", "old_name", "new_name"], "left")
    value, row, name = F.coalesce("by_value", F.lit(0.0)), F.coalesce("by_row", F.lit(0.0)), name_likeness(F.col("old_name"), F.col("new_name"))
    typed = F.when((F.col("types_old_name") == "") | (F.col("types_new_name") == ""), 0.5).when(F.col("types_old_name") == F.col("types_new_name"), 1.0).otherwise(0.0)
    held = F.greatest(row, 0.5 * (value + row)) + 0.05 * name + 0.02 * typed
    alone = F.when(name >= name_alone, name * (0.8 + 0.1 * typed)).otherwise(0.0)
    return pairs.select("feed_id", "at_file", "old_name", "new_name", F.when(F.greatest(value, row) > 0, held).otherwise(alone).alias("weight"))


def best_matching(weights: dict[tuple[str, str], float]) -> list[tuple[str, str]]:
    """Maximum-weight bipartite matching (shortest augmenting paths on the weights that are above zero)."""
    rows, cols = sorted({a for a, _ in weights}), sorted({b for _, b in weights})
    if not rows:
        return []
    size = max(len(rows), len(cols))
    cost = [[-max(0.0, weights.get((rows[i], cols[j]), 0.0)) if i < len(rows) and j < len(cols) else 0.0 for j in range(size)] for i in range(size)]
    inf = float("inf")
    row_price, col_price, owner = [0.0] * (size + 1), [0.0] * (size + 1), [0] * (size + 1)
    for i in range(1, size + 1):
        owner[0], at = i, 0
        least, via, done = [inf] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        while owner[at]:
            done[at] = True
            step, nxt = inf, 0
            for j in range(1, size + 1):
                if not done[j]:
                    slack = cost[owner[at] - 1][j - 1] - row_price[owner[at]] - col_price[j]
                    if slack < least[j]:
                        least[j], via[j] = slack, at
                    if least[j] < step:
                        step, nxt = least[j], j
            for j in range(size + 1):
                if done[j]:
                    row_price[owner[j]] += step
                    col_price[j] -= step
                else:
                    least[j] -= step
            at = nxt
        while at:
            owner[at], at = owner[via[at]], via[at]
    out = [(rows[owner[j] - 1], cols[j - 1]) for j in range(1, len(cols) + 1) if owner[j] and owner[j] <= len(rows)]
    return sorted(p for p in out if weights.get(p, 0.0) > 0)


def _match_file(pdf: pd.DataFrame) -> pd.DataFrame:
    """The renames of one file: as many rows as pairs of fields that went and came with it."""
    pairs = best_matching({(a, b): float(w) for a, b, w in zip(pdf["old_name"], pdf["new_name"], pdf["weight"], strict=True)})
    return pd.DataFrame([(pdf["feed_id"].iloc[0], pdf["at_file"].iloc[0], a, b) for a, b in pairs], columns=["feed_id", "at_file", "old_name", "new_name"])


def _segments(presence: DataFrame) -> DataFrame:
    """presence with ``node`` (a stretch of consecutive files that have a field), whether it starts and whether it ends here."""
    of = W.partitionBy("feed_id", "field").orderBy("file_no")
    rows = presence.withColumn("starts", ~F.coalesce(F.lag("file_no").over(of) == F.col("prev_no"), F.lit(False))).withColumn("ends", ~F.coalesce(F.lead("file_no").over(of) == F.col("next_no"), F.lit(False)))
    rows = rows.withColumn("part", F.sum(F.col("starts").cast("int")).over(of))
    return rows.withColumn("node", F.concat_ws("#", "field", "part"))


def _roots(parents: DataFrame) -> DataFrame:
    """(feed_id, node, attribute): the first node of each chain. parents: (feed_id, node, parent or null).

    Pointers are doubled until all point at a first node: as many rounds as the longest chain has binary digits.
    """
    now = materialise(parents.select("feed_id", "node", F.coalesce("parent", "node").alias("attribute")), "drift-chains")
    while True:
        up = now.select("feed_id", F.col("node").alias("attribute"), F.col("attribute").alias("above"))
        nxt = materialise(now.join(up, ["feed_id", "attribute"]).select("feed_id", "node", F.col("above").alias("attribute"), (F.col("above") != F.col("attribute")).alias("moved")), "drift-chains")
        if not nxt.filter("moved").head(1):
            return nxt.drop("moved")
        now = nxt.drop("moved")


def field_lineage(cells: DataFrame, sketch_size: int = 4096, min_score: float = 0.5) -> DataFrame:
    """(feed_id, file_no, change_kind, old_name, new_name, attribute): changes (renamed, added, removed, retyped) and, under 'field', the attribute of each field in each file.

    Files are matched one by one, each with the one before; stretches of a field, renames and comings back then form chains,
    and a chain is an attribute. No task sees a whole feed.
    """
    cells = materialise(cells, "drift-cells")  # objects are parsed once
    presence = materialise(field_presence(cells), "drift-presence")
    turnover = materialise(_turnover(presence), "drift-turnover")
    candidates = rename_candidates(materialise(column_sketches(cells, turnover, sketch_size), "drift-sketches"))
    weights = edge_weights(turnover, candidates).filter(F.col("weight") >= min_score)
    at_type = presence.schema["file_no"].dataType.simpleString()
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows, but each file's matching takes its time
    renames = materialise(weights.repartition(tasks, "feed_id", "at_file").groupBy("feed_id", "at_file").applyInPandas(_match_file, f"feed_id string, at_file {at_type}, old_name string, new_name string"), "drift-renames")
    rows = materialise(_segments(presence), "drift-segments")
    into = renames.select("feed_id", F.col("at_file").alias("file_no"), F.col("new_name").alias("field"), "old_name")
    out_of = renames.select("feed_id", F.col("at_file").alias("next_no"), F.col("old_name").alias("field"), "new_name")
    starts = rows.filter("starts").join(into, ["feed_id", "file_no", "field"], "left")
    began = starts.select("feed_id", "field", "part", "node", "file_no", "old_name", F.when(F.col("prev_no").isNull(), "initial").when(F.col("old_name").isNotNull(), "renamed").otherwise("added").alias("began"))
    ends = rows.filter("ends").join(out_of, ["feed_id", "next_no", "field"], "left")
    ended = ends.select("feed_id", "field", "part", "next_no", F.when(F.col("next_no").isNull(), "last").when(F.col("new_name").isNotNull(), "renamed").otherwise("removed").alias("ended"))
    spans = materialise(began.join(ended, ["feed_id", "field", "part"]), "drift-spans")
    # a name that comes back goes on from its last removed stretch, if none came back from that before
    earlier = W.partitionBy("feed_id", "field").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    last_removed, last_added = F.max(F.when(F.col("ended") == "removed", F.col("part"))).over(earlier), F.max(F.when(F.col("began") == "added", F.col("part"))).over(earlier)
    back = F.when((F.col("began") == "added") & (last_removed >= F.coalesce(last_added, F.lit(0))), F.concat_ws("#", "field", last_removed))
    sources = spans.filter("ended = 'renamed'").select("feed_id", F.col("next_no").alias("file_no"), F.col("field").alias("old_name"), F.col("node").alias("source"))
    parents = spans.withColumn("back", back).join(sources, ["feed_id", "file_no", "old_name"], "left").select("feed_id", "node", F.coalesce("source", "back").alias("parent"))
    known = rows.join(_roots(parents), ["feed_id", "node"]).withColumn("kinds", F.nullif(F.col("types"), F.lit("")))
    known = known.withColumn("before", F.last("kinds", ignorenulls=True).over(W.partitionBy("feed_id", "attribute").orderBy("file_no").rowsBetween(W.unboundedPreceding, -1)))
    known = materialise(known.select("feed_id", "file_no", "field", "node", "attribute", "kinds", "before", "starts", "ends", "next_no"), "drift-known")
    row = lambda df, at, kind, old, new: df.select("feed_id", F.col(at).cast("long").alias("file_no"), F.lit(kind).alias("change_kind"), old.alias("old_name"), new.alias("new_name"), "attribute")
    attributes = known.filter("starts").select("feed_id", "node", "attribute")
    spans = spans.join(attributes, ["feed_id", "node"])
    field, none = F.col("field"), F.lit("")
    parts = [
        row(known, "file_no", "field", field, field),
        row(known.filter("kinds <> before"), "file_no", "retyped", field, field),
        row(spans.filter("began = 'renamed'"), "file_no", "renamed", F.col("old_name"), field),
        row(spans.filter("began = 'added'"), "file_no", "added", none, field),
        row(spans.filter("ended = 'removed'"), "next_no", "removed", field, none),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def schema_changes(lineage: DataFrame) -> DataFrame:
    return lineage.filter("change_kind <> 'field'").select("feed_id", "file_no", "change_kind", "old_name", "new_name").distinct()


def _name_groups(pdf: pd.DataFrame) -> pd.DataFrame:
    """Names of one kind of feed joined by their renames, in any direction and however few; the most used name stands for all.

    Two groups stay apart only if more feeds have names of both side by side in a file than renamed one to the other.
    """
    count: dict[str, dict[tuple[str, str], int]] = {"field": {}, "renamed": {}, "together": {}}
    for what, old, new, n in zip(pdf["what"], pdf["old_name"], pdf["new_name"], pdf["n"], strict=True):
        pair = (min(old, new), max(old, new))
        count[what][pair] = count[what].get(pair, 0) + n
    uses = {x: n for (x, _), n in count["field"].items()}
    group = {x: {x} for x in uses}
    joined = True
    while joined:
        joined = False
        for (a, b), _ in sorted(count["renamed"].items(), key=lambda p: (-p[1], p[0])):
            one, two = group[a], group[b]
            if one is not two:
                seen = {w: sum(count[w].get((min(x, y), max(x, y)), 0) for x in one for y in two) for w in ("renamed", "together")}
                if seen["together"] <= seen["renamed"]:
                    one |= two
                    group |= dict.fromkeys(two, one)
                    joined = True
    rows = [(pdf["feed_kind"].iloc[0], x, max(sorted(group[x]), key=lambda y: uses[y])) for x in sorted(uses)]
    return pd.DataFrame(rows, columns=["feed_kind", "field", "canonical"])


def _feed_names(stats: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """Each attribute of a feed under the name that stands for most of its files; attributes of one file never share a name.

    stats has a row per attribute, field and wanted name with its number of files, sets the different sets of attributes that a file has.
    """
    names = ["feed_kind", "feed_id", "attribute", "canonical"]
    if stats.empty:
        return pd.DataFrame([], columns=names)
    beside: dict[str, set[str]] = {}
    for attributes in sets["attributes"]:
        for k in attributes:
            beside.setdefault(k, set()).update(attributes)
    ranked = lambda c: {k: sorted(v.groupby(c)["n"].sum().items(), key=lambda x: (-x[1], x[0])) for k, v in stats.groupby("attribute")}
    wanted, own, files = ranked("canonical"), ranked("field"), stats.groupby("attribute")["n"].sum().to_dict()
    name: dict[str, str] = {}
    for k in sorted(files, key=lambda k: (wanted[k][0][0] not in dict(own[k]), -files[k], k)):
        taken = {name[x] for x in beside.get(k, set()) if x in name}
        name[k] = next((x for x in (wanted[k][0][0], *[x for x, _ in own[k]]) if x not in taken), f"{own[k][0][0]} {k}")
    return pd.DataFrame([(stats["feed_kind"].iloc[0], stats["feed_id"].iloc[0], k, v) for k, v in name.items()], columns=names)


def canonical_names(lineage: DataFrame, kind: Column) -> DataFrame:
    """(feed_kind, feed_id, file_no, field, canonical): one name for each attribute of a kind of feed.

    Within a feed the lineage decides. Across feeds names meet by counts of feeds, one row per pair of names; a feed's own
    part sees one row per attribute and name, and each different set of attributes once, however many files there are.
    """
    tagged = materialise(lineage.filter("change_kind in ('field', 'renamed')").withColumn("feed_kind", kind), "drift-lineage")
    fields, feeds = tagged.filter("change_kind = 'field'").select("feed_kind", "feed_id", "file_no", F.col("new_name").alias("field"), "attribute"), F.countDistinct("feed_id").alias("n")
    pair = ["feed_kind", "old_name", "new_name"]
    files = fields.groupBy("feed_kind", "feed_id", "file_no").agg(F.array_sort(F.collect_set("field")).alias("fields"), F.array_sort(F.collect_set("attribute")).alias("attributes"))
    sets = materialise(files.select("feed_kind", "feed_id", "fields", "attributes").distinct(), "drift-sets")  # one per change of a feed's fields
    together = sets.select("feed_kind", "feed_id", "fields", F.explode("fields").alias("old_name")).select("feed_kind", "feed_id", "old_name", F.explode("fields").alias("new_name")).filter("old_name < new_name").groupBy(*pair).agg(feeds)
    renamed = tagged.filter("change_kind = 'renamed'").groupBy(*pair).agg(feeds)
    used = fields.groupBy("feed_kind", F.col("field").alias("old_name"), F.col("field").alias("new_name")).agg(F.count("*").alias("n"))
    counts = used.withColumn("what", F.lit("field")).unionByName(renamed.withColumn("what", F.lit("renamed"))).unionByName(together.withColumn("what", F.lit("together")))
    groups = counts.groupBy("feed_kind").applyInPandas(_name_groups, "feed_kind string, field string, canonical string")
    stats = fields.groupBy("feed_kind", "feed_id", "attribute", "field").agg(F.count("*").alias("n")).join(groups, ["feed_kind", "field"])
    named = stats.groupBy("feed_kind", "feed_id").cogroup(sets.select("feed_kind", "feed_id", "attributes").groupBy("feed_kind", "feed_id")).applyInPandas(_feed_names, "feed_kind string, feed_id string, attribute string, canonical string")
    return fields.join(named, ["feed_kind", "feed_id", "attribute"]).select("feed_kind", "feed_id", "file_no", "field", "canonical")


def unified(cells: DataFrame, names: DataFrame, kind: Column, id_cols: list[str]) -> DataFrame:
    """(feed_kind, id_cols..., attribute, value, json_type): all records of all files under one set of names."""
    tagged = cells.withColumn("feed_kind", kind)
    return tagged.join(names, ["feed_kind", "feed_id", "file_no", "field"]).select("feed_kind", *id_cols, F.col("canonical").alias("attribute"), "value", "json_type")


def consistent_table(long: DataFrame, feed_kind: str, id_cols: list[str]) -> DataFrame:
    """One row per record of a kind of feed, one typed column per attribute, in the order of their names.

    The types of an attribute are reconciled over all its files: DOUBLE if every value reads as a number, BOOLEAN if every
    value reads as one, else STRING. Attributes are a few per kind of feed, so their list is read by the driver.
    """
    rows = long.filter(F.col("feed_kind") == feed_kind)
    fits = rows.filter("value is not null").groupBy("attribute").agg(F.bool_and(F.expr("try_cast(value as double) is not null")).alias("number"), F.bool_and(F.expr("lower(trim(value)) in ('true', 'false')")).alias("flag"))
    known = {r["attribute"]: "double" if r["number"] else "boolean" if r["flag"] else "string" for r in fits.collect()}
    names = sorted(r[0] for r in rows.select("attribute").distinct().collect())
    wide = rows.groupBy(*id_cols).pivot("attribute", names).agg(F.first("value", ignorenulls=True))
    return wide.select(*id_cols, *[F.trim(F.col(f"`{c}`")).try_cast(known.get(c, "string")).alias(c) if known.get(c, "string") != "string" else F.col(f"`{c}`") for c in names])
