"""Mixing sources to target weights on a low-discrepancy schedule of equal-token blocks.

The scarcest source with its permitted repeats sets the size of the mix, and so the tokens that each source has to give. A
source gives whole passes over its documents and a part of one more: its documents in the order of a seeded hash as long as
they fit, then, while a gap of any weight is left, the longest of the others that fits into it. A text longer than the part
is not drawn for it, so one long text can't push a source beyond its share.

What a source gives is cut into blocks of equal tokens by its running sum; a document belongs to the block in which it
starts, so a long text fills as many slots of the schedule as it is long. Slot i of the schedule takes the source into whose
part of the cumulative weights the van der Corput point of i falls, and its rank among the slots of that source says which
block it uses.

Defined results: targets of sources without tokens can't be met; their share goes to the others in proportion, and the
report lists them with actual share 0; documents of sources without a target (null too) are left out and reported with
target 0; a null or zero target or repeat count counts as 0; documents without tokens are left out; equal hashes are
ordered by id; empty tables give an empty mix. A share that the lengths of a source's documents can't add up to is missed
by the smallest gap found.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabspark.llm.ranks import ranked, shard_count
from tabspark.session import materialise

_BITS = 52  # a point is exact in a double


@dataclass(frozen=True)
class Source:
    name: str
    share: float  # of the mix, after the shares of sources without documents went to the others
    repeats: int
    tokens: int
    middle: int = 1  # tokens of its median document


@dataclass(frozen=True)
class Draw:
    """What a source gives: whole passes, and tokens of one more."""

    source: Source
    passes: int
    rest: int

    @property
    def goal(self) -> int:
        return self.passes * self.source.tokens + self.rest


def usable_sources(docs: DataFrame, targets: DataFrame) -> list[Source]:
    """One row per target source: the target table is fixed and small."""
    have = docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.percentile_approx("n_tokens", 0.5).alias("middle"))
    rows = targets.groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("repeats")).join(have, "source").collect()
    good = [r for r in rows if r["tokens"] and r["share"] and r["repeats"] and r["share"] > 0 and r["repeats"] > 0]
    total = sum(r["share"] for r in good)
    return [Source(r["source"], r["share"] / total, int(r["repeats"]), int(r["tokens"]), int(r["middle"])) for r in sorted(good, key=lambda r: r["source"])]


def draws(sources: list[Source]) -> list[Draw]:
    total = min(s.tokens * s.repeats / s.share for s in sources)
    goals = [(s, min(round(s.share * total), s.tokens * s.repeats)) for s in sources]
    return [Draw(s, g // s.tokens, g % s.tokens) for s, g in goals]


def block_size(given: list[Draw], blocks_per_source: int, largest: int = 1 << 16) -> int:
    """Tokens of a block: at least a median document; else the smallest contribution is cut into so many blocks."""
    least = min(d.goal for d in given)
    return int(max(1, min(max(max(d.source.middle for d in given), least / blocks_per_source), largest, least / 2)))


def van_der_corput(i: Column) -> Column:
    """The bits of i mirrored behind the point; i below 2**52."""
    return F.conv(F.reverse(F.lpad(F.bin(i), _BITS, "0")), 2, 10).cast("double") / F.lit(float(1 << _BITS))


def schedule(spark, sources: list[Source], slots: int) -> DataFrame:
    """(slot, source, turn): which source each slot takes and how often that source came before."""
    if slots > 1 << _BITS:
        raise ValueError("too many slots for one point each")
    point, edge, pick = F.col("u"), 0.0, None
    for s in sources[:-1]:
        edge += s.share
        pick = F.when(point < edge, s.name) if pick is None else pick.when(point < edge, s.name)
    pick = F.lit(sources[-1].name) if pick is None else pick.otherwise(sources[-1].name)
    at = spark.range(slots).select(F.col("id").alias("slot"), van_der_corput(F.col("id")).alias("u")).select("slot", pick.alias("source"), F.floor(F.col("slot") / 65536).alias("chunk"))
    sizes = at.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("source").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row per 65536 slots
    starts = sizes.select("source", "chunk", before.alias("start"))
    turn = F.row_number().over(W.partitionBy("source", "chunk").orderBy("slot")) - 1
    return at.withColumn("k", turn).join(starts, ["source", "chunk"]).select("slot", "source", (F.col("k") + F.col("start")).alias("turn"))


def _by_source(column: str, values: dict[str, int]) -> Column:
    """A number per target source, a handful, as an expression."""
    return F.try_element_at(F.create_map(*[F.lit(x) for name, n in values.items() for x in (name, int(n))]), F.col(column)).cast("long")


def _part_pass(docs: DataFrame, given: list[Draw], order: Column, shards: int, tolerance: float, fills: int) -> DataFrame | None:
    """(source, doc_id, n_tokens, before) of the pass that is only in part needed: a prefix that fits, then what fills the gap."""
    rest = {d.source.name: d.rest for d in given if d.rest}
    if not rest:
        return None
    fitting = docs.filter(F.col("n_tokens") <= _by_source("source", rest))
    placed = materialise(ranked(fitting, "source", order, ["doc_id"], shards, "n_tokens").select("source", "doc_id", "n_tokens", "before"), "mix-part")
    inside = F.col("before") + F.col("n_tokens") <= _by_source("source", rest)
    got = {r[0]: int(r[1]) for r in placed.filter(inside).groupBy("source").agg(F.sum("n_tokens")).collect()}  # a row per target source
    gaps, chosen = {s: n - got.get(s, 0) for s, n in rest.items()}, []
    goals = {d.source.name: d.goal for d in given}
    for _ in range(fills):
        open_gaps = {s: g for s, g in gaps.items() if g > tolerance * goals[s]}
        if not open_gaps:
            break
        free = placed.filter(~inside & (F.col("n_tokens") <= _by_source("source", open_gaps)) & ~F.col("doc_id").isin([c[1] for c in chosen]))
        found = free.groupBy("source").agg(F.max(F.struct("n_tokens", "doc_id")).alias("b")).select("source", "b.doc_id", "b.n_tokens").collect()
        if not found:
            break
        for source, doc_id, n in found:
            chosen.append((source, doc_id, n, rest[source] - gaps[source]))
            gaps[source] -= n
    drawn = placed.filter(inside)
    if not chosen:
        return drawn
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    return drawn.unionByName(docs.sparkSession.createDataFrame(chosen, kinds))


def mix(docs: DataFrame, targets: DataFrame, seed: int = 41, blocks_per_source: int = 512, tolerance: float = 0.0005, fills: int = 12) -> DataFrame:
    """(slot, source, use_no, doc_id, n_tokens): docs is (doc_id, source, n_tokens).

    Gaps above ``tolerance`` of a source's goal are filled with at most ``fills`` documents.
    """
    spark = docs.sparkSession
    docs = docs.filter("n_tokens > 0")
    sources = usable_sources(docs, targets)
    if not sources:
        return docs.select(F.lit(0).cast("long").alias("slot"), "source", F.lit(0).cast("long").alias("use_no"), "doc_id", "n_tokens").limit(0)
    given, shards, order = draws(sources), shard_count(spark), F.xxhash64("doc_id", F.lit(seed))
    wanted = docs.filter(F.col("source").isin([s.name for s in sources])).select("source", "doc_id", "n_tokens")
    uses = None
    if passes := {d.source.name: d.passes for d in given if d.passes}:
        whole = ranked(wanted.filter(F.col("source").isin(list(passes))), "source", order, ["doc_id"], shards, "n_tokens")
        use = F.explode(F.sequence(F.lit(0).cast("long"), _by_source("source", passes) - 1))
        uses = whole.select("source", "doc_id", "n_tokens", "before", use.alias("use_no"))
        uses = uses.withColumn("before", F.col("before") + F.col("use_no") * _by_source("source", {s.name: s.tokens for s in sources}))
    part = _part_pass(wanted, given, order, shards, tolerance, fills)
    if part is not None:
        part = part.withColumn("use_no", _by_source("source", {d.source.name: d.passes for d in given}))
        part = part.withColumn("before", F.col("before") + _by_source("source", {d.source.name: d.passes * d.source.tokens for d in given}))
        uses = part if uses is None else uses.unionByName(part.select(uses.columns))
    goals = {d.source.name: d.goal for d in given}
    slots = max(1, sum(goals.values()) // block_size(given, blocks_per_source))
    by_slot = [Source(n, g / sum(goals.values()), 1, g) for n, g in goals.items()]
    plan = materialise(schedule(spark, by_slot, slots), "mix-schedule")
    turns = {r[0]: r[1] for r in plan.groupBy("source").count().collect()}  # a row per target source
    block = F.least(F.floor(F.col("before") * _by_source("source", turns) / _by_source("source", goals)).cast("long"), _by_source("source", turns) - 1)
    return uses.withColumn("turn", block).join(plan, ["source", "turn"]).select("slot", "source", "use_no", "doc_id", "n_tokens")


def mix_report(mixed: DataFrame, docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, n_tokens, n_uses, most_uses, available_tokens), one row per source of either table."""
    used = mixed.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_uses"), (F.max("use_no") + 1).alias("most_uses"))
    have = docs.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    goal = targets.groupBy("source").agg(F.max("target_share").alias("target_share"))
    names = have.select("source").union(goal.select("source")).distinct()
    out = names.alias("s")
    for i, part in enumerate((used, have, goal)):
        part = part.withColumnRenamed("source", f"source{i}")
        out = out.join(part, F.col("s.source").eqNullSafe(F.col(f"source{i}")), "left").drop(f"source{i}")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    total = F.sum("n_tokens").over(W.partitionBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))  # one row per source
    return out.select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.round(F.coalesce(F.col("n_tokens") / total, F.lit(0.0)), 6).alias("actual_share"), zero("n_tokens"), zero("n_uses"), zero("most_uses"), zero("available_tokens"))
