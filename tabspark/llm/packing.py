"""Filling fixed-capacity containers by exact-complement hashing.

Only the number of items of each length matters for the plan, and there are at most ``capacity`` lengths; so the plan is
made on that histogram, however many items there are. Items longer than the capacity are cut into full pieces and a rest.
Indexes over the available lengths answer whether one, two or three of them add up to a gap exactly; combinations are
consumed as often as all their lengths are available. What can't be completed exactly is packed best-fit.

Each item then takes the place of its rank among the items of its length: the plan says which ranks go to which containers.

Defined results: texts without tokens (null, empty) take no space and are spread over the containers (container 0 where
there is no other); no item is split unless it alone exceeds the capacity; equal items are placed by hash, then id; an
empty table gives no containers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.ranks import ranked, shard_count


class SumIndex:
    """Available counts by length, with an index of the sums of two different available lengths."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.count[length] += n
        self.alive = self.count > 0
        self.pairs = np.zeros(2 * capacity + 1, dtype=np.int64)
        lengths = np.flatnonzero(self.alive)
        for i, a in enumerate(lengths):
            np.add.at(self.pairs, a + lengths[i + 1 :], 1)

    def take(self, lengths: dict[int, int], times: int) -> None:
        for length, n in lengths.items():
            self.count[length] -= n * times
            if not self.count[length]:
                self.alive[length] = False
                self.pairs[length + np.flatnonzero(self.alive)] -= 1

    def left(self, length: int, used: dict[int, int]) -> int:
        return int(self.count[length]) - used.get(length, 0)

    def largest(self, limit: int, used: dict[int, int]) -> int:
        """The largest available length up to limit, 0 if there is none."""
        for length in np.flatnonzero(self.alive[: limit + 1])[::-1]:
            if self.left(length, used) > 0:
                return int(length)
        return 0

    def two(self, total: int, used: dict[int, int]) -> tuple[int, ...]:
        if total < 2 or total > 2 * self.capacity:
            return ()
        low = max(1, total - self.capacity)
        a = np.arange(low, total // 2 + 1)
        for x in a[self.alive[a] & self.alive[total - a]][::-1]:
            x, y = int(x), int(total - x)
            if self.left(x, used) >= (2 if x == y else 1) and self.left(y, used) >= 1:
                return (y, x)
        return ()

    def exact(self, gap: int, used: dict[int, int]) -> tuple[int, ...]:
        """One, two or three available lengths that add up to gap; () if there are none."""
        if gap <= self.capacity and self.alive[gap] and self.left(gap, used) > 0:
            return (gap,)
        if found := self.two(gap, used):
            return found
        a = np.flatnonzero(self.alive[: min(gap, self.capacity + 1)])
        rest = gap - a
        half = (rest % 2 == 0) & (rest // 2 <= self.capacity) & self.alive[np.minimum(rest // 2, self.capacity)]
        for x in a[(self.pairs[np.minimum(rest, 2 * self.capacity)] > 0) | half][::-1]:
            x = int(x)
            if self.left(x, used) > 0 and (found := self.two(gap - x, used | {x: used.get(x, 0) + 1})):
                return (x, *found)
        return ()


@dataclass
class Plan:
    """Patterns in order: (lengths with multiplicity, number of containers)."""

    patterns: list[tuple[dict[int, int], int]] = field(default_factory=list)

    @property
    def containers(self) -> int:
        return sum(n for _, n in self.patterns)


def _grow(index: SumIndex, capacity: int, first: int, exact_only: bool) -> dict[int, int] | None:
    used, gap = {first: 1}, capacity - first
    while gap:
        found = index.exact(gap, used)
        if not found:
            nxt = index.largest(gap, used)
            if not nxt:
                return None if exact_only else used
            found = (nxt,)
        for length in found:
            used[length] = used.get(length, 0) + 1
            gap -= length
    return used


def plan_packing(counts: dict[int, int], capacity: int) -> Plan:
    """counts: items by length, 1 to capacity. Each step uses a pattern as often as its lengths are available."""
    index, plan = SumIndex(counts, capacity), Plan()
    for exact_only in (True, False):
        for first in np.flatnonzero(index.alive)[::-1]:
            first = int(first)
            while index.count[first] > 0:
                pattern = _grow(index, capacity, first, exact_only)
                if pattern is None:
                    break
                times = min(int(index.count[length]) // n for length, n in pattern.items())
                index.take(pattern, times)
                plan.patterns.append((pattern, times))
    return plan


def _ranges(plan: Plan) -> pd.DataFrame:
    """For each length the ranks that a pattern takes: (length, start, per, container, slot), sorted."""
    next_rank: dict[int, int] = {}
    rows, base = [], 0
    for pattern, times in plan.patterns:
        slot = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            rows.append((length, next_rank.get(length, 0), n, base, slot))
            next_rank[length] = next_rank.get(length, 0) + n * times
            slot += n
        base += times
    return pd.DataFrame(rows, columns=["length", "start", "per", "container", "slot"]).sort_values(["length", "start"], ignore_index=True)


def pieces(df: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(key, piece_no, first_token, n_tokens): one row per item, full pieces and a rest for those beyond the capacity."""
    n = F.col(size).cast("long")
    last = F.greatest(F.lit(0), F.ceil(n / F.lit(capacity)).cast("long") - 1)
    cut = df.select(key, n.alias("__n"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece_no"))
    first = F.col("piece_no") * capacity
    return cut.select(key, "piece_no", first.alias("first_token"), F.least(F.lit(capacity).cast("long"), F.col("__n") - first).alias("n_tokens"))


def pack(df: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(key, piece_no, first_token, n_tokens, container_id, slot)."""
    parts = pieces(df, key, size, capacity)
    counts = {int(r[0]): int(r[1]) for r in parts.filter("n_tokens > 0").groupBy("n_tokens").count().collect()}  # at most capacity rows
    plan = plan_packing(counts, capacity)
    table, containers = _ranges(plan), max(1, plan.containers)
    width = 1 << 40  # ranks of one length stay below this
    where = (table["length"] * width + table["start"]).to_numpy() if len(table) else np.zeros(0, dtype=np.int64)
    per, base, slot0, start = (table[c].to_numpy(dtype=np.int64) for c in ("per", "container", "slot", "start"))

    @F.pandas_udf("container_id long, slot long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(where, length.to_numpy() * width + rank.to_numpy(), side="right") - 1
        into = rank.to_numpy() - start[at]
        return pd.DataFrame({"container_id": base[at] + into // per[at], "slot": slot0[at] + into % per[at]})

    spread = F.xxhash64(key, "piece_no")
    full = ranked(parts.filter("n_tokens > 0"), "n_tokens", spread, [key, "piece_no"], shard_count(df.sparkSession))
    placed = full.withColumn("at", place("n_tokens", "position")).select(key, "piece_no", "first_token", "n_tokens", "at.container_id", "at.slot")
    empty = parts.filter("n_tokens = 0").select(key, "piece_no", "first_token", "n_tokens", F.pmod(spread, F.lit(containers)).cast("long").alias("container_id"), F.lit(-1).cast("long").alias("slot"))
    return placed.unionByName(empty)


def fill_report(packed: DataFrame, group: str) -> DataFrame:
    """Per group: containers, tokens, used share of the space and share of containers filled exactly. Needs capacity_tokens."""
    full = packed.groupBy(group, "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("items"))
    return full.groupBy(group, "capacity_tokens").agg(
        F.count("*").alias("n_containers"),
        F.sum("items").alias("n_items"),
        F.sum("tokens").alias("n_tokens"),
        F.round(F.sum("tokens") / (F.count("*") * F.col("capacity_tokens")), 6).alias("used_share"),
        F.round(F.avg((F.col("tokens") == F.col("capacity_tokens")).cast("double")), 6).alias("exact_share"),
        F.max("tokens").alias("largest"),
    )
