from itertools import combinations_with_replacement

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabspark.llm import packing

HIST = st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25)


@settings(max_examples=150, deadline=None)
@given(HIST)
def test_plan_uses_every_item_once_and_never_overfills(counts):
    plan = packing.plan_packing(counts, 40)
    used: dict[int, int] = {}
    for pattern, times in plan.patterns:
        assert sum(k * n for k, n in pattern.items()) <= 40 and times > 0
        for k, n in pattern.items():
            used[k] = used.get(k, 0) + n * times
    assert used == counts


@settings(max_examples=150, deadline=None)
@given(HIST, st.integers(1, 40))
def test_index_finds_an_exact_sum_where_there_is_one(counts, gap):
    index = packing.SumIndex(counts, 40)
    items = [k for k, n in counts.items() for _ in range(min(n, 3))]
    exists = any(sum(c) == gap and all(c.count(x) <= counts[x] for x in c) for r in (1, 2, 3) for c in combinations_with_replacement(sorted(set(items)), r))
    found = index.exact(gap, {})
    assert bool(found) == exists
    if found:
        assert sum(found) == gap and all(found.count(x) <= counts[x] for x in found)


def test_index_follows_what_is_taken():
    index = packing.SumIndex({3: 1, 4: 2, 5: 1}, 10)
    assert set(index.exact(8, {})) in ({3, 5}, {4})
    index.take({4: 2}, 1)
    assert sorted(index.exact(8, {})) == [3, 5] and index.exact(4, {}) == ()


def _packed(spark, sizes, capacity):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "k long, n long")
    return [r.asDict() for r in packing.pack(df, "k", "n", capacity).collect()]


def test_whole_items_split_giants_and_empty_texts(spark):
    sizes = [0, 0, 3, 7, 10, 25, 30, 6, 4, 5, 5, 9, 1, 2] + [5] * 50
    out = _packed(spark, sizes, 10)
    fill: dict[int, int] = {}
    for r in out:
        fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
    assert max(fill.values()) <= 10 and sum(fill.values()) == sum(sizes)
    pieces: dict[int, list] = {}
    for r in out:
        pieces.setdefault(r["k"], []).append((r["piece_no"], r["first_token"], r["n_tokens"]))
    for k, n in enumerate(sizes):
        assert len(pieces[k]) == max(1, -(-n // 10))
        assert sum(p[2] for p in pieces[k]) == n and [p[1] for p in sorted(pieces[k])] == [10 * i for i in range(len(pieces[k]))]
    places = [(r["container_id"], r["slot"]) for r in out if r["n_tokens"]]
    assert len(set(places)) == len(places)
    assert len(fill) == sorted(fill)[-1] + 1 and sum(fill.values()) / (10 * len(fill)) > 0.97


def test_empty_table(spark):
    assert _packed(spark, [], 10) == []
    assert [(r["container_id"], r["n_tokens"]) for r in _packed(spark, [0], 10)] == [(0, 0)]


@pytest.mark.parametrize("text,n", [(None, 0), ("", 0), ("a", 1), ("<|endoftext|>", 7)])
def test_token_counts(spark, text, n):
    from tabspark.llm.tokens import with_token_counts

    assert with_token_counts(spark.createDataFrame([(1, text)], "k long, text string")).first()["n_tokens"] == n
