"""Sharding: exact sizes, gapless slots, margins and law of the matrix, determinism."""

import math
import random
from collections import Counter

import pytest

from govlake.llm.sharding import communication_matrix, hypergeometric, shard_rows


def by_hand(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) <= set(range(shards))
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_rows_survive_with_exact_sizes(odd_docs, make_docs, rows_of):
    docs = odd_docs.select("*")
    out = shard_rows(docs, 5, rows_per_cell=2)
    rows = rows_of(out)
    by_hand(rows, 5)
    key = lambda r: repr([r[c] for c in docs.columns])
    assert sorted(map(key, rows)) == sorted(map(key, rows_of(docs)))
    assert sorted(map(repr, rows)) == sorted(map(repr, rows_of(shard_rows(docs, 5, rows_per_cell=2))))
    many = make_docs([f"t{i}" for i in range(1003)])
    by_hand(rows_of(shard_rows(many, 16)), 16)
    by_hand(rows_of(shard_rows(make_docs(["a", "b"]), 16)), 16)
    assert shard_rows(make_docs([]), 16).count() == 0
    named = make_docs([str(i) for i in range(9)], extra=["shard", "SLOT", "slot_", "to", "cell"])
    out = shard_rows(named, 4)
    assert out.columns == [*named.columns, "shard_", "slot__"]
    assert sorted((r["shard_"], r["slot__"]) for r in rows_of(out)) == sorted((i % 4, i // 4) for i in range(9))
    assert sorted(r["shard"] for r in rows_of(out)) == list(range(9))


def test_matrix_has_the_right_margins():
    counts = {c: n for c, n in enumerate([0, 1, 7, 100, 23, 500, 3])}
    m = communication_matrix(counts, 4, 3)
    total = sum(counts.values())
    for s in range(4):
        assert sum(b - a for _, t, a, b in m if t == s) == total // 4 + (s < total % 4)
    for c, n in counts.items():
        places = sorted((a, b) for x, _, a, b in m if x == c)
        assert [p for a, b in places for p in range(a, b)] == list(range(n))


def test_hypergeometric_law():
    good, bad, draws, rng = 7, 9, 6, random.Random(1)
    got = Counter(hypergeometric(good, bad, draws, rng.random()) for _ in range(40_000))
    for k in range(7):
        p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
        assert abs(got[k] / 40_000 - p) < 0.01
    big = [hypergeometric(30_000_000_000, 450_000_000_000, 1_000_000, rng.random()) for _ in range(50)]
    assert abs(sum(big) / 50 - 62_500) < 300


def test_shuffle_is_uniform(make_docs, rows_of):
    docs = make_docs([str(i) for i in range(40)])
    first = Counter()
    for seed in range(12):
        rows = rows_of(shard_rows(docs, 4, seed=seed * 100, rows_per_cell=10))
        first.update(r["shard"] for r in rows if r["doc_id"] < 10)
    assert all(12 < first[s] < 48 for s in range(4))  # 30 expected in each


def test_no_python_in_the_plan(make_docs):
    plan = shard_rows(make_docs(["a", "b"]), 4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
