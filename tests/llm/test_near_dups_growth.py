"""Clusters of texts about as similar as the threshold: links stay exact while no join grows with the square of the cluster."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest

from strandtide.llm import near_dups
from strandtide.runtime import shared_folder

PERCENT = 85


def cluster(n, seed=2, size=400):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(size)]
    out = []
    for _ in range(n):
        words = base.copy()
        for at in rng.sample(range(size), rng.choice((4, 5, 6, 7))):
            words[at] = f"r{rng.randrange(10**9)}"
        out.append(" ".join(words))
    return out


def plain_groups(texts):
    sets = [frozenset(zip(w, w[1:], w[2:], strict=False)) for w in map(str.split, texts)]
    group = list(range(len(sets)))

    def find(x):
        while group[x] != x:
            group[x] = x = group[group[x]]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if find(i) != find(j):
                common = len(a & sets[j])
                if 100 * common >= PERCENT * (len(a) + len(sets[j]) - common):
                    group[find(i)] = find(j)
    least = {}
    for i in range(len(sets)):
        least.setdefault(find(i), i)
    return [least[find(i)] for i in range(len(sets))]


@pytest.fixture
def counted(monkeypatch):
    seen = {}
    confirm, within = near_dups.confirm, near_dups._within_buckets

    def count_confirm(pairs, *rest):
        seen.setdefault("confirmed", []).append(pairs.count())
        return confirm(pairs, *rest)

    def count_within(*args):
        out = within(*args)
        seen["links"] = out.count()
        return out

    monkeypatch.setattr(near_dups, "confirm", count_confirm)
    monkeypatch.setattr(near_dups, "_within_buckets", count_within)
    return seen


def test_pairs_grow_with_the_cluster(spark, counted):
    figures = []
    for n in (300, 600, 1200):
        texts = cluster(n)
        counted.clear()
        got = near_dups.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, PERCENT).collect()
        assert [r.component_id for r in sorted(got, key=lambda r: r.doc_id)] == plain_groups(texts)
        figures.append((sum(counted["confirmed"]), counted["links"]))
    for (a, x), (b, y) in zip(figures[:-1], figures[1:], strict=True):
        assert b <= 2.4 * a
        assert y <= 2.4 * x + 32


def test_cells_give_forests_of_exact_links():
    rng = np.random.default_rng(4)
    base = set(range(300))
    sets = []
    for _ in range(60):
        own = base - set(rng.choice(300, rng.integers(0, 30), replace=False).tolist())
        sets.append(own | set((1000 + rng.integers(0, 200, rng.integers(0, 30))).tolist()))
    delta = [np.array(sorted(s ^ base), dtype=np.int64) for s in sets]
    of = np.concatenate([[0], np.cumsum([len(d) for d in delta])]).astype(np.int64)
    n, label = np.array([len(s) for s in sets]), np.arange(60) // 2 + 500
    for left, right in ((np.arange(60), None), (np.arange(20), np.arange(20, 60))):
        right = left if right is None else right
        want = {tuple(sorted((label[x], label[y]))) for x in left for y in right if label[x] != label[y] and 100 * len(sets[x] & sets[y]) >= PERCENT * len(sets[x] | sets[y])}
        got = near_dups._cell_links(label, n, np.concatenate(delta), of, left, right, PERCENT)
        assert {tuple(sorted(p)) for p in got} <= want
        assert len(got) < len(set(label))
        # same groups by the forest as by all links
        groups = []
        for pairs in (got, want):
            at = {x: x for x in label.tolist()}
            for a, b in pairs:
                old, new = at[a], at[b]
                at = {k: new if v == old else v for k, v in at.items()}
            groups.append({frozenset(k for k in at if at[k] == v) for v in at.values()})
        assert groups[0] == groups[1]


def test_only_two_tables_stay(spark):
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    texts = cluster(40) + ["alone here by itself", "", "alone here by itself"]
    got = near_dups.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, PERCENT)
    assert got.count() == 43
    assert len(set(os.listdir(folder)) - before) == 2
