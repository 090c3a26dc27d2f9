"""Nearest texts in dense clusters: exact against all pairs, with rows that follow the members and not their pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from strandtide.functions.batches import group_bounds, whole_groups
from strandtide.operators import nearest, similarity


def identity(a, b):
    return sum(x == y for x, y in zip(a, b)) / max(len(a), len(b))


def plain(named, k, bound):
    out = []
    for i, a in named:
        near = sorted((-identity(a, b), j) for j, b in named if j != i and identity(a, b) >= bound)
        out += [(i, rank, j, round(-s, 12)) for rank, (s, j) in enumerate(near[:k], 1)]
    return sorted(out)


def found(spark, named, k, bound):
    got = similarity.neighbours(spark.createDataFrame(named, "id string, seq string").repartition(3), k, bound)
    return sorted((r.id, r["rank"], r.neighbour, round(r.identity, 12)) for r in got.collect())


def clades(rng, n, length):
    """Texts with nested shared changes, some letters of their own and sometimes another length."""
    base = [rng.choice("ACGT") for _ in range(length)]
    pool, out = [base], []
    for i in range(n):
        text = rng.choice(pool)[:]
        for _ in range(rng.randrange(0, 3)):
            text[rng.randrange(len(text))] = rng.choice("ACGT")
        if rng.random() < 0.2:
            text = text + [rng.choice("ACGT")] * rng.randrange(1, 3) if rng.random() < 0.5 else text[: -rng.randrange(1, 3)]
        if rng.random() < 0.1:
            pool.append(text)
        out.append((f"s{i:04d}", "".join(text)))
    return out


@pytest.mark.parametrize(("seed", "members", "bound"), [(1, 4, 0.9), (2, 8, 0.93), (3, 20, 0.9)])
def test_groups_beyond_a_cell_give_the_same_neighbours(spark, monkeypatch, seed, members, bound):
    monkeypatch.setattr(nearest, "CELL_MEMBERS", members)
    named = clades(random.Random(seed), 70, 60)
    assert found(spark, named, 3, bound) == plain(named, 3, bound)


def test_texts_too_long_for_a_cell(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL_LETTERS", 100)
    named = clades(random.Random(5), 30, 80) + [("x", "A" * 80), ("y", "A" * 79 + "C"), ("z", "")]
    assert found(spark, named, 2, 0.9) == plain([r for r in named if r[1]], 2, 0.9)


def test_rows_follow_the_members_of_a_cluster(spark, monkeypatch):
    """One-letter variants: nothing that is shuffled grows faster than the cluster."""
    monkeypatch.setattr(nearest, "CELL_MEMBERS", 64)
    sizes = []
    for n in (200, 400, 800):
        rng = random.Random(n)
        base = [rng.choice("ACGT") for _ in range(400)]
        texts = {"".join(base[:p] + [c] + base[p + 1 :]) for p in range(400) for c in "ACGT" if c != base[p]}
        named = [(f"v{i:04d}", t) for i, t in enumerate(sorted(texts)[:n])]
        keyed = spark.createDataFrame([(1, t.encode()[-40:] + t.encode(), i, t.encode()) for i, t in named], "g long, key binary, first string, raw binary")
        counted = []
        cut = nearest.cut_lineage
        monkeypatch.setattr(nearest, "cut_lineage", lambda df, **more: counted.append(out := cut(df, **more)) or out)
        monkeypatch.setattr(nearest, "drop_stored", lambda df: None)
        pairs = nearest.best_in_groups(keyed.select("g", "key"), keyed.drop("g"), 3, 0.99)
        assert pairs.groupBy("key_a").agg(F.count("*").alias("n")).where("n < 3").count() == 0
        sizes.append(sum(df.count() for df in counted))
        monkeypatch.undo()
        monkeypatch.setattr(nearest, "CELL_MEMBERS", 64)
    assert sizes[1] <= 2.3 * sizes[0] and sizes[2] <= 2.3 * sizes[1]


def test_distances_from_entries():
    rng = random.Random(7)
    texts = [np.frombuffer(t.encode(), dtype=np.uint8) for _, t in clades(rng, 40, 50)] + [np.zeros(0, np.uint8)]
    lists = [nearest.entries(t, texts[0]) for t in texts]
    got = nearest.distances(lists, lists)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert got[i, j] == max(len(a), len(b)) - sum(x == y for x, y in zip(a, b))
    assert (nearest._direct(texts) == got).all()


def test_groups_stay_whole_over_batches(spark):
    made = spark.createDataFrame([(i // 7, i) for i in range(500)], "g long, v long").repartition("g").sortWithinPartitions("g")

    def run(batches):
        import pyarrow as pa

        small = (b.slice(i, 3) for b in batches for i in range(0, b.num_rows, 3))
        for table in whole_groups(small, ["g"]):
            bounds = group_bounds(table, ["g"])
            g = table.column("g").to_numpy()[bounds[:-1]]
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(np.diff(bounds))], names=["g", "n"])

    assert rows(made.mapInArrow(run, "g long, n long")) == sorted(((i, 7 if i < 71 else 3) for i in range(72)), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_no_texts(spark):
    assert found(spark, [], 3, 0.9) == []
    assert found(spark, [("a", None), ("b", ""), ("c", "")], 3, 0.9) == []
