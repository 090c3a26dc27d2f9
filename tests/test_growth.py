"""Steps whose memory, disk or time grew faster than their input."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from conftest import rows

from strandtide.functions import sequence as seqfn
from strandtide.operators import similarity
from strandtide.sources import tables as tabio


def test_equal_positions_hold_one_pair_at_a_time():
    a = pd.Series([b"ACGT" * 25_000] * 200 + [None, b"", b"AC"])
    b = pd.Series([b"ACGA" * 25_000] * 200 + [b"A", b"A", b"AGT"])
    tracemalloc.start()
    same = seqfn._equal_positions.func(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert same.tolist() == [75_000] * 200 + [0, 0, 1]
    assert peak < 2_000_000


def _documents(n):
    one = '{"version": "a}{", "meta": {"nodes": {"x": "1"}}, "nodes": {"A%d": {"k": "1"}, "B%d": {"k": "}{", "l": "2"}}, "after": {"E": {"k": "no"}}}'
    return "\n".join(one % (i, i) for i in range(n)), sorted(row for i in range(n) for row in ((f"A{i}", "k", "1"), (f"B{i}", "k", "}{"), (f"B{i}", "l", "2")))


@pytest.mark.parametrize("entries", [1, 3, 1 << 16])
def test_entries_find_their_object_across_slices(spark, monkeypatch, tmp_path, entries):
    monkeypatch.setattr(tabio, "ENTRIES_PER_SLICE", entries, raising=False)
    text, want = _documents(40)
    (tmp_path / "docs.json").write_text(text)
    assert rows(tabio.read_node_documents(spark, str(tmp_path))) == want


def test_no_entry_meets_all_objects_of_its_file(spark, tmp_path):
    (tmp_path / "docs.json").write_text(_documents(2)[0])
    plan = tabio.read_node_documents(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "opened" not in plan


@pytest.mark.parametrize("bound", [0.6, 0.9, 0.95, 0.98])
def test_neighbours_at_the_widest_blocks(spark, bound):
    rng = random.Random(bound)
    texts = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (1, 2, 10, 18, 19, 20, 38, 57, 100, 200)]
    for t in list(texts):
        for _ in range(3):
            # as many changes as the bound allows, and one more, evenly spread
            changes = int((1 - bound) * len(t) + 1e-9) + rng.randrange(2)
            at = {(i * len(t)) // max(changes, 1) for i in range(changes)}
            texts.append("".join("N" if i in at else c for i, c in enumerate(t)) + "T" * rng.randrange(2))
    data = [(f"t{i:02}", t) for i, t in enumerate(texts)]
    want = []
    for i, a in data:
        near = []
        for j, b in data:
            identity = sum(x == y for x, y in zip(a, b, strict=False)) / max(len(a), len(b))
            if i != j and identity >= bound:
                near.append((-identity, j))
        want += [(i, j, round(-d, 9)) for d, j in sorted(near)[:3]]
    got = similarity.neighbours(spark.createDataFrame(data, "id string, seq string"), 3, bound)
    assert sorted((r.id, r.neighbour, round(r.identity, 9)) for r in got.collect()) == sorted(want)


def test_unlike_texts_share_few_groups(spark, monkeypatch):
    rng = random.Random(4)
    seen = []
    compare = similarity.best_in_groups
    monkeypatch.setattr(similarity, "best_in_groups", lambda members, *rest: (seen.append(members.count()), compare(members, *rest))[1])
    data = [(f"t{i}", "".join(rng.choice("AC") for _ in range(90))) for i in range(3000)]
    similarity.neighbours(spark.createDataFrame(data, "id string, seq string"), 3, 0.95)
    # nearly all blocks of half the width that the bound allows are shared: five for each text
    assert seen[0] < 1000


def _candidates(spark, monkeypatch, data):
    seen = []
    compare = similarity.best_in_groups
    with monkeypatch.context() as patch:
        patch.setattr(similarity, "best_in_groups", lambda members, texts, *rest: (seen.append((members.count(), texts.count())), compare(members, texts, *rest))[1])
        got = similarity.neighbours(spark.createDataFrame(data, "id string, seq string"), 3, 0.95)
    return seen[0], sorted((r.id, r.neighbour) for r in got.collect())


def test_texts_with_common_passages_are_no_candidates(spark, monkeypatch):
    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    passages = [some(36) for _ in range(2)]
    data = [(f"t{i}", passages[i % 2] + some(288) + passages[i % 2]) for i in range(200)]
    near = data[7][1][:100] + ("C" if data[7][1][100] != "C" else "G") + data[7][1][101:]
    members, found = _candidates(spark, monkeypatch, [*data, ("near", near)])
    assert found == [("near", "t7"), ("t7", "near")]
    assert members[1] == 2


def test_lengths_that_no_pair_within_the_bound_spans_share_no_group(spark, monkeypatch):
    rng = random.Random(9)
    one = "".join(rng.choice("ACGT") for _ in range(4000))
    data = [(f"t{i:02}", one[: int(40 * 1.06**i)]) for i in range(80)] + [("near", "A" + one[1:2000]), ("long", one[:2000] + "T")]
    members, found = _candidates(spark, monkeypatch, data)
    n = {i: len(t) for i, t in data}
    assert ("near", "long") in found and all(min(n[a], n[b]) >= 0.95 * max(n[a], n[b]) for a, b in found)
    assert members[1] < 10


def test_blocks_are_told_by_place_and_letters():
    text = np.frombuffer(b"ACGTACGTAC", dtype=np.uint8)
    whole = similarity.block_hashes(text, 4)
    assert len(set(whole.tolist())) == 3
    assert (similarity.block_hashes(text[:8], 4) == whole[:2]).all()
    # the last block is shorter, and no letter counts as none
    assert similarity.block_hashes(text[:9], 4)[2] != whole[2]
    assert similarity.block_hashes(np.zeros(2, np.uint8), 4)[0] != similarity.block_hashes(np.zeros(1, np.uint8), 4)[0]
    assert (similarity.block_hashes(text, 1 << 30) == similarity.block_hashes(text, 10)).all()


def test_numbers_of_keys_differ(spark):
    keys = spark.range(1000).selectExpr("unhex(sha2(cast(id as string), 256)) as key")
    assert keys.select(similarity.distinct_number(keys, "key").alias("t")).distinct().count() == 1000


def test_nulls_empty_texts_and_copies_keep_their_neighbours(spark):
    text = "ACGTTGCAAC" * 8
    data = [("a", text), ("a", text), ("b", text), ("c", "C" + text[1:]), ("e", ""), ("f", None), ("g", "TTTT")]
    got = similarity.neighbours(spark.createDataFrame(data, "id string, seq string"), 2, 0.95)
    # a row that comes twice fills two ranks
    assert {(r.id, r.neighbour) for r in got.collect()} == {("a", "b"), ("b", "a"), ("c", "a")}
