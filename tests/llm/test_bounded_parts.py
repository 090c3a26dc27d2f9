"""What reaches the driver or one task stays bounded, and rows with equal hashes are told apart by their ids."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandtide.llm import languages, mixing, near_dups, sharding, substrings
from strandtide.llm.queries import thirds

SCHEMA = "doc_id long, text string, source string, lang string"


def made(spark, n, seed=1):
    rng = random.Random(seed)
    words = lambda: " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(3, 40)))
    texts = [words() for _ in range(n // 2)]
    return spark.createDataFrame([(i, rng.choice(texts) if i % 3 else texts[0], f"s{i % 5}", "x") for i in range(n)], SCHEMA).repartition(4)


@pytest.mark.parametrize("regions", [1, 7])
def test_capacity_is_packed_region_by_region(spark, monkeypatch, regions):
    docs = made(spark, 400)
    total = docs.agg(F.sum(F.octet_length("text") + 8)).first()[0]
    capacity = total // 40
    monkeypatch.setattr(sharding, "SHARDS_PER_REGION", -(-total // (capacity * regions)))
    placed = sharding.shard(docs, None, capacity).collect()
    assert len(placed) == 400
    sizes, group = {}, {}
    for r in placed:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        assert group.setdefault(bytes(r.text_key), r.shard) == r.shard
    alone = {s for s in sizes if len({bytes(r.text_key) for r in placed if r.shard == s}) == 1}
    assert all(n <= capacity or s in alone for s, n in sizes.items())
    assert sorted(sizes) == list(range(len(sizes))) and len(sizes) <= 40 + 2 * regions
    for s in sizes:
        assert sorted(r.slot for r in placed if r.shard == s) == list(range(sum(r.shard == s for r in placed)))


def test_capacity_brings_no_items_to_the_driver(spark, monkeypatch):
    seen = []
    packed = sharding._packed
    monkeypatch.setattr(sharding, "_packed", lambda *a: seen.append(1) or packed(*a))
    sharding.shard(made(spark, 60), None, 500).count()
    assert not seen


def test_stated_references_have_a_bound(spark, monkeypatch):
    monkeypatch.setattr(substrings, "MOST_REFERENCE_WORDS", 50)
    with pytest.raises(ValueError, match="at most 50"):
        substrings.against_references(made(spark, 20), made(spark, 40))


def test_rows_of_equal_hash_and_other_ids_stay(spark, monkeypatch):
    """With a hash that is the same for all rows, ids still tell them apart."""
    docs = spark.createDataFrame([(i, f"text number {i} of some words", "s", "x") for i in range(6)] + [(None, "no id here", "s", "x")], SCHEMA)
    one = lambda *a: F.lit(7).cast("long")
    monkeypatch.setattr(mixing, "row_key", one)
    got = mixing.mixed(docs, thirds, budget=2.0, passes=2)
    assert {(r.doc_id, r.text) for r in got.distinct().collect()} == {(r.doc_id, r.text) for r in docs.collect()}
    monkeypatch.undo()
    kept = near_dups.keep_one(docs.unionAll(docs), 5, 80)
    assert kept.count() == 7


def test_samples_of_frequent_languages_are_the_first_by_hash(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("wort "), F.col("id")).alias("text"), F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("lang"))
    model = languages.fit(docs, bound=200)
    again = languages.fit(docs.repartition(7), bound=200)
    assert model.names == ["a", "b"] and (model.weights == again.weights).all() and (model.offsets == again.offsets).all()
