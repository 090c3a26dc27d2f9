"""Segments of seeds as runs on diagonals: both ways equal a plain search, and repeats make rows by their sum."""

from __future__ import annotations

import random

import pytest

from strandtide.operators import diagonals, seeds


def plain(queries, refs, k):
    out = []
    for q, a in queries:
        for r, b in refs:
            lines = {}
            for i in range(len(a) - k + 1):
                for j in range(len(b) - k + 1):
                    if a[i : i + k] == b[j : j + k] and set(a[i : i + k]) <= set("ACGT"):
                        lines.setdefault(j - i, []).append(i + 1)
            for d, at in lines.items():
                begin = last = None
                for p in [*sorted(at), None]:
                    if begin is not None and (p is None or p - last > 2 * k):
                        out.append((q, r, d, begin, last + k - 1))
                        begin = None
                    begin = p if begin is None else begin
                    last = p
    return sorted(out)


def texts(rng, n, longest, letters):
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(longest))) for _ in range(n)]
    made += [made[0] + made[1], made[1][::-1], "A" * 40, "A" * 25 + "C" + "A" * 25, "AC" * 20, "N" * 20, "ANNA" * 9, "", "acgt" * 5]
    return [(f"t{i}", t) for i, t in enumerate(made)]


@pytest.mark.parametrize("letters", ["ACGT", "ACGTN-", "AAAC"])
@pytest.mark.parametrize("chunk", [20_000, 17])
def test_segments_equal_a_plain_search(spark, monkeypatch, letters, chunk):
    monkeypatch.setattr(seeds, "CHUNK_LETTERS", chunk)
    rng = random.Random(letters)
    queries, refs, k = texts(rng, 8, 70, letters), texts(rng, 5, 60, letters), 4
    q = spark.createDataFrame([(i.encode(), s) for i, s in queries], "key binary, seq string").repartition(3)
    r = spark.createDataFrame(refs, "id string, seq string")
    want = plain(queries, refs, k)
    for bound in (10**6, 1):
        monkeypatch.setattr(seeds, "BROADCAST_LETTERS", bound)
        got = seeds.segments(q, r, k).select("key", "sseqid", "diag", "qstart", "qend").collect()
        assert sorted((bytes(x.key).decode(), *tuple(x)[1:]) for x in got) == want


def test_only_segments_that_can_matter_leave_a_task(spark, monkeypatch):
    monkeypatch.setattr(seeds, "CHUNK_LETTERS", 50)
    rng = random.Random(2)
    refs = texts(rng, 4, 200, "ACGT")
    queries = texts(rng, 10, 200, "ACGT") + [("copy", refs[0][1] + refs[1][1] * 3)]
    q = spark.createDataFrame([(i.encode(), s) for i, s in queries], "key binary, seq string")
    r = spark.createDataFrame(refs, "id string, seq string")
    letters, sizes = sum(len(s) for _, s in refs), dict(queries)
    enough = lambda row: len(sizes[row[0]]) * letters * 2.718281828459045 ** (-0.9 * (row[4] - row[3] + 1)) <= 0.5
    got = {(bytes(x.key).decode(), x.sseqid, x.diag, x.qstart, x.qend) for x in seeds.segments(q, r, 5, 0.9, 0.5).collect()}
    want = plain(queries, refs, 5)
    assert {x for x in got if enough(x)} == {x for x in want if enough(x)}
    assert got <= set(want) or len(got) < len(want)


def test_a_repeated_letter_makes_rows_by_the_sum(spark):
    n, m, k = 3000, 2000, 11
    pieces = seeds.pieces_of(spark.createDataFrame([(b"q", "A" * n)], "key binary, seq string"), "key", k)
    runs = diagonals.in_task(pieces, [("r", "A" * m)], k, m, 0.0, float("inf"), seeds.CHUNK_LETTERS)
    assert runs.count() == n + m - 2 * k + 1
    kmers = seeds.kmer_table(spark.createDataFrame([(b"q", "A" * n)], "key binary, seq string"), "key", k, diagonals.NOT_HERE)
    there = seeds.kmer_table(spark.createDataFrame([("r", "A" * m)], "id string, seq string"), "id", k, diagonals.NOT_THERE).withColumnRenamed("id", "sseqid")
    assert diagonals.by_join(kmers, there).count() == n + m - 2 * k + 1


@pytest.mark.parametrize("letters", ["ACGTN-", "AAAC"])
def test_equal_letters_of_a_segment_are_counted_where_it_is_found(spark, monkeypatch, letters):
    rng = random.Random(letters)
    queries, refs, k = texts(rng, 6, 90, letters), texts(rng, 4, 80, letters), 4
    # one changed letter after another, so that segments have many gaps, some at the ends of chunks
    base = "".join(rng.choice("ACGT") for _ in range(120))
    queries.append(("changed", "".join("N" if i % 9 == 8 else c for i, c in enumerate(base))))
    refs.append(("base", base))
    q = spark.createDataFrame([(i.encode(), s) for i, s in queries], "key binary, seq string").repartition(3)
    r = spark.createDataFrame(refs, "id string, seq string")
    a, b = dict(queries), dict(refs)
    want = sorted((*row, sum(a[row[0]][p - 1] == b[row[1]][p + row[2] - 1] for p in range(row[3], row[4] + 1))) for row in plain(queries, refs, k))
    for chunk, bound in ((20_000, 10**6), (17, 10**6), (17, 1)):
        monkeypatch.setattr(seeds, "CHUNK_LETTERS", chunk)
        monkeypatch.setattr(seeds, "BROADCAST_LETTERS", bound)
        got = seeds.segments(q, r, k).select("key", "sseqid", "diag", "qstart", "qend", "same").collect()
        assert sorted((bytes(x.key).decode(), *tuple(x)[1:]) for x in got) == want


def test_rows_of_a_repeated_letter_do_not_grow_with_the_chunks(spark, monkeypatch):
    monkeypatch.setattr(seeds, "CHUNK_LETTERS", 100)
    n, m, k = 3000, 2000, 11
    text = spark.createDataFrame([(b"q", "A" * n)], "key binary, seq string")
    runs = diagonals.in_task(seeds.pieces_of(text, "key", k), [("r", "A" * m)], k, m, 0.0, float("inf"), 100)
    # a first and a last seed for each diagonal at most
    assert runs.count() <= 2 * (n + m)
    there = seeds.kmer_table(spark.createDataFrame([("r", "A" * m)], "id string, seq string"), "id", k, diagonals.NOT_THERE).withColumnRenamed("id", "sseqid")
    assert diagonals.by_join(seeds.kmer_table(text, "key", k, diagonals.NOT_HERE), there).count() == n + m - 2 * k + 1


def test_hits_carry_no_text_and_count_equal_rows_of_the_references(spark):
    base = "ACGTTGCAAC" * 12
    q = spark.createDataFrame([("q1", base, 1), ("q2", base, 2)], "id string, seq string, ord int")
    r = spark.createDataFrame([("r", base), ("r", base), (None, base), ("s", None)], "id string, seq string")
    hits = seeds.kmer_hits(q, r)
    whole = hits.where("length = 120").collect()
    assert sorted((h.qseqid, h.sseqid, h.mismatch, h.qcovs) for h in whole) == [("q1", "r", 0, 100)] * 2 + [("q2", "r", 0, 100)] * 2
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "_equal_positions" not in plan
