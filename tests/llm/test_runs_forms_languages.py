"""Periodic runs, fill-in-middle forms and language identification against plain versions, on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandtide.llm import fill_middle, languages, runs
from strandtide.llm.queries import QUERIES, with_planted_periods

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, form string, output string, runs int, said int, `a.b` int, at int, h int, words int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, *[None] * 8) for i, t, lang in rows], SCHEMA)


def plain_runs(words):
    """Every maximal stretch by trying every period from the left."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted((s, k, q) for s, k, q in out if not any(r < q and t <= s and t + m >= s + k for t, m, r in out))


def hashed(words):
    return np.array([int.from_bytes(hashlib.sha256(w.encode()).digest()[:8], "little") for w in words], dtype=np.uint64)


def found(texts):
    words = [w for t in texts for w in t]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    rows = runs.find_runs(hashed(words), first)
    return [sorted(tuple(int(v) for v in r[1:]) for r in rows if r[0] == i) for i in range(len(texts))]


def awkward_words(rng, n):
    kind = rng.randrange(4)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        out = []
        while len(out) < n:
            block = [rng.choice("abcdef") for _ in range(rng.randrange(1, 12))]
            out += block * rng.randrange(1, 8) + block[: rng.randrange(len(block))]
        return out[:n]
    if kind == 2:
        p = rng.randrange(1, max(2, n // 3))
        return [f"w{i % p}" for i in range(n)]
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_equal_a_plain_search():
    rng = random.Random(3)
    for _ in range(60):
        texts = [awkward_words(rng, rng.randrange(0, 120)) for _ in range(rng.randrange(1, 12))]
        assert found(texts) == [plain_runs(t) for t in texts]


def test_long_blocks_are_compared_in_pieces(monkeypatch):
    monkeypatch.setattr(runs, "MOST_BLOCK", 4)
    monkeypatch.setattr(runs, "CELLS", 64)
    rng = random.Random(5)
    for _ in range(30):
        texts = [awkward_words(rng, rng.randrange(0, 300)) for _ in range(3)]
        assert found(texts) == [plain_runs(t) for t in texts]


def test_one_word_very_often_and_very_long_periods():
    assert found([["x"] * 50_000]) == [[(0, 50_000, 1)]]
    many = [f"w{i % 12_500}" for i in range(50_000)]
    assert found([["y", *many]]) == [[(1, 50_000, 12_500)]]
    assert found([["y", *many[:-1]]]) == [[]]


def test_transforms_give_exact_correlations():
    rng = np.random.default_rng(2)
    for width in (2, 8, 64):
        values = rng.integers(0, 3, 400).astype(np.int64) * 30_000
        squares = np.concatenate([[0], np.cumsum(values * values)])
        starts = np.arange(0, 100, width)
        block, distance = runs.zero_distances(values, squares, starts, width, 5)
        got = set(zip(block.tolist(), distance.tolist(), strict=True))
        for i, s in enumerate(starts):
            for d in range(width + 1):
                total = int(((values[s : s + width] - values[s + 5 + d : s + 5 + d + width]) ** 2).sum())
                assert ((i, d) in got) == (total % runs.PRIME == 0)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    out = [" ".join(awkward_words(rng, rng.randrange(1, 90))) for _ in range(40)]
    odd = ["", None, " \n\t ", "one", "ein Wort 　  zwei", "é è " * 9, "the the  the\nthe the the the", "a<P>b c", "x <S>", "<M>", "日本 語" * 7, "<P", "S>", "🙂 ok 🙂 ok 🙂 ok 🙂 ok 🙂", "İı word", "word " * 30_000, "z" * 100_000]
    return out + odd


@pytest.fixture(scope="module")
def rows(texts):
    out = [(i * 7, t, [None, "aa", "bb"][i % 3]) for i, t in enumerate(texts)]
    return out + [out[3], out[3], (None, texts[0], "aa"), (None, None, None)]


def test_periodic_runs_of_awkward_rows(spark, rows):
    got = sorted(runs.periodic_runs(table(spark, rows).repartition(5)).collect(), key=str)
    want = []
    for i, t, _ in rows:
        words = WORDS.findall(t or "")
        own = plain_runs(words) if len(set(words)) > 1 or len(words) < 6 else [(0, len(words), 1)]
        gone = {k for s, n, q in own for k in range(s + q, s + n)}
        want.append((i, len(words), own, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == sorted(want, key=lambda x: str(next(r for r in got if (r.doc_id, r.n_words, [tuple(v) for v in r.runs], r.collapsed) == x)))
    assert runs.periodic_runs(table(spark, [])).count() == 0
    assert runs.periodic_runs(table(spark, rows), texts=False).where("collapsed is not null").count() == 0


def test_planted_periods_follow_the_id(spark, rows):
    got = {r.doc_id: r.text for r in with_planted_periods(table(spark, [r for r in rows if r[0] is not None])).collect()}
    for i, t, _ in rows:
        if i is None:
            continue
        words, h = WORDS.findall(t or ""), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert got[i] == " ".join(words[k] if k < a else words[a + (k - a) % p] for k in range(n))
        else:
            assert got[i] == t


def plain_form(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_forms_equal_slices_and_come_back(spark, rows):
    forms = fill_middle.restore(fill_middle.arrange(table(spark, rows).repartition(5)))
    got = sorted((tuple(r) for r in forms.collect()), key=str)
    assert got == sorted(((i, *plain_form(i, t or ""), t or "") for i, t, _ in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.arrange(table(spark, [])).count() == 0


def test_small_flushes_lose_no_row(monkeypatch):
    monkeypatch.setattr(fill_middle, "FLUSH_BYTES", 50)
    flushed = list(fill_middle._flushed(((i, b"a" * (i % 70)) for i in range(200)), ["i", "t"], [pa.int64(), pa.string()], lambda r: len(r[1])))
    assert [x for b in flushed for x in b.column("i").to_pylist()] == list(range(200))
    assert all(b.num_rows == 1 or sum(map(len, b.column("t").to_pylist())) <= 50 for b in flushed)


def test_restore_refuses_other_forms_and_keeps_nulls(spark):
    kept = fill_middle.restore(spark.createDataFrame([(None, "x"), ("plain", None), ("plain", "y")], "form string, output string"))
    assert [r.restored for r in kept.collect()] == [None, None, "y"]
    with pytest.raises(Exception, match="unknown form"):
        fill_middle.restore(spark.createDataFrame([("other", "x")], "form string, output string")).collect()


def test_rotation_exchanges_blocks_of_any_length():
    for a in range(7):
        for b in range(7):
            buffer = bytearray(range(a + b + 4))
            fill_middle.rotate(buffer, 2, 2 + a, 2 + a + b)
            assert list(buffer) == [0, 1, *range(2 + a, 2 + a + b), *range(2, 2 + a), 2 + a + b, 3 + a + b]


SYLLABLES = {"aa": "ka to mi ru sen dai", "bb": "sch ung ein ver heit ö", "cc": "ción que el los ñ ar", "dd": "th ing er on and wh", "ee": "ски ова но при ть я", "ff": "的 是 了 在 人 有", "gg": "ij oe aan een het sch"}


def speech(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.mark.parametrize("names", [["aa"], ["aa", "bb"], ["aa", "bb", "cc", "dd"], list(SYLLABLES)])
def test_languages_of_unseen_texts(spark, names):
    rng = random.Random(9)
    rows = [(i, speech(rng, lang, rng.randrange(4, 60)), lang) for i, lang in enumerate(names * 30)]
    model = languages.fit(table(spark, rows), bound=25 * len(names))
    unseen = [(i, speech(rng, lang, 12), lang) for i, lang in enumerate(names * 20)]
    got = {r.doc_id: r for r in languages.predict(table(spark, unseen).repartition(3), model).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang in unseen]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    mixed = [(i, speech(rng, names[0], 40) + " " + speech(rng, names[-1], 40), None) for i in range(20)]
    if len(names) > 1:
        sure = np.mean([r.score for r in got.values()])
        assert np.mean([r.score for r in languages.predict(table(spark, mixed), model).collect()]) < sure


def test_undecided_texts_and_empty_tables(spark, rows):
    model = languages.fit(table(spark, rows))
    got = languages.predict(table(spark, rows), model).collect()
    assert len(got) == len(rows)
    odd = languages.predict(table(spark, [(1, None, "aa"), (2, "", None), (3, "12 34 -- 🙂", None), (4, "é", None)]), model).collect()
    assert [r.lang_pred == "und" for r in sorted(odd, key=lambda r: r.doc_id)] == [True, True, True, False]
    assert languages.predict(table(spark, []), model).count() == 0
    nothing = languages.fit(table(spark, []))
    assert [(r.lang_pred, r.score) for r in languages.predict(table(spark, [(1, "text", None)]), nothing).collect()] == [("und", 0.0)]


def test_codewords_differ_in_every_column():
    for k in (2, 3, 5, 6, 12, 40):
        codes = languages.codewords(k)
        assert len({tuple(c) for c in codes.T}) == codes.shape[1] == len({tuple(c) for c in codes.T} - {tuple(-c) for c in codes.T})
        assert (np.abs(codes.sum(axis=0)) < k).all()
        assert len({tuple(r) for r in codes}) == k


def test_gram_counts_of_pieces_equal_those_of_whole_texts(monkeypatch):
    rng = random.Random(1)
    column = pa.array([speech(rng, lang, 30) + " 12; ok" for lang in SYLLABLES] + ["", None, "a", "-"])
    whole = np.concatenate([x for _, _, x in languages.features(column)])
    monkeypatch.setattr(languages, "PIECE_BYTES", 7)
    assert np.allclose(whole, np.concatenate([x for _, _, x in languages.features(column)]))
    # a text's features are its own, whatever stands beside it
    alone = np.concatenate([next(languages.features(column[i : i + 1]))[2] for i in range(len(column))])
    assert np.allclose(whole, alone)


def test_held_out_languages_of_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = QUERIES["op11_languages"](spark, "/root/testdata/sf0.001").join(docs.select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("share")).first()["share"]
    assert right >= 0.95
