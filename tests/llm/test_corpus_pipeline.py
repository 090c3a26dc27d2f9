"""The pipeline against a plain version of its five stages on a small corpus, and the queries' contracts."""

from __future__ import annotations

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_text_operators import WORDS, plain_components, prose

import corpus_pipeline
from strandtide.llm import quality
from strandtide.llm.queries import QUERIES, SQL, tokenizer_definition
from strandtide.runtime import shared_folder

tokenizers = pytest.importorskip("tokenizers")


def corpus():
    rng = random.Random(12)
    items = [(i, prose(rng, 25, 10**5)) for i in range(4)]
    texts = []
    for i in range(60):
        text = prose(rng, rng.randrange(8, 150), 3000).capitalize() + "."
        texts.append(text)
        if i % 6 == 0:
            words = text.split()
            words[len(words) // 2] = "edited"
            texts += [text, " ".join(words)]
        if i % 10 == 3:
            texts.append(text + " " + items[i % 4][1].upper() + ". " + prose(rng, 30, 3000))
        if i % 3 == 0:
            texts.append(" ".join(w + rng.choice(["***", "!!", "$$$"]) for w in prose(rng, 40, 3000).split()))
    texts += ["", None, "  ", "Two words."]
    rng.shuffle(texts)
    return [(i, t, "en", ["a", "b", None, "c"][i % 4], len(t or "")) for i, t in enumerate(texts)], items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, items = corpus()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(not re.search(r"[$*!]", t or "")), 0) for i, t, *_ in docs if i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def plain_mix(docs):
    """Documents in order of the queue, until the budget is used up."""
    size = lambda t: len(WORDS.findall(t or ""))
    totals = collections.Counter()
    for _, t, _, s, _ in docs:
        totals[s] += size(t)
    weight = dict(zip(sorted(totals, key=lambda s: (s is None, s)), [3, 1, 2] * 9, strict=False))
    target, left, free = {}, 1.5 * sum(totals.values()), set(totals)
    while full := [s for s in free if left / sum(weight[x] for x in free) * weight[s] > 2 * totals[s]]:
        target |= {s: 2.0 * totals[s] for s in full}
        left -= sum(2.0 * totals[s] for s in full)
        free -= set(full)
    target |= {s: left / sum(weight[x] for x in free) * weight[s] for s in free}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    queue, through = [], collections.Counter()
    for d in sorted(docs, key=lambda d: (md5(f"7|{d[0]}"), md5(d[1] or ""))):
        through[d[3]] += size(d[1])
        if size(d[1]):
            queue += [((through[d[3]] + p * totals[d[3]]) / target[d[3]], d[3] is not None, d[3] or "", d) for p in range(2)]
    out, used = [], 0
    for *_, d in sorted(queue, key=lambda q: q[:3]):
        used += size(d[1])
        if used > sum(target.values()):
            break
        out.append(d)
    return out


def test_stages_and_run(spark, folder):
    docs, items = corpus()
    model = quality.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    scores = quality.probability(model, quality.statistics(pa.array([d[1] for d in docs], pa.string())))
    good = [d for d, s in zip(docs, scores, strict=True) if s >= quality.THRESHOLD]
    assert {d[0] for d in docs} - {d[0] for d in good} >= {i for i, t, *_ in docs if "***" in (t or "") and "!!" in t}
    distinct = [d for d, (i, n, c) in zip(good, plain_components(good, 5, 80), strict=True) if n == 0 or i == c]
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    shingles = lambda t: {tuple(w[k : k + 5]) for w in [split(t)] for k in range(len(w) - 4)}
    unseen = [d for d in distinct if all(len(shingles(u) & shingles(d[1])) < 0.8 * len(shingles(u)) for _, u in items)]
    mixed = plain_mix(unseen)
    want = [good, distinct, unseen, mixed]
    assert [len(x) for x in want] == sorted([len(x) for x in want[:3]], reverse=True) + [len(mixed)] and len(unseen) < len(distinct) < len(good) < len(docs)
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns = now.columns
    for (_, stage), kept in zip(corpus_pipeline.STAGES[:4], want, strict=True):
        now = stage(spark, now, folder)
        assert now.columns == columns
        key = lambda r: tuple((x is None, x) for x in r)
        assert sorted(map(tuple, now.collect()), key=key) == sorted(map(tuple, kept), key=key)
    library = tokenizers.Tokenizer.from_str(tokenizer_definition())
    at, rows = 0, []
    for d in sorted(mixed, key=lambda d: d[0]):
        ids = [*library.encode(d[1] or "", add_special_tokens=False).ids, 1]
        rows.append((d[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    before = set(os.listdir(shared_folder(spark)))
    got = corpus_pipeline.run(spark, folder)
    # the token files and the result
    assert len(set(os.listdir(shared_folder(spark))) - before) == 2
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == rows


def test_there_is_a_query_for_each_operator():
    assert [re.match(r"op(\d+)_", name)[1] for name in sorted(QUERIES, key=lambda n: int(re.match(r"op(\d+)", n)[1]))] == [str(i) for i in range(1, 14)]
    assert set(SQL) <= set(QUERIES)


def test_queries_equal_their_sql(spark):
    from oracle import compare, connect

    folder = "/root/testdata/sf0.001"
    con = connect(folder)
    for name, sql in SQL.items():
        assert compare(spark, con, folder, name, QUERIES[name], sql) is None, name


def test_contract_columns(spark):
    folder = "/root/testdata/sf0.001"
    kinds = {
        "op1_sharding": [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")],
        "op2_quality": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
        "op4_warc": [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint")],
        "op5_fingerprints": [("doc_id", "bigint"), ("n_chars", "bigint"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")],
        "op6_mixing": [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")],
        "op7_substrings": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")],
        "op9_token_files": [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")],
        "op11_languages": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double"), ("ambiguous", "boolean")],
        "op12_periodic_runs": [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"), ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")],
        "op13_fill_middle": [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"), ("output_sha256", "string"), ("restored_sha256", "string")],
        "op10_near_duplicates": [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")],
    }
    for name, columns in kinds.items():
        assert QUERIES[name](spark, folder).dtypes == columns, name


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    scored = QUERIES["op2_quality"](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    good, bad = scored[scored.quality == 1].score, scored[scored.quality == 0].score
    assert len(good) > 20 and len(bad) > 5
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.95
    assert (good >= quality.THRESHOLD).mean() > 0.97
