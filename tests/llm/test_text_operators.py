"""Operators against plain versions, on rows with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import collections
import gzip
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandtide.llm import common, decontaminate, fingerprints, mixing, near_dups, quality, secrets, sharding, substrings, token_files, warc
from strandtide.llm.queries import thirds, tokenizer_definition
from strandtide.runtime import fresh_path

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use inside themselves.
CLASHES = ("row", "node", "size", "shard", "slot", "target", "copies", "taken", "score", "part", "kind", "tie", "hash", "item", "bucket", "doc", "a.b", "_text", "turn")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASHES)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def some_texts():
    rng = random.Random(4)
    base, other, long = prose(rng, 120), prose(rng, 70), prose(rng, 30_000, 5000)
    near = base.split()
    near[60] = "changed"
    nearer = near.copy()
    nearer[100] = "again"
    texts = [base, " ".join(near), " ".join(nearer), base, other, other + " " + prose(rng, 200), prose(rng, 60) + "\n" + other, long, long + " tail", "", None, "  \n", "one", "one two", "One TWO", "one two three", "é è", "x" * 5000]
    return texts + [prose(rng, rng.randrange(1, 90)) for _ in range(40)] + ["same few words here " * 30] * 3 + ["same few words here " * 31]


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, *[None] * len(CLASHES)) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    texts = some_texts()
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    out = [(i * 3, texts[k], [None, "b", "a", "c", "b"][k % 5]) for i, k in enumerate(order)]
    out += [out[4], out[4], (None, texts[0], "a"), (None, "no id here at all", None), (None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [])


def sets_of(text, n):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def plain_components(rows, n, percent):
    sets = [sets_of(t, n) for _, t, *_ in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    ids = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(r[0], len(sets[i]), ids[find(i)]) for i, r in enumerate(rows)]


def key(t):
    return tuple((x is None, x) for x in t)


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, rows, n, percent):
    got = near_dups.near_duplicates(docs, n, percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((tuple(r)[:3] for r in got), key=key) == sorted(plain_components(rows, n, percent), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_large_buckets(spark, monkeypatch):
    """Chains and clusters in which the first class of a bucket is not like all others, over several blocks."""
    monkeypatch.setattr(near_dups, "BLOCK_CLASSES", 16)
    rng = random.Random(9)
    made = []
    for c in range(3):
        words = [f"c{c}x{i}" for i in range(120)]
        for _ in range(45):
            words = words.copy() if rng.random() < 0.7 else made[rng.randrange(len(made))][:]
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(120)] = f"r{rng.randrange(10**6)}"
            made.append(words)
    made_rows = [(i, " ".join(w), "s") for i, w in enumerate(made)]
    rng.shuffle(made_rows)
    got = near_dups.near_duplicates(table(spark, made_rows), 3, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(plain_components(made_rows, 3, 85))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = {r.node: r.label for r in near_dups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == len({got[i] for i in range(1000, 1050)}) == len({got[5000], got[5001]}) == 1
    assert len(set(got.values())) == 3


def test_keep_one(docs, rows):
    kept = near_dups.keep_one(docs, 3, 85)
    assert kept.columns == docs.columns
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    components = plain_components(rows, 3, 85)
    want = {(i, t) for (i, t, *_), (_, n, c) in zip(rows, components, strict=True) if n == 0 or c == i}
    assert set(got) == want
    assert all(n == 1 for (i, t), n in got.items() if sets_of(t, 3))


def test_shard(docs, rows):
    got = sharding.shard(docs, shards=7).select("doc_id", "size", "text_crc32", "shard", "slot", "text_key").collect()
    want = sorted((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows if r[0] is not None)
    assert sorted(tuple(r)[:3] for r in got if r.doc_id is not None) == want and len(got) == len(rows)
    places = collections.defaultdict(set)
    for r in got:
        places[bytes(r.text_key)].add(r.shard)
    assert all(len(x) == 1 for x in places.values())
    slots, loads = collections.defaultdict(list), collections.Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) == set(range(7))
    giant = max(collections.Counter({t: 0 for _, t, _ in rows}), key=lambda t: len(t or ""))
    rest = sorted(n for s, n in loads.items() if s not in places[hashlib.sha256(giant.encode()).digest()])
    assert rest[-2] <= 2.2 * rest[0] or len(rest) < 3


def test_shard_by_capacity(docs, rows):
    got = sharding.shard(docs, shards=None, capacity=20_000).groupBy("shard").agg(F.sum("size").alias("n"), F.countDistinct("text_key").alias("k")).collect()
    assert all(r.n <= 20_000 or r.k == 1 for r in got)


def test_mixing(docs, rows):
    got = mixing.mix(docs, thirds).select("doc_id", "size", "source", "source_size", "target", "taken").collect()
    size = lambda t: len(WORDS.findall(t or ""))
    totals = collections.Counter()
    for _, t, s in rows:
        totals[s] += size(t)
    weights = dict(zip(sorted(totals, key=lambda s: (s is None, s)), [3, 1, 2] * 9, strict=False))
    target, open_sources, left = {}, set(totals), 1.5 * sum(totals.values())
    while True:
        rate = left / sum(weights[s] for s in open_sources)
        full = [s for s in open_sources if rate * weights[s] > 2 * totals[s]]
        if not full:
            break
        for s in full:
            target[s] = 2.0 * totals[s]
            left -= target[s]
            open_sources.remove(s)
    target |= {s: rate * weights[s] for s in open_sources}
    longest = max(size(t) for _, t, _ in rows)
    taken = collections.Counter()
    for r in got:
        assert r.source_size == totals[r.source] and abs(r.target - target[r.source]) < 1e-6 * target[r.source]
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= longest for s in totals)
    assert sum(taken.values()) <= 1.5 * sum(totals.values())
    again = mixing.mix(docs.repartition(3), thirds).select("doc_id", "size", "source", "source_size", "target", "taken").collect()
    assert sorted(map(key, again)) == sorted(map(key, got))
    out = mixing.mixed(docs, thirds)
    assert out.columns == docs.columns
    counted = collections.Counter()
    for r in out.collect():
        counted[r.source] += size(r.text)
    assert counted == +taken


def windows_gone(rows, length):
    seen = collections.defaultdict(set)
    words = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, w in words:
        if i is not None:
            for k in range(len(w) - length + 1):
                seen[tuple(w[k : k + length])].add(i)
    out = []
    for i, w in words:
        bad = set()
        if i is not None:
            for k in range(len(w) - length + 1):
                if min(seen[tuple(w[k : k + length])]) < i:
                    bad.update(range(k, k + length))
        kept = b" ".join(x for k, x in enumerate(w) if k not in bad)
        out.append((i, len(w), len(bad), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=key)


@pytest.mark.parametrize("length", [50, 10, 3])
def test_remove_repeats(docs, rows, length):
    got = substrings.remove_repeats(docs, length).collect()
    assert sorted(map(tuple, got), key=key) == windows_gone(rows, length)


def test_automata_of_reference_shards(docs, rows):
    got = substrings.against_references(docs, docs, 10, shard_words=9000, earlier_only=True).collect()
    assert sorted(map(tuple, got), key=key) == windows_gone(rows, 10)


def test_contained_items(spark, rows):
    rng = random.Random(8)
    item = prose(rng, 30, 10**6).split()
    edited = item.copy()
    edited[15] = "zzz"
    hosts = {900: " ".join(item), 901: prose(rng, 20_000) + " " + ", ".join(item).upper() + ". " + prose(rng, 500), 902: " ".join(edited), 903: " ".join(item[:15])}
    all_rows = rows + [(i, t, "s") for i, t in hosts.items()]
    items = [(1, " ".join(item)), (2, " ".join(item)), (3, "too short"), (4, None), (None, prose(rng, 12)), (5, ""), (6, " ".join(f"w{k}" for k in range(20))), (1, " ".join(item))]
    benchmark = spark.createDataFrame([(i, t, 0, 0) for i, t in items], "item_id long, text string, row int, hash int")
    got = decontaminate.contained(table(spark, all_rows), benchmark).select("doc_id", "item_id", "n_item", "n_found").collect()
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    sets = lambda t: {tuple(w[k : k + 5]) for w in [split(t)] for k in range(len(w) - 4)}
    want = set()
    for i, t, *_ in all_rows:
        own = sets(t)
        for j, u in items:
            s = sets(u)
            if s and len(s & own) >= 0.8 * len(s):
                want.add((i, j, len(s), len(s & own)))
    assert sorted(map(tuple, got)) == sorted(want)
    assert {(900, 1), (901, 1), (901, 2), (902, 1)} <= {(a, b) for a, b, *_ in want} and not any(a == 903 for a, *_ in want)
    clean = decontaminate.without_items(table(spark, all_rows), benchmark)
    assert sorted(key((r.doc_id, r.text)) for r in clean.collect()) == sorted(key((i, t)) for i, t, *_ in all_rows if i not in (900, 901, 902))


def test_fingerprints(docs, rows):
    got = fingerprints.fingerprints(docs)
    found = collections.defaultdict(list)
    for r in got.collect():
        found[r.doc_id].append(r)
    assert sum(map(len, found.values())) == len(rows)
    names = {}
    known = sorted({(i, t or "") for i, t, *_ in rows if i is not None}, key=lambda x: x[0])
    single = [x for x in known if x[0] != rows[4][0]]
    errors = []
    weights = lambda t: {w: 1 + math.log(n) for w, n in collections.Counter(t.split()).items()}
    following = {a[0]: b[1] for a, b in zip(known, known[1:], strict=False)}
    for i, text in single:
        (r,) = found[i]
        assert r.n_chars == len(text) and names.setdefault(text, r.fingerprint) == r.fingerprint
        if i not in following:
            continue
        changed = fingerprints.edited(text, following[i])
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        for near, other in ((r.near_edited, changed), (r.near_next, following[i])):
            a, b = weights(text), weights(other)
            true = sum(min(a.get(w, 0), b.get(w, 0)) for w in {*a, *b}) / (sum(max(a.get(w, 0), b.get(w, 0)) for w in {*a, *b}) or 1) if a or b else 1.0
            errors.append(near - true)
    assert abs(np.mean(errors)) < 0.03 and np.sqrt(np.mean(np.square(errors))) < 0.09
    assert len(set(names.values())) >= len({t for _, t in single}) - 3


def test_fingerprints_of_one_document(spark):
    (r,) = fingerprints.fingerprints(table(spark, [(5, "ab cd ef gh", None)])).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"ab cd ef ab").hexdigest()


def test_token_files(spark, docs, rows):
    tokenizers = pytest.importorskip("tokenizers")
    definition = tokenizer_definition()
    library = tokenizers.Tokenizer.from_str(definition)
    path = fresh_path(spark, "tokens")
    token_files.write(docs, path, definition, 1, file_bytes=2000)
    got = token_files.with_starts(token_files.read(spark, path)).orderBy("start").collect()
    ids = {t: [*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t, *_ in rows}
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is None, x or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = sorted((r[0], len(ids[r[1]]), zlib.crc32(np.array(ids[r[1]], "<u4").tobytes())) for r in rows if r[0] is not None)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == want
    assert len({(r.part, r.number) for r in got}) > 4


def test_warc(spark):
    big, bigger = "b" * 999 + "é", "x\r\n\r\nWARC/1.1\r\n" * 100
    pages = [(1, "http://a/1", big), (7, "http://a/7", big), (3, None, big), (7, "http://a/0", big), (4, "u\r\nv", bigger), (5, "", "short"), (6, "s", "short"), (8, "n", None), (9, "e", ""), (None, "z", big), (10, "d", "y" * 2000), (10, "d", "y" * 2000), (11, "l", "é" * 300_000)]
    table = spark.createDataFrame([(*p, 0, 0) for p in pages], "page_id long, url string, html string, original int, copies int")
    path = fresh_path(spark, "warc")
    warc.write(table, path, records_per_file=7)
    found = warc.read(spark, path)
    assert found.where("record_type in ('response', 'revisit')").count() == len(pages) and found.count() == 3 * len(pages)
    got = warc.assemble(found).collect()
    assert len(got) == len(pages) and all(r.response.intact and r.request is not None for r in got)
    flat = lambda r: (r.metadata.fields.get("page-id"), r.response.payload_bytes, r.response.payload_digest, r.response.record_type, r.metadata.fields.get("refers-to-page-id"))
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = []
    for k, (page, _, html) in enumerate(pages):
        n = len((html or "").encode())
        first = {big: 1, "y" * 2000: 10}.get(html)
        again = first is not None and k != first
        want.append((None if page is None else str(page), n, sha(html), "revisit" if again else "response", ("7" if html == big else "10") if again else None))
    assert sorted(map(flat, got), key=key) == sorted(want, key=key)
    by_id = {r.transaction: r for r in got}
    for r in got:
        if r.response.record_type == "revisit":
            first = by_id[r.response.refers_to].response
            assert first.record_type == "response" and first.payload_digest == r.response.payload_digest
    bodies = {r.metadata.fields.get("page-id"): bytes(r.response.block) for r in got}
    assert bodies["4"].endswith(bigger.encode()) and bodies["11"].endswith(("é" * 300_000).encode())


def test_warc_read_finds_records_of_all_members(spark, tmp_path):
    record = lambda kind, name, more, body: f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\n{more}Content-Length: {len(body)}\r\n\r\n{body}\r\n\r\n".encode()
    for f in range(2):
        made = [record("warcinfo", f"w:{f}", "", "software: x\r\n")]
        for i in range(300):
            made.append(record("request", f"q:{f}:{i}", f"WARC-Concurrent-To: <r:{f}:{i}>\r\n", "GET / HTTP/1.1\r\n\r\n"))
            made.append(record("response", f"r:{f}:{i}", "WARC-Target-URI: http://a/\r\n", f"HTTP/1.1 200 OK\r\n\r\npage {i}"))
        (tmp_path / f"{f}.warc.gz").write_bytes(b"".join(map(gzip.compress, made)))
    found = warc.read(spark, str(tmp_path))
    assert {r.record_type: r["count"] for r in found.groupBy("record_type").count().collect()} == {"warcinfo": 2, "request": 600, "response": 600}
    got = warc.assemble(found).collect()
    assert len(got) == 600 and all(r.response is not None and r.request is not None for r in got)


def quality_rows():
    rng = random.Random(2)
    good = [prose(rng, rng.randrange(5, 120), 5000).capitalize() + "." for _ in range(150)]
    bad = [" ".join(w + rng.choice(["***", "$$$", "!!"]) for w in prose(rng, rng.randrange(5, 120), 5000).split()) for _ in range(150)]
    return [(i, t, y) for i, (t, y) in enumerate([(t, 1) for t in good] + [(t, 0) for t in bad])]


def test_quality(spark):
    made = quality_rows()
    docs = table(spark, [(i, t, "s") for i, t, _ in made] + [(1000, "", "s"), (1001, None, "s"), (None, "Some words.", None), (0, made[0][1], "s")])
    labels = spark.createDataFrame([(i, y, None) for i, _, y in made if i % 3] + [(1, None, None), (None, 1, None), (5555, 1, None), (4, 1, None)], "doc_id long, quality int, x int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model, ["doc_id", "row"]).collect()
    score = {r.doc_id: r.score for r in got}
    assert len(got) == len(made) + 4 and all(0 <= r.score <= 1 for r in got)
    held = [(score[i], y) for i, _, y in made if i % 3 == 0]
    assert sum((s >= 0.5) == y for s, y in held) / len(held) > 0.95
    assert score[1000] == score[1001]
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score >= quality.THRESHOLD for r in got)
    assert quality.fit(docs, labels, bound=50).total(np.zeros((1, quality.FEATURES), np.float32)).shape == (1,)


def test_quality_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels), []).collect()} == {0.5}


def test_secrets(spark):
    rng = random.Random(6)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    made, planted = [], set()
    for i in range(120):
        before, after = prose(rng, 10), prose(rng, 6)
        kind = i % 5
        value = [hexa(18), hexa(40), "AKIA" + "".join(rng.choice("ABCDEFGHIJ234567") for _ in range(16)), str(rng.randrange(10**15, 10**16)), "".join(rng.choice("THENOURSI") for _ in range(14))][kind]
        lead = [" password=", ' token = "', " ", " ", " "][kind]
        made.append((i, before + lead + value + ('"' if kind == 1 else "") + " " + after, "src/app.env"))
        if kind < 3:
            planted.add((i, len(before + lead), len(value)))
    docs = table(spark, made + [(500, None, None), (501, "", "x"), (None, "password=" + hexa(20), None)])
    findings = secrets.candidates(docs, secrets.dictionary(["there", "source"])).cache()
    got = secrets.scan(findings, secrets.fit(findings.where("doc_id % 2 = 0"))).collect()
    found = {(r.doc_id, r.start, r.length) for r in got if r.is_secret and r.doc_id is not None}
    assert found == planted and any(r.is_secret and r.doc_id is None for r in got)
    assert any(not r.is_secret for r in got)


def test_empty_tables(spark, nothing):
    assert near_dups.near_duplicates(nothing).count() == near_dups.keep_one(nothing).count() == 0
    assert sharding.shard(nothing).count() == sharding.shard(nothing, None, 100).count() == 0
    assert mixing.mix(nothing, thirds).count() == mixing.mixed(nothing, thirds).count() == 0
    assert substrings.remove_repeats(nothing).count() == substrings.against_references(nothing, nothing).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained(nothing, items).count() == decontaminate.without_items(nothing, items).count() == 0
    assert fingerprints.fingerprints(nothing).count() == 0
    pages, path = spark.createDataFrame([], "page_id long, url string, html string"), fresh_path(spark, "warc")
    warc.write(pages, path)
    assert warc.assemble(warc.read(spark, path)).count() == 0
    tokens = fresh_path(spark, "tokens")
    token_files.write(nothing, tokens, tokenizer_definition(), 1)
    assert token_files.with_starts(token_files.read(spark, tokens)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.keep_good(nothing, quality.fit(nothing, labels)).count() == 0
    findings = secrets.candidates(nothing, frozenset())
    assert secrets.scan(findings, secrets.fit(findings)).count() == 0


def test_documents_against_no_items_stay(spark, docs, rows):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.without_items(docs, items).count() == len(rows)


def test_bit_filter(spark):
    df = spark.createDataFrame([(x,) for x in (5, -7, None, 2**62)], "h long")
    cells = common.bit_filter(df, "h", 1 << 12)
    assert common.passes(cells, np.array([5, -7, 2**62, 6], np.int64).view(np.uint64)).tolist() == [True, True, True, False]
