"""Archives as crawlers write them, and test items in any script and of any length."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

from strandtide.llm import decontaminate, warc


def record(kind, name, body, *more, length=None):
    lines = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <" + name + b">", *more]
    if length is not False:
        lines.append(b"Content-Length: %d" % (len(body) if length is None else length))
    return b"\r\n".join(lines) + b"\r\n\r\n" + body + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"


def rows_of(spark, tmp_path, *files):
    for i, content in enumerate(files):
        (tmp_path / f"{i}.warc").write_bytes(content)
    return warc.read(spark, str(tmp_path))


def test_records_without_http_and_odd_headers(spark, tmp_path):
    sha32 = base64.b32encode(hashlib.sha1(b"page").digest())
    made = [
        record(b"response", b"dns", b"20240101\r\na.example. 60 IN A 192.0.2.1\r\n", b"Content-Type: text/dns", b"WARC-Target-URI: dns:a.example"),
        record(b"response", b"http", HTTP + b"page", b"Content-Type: application/http; msgtype=response", b"WARC-Payload-Digest: sha1:" + sha32),
        record(b"response", b"md5", HTTP + b"page", b"WARC-Payload-Digest: md5:abc"),
        record(b"response", b"headless", b"HTTP/1.1 204 No Content\r\n", b"Content-Type:application/http"),
        record(b"Metadata", b"meta", b"via:http://a/\r\nfolded: one\r\n  two\r\nbyte: \xff\r\nno colon\r\n\r\n", b"WARC-Concurrent-To:<http>"),
        record(b"request", b"folded", b"GET / HTTP/1.1\r\n\r\n", b"WARC-Concurrent-To:", b"\t<http>", b"X: \xe9"),
        record(b"resource", b"file", b"\0\1\2"),
    ]
    found = {r.record_id: r for r in rows_of(spark, tmp_path, b"".join(made), b"".join(map(gzip.compress, made))).where("error is null").collect()}
    assert found["dns"].payload_bytes == len(b"20240101\r\na.example. 60 IN A 192.0.2.1\r\n") and found["headless"].payload_bytes == 0
    assert found["http"].intact and found["http"].payload_digest == hashlib.sha1(b"page").hexdigest()
    assert found["md5"].intact is None and found["md5"].payload_bytes == 4
    assert found["meta"].fields == {"via": "http://a/", "folded": "one two", "byte": "�"} and found["meta"].transaction == "http"
    assert found["folded"].transaction == "http" and found["file"].record_type == "resource"


def test_damaged_files_give_rows_with_errors(spark, tmp_path):
    fine = record(b"response", b"fine", HTTP + b"x")
    nolength = record(b"response", b"long", b"body\r\nmore", length=False)
    cut = record(b"response", b"cut", HTTP + b"y" * 500)[:-300]
    members = b"".join(map(gzip.compress, (fine, fine.replace(b"fine", b"late"))))
    files = [b"junk before\r\n" + fine, nolength + fine, fine + cut, fine + b"WARC/1.1\r\nWARC-Type: resp", members[:-20], record(b"", b"typeless", b"z"), b"", b"\r\n\r\n"]
    got = rows_of(spark, tmp_path, *files).collect()
    assert sum(r.record_id == "fine" and r.error is None for r in got) == 5
    errors = sorted(r.error for r in got if r.error)
    assert len(errors) == 6 and any("outside" in e for e in errors) and "no length" in errors and "no type" in errors
    assert sum("ends" in e or "ended" in e for e in errors) == 3
    assert warc.assemble(rows_of(spark, tmp_path)).where("response is not null").count() == 1


def test_one_record_is_held_at_a_time():
    class Counting(io.BytesIO):
        most = 0

        def read(self, size=-1):
            Counting.most = max(Counting.most, size)
            assert size >= 0
            return super().read(size)

    content = b"".join(record(b"response", b"r%d" % i, HTTP + b"p" * 1000) for i in range(300))
    assert sum(1 for _ in warc.entries(Counting(content))) == 300 and Counting.most < 1100


def test_records_that_name_each_other_and_chains(spark, tmp_path):
    to = lambda *names: [b"WARC-Concurrent-To: <" + n + b">" for n in names]
    made = []
    for i in range(5):
        n = lambda kind: kind + b"%d" % i  # noqa: B023, E731
        made += [record(b"response", n(b"a"), HTTP + b"1", *to(n(b"b"))), record(b"request", n(b"b"), b"GET", *to(n(b"a"))), record(b"metadata", n(b"c"), b"k: 1", *to(n(b"b")))]
        made += [record(b"response", n(b"d"), HTTP + b"2"), record(b"request", n(b"e"), b"GET", *to(n(b"d"))), record(b"metadata", n(b"f"), b"k: 2", *to(n(b"e")))]
        made += [record(b"response", n(b"g"), HTTP + b"3"), record(b"request", n(b"h"), b"GET", *to(n(b"g"))), record(b"metadata", n(b"i"), b"k: 3", *to(n(b"h"), n(b"g")))]
        made += [record(b"response", n(b"j"), HTTP + b"4"), record(b"request", n(b"k"), b"GET", *to(n(b"j"))), record(b"metadata", n(b"l"), b"k: 4", *to(n(b"j"))), record(b"metadata", n(b"m"), b"k: 5", *to(n(b"j")))]
    for blocks in (True, False):
        got = warc.assemble(rows_of(spark, tmp_path, b"".join(made)), blocks).collect()
        assert len(got) == 20
        parts = sorted((r.response.record_id, r.request.record_id, r.metadata.record_id) for r in got)
        assert parts == sorted((f"{a}{i}", f"{b}{i}", f"{c}{i}") for i in range(5) for a, b, c in ("abc", "def", "ghi", "jkl"))


ITEMS = [
    (1, "Don't panic, said the guide: “always know where your towel is” — every time."),
    (2, "who wrote hamlet"),
    (3, "今天的天气非常好我们去公园散步吧"),
    (4, "Ἄνδρα μοι ἔννεπε μοῦσα πολύτροπον ὃς μάλα πολλὰ"),
    (5, "solo"),
    (6, "…—“”"),
    (7, None),
    (8, "สวัสดีครับผม"),
]


def test_items_in_any_script_and_of_any_length(spark):
    texts = {
        1: "He read: don’t panic—said the guide… 'always know where your towel is', every time! And so on.",
        2: "The question was: Who wrote “Hamlet”?",
        3: "他说，今天的天气非常好，我们去公园散步吧！然后走了。",
        4: "ἄνδρα μοι ἔννεπε, Μοῦσα, πολύτροπον, ὃς μάλα πολλὰ πλάγχθη",
        5: "Han shot first; solo.",
        6: "who wrote about hamlet and so lo — 今天的天气不好",
        7: None,
        8: "",
        9: "ก่อน สวัสดีครับผม หลัง",
        10: "wrote hamlet who",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_item, r.n_found) for r in decontaminate.contained(docs, items).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (9, 8)}
    assert got[2, 2] == (1, 1) and got[3, 3] == (12, 12)
    assert sorted(r.doc_id for r in decontaminate.without_items(docs, items).collect()) == [6, 7, 8, 10]
