"""WARC archives: written as gzip files through Spark, read back record by record, assembled by transaction.

Each capture makes three records: the request, the response (or a revisit of an equal payload) and a
metadata record. Request and metadata name the response in WARC-Concurrent-To, and assembly brings the
three together through it into one nested row. A file is what Spark's text writer makes of records in
order: the line separator is the blank line that ends a record, so files are plain WARC 1.1 in one gzip
member on any file system that Spark writes to, and a lost task leaves no half file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandtide.llm.common import map_batches
from strandtide.llm.near_dups import components
from strandtide.runtime import cut_lineage, drop_stored

END = "\r\n\r\n"
RECORDS_PER_FILE = 1536
RECORDS_PER_BATCH, BYTES_PER_BATCH = 256, 16 << 20
_CAPTURE = ["page_id", "url", "payload_digest", "payload_bytes"]


def originals(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """One row for each distinct (page_id, url, html) of `pages`: those columns' values, `copies`, `original`.

    The payload is the html in UTF-8, null as empty. Of rows whose payloads are equal and have at least
    `least_bytes` bytes, the one with the largest page_id (null smallest, then by url) is the original, and
    `original` (page_id p, url u) names it in each of them; it is null where a payload is smaller or occurs
    once. Equal rows are counted, not compared. Only digests and ids meet by payload; texts are shuffled
    once, by row.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.sha1(payload).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        payload.alias("payload"),
    )
    lean = cut_lineage(base.where(F.col("payload_bytes") >= least_bytes).groupBy(*_CAPTURE).agg(F.count(F.lit(1)).alias("copies")))
    place = F.struct(F.col("page_id").alias("p"), F.col("url").alias("u"))
    groups = lean.groupBy("payload_digest").agg(F.max(place).alias("original"), F.sum("copies").alias("n")).where("n > 1").drop("n")
    known = lean.drop("copies").join(cut_lineage(groups), "payload_digest").select("original", *[F.col(c).alias(f"k_{c}") for c in _CAPTURE])
    rows = base.groupBy(*_CAPTURE).agg(F.first("payload").alias("payload"), F.count(F.lit(1)).cast("int").alias("copies"))
    same = [rows[c].eqNullSafe(F.col(f"k_{c}")) for c in _CAPTURE]
    return rows.join(known, same[0] & same[1] & same[2] & same[3], "left").select(rows["*"], "original")


def _record(kind: Column, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its closing blank line; header lines without a value are left out."""
    lines = [F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: <"), record_id, F.lit(">\r\n")]
    for name, value in headers:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    lines += [F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END)]
    return F.concat(F.concat(*lines).cast("binary"), block)


def _name(page: Column, url: Column, copy: Column) -> Column:
    return F.concat_ws(":", F.lit("urn:capture"), F.coalesce(page.cast("string"), F.lit("none")), F.sha1(F.coalesce(url, F.lit("\0")).cast("binary")), F.col("payload_digest"), copy.cast("string"))


def records(captures: DataFrame) -> DataFrame:
    """Request, response or revisit, and metadata record of each row of `captures`, in the column `record`."""
    uri = F.nullif(F.trim(F.regexp_replace("url", r"\s+", " ")), F.lit(""))
    bracket = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    one = captures.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    # copy 0 of the original row is the response of its payload
    is_original = F.col("original.p").eqNullSafe(F.col("page_id")) & F.col("original.u").eqNullSafe(F.col("url")) & (F.col("copy") == 0)
    one = one.withColumn("own_id", _name(F.col("page_id"), F.col("url"), F.col("copy"))).withColumn(
        "first_id", F.when(F.col("original").isNotNull() & ~is_original, _name(F.col("original.p"), F.col("original.u"), F.lit(0)))
    )
    again = F.col("first_id").isNotNull()
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END).cast("binary")
    answer = _record(
        F.when(again, "revisit").otherwise("response"),
        F.col("own_id"),
        [
            ("WARC-Target-URI", uri),
            ("WARC-Refers-To", bracket(F.col("first_id"))),
            ("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            ("Payload-Length", F.col("payload_bytes").cast("string")),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(again, http).otherwise(F.concat(http, F.col("payload"))),
    )
    concurrent = ("WARC-Concurrent-To", bracket(F.col("own_id")))
    request = _record(
        F.lit("request"),
        F.concat("own_id", F.lit(":request")),
        [("WARC-Target-URI", uri), concurrent, ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1" + END)).cast("binary"),
    )
    field = lambda name, c: F.coalesce(F.concat(F.lit(f"{name}: "), c.cast("string"), F.lit("\r\n")), F.lit(""))
    facts = F.concat(field("page-id", F.col("page_id")), field("refers-to-page-id", F.when(again, F.col("original.p"))))
    metadata = _record(
        F.lit("metadata"), F.concat("own_id", F.lit(":metadata")), [("WARC-Target-URI", uri), concurrent, ("Content-Type", F.lit("application/warc-fields"))], facts.cast("binary")
    )
    return one.select(F.explode(F.array(request, answer, metadata)).alias("record"))


def write(pages: DataFrame, path: str, least_bytes: int = 1000, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Writes `pages` (page_id, url, html) as WARC files below `path`, at most `records_per_file` records in each."""
    lines = records(originals(pages, least_bytes)).select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


class _Unpacked:
    """A gzip file of any number of members as a stream. What was unpacked before a damaged place is given out before the exception."""

    CHUNK, PIECE = 1 << 16, 1 << 18

    def __init__(self, content: bytes):
        self._content, self._at, self._member = content, 0, None
        self._held, self._from, self._fault = bytearray(), 0, None

    def _unpacked(self) -> bytes:
        """A little more, nothing at the end."""
        while True:
            if self._member is None:
                # zeros may fill a file up
                while self._content[self._at : self._at + 1] == b"\0":
                    self._at += 1
                if self._at >= len(self._content):
                    return b""
                self._member = zlib.decompressobj(31)
            chunk = self._content[self._at : self._at + self.CHUNK]
            if not chunk:
                raise EOFError("the file ends inside a gzip member")
            out = self._member.decompress(chunk, self.PIECE)
            left = self._member.unused_data if self._member.eof else self._member.unconsumed_tail
            self._at += len(chunk) - len(left)
            if self._member.eof:
                self._member = None
            if out:
                return out

    def _fill(self) -> bool:
        if self._fault is None:
            try:
                if out := self._unpacked():
                    if self._from > self.PIECE:
                        del self._held[: self._from]
                        self._from = 0
                    self._held += out
                    return True
            except (EOFError, zlib.error) as e:
                self._fault = e
        if self._fault is not None and self._from == len(self._held):
            raise self._fault
        return False

    def _given(self, stop: int) -> bytes:
        out = bytes(self._held[self._from : stop])
        self._from += len(out)
        return out

    def readline(self) -> bytes:
        looked = 0
        while (at := self._held.find(b"\n", self._from + looked)) < 0:
            looked = len(self._held) - self._from
            if not self._fill():
                return self._given(len(self._held))
        return self._given(at + 1)

    def read(self, size: int) -> bytes:
        while len(self._held) - self._from < size and self._fill():
            pass
        return self._given(self._from + size)


def opened(content: bytes):
    """The bytes of a file, plain or gzip of one or more members, as a stream; what is unpacked is never held as a whole."""
    return _Unpacked(content) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def header_fields(lines) -> dict[str, str]:
    """Names (lower case) and values of header lines in bytes. A line that begins with white space goes on from the one before, bytes
    that are no UTF-8 become a replacement sign, a line without colon is left out; ids of a repeated concurrent-to are joined by a blank."""
    found: dict[str, str] = {}
    name = None
    for line in lines:
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and name is not None:
            found[name] = f"{found[name]} {text.strip()}".strip()
            continue
        name, colon, value = text.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            name = None
        elif name == "warc-concurrent-to" and name in found:
            found[name] += f" {value.strip()}"
        else:
            found[name] = value.strip()
    return found


def entries(stream, strict: bool = False):
    """(headers, block, error) of each record of a stream; lengths come from Content-Length alone.

    What is no record gives one row with an error and the search goes on at the next line that begins a record: bytes outside
    records, a record without a length, the end of a file that was cut, a damaged gzip member (after which nothing can be
    read). `strict` makes these exceptions. One record is held at a time.
    """
    line, headers = b"", {}
    try:
        while True:
            while line in (b"", b"\r\n", b"\n"):
                line = stream.readline()
                if not line:
                    return
            headers = {}
            if not line.startswith(b"WARC/"):
                if strict:
                    raise ValueError(f"no record: {line[:20]!r}")
                skipped = 0
                while line and not line.startswith(b"WARC/"):
                    skipped += len(line)
                    line = stream.readline()
                yield {}, None, f"{skipped} bytes outside records"
                continue
            lines = []
            while (line := stream.readline()) not in (b"", b"\r\n", b"\n"):
                lines.append(line)
            headers = header_fields(lines)
            length = headers.get("content-length", "")
            if not line:
                raise EOFError("the file ends inside a header")
            if not length.isascii() or not length.isdigit():
                if strict:
                    raise ValueError("a record without a length")
                yield headers, None, "no length"
                line = stream.readline()
                while line and not line.startswith(b"WARC/"):
                    line = stream.readline()
                continue
            block = stream.read(int(length))
            if len(block) < int(length):
                raise EOFError("the file ends inside a record")
            yield headers, block, None
            line = b""
    except (EOFError, zlib.error) as e:
        if strict:
            raise
        yield headers, None, f"{e}"


def parse(content: bytes):
    """(headers, block) of each record of one file; anything that is no record is an exception."""
    for headers, block, _ in entries(opened(content), strict=True):
        yield headers, block


_COLUMNS = ["transaction", "record_id", "concurrent_to", "record_type", "refers_to", "target_uri", "payload_digest", "payload_bytes", "intact", "fields", "block", "error"]
_SCHEMA = "transaction string, record_id string, concurrent_to array<string>, record_type string, refers_to string, target_uri string, payload_digest string, payload_bytes long, intact boolean, fields map<string, string>, block binary, error string"
_TYPES = pa.schema(
    [
        (c, t)
        for c, t in zip(_COLUMNS, [pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 4, pa.int64(), pa.bool_(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.string()], strict=True)
    ]
)


def _digest(said: str | None) -> str | None:
    """A SHA-1 as a header gives it, in hex; base 32 is usual, too. None for other kinds."""
    kind, _, value = (said or "").rpartition(":")
    if kind.lower() not in ("", "sha1", "sha-1"):
        return None
    if len(value) == 32:
        try:
            return base64.b32decode(value.upper()).hex()
        except ValueError:
            return None
    return value.lower() or None


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP head; the whole block of a response that has none, such as a DNS record."""
    kind = headers.get("content-type", "")
    if not (kind.lower().startswith("application/http") or (not kind and block.startswith(b"HTTP/"))):
        return block
    at = block.find(b"\r\n\r\n")
    if at >= 0:
        return block[at + 4 :]
    at = block.find(b"\n\n")
    return block[at + 2 :] if at >= 0 else b""


def _row(headers: dict[str, str], block: bytes | None, error: str | None) -> tuple:
    plain = lambda name: headers[name].strip("<> ") if name in headers else None
    concurrent = [x.strip("<>") for x in headers.get("warc-concurrent-to", "").split()]
    kind, digest, size, intact, fields = headers.get("warc-type", "").lower() or None, None, None, None, None
    if error is None and kind is None:
        error = "no type"
    if kind in ("response", "revisit") and block is not None:
        said, length = headers.get("warc-payload-digest"), headers.get("payload-length", "")
        size = int(length) if length.isascii() and length.isdigit() else None
        digest = _digest(said)
        if kind == "response":
            payload = _payload(headers, block)
            own = hashlib.sha1(payload).hexdigest()
            # nothing is said of other kinds of digests
            intact = None if said and digest is None else digest == own and size in (None, len(payload))
            digest, size = own, len(payload)
        else:
            intact = True
    elif kind == "metadata" and block is not None:
        fields = list(header_fields(x for x in block.split(b"\n") if x.strip()).items())
    return (concurrent[0] if concurrent else plain("warc-record-id")), plain("warc-record-id"), concurrent, kind, plain("warc-refers-to"), headers.get("warc-target-uri"), digest, size, intact, fields, block, error


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all files below `path`, one row each. Digest and length of a response are those of the payload
    as read; `intact` says whether its headers agree (null for digests that are not SHA-1). Those of a revisit are what its headers
    say of the full payload. What is no record is a row with an `error` (see `entries`); nothing ends the job.

    A task holds a file as it is stored, at most 2 GB, and one record of it.
    """

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for entry in entries(opened(content.as_py())):
                    held.append(_row(*entry))
                    size += len(entry[1] or b"")
                    if len(held) == RECORDS_PER_BATCH or size > BYTES_PER_BATCH:
                        yield pa.RecordBatch.from_pylist([dict(zip(_COLUMNS, r, strict=True)) for r in held], schema=_TYPES)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist([dict(zip(_COLUMNS, r, strict=True)) for r in held], schema=_TYPES)

    return map_batches(spark.read.format("binaryFile").load(path).select("content"), run, _SCHEMA)


def connected(pointers: DataFrame) -> DataFrame | None:
    """(id, transaction) of ids that one step of concurrent-to does not bring together; None if there are none.

    `pointers` has record_id and target. In the usual case requests and metadata name a response that names nobody, and every
    target is its transaction. Ids that name others and are named, or name several, are connected as far as it goes.
    """
    roles = pointers.select(F.col("record_id").alias("id"), F.lit(1).alias("names"), F.lit(0).alias("named")).union(pointers.select("target", F.lit(0), F.lit(1)))
    odd = cut_lineage(roles.groupBy("id").agg(F.sum("names").alias("names"), F.sum("named").alias("named")).where("names > 1 or (names > 0 and named > 0)").select("id"))
    if odd.isEmpty():
        drop_stored(odd)
        return None
    near = pointers.join(odd.select(F.col("id").alias("record_id")), "record_id", "left_semi").union(pointers.join(odd.select(F.col("id").alias("target")), "target", "left_semi").select("record_id", "target"))
    edges = near.select(F.least("record_id", "target").alias("a"), F.greatest("record_id", "target").alias("b"))
    return components(edges).select(F.col("node").alias("id"), F.col("label").alias("transaction"))


def assemble(found: DataFrame, blocks: bool = True) -> DataFrame:
    """One nested row for each capture: `transaction`, `response`, `request`, `metadata`.

    Records meet through concurrent-to ids, whoever names whom: those that one step brings together in one shuffle, chains and
    records that name each other through `connected`. A part that is missing is null; of several the one with the
    smallest id is taken. Records about a file (warcinfo) and rows with an error are no capture. `blocks=False` leaves the
    records' contents out of it and reads the archives once.
    """
    keep = [c for c in _COLUMNS if c not in ("transaction", "concurrent_to", "error") and (blocks or c != "block")]
    records_ = found.where("record_type <> 'warcinfo' and error is null").select("transaction", "concurrent_to", *keep)
    if not blocks:
        records_ = cut_lineage(records_)
    pointers = cut_lineage(records_.where("record_id is not null").select("record_id", F.explode(F.array_distinct("concurrent_to")).alias("target")).where("target <> record_id"))
    met = connected(pointers)
    drop_stored(pointers)
    if met is not None:
        own = met.select(F.col("id").alias("record_id"), F.col("transaction").alias("_own"))
        named = met.select(F.col("id").alias("transaction"), F.col("transaction").alias("_named"))
        both = records_.join(own, "record_id", "left").join(named, "transaction", "left")
        records_ = both.select(F.coalesce("_own", "_named", "transaction").alias("transaction"), *keep)
    part = lambda *kinds: F.min_by(F.struct(*keep), F.when(F.col("record_type").isin(*kinds), F.coalesce("record_id", F.lit(""))))
    whole = records_.groupBy("transaction").agg(part("response", "revisit").alias("response"), part("request").alias("request"), part("metadata").alias("metadata"))
    return whole.where("transaction is not null")
