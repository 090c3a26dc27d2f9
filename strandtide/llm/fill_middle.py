"""Fill-in-middle forms of whole texts, made by in-place block rotation and undone by its inverse.

Every text is handled as UTF-8 bytes. One scan finds the byte places of the code points and with them the
two cuts. The sentinels are inserted in front of the three parts of a bytearray, in reading order (prefix,
middle, suffix), and two neighbouring blocks then change places by three reversals: suffix and middle in
the form `psm`, the suffix and all before it in the form `spm`. Restoring finds the sentinels in the output, turns
the same rotation back and takes the sentinels out; it needs nothing but the output and its form.

A scan of the table without any shuffle. Batches leave a task by bytes, so memory is bounded by
FLUSH_BYTES and the longest text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandtide.llm.common import map_batches, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FLUSH_BYTES = 8 << 20


def rotate(buffer: bytearray, lo: int, mid: int, hi: int) -> None:
    """Exchange buffer[lo:mid] and buffer[mid:hi] in place: each block is reversed, then both together."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    for a, b in ((lo, mid), (mid, hi), (lo, hi)):
        half = (b - a) // 2
        left, right = view[a : a + half], view[b - half : b][::-1]
        kept = left.copy()
        left[:] = right
        right[:] = kept


def arranged(text: bytes, first: int, second: int, form: str) -> bytearray:
    """`text` with its cuts before the bytes `first` and `second` in one of the forms."""
    buffer = bytearray(text)
    if form == PLAIN:
        return buffer
    for place, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[place:place] = mark
    middle = first + len(PREFIX)
    suffix = second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return buffer


def restored(output: bytes, form: str) -> bytearray:
    """The text behind `output`: the rotation is turned back and the sentinels go. A plain output is the text."""
    buffer = bytearray(output)
    if form == PLAIN:
        return buffer
    if form not in (PSM, SPM):
        raise ValueError(f"unknown form {form!r}")
    suffix, later = buffer.index(SUFFIX), buffer.index(MIDDLE if form == PSM else PREFIX)
    rotate(buffer, suffix, later, len(buffer))
    # reading order again: prefix, middle, suffix; the marks are taken out from the back
    for mark in (SUFFIX, MIDDLE, PREFIX):
        place = buffer.rindex(mark)
        del buffer[place : place + len(mark)]
    return buffer


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four unsigned numbers of 32 bits from the seed and the id; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def _planned(text: np.ndarray, doc_id: int | None, seed: int, plain_from: int, spm_below: int) -> tuple[int, str, int | None, int | None, bytearray]:
    """(code points, form, code points of the prefix, of the middle, output) of one text."""
    begins = (text & 0xC0) != 0x80
    n = int(np.count_nonzero(begins))
    raw = text.tobytes()
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not raw or h3 % 100 >= plain_from or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, arranged(raw, 0, 0, PLAIN)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    if n == len(raw):
        places = first, second
    else:
        starts = np.append(np.flatnonzero(begins), len(raw))
        places = int(starts[first]), int(starts[second])
    form = SPM if h4 % 100 < spm_below else PSM
    return n, form, first, second - first, arranged(raw, *places, form)


def _flushed(rows, names: list[str], types: list[pa.DataType], size):
    """Record batches of at most FLUSH_BYTES bytes of texts, or one longer row."""
    held, total = [], 0
    for row in rows:
        more = size(row)
        if held and total + more > FLUSH_BYTES:
            yield _batch(held, names, types)
            held, total = [], 0
        held.append(row)
        total += more
    if held:
        yield _batch(held, names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    # bytes become strings without decoding them twice: Arrow checks UTF-8 in the cast
    arrays = [pa.array(column, type=pa.binary()).cast(t) if t == pa.string() and any(isinstance(x, bytes) for x in column) else pa.array(column, type=t) for column, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def arrange(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """`doc_id`, `n` (code points), `form`, `prefix_chars`, `middle_chars`, `output` for every row of `docs` (doc_id, text).

    Cuts and form are drawn from `seed` and doc_id alone, so equal ids give equal draws and reruns agree. A null text
    counts as empty; empty texts and those that hold a sentinel stay plain, and so do `plain_percent` of the others;
    `spm_percent` of the rest are suffix first. Plain rows have null prefix and middle. Repeated rows are handled one
    by one, a null id draws like an empty one, other columns are ignored, an empty table gives an empty result.
    """
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def rows(batch):
        ids = batch.column("doc_id").to_pylist()
        data, offsets = utf8(batch.column("text"))
        for doc_id, lo, hi in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            *facts, output = _planned(data[lo:hi], doc_id, seed, 100 - plain_percent, spm_percent)
            yield doc_id, *facts, bytes(output)

    def run(batches):
        for batch in batches:
            yield from _flushed(rows(batch), names, types, lambda row: len(row[5]))

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(source, run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(forms: DataFrame) -> DataFrame:
    """`forms` (form, output and any more columns) with the column `restored`, the text rebuilt from these two alone.

    A null output or form gives a null text; an unknown form is an error.
    """
    places = [f"_{i}" for i in range(len(forms.columns))]
    form_at, output_at = forms.columns.index("form"), forms.columns.index("output")

    def run(batches):
        for batch in batches:
            forms_of, (data, offsets) = batch.column(form_at).to_pylist(), utf8(batch.column(output_at))
            known = batch.column(output_at).is_valid().to_pylist()
            at = 0
            while at < batch.num_rows:
                # as many rows as hold FLUSH_BYTES, one at least
                stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + FLUSH_BYTES, side="right")) - 1)
                texts = [
                    bytes(restored(data[offsets[i] : offsets[i + 1]].tobytes(), forms_of[i])) if known[i] and forms_of[i] is not None else None
                    for i in range(at, min(stop, batch.num_rows))
                ]
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, type=pa.binary()).cast(pa.string())], names=[*places, "restored"])
                at += len(texts)

    placed = forms.toDF(*places)
    schema = T.StructType([*placed.schema.fields, T.StructField("restored", T.StringType())])
    return map_batches(placed, run, schema).toDF(*forms.columns, "restored")
