"""Removal of long word passages that stand in an earlier document.

Two operators share one meaning: a window is `length` consecutive words of one document, and each word goes
that is covered by a window whose words also stand in a row in a document with a smaller id.

`against_references` takes a stated, bounded reference. Its shards become suffix automata, each is
broadcast in turn, and documents stream past it: the length of the longest match that ends at each word,
the matching statistics, shows where a span of at least `length` words stands in the shard. Its cost is
the number of shards times the words of the documents.

`remove_repeats` is for a corpus against itself. There every document is a reference for the later ones, so
the shards grow with the corpus, their product with it would grow as its square, and an automaton over
all of it fits no executor. The same spans are found by equality of whole windows:

1. The least hash among a window's 18-word runs is its anchor; equal windows have equal anchors, and
   neighbouring windows mostly share theirs, so a document has one anchor for about 17 words. Anchors that
   occur in one document only are dropped by a grouping that combines before it shuffles.
2. Windows whose anchor is left are compared by 128-bit hashes: the least id that has each of them, again
   a grouping that combines first. Windows that several documents have are joined back, by a join that
   Spark can split where one window is very common.
3. Documents that have such windows get their list and drop the covered words. All others are finished in
   one scan.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandtide.llm.common import NOT_SPACE, Block, bit_filter, blocks, group_bounds, in_groups, map_batches, passes, signed
from strandtide.runtime import cut_lineage

RUN_WORDS = 18
FILTER_BITS = 1 << 27
# Most words of all references that `against_references` takes.
MOST_REFERENCE_WORDS = 20_000_000


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[: len(x) - step], x[step:])
        have += step
    return x


def _anchors(block: Block, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor of each window, index of its first word, bounds for each text)."""
    run = min(RUN_WORDS, length)
    grams, _, bounds = block.runs(words, run)
    width = length - run + 1
    if len(grams) < width:
        return grams[:0], np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    least = sliding_minimum(grams, width)
    per_text = np.maximum(np.diff(bounds) - width + 1, 0)
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(per_text)])
    inside = np.arange(ends[-1]) - np.repeat(ends[:-1], per_text)
    return least[inside + np.repeat(bounds[:-1], per_text)], inside + np.repeat(block.first[:-1], per_text), ends


def covered(n_words: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of a text's words lie in a window that begins at one of `starts`."""
    step = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + length, -1)
    return np.cumsum(step[:-1]) > 0


_RESULT = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
_RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _rest(words: list[bytes], gone: np.ndarray | None, texts: bool) -> tuple[int, int, str, str | None]:
    left = words if gone is None else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    kept = b" ".join(left)
    return len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None


def _columns(ids: list, rows: list[tuple]) -> list[pa.Array]:
    n, removed, sha, kept = zip(*rows, strict=True)
    return [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())]


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, windows): 64-bit hashes of those windows of a document whose words also stand in one with a smaller id."""

    def anchors(batches):
        for batch in batches:
            for lo, _, block in blocks(batch.column("text"), NOT_SPACE):
                least, _, bounds = _anchors(block, block.words(), length)
                if not len(least):
                    continue
                change = np.ones(len(least), dtype=bool)
                change[1:] = least[1:] != least[:-1]
                change[bounds[:-1][np.diff(bounds) > 0]] = True
                at = np.flatnonzero(change)
                of = pa.array(np.searchsorted(bounds, at, side="right") - 1 + lo)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(of), pa.array(signed(least[at]))], names=["doc_id", "anchor"])

    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = map_batches(source, anchors, "doc_id long, anchor long")
    shared = cut_lineage(found.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor"))
    of_anchors = _thinned(shared, "anchor")

    def windows(anchors, repeated):
        """Windows whose anchor, or whose own hash, passes the filter at hand."""

        def run(batches):
            for batch in batches:
                for lo, _, block in blocks(batch.column("text"), NOT_SPACE):
                    words = block.words()
                    one, _, bounds = block.runs(words, length)
                    at = np.flatnonzero(passes(anchors.value, _anchors(block, words, length)[0]) if anchors else passes(repeated.value, one))
                    if not len(at):
                        continue
                    two, _, _ = block.runs(block.words(which=1), length, which=1)
                    of = pa.array(np.searchsorted(bounds, at, side="right") - 1 + lo)
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(of), pa.array(signed(one[at])), pa.array(signed(two[at]))], names=["doc_id", "window", "check"])

        return map_batches(source, run, "doc_id long, window long, check long")

    # windows are made twice from the texts: keeping them would take more room than the texts do
    seen = windows(of_anchors, None).groupBy("window", "check").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    least = cut_lineage(seen.where("lo < hi").select("window", "check", "lo"), replaces=shared)
    later = windows(None, _thinned(least, "window")).join(least, ["window", "check"]).where("doc_id > lo")
    # a document's windows are no more than its words
    return cut_lineage(later.groupBy("doc_id").agg(F.collect_set("window").alias("windows")), replaces=least)


def _thinned(hashes: DataFrame, column: str):
    return hashes.sparkSession.sparkContext.broadcast(bit_filter(hashes, column, FILTER_BITS))


def remove_repeats(docs: DataFrame, length: int = 50, texts: bool = True) -> DataFrame:
    """`doc_id`, `n_words`, `n_removed`, `kept_sha256`, `kept` (the words that stay, joined by one space) for every row of `docs`.

    Words are runs outside white space, unchanged; null texts have none. Windows are judged on the input, not on
    what is left. Rows of equal id are no reference for each other; rows without id lose nothing and are no
    reference. Other columns are ignored. `texts=False` leaves `kept` null.
    """
    found = repeated_windows(docs, length)
    cells = docs.sparkSession.sparkContext.broadcast(bit_filter(found, "doc_id", 1 << 24))

    def split(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            concerned = known & passes(cells.value, np.where(known, ids.fill_null(0).to_numpy(), 0).view(np.uint64))
            free = batch.filter(pa.array(~concerned))
            if free.num_rows:
                rows = [_rest((t or "").encode().split(), None, texts) for t in free.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*_columns(free.column("doc_id").to_pylist(), rows), pa.nulls(len(rows), pa.string())], names=[*_RESULT, "text"])
            held = batch.filter(pa.array(concerned))
            if held.num_rows:
                none = [pa.nulls(held.num_rows, t) for t in (pa.int64(), pa.int64(), pa.string(), pa.string())]
                yield pa.RecordBatch.from_arrays([held.column("doc_id"), *none, held.column("text").fill_null("")], names=[*_RESULT, "text"])

    def finish(batches):
        for batch in batches:
            ids, gone = batch.column("doc_id").to_pylist(), batch.column("windows")
            for lo, hi, block in blocks(batch.column("text"), NOT_SPACE):
                one, at, bounds = block.runs(block.words(), length)
                raw, rows = block.data.tobytes(), []
                for i in range(hi - lo):
                    words = raw[block.offsets[i] : block.offsets[i + 1]].split()
                    bad = np.asarray(gone[lo + i].values if gone[lo + i].is_valid else [], dtype=np.int64)
                    own = slice(bounds[i], bounds[i + 1])
                    starts = at[own][np.isin(one[own].view(np.int64), bad)] - block.first[i]
                    rows.append(_rest(words, covered(len(words), starts, length), texts))
                yield pa.RecordBatch.from_arrays(_columns(ids[lo:hi], rows), names=_RESULT)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = cut_lineage(map_batches(source, split, _RESULT_SCHEMA + ", text string"))
    joined = parts.where("text is not null").select("doc_id", "text").join(found, "doc_id", "left")
    return parts.where("text is null").select(*_RESULT).union(map_batches(joined, finish, _RESULT_SCHEMA))


class SuffixAutomaton:
    """All word sequences of some references, and the least id of a reference that has each of them."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.least.append(None)
        return len(self.next) - 1

    def _split(self, p: int, word, q: int) -> int:
        """The state of the sequences of `q` that are one word longer than those of `p`."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words, number: int) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word, self.next[last][word])
            else:
                new = self._state(self.length[last] + 1, {}, 0)
                p = last
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, word, self.next[p][word])
                last = new
            if self.least[last] is None or number < self.least[last]:
                self.least[last] = number

    def close(self) -> SuffixAutomaton:
        """Carries the least ids from longer sequences to their suffixes."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up, own = self.link[s], self.least[s]
            if up > 0 and own is not None and (self.least[up] is None or own < self.least[up]):
                self.least[up] = own
        return self

    def windows(self, words, length: int, below: int | None) -> list[int]:
        """First words of all windows whose sequence a reference with an id below `below` has (None: any reference)."""
        state, matched, found = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            if matched >= length:
                at = state
                while self.length[self.link[at]] >= length:
                    at = self.link[at]
                if below is None or self.least[at] < below:
                    found.append(i - length + 1)
        return found


def against_references(docs: DataFrame, references: DataFrame, length: int = 50, shard_words: int = 200_000, earlier_only: bool = False) -> DataFrame:
    """As `remove_repeats`, but windows are looked for in `references` (doc_id, text), a stated set of bounded size.

    More than MOST_REFERENCE_WORDS words are an error. References are dealt by hash to shards of about `shard_words` words, whose
    automata are built in one job; one at a time is fetched, in as many bytes as its words make, and broadcast.
    With `earlier_only`, a window counts only if a reference with a smaller id than the document's has it.
    """
    spark = docs.sparkSession

    def build(batches):
        for table in in_groups(batches, ["shard"]):
            bounds = group_bounds(table, ["shard"])
            numbers, texts, shards_of = (table.column(c).to_pylist() for c in ("doc_id", "text", "shard"))
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                automaton = SuffixAutomaton()
                for i in range(lo, hi):
                    automaton.add((texts[i] or "").encode().split(), numbers[i])
                yield pa.RecordBatch.from_arrays([pa.array([shards_of[lo]], pa.int64()), pa.array([pickle.dumps(automaton.close())])], names=["shard", "automaton"])

    sized = references.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.size(F.split("text", r"\s+")).cast("long").alias("n"))
    words = sized.agg(F.sum("n").alias("n")).first()["n"] or 0
    if words > MOST_REFERENCE_WORDS:
        raise ValueError(f"references of {words} words; at most {MOST_REFERENCE_WORDS} can be looked for")
    shards = max(1, -(-words // shard_words))
    dealt = sized.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).alias("shard"), "doc_id", "text").repartition("shard").sortWithinPartitions("shard", "doc_id")
    automata = cut_lineage(map_batches(dealt, build, "shard long, automaton binary"))
    source = cut_lineage(docs.select(F.monotonically_increasing_id().alias("at"), F.col("doc_id").cast("long").alias("doc_id"), "text"))
    hits = None
    for shard in range(shards):
        blob = automata.where(F.col("shard") == shard).select("automaton").first()
        if blob is None:
            continue
        held = spark.sparkContext.broadcast(bytes(blob["automaton"]))

        def look(batches, held=held):
            automaton = pickle.loads(held.value)
            for batch in batches:
                rows = zip(batch.column("at").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                found = [(at, automaton.windows((text or "").encode().split(), length, number if earlier_only else None)) for at, number, text in rows if number is not None or not earlier_only]
                found = [(at, starts) for at, starts in found if starts]
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([s for _, s in found], pa.list_(pa.int64()))], names=["at", "starts"])

        one = cut_lineage(map_batches(source, look, "at long, starts array<long>"))
        hits = one if hits is None else cut_lineage(hits.union(one))

    def finish(batches):
        for batch in batches:
            rows = []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True):
                words = (text or "").encode().split()
                rows.append(_rest(words, covered(len(words), np.array(starts or [], dtype=np.int64), length), True))
            if rows:
                yield pa.RecordBatch.from_arrays(_columns(batch.column("doc_id").to_pylist(), rows), names=_RESULT)

    if hits is None:
        hits = spark.createDataFrame([], "at long, starts array<long>")
    merged = hits.groupBy("at").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return map_batches(source.join(merged, "at", "left").select("doc_id", "text", "starts"), finish, _RESULT_SCHEMA)
