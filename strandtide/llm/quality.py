"""Quality classifier: histogram gradient-boosted trees over statistics of the text alone.

Statistics come from one vectorized pass over each Arrow batch. The trees are fitted on a bounded sample of
labelled rows on the driver; applying them is a scan without any shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandtide.llm.common import NOT_SPACE, Block, blocks, distinct_per_text, map_batches
from strandtide.llm.trees import Trees, boosted

#: At most so many labelled rows are used for fitting, chosen by a hash of their id.
TRAINING_ROWS = 20_000
THRESHOLD = 0.3

_LOWER, _UPPER, _DIGIT, _BEYOND, _SPACE, _LINE, _STOP, _SIGN, _BANG, _BAR, _OTHER = range(11)


def _classes() -> np.ndarray:
    table = np.full(256, _OTHER, dtype=np.int64)
    table[128:] = _BEYOND
    for kind, letters in (
        (_LOWER, "abcdefghijklmnopqrstuvwxyz"),
        (_UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (_DIGIT, "0123456789"),
        (_SPACE, " \t"),
        (_LINE, "\r\n\v\f"),
        (_STOP, ".,;:?'\"()-"),
        (_SIGN, "#$%&*+/<=>@[\\]^_`{}~"),
        (_BANG, "!"),
        (_BAR, "|"),
    ):
        table[[ord(c) for c in letters]] = kind
    return table


_CLASS, _KINDS = _classes(), 11
FEATURES = _KINDS + 16


def _statistics(block: Block) -> np.ndarray:
    n = len(block.offsets) - 1
    sizes = np.diff(block.offsets)
    kinds = _CLASS[block.data]
    text_of = np.repeat(np.arange(n), sizes)
    counts = np.bincount(text_of * _KINDS + kinds, minlength=n * _KINDS).reshape(n, _KINDS).astype(float)
    words, hashed = block.counts, block.words()
    of = np.repeat(np.arange(n), words)
    lengths = (block.stops - block.starts).astype(float)
    per_word = np.maximum(words, 1)
    sums = lambda v: np.bincount(of, v, n)
    share = lambda v: sums(v) / per_word
    ends, begins = kinds[block.stops - 1], kinds[block.starts]
    again = np.zeros(len(hashed))
    again[1:] = (hashed[1:] == hashed[:-1]) & (of[1:] == of[:-1])
    distinct, bounds = distinct_per_text(hashed, block.first)
    runs, _, run_bounds = block.runs(hashed, 3)
    _, distinct_runs = distinct_per_text(runs, run_bounds)
    n_runs = np.diff(run_bounds)
    upper = np.concatenate([np.zeros(1), np.cumsum(kinds == _UPPER)])
    caps = (upper[block.stops] - upper[block.starts]) >= 2
    odd = ((kinds == _SIGN) | (kinds == _BAR) | (kinds == _BANG)).astype(float)
    odd = np.concatenate([np.zeros(1), np.cumsum(odd)])
    mean = share(lengths)
    rest = [
        np.log1p(sizes),
        np.log1p(words),
        mean,
        np.sqrt(np.maximum(share(lengths**2) - mean**2, 0)),
        share(lengths <= 3),
        share(lengths == 1),
        share(caps),
        share(begins == _UPPER),
        share((ends == _STOP)),
        share(ends == _SIGN),
        share(again),
        np.diff(bounds) / per_word,
        np.where(n_runs > 0, np.diff(distinct_runs) / np.maximum(n_runs, 1), 1),
        share((odd[block.stops] - odd[block.starts]) > 0),
        (counts[:, _LINE] + 1) / per_word,
        counts[:, _UPPER] / np.maximum(counts[:, _UPPER] + counts[:, _LOWER], 1),
    ]
    return np.column_stack([counts / np.maximum(sizes, 1)[:, None], *rest]).astype(np.float32)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of `FEATURES` numbers for each text; an empty or null text has its own."""
    parts = [_statistics(block) for _, _, block in blocks(column, NOT_SPACE)]
    return np.concatenate(parts) if parts else np.zeros((0, FEATURES), np.float32)


def probability(model: Trees, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-model.total(x)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = TRAINING_ROWS) -> Trees:
    """Trees for `label` (0 or 1; null is no label) of `labels` (doc_id, label) on the texts of `docs`.

    At most `bound` labels are used: those whose ids come first in hash order. They are few enough to be sent to
    the scan of `docs`. Repeated ids give several rows. Without labels the score is 0.5 for every text.
    """
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y is not null")
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("y")]
    sample = given.orderBy(*order).limit(bound)

    def run(batches):
        for batch in batches:
            x = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES), pa.array(x.ravel()))], names=["doc_id", "y", "x"]
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = map_batches(texts.join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text"), run, "doc_id long, y int, x array<float>")
    # ids may be repeated in `docs`: the bound holds for what is fetched, too
    rows = found.orderBy(*order, "x").limit(bound).toArrow()
    x = np.asarray(rows.column("x").combine_chunks().flatten(), dtype=np.float32).reshape(-1, FEATURES) if rows.num_rows else np.zeros((0, FEATURES), np.float32)
    return boosted(x, rows.column("y").to_numpy().astype(float))


def score(docs: DataFrame, model: Trees, columns: list[str]) -> DataFrame:
    """`columns` of `docs` and `score`, the probability of label 1, for every row; the text column is `text`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # columns travel by place: any name will do
    places = [f"_{i}" for i in range(len(columns))]

    def run(batches):
        for batch in batches:
            found = probability(shared.value, statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*[batch.column(p) for p in places], pa.array(found)], names=[*places, "score"])

    source = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(columns, places, strict=True)], "text")
    schema = source.drop("text").schema.add("score", "double")
    return map_batches(source, run, schema).toDF(*columns, "score")


def keep_good(docs: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` whose score reaches `threshold`, unchanged; a scan without shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(probability(shared.value, statistics(batch.column(at))) >= threshold))

    placed = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    return map_batches(placed, run, placed.schema).toDF(*docs.columns)
