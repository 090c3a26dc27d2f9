"""Nearest texts by positions, from differences against a lead, without pairing a cluster with itself.

Texts that may be near share a group (a rare block of letters, see `similarity.neighbours`). A small group is
compared inside one task and gives at most k rows for each member. A group of thousands of near copies is not:

1. Every member becomes its difference from the group's lead, a short list of (position, letter). Differences that most
   members have move into the lead.
2. Two members without a common position differ in as many positions as both lists have together. Among members
   of equal length only the k + 1 with the shortest lists (ties by id) can then be among the k nearest: every member
   meets this short list of the group.
3. Members that share a position meet in a subgroup by that position. With at most h differing positions inside the bound,
   the h + 1 rarest positions of each list are enough (prefix filter). Subgroups that are still large go through the same
   steps with that position set aside.

All steps are exact for the identity bound; what is shuffled follows the members and their differences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandtide.functions.batches import group_bounds, whole_groups
from strandtide.operators.dedup import top_n
from strandtide.runtime import cut_lineage, drop_stored

# A group of so many members and letters is compared inside one task.
CELL_MEMBERS, CELL_LETTERS = 1024, 1 << 24
FEW, COLUMNS = 24, 4096
# An entry is position * 1024 + code: a byte of the text, 256 for none, 512 and more for letters of earlier leads.
CODES, NO_LETTER, FORMER = 1024, 256, 512
_PAIRS = "key_a binary, key_b binary, identity double, first_b string"


def shared_counts(a: np.ndarray, row_a: np.ndarray, n_a: int, b: np.ndarray, row_b: np.ndarray, n_b: int) -> np.ndarray:
    """How many values each row of one side shares with each row of the other; values are distinct in a row."""
    counts = np.zeros((n_a, n_b), dtype=np.float32)
    both = np.intersect1d(a, b)
    for lo in range(0, len(both), COLUMNS):
        part = both[lo : lo + COLUMNS]
        sides = []
        for values, row, n in ((a, row_a, n_a), (b, row_b, n_b)):
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            inside = part[at] == values
            side = np.zeros((n, len(part)), dtype=np.float32)
            side[row[inside], at[inside]] = 1
            sides.append(side)
        counts += sides[0] @ sides[1].T
    return counts.astype(np.int64)


def distances(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Differing positions of each pair, from sorted entries against one lead."""
    laid = lambda side: (np.concatenate([np.zeros(0, np.int64), *side]), np.repeat(np.arange(len(side)), [len(x) for x in side]), len(side))
    (a, row_a, n_a), (b, row_b, n_b) = laid(left), laid(right)
    same = shared_counts(a, row_a, n_a, b, row_b, n_b)
    places = shared_counts(a // CODES, row_a, n_a, b // CODES, row_b, n_b)
    return np.bincount(row_a, minlength=n_a)[:, None] + np.bincount(row_b, minlength=n_b)[None, :] - same - places


def entries(text: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """(position, letter) where a text differs from the lead; the shorter one counts as having no letter behind its end."""
    shorter = min(len(text), len(lead))
    at = np.flatnonzero(text[:shorter] != lead[:shorter])
    longer = np.arange(shorter, max(len(text), len(lead)))
    letters = text[shorter:].astype(np.int64) if len(text) > shorter else np.full(len(longer), NO_LETTER, np.int64)
    return np.concatenate([at * CODES + text[at], longer * CODES + letters])


def _direct(texts: list[np.ndarray]) -> np.ndarray:
    width = max(map(len, texts))
    laid = np.full((len(texts), width), NO_LETTER, dtype=np.int16)
    for i, t in enumerate(texts):
        laid[i, : len(t)] = t
    return np.stack([np.count_nonzero(laid != row, axis=1) for row in laid])


def _best(distance: np.ndarray, n_a, n_b, first_b: list[str], own: np.ndarray, k: int, bound: float) -> Iterator[tuple[int, int, float]]:
    """(row, column, identity) of at most k columns a row: by identity, then by `first_b`. `own` marks pairs of one text."""
    longer = np.maximum(n_a[:, None], n_b[None, :])
    identity = (longer - distance) / longer
    by_id = np.argsort(np.array(first_b, dtype=object), kind="stable")
    identity = np.where(own, -1.0, identity)[:, by_id]
    for i, row in enumerate(identity):
        good = np.flatnonzero(row >= bound)
        if len(good):
            for j in good[np.argsort(-row[good], kind="stable")[:k]].tolist():
                yield i, int(by_id[j]), float(row[j])


def _own(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Which pairs are one text."""
    number = {key: i for i, key in enumerate(dict.fromkeys([*left, *right]))}
    return np.array([number[x] for x in left])[:, None] == np.array([number[x] for x in right])[None, :]


def _found(rows: list[tuple]) -> pa.RecordBatch:
    a, b, identity, first = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(identity, pa.float64()), pa.array(first, pa.string())], names=["key_a", "key_b", "identity", "first_b"])


def _bytes_of(text) -> np.ndarray:
    return np.frombuffer(text.as_py(), dtype=np.uint8)


def _text_groups(k: int, bound: float):
    """Best partners inside whole groups of texts (g, key, first, seq)."""

    def run(batches):
        for table in whole_groups(batches, ["g"]):
            bounds, rows = group_bounds(table, ["g"]), []
            keys, firsts, seqs = table.column("key").to_pylist(), table.column("first").to_pylist(), table.column("raw")
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                texts = [_bytes_of(seqs[i]) for i in range(lo, hi)]
                if hi - lo <= FEW:
                    distance = _direct(texts)
                else:
                    lists = [entries(t, texts[0]) for t in texts]
                    distance = distances(lists, lists)
                n = np.array([len(t) for t in texts])
                for i, j, identity in _best(distance, n, n, firsts[lo:hi], _own(keys[lo:hi], keys[lo:hi]), k, bound):
                    rows.append((keys[lo + i], keys[lo + j], identity, firsts[lo + j]))
            if rows:
                yield _found(rows)

    return run


def _cells(k: int, bound: float):
    """Best partners of the members of each cell (g, cell, listed, key, first, n, used, delta) among its listed rows.

    Rows of a cell that are not listed are members; a cell without any listed row compares its members with each other.
    """

    def run(batches):
        for table in whole_groups(batches, ["g", "cell"]):
            bounds, rows = group_bounds(table, ["g", "cell"]), []
            keys, firsts = table.column("key").to_pylist(), table.column("first").to_pylist()
            listed, n = np.array(table.column("listed").to_pylist(), dtype=bool), table.column("n").to_numpy()
            used, delta = table.column("used"), table.column("delta")
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                lists = [np.concatenate([used[i].values.to_numpy(), delta[i].values.to_numpy()]).astype(np.int64) for i in range(lo, hi)]
                at = np.arange(hi - lo)
                left = at[~listed[lo:hi]]
                right = at[listed[lo:hi]] if listed[lo:hi].any() else left
                if not len(left):
                    continue
                distance = distances([lists[i] for i in left], [lists[i] for i in right])
                own = _own([keys[lo + i] for i in left], [keys[lo + j] for j in right])
                for i, j, identity in _best(distance, n[lo + left], n[lo + right], [firsts[lo + j] for j in right], own, k, bound):
                    rows.append((keys[lo + left[i]], keys[lo + right[j]], identity, firsts[lo + right[j]]))
            if rows:
                yield _found(rows)

    return run


def _against_lead(batches):
    for batch in batches:
        raw, lead = batch.column("raw"), batch.column("lead")
        found = [entries(_bytes_of(t), _bytes_of(base)) for t, base in zip(raw, lead, strict=True)]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        delta = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("g", "key", "first", "n")], delta], names=["g", "key", "first", "n", "delta"])


def _centred(state: DataFrame, sizes: DataFrame, level: int) -> DataFrame:
    """`state` with differences that more than half of a group's members have moved into the lead.

    Whoever has the lead's letter there gets an entry of its own; the code says at which level it was the lead's.
    """
    counts = state.select("g", F.explode("delta").alias("e")).groupBy("g", "e").agg(F.count(F.lit(1)).alias("c"))
    most = counts.join(sizes, "g").where("2 * c > m").groupBy("g").agg(F.collect_list("e").alias("moved"))
    place = lambda e: F.floor(e / CODES)
    moved = F.coalesce("moved", F.array().cast("array<long>"))
    lost = F.array_except(F.transform("_moved", place), F.transform("delta", place))
    back = F.transform(lost, lambda p: (p * CODES + FORMER + level).cast("long"))
    joined = state.join(most, "g", "left").withColumn("_moved", moved)
    return joined.withColumn("delta", F.array_sort(F.concat(F.array_except("delta", "_moved"), back))).drop("moved", "_moved")


def best_in_groups(members: DataFrame, texts: DataFrame, k: int, bound: float) -> DataFrame:
    """(key_a, key_b, identity, first_b): for each text and group at least its k best partners of the group, and no more than k a comparison.

    `members` has g and key, each pair once; `texts` has key, `first` (the id that breaks ties), raw (bytes).
    """
    slack = 1.0 - bound
    sized = texts.withColumn("n", F.length("raw"))
    placed = members.join(sized.select("key", "n"), "key")
    # near copies share many groups of the same members, of which one is enough: two hashes tell the members
    marks = [F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y")]
    groups = placed.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("longest"), F.min("key").alias("lead_key"), *marks).where("m > 1")
    sizes = cut_lineage(groups.groupBy("m", "longest", "lead_key", "x", "y").agg(F.min("g").alias("g")))
    small = (F.col("m") <= CELL_MEMBERS) & (F.col("m") * F.col("longest") <= CELL_LETTERS)
    inside = members.join(sizes.where(small).select("g"), "g", "left_semi").join(sized.select("key", "first", "raw"), "key")
    found = [inside.select("g", "key", "first", "raw").repartition("g").sortWithinPartitions("g").mapInArrow(_text_groups(k, bound), _PAIRS)]

    large = sizes.where(~small)
    stored, level = [sizes], 0
    more = not large.isEmpty()
    if more:
        leads = large.join(texts.select(F.col("key").alias("lead_key"), F.col("raw").alias("lead")), "lead_key").select("g", "lead")
        full = members.join(large.select("g"), "g", "left_semi").join(sized, "key").join(leads.hint("merge"), "g")
        schema = "g long, key binary, first string, n int, delta array<long>"
        against = full.select("g", "key", "first", "n", "raw", "lead").mapInArrow(_against_lead, schema)
        state = cut_lineage(against.withColumn("used", F.array().cast("array<long>")))
        stored.append(state)
    while more:
        counts = cut_lineage(state.groupBy("g").agg(F.count(F.lit(1)).alias("m")))
        centred = cut_lineage(_centred(state, counts, level))
        stored += [counts, centred]
        columns = ["g", "cell", "listed", "key", "first", "n", "used", "delta"]
        near = top_n(centred.withColumn("_d", F.size("delta")), ["g", "n", "used"], ["_d", "first"], k + 1).drop("_d")
        cells = F.ceil(F.col("m") / CELL_MEMBERS).cast("int")
        dealt = centred.join(counts, "g").withColumns({"cell": F.pmod(F.xxhash64("key"), cells).cast("int"), "listed": F.lit(False)})
        copied = near.join(counts, "g").withColumns({"cell": F.explode(F.sequence(F.lit(0), cells - 1)), "listed": F.lit(True)})
        both = dealt.select(columns).unionByName(copied.select(columns))
        found.append(both.repartition("g", "cell").sortWithinPartitions("g", "cell").mapInArrow(_cells(k, bound), _PAIRS))

        # subgroups by the rarest positions; partners inside the bound differ in at most `h` positions
        place = F.floor(F.col("e") / CODES)
        entry = centred.select("g", "key", "n", F.explode("delta").alias("e")).withColumn("p", place)
        often = entry.groupBy("g", "p").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        h = F.floor(slack * F.floor(F.col("n") / bound + 1e-9) + 1e-9)
        rarity = F.row_number().over(Window.partitionBy("g", "key").orderBy("c", "p"))
        counted = entry.join(often, ["g", "p"], "left").withColumn("c", F.coalesce("c", F.lit(1)))
        rare = counted.withColumn("_r", rarity).where((F.col("_r") <= h + 1) & (F.col("c") > 1)).select("g", "key", "p", "e")
        sub = rare.join(centred, ["g", "key"]).select(
            F.xxhash64("g", "p").alias("g"), "key", "first", "n", F.array_remove("delta", F.col("e")).alias("delta"), F.array_append("used", F.col("e")).alias("used")
        )
        sub = cut_lineage(sub)
        again = cut_lineage(sub.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
        stored += [sub, again]
        few = sub.join(again.where(F.col("m") <= CELL_MEMBERS).select("g"), "g", "left_semi")
        compared = few.withColumns({"cell": F.lit(0), "listed": F.lit(False)}).select(columns)
        found.append(compared.repartition("g").sortWithinPartitions("g", "cell").mapInArrow(_cells(k, bound), _PAIRS))
        state = cut_lineage(sub.join(again.where(F.col("m") > CELL_MEMBERS).select("g"), "g", "left_semi"))
        stored.append(state)
        more = not state.isEmpty()
        level += 1
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    result = cut_lineage(out.distinct())
    for used in stored:
        drop_stored(used)
    return result
