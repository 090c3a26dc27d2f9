"""Near-duplicate classes by b-bit MinHash, confirmed on full shingle sets.

1. Every text becomes its set of hashed word shingles. Equal sets form one class, whose members are never
   compared; they are counted by a grouping that combines on the map side.
2. 128 minima per class give 32 band keys of four minima each, and afterwards only the low four bits of
   each minimum are kept, packed into eight longs. At a similarity of 0.85 a pair shares no band with
   probability 6e-11, at 0.8 with 5e-8.
3. In each band bucket every class is compared with the bucket's first and last class. Bit counts of the packed
   minima estimate the similarity, corrected for chance collisions; likely pairs are confirmed on their full sets.
   The pair of a bucket of two is confirmed without an estimate.
4. What is in one component by then needs no further comparison. Buckets that still hold classes of several
   components are compared in full and exactly, in cells of bounded size inside the task, whatever the
   estimates said: every class travels as its difference from the smallest class of the bucket, which tells
   the size of any two members' intersection. Only a spanning forest of the links between components leaves a
   cell, so no join sees the pairs of a cluster. Classes of a bucket's largest component meet only those outside it.
   No link of two classes that share a bucket is left out, by an estimate or a cap.
5. Components are contracted by random order in tables; nothing of them reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandtide.llm.common import NOT_SPACE, bit_filter, blocks, distinct_per_text, group_bounds, in_groups, known_id, lists, map_batches, mix, passes, row_key, signed
from strandtide.runtime import cut_lineage, drop_stored

MINIMA, ROWS_PER_BAND, LOW_BITS = 128, 4, 4
# Most classes, and about the most shingles, of one side of a cell.
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 1 << 21
CELL_COLUMNS = 4096


def _minima(values: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """Minima of each set under `count` random orders; zeros for empty sets."""
    drawn = mix(mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    salt, factor = drawn[:count], drawn[count:] | np.uint64(1)
    out = np.zeros((len(bounds) - 1, count), dtype=np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        at = bounds[:-1][full]
        for k in range(count):
            out[full, k] = np.minimum.reduceat((values ^ salt[k]) * factor[k], at)
    return out


def _packed(minima: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of each minimum, side by side in 64-bit numbers."""
    n, count = minima.shape
    per = 64 // bits
    low = (mix(minima) & np.uint64((1 << bits) - 1)).reshape(n, count // per, per)
    return np.bitwise_or.reduce(low << (np.arange(per, dtype=np.uint64) * np.uint64(bits)), axis=2)


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, sorted distinct hashes, bounds) by block; a text with fewer words has its whole sequence as one."""
    for lo, hi, block in blocks(column, NOT_SPACE):
        hashed = block.words(lower=True)
        runs, _, bounds = block.runs(hashed, words)
        short = np.flatnonzero((block.counts > 0) & (block.counts < words))
        if len(short):
            runs = np.insert(runs, bounds[short], np.concatenate([block.whole(hashed, i) for i in short]))
            extra = np.zeros(len(bounds), dtype=np.int64)
            extra[short + 1] = 1
            bounds = bounds + np.cumsum(extra)
        yield lo, hi, *distinct_per_text(runs, bounds)


def _set_keys(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent sums over each set; empty sets get 0."""
    out = []
    for salt in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ salt))])
        out.append(mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))
    return out[0], out[1]


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """`row`, `doc_id`, `n_shingles`, `node` and `check` (keys of the set), `packed` minima, `bands` for every row of `docs`."""
    bands = MINIMA // ROWS_PER_BAND

    def run(batches):
        for batch in batches:
            for lo, hi, values, bounds in shingle_sets(batch.column("text"), words):
                sizes = np.diff(bounds)
                minima = _minima(values, bounds, MINIMA)
                node, check = _set_keys(values, bounds)
                grouped = minima.reshape(hi - lo, bands, ROWS_PER_BAND)
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (hi - lo, bands))
                for r in range(ROWS_PER_BAND):
                    key = mix(key ^ grouped[:, :, r])
                packed = _packed(minima, LOW_BITS)
                per = lambda n: np.arange(hi - lo + 1) * n
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [own.column("row"), own.column("doc_id"), pa.array(sizes), pa.array(signed(node)), pa.array(signed(check)), lists(signed(packed.ravel()), per(MINIMA // 16)), lists(signed(np.ascontiguousarray(key).ravel()), per(bands))],
                    names=["row", "doc_id", "n_shingles", "node", "check", "packed", "bands"],
                )

    source = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(source, run, "row long, doc_id long, n_shingles long, node long, check long, packed array<long>, bands array<long>")


def estimate(a: str, b: str) -> Column:
    """Similarity from two packed signatures: the share of equal low bits, less what chance alone would give."""
    differ = None
    for i in range(MINIMA // 16):
        x = f"({a}[{i}] ^ {b}[{i}])"
        spread = f"(({x} | shiftrightunsigned({x}, 1) | shiftrightunsigned({x}, 2) | shiftrightunsigned({x}, 3)) & 1229782938247303441L)"
        differ = f"bit_count({spread})" if differ is None else f"{differ} + bit_count({spread})"
    chance = 1 / (1 << LOW_BITS)
    return ((1 - F.expr(differ) / F.lit(float(MINIMA))) - chance) / (1 - chance)


def estimate_floor(percent: int, minima: int = MINIMA, bits: int = LOW_BITS) -> float:
    """Five standard deviations of the estimate below the threshold."""
    chance = 1 / (1 << bits)
    p = percent / 100 * (1 - chance) + chance
    return percent / 100 - 5 * (p * (1 - p) / minima) ** 0.5 / (1 - chance)


def _similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100) >= (F.greatest(a, b) * percent)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("hashes").alias("of_b"))
    both = pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(common * 100 >= (F.size("of_a") + F.size("of_b") - common) * percent).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b): equal labels for connected nodes.

    Each round every node moves to the neighbour (or itself) that is first in a random order of that
    round, and edges inside one label disappear, so long chains shrink as fast as stars. Every round is a
    written table; only whether edges are left is asked.
    """
    edges = cut_lineage(edges.where("a != b").distinct())
    labels = cut_lineage(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("label", F.col("node")))
    seed = 0
    while not edges.isEmpty():
        seed += 1
        order = lambda c: F.xxhash64(F.col(c), F.lit(seed))  # noqa: B023, E731
        both = edges.select(F.col("a").alias("label"), F.col("b").alias("to")).union(edges.select("b", "a"))
        own = both.select("label", F.col("label").alias("to"))
        moves = cut_lineage(both.union(own).groupBy("label").agg(F.min(F.struct(order("to").alias("o"), F.col("to"))).alias("m")).select("label", F.col("m.to").alias("to")))
        left, right = moves.select(F.col("label").alias("a"), F.col("to").alias("na")), moves.select(F.col("label").alias("b"), F.col("to").alias("nb"))
        fewer = edges.join(left, "a").join(right, "b").where("na != nb").select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct()
        edges = cut_lineage(fewer, replaces=edges)
        labels = cut_lineage(labels.join(moves, "label", "left").select("node", F.coalesce("to", "label").alias("label")), replaces=labels)
        drop_stored(moves)
    drop_stored(edges)
    return labels


def _joined(labels: DataFrame, more: DataFrame) -> DataFrame:
    """`labels` after the further links `more`: only labels that these connect are contracted again."""
    name = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    between = more.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    found = components(between)
    met = found.select(F.col("node").alias("label"), F.col("label").alias("further"))
    known = labels.union(met.select("label", "label")).distinct()
    out = cut_lineage(known.join(met, "label", "left").select("node", F.coalesce("further", "label").alias("label")).distinct())
    drop_stored(found)
    return out


def _common(left: tuple[np.ndarray, np.ndarray, int], right: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """How many values each pair of rows shares; a side is (values, row of each value, rows), values distinct in a row."""
    (a, row_a, n_a), (b, row_b, n_b) = left, right
    counts = np.zeros((n_a, n_b), dtype=np.float32)
    both = np.intersect1d(a, b)
    if not len(both):
        return counts.astype(np.int64)
    if left is right:
        # a value of one row only is shared with none
        both, often = np.unique(a, return_counts=True)
        both = both[often > 1]
    column = lambda v: np.minimum(np.searchsorted(both, v), max(len(both) - 1, 0))
    at_a, at_b = column(a), column(b)
    if len(both):
        in_a, in_b = both[at_a] == a, both[at_b] == b
        for lo in range(0, len(both), CELL_COLUMNS):
            sides = []
            for at, inside, row, n in ((at_a, in_a, row_a, n_a), (at_b, in_b, row_b, n_b)):
                some = inside & (at >= lo) & (at < lo + CELL_COLUMNS)
                part = np.zeros((n, min(CELL_COLUMNS, len(both) - lo)), dtype=np.float32)
                part[row[some], at[some] - lo] = 1
                sides.append(part)
            counts += sides[0] @ sides[1].T
    counts = counts.astype(np.int64)
    if left is right:
        np.fill_diagonal(counts, np.bincount(row_a, minlength=n_a))
    return counts


def _forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that are left when those that close a circle go."""
    parent: dict[int, int] = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for a, b in pairs.tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            kept.append((a, b))
    return kept


def _cell_links(label, n, delta, of, left, right, percent: int) -> list[tuple[int, int]]:
    """Pairs of labels, without circles, that a link between `left` and `right` connects.

    With differences from one base, sets of n and m shingles differ in |x| + |y| - 2 |x and y| shingles, and they are
    linked if 100 + percent times that is at most 100 - percent times n + m.
    """

    def side(rows):
        sizes = of[rows + 1] - of[rows]
        at = np.arange(sizes.sum()) + np.repeat(of[rows] - (np.cumsum(sizes) - sizes), sizes)
        return delta[at], np.repeat(np.arange(len(rows)), sizes), len(rows)

    one = side(left)
    two = one if right is left else side(right)
    differ = (of[left + 1] - of[left])[:, None] + (of[right + 1] - of[right])[None, :] - 2 * _common(one, two)
    linked = differ * (100 + percent) <= (n[left][:, None] + n[right][None, :]) * (100 - percent)
    x, y = np.nonzero(linked & (label[left][:, None] != label[right][None, :]))
    pairs = np.stack([label[left][x], label[right][y]], axis=1)
    return _forest(np.unique(np.sort(pairs, axis=1), axis=0)) if len(pairs) else []


def _within_buckets(labelled: DataFrame, buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between labels, a spanning forest for each cell, of all classes that share a bucket.

    `labelled` has bucket, node, n_shingles, label. Classes outside a bucket's largest label meet each other and
    those of the largest label, block against block; a class is copied once for each block it meets.
    """
    # buckets of the same classes, which a cluster has in many bands, are compared once: two hashes tell their members
    mark, other = F.xxhash64("node"), F.xxhash64("node", F.lit(1))
    per_label = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"), F.bit_xor(mark).alias("x"), F.bit_xor(other).alias("y"))
    top = F.max(F.struct("n", "s", "label"))
    whole = per_label.groupBy("bucket").agg(top.alias("top"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).where("n > top.n")
    one = F.min(F.struct("bucket", "top"))
    several = whole.groupBy("n", "s", "x", "y").agg(one.alias("one")).select("one.bucket", "one.top", "n", "s")
    blocks_of = lambda n, s: F.ceil(F.greatest(n / BLOCK_CLASSES, s / BLOCK_SHINGLES)).cast("int")
    several = several.select(
        "bucket",
        F.col("top.label").alias("most"),
        blocks_of(F.col("top.n"), F.col("top.s")).alias("n_most"),
        blocks_of(F.col("n") - F.col("top.n"), F.col("s") - F.col("top.s")).alias("n_rest"),
    )
    members = cut_lineage(labelled.join(several, "bucket").join(buckets.select("bucket", "base"), "bucket"))
    own = sets.select("node", F.col("hashes").alias("own"))
    base = members.select("bucket", "base").distinct().join(sets.select(F.col("node").alias("base"), "hashes"), "base").select("bucket", F.col("hashes").alias("of_base"))
    # equal rows of (node, bucket) are one: `labelled` has each class once in a bucket
    full = members.join(own.hint("merge"), "node").join(base.hint("merge"), "bucket")
    placed = full.select(
        "bucket",
        "label",
        "n_shingles",
        (F.col("label") == F.col("most")).alias("big"),
        "n_most",
        "n_rest",
        F.concat(F.array_except("own", "of_base"), F.array_except("of_base", "own")).alias("delta"),
        F.pmod(F.xxhash64("node"), F.when(F.col("label") == F.col("most"), F.col("n_most")).otherwise(F.col("n_rest"))).cast("int").alias("block"),
    )
    cell = lambda with_most, i, j: F.struct(F.lit(with_most).alias("with_most"), i.alias("i"), j.alias("j"))
    rest, most = F.sequence(F.lit(0), F.col("n_rest") - 1), F.sequence(F.lit(0), F.col("n_most") - 1)
    cells = F.when(F.col("big"), F.transform(rest, lambda i: cell(True, i, F.col("block")))).otherwise(
        F.concat(F.transform(rest, lambda k: cell(False, F.least("block", k), F.greatest("block", k))), F.transform(most, lambda j: cell(True, F.col("block"), j)))
    )
    dealt = placed.withColumn("cell", F.explode(cells)).select("bucket", "cell.*", "big", "block", "label", "n_shingles", "delta")
    keys = ["bucket", "with_most", "i", "j"]

    def run(batches):
        for table in in_groups(batches, keys):
            label, n, block, i, j = (table.column(c).to_numpy() for c in ("label", "n_shingles", "block", "i", "j"))
            big, with_most = (table.column(c).to_numpy() for c in ("big", "with_most"))
            lists_of = table.column("delta").combine_chunks()
            delta = lists_of.flatten().to_numpy()
            of = np.concatenate([np.zeros(1, np.int64), np.cumsum(pc.list_value_length(lists_of).to_numpy())])
            bounds = group_bounds(table, keys)
            found = []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                at = np.arange(lo, hi)
                if with_most[lo]:
                    left, right = at[~big[lo:hi]], at[big[lo:hi]]
                else:
                    left = at[block[lo:hi] == i[lo]]
                    right = left if i[lo] == j[lo] else at[block[lo:hi] == j[lo]]
                if len(left) and len(right):
                    found += _cell_links(label, n, delta, of, left, right, percent)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    links = cut_lineage(map_batches(dealt.repartition(*keys).sortWithinPartitions(*keys), run, "a long, b long"))
    drop_stored(members)
    return links


def _sets_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """Full sets of the classes in `nodes` (node, row of one member), from one more pass over the texts.

    A bitmap of fixed size over the members' row keys thins out the texts; the join is exact.
    """
    cells = bit_filter(nodes, "row", 1 << 26)

    def run(batches):
        for batch in batches:
            keep = passes(cells, batch.column("row").to_numpy().view(np.uint64))
            batch = batch.filter(pa.array(keep))
            for lo, hi, values, bounds in shingle_sets(batch.column("text"), words):
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(lo, hi - lo), lists(signed(values), bounds)], names=["row", "hashes"])

    sets = map_batches(docs.select(row_key().alias("row"), "text"), run, "row long, hashes array<long>")
    return sets.join(nodes, "row").dropDuplicates(["node"]).select("node", "hashes")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`row`, `doc_id`, `n_shingles`, `component_id`, `kept` for every row of `docs` (doc_id, text, more).

    Words are runs outside white space with A-Z lowered. Texts whose shingle sets have 100 * intersection >=
    `percent` * union are linked; `component_id` is the smallest doc_id reachable over links, `kept` says
    whether it is the row's own. `row` is `common.row_key()`. Rows without words or text are linked with nothing.
    Rows of equal id and text are alike, so all or none of them are kept. A row without id joins its class,
    and is kept only if no member of its component has an id. Other columns are ignored; an empty table
    gives an empty result. Two stored tables stay, which the result reads; all others are deleted.
    """
    marks = cut_lineage(fingerprints(docs, words))
    classes = cut_lineage(
        marks.where("n_shingles > 0")
        .groupBy("node", "check", "n_shingles")
        .agg(F.min("doc_id").alias("least_id"), F.min("row").alias("row"), F.first("packed").alias("packed"), F.first("bands").alias("bands"))
    )
    rows = classes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    smallest = F.min(F.struct("n_shingles", "node"))["node"]
    buckets = cut_lineage(
        rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("lead"), F.max("node").alias("last"), smallest.alias("base")).where("members > 1")
    )
    shared = cut_lineage(rows.join(buckets.drop("base"), "bucket"))
    in_buckets = classes.join(shared.select("node").distinct(), "node", "left_semi")
    slim = cut_lineage(in_buckets.select("node", "n_shingles", "packed", "row"))
    sets = cut_lineage(_sets_of(docs, slim.select("node", "row"), words))

    def pair(end):
        ends = [F.least("node", end).alias("a"), F.greatest("node", end).alias("b")]
        return shared.where(F.col("node") != F.col(end)).select(*ends, (F.col("members") == 2).alias("only"))

    stars = pair("lead").union(pair("last")).groupBy("a", "b").agg(F.max("only").alias("only"))
    side = lambda c: slim.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("packed").alias(f"packed_{c}"))
    likely = (
        stars.join(side("a"), "a")
        .join(side("b"), "b")
        .where(_similar_sizes(F.col("n_a"), F.col("n_b"), percent) & (F.col("only") | (estimate("packed_a", "packed_b") >= F.lit(estimate_floor(percent)))))
        .select("a", "b")
    )
    links = cut_lineage(confirm(likely, sets, percent))
    labels = components(links)

    # the pair of a bucket of two has been confirmed or refused
    labelled = shared.where("members > 2").join(labels, "node", "left").select("bucket", "node", "n_shingles", F.coalesce("label", "node").alias("label"))
    more = _within_buckets(labelled, buckets, sets, percent)
    if not more.isEmpty():
        before, labels = labels, _joined(labels, more)
        drop_stored(before)

    whole = classes.select("node", "check", "least_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = whole.groupBy("label").agg(F.min("least_id").alias("component_id"))
    of_class = cut_lineage(whole.join(least, "label").select("node", "check", "component_id"))
    for used in (classes, buckets, shared, slim, sets, links, labels, more):
        drop_stored(used)
    linked = marks.where("n_shingles > 0").select("row", "doc_id", "n_shingles", "node", "check").join(of_class, ["node", "check"])
    alone = marks.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["row", "doc_id", "n_shingles", "component_id"]
    return linked.select(*columns).union(alone.select(*columns)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay when one document of each component is kept; repeated rows count once.

    Rows without words stay. Columns are those of `docs`, whatever their names.
    """
    kept = near_duplicates(docs, words, percent).where("kept")
    # rows are told apart by their id and a hash: two keys of 64 bits
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_key().alias("row"), known_id().alias("id"))
    plain = cut_lineage(kept.groupBy("row", known_id().alias("id")).agg(F.max("n_shingles").alias("n_shingles")))
    # the join and the choice of one among equal rows both go by `row`, so texts are shuffled once
    joined = marked.join(plain, ["row", "id"]).withColumn("copy", F.when(F.col("n_shingles") == 0, F.monotonically_increasing_id()).otherwise(F.lit(0)))
    return joined.dropDuplicates(["row", "id", "copy"]).select("doc.*")
