"""Seed search of queries against references, region cutting and placing on reference coordinates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandtide.names import quoted
from strandtide.functions import sequence as seqfn
from strandtide.operators.dedup import best_hit
from strandtide.operators.diagonals import BASES, MOST_K, NOT_HERE, NOT_THERE, by_join, in_task, letter_code

# Search threshold and ungapped scoring.
MAX_EVALUE = 0.0005
MATCH, MISMATCH = 2, -3
LAMBDA, KAPPA = 0.625, 0.41

HIT_COLUMNS = (
    "qseqid sseqid pident length mismatch gapopen qstart qend sstart send evalue bitscore qcovs".split()
)
CHUNK_LETTERS = 20_000
# Most reference letters that may travel with a job (about 50 bytes each once indexed).
BROADCAST_LETTERS = 2_000_000


def sequence_key(col: str) -> Column:
    """32-byte digest that stands for a sequence in shuffles and sorts."""
    return F.unhex(F.sha2(col, 256)).alias("key")


def _distinct_sequences(seqs: DataFrame) -> DataFrame:
    """Copies share one key, so each distinct sequence is searched once however often it occurs."""
    return seqs.select(sequence_key("seq"), "seq").groupBy("key").agg(F.first("seq").alias("seq"))


def pieces_of(seqs: DataFrame, key: str, k: int) -> DataFrame:
    """(key, from, lead, raw, qlen, chars): sequences of k letters or more as bytes, in chunks that overlap.

    A chunk owns the k-mers that begin in its first CHUNK_LETTERS letters behind `lead`, the one letter before them (none at the start of
    the text), and holds k letters behind the last of them. No list of positions, and no task, follows the length of one sequence.
    """
    letters = seqs.select(key, F.encode("seq", "utf-8").alias("_raw"), F.length("seq").alias("chars")).filter(F.length("_raw") >= k).withColumn("qlen", F.length("_raw"))
    zero = F.lit(0)
    whole = letters.filter(F.col("qlen") < CHUNK_LETTERS + k).select(key, zero.alias("from"), zero.alias("lead"), F.col("_raw").alias("raw"), "qlen", "chars")
    long = letters.filter(F.col("qlen") >= CHUNK_LETTERS + k)
    cut = long.withColumn("from", F.explode(F.sequence(zero, F.col("qlen") - k, F.lit(CHUNK_LETTERS)))).withColumn("lead", F.least("from", F.lit(1)))
    raw = F.substr("_raw", F.col("from") - F.col("lead") + 1, F.col("lead") + CHUNK_LETTERS + 2 * k)
    chunks = cut.select(key, "from", "lead", raw.alias("raw"), "qlen", "chars")
    return whole.unionByName(chunks.repartition(key, "from"))


def kmer_table(seqs: DataFrame, key: str, k: int, absent: int) -> DataFrame:
    """One row per k-mer of ACGT: (key, pos, kmer, before, behind, after, chars); the codes of the letters beside it, `absent` at a
    text's ends, and the k letters after it.

    Slices are taken from bytes, where they are constant-time; slices of text walk it from its start.
    """
    owned = F.least(F.length("raw") - k + 1, F.col("lead") + CHUNK_LETTERS)
    placed = pieces_of(seqs, key, k).withColumn("_at", F.explode(F.when(owned > F.col("lead"), F.sequence(F.col("lead") + 1, owned))))
    letter = lambda at: F.when((at >= 1) & (at <= F.length("raw")), F.substr("raw", at, F.lit(1)).cast("string"))
    cut = placed.select(
        key,
        (F.col("from") - F.col("lead") + F.col("_at")).alias("pos"),
        F.substr("raw", F.col("_at"), F.lit(k)).alias("kmer"),
        letter_code(letter(F.col("_at") - 1), absent).alias("before"),
        letter_code(letter(F.col("_at") + k), absent).alias("behind"),
        F.substr("raw", F.col("_at") + k, F.lit(k)).alias("after"),
        "chars",
    )
    return cut.filter(F.length(F.translate(F.col("kmer").cast("string"), BASES, "")) == 0)


def _distinct_references(refs: DataFrame) -> DataFrame:
    """(token, id, seq, copies): equal rows once; the token tells texts of one id apart."""
    once = refs.select("id", "seq").dropna().groupBy("id", sequence_key("seq")).agg(F.first("seq").alias("seq"), F.count(F.lit(1)).cast("int").alias("copies"))
    nth = F.row_number().over(Window.partitionBy("id").orderBy("key"))
    return once.select(F.concat(nth.cast("string"), F.lit(":"), F.col("id")).alias("token"), "id", "seq", "copies")


def segments(queries: DataFrame, refs: DataFrame, k: int = 11, decay: float = 0.0, ceiling: float = math.inf) -> DataFrame:
    """Ungapped segments per (query, reference, diagonal) of (key, seq) queries: seeds at most 2 k letters apart are joined.

    (key, sseqid, nth, diag, qstart, qend, same, chars): `nth` counts the texts of one reference id, `same` the equal letters of the segment,
    `chars` the letters of the query. No text is needed beyond this point.

    Runs of seeds are made as a whole (`diagonals`). With `ceiling`, segments for which query letters * reference letters *
    exp(-decay * length) exceeds it are dropped where they are found. Few references travel with the job; many are
    joined by k-mer and the letter beside it.
    """
    letters = refs.agg(F.sum(F.length("seq")).alias("n")).first()["n"] or 0
    known = _distinct_references(refs).select("token", "seq")
    line = Window.partitionBy("key", "sseqid", "diag")
    if letters <= BROADCAST_LETTERS and k <= MOST_K:
        listed = [(r["token"], r["seq"]) for r in known.collect()]  # at most BROADCAST_LETTERS letters
        found = in_task(pieces_of(queries, "key", k), listed, k, letters, decay, ceiling, CHUNK_LETTERS)
        # a run that chunks have cut has its last seed in the row behind that of its first one
        w = line.orderBy(F.coalesce("first", "last"))
        end = F.struct("last", "after", "after_there")
        ended = found.withColumn("_end", F.when(F.col("last").isNull(), F.lead(end).over(w)).otherwise(end)).filter("first is not null")
        runs = ended.select("key", "sseqid", "diag", "first", "_end.last", "same", "_end.after", "_end.after_there", "chars")
    else:
        ref_side = kmer_table(known, "token", k, NOT_THERE).withColumnRenamed("token", "sseqid")
        runs = by_join(kmer_table(queries, "key", k, NOT_HERE), ref_side).withColumn("same", F.lit(None).cast("long"))
    # runs that lie close together are one segment; of the letters between them the equal ones count, at most k
    w = line.orderBy("first")
    before = F.lag(F.struct("last", "after", "after_there")).over(w)
    placed = runs.withColumn("_before", before).withColumn("_gap", F.col("first") - F.col("_before.last") - k)
    near = F.coalesce(F.col("_gap") <= k, F.lit(False))
    letter = lambda c, i: F.substr(F.col(c), i, F.lit(1))
    alike = F.aggregate(
        F.sequence(F.lit(1), F.col("_gap").cast("int")),
        F.lit(0).cast("long"),
        lambda n, i: n + (letter("_before.after", i) == letter("_before.after_there", i)).cast("long"),
    )
    between = F.when(near & (F.col("_gap") > 0), alike).when(near, F.col("_gap")).otherwise(0)
    own = F.coalesce("same", F.col("last") - F.col("first") + k)
    out = (
        placed.withColumn("_new", F.when(near, 0).otherwise(1))
        .withColumn("_seg", F.sum("_new").over(w))
        .groupBy("key", "sseqid", "diag", "_seg")
        .agg(
            F.min("first").cast("int").alias("qstart"),
            (F.max("last") + k - 1).cast("int").alias("qend"),
            F.sum(own + between).cast("int").alias("same"),
            F.max("chars").alias("chars"),
        )
    )
    cut = F.instr("sseqid", ":")
    return out.select("key", F.substr("sseqid", cut + 1, F.length("sseqid")).alias("sseqid"), F.substr("sseqid", F.lit(1), cut - 1).cast("int").alias("nth"), "diag", "qstart", "qend", "same", "chars")


def kmer_hits(
    queries: DataFrame,
    refs: DataFrame,
    k: int = 11,
    max_evalue: float = MAX_EVALUE,
    match: int = MATCH,
    mismatch: int = MISMATCH,
    lam: float = LAMBDA,
    kappa: float = KAPPA,
) -> DataFrame:
    """Ungapped local hits of (id, seq, ord) queries on (id, seq) references, in the 13-column hit shape plus `ord`.

    Runs of equal k-mers are found as a whole, inside the tasks when the references have few letters, by a
    sort-merge join beyond that, and only segments that can reach the threshold leave the task (`segments`).
    """
    keyed = queries.select("id", sequence_key("seq"))
    distinct = _distinct_sequences(queries)
    db_letters = refs.agg(F.sum(F.length("seq")).alias("n")).first()["n"] or 0
    # the best a segment can do is to match throughout: segments that fail even so, nearly all of them, are dropped in the tasks
    found = segments(distinct, refs.select("id", "seq"), k, lam * match, max_evalue / kappa)
    length = F.col("qend") - F.col("qstart") + 1
    scored = found.select(
        "key", "sseqid", "nth", "qstart", "qend",
        (F.col("qstart") + F.col("diag")).cast("int").alias("sstart"),
        (F.col("qend") + F.col("diag")).cast("int").alias("send"),
        length.alias("length"),
        F.col("same").alias("_same"),
        F.col("chars").alias("_qlen"),
    )
    scored = scored.withColumn("mismatch", F.col("length") - F.col("_same"))
    scored = scored.withColumn("_score", match * F.col("_same") + mismatch * F.col("mismatch"))
    evalue = kappa * F.col("_qlen") * db_letters * F.exp(-lam * F.col("_score"))
    kept = scored.withColumn("evalue", evalue).filter(F.col("evalue") <= max_evalue)
    # coverage: union of the spans of a query on one reference
    w = Window.partitionBy("key", "sseqid").orderBy("qstart", "qend", "sstart")
    reach = F.max("qend").over(w.rowsBetween(Window.unboundedPreceding, -1))
    gain = F.greatest(F.col("qend") - F.greatest(F.col("qstart") - 1, F.coalesce(reach, F.lit(0))), F.lit(0))
    covered = F.sum("_gain").over(Window.partitionBy("key", "sseqid"))
    kept = kept.withColumn("_gain", gain).withColumn("_covered", covered)
    # equal rows of the references give equal hits
    several = _distinct_references(refs).filter("copies > 1").select(F.col("id").alias("sseqid"), F.substring_index("token", ":", 1).cast("int").alias("nth"), "copies")
    if not several.isEmpty():
        kept = kept.join(several, ["sseqid", "nth"], "left").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)))))
    hits = kept.select(
        "key",
        "sseqid",
        F.bround(100 * F.col("_same") / F.col("length"), 3).alias("pident"),
        "length",
        "mismatch",
        F.lit(0).alias("gapopen"),
        "qstart", "qend", "sstart", "send", "evalue",
        F.bround((lam * F.col("_score") - math.log(kappa)) / math.log(2), 1).alias("bitscore"),
        F.floor(100 * F.col("_covered") / F.col("_qlen")).cast("int").alias("qcovs"),
    )
    fanned = keyed.withColumnRenamed("id", "qseqid").join(hits, "key").drop("key")
    return fanned.select(*HIT_COLUMNS)


def with_hit_order(hits: DataFrame) -> DataFrame:
    """Stable order column for hits that do not come from a file."""
    return hits.withColumn("ord", F.struct("sseqid", "qstart", "sstart"))


def abs_span(hits: DataFrame) -> DataFrame:
    return hits.withColumn("diff_length_ref", F.abs(F.col("send") - F.col("sstart")))


def hit_lengths(hits: DataFrame) -> DataFrame:
    """Reference span of the best hit per query, before any length filter."""
    return abs_span(best_hit(hits)).select("qseqid", "diff_length_ref")


def cut_region(seqs: DataFrame, hits: DataFrame, lo: int, hi: int) -> DataFrame:
    """Cut the best-hit part out of each sequence; both reference span and cut length are within the bounds."""
    best = abs_span(best_hit(hits)).filter(F.col("diff_length_ref").between(lo, hi))
    joined = seqs.join(best.select(F.col("qseqid").alias("id"), "qstart", "qend"), "id")
    cut = joined.withColumn("seq", F.substr("seq", F.col("qstart"), F.col("qend") - F.col("qstart") + 1))
    return cut.filter(F.length("seq").between(lo, hi)).select(quoted(seqs.columns))


def project_ungapped(seqs: DataFrame, hits: DataFrame, refs: DataFrame) -> DataFrame:
    """Each query on the coordinates of the reference of its best hit, `-` where it has no letter."""
    best = best_hit(hits).select(F.col("qseqid").alias("id"), "sseqid", (F.col("sstart") - F.col("qstart")).alias("_off"))
    sized = refs.select(F.col("id").alias("sseqid"), F.length("seq").alias("_n"))
    joined = seqs.select("id", "seq").join(best, "id").join(sized, "sseqid")
    return joined.select("id", "sseqid", seqfn.project(F.col("seq"), F.col("_off"), F.col("_n")).alias("aligned"))
