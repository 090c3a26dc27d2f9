"""Clade rules, clade labels and what hangs on the tree's nodes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandtide.functions import sequence as seqfn
from strandtide.functions.binding import bind
from strandtide.functions.text import record_url
from strandtide.operators.dedup import keep_first
from strandtide.names import quoted
from strandtide.operators.grouping import collapse_rare, exact_quantiles
from strandtide.operators.tree import inherit_when_unknown, nearest_resolved
from strandtide.runtime import broadcast_when_small, cut_lineage

# Residue positions of the epitopes and the accepted escape pairs.
EPITOPES = {
    "BC": list(range(95, 107)),
    "DE": list(range(142, 152)),
    "EF": list(range(165, 173)),
    "CTERM": list(range(281, 291)),
    "GH": list(range(209, 224)),
    "Esc_CHN": [283, 293],
}
ESCAPE_PAIRS = ("SA", "TA", "TX", "TS", "SS", "XX")
EPITOPE_MIN_COUNT = 6
UNASSIGNED = "unassigned"
# Sites looked up from one copy of a sequence; a longer list takes several.
SITES_AT_ONCE = 4096


def inherited_rules(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All (clade, gene, site, alt) a clade needs, inherited ones included, and the depth per clade.

    Rule rows with gene `clade` name the parent in `site`. Ancestors are found by doubling: each round joins the known
    paths with each other, so a chain of any length takes about its logarithm in rounds. A clade that reaches itself
    is an error.
    """
    names = rules.select("clade").distinct()
    paths = rules.filter(F.lower("gene") == "clade").select("clade", F.col("site").alias("source"), F.lit(1).cast("long").alias("depth")).distinct()
    paths, known = cut_lineage(paths), -1
    while True:
        state = paths.agg(F.sum("depth").alias("n"), F.count_if(F.col("clade") == F.col("source")).alias("loops")).first()
        if state["loops"]:
            raise ValueError("the clade rules inherit in a cycle")
        if state["n"] is None or state["n"] == known:
            break
        known = state["n"]
        on = paths.select(F.col("clade").alias("source"), F.col("source").alias("beyond"), F.col("depth").alias("more"))
        longer = paths.join(on, "source").select("clade", F.col("beyond").alias("source"), (F.col("depth") + F.col("more")).alias("depth"))
        paths = cut_lineage(paths.unionByName(longer).groupBy("clade", "source").agg(F.max("depth").alias("depth")), replaces=paths)
    reach = paths.unionByName(names.select("clade", F.col("clade").alias("source"), F.lit(0).cast("long").alias("depth")))
    own = rules.filter(F.lower("gene") != "clade").select(
        F.col("clade").alias("source"), "gene", F.col("site").cast("int").alias("site"), "alt"
    )
    needed = reach.join(own, "source").select("clade", "gene", "site", "alt").distinct()
    return needed, reach.groupBy("clade").agg(F.max("depth").alias("depth"))


def site_states(seqs: DataFrame, sites: Sequence[tuple[str, int]], proteins: Mapping[str, tuple[int, int]]) -> DataFrame:
    """(id, gene, site, alt): the letters of each sequence at the rule sites, nothing else.

    `nuc` reads the sequence; any other gene reads the translation of its 1-based closed window.
    """
    cells = []
    for gene in dict.fromkeys(g for g, _ in sites):
        if gene == "nuc":
            text = F.col("seq")
        else:
            lo, hi = proteins[gene]
            text = seqfn.translate_seq(F.substr("seq", F.lit(lo), F.lit(hi - lo + 1)))
        cells += [
            F.struct(F.lit(gene).alias("gene"), F.lit(s).alias("site"), F.substr(text, F.lit(s), F.lit(1)).alias("alt"))
            for g, s in sites
            if g == gene
        ]
    return seqs.select("id", F.inline(F.array(*cells))).filter(F.col("alt") != "")


def site_blocks(sites: DataFrame, name: str) -> DataFrame:
    """(name, sites): the sites of each name in blocks of at most SITES_AT_ONCE, from (name, site)."""
    block = F.floor((F.col("site") - 1) / SITES_AT_ONCE)
    return sites.groupBy(name, block.alias("_block")).agg(F.array_sort(F.collect_set("site")).alias("sites")).drop("_block")


def site_states_of(seqs: DataFrame, sites: DataFrame, proteins: Mapping[str, tuple[int, int]]) -> DataFrame:
    """`site_states` for a table of sites (gene, site) of any length.

    The sites are a stated set, which every sequence looks up gene by gene and block by block; only the letters there leave
    its row.
    """
    stored = cut_lineage(site_blocks(sites.distinct(), "gene"))
    # at most as many names as there are windows
    genes = sorted(r["gene"] for r in stored.where(F.col("gene").isin(["nuc", *proteins])).select("gene").distinct().collect())
    blocks = broadcast_when_small(stored)
    text = F.when(F.col("gene") == "nuc", F.col("seq"))
    for gene, (lo, hi) in proteins.items():
        text = text.when(F.col("gene") == gene, seqfn.translate_seq(F.substr("seq", F.lit(lo), F.lit(hi - lo + 1))))
    cells = bind(
        F.struct(F.encode(text, "utf-8").alias("raw"), F.col("sites").alias("sites")),
        lambda x: F.transform(x["sites"], lambda s: F.struct(s.alias("site"), F.when(s >= 1, F.substr(x["raw"], s, F.lit(1)).cast("string")).alias("alt"))),
    )
    named = seqs.select("id", "seq", F.explode(F.array(*map(F.lit, genes)).cast("array<string>")).alias("gene"))
    return named.join(blocks, "gene").select("id", "gene", F.inline(cells)).filter("alt <> ''")


def clades_held(states: DataFrame, rules: DataFrame) -> DataFrame:
    """Every clade whose rules all hold for an id, with its depth.

    The rules of a clade are numbered; an id has the clade when it meets all numbers. Numbers are bits of words that are or-ed
    before the shuffle, 63 to a word, so neither a repeated state nor a clade of very many rules makes a long set.
    """
    needed, depth = inherited_rules(rules)
    per_clade = Window.partitionBy("clade")
    numbered = needed.withColumns(
        {"_i": F.row_number().over(per_clade.orderBy("gene", "site", "alt")) - 1, "_wanted": F.count(F.lit(1)).over(per_clade)}
    ).join(depth, "clade")
    # a curated list as a rule, so that states need no shuffle by site; its size is checked all the same
    small = broadcast_when_small(cut_lineage(numbered))
    word, bit = F.floor(F.col("_i") / 63).alias("_word"), F.expr("shiftleft(1L, cast(_i % 63 as int))")
    words = (
        states.join(small, ["gene", "site", "alt"])
        .groupBy("id", "clade", word)
        .agg(F.bit_or(bit).alias("_bits"), F.first("_wanted").alias("_wanted"), F.first("depth").alias("depth"))
    )
    met = words.groupBy("id", "clade").agg(F.sum(F.bit_count("_bits")).alias("_met"), F.first("_wanted").alias("_wanted"), F.first("depth").alias("depth"))
    return met.filter("_met = _wanted").select("id", "clade", "depth")


def clades_from_table(seqs: DataFrame, rules: DataFrame, proteins: Mapping[str, tuple[int, int]]) -> DataFrame:
    """The most derived clade of every sequence, straight from a rule table (clade, gene, site, alt).

    The sites to look at are those of the table, however many it has; genes other than `nuc` must be in `proteins`. Only
    letters at those sites leave a sequence's row.
    """
    needed = rules.filter(F.lower("gene") != "clade").select("gene", F.col("site").cast("int").alias("site"))
    absent = [r["gene"] for r in needed.filter(~F.col("gene").isin(["nuc", *proteins])).select("gene").distinct().orderBy("gene").limit(20).collect()]
    if absent:
        raise ValueError(f"the rules name proteins without a window: {absent}")
    return clade_by_rules(seqs, site_states_of(seqs, needed, proteins), rules)


def clade_by_rules(ids: DataFrame, states: DataFrame, rules: DataFrame) -> DataFrame:
    """The most derived clade per id, ties by name; ids without one are unassigned."""
    best = clades_held(states, rules).groupBy("id").agg(F.min_by("clade", F.struct(-F.col("depth"), "clade")).alias("clade"))
    return ids.select("id").join(best, "id", "left").select("id", F.coalesce("clade", F.lit(UNASSIGNED)).alias("clade"))


def clade_on_tree(nodes: DataFrame, states: DataFrame, rules: DataFrame) -> DataFrame:
    """A node that meets a clade's rules labels its descendants, until a more specific label follows."""
    own = clade_by_rules(nodes.select(F.col("node").alias("id")), states, rules)
    labelled = nodes.select("node", "parent").join(own.withColumnRenamed("id", "node"), "node")
    return nearest_resolved(labelled, "clade", F.col("clade") != UNASSIGNED)


def validate_set(col: Column, allowed: Sequence[str], other: str = "other") -> Column:
    return F.when(col.isin(list(allowed)), col).otherwise(F.lit(other))


def epitope_strings(nodes: DataFrame, epitopes: Mapping[str, Sequence[int]] = EPITOPES, min_count: int = EPITOPE_MIN_COUNT) -> DataFrame:
    """Residues at the epitope positions per node (node, parent, is_tip, protein).

    Unknown residues of the C terminus come from the parent, escape pairs outside the accepted set
    and strings that are rare among tips become `other`. Sequences are read once: what is inherited, counted and
    joined back are the short strings.
    """
    wide = nodes.select("node", "parent", "is_tip", *[seqfn.positions_string(F.col("protein"), p).alias(e) for e, p in epitopes.items()])
    wide = cut_lineage(wide)
    if "CTERM" in epitopes:
        wide = inherit_when_unknown(wide, "CTERM")
    if "Esc_CHN" in epitopes:
        wide = wide.withColumn("Esc_CHN", validate_set(F.col("Esc_CHN"), ESCAPE_PAIRS))
    return _collapse_columns(wide, list(epitopes), min_count)


def _collapse_columns(wide: DataFrame, columns: Sequence[str], min_count: int) -> DataFrame:
    """Collapse rare values of several columns: one long pass instead of one join per column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns])
    long = wide.select("node", "is_tip", F.inline(pairs))
    collapsed = collapse_rare(long, "value", min_count, F.col("is_tip"), ["feature"])
    return collapsed.groupBy("node").agg(*[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(c) for c in columns])


def key_mutation_strings(nodes: DataFrame, positions: Mapping[str, Sequence[int]], min_count: int = 1) -> DataFrame:
    """Residues of the translated node sequences at the key positions of each set."""
    protein = nodes.withColumn("protein", seqfn.translate_seq(F.col("seq")))
    wide = protein.select("node", "is_tip", *[seqfn.positions_string(F.col("protein"), sorted(p)).alias(s) for s, p in positions.items()])
    return _collapse_columns(wide, list(positions), min_count)


def key_mutations_at(nodes: DataFrame, positions: DataFrame, min_count: int = 1) -> DataFrame:
    """`key_mutation_strings` for a table of positions (feature_set, position) of any length, one column for each set.

    Only the names of the sets, which name the result's columns, come to the driver.
    """
    names = sorted(r["feature_set"] for r in positions.select("feature_set").distinct().collect())
    if not names:
        return nodes.select("node")
    blocks = broadcast_when_small(cut_lineage(site_blocks(positions.select("feature_set", F.col("position").cast("int").alias("site")).distinct(), "feature_set")))
    protein = cut_lineage(nodes.select("node", "is_tip", F.encode(seqfn.translate_seq(F.col("seq")), "utf-8").alias("_raw")))
    letters = bind(
        F.struct(F.col("_raw").alias("raw"), F.col("sites").alias("sites")),
        lambda x: F.concat_ws("", F.transform(x["sites"], lambda s: F.when(s >= 1, F.substr(x["raw"], s, F.lit(1)).cast("string")))),
    )
    asked = protein.select("*", F.explode(F.array(*map(F.lit, names))).alias("feature_set"))
    parts = asked.join(blocks, "feature_set").select("node", "is_tip", F.col("feature_set").alias("feature"), F.get("sites", F.lit(0)).alias("_first"), letters.alias("value"))
    in_order = F.array_sort(F.collect_list(F.struct("_first", "value")))
    long = parts.groupBy("node", "is_tip", "feature").agg(F.concat_ws("", F.transform(in_order, lambda p: p["value"])).alias("value"))
    collapsed = collapse_rare(long, "value", min_count, F.col("is_tip"), ["feature"])
    return collapsed.groupBy("node").agg(*[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(c) for c in names])


def trim_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns without white space at both ends; a label of white space only is empty, a null stays."""
    return df.withColumns({c: F.regexp_replace(F.col(f"`{c}`"), r"^\s+|\s+$", "") for c in columns})


def clade_label(meta: DataFrame, seqs: DataFrame, clades: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clade into the metadata and into sequence names; ids without clade or sequence leave both tables."""
    shown = F.when(F.col("clade") == UNASSIGNED, F.lit("")).otherwise(F.col("clade"))
    known = clades.select("id", "clade")
    both = meta.join(known, "id").join(seqs.select("id"), "id", "left_semi")
    name = F.when(F.col("clade") == UNASSIGNED, F.col("id")).otherwise(F.concat("id", F.lit("-Clade"), "clade"))
    renamed = seqs.join(known, "id").join(meta.select("id"), "id", "left_semi")
    return (
        both.withColumn("subgenogroup", shown).drop("clade"),
        renamed.select(name.alias("id"), "seq"),
    )


def published_clades(
    meta: DataFrame,
    subgenotypes: DataFrame,
    typed: DataFrame,
    lengths: DataFrame,
    colors: DataFrame,
    key: str,
    wanted_type: str,
    suffix: str = "",
    fallback: DataFrame | None = None,
) -> DataFrame:
    """Enrich metadata with published clades: keep-first, four left joins, length as text, url, new labels.

    `fallback` (key, subgenogroup, ord) fills subgenogroups that the metadata lacks.
    """
    base = keep_first(meta, [key], ["ord"]).drop("ord")
    if fallback is not None:
        spare = keep_first(fallback, [key], ["ord"]).select(key, F.trim("subgenogroup").alias("_spare"))
        base = base.join(spare, key, "left").withColumn("subgenogroup", F.coalesce("subgenogroup", "_spare")).drop("_spare")
    sub = keep_first(subgenotypes, [key], ["ord"]).drop("ord")
    rivm = keep_first(typed, ["name"], ["ord"]).filter(
        (F.col("VP1 subgenogroup") != "Could not assign") & (F.col("type") == wanted_type)
    )
    rivm = rivm.select(F.col("name").alias(key), F.trim("VP1 subgenogroup").alias("RIVM_subgenogroup"))
    hit = keep_first(lengths, [key], ["ord"]).select(key, F.concat(F.col("length").cast("string"), F.lit(suffix)).alias("length_blast"))
    tint = keep_first(colors, [key], ["ord"]).drop("ord")
    out = base.join(sub, key, "left").join(rivm, key, "left").join(hit, key, "left").join(tint, key, "left")
    return out.withColumn("url", record_url(F.col(key))).withColumnsRenamed(
        {"has_age": "Age available", "has_diagnosis": "Diagnosis available"}
    )


def export_nodes(
    nodes: DataFrame, metadata: DataFrame | None, *node_data: DataFrame
) -> DataFrame:
    """One row per node with its traits, dimensions and labels; every extra table has one row per node."""
    out = nodes if metadata is None else nodes.join(metadata, "node", "left")
    for table in node_data:
        out = out.join(table, "node", "left")
    return out


def clock_filter(tips: DataFrame, rate: float = 0.004, n_iqd: float = 10.0) -> DataFrame:
    """Residual of divergence against date per tip, and whether it is within n interquartile distances."""
    shaped = tips.withColumn("_drift", F.col("divergence") - rate * F.col("date"))
    mean = shaped.agg(F.avg("_drift").alias("m")).first()["m"]
    if mean is None:
        return shaped.select(*quoted(tips.columns), F.lit(None).cast("double").alias("residual"), F.lit(True).alias("kept"))
    q1, q2, q3 = exact_quantiles(shaped, "_drift", (0.25, 0.5, 0.75))
    near = F.abs(F.col("_drift") - q2) <= n_iqd * (q3 - q1)
    return shaped.select(*quoted(tips.columns), (F.col("_drift") - mean).alias("residual"), near.alias("kept"))
