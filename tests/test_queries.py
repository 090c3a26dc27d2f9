"""Registered queries against their SQL, and what their plans must not contain.

All queries are compared when FULL_ORACLE is set (about ten minutes); by default a spread of them is. The plans of all
of them are checked.
"""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from oracle import compare, connect

from strandtide.plans.registry import all_queries, all_sql

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_sql()
LIGHT = (
    "sampled_counts_by_country filter_with_reasons merge_many wildcard_rule_join standardize_isolation collect_per_group subsample_per_group row_diff kmer_hits "
    "cut_region dedup_near_identical neighbours substitutions translate_seq clade_by_rules snapshot_report local_id_registry fasta_round_trip genbank_round_trip "
    "first_seen_stream format_dates mine_host_text parsimony_states add_metadata "
    "upsert_latest upsert_table snapshot_unchanged extract_feature extract_feature_strands gff3_round_trip clades_from_table clade_on_tree epitope_strings "
    "key_mutations_from_labels join_qc_all ledger_from_files interval_coverage rmdup_sequences looks_like_accession"
).split()
PYTHON_ALLOWED = {
    # canonical composition of text beyond ASCII
    "normalize_strings", "curate_chain", "curate_stream",
    # comparing two byte arrays
    "pairwise_identity", "dedup_near_identical", "neighbours", "kmer_hits", "kmer_hits_of_repeats", "best_hit", "abs_span", "hit_lengths", "cut_region", "project_ungapped", "published_clades",
}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("FULL_ORACLE") else LIGHT)
def test_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES[name], SQL.get(name)) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert name in PYTHON_ALLOWED or "ArrowEvalPython" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["dedup_keep_first"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan
    pushed = QUERIES["semi_filter"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in pushed


def test_sort_by_orders_rows(spark):
    shown = [(-r["l_quantity"], r["l_extendedprice"]) for r in QUERIES["sort_by"](spark, FOLDER).collect()]
    assert len(shown) > 1000 and shown == sorted(shown)


def test_final_table_reads_its_sources_once(spark):
    """What follows the stored merge scans neither `documents` nor `labels` more than three times."""
    plan = QUERIES["add_metadata"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("documents.parquet") <= 3 and plan.count("labels.parquet") <= 3
    assert plan.count("Exchange") <= 26 * 2  # each node is listed in the plan and again in its details
