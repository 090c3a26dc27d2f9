"""From raw documents to token files in five stages.

Each stage takes (spark, docs, sf_dir) and gives the documents it keeps, in the columns of `documents`; the
last one writes token files and gives a row for each document in them. A stage sees all that the one before
kept, as a table that was written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandtide.llm import decontaminate, mixing, near_dups, quality, token_files
from strandtide.llm.queries import thirds, tokenizer_definition
from strandtide.runtime import drop_folder, fresh_path, tables_for_a_while


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier, fitted on the labels, rejects."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are linked at a similarity of 0.8 or more."""
    return near_dups.keep_one(docs, words=5, percent=80)


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain four fifths or more of a benchmark item's five-word shingles."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weights 3, 1, 2 in turn for one and a half times all words, no document more than twice."""
    return mixing.mixed(docs, thirds, budget=1.5, passes=2)


def token_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and gives `doc_id`, `start`, `n_tokens`, `ids_crc32` of every document in them."""
    path = fresh_path(spark, "corpus-tokens")
    token_files.write(docs, path, tokenizer_definition(), end_id=1)
    return token_files.with_starts(token_files.read(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality classifier", good_documents),
    ("near-duplicates", distinct_documents),
    ("benchmark decontamination", unseen_documents),
    ("source mixing", mixed_documents),
    ("token files", token_documents),
]

# Neither the trees' scores nor the tokenizer's ids can be said in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of `sf_dir`. What stays below the shared folder are the token files and these rows."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name.replace(' ', '-')}")
        with tables_for_a_while(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            drop_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
