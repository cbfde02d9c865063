"""From raw documents to packed training sequences, stage by stage.

Every stage takes what its predecessor kept, as a stored table, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadwright.llm import jaccard, language, mixing, packing, substrings
from threadwright.llm.common import staged
from threadwright.llm.targets import DOMAIN, MIX_LEVELS, MIX_SEED, MIX_WEIGHTS, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEEP_SHARE, KEEP_EPOCHS = 0.8, 2


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are in none of the known languages."""
    model = language.fit_language_model(docs)
    return language.identify_language(docs, model, columns=COLUMNS).filter("not rejected").select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates, and rows without an id."""
    groups = jaccard.jaccard_groups(docs)
    first = groups.filter("doc_id = component_id").select("doc_id")
    kept = docs.join(first.hint("shuffle_hash"), "doc_id", "left_semi").select(*COLUMNS)
    return kept.unionByName(docs.filter("doc_id IS NULL").select(*COLUMNS))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document has."""
    cut = substrings.remove_repeated_passages(docs, columns=COLUMNS)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Choose documents by the target weights of domains, languages and sources, some of them twice."""
    named = docs.withColumn("domain", F.expr(DOMAIN)).withColumn("n_tokens", mixing.word_count("text"))
    chosen = mixing.mix_to_weights(named, "n_tokens", MIX_LEVELS, MIX_WEIGHTS, None, KEEP_SHARE, KEEP_EPOCHS, MIX_SEED)
    return chosen.select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise and pack into sequences of 4096 ids."""
    return packing.pack(staged(packing.tokenized_pieces(docs, vocabulary()), "pieces"))


STAGES = [
    ("language_id", identified),
    ("near_duplicates", without_near_duplicates),
    ("substring_dedup", without_repeated_passages),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]

#: Learned language models and byte-pair encoding have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
