"""From raw documents to packed training sequences.

Stages, each over all that the one before kept; every result is written as
Parquet and read again, so a lost executor repeats one stage at most:

1. quality rules: documents that the base policy rejects go (the further rules
   would take most of what the classifier can tell, so they are left to it);
2. quality classifier: documents that the two trained views reject go;
3. near duplicates: one document of each component stays;
4. source mix: documents are taken as often as their source's target needs,
   so a document may come twice or not at all;
5. packing: the pieces of all documents, with their token ids, in sequences of
   2048 tokens.

Defined results: an empty table passes through as no rows; rows that repeat a
doc_id are judged alike and stay or go together; other columns are carried to
the fourth stage.  SQL cannot express the classifier and the tokenizer, so the
stages are tested against plain Python on small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from tallyline.llm import cotraining, mixing, near_dup, packing, quality_rules
from tallyline.sources.stage import new_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept(docs, quality_rules.BASE)


def by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the raw table: the rules may have left no document labelled bad."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return cotraining.kept(docs, labels, raw)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, TOKENIZER, with_ids=True))


STAGES = [
    ("quality_rules", by_rules),
    ("quality_classifier", by_classifier),
    ("near_duplicates", without_near_duplicates),
    ("source_mix", mixed),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the pieces and their places in sequences."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
