"""A corpus from raw documents to packed sequences, in four stages.

Each stage works on all that the one before it kept, which is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spritelake.llm import mixing, neardups, packing, shared, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold stay; the model is fitted on labelled documents.

    Null, empty and wordless texts have the score of the intercept; equal texts stay or go
    together; without labels of both classes the score is constant; rows without id are scored like
    any other; an empty table stays empty; columns of any name are kept."""
    model = toxicity.fit(docs, shared.read(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more, by way of SimHash
    signatures) the document with the smallest id stays.

    Null, empty and blank texts are copies of each other; rows without id, or that share one, are
    told apart by their texts; of repeated rows one stays; very long texts are compared whole; an
    empty table stays empty; columns of any name are kept."""
    return neardups.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order in which Pfair scheduling takes the sources.

    A null source is a source of its own; rows without id are spread by a hash of their numbers;
    repeated rows are all placed; texts are not read but for ties; an empty table stays empty; columns
    of any name are kept."""
    return mixing.in_mixed_order(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed sequences; ``place`` orders these like the mixture.

    Null and empty texts have the end id alone; null ids stay null; repeated rows are packed each;
    very long texts are cut into windows; an empty table gives no pieces; other columns are not read."""
    return packing.packed_sequences(docs, place=shared.written_place(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Scores, fingerprints and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``."""
    docs = shared.read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = shared.stored(docs, name)
    return docs
