"""The corpus pipeline: toxic documents out, near-duplicates out, repeats cut, benchmark out, then tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.llm import bpe, decontaminate, nearcopies, suffix, toxicity
from chronoloom.sources.shared import materialize

#: SQL can't express a trained model, nor BPE; the stages are tested against brute force.
ORACLE_SQL = None


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled rows not held out, doesn't call toxic.

    Null and empty texts are scored as no words. Each row is judged by its own
    text: repeated rows go or stay together, whatever their ids. Contradicting
    labels teach nothing; without labels of both classes all scores are alike.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (by doc_id) of each group linked by a Jaccard similarity of five-word shingles of at least 0.8.

    Null, empty and blank texts are copies of each other. Rows without an id come
    after those with one, and of equal ids any one is first; exactly one row of a
    group stays, so no text is lost for sharing an id or having none.
    """
    return nearcopies.first_of_near_copies(docs)


def repeats_cut(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 200 bytes and more that occur again.

    Null texts stay null, texts under 200 bytes as they are; a row is a text of its
    own, whatever its id, so repeated rows lose all they have. No row goes.
    """
    return suffix.remove_repeats(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found.

    Null and empty texts hold none; repeated rows go or stay together; items
    without words, id or text are left out; an empty benchmark drops nothing.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of each document; null texts count as empty, each row gives one.

    The tables are small and let go, as workers also serve the other stages.
    """
    return bpe.token_digests(docs, max_pieces=100_000, max_states=80_000, rest_after_task=True)


STAGES = [
    ("toxicity", toxic_out),
    ("simhash_near_dedup", near_duplicates_out),
    ("suffix_array_dedup", repeats_cut),
    ("benchmark_decontamination", benchmark_out),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next.

    Empty tables give an empty result, and further columns of ``documents``,
    whatever their names, are carried to the last stage.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
