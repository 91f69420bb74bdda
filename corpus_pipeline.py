"""Documents to packed training sequences: quality, near copies, repeated lines, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import lines, mixing, packing, setjoin, trees
from tallgrass.llm.common import discard, new_path, scratch, stored, table, with_copies
from tallgrass.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, scores 0.3 or more.

    Null texts are scored as empty ones; null ids, repeated rows and other columns stay as they are; without labels
    all documents stay; an empty table gives an empty table.
    """
    return trees.keep_scored(docs, trees.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): that with the smallest id, null last.

    Texts without words are groups of their own but for equal rows, of which one stays; ids that repeat with different
    texts are different documents; an empty table gives an empty table.
    """
    return setjoin.one_of_each_group(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of clauses, and of 50 words wherever they begin, that stand in an earlier document.

    Null texts become ''; documents that lose all their words go; an empty table gives an empty table.
    """
    return lines.deduplicated(docs, window=50)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture of its source takes it.

    Documents without words have no size and are not taken; a null source is a source; equal rows share their copies;
    an empty table gives an empty table.
    """
    chosen = mixing.mix_sources(docs).filter("copies > 0")
    return with_copies(docs, chosen.select(F.col("doc_id").alias("_id"), "_t", F.col("copies").alias("n")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in a sequence; a null or empty text is one piece, repeats are documents."""
    return packing.pack_documents(docs, tokenizer_file()).drop("_t")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_lines),
    ("mixing sources", mixture),
    ("packing", packed),
]

#: SQL has no form for the classifier; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage's rows are written and read before the next, and deleted after it."""
    given = docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, path = docs, new_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), name, path)
        if before is not given:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
