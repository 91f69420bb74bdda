"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, archives, divergence, lines, mixing, mixing_lm, packing, setjoin, substrings, toxicity, trees, vectors, whitening
from .common import held, table


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_lm.score_documents(table(spark, sf_dir, "documents")).drop("_t")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file()).drop("_t")


def op3_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op4_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = trees.classify(docs, trees.train(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held("doc_id", 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op5_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents")).drop("_t", "removed")


def op6_projection_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(table(spark, sf_dir, "embeddings"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = setjoin.jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_units(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_seen", "n_removed", removed.alias("removed_chars"), F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archive_pages(table(spark, sf_dir, "pages"))


def op10_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("_t")


def op11_polar_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_toxicity_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.classify(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held("doc_id", 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_texts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_mixing_score, op2_packing, op3_divergence, op4_quality_trees, op5_suffix_family, op6_projection_links, op7_jaccard_join, op8_line_dedup, op9_arc_to_warc, op10_fair_mixing, op11_polar_whitening, op12_toxicity_automata, op13_token_alignment)}
ORACLES = {"op3_divergence": divergence.sql(), "op8_line_dedup": lines.SQL, "op9_arc_to_warc": archives.SQL, "op10_fair_mixing": mixing.SQL}
