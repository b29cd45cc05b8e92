"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .classifiers import quality, toxicity
from .divergence import source_divergence
from .fill_in_middle import fill_in_middle, restored
from .html_extract import extract_pages
from .language_model import score_texts
from .mixing import mix_sources
from .ngram_join import ngram_jaccard_join
from .packing import pack_sequences, token_pieces
from .segmentation import sample_segmentations
from .token_file import read_token_file, token_path, write_token_file
from .vectors import near_duplicate_vectors, nearest_vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_vectors(_table(spark, sf_dir, "embeddings"), queries=F.col("vec_id") % 20 == 0, k=20)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, sf_dir, "documents"), n=5, similarity=0.8)


def segmentation_digest(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    crc = F.crc32(F.coalesce("text", F.lit("")))
    sampled = sample_segmentations(docs.select("doc_id", "text", crc.alias("text_crc")), model, k=2, carry=["doc_id", "text_crc"])
    return sampled.select(
        "doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "log_inclusion",
        (F.crc32("decoded") == F.col("text_crc")).alias("round_trip"),
    )


def op4_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation_digest(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = token_path(spark)
    write_token_file(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), added=True)
    return read_token_file(spark.read.parquet(path))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"), order=2)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = token_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)
    return pack_sequences(pieces, capacity=2048)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"), least=10, top=10)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(_table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to query, for every ``opN_`` function of this module."""
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
