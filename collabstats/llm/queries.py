"""The registered queries of this package: one thin query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collabstats.llm import ball_tree, bpe, byte_cnn, contamination, langid, lattice_lm, mixing, oracle, permutation_index, pii, resampling, simhash, spotsigs, suffix_dedup
from collabstats.llm.common import crc_is_one, read


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    counts = [pii.count(F.col("pii"), kind).alias(f"n_{kind}") for kind in pii.BASE]
    base = pii.digest(F.filter("pii", lambda s: s["base"]))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), pii.digest(F.col("pii")).alias("spans"))


def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return lattice_lm.score(read(spark, sf_dir, "documents"), lattice_lm.load_pieces(public_tokenizers.path("piece_bpe_32k.model")))


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_neighbours(read(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_print().alias("fingerprint"), "component_id")


def op6_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", crc_is_one(F.col("doc_id"), 3).alias("held_out"))
    weights = byte_cnn.train(docs.where("not held_out"), read(spark, sf_dir, "labels").select("doc_id", "quality"))
    return byte_cnn.predict(docs, weights, keep=("doc_id", "held_out"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(read(spark, sf_dir, "embeddings"))


def vocabulary() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary()
    coded = bpe.encode(read(spark, sf_dir, "documents"), ranks, pattern, decoded=True)
    return coded.select("doc_id", "n_tokens", bpe.sha256("ids").alias("ids_sha256"), bpe.sha256("decoded").alias("decoded_sha256"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", crc_is_one(F.col("doc_id"), 3).alias("held_out"))
    model = langid.train(docs.where("not held_out"))
    return langid.predict(docs, model, keep=("doc_id", "held_out")).select("doc_id", "held_out", "lang_pred", "score")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"] + 1)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"))


def op12_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_lattice_lm": op2_lattice_lm,
        "op3_spotsigs": op3_spotsigs,
        "op4_simhash": op4_simhash,
        "op5_permutation_index": op5_permutation_index,
        "op6_byte_cnn": op6_byte_cnn,
        "op7_mixing": op7_mixing,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_language": op9_language,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_contamination": op11_contamination,
        "op12_ball_tree": op12_ball_tree,
        "op13_resampling": op13_resampling,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
