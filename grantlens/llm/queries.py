"""Queries over the document tables, one per operator, with their parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantlens.llm import best_fit, binary_pack, counts, exact, licences, lines, near, pieces, pii, preference, quality, repair, trie


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans_of(_table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with a checksum of their ids, and of the text that these decode to."""
    encoded = pieces.encode(_table(spark, sf_dir, "documents"), with_text=True)
    return encoded.select(
        "doc_id",
        "chunk",
        "n_chunks",
        (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = preference.answer_pairs(_table(spark, sf_dir, "conversations"))
    return preference.pair_digests(preference.preference_pairs(turns))


def op5_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.row_digests(best_fit.pack_rows(_table(spark, sf_dir, "documents")))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_copies(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, and a digest of what is left of its text."""
    report = lines.line_report(_table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return report.select("doc_id", "n_lines", "n_removed", digest.alias("text_sha256"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_pack.piece_digests(binary_pack.pack(_table(spark, sf_dir, "documents")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.conversations(_table(spark, sf_dir, "conversations"), borrow=True))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(_table(spark, sf_dir, "documents"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(repair.damaged(_table(spark, sf_dir, "conversations")), present="present")


QUERIES = {
    "op1_pii": op1_pii,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_preference_format": op4_preference_format,
    "op5_token_rows": op5_token_rows,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_licence_scan": op8_licence_scan,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_counts": op12_token_counts,
    "op13_structure_repair": op13_structure_repair,
}
