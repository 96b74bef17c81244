"""The named queries of the operators over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablelift.llm.byte_bpe import byte_bpe
from tablelift.llm.conversations import damaged, repair_conversations, repaired_digests
from tablelift.llm.fingerprints import edited_fingerprints
from tablelift.llm.language import language
from tablelift.llm.line_dedup import line_dedup
from tablelift.llm.lm_scoring import lm_scores
from tablelift.llm.mixing import mix
from tablelift.llm.near_duplicates import near_duplicates
from tablelift.llm.oracles import ORACLES
from tablelift.llm.packing import pack
from tablelift.llm.quality_model import quality_model
from tablelift.llm.quality_rules import quality_rules
from tablelift.llm.toxicity import toxicity
from tablelift.llm.vector_codes import codebooks_sha256, vector_codes

WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"))


def op2_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_model(table(spark, sf_dir, "documents"), trusted)


def op5_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def id_part(parts: int) -> Column:
    """The part that crc32 of doc_id, as text, puts a document in."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op6_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language(table(spark, sf_dir, "documents"), id_part(4) != 2)
    held_out = F.coalesce(id_part(4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "n_words")


def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def op10_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), id_part(5) == 1, vocabulary(PIECE_VOCABULARY))


def op11_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_digests(repair_conversations(damaged(table(spark, sf_dir, "conversations"))))


def op12_anchor_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe(table(spark, sf_dir, "documents"), vocabulary(BYTE_RANKS))
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


NAMED = (
    op1_pfair_mixing, op2_minhash_near_duplicates, op3_quality_rules,
    op4_kneser_ney_quality, op5_harmonic_packing,
    op6_language_crf, op7_toxicity_chain,
    op8_bottom_k_fingerprints, op9_line_dedup, op10_lattice_scores,
    op11_checkpointed_repair, op12_anchor_tree_codes, op13_byte_bpe,
)


def queries() -> dict:
    return {f.__name__: f for f in NAMED}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
