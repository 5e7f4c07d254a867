"""The registered queries: thin wrappers that derive the digest columns."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import stash

#: Folder of the public tokenizers' files; a parameter, not part of the repository.
TOKENIZERS = os.environ.get("LODEWORKS_TOKENIZERS", "")


def tokenizer_file(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokens import read_token_files, tokenize_to_files

    _, shards = tokenize_to_files(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return read_token_files(shards)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix, repeats

    sized, plan = mix(_table(spark, sf_dir, "documents"))
    return repeats(sized, plan).select("doc_id", "size", F.col("_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_times") * F.col("size")).alias("taken"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    return identify(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import roundtrip

    return roundtrip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pages import main_text

    return main_text(_table(spark, sf_dir, "pages"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import with_features, with_media

    # the media are written, and the features computed from what is read back
    got = with_features(stash(with_media(_table(spark, sf_dir, "documents")), "media"))
    codes = F.col("fingerprint")
    return got.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256",
                      F.concat_ws(":", F.size(codes).cast("string"), F.lower(F.hex(F.xxhash64(codes)))).alias("feature"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import encode

    got = encode(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), check=True)
    return got.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "round_trip")


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_copies", "kept")


def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ppm import score

    return score(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_source_mix": op2_source_mix,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_vector_dedup": op4_vector_dedup,
    "op5_language_id": op5_language_id,
    "op6_warc": op6_warc,
    "op7_main_text": op7_main_text,
    "op8_media": op8_media,
    "op9_minhash": op9_minhash,
    "op10_ppm": op10_ppm,
}
