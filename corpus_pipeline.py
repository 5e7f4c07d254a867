"""The corpus pipeline: language ID, near-dedup, mixing, SentencePiece.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written and read again before the next.  All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm import langid, minhash, mixing, pieces
from lodeworks.llm.queries import tokenizer_file
from lodeworks.llm.storage import drop, stash

#: A text whose main language holds less than this share of its letters is rejected.
MIN_SHARE = 1 / 3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, without a main language, or likelier noise
    than any language that the model has learned.

    The model learns from the labelled documents outside one fold; the labels
    of documents are not read when they are judged.  A null or empty text is
    dropped; rows with a null key, repeated rows and extra columns of any name
    stay as they are; without a label nothing is known and every text goes; an
    empty table gives an empty one.
    """
    names = docs.columns
    model = langid.fit(docs.where(langid.crc_mod(F.col("doc_id"), 3) != 1), "text", "lang", "doc_id")
    added = langid.fresh(names, *langid.ADDED)
    judged = langid.with_languages(docs, model, "text", langid.SWITCH, added)
    language, share, _, fit = (F.col(f"`{c}`") for c in added)
    return judged.where((language != langid.UNDETERMINED) & (share >= MIN_SHARE) & (fit >= 0)).select(*[f"`{c}`" for c in names])


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that of the least id.

    Rows with a null text stay; texts without words are duplicates of equal ones
    only; of rows that repeat the kept id and text one stays; a group of null
    ids keeps one of them; extra columns of any name stay; an empty table gives
    an empty one.
    """
    return minhash.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to weights 1, 2, 3: a document stands there as often
    as the mix takes it.

    Null sources are one source, the last.  Rows of equal or null id share one
    draw.  Null and empty texts have no words; they may be taken or not.  Extra
    columns of any name stay; an empty table gives an empty one.
    """
    return mixing.mix_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_pieces, round_trip) of every document: its piece ids,
    and whether they decode to its text.

    Null and empty texts have no ids; repeated rows and null ids stay; other
    columns are not read; an empty table gives an empty one.
    """
    got = pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), check=True)
    return got.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip")


STAGES = [("language_id", language_stage), ("near_dedup", dedup_stage), ("source_mix", mix_stage), ("sentencepiece", encode_stage)]

#: SQL cannot express the stages; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, before = stash(stage(spark, docs, sf_dir), f"pipeline-{name}"), docs
        drop(before)  # the stage's rows are written
    return STAGES[-1][1](spark, docs, sf_dir)
