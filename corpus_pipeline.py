"""From raw documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read back as the next stage's ``docs``. All but the last return the columns of
``documents``; other columns are left behind by the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm import mixing, packing, quality, simhash, substrings
from eventweave.llm.frames import read, session, stored
from eventweave.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    docs = docs.select(*DOCUMENTS)
    return quality.judge(docs, quality.fit(docs, read(session(spark), sf_dir, "labels"))).filter("kept").select(*DOCUMENTS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash component: 3-word shingles, 3 bits."""
    session(spark)
    return simhash.keep_one(docs.select(*DOCUMENTS), words=3, seed=42, most=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated 35-word windows; untouched texts stay as they are."""
    session(spark)
    got = substrings.remove_repeats(docs.select(*DOCUMENTS), length=35)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return got.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENTS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that tokens follow the targets of source, language and topic."""
    session(spark)
    docs = docs.select(*DOCUMENTS)
    drawn = mixing.mix(docs.withColumns({"own_source": F.col("source"), "own_lang": F.col("lang")})).filter("selected")
    return drawn.withColumns({"source": F.col("own_source"), "lang": F.col("own_lang")}).select(*DOCUMENTS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn documents as pieces of sequences of 4096 tokens."""
    session(spark)
    got = packing.pack(docs, tokenizer=tokenizer_path("word_bpe_49k.json"), capacity=4096, end_id=1)
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]
#: SQL cannot express the fitted, hashed and packed stages; tests compare them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(session(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
