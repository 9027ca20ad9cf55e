"""Registered queries of the training-data operators: ``opN_<name>`` applies operator N to
its whole table with production parameters. ``ORACLES`` holds DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm import extraction, lexical, linequality, mixing, packing, quality, sharding, simhash, substrings, tokenfile, toxicity, whitening, winnowing
from eventweave.llm.frames import read, session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(session(spark), sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op1_substring_dedup")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of repeated 35-word windows."""
    got = substrings.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), length=35)
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op2_simhash_dedup")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, 3 bits."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, seed=42, most=3)


@register("op3_mixing", mixing.oracle_sql(mixing.ALPHAS, mixing.SWEEPS, mixing.SEED))
def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked weight, sampling probability and draw of every document."""
    got = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return got.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("weight", 6).alias("weight"),
                      F.round("probability", 6).alias("probability"), "selected")


@register("op4_quality")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the n-gram likelihood ratio for every document."""
    docs = read(spark, sf_dir, "documents")
    got = quality.judge(docs.select("doc_id", "text"), quality.fit(docs, read(spark, sf_dir, "labels")))
    return got.select("doc_id", *quality.VERDICT, "base_failed", "kept", "score")


@register("op5_html_extraction")
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = read(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.fit(pages))


@register("op6_winnowing")
def winnowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of all documents and of their edited texts."""
    got = winnowing.edited_fingerprints(read(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_chars", "edited_sha256", winnowing.entries_text("entries").alias("fingerprint"),
                      winnowing.entries_text("edited_entries").alias("edited_fingerprint"), "near_edited", "near_next")


@register("op7_token_binary")
def token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as a token file and read back."""
    got = tokenfile.token_file(read(spark, sf_dir, "documents"), tokenizer=tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return got.select("doc_id", "start", "n_tokens", "ids_crc32")


@register("op8_sharding")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes, equal texts together."""
    return sharding.shard(read(spark, sf_dir, "documents"), shards=40, overhead=16)


def held_out():
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


@register("op9_toxicity")
def toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels come from the rows that are not held out."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").filter(~held_out()))
    return toxicity.score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


@register("op10_packing")
def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    got = packing.pack(read(spark, sf_dir, "documents"), tokenizer=tokenizer_path("word_bpe_49k.json"), capacity=4096, end_id=1)
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op11_whitening")
def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 leading whitened components of every embedding."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows, whitening.fit(rows))


def line_held_out():
    """Rows whose quality labels are never learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


@register("op12_quality_classifier")
def line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels come from the rows that are not held out."""
    docs = read(spark, sf_dir, "documents")
    model = linequality.fit(docs, read(spark, sf_dir, "labels").filter(~line_held_out()))
    got = linequality.score(docs, model)
    return got.select("doc_id", F.coalesce(line_held_out(), F.lit(False)).alias("held_out"), "score", "predicted", "n_lines", "n_bad_lines")


@register("op13_lexical_search", lexical.ORACLE)
def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(lexical.build(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"))
