"""Corpus pipeline over ``documents``: language ID, SimHash near duplicates, source mixing, packing.

Each stage gets what its predecessor kept, as a table that was written and read again, and returns the columns of
``documents``; the last returns the packed pieces.  A stage decides on keys (doc_id and a hash of the text) and joins the
decisions back once, so that no text passes through a Python worker on its way to the next stage.

Definitions: rows with equal doc_id and text share a decision; nulls compare equal in that join; an empty table passes
through as an empty table; further columns of ``documents`` are carried along; very long texts are scored, hashed and
cut whole, a bounded part at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubflow.llm import cube_mix, packing, simhash, string_kernel
from hubflow.llm.common import work_dir, written
from hubflow.llm.queries import tokenizer_path

#: Share of a language's usual mean n-gram weight below which a text is rejected.
UNFAMILIAR = 0.25


def _decided(docs: DataFrame, decisions: DataFrame, *columns: str) -> DataFrame:
    """Rows of ``docs`` whose key is among the distinct keys of ``decisions``, with its columns as _name."""
    d = decisions.select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    return docs.join(d, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("text") == F.col("_text_key")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose n-grams are unlike every learned language's.

    A winner whose mean n-gram weight is below UNFAMILIAR of what is usual in its language is no language: other
    scripts, encoded data.  Short, mixed or marked-up text in a learned language stays well above it.
    """
    model = string_kernel.train(docs)
    verdicts = string_kernel.identify(docs, model)
    kept = verdicts.filter((F.col("lang_pred") != "und") & (F.col("familiar") >= UNFAMILIAR)).select("doc_id", "text_key").distinct()
    return _decided(docs, written(kept, "language-kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest doc_id (then text hash)."""
    found = simhash.simhash_components(docs, words_per_shingle=3, max_bits=2)
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")  # a row without a doc_id comes last
    kept = written(found.groupBy("component").agg(F.min(first).alias("x")).select("x.doc_id", "x.text_key"), "unique-kept")
    return _decided(docs, kept).dropDuplicates(["doc_id", "_text_key"]).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0 to 3 times)."""
    mix = cube_mix.mix_sources(docs).filter("copies > 0")
    # rows equal in doc_id and text may differ in source: the decision holds for the source too
    taken = written(mix.select("doc_id", "text_key", "source", "copies").distinct(), "mix-taken")
    joined = _decided(docs, taken, "source", "copies").filter(F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), capacity=1024, end_id=2)


STAGES = [("language_id", language), ("simhash_near_dedup", near_duplicates), ("source_mixing", mixing), ("best_fit_packing", pack)]

#: Kernel scores, SimHash components and balanced sampling are not expressible in SQL; tests/llm holds the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = work_dir(spark, f"pipeline-{name}")
            out.write.option("compression", "zstd").parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
        docs = out
    return docs
