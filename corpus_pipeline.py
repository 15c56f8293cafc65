"""A training corpus from raw documents, stage by stage.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last
return the columns of ``documents``; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from postpulse.llm import decontaminate, language, lines, packing, simhash
from postpulse.llm.queries import table, tokenizer_file
from postpulse.scratch import shared_folder

#: Parts of texts that a Python worker remembers. The stages share their executors, so it is
#: less than what an operator takes that runs alone.
CACHED_WORDS = 200_000


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that a language of the labelled documents explains; others, and null texts, go."""
    model = language.train(docs, id_col="doc_id")
    found = language.identify(docs, model, cached_words=CACHED_WORDS)
    return _columns(found.filter(~F.col("rejected")), docs)


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share; every document stays."""
    cleaned = lines.LineIndex.empty(spark).insert(docs).clean(docs)
    counted = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return _columns(counted, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return _columns(simhash.one_of_each(docs), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not mostly made of benchmark passages, by the contamination rule."""
    found = decontaminate.find_benchmark_words(docs, table(spark, sf_dir, "benchmark"))
    return _columns(found.filter(~F.col("contaminated")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids and their place in a sequence."""
    pieces = packing.token_pieces(
        docs.select("doc_id", "text"), tokenizer_file(), cached_words=CACHED_WORDS
    )
    return packing.pack(pieces).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", identify_language),
    ("lines", drop_frequent_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Neither the language model, fingerprints nor token ids can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is read from the last stage's table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = stage(spark, docs, sf_dir)
        path = shared_folder(spark, f"corpus-{name}")
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs


pipeline = run
