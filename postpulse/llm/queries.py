"""The registered queries of the corpus operators: each reads its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, collocations, decontaminate, language, lines, nearest, ngrams, packing, pages, sharding, simhash, suffixes, toxicity
from .rows import fold


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return sharding.shuffle_into_shards(docs, 24).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages.extract(table(spark, sf, "pages").select("page_id", "url", "html"))


def op3_nearest(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    queries = vectors.filter("vec_id % 20 = 0")
    return nearest.nearest(queries, vectors, 20).withColumnRenamed("query", "query_id")


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, keep_text=False)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op5_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    cleaned = lines.LineIndex.empty(spark).insert(docs).clean(docs)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    marked = docs.withColumn("held_out", fold("doc_id", 5) == 0)
    model = toxicity.train(marked.filter("not held_out"), table(spark, sf, "labels"))
    return toxicity.score(marked, model, keep_text=False).select(
        "doc_id",
        "held_out",
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    packed = packing.pack(packing.token_pieces(docs, tokenizer_file()))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    marked = docs.withColumn("held_out", fold("doc_id", 3) == 1)
    model = language.train(marked.filter("not held_out"), id_col="doc_id")
    found = language.identify(marked.drop("lang"), model, keep_text=False)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op9_ngrams(spark: SparkSession, sf: str) -> DataFrame:
    remainder = fold("doc_id", 7)
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", (remainder == 2).alias("held_out"), (remainder != 2).alias("train")
    )
    return ngrams.score(docs, train_col="train").drop("train")


def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark_words(
        docs, table(spark, sf, "benchmark"), keep_text=False
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("bigint").alias("n_items"),
        decontaminate.items_digest().alias("items_sha256"),
        "contaminated",
    )


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents").select("lang", "text"))


def op12_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = suffixes.without_repeats(docs)
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept", "spans")


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf, "documents").select("doc_id", "text")
    a, b = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.align(docs, a, b)
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")
