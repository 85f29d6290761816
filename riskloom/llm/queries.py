"""Registered queries of the subpackage: thin, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.oracles import ORACLES  # noqa: F401  (part of the contract)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.license_scan import scanned

    return scanned(_table(spark, sf_dir, "documents"))


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.kd_shards import kd_sharded

    placed = kd_sharded(_table(spark, sf_dir, "documents"), shards=8)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, the numbers of the removed ones, and the kept text's SHA-256."""
    from riskloom.llm.line_dedup import repeated_lines, without_lines

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long")
    removed = repeated_lines(docs, min_words=1)
    kept = without_lines(docs.withColumn("n_lines", lines), removed)
    return kept.select("doc_id", "n_lines", F.col("__n_removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op4_mtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.mtree_search import top_products

    return top_products(_table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.toxicity import fit, hashed_fold, toxicity

    docs = _table(spark, sf_dir, "documents")
    model = fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity(docs, model).withColumn("held_out", hashed_fold(F.col("doc_id")) == 0).select("doc_id", "held_out", "score", "predicted")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from riskloom.llm.token_store import stored_ids

    return stored_ids(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.substring_dedup import without_repeats

    return without_repeats(_table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from riskloom.llm.bpe_codec import encoded_digests

    return encoded_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.decontamination import contained_items

    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.near_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), width=3, share=(85, 100))


def op11_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.secret_spans import BASE_KINDS, joined, of_kinds, secret_spans

    counts = [F.size(of_kinds("spans", kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    base = joined(of_kinds("spans", *BASE_KINDS))
    return secret_spans(_table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.fill_middle import middle_examples, restored

    made = middle_examples(_table(spark, sf_dir, "documents"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(restored(), 256)}
    return made.withColumns(digests).drop("output")


def op13_anchor_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.anchor_codes import codebook_digest, compressed, with_label_error

    codes, codebooks = compressed(_table(spark, sf_dir, "embeddings"))
    pairs = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return with_label_error(codes).select(
        "vec_id", pairs.alias("code"), "error", "label_error", F.lit(codebook_digest(codebooks)).alias("codebooks_sha256")
    )


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op3_kd_shards": op3_kd_shards,
    "op2_line_dedup": op2_line_dedup,
    "op4_mtree_search": op4_mtree_search,
    "op5_toxicity": op5_toxicity,
    "op6_token_store": op6_token_store,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_decontamination": op9_decontamination,
    "op10_near_dedup": op10_near_dedup,
    "op11_secret_spans": op11_secret_spans,
    "op12_fill_middle": op12_fill_middle,
    "op13_anchor_codes": op13_anchor_codes,
}
