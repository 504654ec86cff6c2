"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlift.llm import (
    ball_tree, html_text, importance, ngram_join, packing, positional_index, quality_mil, secret_scan, source_mix,
    token_store, toxicity, walsh_codes, weighted_sampling,
)
from cohortlift.llm.shipping import ship
from cohortlift.llm.staging import Stages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ngram_join.jaccard_components(docs, width=3, num=9, den=10).select(
        "doc_id", "n_shingles", "component_id", "class_id"
    )


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels")
    model = quality_mil.train(quality_mil.training_rows(docs, labels, "quality", 3, 1))
    return quality_mil.score(docs, model).select(
        "doc_id", quality_mil.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.when(finite, whole).alias("vector"))
    return ball_tree.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return source_mix.plan_mix(docs, keep_text=False).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.size("_shards")).alias("taken"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = secret_scan.base_spans(F.col("spans"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secret_scan.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op6_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels")
    model = toxicity.train(quality_mil.training_rows(docs, labels, "toxic", 5, 0))
    return toxicity.score(docs, model).select(
        "doc_id", quality_mil.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.store_path(spark)
    token_store.write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_file(), end_id=2)
    return token_store.token_index(spark, path)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        _table(spark, sf_dir, "documents"), capacity=4096, tokenizer_path=tokenizer_file(), end_id=1
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return importance.resample(docs, target, width=1, buckets=10_000, percent=10, least_words=20, seed=2024)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    path = f"{Stages(spark, 'positional-index').base}/index"
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return positional_index.contamination(docs, items, path, width=10).select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = walsh_codes.train(_table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)
    encoded = Stages(spark, "codes").write(codes.encode(), "encoded")
    return walsh_codes.label_errors(encoded).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256")
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: query for name, query in globals().items() if name.startswith("op") and name[2].isdigit()
    }
