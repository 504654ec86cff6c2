"""The corpus pipeline: five stages from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the
next one's docs.  All but the last return the columns of ``documents``.

1. quality: the attention model learnt from ``labels`` scores every text; those under 0.5 go.
2. near_duplicates: five-word shingles, similarity 0.8; one document of each component stays.
3. secrets: every secret span is replaced by a mask; no document goes.
4. mix: sources get their target shares; a document drawn twice stands twice, one not drawn goes.
5. packing: the drawn documents' token ids fill sequences of 4096.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlift.llm import ngram_join, packing, quality_mil, secret_scan, source_mix
from cohortlift.llm.bitmaps import Bitmap
from cohortlift.llm.queries import tokenizer_file
from cohortlift.llm.shipping import ship
from cohortlift.llm.staging import Stages, bound_batches
from cohortlift.session import shared_dir


def _begin(spark: SparkSession) -> None:
    """The code for the executors, and batches bounded by bytes; most stages run after they return, so the bound stays."""
    ship(spark)
    bound_batches(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least 0.5; a null text is scored as an empty one."""
    _begin(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_mil.train(quality_mil.training_rows(docs, labels, "quality", 3, 1))
    mark = _fresh(docs, "score")
    return quality_mil.score(docs, model, mark).where(F.col(mark) >= 0.5).select(*docs.columns)


def _fresh(docs: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as set it apart from the columns of ``docs``."""
    return name if name not in map(str.lower, docs.columns) else _fresh(docs, f"_{name}")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component.

    A document is a row's doc_id and text: rows that share only a doc_id are different documents, and of rows that
    share both one stays.  Rows with a null doc_id or without words are no one's copies and stay.
    """
    _begin(spark)
    tables = Stages(spark, "near-duplicates")
    key, mark = _fresh(docs, "key"), _fresh(docs, "mark")
    keyed = docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    rows = keyed.select(F.col(key).alias("doc_id"), "text")
    found = tables.write(ngram_join.jaccard_components(rows, width=5, num=4, den=5).where("n_shingles > 0"), "components")
    # What goes, and what stays once of several rows; all else stays without being looked up.
    special = tables.write(
        found.groupBy("doc_id").agg(F.first("component_id").alias("component_id"), F.count("*").alias("n"))
        .where("doc_id <> component_id or n > 1")
        .select(F.col("doc_id").alias(key), (F.col("doc_id") == F.col("component_id")).alias(mark)), "special",
    )
    asked = _fresh(docs, "asked")
    rows = Bitmap(special, key).marked(keyed, asked, key)
    looked_up = rows.where(asked).join(special, key, "left")
    once = looked_up.where(F.col(mark)).dropDuplicates([key])
    out = rows.where(~F.col(asked)).select(*docs.columns)
    for part in (looked_up.where(F.col(mark).isNull()), once):
        out = out.unionByName(part.select(*docs.columns))
    return out


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and ``n_chars`` following the text."""
    _begin(spark)
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every draw, dealt into the mixture's shards and shuffled in each."""
    _begin(spark)
    # The mixture's rows lie shard by shard, in their shuffled places, from its last window on.
    return source_mix.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece's place in a sequence of at most 4096 ids."""
    _begin(spark)
    return packing.pack(docs, capacity=4096, tokenizer_path=tokenizer_file(), end_id=1)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("packing", pack),
]

#: Learnt scores, seeded draws and a tokenizer's ids are beyond SQL; tests/llm checks each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared folder."""
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{base}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
