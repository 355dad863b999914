"""A corpus pipeline of five stages: toxicity, quality, exact copies, near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and rereads it as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import exact, jaccard, packing, q04_quality, q05_toxicity, q10_packing, rules, toxicity
from spanloom.llm.common import materialize, read
from spanloom.llm.sampling import spare_name


def same(docs: DataFrame) -> list[Column]:
    """The columns of documents, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def print_of() -> Column:
    """The hash of a row's text that `exact.find_copies` returns as text_sha256."""
    return F.sha2(exact.normalise(F.col("text")), 256)


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs without the rows of dropped (doc_id, text_sha256); another text under the same doc_id stays."""
    name = spare_name(docs, "print")
    gone = dropped.withColumnRenamed("text_sha256", name)
    return docs.withColumn(name, print_of()).join(gone, ["doc_id", name], "left_anti").select(*same(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold."""
    model = q05_toxicity.fit_outside_fold(docs, read(spark, sf_dir, "labels"))
    name = spare_name(docs, "toxicity")
    return toxicity.score(docs, model, name).where(F.col(name) < q05_toxicity.THRESHOLD).drop(name)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    ensemble = q04_quality.fit_outside_fold(docs, read(spark, sf_dir, "labels"))
    name = spare_name(docs, "quality")
    return rules.score(docs, ensemble, name).where(F.col(name) >= q04_quality.THRESHOLD).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the smallest doc_id.

    Rows that repeat a doc_id and text are one document. Rows without a doc_id stay.
    """
    found = materialize(exact.find_copies(docs).where("not kept").select("doc_id", "keep_id", "text_sha256"), "copies")
    others = found.where("doc_id <> keep_id").select("doc_id", "text_sha256").distinct()
    left = without(docs, others)
    again = found.where("doc_id = keep_id").select("doc_id").distinct()
    if again.isEmpty():
        return left
    once = (
        left.join(again, "doc_id", "left_semi")
        .groupBy("doc_id", print_of().alias("print"))
        .agg(F.max_by(F.struct(*same(docs)), F.char_length("text")).alias("row"))
        .select("row.*")
    )
    return left.join(again, "doc_id", "left_anti").select(*same(docs)).union(once.select(*same(docs)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each class of similar word shingle sets (five words, 0.8).

    Where a doc_id repeats, its texts are documents of their own: doc_id and text are numbered in their order, and the
    smallest number of a class is kept.
    """
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if again.isEmpty():
        found = jaccard.link_classes(docs, size=5, percent=80)
        dropped = materialize(found.where("doc_id <> component_id").select("doc_id").distinct(), "near-copies")
        return docs.join(dropped, "doc_id", "left_anti").select(*same(docs))
    texts = docs.where("doc_id is not null").select("doc_id", print_of().alias("text_sha256"), "text")
    numbers = materialize(exact.number(texts, ["doc_id", "text_sha256"], "numbered"), "numbers")
    numbered = texts.join(numbers, ["doc_id", "text_sha256"]).select(F.col("name").alias("doc_id"), "text")
    found = jaccard.link_classes(numbered, size=5, percent=80).where("doc_id <> component_id")
    dropped = numbers.join(found.select(F.col("doc_id").alias("name")).distinct(), "name", "left_semi")
    return without(docs, materialize(dropped.select("doc_id", "text_sha256"), "near-copies"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, packed: one row per piece."""
    tokenizer = q10_packing.public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, tokenizer, q10_packing.END_ID, q10_packing.CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("best_fit_packing", pack),
]

#: Learned stages can't be expressed in SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
