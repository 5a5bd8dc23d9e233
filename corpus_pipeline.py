"""From raw documents to token-id shards: the training-data stages in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the runner
writes it as Parquet and hands the reread table to the next stage.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import contamination, language_id, mixing, near_dedup, token_output
from tollgate.llm.queries import table
from tollgate.llm.staging import materialise, workers_import_this


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go.

    So do null and empty texts and texts without a letter, and every document
    where no row names a language.  Null ids are rows like any other, repeated
    rows share their fate, an empty table stays empty."""
    workers_import_this(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id (of
    several rows with that id, one; without any id in the group, one row).

    Texts without words are in no group and stay, repeated rows of them once;
    an empty table stays empty."""
    workers_import_this(spark)
    rows = near_dedup.near_groups(docs).select("doc_id", "content", "component")
    # Equal ids and texts are one group; an empty set is in none and stays.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "content"))
    grouped = rows.filter("component is not null").groupBy("component").agg(first.alias("_first")).select("_first.doc_id", "_first.content")
    chosen = grouped.unionByName(rows.filter("component is null").select("doc_id", "content")).distinct().select(
        F.col("doc_id").alias("_id"), F.col("content").alias("_content"))
    stays = docs.join(chosen, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (
        F.xxhash64("text") == F.col("_content")), "left_semi")
    return stays.dropDuplicates(["doc_id", "text"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none and stay; null and empty items are held by
    none; repeated rows share their fate; with an empty benchmark all stay, and
    an empty table stays empty."""
    workers_import_this(spark)
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by their rate towards the target weights.

    A rate above 1 repeats a document, so rows may be equal again after this
    stage.  Null and empty texts have the rate of their posteriors; null ids
    have no label; without labels every document stays once; an empty table
    stays empty."""
    return mixing.mixed_documents(docs, mixing.quality_domains(table(spark, sf_dir, "labels")))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id shards; one row per document as read back from them.

    Null and empty texts are the end id alone; null ids come first in the
    shards; repeated rows each have their ids; an empty table gives no shard
    and no row."""
    workers_import_this(spark)
    return token_output.token_output(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: Language models, iterated rates and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's table is written to the
    shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if number == len(STAGES) - 1 else materialise(out, name)
    return docs
