"""The corpus pipeline: documents to packed training bins in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps (the last one: the packed pieces), is
written as Parquet and read again as the next one's documents.  Verdicts hold for rows, not ids: the filters name a row
by its content (128 bits of all columns), the near-duplicate stage by a number of its own.  A row with a null id is judged
like any other, and a clean row stays whatever becomes of other rows under its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm import packing, phrase_automata, prefix_trie
from scorewright.llm.common import row_key, store, table
from scorewright.llm.queries import identify_documents, judge_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _own(docs: DataFrame) -> DataFrame:
    """The columns of documents; other ones, whatever their names, do not take part."""
    return docs.select(*COLUMNS)


KEY = "__row"


def _kept(spark: SparkSession, docs: DataFrame, sf_dir: str, judge) -> DataFrame:
    """``docs`` without the rows that ``judge`` rejects; equal rows share a verdict."""
    keyed = _own(docs).withColumn(KEY, row_key(*COLUMNS))
    gone = judge(spark, keyed, sf_dir, (KEY,)).where("NOT kept").select(KEY).distinct()
    return keyed.join(gone, KEY, "left_anti").select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with an uncertain one, go."""
    return _kept(spark, docs, sf_dir, identify_documents)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably of low quality or toxic go."""
    return _kept(spark, docs, sf_dir, judge_quality)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, 0.8) stays: the least id (a null one last), of equal ids
    the least text hash.  Rows without words are copies of nothing.  Rows under one id are copies only if their texts are."""
    # the numbers are written with the rows, so that every later read sees the same ones
    rows = store(_own(docs).withColumn(KEY, F.monotonically_increasing_id()), "numbered")
    groups = prefix_trie.jaccard_components(rows, n=5, share=80, id_col=KEY).select(F.col("doc_id").alias(KEY), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", KEY)
    first = (rows.select(KEY, "doc_id", F.xxhash64("text").alias("h")).join(groups, KEY)
             .groupBy("component_id").agg(F.min(order)[KEY].alias(KEY)))
    return rows.join(first.select(KEY), KEY, "left_semi").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go; documents that lose nothing keep their text as it is."""
    docs = _own(docs)
    changed = phrase_automata.substring_dedup(docs).where("kept IS NOT NULL").select(
        F.coalesce("doc_id", F.lit(phrase_automata.LAST)).alias("__id"), F.col("row_key").alias("__key"), "kept").dropDuplicates(["__id", "__key"])
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(phrase_automata.LAST)),
                              "__key": phrase_automata.row_key_column(F.col("text"))})
    text = F.coalesce("kept", "text")
    size = F.when(F.col("kept").isNotNull(), F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return keyed.join(changed, ["__id", "__key"], "left").withColumns({"text": text, "n_chars": size}).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(docs)


STAGES = [("language ID", language_id), ("quality classifier", quality), ("n-gram Jaccard join", near_duplicates),
          ("substring dedup", substring_dedup), ("best-fit packing", pack)]

#: The language models, the fitted classifier and the greedy packing have no SQL form; tests compare the stages with
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
