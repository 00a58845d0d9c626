"""The corpus pipeline: language ID, near-duplicate removal, repeated passages, decontamination, mixing.

Each stage works on all documents that the one before has kept, by an operator
of ``surfrank.llm``, and what it decides takes effect:

1. language_id drops documents without a letter and those in none of the
   learned languages.
2. near_dedup keeps the document with the smallest id of each group of near
   duplicates (five-word shingles, similarity 0.8), with each of its texts once if
   it has several; rows with a null doc_id stay.
3. substring_dedup cuts passages of 35 words or more that come twice; n_chars
   follows the text.
4. decontamination drops documents that hold a benchmark item.
5. mixing packs what is left into blocks and returns the mix: a row for each
   span of a document, by shard and slot.

All but the last return the columns of documents, extra ones included.  SQL
can't express the stages' operators, so the tests compare them with
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surfrank.llm import decontaminate, langid, mixing, neardup, substring
from surfrank.llm.tables import broadcast_if_small, settled, table, without, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.recognised(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = neardup.near_duplicates(docs)
    copies = settled(groups.where("doc_id <> component_id").select("doc_id").distinct())
    kept = without(docs, copies, "doc_id")
    repeated = settled(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    if repeated.isEmpty():
        return kept.select(docs.columns)
    again = kept.join(broadcast_if_small(repeated), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return without(kept, repeated, "doc_id").select(docs.columns).unionByName(again.select(docs.columns))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = docs.columns
    cut = substring.remove_repeats(docs, keep=columns).toDF(*[f"c{k}" for k in range(len(columns))], "n_words", "n_removed", "kept_text")
    changed = F.col("n_removed") > 0
    value = {c: F.col(f"c{k}") for k, c in enumerate(columns)}
    value["text"] = F.col("kept_text")
    if "n_chars" in value:
        value["n_chars"] = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(value["n_chars"])
    return cut.select(*[value[c].alias(c) for c in columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _, sources, spans = mixing.mix_documents(docs)
    return spans.join(broadcast_if_small(sources.select("source_no", "source")), "source_no").select("shard", "slot", "source", "block", "doc_id", "first_word", "n_words")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
