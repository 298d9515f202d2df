"""A corpus pipeline: toxic documents go, then exact and near copies, then sources are mixed and packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame: all but the last the columns of documents. Each is
judged on its own input and written before the next one reads it.

Cases, for all stages: null ids stay null; null texts count as empty and are kept by the filters (of equal ones, one);
repeated rows are one text to the deduplications, which keep every row that has the winner's id; texts of any length go
through whole; an empty table gives an empty result; columns beside doc_id, text and source are passed on, whatever
their names (the last stage returns its own columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import forgotten, mark, stored
from quire.llm.exact_dedup import kept_rows
from quire.llm.mixing import mixed_rows
from quire.llm.near_join import one_of_each
from quire.llm.packing import pack
from quire.llm.queries import table, tokenizer
from quire.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, size=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
#: The classifier and the packing aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, since = table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # What the stage and those before it wrote is read no more.
        forgotten(spark, since, keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
