"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm.avi import clips, media_digests, text_media
from quire.llm.exact_dedup import EXACT_DEDUP_SQL, exact_dedup
from quire.llm.licenses import license_scan
from quire.llm.mixing import MIX_SQL, mix
from quire.llm.near_join import NEAR_JOIN_SQL, near_join
from quire.llm.packing import pack
from quire.llm.token_counts import token_counts
from quire.llm.token_store import read_ids, write_ids
from quire.llm.toxicity import toxicity
from quire.llm.warc import ARCHIVE_SQL, archive


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), capacity=4096, end_id=1)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op6_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages"))


def op7_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join(table(spark, sf_dir, "documents"), size=5, percent=80)


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder, manifest = write_ids(docs, tokenizer("word_bpe_49k.json"), end_id=1)
    return read_ids(folder, manifest, docs)


def op9_avi_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(text_media(table(spark, sf_dir, "documents")))


def media_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timed clips of the media that op9_avi_clips digests."""
    return clips(text_media(table(spark, sf_dir, "documents")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), limit=512)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_mix_sources": op4_mix_sources,
    "op5_license_scan": op5_license_scan,
    "op6_warc_members": op6_warc_members,
    "op7_near_join": op7_near_join,
    "op8_token_store": op8_token_store,
    "op9_avi_clips": op9_avi_clips,
    "op10_token_counts": op10_token_counts,
    "media_clips": media_clips,
}
ORACLE: dict[str, str] = {"op1_exact_dedup": EXACT_DEDUP_SQL, "op4_mix_sources": MIX_SQL, "op6_warc_members": ARCHIVE_SQL, "op7_near_join": NEAR_JOIN_SQL}
