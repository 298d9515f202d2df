"""Exact deduplication against a historical index by minimal perfect hashing.

The index covers the distinct digests of the history. It is a table of shards, a shard being a range of digests with a
minimal perfect hash whose slots hold the full digest, the winner's locator (its id) and the size of its group. A new
batch is first summed to one row per digest, so a text that fills a third of the batch is one row from there on. Each
digest then meets its shard: the slot that the hash names is compared byte by byte with the digest, so a nonmember
never counts as a repeat. Nonmembers group separately: each is a group of its own batch.

Texts are equal when identical after replacing each run of white space (U+0020, U+0009 to U+000D) by one space.

Cases: a null text counts as empty; all empty texts are one group; a null id never wins against another id and two
rows that repeat id and text both count as kept, as nothing tells them apart; an empty history or batch is fine;
columns beside id and text are ignored, whatever their names; texts of any length are digested whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm import kernels as K
from quire.llm.perfect_hash import PerfectHash

INDEX = "shard int, hash binary, digests binary, winners binary, sizes binary"
FOUND = "digest binary, keep_id long, group_size long"
#: Stands for a null id in packed locators, and loses against every other id.
NO_ID = (1 << 63) - 1
#: Digests that a shard holds on average.
SHARD_DIGESTS = 100_000


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and 32-byte SHA-256 digest of each normalised text."""
    return docs.select(F.col(id_col).cast("long").alias("id"), digest_of(F.col(text_col)).alias("digest"))


def digest_of(text: Column) -> Column:
    one_space = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.sha2(one_space.cast("binary"), 256))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))


def _shard(shards: int):
    """Shard of a digest by its first 3 bytes."""
    return (F.conv(F.hex(F.substring("digest", 1, 3)), 16, 10).cast("long") * shards / (1 << 24)).cast("int")


def _words(digest: np.ndarray) -> np.ndarray:
    """64-bit hashes of n x 32 bytes of digests."""
    w = np.ascontiguousarray(digest).view("<u8").reshape(-1, 4)
    return K.mixed(w[:, 0] + K.mixed(w[:, 1] + K.mixed(w[:, 2] + K.mixed(w[:, 3]))))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """Index rows from (id, digest) rows of the history; store them to dedupe later batches."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = _matrix(pdf["digest"])
        h = _words(keys)
        ph = PerfectHash.build(h)
        at = ph.slots(h)
        full, winner, size = np.empty_like(keys), np.empty(len(h), np.int64), np.empty(len(h), np.int64)
        full[at] = keys
        winner[at] = pdf["first"].fillna(NO_ID).to_numpy(np.int64)
        size[at] = pdf["n"].to_numpy(np.int64)
        return pd.DataFrame([[int(pdf["shard"].iloc[0]), ph.tobytes(), full.tobytes(), winner.tobytes(), size.tobytes()]], columns=["shard", "hash", "digests", "winners", "sizes"])

    summed = _summed(history).withColumn("first", F.coalesce("first", F.lit(NO_ID))).withColumn("shard", _shard(shards))
    return summed.groupBy("shard").applyInPandas(common.tidied(build), INDEX)


def look_up(batch: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """One row per distinct digest of the batch's (id, digest) rows or of the history: digest, keep_id, group_size."""

    def resolve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        first, n = left["first"].to_numpy(np.int64), left["n"].to_numpy(np.int64)
        digest = list(left["digest"])
        if not len(right):
            return pd.DataFrame({"digest": digest, "keep_id": first, "group_size": n})
        row = right.iloc[0]
        full = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        winner, size = np.frombuffer(row["winners"], np.int64).copy(), np.frombuffer(row["sizes"], np.int64).copy()
        member = np.zeros(len(left), bool)
        if len(left):
            keys = _matrix(left["digest"])
            at = PerfectHash.frombytes(row["hash"]).slots(_words(keys))
            member = (at >= 0) & (full[at] == keys).all(axis=1)
            winner[at[member]] = np.minimum(winner[at[member]], first[member])
            size[at[member]] += n[member]
        out = [pd.DataFrame({"digest": [x.tobytes() for x in full], "keep_id": winner, "group_size": size})]
        if not member.all():  # nonmembers group separately
            out.append(pd.DataFrame({"digest": [d for d, m in zip(digest, member, strict=True) if not m], "keep_id": first[~member], "group_size": n[~member]}))
        return pd.concat(out, ignore_index=True)

    summed = _summed(batch).withColumn("first", F.coalesce("first", F.lit(NO_ID))).withColumn("shard", _shard(shards))
    return summed.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(common.tidied(resolve), FOUND)


def groups(rows: DataFrame, history_share: float = 0.5) -> DataFrame:
    """digest, keep_id and group_size of each distinct digest of stored (id, digest) rows.

    The rows with the lower ids, up to history_share of the range, are the history that the index covers; the others
    are the new batch. The result doesn't depend on the share.
    """
    spark = common.session(rows)
    low, high, n = rows.agg(F.min("id"), F.max("id"), F.count(F.lit(1))).first()
    border = (low or 0) + int(((high or 0) - (low or 0)) * history_share)
    shards = max(1, min(1 << 20, max(common.partitions_for(spark), -(-int(n * history_share) // SHARD_DIGESTS))))
    old = F.coalesce(F.col("id") <= border, F.lit(False))
    index = common.stored(build_index(rows.where(old), shards), "digest-index")
    return look_up(rows.where(~old), index, shards)


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that exact_dedup() keeps, with all their columns. Texts are digested once, as the rows are written."""
    rows = common.stored(docs.withColumn("__digest", digest_of(F.col(text_col))), "digested")
    found = groups(rows.select(F.col(id_col).cast("long").alias("id"), F.col("__digest").alias("digest")))
    winner = found.select(F.col("digest").alias("__of"), F.when(F.col("keep_id") != NO_ID, F.col("keep_id")).alias("__keep"))
    return rows.join(winner, (F.col("__digest") == F.col("__of")) & F.col(id_col).cast("long").eqNullSafe(F.col("__keep")), "left_semi").select(*docs.columns)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", history_share: float = 0.5) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row; the smallest id of equal texts is kept."""
    rows = common.stored(digests(docs, id_col, text_col), "digests")
    found = groups(rows, history_share)
    # A join that Spark may split: a digest with a third of all rows is dealt over many tasks.
    joined = rows.join(found.withColumnRenamed("digest", "of"), F.col("digest") == F.col("of"))
    keep = F.when(F.col("keep_id") != NO_ID, F.col("keep_id"))
    return joined.select(F.col("id").alias("doc_id"), keep.alias("keep_id"), "group_size", F.col("id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


EXACT_DEDUP_SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""
