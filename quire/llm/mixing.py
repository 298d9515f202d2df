"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Within a source every document has the same expected number of copies, target / source size. Prefix sums of expected
copies run along the documents ordered by size and id; one random offset per source is added, and a document is
emitted once for every integer boundary that its step crosses. As neighbours are alike in size, the words taken stay
near the target.

A source may hold any share of the rows: ranks come from a range partitioning by (source, size, id), ranks within a
partition and a table of counts per partition and source, so no task sees a whole source. Words are counted in one pass
that writes three columns; everything after reads those. Targets take one task over one row per source: sources must be
few enough for that (some millions).

Cases: a null text has size 0; a null source is a source of its own, last in order; rows that repeat an id are rows of
their own; a source of size 0 has target 0 and takes no words; an empty table gives an empty result; columns beside
id, text and source are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import common

#: A document's words are the runs of other characters.
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), size_of(F.col(text_col)).alias("size"))


def targets(sized: DataFrame, most: int = 3) -> DataFrame:
    """source, source_size, target and rate of each source; sources by code point weigh 1, 2, 3, 1, ...

    Targets share the whole size by weight. With sources in order of most * size / weight, those before some place in
    the order stop at most * size, and the others share what is left by weight.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    all_rows = Window.partitionBy()
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("whole", F.sum("source_size").over(all_rows)).withColumn("weights", F.sum("weight").over(all_rows))
    per = per.withColumn("rest", F.col("whole") - most * F.coalesce(F.sum("source_size").over(by_cap), F.lit(0)))
    per = per.withColumn("left", F.col("weights") - F.coalesce(F.sum("weight").over(by_cap), F.lit(0)))
    capped = most * F.col("source_size") * F.col("left") <= F.col("rest") * F.col("weight")
    # The first uncapped source in the order has what is left to share.
    per = per.withColumn("capped", capped)
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), "left", "rest"))).over(all_rows)
    per = per.withColumn("free", free)
    share = F.col("free.rest") * F.col("weight") / F.col("free.left")
    target = F.when(F.col("capped"), (most * F.col("source_size")).cast("double")).otherwise(share.cast("double"))
    return per.withColumn("target", target).select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))


def offset(source: Column, seed: str) -> Column:
    """The source's random offset, from 0 to 1: a multiple of 2**-32 by MD5 of seed and source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\x00"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _mixed(sized: DataFrame, most: int, seed: str, *ties: str) -> DataFrame:
    """The stored (id, source, size, ...) rows with source_size, target and copies; equal rows are told apart by `ties`."""
    spark = common.session(sized)
    within = [F.col("size"), F.col("id").asc_nulls_first(), *[F.col(c) for c in ties]]
    ranged = sized.repartitionByRange(common.partitions_for(spark), F.col("source").asc_nulls_last(), *within)
    rows = common.stored(ranged.withColumn("part", F.spark_partition_id()), "sizes")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("part", "source").orderBy(*within)))
    parts = rows.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"))
    before = parts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    known = before.join(targets(rows, most).withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("s"), F.col("part").alias("p"), "before", "source_size", "target", "rate")
    rows = ranked.join(known, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    rank, start = F.col("rank") + F.col("before"), offset(F.col("source"), seed)
    copies = (F.floor(rank * F.col("rate") + start) - F.floor((rank - 1) * F.col("rate") + start)).cast("long")
    copies = F.least(copies, F.lit(most))  # rounding of a rate of exactly `most` may cross one boundary more
    return rows.select(*sized.columns, "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, most: int = 3, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, copies and taken of every row."""
    rows = _mixed(common.stored(sizes(docs, id_col, text_col, source_col), "counted"), most, seed)
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_rows(docs: DataFrame, most: int = 3, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row as often as mix() takes it, with all its columns, also rows that repeat an id or have none.

    Rows are numbered when they are written, so that each has its own copies. Which of several rows of one source, size
    and id has a copy more than another depends on that number.
    """
    numbered = docs.withColumns({"__row": F.monotonically_increasing_id(), "__size": size_of(F.col(text_col))})
    rows = common.stored(numbered, "numbered")
    sized = rows.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), F.col("__size").alias("size"), "__row")
    times = _mixed(sized, most, seed, "__row").where("copies > 0").select(F.col("__row").alias("__of"), F.col("copies").cast("int").alias("__times"))
    taken = rows.join(times, F.col("__row") == F.col("__of"))
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)


MIX_SQL = r"""
WITH s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1 AS weight FROM p),
o AS (SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS lft
  FROM w WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, 3 * source_size * lft <= rest * weight AS capped FROM o),
f AS (SELECT rest AS free_rest, lft AS free_left FROM c WHERE NOT capped ORDER BY source_size / weight, lft, rest LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE
  ELSE (SELECT (free_rest * weight)::DOUBLE / free_left::DOUBLE FROM f) END AS target FROM c),
r AS (SELECT s.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS FIRST) AS rank,
  ('0x' || substr(md5('mix:' || coalesce(s.source, chr(0))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  least(floor(rank * rate + u) - floor((rank - 1) * rate + u), 3)::BIGINT AS copies,
  (size * least(floor(rank * rate + u) - floor((rank - 1) * rate + u), 3))::BIGINT AS taken FROM r
"""
