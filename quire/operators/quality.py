"""Quality of readings: verdicts, conflicts of duplicate readings and the gate."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quire.config import DEFAULT, Config
from quire.functions import text as T
from quire.functions.geom import overlap_min
from quire.operators.spatial import box_join, left_box, prefixed, right_box


def reasons(cfg: Config = DEFAULT) -> Column:
    low = F.when(F.col("conf") < cfg.conf_review, F.lit("low_conf"))
    return F.array_compact(F.concat(F.array(low), T.garbage_reasons(F.col("text"))))


def verdicts(blocks: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """skip, review or ok, with reasons in order."""
    rows = blocks.withColumn("reasons", reasons(cfg))
    hard = (F.col("conf") < cfg.conf_skip) | F.arrays_overlap("reasons", F.array(F.lit("noise_digits"), F.lit("char_repeat")))
    return rows.withColumn("verdict", F.when(hard, "skip").when(F.size("reasons") > 0, "review").otherwise("ok"))


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two readings by matching blocks."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def conflicts(blocks: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Pairs of blocks of a page at one place whose readings differ: page, first, second, ratio."""
    rows = blocks.select("page", "ln", "x0", "y0", "x1", "y1", T.norm_text(F.col("text")).alias("norm"))
    rows = rows.where("norm <> ''")
    theta = (F.col("l_ln") < F.col("r_ln")) & (F.col("l_norm") != F.col("r_norm")) & (overlap_min(left_box(), right_box()) >= cfg.reading_overlap)
    found = box_join(prefixed(rows, "l_"), prefixed(rows, "r_"), theta)
    found = found.select(F.col("l_page").alias("page"), F.col("l_ln").alias("first"), F.col("r_ln").alias("second"), ratio("l_norm", "r_norm").alias("ratio"))
    return found.where(F.col("ratio") < cfg.reading_ratio)


def best_reading(blocks: DataFrame, again: DataFrame, least: float = 0.45, same: float = 0.75) -> DataFrame:
    """For each block the second reading that covers it best, and whether both agree."""
    theta = overlap_min(left_box(), right_box()) >= least
    found = box_join(prefixed(blocks, "l_"), prefixed(again, "r_"), theta).withColumn("overlap", overlap_min(left_box(), right_box()))
    best = found.groupBy("l_page", "l_ln").agg(F.max_by(F.struct("l_text", "r_text"), F.struct("overlap", -F.col("r_ln"))).alias("m"))
    rows = best.select(F.col("l_page").alias("page"), F.col("l_ln").alias("ln"), ratio(T.norm_text(F.col("m.l_text")), T.norm_text(F.col("m.r_text"))).alias("ratio"))
    return rows.withColumn("agrees", F.col("ratio") >= same)


def gate(verdict_rows: DataFrame, agreement: float | None = None) -> DataFrame:
    """One row: counts, shares and GO, GO*, REVIEW or NO-GO."""
    one = verdict_rows.agg(F.count(F.lit(1)).alias("n_blocks"), F.count_if(F.col("verdict") == "skip").alias("n_skip"), F.count_if(F.col("verdict") == "review").alias("n_review"))
    n = F.greatest(F.col("n_blocks"), F.lit(1))
    skip, review, agreed = F.col("n_skip") / n, F.col("n_review") / n, F.lit(agreement).cast("double")
    bad = (skip > 0.25) | F.coalesce(agreed < 0.60, F.lit(False))
    good = (skip <= 0.05) & (review <= 0.15)
    verdict = F.when(bad, "NO-GO").when(good & agreed.isNull(), "GO*").when(good & (agreed >= 0.85), "GO").otherwise("REVIEW")
    return one.withColumn("gate", verdict)
