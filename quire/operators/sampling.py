"""Review samples: features of pages, strata, risk and hash-ordered samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.config import DEFAULT, Config
from quire.functions import text as T
from quire.plans.shared import cut, global_rank


def quantile(df: DataFrame, column: str, p: float, name: str) -> DataFrame:
    """One row: sorted[min(n - 1, int(n * p))], 0 for no rows. Values are counted first, so equal ones come once."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("k"))
    ranked = cut(counts)
    n = ranked.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"))
    # The window goes over distinct values; features of pages take few.
    ends = ranked.withColumn("to", F.sum("k").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    at = F.least(F.col("n") - 1, F.floor(F.col("n") * p))
    hit = ends.crossJoin(F.broadcast(n)).where(F.col("to") > at).agg(F.min("v").alias("v"))
    return hit.select(F.coalesce("v", F.lit(0.0)).alias(name))


def page_features(blocks: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """By page of (page, layer, text, y0, y1) blocks: characters and greatest type of the text layer, blocks and small
    blocks of the second layer (l2), digits and negations of both; images and their share of the page.

    images: (page, area, page_area); without it the page has none.
    """
    h, text, second = F.col("y1") - F.col("y0"), F.col("text"), F.col("layer") == "l2"
    whole = F.sum(F.when(~second, F.length(text)).otherwise(0))
    per = blocks.groupBy("page").agg(
        (F.sum(F.when(~second, F.regexp_count(text, F.lit(T.CJK_WIDE))).otherwise(0)) + F.floor(whole / 2)).cast("long").alias("chars"),
        F.count_if(second).alias("l2"),
        F.count_if(second & (h < 5)).alias("small"),
        F.coalesce(F.max(F.when(~second & (F.length(F.trim(text)) >= 2), h)), F.lit(0.0)).alias("title"),
        F.sum(F.regexp_count(text, F.lit("[0-9]"))).alias("digits"),
        F.sum(F.regexp_count(text, F.lit(T.RISK_NEGATION))).alias("negations"),
    )
    if images is None:
        return per.withColumns({"images": F.lit(0).cast("long"), "image_share": F.lit(0.0)})
    of = images.groupBy("page").agg(F.count(F.lit(1)).alias("images"), F.bround(F.sum("area") / F.greatest(F.lit(1.0), F.max("page_area")), 3).alias("image_share"))
    return per.join(of, "page", "left").withColumns({"images": F.coalesce("images", F.lit(0)), "image_share": F.coalesce("image_share", F.lit(0.0))})


def strata(features: DataFrame) -> DataFrame:
    """page and stratum: cover, chapter, dense, chart, text or other, the first that holds, by quantiles."""
    f = cut(features)
    marks = [("title", 0.90, "q_title", f.where("title > 0")), ("l2", 0.75, "q_dense", f), ("chars", 0.25, "q_few", f), ("chars", 0.60, "q_many", f), ("l2", 0.25, "q_plain", f.where("l2 > 0"))]
    for column, p, name, rows in marks:
        f = f.crossJoin(F.broadcast(quantile(rows, column, p, name)))
    stratum = (
        F.when(F.col("page") == 1, "cover")
        .when((F.col("title") >= F.col("q_title")) & (F.col("q_title") > 0), "chapter")
        .when(F.col("l2") >= F.col("q_dense"), "dense")
        .when((F.col("chars") <= F.col("q_few")) & (F.col("l2") > 0), "chart")
        .when((F.col("chars") >= F.col("q_many")) & (F.col("l2") <= F.col("q_plain")), "text")
        .otherwise("other")
    )
    return f.select("page", stratum.alias("stratum"))


def ratio_anomalies(pairs: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """By page: pairs (page, src, tgt, status) with texts long enough whose ratio of lengths lies outside two quantiles of all."""
    n, m = F.length("src"), F.length("tgt")
    rows = pairs.where(F.col("status").isin("translated", "same") & (n >= 20) & (m >= 8)).select("page", (m / n).alias("ratio"))
    rows = cut(rows)
    bounds = quantile(rows, "ratio", low, "lo").crossJoin(quantile(rows, "ratio", high, "hi"))
    return rows.crossJoin(F.broadcast(bounds)).where("ratio < lo OR ratio > hi").groupBy("page").agg(F.count(F.lit(1)).alias("anomalies"))


def risk(features: DataFrame, anomalies: DataFrame) -> DataFrame:
    """page and risk: weighted shares of the maxima of digits, negations, ratio anomalies (page, anomalies), blocks of the second layer and small ones."""
    weights = {"digits": 1.0, "negations": 2.0, "anomalies": 2.0, "l2": 0.5, "small": 0.5}
    features = features.join(anomalies, "page", "left").withColumn("anomalies", F.coalesce("anomalies", F.lit(0)))
    f = cut(features)
    most = f.agg(*[F.greatest(F.max(c), F.lit(1)).alias(f"m_{c}") for c in weights])
    total = reduce(lambda a, b: a + b, [w * F.col(c) / F.col(f"m_{c}") for c, w in weights.items()])
    return f.crossJoin(F.broadcast(most)).select("page", F.bround(total, 4).alias("risk"))


def md5_order(seed: int, column: str) -> Column:
    """A random order that any engine can follow."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(column).cast("string")))


def quotas(sizes: dict[str, int], n: int, ratio: float) -> dict[str, tuple[int, int]]:
    """By stratum, in their order: how many pages are drawn, and how many of these stay after the largest were trimmed."""
    want = max(1, round(n * ratio))
    drawn = {s: 1 if s == "cover" else min(k, max(1, round(want * k / n))) for s, k in sizes.items()}
    left = dict(drawn)
    while sum(left.values()) > want + 2:
        open_ = [s for s, k in left.items() if s != "cover" and k > 1]
        if not open_:
            break
        left[max(open_, key=left.get)] -= 1
    return {s: (drawn[s], left[s]) for s in sizes}


def stratified(pages: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Pages of (page, stratum) drawn in proportion: at least one per stratum, the cover always; of strata with too many,
    the last pages go."""
    rows = cut(pages)
    # At most six strata: their sizes are counted out on the driver, first those that come first in the document.
    known = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("size"), F.min("page").alias("first")).collect()
    known.sort(key=lambda r: r["first"])
    if not known:
        return rows.select("page", "stratum")
    n = sum(r["size"] for r in known)
    given = quotas({r["stratum"]: r["size"] for r in known}, n, cfg.sample_ratio)
    out, at, taken = [], 0, 0
    for r in sorted(known, key=lambda r: r["stratum"]):
        draw, stay = given[r["stratum"]]
        out.append((r["stratum"], draw, stay, at, taken))
        at, taken = at + r["size"], taken + draw
    quota = F.broadcast(rows.sparkSession.createDataFrame(out, "stratum string, draw long, stay long, at long, taken long"))
    # Ranks within a stratum: by range, so that a stratum with most pages isn't one task's.
    ranked = global_rank(rows, "r", F.col("stratum"), md5_order(cfg.seed, "page"), F.col("page"))
    drawn = cut(ranked.join(quota, "stratum").where(F.col("r") - F.col("at") <= F.col("draw")).select("page", "stratum"))
    placed = global_rank(drawn, "r", F.col("stratum"), F.col("page"))
    return placed.join(quota, "stratum").where(F.col("r") - F.col("taken") <= F.col("stay")).select("page", "stratum")


def forced(risks: DataFrame, sampled: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The riskiest pages that weren't drawn, up to a share of all."""
    rows = cut(risks)
    n = rows.agg(F.ceil(F.count(F.lit(1)) * cfg.force_cap).alias("cap"))
    ranked = global_rank(rows.join(sampled.select("page"), "page", "left_anti"), "r", F.desc("risk"), F.col("page"))
    return ranked.crossJoin(F.broadcast(n)).where("r <= cap").select("page", "risk")


def every_step(pages: DataFrame, k: int = 8) -> DataFrame:
    """Pages at equal distances in the order of mean confidence."""
    rows = cut(pages)
    n = rows.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / k)).alias("step"))
    ranked = global_rank(rows, "r", F.col("conf"), F.col("page"))
    return ranked.crossJoin(F.broadcast(n)).where("(r - 1) % step = 0 AND (r - 1) / step < " + str(k)).select("page", "conf")


def by_class(blocks: DataFrame, n: int = 12, cap: int = 14, seed: int = 7) -> DataFrame:
    """A sample of blocks (page, ln, cls) by class: a sixth numbers, half labels, the rest sentences; at most cap."""
    few, half = max(3, n // 6), n // 2
    parts = [("skip_numeric", few), ("label", half), ("sentence", max(0, n - few - half))]
    key = F.md5(F.concat_ws(":", F.lit(seed), "page", "ln"))
    drawn = None
    for cls, k in parts:
        one = blocks.where(F.col("cls") == cls).withColumn("k", key).orderBy("k").limit(k)
        drawn = one if drawn is None else drawn.unionByName(one)
    return drawn.orderBy("k").limit(cap).select("page", "ln", "cls")


def sampled_words(texts: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row: Latin words and CJK characters, and whether they are too few for a verdict."""
    n = F.regexp_count("text", F.lit("[A-Za-z0-9]+")) + F.regexp_count("text", F.lit(T.CJK_WIDE))
    return texts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n_words")).withColumn("inconclusive", F.col("n_words") < cfg.min_words)


def long_sentences(pairs: DataFrame, k: int = 10, cfg: Config = DEFAULT) -> DataFrame:
    """k pairs with long targets in the order of a hash."""
    key = F.md5(F.concat_ws(":", F.lit(cfg.seed), "doc", "ln"))
    return pairs.where(F.col("status").isin("translated", "same") & (F.length("tgt") >= cfg.long_sentence)).orderBy(key).limit(k).select("doc", "ln", "page")
