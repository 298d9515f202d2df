"""Queries that show single functions on whole tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import geom as G
from quire.functions import text as T
from quire.operators import layout
from quire.operators.spatial import left_box, prefixed, right_box
from quire.plans.views import frags, lines, sql, table
from quire.queries import NORM_WS, ORACLE, QUERIES, _area, _inter, _overlap, query

__all__ = ["ORACLE", "QUERIES"]

LETTERS = "length(regexp_replace(text, '[^A-Za-z]', '', 'g'))"
ASCII = r"regexp_full_match(text, '[\x00-\x7f]*')"


@query("text_normals", sql("frags", f"SELECT page, ln, {NORM_WS.format('text')} AS ws, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS alnum, regexp_replace(lower(text), '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]', '', 'g') AS cjk, nfc_normalize(replace(replace(text, 'ﬁ', 'fi'), 'ﬂ', 'fl')) AS plain FROM frags"))
def text_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return frags(spark, sf_dir).select("page", "ln", T.norm_ws(t).alias("ws"), T.norm_alnum(t).alias("alnum"), T.norm_text(t).alias("cjk"), T.norm_ligature(t).alias("plain"))


@query("text_predicates", sql("frags", f"SELECT page, ln, length(text) >= 3 AND regexp_full_match(text, '[\\x20-\\x7e]*') AND conf >= 0.5 AND {LETTERS} >= 3 AND {LETTERS}::DOUBLE / length(text) >= 0.6 AND regexp_matches(text, '[A-Za-z]{{2,}}') AS english, length(text) >= 4 AND {ASCII} AND {LETTERS} >= 4 AND {LETTERS}::DOUBLE / length(text) >= 0.7 AND regexp_matches(text, '[A-Za-z]{{2,}}') AS looks, len(list_filter(regexp_extract_all(text, '[A-Za-z]{{3,}}'), lambda w: regexp_matches(w, '[aeiouyAEIOUY]'))) > 0 AS plausible, regexp_matches(text, '(?i)^\\s*sources?\\b') AS citation, regexp_matches(text, '^[A-Z0-9&.\\-]{{2,6}}$') AS ticker, regexp_matches(text, '[\\x{{4e00}}-\\x{{9fff}}]') AND NOT regexp_matches(text, '[A-Za-z]{{3,}}') AS translated FROM frags"))
def text_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return frags(spark, sf_dir).select("page", "ln", T.is_english(t, F.col("conf")).alias("english"), T.looks_english(t).alias("looks"), T.plausible(t).alias("plausible"), T.is_citation(t).alias("citation"), T.is_ticker(t).alias("ticker"), T.already_translated(t).alias("translated"))


@query("dedup_lines", "SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(l, list_prepend(NULL, l[1:len(l) - 1])), lambda p: p[1] <> '' AND (p[2] IS NULL OR p[1] <> p[2])), lambda p: p[1]), chr(10)) AS text FROM (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')) AS l FROM documents)")
def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.dedup_lines(F.col("text")).alias("text"))


@query("text_widths", sql("lines", r"SELECT page, ln, length(regexp_replace(text, '[\x{0}-\x{2e7f}]', '', 'g')) + (length(text) - length(regexp_replace(text, '[\x{0}-\x{2e7f}]', '', 'g'))) * 0.56::DOUBLE AS em, length(text)::INT AS shown FROM lines"))
def text_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return lines(spark, sf_dir).select("page", "ln", T.width_em(t).cast("double").alias("em"), T.display_width(t).alias("shown"))


@query("report_cells", r"SELECT p_partkey, replace(trim(regexp_replace(p_type || chr(10) || ' | ' || p_name, '\s+', ' ', 'g'), ' '), '|', '\|') AS cell, trim(regexp_extract(p_name || ' (' || p_type || ')', '^([^(（]*)', 1), ' ') AS head, '#' || lower(lpad(to_hex(p_partkey * 7919 % 16777216), 6, '0')) AS color, CASE WHEN p_size >= 40 THEN 'Black' WHEN p_size >= 20 THEN 'Bold' ELSE 'Medium' END AS weight FROM part")
def report_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", T.cell(F.concat("p_type", F.lit("\n"), F.lit(" | "), "p_name")).alias("cell"), T.before_paren(F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))).alias("head"), T.color_hex(F.col("p_partkey") * 7919).alias("color"), T.font_weight(F.lit("Other"), F.col("p_size")).alias("weight"))


CASES = [(1, "图 3.1说明。", "$97.4B in 2024", "974 亿"), (2, "第章2", "Aug 11, 2020", "2020 年 8 月"), (3, "plain", "1?2 and 33", "x"), (4, "表4.2 and中文", "33 cats", "x")]


@query("structure_words", "SELECT * FROM (VALUES (1, 'Figure 3.1 说明.', 'unit'), (2, '第 Chapter 2', 'date'), (3, 'plain', 'noise'), (4, 'Table 4.2 and 中文', 'check')) t(id, text, kind)")
def structure_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.createDataFrame(CASES, "id int, zh string, src string, tgt string")
    missing = T.num_missing(T.num_runs(F.col("src")), T.num_runs(F.col("tgt"), every=True))
    return df.select("id", T.structure_words(F.col("zh")).alias("text"), T.classify_number(missing, F.col("src"), F.col("tgt")).alias("kind"))


@query("glyph_ranks", "SELECT font, glyph, code FROM (SELECT p_brand AS font, p_size AS glyph, p_partkey AS code, row_number() OVER (PARTITION BY p_brand, p_size ORDER BY CASE WHEN p_partkey < 500 THEN 0 WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END, p_partkey) AS k FROM part) WHERE k = 1")
def glyph_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the code points of a glyph, the one of the best class."""
    code = F.col("p_partkey")
    rank = F.when(code < 500, 0).when(code % 2 == 0, 1).otherwise(2)
    best = F.row_number().over(Window.partitionBy("p_brand", "p_size").orderBy(rank, code))
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("font"), F.col("p_size").alias("glyph"), code.alias("code"), best.alias("k")).where("k = 1").drop("k")


@query("box_measures", sql("frags", f", p AS (SELECT a.page, a.ln, {_inter('a', 'b')} AS i, {_area('a')} AS sa, {_area('b')} AS sb, least(a.y1, b.y1) - greatest(a.y0, b.y0) > 0.6::DOUBLE * least(a.y1 - a.y0, b.y1 - b.y0) AS vo, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) / greatest(least(a.x1 - a.x0, b.x1 - b.x0), 1e-6) AS xo, greatest(0, b.y0 - a.y1, a.y0 - b.y1) AS gap FROM frags a JOIN frags b ON a.page = b.page AND b.ln = a.ln + 1) SELECT page, ln, round_even(sa, 4) AS area, round_even(i / greatest(least(sa, sb), 1e-6), 6) AS overlap_min, round_even(i / greatest(sa, 1.0), 6) AS overlap_self, round_even(i / (sa + sb - i), 6) AS iou, vo AS v_overlap, round_even(xo, 6) AS x_overlap, gap::DOUBLE AS vgap FROM p"))
def box_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frags(spark, sf_dir).select("page", "ln", "x0", "y0", "x1", "y1")
    both = prefixed(f, "l_").join(prefixed(f, "r_"), (F.col("l_page") == F.col("r_page")) & (F.col("r_ln") == F.col("l_ln") + 1))
    a, b = left_box(), right_box()
    r = lambda c: F.bround(c, 6)
    return both.select(F.col("l_page").alias("page"), F.col("l_ln").alias("ln"), F.bround(G.area(a), 4).alias("area"), r(G.overlap_min(a, b)).alias("overlap_min"), r(G.overlap_self(a, b)).alias("overlap_self"), r(G.iou(a, b)).alias("iou"), G.v_overlap(a, b).alias("v_overlap"), r(G.x_overlap_ratio(a, b)).alias("x_overlap"), G.vgap(a, b).cast("double").alias("vgap"))


@query("box_moves", sql("frags", "SELECT page, ln, round_even(y0 / 1000, 6) AS tx0, round_even(1 - x1 / 2000, 6) AS ty0, round_even(greatest(0, x0 - greatest(2, 0.18::DOUBLE * greatest(x1 - x0, y1 - y0))), 6) AS px0, round_even(least(600, x1 + greatest(2, 0.18::DOUBLE * greatest(x1 - x0, y1 - y0))), 6) AS px1, x1 - x0 < 34 AND y1 - y0 > 18 AND y1 - y0 > 1.4::DOUBLE * (x1 - x0) AS vertical, round_even(least(4.6::DOUBLE, greatest(3.6::DOUBLE, 1.6::DOUBLE * (y1 - y0))), 2) AS micro FROM frags"))
def box_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = G.box()
    turned = G.turned_back(G.Box(F.col("x0") / 2000, F.col("y0") / 1000, F.col("x1") / 2000, F.col("y1") / 1000))
    p = G.padded(b, G.adaptive_pad(b), F.lit(600.0), F.lit(800.0))
    r = lambda c: F.bround(c, 6)
    return frags(spark, sf_dir).select("page", "ln", r(turned.x0).alias("tx0"), r(turned.y0).alias("ty0"), r(p.x0).alias("px0"), r(p.x1).alias("px1"), G.is_vertical(b).alias("vertical"), G.micro_size(b.y1 - b.y0).alias("micro"))


@query("anchor_candidates", sql("frags", "SELECT l.page, l.ln, min(greatest(0, r.y0 - l.y1, l.y0 - r.y1))::DOUBLE AS gap FROM frags l JOIN frags r ON l.page = r.page AND l.ln <> r.ln AND greatest(0, least(l.x1, r.x1) - greatest(l.x0, r.x0)) / greatest(least(l.x1 - l.x0, r.x1 - r.x0), 1e-6) >= 0.5 GROUP BY 1, 2"))
def anchor_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance to the nearest block of the page above or below that shares half of the width."""
    f = frags(spark, sf_dir).select("page", "ln", "x0", "y0", "x1", "y1")
    return layout.nearest_sharing(f)


@query("unit_statistics", "SELECT p_brand AS font, p_size AS size, count(*) AS n FROM part GROUP BY 1, 2 ORDER BY n DESC, font, size LIMIT 30")
def unit_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("font"), F.col("p_size").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "font", "size").limit(30)


@query("suspicious_pages", sql("pairs", r"SELECT page, sum(len(regexp_extract_all(src, '[A-Za-z]{2,}')))::BIGINT AS n_words, sum(len(regexp_extract_all(tgt, '[\x{3400}-\x{9fff}]')))::BIGINT AS n_cjk FROM pairs GROUP BY page HAVING sum(len(regexp_extract_all(src, '[A-Za-z]{2,}'))) >= 25 AND sum(len(regexp_extract_all(tgt, '[\x{3400}-\x{9fff}]'))) < 10"))
def suspicious_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with many source words and hardly any target characters."""
    from quire.plans.views import pairs

    per = pairs(spark, sf_dir).groupBy("page").agg(F.sum(F.regexp_count("src", F.lit(T.WORD))).alias("n_words"), F.sum(F.regexp_count("tgt", F.lit(T.CJK_WIDE))).alias("n_cjk"))
    return per.where("n_words >= 25 AND n_cjk < 10")


@query("page_chunks", sql("lines", "SELECT (page - 1) // 50 AS chunk, count(*) AS n_lines, min(page) AS first_page, max(page) AS last_page FROM lines GROUP BY 1"))
def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 50 pages that can be built apart."""
    return lines(spark, sf_dir).groupBy(F.floor((F.col("page") - 1) / 50).cast("long").alias("chunk")).agg(F.count(F.lit(1)).alias("n_lines"), F.min("page").alias("first_page"), F.max("page").alias("last_page"))
