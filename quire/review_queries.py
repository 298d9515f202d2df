"""Queries of the review: structure, text audit, rebuilt pages, rasters and the report over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.function_queries import ORACLE, QUERIES
from quire.functions import geom as G
from quire.functions import kernels
from quire.functions import text as T
from quire.operators import audit, rebuild, scope, structure, tracing, visual, worklist
from quire.plans.views import blocks, frags, layered, lines, pairs, sql, table
from quire.queries import backtrans_verdict, guard_diff, query, residue_verdict, stratified_sample
from quire.sources import artifacts

__all__ = ["ORACLE", "QUERIES"]

# Structure: pages of documents; the product lacks none, but some are larger, turned or have another place in the contents.

_UNITS = "un AS (SELECT page * 100000 + ln AS id, page, text, 6 + (7 * doc + 13 * ln) % 20 AS size, NOT regexp_matches(text, '[A-Za-z]') AS passthrough, CASE WHEN (doc + ln) % 6 = 0 THEN '' ELSE '译' || text END AS zh FROM blocks WHERE (doc + 3 * ln) % 17 <> 0)"
_THRESHOLD = "th AS (SELECT greatest(12.0::DOUBLE, round_even(1.4::DOUBLE * l[least(n - 1, floor(n * 0.5::DOUBLE))::BIGINT + 1], 1)) AS t FROM (SELECT list_sort(list(size)) AS l, count(*) AS n FROM un WHERE size > 0))"
_TITLES = rf", {_UNITS}, {_THRESHOLD}, ti AS (SELECT id, page, size, text, (id % 11 <> 0 AND zh <> '') AS translated FROM un, th WHERE size >= t AND length(trim(text, ' ')) >= 2 AND NOT passthrough AND NOT regexp_matches(trim(text, ' '), '^[\s0-9$%¢€£¥.,+\-–—/×x:*()\[\]<>|~=''""#&°]+$'))".replace('""', '"')


def _units(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Units, and the translations of those whose number isn't a multiple of eleven."""
    doc, ln = F.col("doc"), F.col("ln")
    rows = blocks(spark, sf_dir).where((doc + 3 * ln) % 17 != 0)
    rows = rows.select((F.col("page") * 100000 + ln).alias("id"), "page", "text", (6 + (7 * doc + 13 * ln) % 20).alias("size"), (~F.col("text").rlike("[A-Za-z]")).alias("passthrough"), F.when((doc + ln) % 6 == 0, "").otherwise(F.concat(F.lit("译"), "text")).alias("zh"))
    return rows.drop("zh"), rows.where("id % 11 <> 0").select("id", "zh")


@query("titles", sql("blocks", _TITLES + " SELECT id, page, size, text, translated FROM ti"))
def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.titles(*_units(spark, sf_dir))


def _checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("page"))
    src = d.select("page", F.lit(600.0).alias("width"), F.lit(800.0).alias("height"), ((F.col("page") % 4) * 90).alias("rotation"))
    dst = src.withColumn("width", F.col("width") + F.when(F.col("page") % 7 == 0, 0.6).otherwise(0.4)).withColumn("rotation", F.when(F.col("page") % 19 == 0, 0).otherwise(F.col("rotation")))
    toc = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pos"), F.lit(1).alias("level"), F.col("n_regionkey").alias("page"), F.col("n_name").alias("title"))
    new = toc.withColumn("title", F.when(F.col("pos") % 5 == 0, F.col("title")).otherwise(F.concat(F.lit("译"), "title"))).withColumn("page", F.when(F.col("pos") % 8 == 3, -1).otherwise(F.col("page")))
    fonts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), (F.col("p_size") > 45).alias("embedded"))
    return structure.structure_checks(src, dst, toc, new, *_units(spark, sf_dir), fonts)


_CHECKS = _TITLES + """, pg AS (SELECT doc_id + 1 AS page FROM documents), ck AS (
SELECT 0 AS ord, 'open' AS "check", 1 AS n, 0 AS n_bad UNION ALL SELECT 1, 'pages', 1, 0
UNION ALL SELECT 2, 'size', count(*), count(*) FILTER (WHERE page % 7 = 0) FROM pg UNION ALL SELECT 3, 'rotation', count(*), count(*) FILTER (WHERE page % 19 = 0 AND page % 4 <> 0) FROM pg
UNION ALL SELECT 4, 'toc', count(*), count(*) FILTER (WHERE n_nationkey % 8 = 3 OR n_nationkey % 5 = 0) FROM nation UNION ALL SELECT 5, 'titles', count(*), count(*) FILTER (WHERE NOT translated) FROM ti
UNION ALL SELECT 6, 'fonts', count(*), count(*) FILTER (WHERE NOT e) FROM (SELECT bool_or(p_size > 45) AS e FROM part GROUP BY p_brand)),
cs AS (SELECT *, CASE WHEN n = 0 THEN 'SKIP' WHEN n_bad > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ck)"""


@query("structure_checks", sql("blocks", _CHECKS + " SELECT * FROM cs"))
def structure_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven checks of a product whose every seventh page is larger, some pages turned, titles and contents untranslated."""
    return _checks(spark, sf_dir)


@query("structure_verdict", sql("blocks", _CHECKS + " SELECT count(*) FILTER (WHERE status = 'PASS') AS n_pass, count(*) FILTER (WHERE status = 'FAIL') AS n_fail, count(*) FILTER (WHERE status = 'SKIP') AS n_skip, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' ELSE 'PASS' END AS verdict, CASE WHEN bool_or(status = 'FAIL') THEN 1 ELSE 0 END AS code FROM cs"))
def structure_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.exit_verdict(_checks(spark, sf_dir))


# Characters: English lines are what was meant; others' characters are drawn by glyphs, some outside of their font's codes.


def _drawn(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    rows = lines(spark, sf_dir)
    other, meant = rows.where("lang <> 'en'").select("page", "ln", "text"), rows.where("lang = 'en'").select("page", "text")
    # Evidence is about unexpected characters: lines without any have none.
    other = other.where(T.holds(F.col("text"), audit.unexpected_signs(other, meant)))
    code = F.conv(F.hex(F.encode("ch", "utf-32")), 16, 10).cast("long")
    glyphs = other.select("page", F.explode(F.split("text", "")).alias("ch")).where(~F.col("ch").isin("", " ")).withColumn("code", code)
    glyphs = glyphs.where("code % 3 <> 0").select("page", F.when(F.col("code") % 2 == 0, "Serif").otherwise("Sans").alias("font"), "ch", ((F.col("code") + F.col("page") % 2) % 256).alias("gid"))
    spans = spark.createDataFrame([("Serif", 0, 60), ("Serif", 50, 230), ("Sans", 0, 200), ("Sans", 210, 240)], "font string, lo long, hi long")
    return other, audit.distinct_characters(meant).select(F.lit(0).alias("page"), F.col("ch").alias("text")), glyphs, spans


_EVIDENCE = """, chr_ AS (SELECT page, ln, text, lang, unnest(string_split(text, '')) AS ch FROM lines), want AS (SELECT DISTINCT ch FROM chr_ WHERE lang = 'en'),
odd AS (SELECT *, unicode(ch) AS code FROM chr_ WHERE lang <> 'en' AND NOT regexp_matches(ch, '^\\s?$') AND ch NOT IN (SELECT ch FROM want)),
gl AS (SELECT ch, CASE WHEN code % 2 = 0 THEN 'Serif' ELSE 'Sans' END AS font, (code + page % 2) % 256 AS gid FROM odd WHERE code % 3 <> 0),
gc AS (SELECT *, CASE font WHEN 'Serif' THEN gid <= 230 ELSE gid <= 200 OR gid BETWEEN 210 AND 240 END AS covered FROM gl),
tr AS (SELECT ch, array_to_string(list_sort(list(DISTINCT font)), ',') AS fonts, array_to_string(list_sort(list(DISTINCT gid))[1:6], ',') AS codes, count(*) FILTER (WHERE NOT covered) AS n_outside, count(*) AS n_traced FROM gc GROUP BY ch),
ln_ AS (SELECT ch, page, ln, min(text[1:70]) AS text FROM odd GROUP BY 1, 2, 3),
ex AS (SELECT ch, array_to_string(list(page || ':' || ln || ':' || text ORDER BY page, ln)[1:2], ' / ') AS examples, array_to_string(list_sort(list(DISTINCT page))[1:10], ',') AS pages FROM ln_ GROUP BY ch),
ev AS (SELECT o.ch, unicode(o.ch)::BIGINT AS code, o.n, pages, examples, coalesce(fonts, '') AS fonts, coalesce(codes, '') AS codes, coalesce(n_outside, 0) AS n_outside, coalesce(n_traced, 0) AS n_traced,
  CASE WHEN coalesce(n_outside, 0) > 0 THEN 'broken' WHEN coalesce(n_traced, 0) > 0 THEN 'benign' WHEN o.ch IN ('ﬀ', 'ﬁ', 'ﬂ', 'ﬃ', 'ﬄ', 'ﬅ', 'ﬆ', '⸺', '⸻') THEN 'benign' ELSE 'broken' END AS verdict
  FROM (SELECT ch, count(*) AS n FROM odd GROUP BY ch) o JOIN ex ON ex.ch = o.ch LEFT JOIN tr ON tr.ch = o.ch)"""


@query("charset_evidence", sql("lines", _EVIDENCE + " SELECT * FROM ev"))
def charset_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where unexpected characters stand, which glyphs draw them, and whether they are broken."""
    return audit.charset_evidence(*_drawn(spark, sf_dir))


@query("source_items", sql("layered", ", l2 AS (SELECT *, row_number() OVER (ORDER BY page, ln) - 1 AS k FROM layered WHERE layer = 'l2') SELECT 'p' || page || 'u' || ln AS id, page, ln, layer, text AS src, NOT regexp_matches(text, '[A-Za-z]') AS passthrough, NULL::DOUBLE AS conf FROM layered WHERE layer = 'text' UNION ALL SELECT 'l2:' || page || ':' || k, page, ln, layer, text, false, conf FROM l2"))
def source_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text units and image blocks as one table."""
    b = layered(spark, sf_dir)
    units = b.where("layer = 'text'").select(F.concat(F.lit("p"), "page", F.lit("u"), "ln").alias("id"), "page", "ln", "text", (~F.col("text").rlike("[A-Za-z]")).alias("passthrough"))
    return audit.source_items(units, b.where("layer = 'l2'"))


_DIRTY = _EVIDENCE + ", br AS (SELECT ch FROM ev WHERE verdict = 'broken'), dirty AS (SELECT DISTINCT doc, ln FROM (SELECT doc, ln, unnest(list_distinct(string_split(tgt, ''))) AS ch FROM pairs) WHERE ch IN (SELECT ch FROM br))"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).withColumn("id", F.concat_ws(":", "doc", "ln"))


@query("clean_pairs", sql("lines pairs", _DIRTY + " SELECT doc, ln FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM dirty d WHERE d.doc = p.doc AND d.ln = p.ln)"))
def clean_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs without broken characters in their target."""
    return audit.clean_pairs(_pairs(spark, sf_dir), charset_evidence(spark, sf_dir).where("verdict = 'broken'")).select("doc", "ln")


@query("text_audit")
def text_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole audit in order, as numbers of findings; tested against its parts."""
    terms = table(spark, sf_dir, "part").select(F.regexp_extract("p_name", "([A-Za-z]+)$", 1).alias("en")).distinct().withColumn("zh", F.lit("译"))
    return audit.text_audit(_pairs(spark, sf_dir), charset_evidence(spark, sf_dir), terms)


# Rebuilt pages


def _set_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks as units of one line, or of two where they are high."""
    h = F.col("y1") - F.col("y0")
    font = F.when(F.col("ln") % 3 == 0, "Serif").when(F.col("ln") % 3 == 1, "Sans").otherwise("Mono")
    return frags(spark, sf_dir).select("page", "ln", "x0", "y0", "x1", "y1", "text", (F.col("y1") - 0.2 * h).alias("baseline"), F.bround(0.8 * h, 1).alias("size"), F.when(h > 15, h / 2).alias("lineheight"), F.when(h > 15, 2).otherwise(1).alias("nlines"), font.alias("font"), (~F.col("text").rlike("[A-Za-z]")).alias("passthrough"))


def _zh(units: DataFrame) -> DataFrame:
    return units.select("page", "ln", F.when((F.col("page") + F.col("ln")) % 9 == 0, "").otherwise(F.concat("text", F.substring("text", 1, 12))).alias("zh"))


def _rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _set_units(spark, sf_dir)
    measured = spark.createDataFrame([(8.0, 1.35, 6.75)], "size double, ratio double, k double")
    pages = units.select("page").distinct().withColumn("height", F.lit(2000.0))
    return rebuild.rebuilt_boxes(units, _zh(units), measured, pages)


_RATIO = "round_even(CASE WHEN lineheight IS NOT NULL THEN least(1.8::DOUBLE, greatest(1.0::DOUBLE, lineheight / size)) WHEN size <= 14 THEN 1.35::DOUBLE ELSE 1.22::DOUBLE END, 4)"
_REBUILT = rf""", ru AS (SELECT page, ln, x0, y0, x1, y1, text, y1 - 0.2::DOUBLE * (y1 - y0) AS baseline, round_even(0.8::DOUBLE * (y1 - y0), 1) AS size, CASE WHEN y1 - y0 > 15 THEN (y1 - y0) / 2 END AS lineheight, CASE WHEN y1 - y0 > 15 THEN 2 ELSE 1 END AS nlines, CASE ln % 3 WHEN 0 THEN 'Serif' WHEN 1 THEN 'Sans' ELSE 'Mono' END AS font, CASE WHEN (page + ln) % 9 = 0 THEN '' ELSE text || text[1:12] END AS zh FROM frags),
rk AS (SELECT *, {_RATIO} AS ratio FROM ru),
rl AS (SELECT l.*, coalesce((SELECT min(r.y0 - 1.5::DOUBLE) FROM ru r WHERE r.page = l.page AND r.ln <> l.ln AND r.x1 > l.x0 + 2 AND r.x0 < l.x1 - 2 AND r.y0 >= l.y1 - 1 AND r.y0 <= l.y1 + 3 * l.ratio * l.size + 1.5::DOUBLE), l.y1 + 3 * l.ratio * l.size) AS lim FROM rk l),
rm AS (SELECT *, round_even(least(y1 + 3 * ratio * size, lim), 4) AS bottom, (baseline - CASE WHEN size = 8 AND ratio = 1.35 THEN 6.75::DOUBLE ELSE size * (0.3::DOUBLE + 0.5::DOUBLE * ratio) END) - y0 AS delta FROM rl WHERE regexp_matches(text, '[A-Za-z]') AND zh <> ''),
rn AS (SELECT *, y0 + delta AS top, least(bottom + delta, 1998::DOUBLE) AS e FROM rm),
ro AS (SELECT *, nlines = 1 AND ratio * size - (e - top) > 0 AND ratio * size - (e - top) <= 0.3::DOUBLE * size AS filled FROM rn),
rp AS (SELECT *, CASE WHEN filled THEN least(top + ratio * size, 1998::DOUBLE) ELSE e END AS fin, length(regexp_replace(zh, '[\x{{0}}-\x{{2e7f}}]', '', 'g')) AS wide FROM ro),
rq AS (SELECT *, ceil((wide + (length(zh) - wide) * 0.56::DOUBLE) * size / greatest(x1 - x0, 1.0)) * (ratio * size) AS tall, fin - top AS high FROM rp),
rr AS (SELECT *, greatest(0.7::DOUBLE, least(1.0::DOUBLE, greatest(high, 0) / greatest(tall, 1e-6))) AS sc FROM rq),
rb AS (SELECT page, ln, font, size, round_even(top, 4) AS y0, round_even(fin, 4) AS y1, filled, round_even(high - tall * sc, 1) + 0::DOUBLE AS spare, round_even(sc, 3) AS scale, length(text) AS src_len, length(zh) AS zh_len FROM rr)"""


@query("rebuilt_boxes", sql("frags", _REBUILT + " SELECT * FROM rb"))
def rebuilt_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rebuilt(spark, sf_dir)


@query("rebuild_report", sql("frags", _REBUILT + ", mi AS (SELECT count(*) AS n_missing FROM ru WHERE regexp_matches(text, '[A-Za-z]') AND zh = '') SELECT count(*) AS n_set, count(*) FILTER (WHERE scale < 0.985) AS n_shrunk, count(*) FILTER (WHERE spare < 0) AS n_dropped, (SELECT n_missing FROM mi) AS n_missing, 'Mono' AS unknown_fonts, count(*) FILTER (WHERE spare < 0) = 0 AS passed FROM rb"))
def rebuild_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up of the rebuilt pages, with the gate on text without room."""
    units = _set_units(spark, sf_dir)
    return rebuild.rebuild_report(_rebuilt(spark, sf_dir), rebuild.untranslated(units, _zh(units)), ["Serif", "Sans"])


@query("most_shrunk", sql("frags", _REBUILT + " SELECT page, ln, scale, size, src_len, zh_len FROM rb WHERE scale < 0.985 ORDER BY scale, page, ln LIMIT 20"))
def most_shrunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuild.most_shrunk(_rebuilt(spark, sf_dir))


# Titles in images, and layers

_IMAGES = ", im AS (SELECT page, ln, (doc * 7 + ln) % 23 AS xref, x0, y0, x1, y1, CASE WHEN ln % 8 = 1 THEN NULL ELSE (doc * 31 + ln * 7) % 160 + 20.0::DOUBLE END AS shade FROM blocks WHERE ln % 2 = 1)"


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd blocks as images, whose masks have four values around a mean."""
    doc, ln = F.col("doc"), F.col("ln")
    mean = (doc * 31 + ln * 7) % 160 + 20
    mask = F.when(ln % 8 != 1, F.array(mean - 20, mean + 20, mean - 5, mean + 5))
    return blocks(spark, sf_dir).where(ln % 2 == 1).select("page", "ln", ((doc * 7 + ln) % 23).alias("xref"), "x0", "y0", "x1", "y1", mask.alias("mask"))


_TALL = "(i.y1 - i.y0) / greatest(t.y1 - t.y0, 1e-6)"
_DOWN = "(least(i.y1, t.y1) - greatest(i.y0, t.y0)) / greatest(least(i.y1 - i.y0, t.y1 - t.y0), 1e-6)"
_ACROSS = "(least(i.x1, t.x1) - greatest(i.x0, t.x0)) / greatest(t.x1 - t.x0, 1e-6)"


@query("title_bitmaps", sql("blocks", _IMAGES + f""", bg AS (SELECT page, arg_max({{'xref': xref, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}, ((x1 - x0) * (y1 - y0), -ln)) AS b FROM im GROUP BY page),
cand AS (SELECT im.* FROM im JOIN bg ON im.page = bg.page WHERE NOT (im.xref = b.xref OR im.x0 = b.x0 AND im.y0 = b.y0 AND im.x1 = b.x1 AND im.y1 = b.y1) AND (im.x1 - im.x0) * (im.y1 - im.y0) < 0.5::DOUBLE * (b.x1 - b.x0) * (b.y1 - b.y0)),
met AS (SELECT i.page, i.ln, i.xref, i.shade, t.ln AS title, round_even({_DOWN} * ({_ACROSS}), 9) AS score FROM cand i JOIN blocks t ON t.page = i.page AND t.ln % 2 = 0 WHERE {_DOWN} > 0.7 AND {_ACROSS} > 0.5 AND {_TALL} BETWEEN 0.5 AND 2.5),
best AS (SELECT page, ln, xref, coalesce(shade / 255, 1) AS alpha, max((score, -title)) AS m FROM met GROUP BY 1, 2, 3, 4)
SELECT page, ln, -m[2] AS title, round_even(m[1], 6) AS score, round_even(alpha, 3) AS alpha, CASE WHEN xref = 0 THEN 'inline image' WHEN alpha > 0.35 THEN 'panel' ELSE '' END AS why, xref <> 0 AND alpha <= 0.35 AS ok FROM best"""))
def title_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images that show a title: even blocks are titles."""
    return rebuild.title_bitmaps(_images(spark, sf_dir), blocks(spark, sf_dir).where("ln % 2 = 0"))


@query("found_layers", sql("blocks", ", l AS (SELECT page, ln, ln % 4 AS w, doc % 3 AS h, x0, y0, x1, y1 FROM blocks) SELECT a.page, a.ln AS name, min(b.ln) AS layer FROM (SELECT page, ln, w, h, x0 + (ln % 3) AS x0, y0, x1 + 0.5::DOUBLE AS x1, y1 FROM l) a JOIN l b ON a.page = b.page AND a.w = b.w AND a.h = b.h AND abs(a.x0 - b.x0) <= 1.5 AND abs(a.y0 - b.y0) <= 1.5 AND abs(a.x1 - b.x1) <= 1.5 AND abs(a.y1 - b.y1) <= 1.5 GROUP BY 1, 2"))
def found_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers by pixel size and place; every third is looked for two points off, and not found."""
    ln = F.col("ln")
    rows = blocks(spark, sf_dir).select("page", "ln", (ln % 4).alias("w"), (F.col("doc") % 3).alias("h"), "x0", "y0", "x1", "y1")
    return rebuild.found_layers(rows, rows.select("page", ln.alias("name"), "w", "h", (F.col("x0") + ln % 3).alias("x0"), "y0", (F.col("x1") + 0.5).alias("x1"), "y1"))


@query("shadow_layers", sql("blocks", ", l AS (SELECT page, ln, ln % 10 AS xref, ln % 3 <> 0 AS masked, x0, y0, x1, y1 FROM blocks), s AS (SELECT t.page, t.ln, max((round_even(greatest(0, least(t.x1, r.x1) - greatest(t.x0, r.x0)) * greatest(0, least(t.y1, r.y1) - greatest(t.y0, r.y0)) / greatest((t.x1 - t.x0) * (t.y1 - t.y0), 1e-6), 9), -r.ln)) AS m FROM l t JOIN l r ON t.page = r.page AND t.xref <> r.xref AND r.masked AND least(t.x1, r.x1) > greatest(t.x0, r.x0) AND least(t.y1, r.y1) > greatest(t.y0, r.y0) WHERE t.ln % 5 = 0 GROUP BY 1, 2) SELECT page, ln, -m[2] AS shadow, round_even(m[1], 6) AS share FROM s"))
def shadow_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks(spark, sf_dir).select("page", "ln", (F.col("ln") % 10).alias("xref"), (F.col("ln") % 3 != 0).alias("masked"), "x0", "y0", "x1", "y1")
    return rebuild.shadows(rows, rows.where("ln % 5 = 0").drop("masked"))


# Rasters: vectors as pages of 8 x 8 pixels, each against the one before; a rectangle of the page is masked.

_RASTERS = """WITH ra AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE * 127 + 128) AS a FROM embeddings), rb AS (SELECT x.vec_id, x.a, y.a AS b FROM ra x JOIN ra y ON y.vec_id = x.vec_id + 1),
rc AS (SELECT vec_id, a, b, list_avg(a) AS ma, list_avg(b) AS mb, list_avg(list_transform(range(1, 65), lambda i: a[i] * b[i])) AS ab, list_avg(list_transform(a, lambda v: v * v)) AS aa, list_avg(list_transform(b, lambda v: v * v)) AS bb,
  list_transform(list_filter(range(0, 64), lambda i: NOT (i % 8 >= 1 + vec_id % 3 AND i % 8 < 5 AND i // 8 >= 2 AND i // 8 < 6)), lambda i: abs(trunc(a[i + 1]) - trunc(b[i + 1]))) AS d FROM rb),
rd AS (SELECT vec_id AS page, round_even((2 * ma * mb + 6.5025::DOUBLE) * (2 * (ab - ma * mb) + 58.5225::DOUBLE) / ((ma * ma + mb * mb + 6.5025::DOUBLE) * ((aa - ma * ma) + (bb - mb * mb) + 58.5225::DOUBLE)), 6) AS ssim,
  round_even(list_avg(d) / 255, 6) AS ae_mean, round_even(len(list_filter(d, lambda x: x > 8))::DOUBLE / len(d), 6) AS ae_share, round_even(1 - (vec_id % 40) * 0.0002::DOUBLE, 6) AS iou FROM rc),
qt AS (SELECT list_sort(list(ssim)) AS s, list_sort(list(ae_mean)) AS e, list_sort(list(iou)) AS o, count(*) AS n FROM rd),
fl AS (SELECT rd.*, ssim <= s[least(n - 1, floor(n * 0.05::DOUBLE))::BIGINT + 1] AS flag_ssim, ae_mean >= e[least(n - 1, floor(n * 0.95::DOUBLE))::BIGINT + 1] AND ae_mean > 0 AS flag_ae, ae_mean > 0.5::DOUBLE / 255 OR ae_share > 0.001 AS warn_ae, iou < 0.995 AS flag_iou FROM rd, qt)"""


def _rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    scaled = lambda c: F.transform(c, lambda v: v.cast("double") * 127 + 128)
    both = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")), "vec_id")
    inside = lambda i: (i % 8 >= 1 + F.col("vec_id") % 3) & (i % 8 < 5) & (F.floor(i / 8) >= 2) & (F.floor(i / 8) < 6)
    mask = F.transform(F.sequence(F.lit(0), F.lit(63)), inside)
    rows = both.select(F.col("vec_id").alias("page"), scaled(F.col("embedding")).alias("a"), scaled(F.col("b")).alias("b"), mask.alias("mask"), F.bround(1 - (F.col("vec_id") % 40) * 0.0002, 6).alias("iou"))
    error = kernels.abs_error("a", "b", "mask")
    rows = rows.select("page", "iou", kernels.ssim("a", "b").alias("s"), error.alias("e"))
    return rows.select("page", F.bround("s", 6).alias("ssim"), F.bround("e.mean", 6).alias("ae_mean"), F.bround("e.share", 6).alias("ae_share"), "iou")


@query("visual_flags", _RASTERS + " SELECT * FROM fl")
def visual_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual.flagged(_rasters(spark, sf_dir))


@query("visual_summary", _RASTERS + " SELECT count(*) AS n_pages, count(*) FILTER (WHERE flag_ssim) AS n_flag_ssim, count(*) FILTER (WHERE flag_ae) AS n_flag_ae, count(*) FILTER (WHERE warn_ae) AS n_warn_ae, count(*) FILTER (WHERE flag_iou) AS n_flag_iou, count(*) FILTER (WHERE flag_ssim OR flag_ae OR flag_iou) AS n_flagged, any_value(s[n // 2 + 1]) AS ssim_median, any_value(s[least(n - 1, floor(n * 0.05::DOUBLE))::BIGINT + 1]) AS ssim_floor, any_value(e[n // 2 + 1]) AS ae_median, any_value(e[least(n - 1, floor(n * 0.95::DOUBLE))::BIGINT + 1]) AS ae_ceiling, any_value(o[n // 2 + 1]) AS iou_median FROM fl, qt")
def visual_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual.rolled_up(visual_flags(spark, sf_dir))


@query("worst_pages", _RASTERS + " SELECT page, ssim FROM fl ORDER BY ssim, page LIMIT 5")
def worst_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual.worst_pages(visual_flags(spark, sf_dir))


# Drift, merges, probe

@query("drift_ranking", f"WITH v AS ({ORACLE['backtrans_verdict']}) SELECT id, overlap, verdict, row_number() OVER (ORDER BY verdict <> 'flag', overlap, id) AS rank FROM v")
def drift_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back-translations in the order of review."""
    return tracing.ranked_drift(backtrans_verdict(spark, sf_dir).select("id", "overlap", "verdict"))


@query("merge_footers", "WITH u AS (SELECT p_partkey AS id, p_type AS text, p_size > 45 AS passthrough FROM part), f AS (SELECT id FROM u WHERE text = 'SMALL' AND NOT passthrough) SELECT id, CASE WHEN id IN (SELECT id FROM f) THEN '页脚' ELSE 'v' || id END AS value FROM u WHERE id IN (SELECT id FROM f) OR id % 13 <> 0")
def merge_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations in which all footers have one value."""
    units = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("text"), (F.col("p_size") > 45).alias("passthrough"))
    given = units.where("id % 13 <> 0").select("id", F.concat(F.lit("v"), "id").alias("value"))
    return worklist.with_footers(units, given, "SMALL", "页脚")


@query("document_probe", sql("blocks", ", p AS (SELECT source AS document, doc_id AS page, length(text) AS chars FROM documents), i AS (SELECT source AS document, doc AS page, count(*) AS images, max((x1 - x0) * (y1 - y0)) AS largest FROM blocks WHERE ln % 4 = 1 GROUP BY 1, 2), b AS (SELECT p.*, coalesce(images, 0) AS images, largest FROM p LEFT JOIN i ON p.document = i.document AND p.page = i.page) SELECT document, count(*) AS n_pages, sum(chars)::BIGINT AS n_chars, sum(images)::BIGINT AS n_images, round_even(sum(chars) / count(*), 3) AS mean_chars, CASE WHEN sum(chars) / count(*) < 50 THEN 'ocr' WHEN sum(images) > 0 THEN 'ocr_plus_text_layer' ELSE 'text_layer' END AS route, count(*) FILTER (WHERE largest >= 0.8::DOUBLE * 30000) AS n_full FROM b GROUP BY document"))
def document_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select(F.col("source").alias("document"), F.col("doc_id").alias("page"), F.length("text").cast("long").alias("chars"), F.lit(30000.0).alias("area"))
    images = blocks(spark, sf_dir).where("ln % 4 = 1").select(F.col("source").alias("document"), F.col("doc").alias("page"), ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"))
    return scope.probe(pages, images)


@query("size_histogram", sql("blocks", "SELECT (y1 - y0)::DOUBLE AS size, sum(length(text))::BIGINT AS n_chars FROM blocks GROUP BY 1 ORDER BY n_chars DESC, size LIMIT 25"))
def size_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type sizes by characters, the first 25."""
    return scope.character_histogram(blocks(spark, sf_dir).withColumn("size", (F.col("y1") - F.col("y0")).cast("double")), "size", 25)


@query("worst_backgrounds", sql("blocks", "SELECT page, ln, conf AS ratio FROM blocks WHERE conf < 0.55 ORDER BY conf, page, ln LIMIT 30"))
def worst_backgrounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.worst_backgrounds(blocks(spark, sf_dir).select("page", "ln", F.col("conf").alias("ratio")))


@query("clipped_text", sql("blocks", ", b AS (SELECT * FROM blocks WHERE ln % 2 = 0), s AS (SELECT * FROM blocks WHERE ln % 2 = 1) SELECT b.page, b.ln, string_agg(s.text, ' ' ORDER BY s.y0, s.x0, s.ln) AS text FROM b JOIN s ON b.page = s.page AND least(b.x1, s.x1) > greatest(b.x0, s.x0) AND least(b.y1, s.y1) > greatest(b.y0, s.y0) GROUP BY 1, 2"))
def clipped_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product text in each box of the source: odd blocks in even ones."""
    b = blocks(spark, sf_dir).select("page", "ln", "x0", "y0", "x1", "y1", "text")
    return artifacts.clipped_text(b.where("ln % 2 = 1"), b.where("ln % 2 = 0").drop("text"))


@query("latin_ratios", sql("lines", r"SELECT page, ln, CASE WHEN length(regexp_replace(text, '\s+', '', 'g')) > 0 THEN round_even(length(regexp_replace(text, '[^A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{2c1}]', '', 'g'))::DOUBLE / length(regexp_replace(text, '\s+', '', 'g')), 6) ELSE 0 END AS ratio FROM lines"))
def latin_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of letters below U+2E80 in a line."""
    return lines(spark, sf_dir).select("page", "ln", F.bround(T.latin_ratio(F.col("text")), 6).alias("ratio"))


_W = r"[\x{2e81}-\x{2fff}\x{3040}-\x{feff}\x{fff0}-\x{10ffff}]"


def _wrapped(run: str, other: str) -> str:
    lettered = f"({run}*[A-Za-z]{run}*)"
    return rf""", wt AS (SELECT page, ln, regexp_replace(regexp_replace(tgt, '({_W}){lettered}', '\1' || chr(8201) || '\2', 'g'), '{lettered}({_W})', '\1' || chr(8201) || '\2', 'g') AS t FROM pairs),
wr AS (SELECT page, ln, flatten(list_transform(regexp_extract_all(t, '{run}+|{other}+'), lambda p: CASE WHEN regexp_matches(p, '^{run}') THEN regexp_extract_all(p, '[^f]*f|[^f]+') ELSE [p] END)) AS r FROM wt)
SELECT page, ln, array_to_string(r, '|') AS runs, len(list_filter(r, lambda p: regexp_matches(p, '^{run}'))) AS n_latin FROM wr"""


def _wrapped_runs(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    runs = pairs(spark, sf_dir).select("page", "ln", T.runs_of(F.col("tgt"), F.lit(10.0), run).alias("r"))
    return runs.select("page", "ln", F.array_join(F.transform("r", lambda x: x["run"]), "|").alias("runs"), F.size(F.filter("r", lambda x: x["latin"])).alias("n_latin"))


@query("wrapped_runs", sql("pairs", _wrapped(r"[\x20-\x7e]", r"[^\x20-\x7e]")))
def wrapped_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of targets in the text layer."""
    return _wrapped_runs(spark, sf_dir, T.LATIN_RUN)


@query("wrapped_overlay_runs", sql("pairs", _wrapped("[0-9A-Za-z]", "[^0-9A-Za-z]")))
def wrapped_overlay_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of targets in overlays."""
    return _wrapped_runs(spark, sf_dir, T.OVERLAY_RUN)


@query("deskewed_boxes", sql("blocks", ", d AS (SELECT page, ln, radians((ln % 11) - 5.0::DOUBLE) AS r, list_transform([[x0, y0], [x1, y0], [x0, y1], [x1, y1]], lambda p: [p[1] - 300, p[2] - 400]) AS c FROM blocks), e AS (SELECT page, ln, list_transform(c, lambda p: p[1] * cos(r) - p[2] * sin(r) + 300) AS xs, list_transform(c, lambda p: p[1] * sin(r) + p[2] * cos(r) + 400) AS ys FROM d) SELECT page, ln, round_even(greatest(0, list_min(xs)), 4) AS x0, round_even(greatest(0, list_min(ys)), 4) AS y0, round_even(least(600, list_max(xs)), 4) AS x1, round_even(least(800, list_max(ys)), 4) AS y1 FROM e"))
def deskewed_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes turned back by up to five degrees."""
    b = G.deskewed(G.box(), ((F.col("ln") % 11) - 5).cast("double"), F.lit(600.0), F.lit(800.0))
    return blocks(spark, sf_dir).select("page", "ln", *[F.bround(c, 4).alias(k) for k, c in zip(b._fields, b, strict=True)])


@query("lines_needed", sql("frags", ", c AS (SELECT page, ln, list_prepend({'n': 1, 'u': 0::DOUBLE}, list_transform(string_split(text, ''), lambda ch: {'n': 0, 'u': CASE WHEN unicode(ch) >= 11904 THEN 10::DOUBLE ELSE 0.56::DOUBLE * 10 END})) AS w FROM frags) SELECT page, ln, list_reduce(w, lambda a, x: CASE WHEN a.u > 0 AND a.u + x.u > 60 THEN {'n': a.n + 1, 'u': x.u} ELSE {'n': a.n, 'u': a.u + x.u} END).n AS n_lines FROM c"))
def lines_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of type size 10 in a width of 60, sign by sign."""
    return frags(spark, sf_dir).select("page", "ln", G.lines_needed(F.col("text"), F.lit(60.0), F.lit(10.0)).alias("n_lines"))


@query("axes", sql("blocks", ", g AS (SELECT page, ln // 3 AS para, CASE (ln // 3) % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'right' ELSE 'center' END AS kind, list(x0) AS a, list(x1) AS b, list((x0 + x1) / 2 ORDER BY (x0 + x1) / 2) AS c FROM blocks GROUP BY 1, 2, 3) SELECT page, para, kind, CASE kind WHEN 'left' THEN list_min(a) WHEN 'right' THEN list_max(b) ELSE c[len(c) // 2 + 1] END AS axis FROM g"))
def axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Axis of paragraphs by their alignment."""
    para = F.expr("ln div 3")
    kind = F.when(para % 3 == 0, "left").when(para % 3 == 1, "right").otherwise("center")
    per = blocks(spark, sf_dir).groupBy("page", para.alias("para"), kind.alias("kind")).agg(F.collect_list(F.struct("x0", "x1")).alias("lines"))
    return per.select("page", "para", "kind", G.axis_of(F.col("lines"), F.col("kind")).alias("axis"))


# The report

def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = structure.text_findings(_pairs(spark, sf_dir), charset_evidence(spark, sf_dir))
    return structure.quality_report(
        spark, source=guard_diff(spark, sf_dir), structure=_checks(spark, sf_dir), text=findings, sample=stratified_sample(spark, sf_dir),
        drift=backtrans_verdict(spark, sf_dir), visual=visual_flags(spark, sf_dir), residue=residue_verdict(spark, sf_dir),
    )


@query("quality_report")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven sections from the audits of this library; tested against their rows."""
    return _report(spark, sf_dir)


@query("report_lines")
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.report_lines(_report(spark, sf_dir))
