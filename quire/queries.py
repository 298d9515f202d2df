"""Registered queries of the library's operators, and the SQL that gives the same rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.config import NUMBER_WORDS, STOP_CAPS, STOP_LONG, STOP_SHORT
from quire.functions import geom as G
from quire.functions import kernels
from quire.functions import text as T
from quire.operators import audit, fold, layout, quality, sampling, scope, snapshots, tracing, worklist
from quire.operators.spatial import box_join, left_box, prefixed, right_box
from quire.plans.groups import map_groups
from quire.plans.views import Query, block_pairs, blocks, frags, layered, lines, number_pairs, pairs, sql, table

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if oracle is not None:
            ORACLE[name] = oracle
        return f

    return add


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# Expressions of the oracle.
NUMERIC_SQL = r"(regexp_full_match(text, '[\s\d%.,()''’\-–—+/x×$:#°]*') OR NOT regexp_matches(text, '[A-Za-z]{2,}'))"
CLS = rf"CASE WHEN {NUMERIC_SQL} THEN 'skip_numeric' WHEN length(text) <= 24 AND len(regexp_extract_all(text, '[A-Za-z]{{2,}}')) <= 3 AND NOT regexp_matches(text, '[.!?]$') THEN 'label' ELSE 'sentence' END"
_SAME = "|".join(re.escape(chr(c)).replace("'", "''") + "{6}" for c in range(33, 127))
_REPEAT = f"regexp_matches(text, ' {{6}}|{_SAME}')"
_MUTE = r"len(list_filter(regexp_extract_all(regexp_replace(text, '[\x{c0}-\x{24f}]', '0', 'g'), '\b[A-Za-z]{8,}\b'), lambda w: NOT regexp_matches(w, '[aeiouyAEIOUY]'))) > 0 AND NOT regexp_matches(text, '[\x{4e00}-\x{9fff}]')"
REASONS = f"list_filter([CASE WHEN conf < 0.55 THEN 'low_conf' END, CASE WHEN regexp_matches(text, '\\d{{10,}}') THEN 'noise_digits' END, CASE WHEN {_REPEAT} THEN 'char_repeat' END, CASE WHEN len(regexp_extract_all(text, '\\?')) >= 2 THEN 'junk_marks' END, CASE WHEN {_MUTE} THEN 'no_vowel' END], lambda r: r IS NOT NULL)"
VERDICT = "CASE WHEN conf < 0.35 OR list_contains(reasons, 'noise_digits') OR list_contains(reasons, 'char_repeat') THEN 'skip' WHEN len(reasons) > 0 THEN 'review' ELSE 'ok' END"
REASON = r"CASE WHEN verdict = 'skip' THEN 'qc_skip' WHEN cls = 'skip_numeric' THEN 'skip_numeric' WHEN regexp_matches(text, '(?i)^AI\s*[6OG&]\s*Z?\s*GROWTH$') THEN 'decoration' WHEN y1 - y0 < 5 THEN 'too_small' WHEN regexp_matches(text, '[\x{4e00}-\x{9fff}]') AND NOT regexp_matches(text, '[A-Za-z]{3,}') THEN 'already_zh' END"
JUDGED = f", v AS (SELECT *, {VERDICT} AS verdict FROM (SELECT *, {REASONS} AS reasons, {CLS} AS cls FROM frags)), j AS (SELECT *, {REASON} AS reason FROM v)"
NORM_WS = r"lower(regexp_replace({}, '\s+', '', 'g'))"


def _inter(a: str, b: str) -> str:
    return f"(greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0)))"


def _area(a: str) -> str:
    return f"(({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0))"


def _overlap(a: str, b: str) -> str:
    return f"({_inter(a, b)} / greatest(least({_area(a)}, {_area(b)}), 1e-6))"


# Scope


@query("scope_summary", sql("frags", f", c AS (SELECT *, {CLS} AS cls FROM frags) SELECT cls, count(*) AS n_blocks, sum(length(text))::BIGINT AS n_chars, count(DISTINCT text) AS n_texts, (SELECT sum(length(t))::BIGINT FROM (SELECT DISTINCT text AS t FROM c x WHERE x.cls = c.cls)) AS n_text_chars, count(DISTINCT page) AS n_pages FROM c GROUP BY cls"))
def scope_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.scope_summary(frags(spark, sf_dir))


@query("classify_blocks", sql("frags", f"SELECT page, ln, {CLS} AS cls FROM frags"))
def classify_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.classified(frags(spark, sf_dir)).select("page", "ln", "cls")


@query("scope_pages_top", sql("frags", "SELECT page, count(*) AS n FROM frags GROUP BY page ORDER BY n DESC, page LIMIT 12"))
def scope_pages_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.top(frags(spark, sf_dir), "page", 12)


@query("scope_anti_text_layer", sql("blocks", f", o AS (SELECT * FROM blocks WHERE ln % 3 <> 0 AND {_area('blocks')} >= 1), t AS (SELECT * FROM blocks WHERE ln % 3 = 0) SELECT page, ln FROM o WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.page = o.page AND {_inter('o', 't')} / greatest({_area('o')}, 1.0) > 0.55)"))
def scope_anti_text_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blocks(spark, sf_dir)
    return scope.outside_text_layer(b.where("ln % 3 <> 0"), b.where("ln % 3 = 0")).select("page", "ln")


@query("ocr_to_points", sql("blocks", "SELECT page, ln, round_even(x0 / 1000 * 600, 6) AS x0, round_even((1 - y0 / 2000 - 0.01) * 800, 6) AS y0, round_even((x0 / 1000 + 0.05) * 600, 6) AS x1, round_even((1 - y0 / 2000) * 800, 6) AS y1 FROM blocks"))
def ocr_to_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = G.to_points(F.col("x0") / 1000, F.col("y0") / 2000, F.lit(0.05), F.lit(0.01), F.lit(600), F.lit(800))
    return blocks(spark, sf_dir).select("page", "ln", *[F.bround(c, 6).alias(k) for k, c in zip(b._fields, b, strict=True)])


@query("conf_histogram", sql("frags", "SELECT round_even(conf, 2) AS conf, count(*) AS n FROM frags GROUP BY 1 ORDER BY n DESC, 1 LIMIT 8"))
def conf_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.conf_histogram(frags(spark, sf_dir))


@query("banding_by_height", sql("frags", f", p AS (SELECT text, max(y1 - y0) AS h, avg(conf) AS conf FROM frags WHERE {CLS} <> 'skip_numeric' GROUP BY text), b AS (SELECT *, CASE WHEN h < 4 THEN 0 WHEN h < 5 THEN 4 WHEN h < 6 THEN 5 WHEN h < 8 THEN 6 WHEN h < 12 THEN 8 WHEN h < 20 THEN 12 ELSE 20 END AS band FROM p) SELECT band::INT AS band, count(*) AS n_texts, sum(length(text))::BIGINT AS n_chars, count(*) FILTER (WHERE round(conf, 6) < 0.5) AS n_low, round_even(sum(round(conf, 6)::DECIMAL(18, 6))::DOUBLE / count(*), 4) AS mean_conf, round_even(100.0::DOUBLE * count(*) / (SELECT count(*) FROM b), 1) AS share FROM b GROUP BY band"))
def banding_by_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.height_bands(frags(spark, sf_dir))


@query("cumulative_heights", sql("frags", f", p AS (SELECT text, max(y1 - y0) AS h FROM frags WHERE {CLS} <> 'skip_numeric' GROUP BY text) SELECT count(*) FILTER (WHERE h >= 5) AS at_least_5, count(*) FILTER (WHERE h >= 6) AS at_least_6, count(*) FILTER (WHERE h >= 8) AS at_least_8 FROM p"))
def cumulative_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.cumulative_heights(frags(spark, sf_dir))


@query("document_route", "SELECT source AS document, count(*) AS n_pages, sum(length(text))::BIGINT AS n_chars, sum((doc_id % 7 = 0)::INT)::BIGINT AS n_images, round_even(sum(length(text)) / count(*), 3) AS mean_chars, CASE WHEN sum(length(text)) / count(*) < 50 THEN 'ocr' WHEN sum((doc_id % 7 = 0)::INT) > 0 THEN 'ocr_plus_text_layer' ELSE 'text_layer' END AS route FROM documents GROUP BY source")
def document_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select(F.col("source").alias("document"), F.length("text").cast("long").alias("chars"), (F.col("doc_id") % 7 == 0).cast("int").alias("images"))
    return scope.route(pages)


@query("page_range", "SELECT spec, unnest(p)::INT AS page FROM (VALUES ('1-5,12', [1, 2, 3, 4, 5, 12]), ('7', [7]), ('2-3,3-4', [2, 3, 4])) t(spec, p)")
def page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.page_range(spark.createDataFrame([("1-5,12",), ("7",), ("2-3,3-4",)], "spec string"), 20)


@query("background_stats", sql("frags", "SELECT page, count(*) AS n_blocks, count(*) FILTER (WHERE conf >= 0.55) AS n_uniform, count(*) FILTER (WHERE (doc * 7 + ln * 13) % 256 >= 200) AS n_light, count(*) FILTER (WHERE y1 - y0 > 2 * (x1 - x0) AND length(text) > 3) AS n_turned FROM frags GROUP BY page"))
def background_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frags(spark, sf_dir)
    return scope.background(f.select("page", ((F.col("doc") * 7 + F.col("ln") * 13) % 256).alias("lum"), F.col("conf").alias("ratio"), (F.col("x1") - F.col("x0")).alias("w"), (F.col("y1") - F.col("y0")).alias("h"), F.length("text").alias("n")))


# Quality of readings


@query("qc_verdict", sql("frags", JUDGED + " SELECT page, ln, verdict, array_to_string(reasons, ',') AS reasons FROM v"))
def qc_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(frags(spark, sf_dir)).select("page", "ln", "verdict", F.array_join("reasons", ",").alias("reasons"))


@query("qc_gate", sql("frags", JUDGED + " SELECT n_blocks, n_skip, n_review, CASE WHEN n_skip > 0.25 * n_blocks THEN 'NO-GO' WHEN n_skip <= 0.05 * n_blocks AND n_review <= 0.15 * n_blocks THEN 'GO*' ELSE 'REVIEW' END AS gate FROM (SELECT count(*) AS n_blocks, count(*) FILTER (WHERE verdict = 'skip') AS n_skip, count(*) FILTER (WHERE verdict = 'review') AS n_review FROM v)"))
def qc_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate(quality.verdicts(frags(spark, sf_dir)))


@query("qc_duplicate_readings")
def qc_duplicate_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.conflicts(blocks(spark, sf_dir))


@query("qc_best_reading")
def qc_best_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = blocks(spark, sf_dir)
    return quality.best_reading(f, f.withColumn("text", F.translate("text", "oe", "0c")))


# Work lists


@query("queue_skip_reasons", sql("frags", JUDGED + " SELECT coalesce(reason, 'keep') AS reason, count(*) AS n FROM j GROUP BY 1"))
def queue_skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.reason_counts(frags(spark, sf_dir))


_QUEUE = JUDGED + ", q AS (SELECT text, count(*) AS n, count(DISTINCT page) AS n_pages, arg_min(cls, page * 1000000 + ln) AS cls, arg_min(y1 - y0, page * 1000000 + ln) AS h_first, round_even(avg(y1 - y0), 4) AS h_avg, bool_or(verdict = 'review') AS qc FROM j WHERE reason IS NULL GROUP BY text)"


@query("queue_dedup", sql("frags", _QUEUE + " SELECT * FROM q"))
def queue_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.queue(frags(spark, sf_dir))


@query("queue_batches", sql("frags", _QUEUE + ' SELECT gid, text, n, (gid - 1) // 200 + 1 AS batch FROM (SELECT *, row_number() OVER (ORDER BY n DESC, text COLLATE "binary") AS gid FROM q)'))
def queue_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.numbered(worklist.queue(frags(spark, sf_dir))).select("gid", "text", "n", "batch")


_CLEAN = r"length(text) >= 5 AND regexp_full_match(text, '[\x00-\x7f]*') AND NOT regexp_matches(text, '(?i)^AI\s*[6OG&]\s*Z?\s*GROWTH$') AND NOT regexp_matches(text, '^[\s0-9$%¢€£¥.,+\-–—/×x:*()\[\]<>|~=''""#&°]+$') AND regexp_matches(text, '[A-Za-z]{3}') AND length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::DOUBLE / length(text) >= 0.55 AND len(list_filter(regexp_extract_all(text, '[A-Za-z]+'), lambda w: length(w) >= 4 AND NOT regexp_matches(w, '[aeiouAEIOU]'))) <= greatest(1, len(regexp_extract_all(text, '[A-Za-z]+')) // 4)"


@query("supplement_candidates", sql("frags", JUDGED + f" SELECT text, count(*) AS n, max(y1 - y0) AS h FROM frags WHERE y1 - y0 >= 3.6 AND y1 - y0 < 5 AND {_CLEAN} AND {NORM_WS.format('text')} NOT IN (SELECT {NORM_WS.format('text')} FROM j WHERE reason IS NULL) GROUP BY text".replace('""', '"')))
def supplement_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.supplement(frags(spark, sf_dir))


_MICRO = r"y1 - y0 >= 1.8 AND y1 - y0 < 5 AND regexp_matches(text, '[A-Za-z]{3}') AND NOT regexp_matches(text, '(?i)^\s*sources?\b') AND NOT regexp_matches(text, '^[A-Z0-9&.\-]{2,6}$') AND NOT regexp_matches(text, '(?i)^AI\s*[6OG&]\s*Z?\s*GROWTH$') AND len(list_filter(regexp_extract_all(text, '[A-Za-z]{3,}'), lambda w: regexp_matches(w, '[aeiouyAEIOUY]'))) > 0"


@query("micro_candidates", sql("frags", f", m AS (SELECT * FROM frags WHERE {_MICRO}), p AS (SELECT * FROM frags WHERE y1 - y0 >= 5) SELECT page, ln FROM m WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.page = m.page AND {_overlap('m', 'p')} > 0.4)"))
def micro_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frags(spark, sf_dir)
    return worklist.micro_candidates(f, f.where("y1 - y0 >= 5")).select("page", "ln")


@query("micro_numbers", sql("frags", 'SELECT text, 9499 + row_number() OVER (ORDER BY lower(text) COLLATE "binary", text COLLATE "binary") AS gid FROM (SELECT DISTINCT text FROM frags WHERE y1 - y0 < 5)'))
def micro_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.micro_numbers(frags(spark, sf_dir).where("y1 - y0 < 5"))


_COLLIDED = ", m AS (SELECT page, ln, text, round_even(least(4.6::DOUBLE, greatest(3.6::DOUBLE, 1.6::DOUBLE * (y1 - y0))), 2) AS size, x0, x1, (y0 + y1) / 2 AS mid FROM {0}), g AS (SELECT page, ln, size, x0 - 1 AS x0, mid - 0.72::DOUBLE * size AS y0, x1 + 1 AS x1, mid + 0.72::DOUBLE * size AS y1 FROM m), hit AS (SELECT DISTINCT g.page, g.ln, g.size FROM g JOIN frags r ON g.page = r.page AND g.ln <> r.ln AND r.y1 > g.y0 + 0.4::DOUBLE AND r.y0 < g.y1 - 0.4::DOUBLE AND r.x1 > g.x0 AND r.x0 < g.x1)"


@query("micro_collisions", sql("frags", ", c AS (SELECT * FROM frags WHERE y1 - y0 < 5)" + _COLLIDED.format("c") + " SELECT * FROM hit"))
def micro_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frags(spark, sf_dir)
    return worklist.micro_collisions(f.where("y1 - y0 < 5"), f)


@query("plan_overlap_pairs", sql("blocks", f"SELECT a.page, count(*) AS n FROM blocks a JOIN blocks b ON a.page = b.page AND a.ln < b.ln AND {_overlap('a', 'b')} > 0.55 GROUP BY a.page"))
def plan_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blocks(spark, sf_dir).select("page", "ln", "x0", "y0", "x1", "y1")
    theta = (F.col("l_ln") < F.col("r_ln")) & (G.overlap_min(left_box(), right_box()) > 0.55)
    return box_join(prefixed(b, "l_"), prefixed(b, "r_"), theta).groupBy(F.col("l_page").alias("page")).agg(F.count(F.lit(1)).alias("n"))


def _greedy(source: str, order: str, clash: str) -> str:
    """Tables of the rows that a fold in an order keeps: a row (x) goes if it clashes with a kept one (a) of its page."""
    row = "{'ln': ln, 'text': text, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}"
    return f", folded AS (SELECT page, unnest(list_reduce(list([{row}] ORDER BY {order}), lambda acc, x: CASE WHEN len(list_filter(acc, lambda a: {clash})) > 0 THEN acc ELSE list_concat(acc, x) END)) AS a FROM {source} GROUP BY page), kept AS (SELECT page, a.ln AS ln, a.text AS text, a.x0 AS x0, a.y0 AS y0, a.x1 AS x1, a.y1 AS y1 FROM folded)"


_OVERLAPS = _overlap("a", "x[1]") + " > 0.55"
_LONGEST = 'length(text) DESC, ln'


@query("plan_greedy_dedup", sql("blocks", _greedy("blocks", _LONGEST, _OVERLAPS) + " SELECT page, ln FROM kept"))
def plan_greedy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.dedup_overlaps(blocks(spark, sf_dir)).select("page", "ln")


@query("plan_incremental_merge", sql("blocks", f", o AS (SELECT * FROM blocks WHERE ln % 2 = 0), n AS (SELECT * FROM blocks b WHERE ln % 2 = 1 AND NOT EXISTS (SELECT 1 FROM o WHERE o.page = b.page AND {_overlap('o', 'b')} > 0.55))" + _greedy("n", _LONGEST, _OVERLAPS) + " SELECT page, ln, 'old' AS origin FROM o UNION ALL SELECT page, ln, 'new' FROM kept"))
def plan_incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blocks(spark, sf_dir)
    return worklist.plan_increment(b.where("ln % 2 = 0"), b.where("ln % 2 = 1"))


# Upright blocks: narrow and high boxes where others are broad.
_VERTICAL = ", up AS (SELECT doc, page, ln + 1000000 AS ln, text, x0, y0, x0 + 6 + ln % 40 AS x1, y0 + 5.6::DOUBLE * length(text) AS y1 FROM frags WHERE ln % 3 = 0)"


def _vertical(spark: SparkSession, sf_dir: str) -> DataFrame:
    ln = F.col("ln")
    return frags(spark, sf_dir).where(ln % 3 == 0).select("doc", "page", (ln + 1000000).alias("ln"), "text", "x0", "y0", (F.col("x0") + 6 + ln % 40).alias("x1"), (F.col("y0") + 5.6 * F.length("text")).alias("y1"))


_BOTH = _VERTICAL + ", both_ AS (SELECT doc, page, ln, text, x0, y0, x1, y1, conf, 'scope' AS origin FROM frags WHERE ln % 3 <> 0 UNION ALL SELECT doc, page, ln, text, x0, y0, x1, y1, 1.0, 'vertical' FROM up)"
_JUDGED_BOTH = JUDGED.replace("FROM frags", "FROM both_")


def _given(texts: DataFrame) -> DataFrame:
    """Translations: some texts are kept, some have none, the others are turned round."""
    n = F.length("text")
    return texts.select("text").distinct().withColumn("value", F.when(n % 5 == 0, "=").when(n % 7 == 0, "").otherwise(F.substring(F.reverse("text"), 1, 9)))


_GIVEN = "CASE WHEN length(text) % 5 = 0 THEN '=' WHEN length(text) % 7 = 0 THEN '' ELSE reverse(text)[1:9] END"


@query("plan_build", sql("frags", _BOTH + _JUDGED_BOTH + f", gv AS (SELECT * FROM (SELECT *, {_GIVEN} AS value FROM j WHERE reason IS NULL) WHERE value <> '' AND value <> '=')" + _greedy("gv", _LONGEST, _OVERLAPS) + f""", pv AS (SELECT *, {_GIVEN} AS value, x1 - x0 AS w, y1 - y0 AS h FROM kept), pt AS (SELECT *, w < 14 AND h > 18 AND length(value) >= 2 AS turn FROM pv)
SELECT row_number() OVER (ORDER BY page, y0, x0, ln) AS pos, page, ln, text, value, CASE WHEN turn THEN 90 ELSE 0 END AS rotate, round_even(CASE WHEN turn THEN least(0.78::DOUBLE * h, w * 1.15::DOUBLE, h / greatest(1, length(value)) * 1.35::DOUBLE) ELSE least(0.78::DOUBLE * h, w / greatest(1, length(value)) * 1.25::DOUBLE) END, 3) AS size, round_even(1.15::DOUBLE * h, 3) AS size_cap FROM pt"""))
def plan_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan over both scans, in order of page and place."""
    scope_, up = frags(spark, sf_dir).where("ln % 3 <> 0"), _vertical(spark, sf_dir)
    given = _given(scope_.select("text").unionByName(up.select("text")))
    return worklist.translated_plan(scope_.select("doc", "page", "ln", "text", "x0", "y0", "x1", "y1", "conf"), given, up)


@query("candidate_union", sql("frags", _BOTH + " SELECT page, ln, origin, conf::DOUBLE AS conf, 'label' AS cls FROM both_"))
def candidate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both scans as one table."""
    scope_ = frags(spark, sf_dir).where("ln % 3 <> 0").select("page", "ln", "conf", F.lit(None).cast("string").alias("cls"))
    return worklist.candidates(scope_, _vertical(spark, sf_dir).select("page", "ln")).select("page", "ln", "origin", "conf", "cls")


@query("vertical_new", sql("frags", _VERTICAL + f""", sc AS (SELECT page, list(DISTINCT {NORM_WS.format('text')}) AS norms FROM frags WHERE ln % 3 = 1 AND length({NORM_WS.format('text')}) >= 5 GROUP BY page), pl AS (SELECT DISTINCT page, {NORM_WS.format('text')} AS norm FROM frags WHERE ln % 9 = 2),
vf AS (SELECT *, {NORM_WS.format('text')} AS norm FROM up WHERE x1 - x0 < 34 AND y1 - y0 > 18 AND y1 - y0 > 1.4::DOUBLE * (x1 - x0) AND length(text) >= 4 AND regexp_full_match(text, '[\x00-\x7f]*') AND length(regexp_replace(text, '[^A-Za-z]', '', 'g')) >= 4 AND length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::DOUBLE / length(text) >= 0.7 AND regexp_matches(text, '[A-Za-z]{{2,}}'))
SELECT vf.page, ln FROM vf LEFT JOIN sc ON sc.page = vf.page WHERE len(list_filter(coalesce(norms, []), lambda s: contains(s, norm) OR contains(norm, s))) = 0 AND NOT EXISTS (SELECT 1 FROM pl WHERE pl.page = vf.page AND pl.norm = vf.norm)"""))
def vertical_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upright blocks that neither the main scan (every third block) nor the plan (every ninth) has."""
    f = frags(spark, sf_dir)
    return worklist.vertical_new(_vertical(spark, sf_dir), f.where("ln % 3 = 1"), f.where("ln % 9 = 2")).select("page", "ln")


@query("supplement_ranked", sql("frags", _VERTICAL + JUDGED + f""", seen AS (SELECT DISTINCT {NORM_WS.format('text')} AS key FROM j WHERE reason IS NULL),
sm AS (SELECT text, min((page, ln, y1 - y0)) AS f FROM frags WHERE y1 - y0 >= 3.6 AND y1 - y0 < 5 AND {_CLEAN} AND {NORM_WS.format('text')} NOT IN (SELECT key FROM seen) GROUP BY text),
ve AS (SELECT text, min((page, ln, y1 - y0)) AS f FROM up WHERE {_CLEAN} AND {NORM_WS.format('text')} NOT IN (SELECT key FROM seen) GROUP BY text),
b AS (SELECT coalesce(sm.text, ve.text) AS text, CASE WHEN sm.text IS NOT NULL THEN 'small' ELSE 'vertical' END AS origin, coalesce(sm.f, ve.f) AS f FROM sm FULL JOIN ve ON sm.text = ve.text)
SELECT row_number() OVER (ORDER BY origin <> 'vertical', f[3] DESC, text COLLATE "binary") AS rank, text, origin, f[1] AS page, f[3] AS h FROM b""".replace('""', '"')))
def supplement_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the queue left out in both scans, in the order of the supplement."""
    return worklist.supplement_ranked(frags(spark, sf_dir), _vertical(spark, sf_dir))


@query("micro_plan", sql("frags", f''', mc AS (SELECT * FROM frags WHERE {_MICRO}), p AS (SELECT * FROM frags WHERE y1 - y0 >= 5), cand AS (SELECT * FROM mc m WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.page = m.page AND {_overlap('m', 'p')} > 0.4)), num AS (SELECT text, 9499 + row_number() OVER (ORDER BY lower(text) COLLATE "binary", text COLLATE "binary") AS gid FROM (SELECT DISTINCT text FROM cand)), ok AS (SELECT cand.*, gid, {_GIVEN.replace('text', 'cand.text')} AS value FROM cand JOIN num ON cand.text = num.text), okv AS (SELECT * FROM ok WHERE value <> '' AND value <> '=')''' + _COLLIDED.format("okv") + """, fin AS (SELECT okv.*, round_even(least(4.6::DOUBLE, greatest(3.6::DOUBLE, 1.6::DOUBLE * (y1 - y0))), 2) AS size FROM okv WHERE NOT EXISTS (SELECT 1 FROM hit WHERE hit.page = okv.page AND hit.ln = okv.ln))
SELECT row_number() OVER (ORDER BY page, y0, x0, ln) AS pos, page, ln, gid, value, size, round_even(x0, 4) AS x0, round_even((y0 + y1) / 2 - 0.72::DOUBLE * size, 4) AS y0, round_even(x0 + (x1 - x0) * 1.35::DOUBLE, 4) AS x1, round_even((y0 + y1) / 2 + 0.72::DOUBLE * size, 4) AS y1 FROM fin"""))
def micro_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan rows of micro labels that meet no other box."""
    f = frags(spark, sf_dir)
    return worklist.micro_plan(f, f.where("y1 - y0 >= 5"), _given(f), f)


@query("merge_validation", "SELECT coalesce(a.o_orderkey, b.o_orderkey) AS id, CASE WHEN b.o_orderkey IS NULL THEN 'missing' WHEN a.o_orderkey IS NULL THEN 'extra' WHEN b.o_orderkey % 31 = 0 THEN 'empty' ELSE 'ok' END AS state FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 17 <> 0) a FULL JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 13 <> 0) b ON a.o_orderkey = b.o_orderkey")
def merge_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return worklist.merge_check(o.where("id % 17 <> 0"), o.where("id % 13 <> 0").withColumn("value", F.when(F.col("id") % 31 == 0, " ").otherwise(F.concat(F.lit("v"), "id"))))


# Audits

_STATUS = r", st AS (SELECT *, CASE WHEN passthrough OR regexp_matches(src, '^[\s0-9$%¢€£¥.,+\-–—/×x:*()\[\]<>|~=''\"#&°]+$') THEN 'kept' WHEN trim(tgt, ' ') = '' THEN 'empty' WHEN NOT regexp_matches(tgt, '[\x{3400}-\x{9fff}]') AND " + NORM_WS.format("src") + " = " + NORM_WS.format("tgt") + " THEN 'unchanged' WHEN " + NORM_WS.format("src") + " = " + NORM_WS.format("tgt") + " THEN 'same' ELSE 'translated' END AS status FROM pairs WHERE trim(src, ' ') <> '')"
_STATUS = _STATUS.replace('\\"', '"')


@query("pair_status", sql("pairs", _STATUS + " SELECT doc, ln, status FROM st"))
def pair_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.with_status(pairs(spark, sf_dir)).select("doc", "ln", "status")


@query("coverage_by_layer", sql("pairs", _STATUS + " SELECT layer, t AS n_translated, u AS n_unchanged, CASE WHEN t + u = 0 THEN 100.0::DOUBLE ELSE round_even(100::DOUBLE * t / (t + u), 2) END AS coverage FROM (SELECT layer, count(*) FILTER (WHERE status = 'translated') AS t, count(*) FILTER (WHERE status = 'unchanged') AS u FROM st GROUP BY layer)"))
def coverage_by_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.coverage(pairs(spark, sf_dir))


@query("repeat_conflicts", sql("pairs", _STATUS + f" SELECT {NORM_WS.format('src')} AS key, count(*) AS n, count(DISTINCT tgt) AS n_variants FROM st WHERE status IN ('translated', 'same') AND length(src) >= 8 AND {NORM_WS.format('src')} <> '' GROUP BY 1 HAVING count(*) >= 2 AND count(DISTINCT tgt) > 1"))
def repeat_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.repeats(pairs(spark, sf_dir))


_LONG_FIRST = "list_reduce(list([tgt] ORDER BY length(tgt) DESC, tgt COLLATE \"binary\"), lambda acc, x: CASE WHEN len(list_filter(acc, lambda a: contains(a, x[1]))) > 0 THEN acc ELSE list_concat(acc, x) END)"


@query("repeat_variants", sql("block_pairs", _STATUS.replace("FROM pairs", "FROM block_pairs") + f", rr AS (SELECT {NORM_WS.format('src')} AS key, tgt, count(*) AS c FROM st WHERE status IN ('translated', 'same') AND length(src) >= 8 AND {NORM_WS.format('src')} <> '' GROUP BY 1, 2), rv AS (SELECT key, sum(c)::BIGINT AS n, {_LONG_FIRST} AS vs FROM rr GROUP BY key HAVING sum(c) >= 2 AND count(*) > 1) SELECT key, n, array_to_string(vs, ' / ') AS variants FROM rv WHERE len(vs) >= 2"))
def repeat_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.repeat_variants(block_pairs(spark, sf_dir)).select("key", "n", F.array_join("variants", " / ").alias("variants"))


_NOUNS = r"list_distinct(list_concat(list_filter(regexp_extract_all(src, '\b[A-Z][A-Z0-9]{1,5}\b'), lambda t: length(t) >= 4 AND NOT list_contains(" + _list(STOP_CAPS) + r", t)), list_filter(regexp_extract_all(src, '\b[A-Z]{1,4}-?\d{1,4}[A-Za-z]{0,3}\b'), lambda t: NOT regexp_full_match(t, '[A-Z]\d')), regexp_extract_all(src, '\b[a-z0-9][a-z0-9.\-]*\.(?:com|org|net|ai|io|gov|edu)\b'), regexp_extract_all(src, '\b[A-Z][A-Za-z.&]*(?:\s+[A-Z][A-Za-z.&]*){0,3}\s+(?:Inc|Corp|Corporation|Ltd|LLC|Co|Group|Capital|Partners|Technologies|Research)\b')))"
_PARTS = "(SELECT p_type || ' ' || p_name AS src, CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN lower(p_type) ELSE p_type END AS tgt FROM part)"


@query("propernoun_policy", f"SELECT term, n, n_kept, round_even(n_kept::DOUBLE / n, 4) AS kept_rate, CASE WHEN n_kept = n THEN 'kept' WHEN n_kept = 0 THEN 'translated' ELSE 'policy-mixed' END AS policy FROM (SELECT term, count(*) AS n_all, count(*) FILTER (WHERE tgt <> '') AS n, count(*) FILTER (WHERE tgt <> '' AND contains(tgt, term)) AS n_kept FROM (SELECT unnest({_NOUNS}) AS term, tgt FROM {_PARTS}) GROUP BY term) WHERE n_all >= 3 AND n >= 3")
def propernoun_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, kind = F.col("p_partkey"), F.col("p_type")
    rows = table(spark, sf_dir, "part").select(F.concat_ws(" ", kind, "p_name").alias("src"), F.when(key % 5 == 0, "").when(key % 3 == 0, F.lower(kind)).otherwise(kind).alias("tgt"))
    return audit.proper_nouns(rows)


@query("paren_evidence", "SELECT lower(regexp_extract(p_name, '^([A-Za-z]+)', 1)) AS term, count(*) AS n FROM part GROUP BY 1")
def paren_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("译名（"), F.regexp_extract("p_name", "^([A-Za-z]+)", 1), F.lit("）")).alias("tgt"))
    return audit.paren_evidence(rows)


_RUNS = "list_distinct(list_transform(list_filter(regexp_split_to_array(array_to_string(list_transform(regexp_extract_all({0}, '(?:^|[^A-Za-z0-9])([0-9][0-9oOlI,.\\x{{a0}}]{{0,18}})', 1), lambda t: translate(t, 'oOlI', '0011')), ' '), '[^0-9]+'), lambda p: p <> ''), lambda p: coalesce(nullif(ltrim(p, '0'), ''), '0')))"
_SRC, _TGT = _RUNS.format("src"), _RUNS.format("tgt")


@query("number_conservation", sql("number_pairs", f", r AS (SELECT id, src, tgt, list_sort(list_filter(list_filter({_SRC}, lambda t: length(t) >= 2 OR contains(src, '$' || t)), lambda t: NOT (list_contains({_TGT}, t) OR length(t) = 2 AND list_contains({_TGT}, '20' || t) OR length(t) = 4 AND list_contains({_TGT}, substr(t, 3, 2))))) AS missing FROM number_pairs) SELECT id, array_to_string(missing, ' ') AS missing, 'check' AS kind FROM r WHERE len(missing) > 0"))
def number_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.numbers(number_pairs(spark, sf_dir))


@query("negation_hints", sql("pairs", _STATUS + r" SELECT doc, ln, CASE WHEN e THEN n ELSE 0 END AS n_negations, i AS implicit FROM (SELECT *, n > 0 AND NOT regexp_matches(tgt, '[不没无未非别勿莫免禁止得]') AS e, regexp_matches(plain, '(?i)\b(?:except|without|excluding|fail(?:ed|s)? to|lack|absent|free of)\b') AND NOT regexp_matches(tgt, '[不没无未非别勿莫免禁止得除外]') AS i FROM (SELECT *, len(regexp_extract_all(plain, '(?i)\b(?:not|no|never|none|neither|nor|cannot|n[o'']t)\b')) AS n FROM (SELECT *, regexp_replace(src, '[\x{c0}-\x{24f}]', 'x', 'g') AS plain FROM st) WHERE status = 'translated')) WHERE e OR i"))
def negation_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.negations(pairs(spark, sf_dir))


_CHARS = ", ch AS (SELECT page, unnest(string_split(text, '')) AS ch, lang FROM lines), x AS (SELECT * FROM ch WHERE ch <> '' AND ch NOT IN (SELECT ch FROM ch WHERE lang = 'en')) "


@query("charset_unexpected", sql("lines", _CHARS + "SELECT unicode(ch)::BIGINT AS code, count(*) AS n, count(DISTINCT page) AS n_pages, ch IN ('ﬀ', 'ﬁ', 'ﬂ', 'ﬃ', 'ﬄ', 'ﬅ', 'ﬆ', '⸺', '⸻', ' ') AS benign FROM x GROUP BY ch"))
def charset_unexpected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir)
    return audit.unexpected_characters(rows.where("lang <> 'en'"), rows.where("lang = 'en'"))


@query("charset_contiguous", sql("lines", _CHARS + "SELECT min(unicode(ch))::BIGINT AS low, max(unicode(ch))::BIGINT AS high, count(DISTINCT ch) AS n, max(unicode(ch)) - min(unicode(ch)) + 1 = count(DISTINCT ch) AS contiguous FROM x"))
def charset_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.contiguous(charset_unexpected(spark, sf_dir))


@query("cmap_interval_join", "SELECT font, count(*) AS n_glyphs, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT p_brand AS f, p_size * 100 AS lo, p_size * 100 + 40 AS hi FROM part) s WHERE s.f = g.font AND g.gid BETWEEN s.lo AND s.hi)) AS n_outside FROM (SELECT DISTINCT p_brand AS font, p_partkey % 5000 AS gid FROM part) g GROUP BY font")
def cmap_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    spans = part.select(F.col("p_brand").alias("font"), (F.col("p_size") * 100).alias("lo"), (F.col("p_size") * 100 + 40).alias("hi")).distinct()
    return audit.outside_spans(part.select(F.col("p_brand").alias("font"), (F.col("p_partkey") % 5000).alias("gid")).distinct(), spans)


# Terms: last words of names with a form, and whole names (two words), some proposed by brackets, without one.
_TP = "tp AS (SELECT p_partkey AS id, p_type || ' ' || p_name AS src, CASE WHEN p_partkey % 5 = 0 THEN 'other' WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 4 = 0 THEN '名（' || p_name || '）' ELSE 'zh-' || regexp_extract(p_name, '([A-Za-z]+)$', 1) END AS tgt FROM part)"
_TERMS = _TP + ", ts AS (SELECT *, lower(regexp_replace(src, '\\s+', '', 'g')) <> lower(regexp_replace(tgt, '\\s+', '', 'g')) OR regexp_matches(tgt, '[\\x{3400}-\\x{9fff}]') AS done FROM tp), tm AS (SELECT DISTINCT regexp_extract(p_name, '([A-Za-z]+)$', 1) AS en, 'zh-' || regexp_extract(p_name, '([A-Za-z]+)$', 1) AS zh, 'term' AS verdict FROM part UNION ALL SELECT DISTINCT p_name, CASE WHEN length(p_name) % 3 = 0 THEN NULL ELSE 'zz' END, CASE WHEN length(p_name) % 2 = 0 THEN 'paren' ELSE 'term' END FROM part), oc AS (SELECT ts.*, en, zh, verdict FROM ts JOIN tm ON done AND regexp_matches(lower(src), '(^|[^a-z0-9_])' || lower(en) || '($|[^a-z0-9_])'))"


def _terms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part, name, key = table(spark, sf_dir, "part"), F.col("p_name"), F.col("p_partkey")
    last = F.regexp_extract("p_name", "([A-Za-z]+)$", 1)
    zh = F.concat(F.lit("zh-"), last)
    tgt = F.when(key % 5 == 0, "other").when(key % 3 == 0, name).when(key % 4 == 0, F.concat(F.lit("名（"), name, F.lit("）"))).otherwise(zh)
    rows = part.select(key.alias("id"), F.concat_ws(" ", "p_type", name).alias("src"), tgt.alias("tgt"), F.lit(False).alias("passthrough"))
    whole = part.select(name.alias("en"), F.when(F.length(name) % 3 != 0, "zz").alias("zh"), F.when(F.length(name) % 2 == 0, "paren").otherwise("term").alias("verdict")).distinct()
    return audit.with_status(rows), part.select(last.alias("en"), zh.alias("zh"), F.lit("term").alias("verdict")).distinct().unionByName(whole)


@query("glossary_violations", f"WITH {_TERMS} SELECT en, count(*) AS n, count(*) FILTER (WHERE NOT contains(tgt, zh) AND NOT contains(lower(tgt), lower(en))) AS n_violations FROM oc WHERE zh IS NOT NULL GROUP BY en")
def glossary_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.glossary_violations(*_terms(spark, sf_dir))


_FREEZE = f"WITH {_TERMS}, pt AS (SELECT en, coalesce(zh, '') AS given, verdict, count(DISTINCT tgt) AS n_targets, min(tgt) AS one, bool_and(contains(lower(tgt), lower(en))) AS held FROM oc GROUP BY 1, 2, 3), fz AS (SELECT en, CASE WHEN given = '' AND n_targets = 1 AND verdict = 'paren' AND trim(regexp_extract(one, '^([^(（]*)', 1)) <> en THEN trim(regexp_extract(one, '^([^(（]*)', 1)) ELSE given END AS zh, n_targets, verdict, held FROM pt), fr AS (SELECT en, zh, n_targets, CASE WHEN zh = '' AND held THEN true ELSE verdict = 'kept' END AS keep, zh = '' AND NOT held AS needs_ruling FROM fz)"


@query("glossary_freeze", _FREEZE + " SELECT * FROM fr")
def glossary_freeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.glossary_freeze(*_terms(spark, sf_dir))


@query("glossary_frozen", _FREEZE + " SELECT count(*) FILTER (WHERE NOT needs_ruling) AS n_settled, count(*) FILTER (WHERE needs_ruling) AS n_open, count(*) FILTER (WHERE needs_ruling) = 0 AS frozen FROM fr")
def glossary_frozen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the glossary may be frozen."""
    return audit.frozen(audit.glossary_freeze(*_terms(spark, sf_dir)))


@query("glossary_consistent", "WITH g AS (SELECT lower(trim(p_name)) AS key, min((p_name, 'zh-' || p_brand)) AS f FROM part WHERE p_partkey % 3 = 0 GROUP BY 1), p AS (SELECT lower(trim(p_name)) AS key, max((length(p_brand || p_size), p_brand || p_size, p_name)) AS m FROM part WHERE p_partkey % 7 <> 0 GROUP BY 1) SELECT coalesce(f[1], m[3]) AS en, coalesce(f[2], m[2]) AS zh, f IS NOT NULL AS fixed, coalesce(f[2] <> m[2], false) AS differs FROM p FULL JOIN g ON p.key = g.key")
def glossary_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One form per term: the frozen one, else the longest of those in use."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    proposed = F.when(key % 7 == 0, " ").otherwise(F.concat("p_brand", F.col("p_size").cast("string")))
    fixed = part.where(key % 3 == 0).select(F.col("p_name").alias("en"), F.concat(F.lit("zh-"), "p_brand").alias("zh"))
    return audit.consistent(fixed, part.select(F.col("p_name").alias("en"), proposed.alias("zh")))


@query("glossary_proposal", f"WITH pp AS ({ORACLE['propernoun_policy']}), pe AS ({ORACLE['paren_evidence']}), fi AS (SELECT term AS en FROM pp WHERE policy <> 'kept') SELECT en, 'term' AS origin FROM fi UNION ALL SELECT term, 'brackets' FROM pe WHERE lower(term) NOT IN (SELECT lower(en) FROM fi)")
def glossary_proposal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.glossary_proposal(propernoun_policy(spark, sf_dir), paren_evidence(spark, sf_dir))


# Samples

_FEATURES = r", im AS (SELECT page, count(*) AS images, round_even(sum((x1 - x0) * (y1 - y0)) / 480000::DOUBLE, 3) AS image_share FROM layered WHERE ln % 5 = 3 GROUP BY page), f0 AS (SELECT page, (sum(CASE WHEN layer = 'text' THEN len(regexp_extract_all(text, '[\x{3400}-\x{9fff}]')) ELSE 0 END) + floor(sum(CASE WHEN layer = 'text' THEN length(text) ELSE 0 END) / 2))::BIGINT AS chars, count(*) FILTER (WHERE layer = 'l2') AS l2, count(*) FILTER (WHERE layer = 'l2' AND y1 - y0 < 5) AS small, coalesce(max(CASE WHEN layer = 'text' AND length(text) >= 2 THEN y1 - y0 END), 0.0)::DOUBLE AS title, sum(len(regexp_extract_all(text, '[0-9]')))::BIGINT AS digits, sum(len(regexp_extract_all(regexp_replace(text, '[\x{c0}-\x{24f}]', 'x', 'g'), '(?i)\b(?:not|no|never|none|neither|nor|cannot|without|except|lack|fail(?:ed|s)? to)\b')))::BIGINT AS negations FROM layered GROUP BY page), f AS (SELECT f0.*, coalesce(images, 0)::BIGINT AS images, coalesce(image_share, 0)::DOUBLE AS image_share FROM f0 LEFT JOIN im ON f0.page = im.page)"


@query("page_features", sql("layered", _FEATURES + " SELECT * FROM f"))
def page_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = layered(spark, sf_dir)
    images = b.where("ln % 5 = 3").select("page", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"), F.lit(480000.0).alias("page_area"))
    return sampling.page_features(b, images)


def _q(column: str, p: float, where: str = "true") -> str:
    return f"(SELECT coalesce(list_sort(list({column}))[least(count(*) - 1, floor(count(*) * {p}::DOUBLE))::BIGINT + 1], 0) FROM f WHERE {where})"


_STRATA = _FEATURES + f", s AS (SELECT page, CASE WHEN page = 1 THEN 'cover' WHEN title >= {_q('title', 0.9, 'title > 0')} AND {_q('title', 0.9, 'title > 0')} > 0 THEN 'chapter' WHEN l2 >= {_q('l2', 0.75)} THEN 'dense' WHEN chars <= {_q('chars', 0.25)} AND l2 > 0 THEN 'chart' WHEN chars >= {_q('chars', 0.6)} AND l2 <= {_q('l2', 0.25, 'l2 > 0')} THEN 'text' ELSE 'other' END AS stratum FROM f)"


@query("page_strata", sql("layered", _STRATA + " SELECT * FROM s"))
def page_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.strata(page_features(spark, sf_dir))


# Ratios outside of the 5th and 95th of a hundred are anomalies: the fifth part of the risk.
_RISK = _STATUS.replace("FROM pairs", "FROM block_pairs") + ", q AS (SELECT page, length(tgt)::DOUBLE / length(src) AS ratio FROM st WHERE status IN ('translated', 'same') AND length(src) >= 20 AND length(tgt) >= 8), qs AS (SELECT list_sort(list(ratio)) AS l, count(*) AS n FROM q), an AS (SELECT page, count(*) AS anomalies FROM q, qs WHERE ratio < l[least(n - 1, floor(n * 0.05::DOUBLE))::BIGINT + 1] OR ratio > l[least(n - 1, floor(n * 0.95::DOUBLE))::BIGINT + 1] GROUP BY page), fa AS (SELECT f.*, coalesce(anomalies, 0) AS anomalies FROM f LEFT JOIN an ON f.page = an.page), k AS (SELECT page, round_even(" + " + ".join(f"{w}::DOUBLE * {c} / greatest((SELECT max({c}) FROM fa), 1)" for c, w in (("digits", 1.0), ("negations", 2.0), ("anomalies", 2.0), ("l2", 0.5), ("small", 0.5))) + ", 4) AS risk FROM fa)"


@query("risk_score", sql("block_pairs layered", _FEATURES + _RISK + " SELECT * FROM k"))
def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.risk(page_features(spark, sf_dir), sampling.ratio_anomalies(audit.with_status(block_pairs(spark, sf_dir))))


# Quotas as lists over the strata in order of their first page; the largest gives up its last page until few enough are left.
_DRAWN = """, qa AS (SELECT stratum, count(*) AS size, min(page) AS first, (SELECT count(*) FROM s) AS n FROM s GROUP BY stratum),
qb AS (SELECT *, greatest(1, round_even(n * 0.1::DOUBLE, 0)) AS want FROM qa),
qc AS (SELECT *, CASE WHEN stratum = 'cover' THEN 1 ELSE least(size, greatest(1, round_even(want * size / n, 0))) END::BIGINT AS draw FROM qb),
qd AS (SELECT list(stratum ORDER BY first) AS names, list(draw ORDER BY first) AS stay, any_value(want)::BIGINT AS want FROM qc),
qe AS (SELECT names, want, stay, 0 AS step FROM qd UNION ALL SELECT names, want, list_transform(range(1, len(stay) + 1), lambda i: CASE WHEN i = list_position(list_transform(range(1, len(stay) + 1), lambda j: CASE WHEN names[j] = 'cover' OR stay[j] <= 1 THEN -1 ELSE stay[j] END), list_max(list_transform(range(1, len(stay) + 1), lambda j: CASE WHEN names[j] = 'cover' OR stay[j] <= 1 THEN -1 ELSE stay[j] END))) THEN stay[i] - 1 ELSE stay[i] END), step + 1
  FROM qe WHERE list_sum(stay) > want + 2 AND list_max(list_transform(range(1, len(stay) + 1), lambda j: CASE WHEN names[j] = 'cover' OR stay[j] <= 1 THEN -1 ELSE stay[j] END)) > 0),
qf AS (SELECT unnest(names) AS stratum, unnest(stay) AS stay FROM (SELECT * FROM qe ORDER BY step DESC LIMIT 1)),
qg AS (SELECT page, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5('11:' || page), page) AS r FROM s),
qh AS (SELECT page, qg.stratum, row_number() OVER (PARTITION BY qg.stratum ORDER BY page) AS k FROM qg JOIN qc ON qg.stratum = qc.stratum WHERE r <= draw),
d AS (SELECT page, qh.stratum FROM qh JOIN qf ON qh.stratum = qf.stratum WHERE k <= stay)"""


def _recursive(query: str) -> str:
    return query.replace("WITH ", "WITH RECURSIVE ", 1)


@query("stratified_sample", _recursive(sql("layered", _STRATA + _DRAWN + " SELECT * FROM d")))
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified(page_strata(spark, sf_dir))


@query("forced_pool", _recursive(sql("block_pairs layered", _STRATA + _DRAWN + _RISK + " SELECT page, risk FROM k WHERE page NOT IN (SELECT page FROM d) ORDER BY risk DESC, page LIMIT (SELECT ceil(count(*) * 0.2::DOUBLE)::BIGINT FROM f)")))
def forced_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.forced(risk_score(spark, sf_dir), stratified_sample(spark, sf_dir))


@query("equidistant_sample", sql("frags", ", p AS (SELECT page, round_even(avg(conf::DECIMAL(10, 4)), 6) AS conf FROM frags GROUP BY page), o AS (SELECT *, row_number() OVER (ORDER BY conf, page) AS r, greatest(1, count(*) OVER () // 8) AS step FROM p) SELECT page, conf FROM o WHERE (r - 1) % step = 0 AND (r - 1) // step < 8"))
def equidistant_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = frags(spark, sf_dir).groupBy("page").agg(F.bround(F.avg(F.col("conf").cast("decimal(10,4)")).cast("double"), 6).alias("conf"))
    return sampling.every_step(per)


@query("class_sample", sql("frags", f", c AS (SELECT page, ln, {CLS} AS cls, md5('7:' || page || ':' || ln) AS k FROM frags), r AS (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY k) AS r FROM c) SELECT page, ln, cls FROM r WHERE r <= CASE cls WHEN 'skip_numeric' THEN 3 WHEN 'label' THEN 6 ELSE 3 END ORDER BY k LIMIT 14"))
def class_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.by_class(scope.classified(frags(spark, sf_dir)))


@query("inconclusive_gate", _recursive(sql("pairs layered", _STRATA + _DRAWN + r" SELECT sum(len(regexp_extract_all(tgt, '[A-Za-z0-9]+')) + len(regexp_extract_all(tgt, '[\x{3400}-\x{9fff}]')))::BIGINT AS n_words, sum(len(regexp_extract_all(tgt, '[A-Za-z0-9]+')) + len(regexp_extract_all(tgt, '[\x{3400}-\x{9fff}]'))) < 1000 AS inconclusive FROM pairs WHERE page IN (SELECT page FROM d)")))
def inconclusive_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = pairs(spark, sf_dir).join(stratified_sample(spark, sf_dir).select("page"), "page", "left_semi")
    return sampling.sampled_words(drawn.select(F.col("tgt").alias("text")))


@query("long_sentences", sql("pairs", _STATUS + " SELECT doc, ln, page FROM st WHERE status IN ('translated', 'same') AND length(tgt) >= 60 ORDER BY md5('11:' || doc || ':' || ln) LIMIT 10"))
def long_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.long_sentences(audit.with_status(pairs(spark, sf_dir)))


# Residue and drift

_ENGLISH = r"length(text) >= 3 AND regexp_full_match(text, '[\x20-\x7e]*') AND conf >= 0.5 AND length(regexp_replace(text, '[^A-Za-z]', '', 'g')) >= 3 AND length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::DOUBLE / length(text) >= 0.6 AND regexp_matches(text, '[A-Za-z]{2,}')"


_RESIDUE = rf""", e AS (SELECT *, {NORM_WS.format('text')} AS norm FROM frags WHERE ln % 2 = 0 AND {_ENGLISH}),
keep AS (SELECT DISTINCT {NORM_WS.format('text')} AS norm FROM frags WHERE doc % 10 = 0),
lw AS (SELECT page, list_distinct(flatten(list(regexp_extract_all(lower(text), '[A-Za-z]{{2,}}')))) AS words FROM frags WHERE ln % 40 = 1 GROUP BY page),
p AS (SELECT * FROM frags WHERE ln % 4 = 3), sc AS (SELECT page, list(DISTINCT {NORM_WS.format('text')}) AS norms FROM frags WHERE ln % 6 = 5 AND length({NORM_WS.format('text')}) >= 6 GROUP BY page),
re AS (SELECT e.page, e.ln, text, y1 - y0 AS h, CASE WHEN norm IN (SELECT norm FROM keep) OR regexp_matches(text, '(?i)^AI\s*[6OG&]\s*Z?\s*GROWTH$') THEN 'keep'
  WHEN list_has_any(list_filter(regexp_extract_all(lower(text), '[A-Za-z]{{2,}}'), lambda w: length(w) >= 3), coalesce(words, [])) THEN 'textlayer'
  WHEN EXISTS (SELECT 1 FROM p WHERE p.page = e.page AND {_overlap('e', 'p')} >= 0.5) THEN 'covered'
  WHEN len(list_filter(coalesce(norms, []), lambda s: contains(s, norm) OR contains(norm, s))) > 0 THEN 'filtered' ELSE 'unseen' END AS cls
  FROM e LEFT JOIN lw ON lw.page = e.page LEFT JOIN sc ON sc.page = e.page)"""


def _residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frags(spark, sf_dir)
    layer = f.where("ln % 40 = 1").select("page", F.explode(T.words(F.lower("text"))).alias("word"))
    return tracing.residue(f.where("ln % 2 = 0"), f.where("doc % 10 = 0"), layer, f.where("ln % 4 = 3"), f.where("ln % 6 = 5"))


@query("residue_classes", sql("frags", _RESIDUE + " SELECT page, ln, text, cls FROM re"))
def residue_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product's blocks are those of even numbers; text layer, plan and source are other blocks of the page."""
    return _residue(spark, sf_dir)


@query("residue_targets", sql("frags", _RESIDUE + " SELECT page, ln, h, cls, row_number() OVER (ORDER BY h DESC, page, ln) AS rank FROM re WHERE cls = 'unseen' AND h >= 4"))
def residue_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residue that the source's reading doesn't hold, the highest first."""
    found = _residue(spark, sf_dir).join(frags(spark, sf_dir).select("page", "ln", (F.col("y1") - F.col("y0")).alias("h")), ["page", "ln"])
    return tracing.residue_targets(found.select("page", "ln", "h", "cls"))


@query("residue_dedup", sql("blocks", _greedy("blocks", "y0, x0, length(text) DESC, ln", "contains(a.text, x[1].text)") + " SELECT page, ln FROM kept"))
def residue_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.dedup_contained(blocks(spark, sf_dir)).select("page", "ln")


def _content(column: str, stop: tuple[str, ...], least: int) -> str:
    return f"list_distinct(list_filter(regexp_extract_all(lower({column}), '[A-Za-z]{{2,}}'), lambda w: length(w) >= {least} AND NOT list_contains({_list(stop)}, w)))"


_A, _B = _content("src", STOP_SHORT, 3), _content("prod", STOP_SHORT, 3)


@query("residue_verdict", sql("frags", f", r AS (SELECT doc * 100000 + ln AS id, text AS src, CASE WHEN (doc + ln) % 3 = 0 THEN text ELSE reverse(text) END AS prod FROM frags) SELECT id, CASE WHEN len(list_intersect({_A}, {_B})) > 0 THEN 'real' WHEN len({_A}) = 0 THEN 'noise' ELSE 'lookup' END AS verdict FROM r"))
def residue_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frags(spark, sf_dir)
    prod = F.when((F.col("doc") + F.col("ln")) % 3 == 0, F.col("text")).otherwise(F.reverse("text"))
    return tracing.verified(f.select((F.col("doc") * 100000 + F.col("ln")).alias("id"), F.col("text").alias("src"), prod.alias("prod")))


@query("backtrans_queue", _recursive(sql("pairs layered", _STRATA + _DRAWN + _STATUS + " SELECT 'b' || lpad((row_number() OVER (ORDER BY doc, ln) - 1)::VARCHAR, 4, '0') AS gid, doc, ln FROM (SELECT doc, ln FROM st WHERE status IN ('translated', 'same') AND length(tgt) >= 24 AND page IN (SELECT page FROM d) ORDER BY doc, ln LIMIT 120)")))
def backtrans_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracing.drift_queue(audit.with_status(pairs(spark, sf_dir)), stratified_sample(spark, sf_dir))


_CA, _CB = _content("src", STOP_LONG, 2), _content("back", STOP_LONG, 2)
_POL = r"(regexp_matches(regexp_replace({0}, '[\x{{c0}}-\x{{24f}}]', 'x', 'g'), '(?i)\b(?:not|non|no|never|none|nothing|neither|nor|without|cannot)\b|[A-Za-z]+n[''’]t\b|[不没无未非别勿莫]'))"
_WORDS_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in NUMBER_WORDS.items()) + "}"


def _nums(column: str) -> str:
    spoken = f"list_filter(list_transform(regexp_extract_all(lower({column}), '[A-Za-z]{{2,}}'), lambda w: {_WORDS_SQL}[w]), lambda v: v IS NOT NULL)"
    return f"list_distinct(list_concat({_RUNS.format(column)}, {spoken}))"


@query("backtrans_verdict", sql("frags", f""", r AS (SELECT doc * 100000 + ln AS id, text AS src, CASE WHEN (doc + ln) % 3 = 0 THEN text WHEN (doc + ln) % 3 = 1 THEN text[1:length(text) // 2] ELSE 'not ' || text END AS back FROM frags),
s AS (SELECT *, {_CA} AS a, {_CB} AS b, {_nums('src')} AS na, {_nums('back')} AS nb FROM r),
t AS (SELECT *, len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))) AS j, len(list_filter(na, lambda t: NOT (list_contains(nb, t) OR length(t) = 2 AND list_contains(nb, '20' || t) OR length(t) = 4 AND list_contains(nb, substr(t, 3, 2))))) AS m, length(back)::DOUBLE / length(src) AS q FROM s WHERE len(a) > 0 AND len(b) > 0 AND length(src) > 0)
SELECT id, round_even(j, 4) AS overlap, m AS n_missing, CASE WHEN m > 0 OR q < 0.45 OR q > 2.2 OR j < 0.15 THEN 'flag' WHEN j < 0.35 OR {_POL.format('src')} <> {_POL.format('back')} THEN 'watch' ELSE 'ok' END AS verdict FROM t"""))
def backtrans_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frags(spark, sf_dir)
    k = (F.col("doc") + F.col("ln")) % 3
    back = F.when(k == 0, F.col("text")).when(k == 1, F.expr("substring(text, 1, cast(length(text) div 2 as int))")).otherwise(F.concat(F.lit("not "), "text"))
    return tracing.drift(f.select((F.col("doc") * 100000 + F.col("ln")).alias("id"), F.col("text").alias("src"), back.alias("back")))


# Layout


@query("align_multi", sql("blocks", """, g AS (SELECT page, ln // 3 AS para, list(x0 ORDER BY x0) AS a, list(x1 ORDER BY x1) AS b, list((x0 + x1) / 2 ORDER BY (x0 + x1) / 2) AS c, max(y1 - y0) AS size, count(*) AS n FROM (SELECT page, ln, y0, y1, floor(x0 / 200) + (ln % 3) * ((doc % 3) - 1) AS x0, floor(x0 / 200) + 100 + (ln % 3) * (doc % 2) AS x1 FROM blocks) GROUP BY 1, 2 HAVING count(*) > 1),
r AS (SELECT page, para, n, size, """ + ", ".join(f"CASE WHEN n >= 3 THEN least({v}[n] - {v}[1], {v}[n - 1] - {v}[1], {v}[n] - {v}[2]) ELSE {v}[n] - {v}[1] END AS {v}{v}" for v in "abc") + """ FROM g),
o AS (SELECT *, list_sort([{'s': aa, 'i': 0, 'k': 'left'}, {'s': bb, 'i': 1, 'k': 'right'}, {'s': cc, 'i': 2, 'k': 'center'}]) AS z, greatest(1.5, 0.15::DOUBLE * size) AS tol FROM r)
SELECT page, para, n::INT AS n_lines, CASE WHEN aa <= tol THEN 'left' WHEN z[1].s <= tol AND (z[2].s <= 0 OR z[1].s <= 0.6::DOUBLE * z[2].s) THEN z[1].k ELSE 'left' END AS align FROM o"""))
def align_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    ln, doc, base = F.col("ln"), F.col("doc"), F.floor(F.col("x0") / 200)
    rows = blocks(spark, sf_dir).select("page", F.expr("ln div 3").alias("para"), (base + (ln % 3) * (doc % 3 - 1)).cast("double").alias("x0"), (base + 100 + (ln % 3) * (doc % 2)).cast("double").alias("x1"), (F.col("y1") - F.col("y0")).alias("h"))
    return layout.multi_aligned(rows, F.col("h"))


def unit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in two columns, in two fonts."""
    ln, doc = F.col("ln"), F.col("doc")
    rows = lines(spark, sf_dir)
    column = ln % 2
    x0 = (column * 300 + F.when((doc + ln) % 9 == 0, 12).otherwise(0)).cast("double")
    y0 = (F.expr("ln div 2") * 14).cast("double")
    size = F.when(ln % 10 < 2, 16.0).otherwise(10.0)
    return rows.select("doc", "page", "ln", x0.alias("x0"), y0.alias("y0"), (x0 + 5.0 * F.length("text")).alias("x1"), (y0 + 12).alias("y1"), "text", F.when(ln % 10 < 2, "Bold").otherwise("Regular").alias("font"), size.alias("size"), F.lit(0).alias("color"))


#: Whether a line (x) goes on a group by its last line (g), and how far off it is; null: it doesn't.
_GAP = "CASE WHEN g.font = x.l.font AND abs(g.size - x.l.size) < 0.15 AND greatest(0, least(x.l.x1, g.x1) - greatest(x.l.x0, g.x0)) / greatest(least(x.l.x1 - x.l.x0, g.x1 - g.x0), 1e-6) > 0.3 AND least(x.l.y1, g.y1) - greatest(x.l.y0, g.y0) <= 0.6::DOUBLE * least(x.l.y1 - x.l.y0, g.y1 - g.y0) AND x.l.y0 - g.y1 BETWEEN -0.35::DOUBLE * (g.y1 - g.y0) AND greatest(0.55::DOUBLE * (g.y1 - g.y0), 5) THEN abs(x.l.y0 - g.y1) END"
_GAPS = f"list_transform(acc.gs, lambda q: list_first(list_transform([q[len(q)]], lambda g: {_GAP})))"
_SPREAD = "list_max({0}) - list_min({0})"


@query("units_extract", sql("lines", rf""", ul AS (SELECT doc, page, {{'ln': ln, 'x0': x0, 'y0': y0, 'x1': x0 + 5.0::DOUBLE * length(text), 'y1': y0 + 12, 'text': text, 'font': font, 'size': size}} AS l FROM (SELECT doc, page, ln, text, ((ln % 2) * 300 + CASE WHEN (doc + ln) % 9 = 0 THEN 12 ELSE 0 END)::DOUBLE AS x0, ((ln // 2) * 14)::DOUBLE AS y0, CASE WHEN ln % 10 < 2 THEN 'Bold' ELSE 'Regular' END AS font, CASE WHEN ln % 10 < 2 THEN 16.0 ELSE 10.0 END::DOUBLE AS size FROM lines)),
us AS (SELECT doc, page, list({{'l': l, 'gs': [[l]][1:0]}} ORDER BY round_even(l.y0, 1), l.x0, l.ln) AS steps FROM ul GROUP BY doc, page),
uf AS (SELECT doc, page, list_reduce(list_prepend({{'l': steps[1].l, 'gs': [[steps[1].l]]}}, steps[2:len(steps)]), lambda acc, x: {{'l': x.l, 'gs': CASE WHEN list_min({_GAPS}) IS NULL THEN list_append(acc.gs, [x.l]) ELSE list_transform(acc.gs, lambda q, i: CASE WHEN i = list_position({_GAPS}, list_min({_GAPS})) THEN list_append(q, x.l) ELSE q END) END}}).gs AS gs FROM us),
ug AS (SELECT doc, page, unnest(gs) AS g FROM uf),
uh AS (SELECT doc, page, g, row_number() OVER (PARTITION BY doc, page ORDER BY round_even(list_min(list_transform(g, lambda v: v.y0)), 1), list_min(list_transform(g, lambda v: v.x0))) - 1 AS unit, list_transform(g, lambda v: v.x0) AS a, list_transform(g, lambda v: v.x1) AS b, list_transform(g, lambda v: (v.x0 + v.x1) / 2) AS c, list_position(list_transform(g, lambda v: length(v.text)), list_max(list_transform(g, lambda v: length(v.text)))) AS top, list_reduce(list_transform(g, lambda v: trim(regexp_replace(v.text, '\s+', ' ', 'g'), ' ')), lambda t, v: CASE WHEN t[len(t):] = '-' THEN t[1:len(t) - 1] || v ELSE trim(t || ' ' || v, ' ') END) AS text FROM ug)
SELECT doc, page, unit::INT AS unit, list_min(a) AS x0, list_min(list_transform(g, lambda v: v.y0)) AS y0, list_max(b) AS x1, list_max(list_transform(g, lambda v: v.y1)) AS y1, text, g[top].font AS font, g[top].size AS size, CASE WHEN len(g) = 1 OR {_SPREAD.format('a')} < 1.5 THEN 'left' WHEN {_SPREAD.format('b')} < 1.5 THEN 'right' WHEN {_SPREAD.format('c')} < 1.5 THEN 'center' ELSE 'left' END AS align, CASE WHEN len(g) > 1 THEN (g[len(g)].y0 - g[1].y0) / (len(g) - 1) END AS lineheight, len(g)::INT AS nlines, NOT regexp_matches(text, '[A-Za-z]') AS passthrough FROM uh"""))
def units_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.units(unit_lines(spark, sf_dir)).drop("lines")


@query("align_single")
def align_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.aligned(layout.units(unit_lines(spark, sf_dir)), table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("page"), F.lit(612.0).alias("width")))


@query("room_below", sql("frags", "SELECT page, ln, round_even(least(most, coalesce(lim, most)), 4) AS bottom FROM (SELECT l.page, l.ln, l.y1 + 3 * (l.y1 - l.y0) AS most, (SELECT min(r.y0 - 1.5::DOUBLE) FROM frags r WHERE r.page = l.page AND r.ln <> l.ln AND r.x1 > l.x0 + 2 AND r.x0 < l.x1 - 2 AND r.y0 >= l.y1 - 1 AND r.y0 <= l.y1 + 3 * (l.y1 - l.y0) + 1.5::DOUBLE) AS lim FROM frags l)"))
def room_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.room_below(frags(spark, sf_dir).select("page", "ln", "x0", "y0", "x1", "y1"))


@query("row_neighbours", sql("frags", 'SELECT l.page, l.ln, max(CASE WHEN r.x1 <= l.x0 + 1 THEN r.x1 END) AS "left", min(CASE WHEN r.x0 >= l.x1 - 1 THEN r.x0 END) AS "right" FROM frags l JOIN frags r ON l.page = r.page AND l.ln <> r.ln AND least(l.y1, r.y1) - greatest(l.y0, r.y0) > 0 GROUP BY 1, 2'))
def row_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.row_neighbours(frags(spark, sf_dir).select("page", "ln", "x0", "y0", "x1", "y1"))


@query("baseline_lookup", "SELECT size, ratio, round_even(CASE WHEN size <= 10 THEN 5 + 0.25::DOUBLE ELSE size * (0.3::DOUBLE + 0.5::DOUBLE * ratio) END, 6) AS k FROM (SELECT DISTINCT p_size::DOUBLE AS size, CASE WHEN p_size <= 14 THEN 1.35::DOUBLE ELSE 1.22::DOUBLE END AS ratio FROM part)")
def baseline_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("double")
    combos = table(spark, sf_dir, "part").select(size.alias("size"), G.line_ratio(F.lit(None).cast("double"), size).alias("ratio"))
    return layout.baselines(combos, combos.where("size <= 10").distinct().withColumn("k", F.lit(5.25)))


@query("fitting_size")
def fitting_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = blocks(spark, sf_dir)
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return f.select("page", "ln", F.round(kernels.fit_size("text", w, h, 0.78 * h, 1.15 * h), 4).alias("size"))


# Rasters


def _mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    scaled = lambda c: F.transform(c, lambda v: v.cast("double") * 127 + 128)
    return e.join(other, "vec_id").select("vec_id", scaled(F.col("embedding")).alias("a"), scaled(F.col("b")).alias("b"))


@query("ssim_pairs", "WITH r AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE * 127 + 128) AS a FROM embeddings), m AS (SELECT x.vec_id, x.a, y.a AS b FROM r x JOIN r y ON y.vec_id = x.vec_id + 1), s AS (SELECT vec_id, list_avg(a) AS ma, list_avg(b) AS mb, list_avg(list_transform(range(1, 65), lambda i: a[i] * b[i])) AS ab, list_avg(list_transform(a, lambda v: v * v)) AS aa, list_avg(list_transform(b, lambda v: v * v)) AS bb FROM m) SELECT vec_id, round_even((2 * ma * mb + 6.5025::DOUBLE) * (2 * (ab - ma * mb) + 58.5225::DOUBLE) / ((ma * ma + mb * mb + 6.5025::DOUBLE) * ((aa - ma * ma) + (bb - mb * mb) + 58.5225::DOUBLE)), 6) AS ssim FROM s")
def ssim_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mates(spark, sf_dir).select("vec_id", F.bround(kernels.ssim("a", "b"), 6).alias("ssim"))


_IOU = "CASE WHEN least(x.r.x1, b.x1) > greatest(x.r.x0, b.x0) AND least(x.r.y1, b.y1) > greatest(x.r.y0, b.y0) THEN (least(x.r.x1, b.x1) - greatest(x.r.x0, b.x0)) * (least(x.r.y1, b.y1) - greatest(x.r.y0, b.y0)) / ((x.r.x1 - x.r.x0) * (x.r.y1 - x.r.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - (least(x.r.x1, b.x1) - greatest(x.r.x0, b.x0)) * (least(x.r.y1, b.y1) - greatest(x.r.y0, b.y0))) ELSE 0::DOUBLE END"
_IOUS = f"list_transform(acc.rest, lambda b: {_IOU})"


@query("rect_iou_match", sql("blocks", f""", ra AS (SELECT page, {{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} AS r FROM blocks), rb AS (SELECT page, list({{'x0': r.x0 + 1, 'y0': r.y0, 'x1': r.x1 + 1, 'y1': r.y1}} ORDER BY r.x0, r.y0, r.x1, r.y1) AS rest FROM ra GROUP BY page),
rl AS (SELECT ra.page, list_prepend({{'r': any_value(r), 'rest': any_value(rest), 'scores': []::DOUBLE[]}}, list({{'r': r, 'rest': rest[1:0], 'scores': []::DOUBLE[]}} ORDER BY -((r.x1 - r.x0) * (r.y1 - r.y0)), r.x0, r.y0, r.x1, r.y1)) AS steps FROM ra JOIN rb ON ra.page = rb.page GROUP BY ra.page),
rr AS (SELECT page, list_reduce(steps, lambda acc, x: {{'r': x.r, 'rest': CASE WHEN list_max({_IOUS}) > 0 THEN list_concat(acc.rest[1:list_position({_IOUS}, list_max({_IOUS})) - 1], acc.rest[list_position({_IOUS}, list_max({_IOUS})) + 1:len(acc.rest)]) ELSE acc.rest END, 'scores': list_append(acc.scores, coalesce(list_max({_IOUS}), 0))}}) AS s FROM rl)
SELECT page, len(s.scores)::BIGINT AS n, list_sum(s.scores) / len(s.scores) AS iou FROM rr"""))
def rect_iou_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blocks(spark, sf_dir)
    sides = b.select("page", "x0", "y0", "x1", "y1", F.lit("a").alias("side")).unionByName(b.select("page", F.col("x0") + 1, "y0", F.col("x1") + 1, "y1", F.lit("b").alias("side")).toDF("page", "x0", "y0", "x1", "y1", "side"))
    return map_groups(sides, ["page"], ["side"], kernels.matched_rects, "page long, n long, iou double")


# Snapshots

_SNAP = "a AS (SELECT o_orderkey::VARCHAR AS path, length(o_orderpriority)::BIGINT AS size, o_orderkey % 3 AS mtime, sha256(o_orderpriority || o_orderstatus) AS h, o_orderkey AS k FROM orders WHERE o_orderkey % 19 <> 0), b AS (SELECT o_orderkey::VARCHAR AS path, length(o_orderpriority)::BIGINT AS size, CASE WHEN o_orderkey % 29 = 0 THEN 9 ELSE o_orderkey % 3 END AS mtime, sha256(o_orderpriority || CASE WHEN o_orderkey % 23 = 0 THEN '!' ELSE o_orderstatus END) AS h FROM orders WHERE o_orderkey % 17 <> 0)"


def _snapshot(spark: SparkSession, sf_dir: str, new: bool) -> DataFrame:
    key = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").where(key % (17 if new else 19) != 0)
    status = F.when(key % 23 == 0, "!").otherwise(F.col("o_orderstatus")) if new else F.col("o_orderstatus")
    mtime = F.when(key % 29 == 0, 9).otherwise(key % 3) if new else key % 3
    return o.select(key.cast("string").alias("path"), F.length("o_orderpriority").cast("long").alias("size"), mtime.alias("mtime"), F.lit("644").alias("mode"), F.sha2(F.concat("o_orderpriority", status), 256).alias("sha256"))


@query("guard_diff", f"WITH {_SNAP} SELECT path, why, CASE WHEN why = 'same' THEN 'PASS' WHEN why = 'mtime' THEN 'WARN' ELSE 'FAIL' END AS result FROM (SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'missing' WHEN a.path IS NULL THEN 'unknown' WHEN a.h <> b.h THEN 'content' WHEN a.mtime <> b.mtime THEN 'mtime' ELSE 'same' END AS why FROM a FULL JOIN b ON a.path = b.path)")
def guard_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.guard(_snapshot(spark, sf_dir, False), _snapshot(spark, sf_dir, True))


@query("manifest_gaps", f"WITH {_SNAP} SELECT a.path, b.h AS sha256, b.size, b.path IS NULL AS missing FROM a LEFT JOIN b ON a.path = b.path")
def manifest_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.manifest(_snapshot(spark, sf_dir, False).select("path"), _snapshot(spark, sf_dir, True).select("path", "sha256", "size"))


@query("toc_compare", "SELECT n_nationkey AS pos, n_nationkey % 5 <> 0 AS same_place, n_nationkey % 2 = 0 AS translated FROM nation")
def toc_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pos"), F.lit(1).alias("level"), F.col("n_regionkey").alias("page"), F.col("n_name").alias("title"))
    moved = n.withColumn("page", F.when(F.col("pos") % 5 == 0, -1).otherwise(F.col("page"))).withColumn("title", F.when(F.col("pos") % 2 == 0, F.lit("x")).otherwise(F.col("title")))
    return snapshots.compared_contents(n, moved)


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    return scope_summary(spark, sf_dir)



