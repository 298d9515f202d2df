"""Operators against plain models and properties."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions import kernels as K
from quire.operators import audit, fold, layout, quality, sampling, scope, snapshots, tracing, worklist
from quire.plans.shared import global_rank
from quire.plans.views import blocks, frags

SF = "/root/testdata/sf0.001"
BOX = "x0 double, y0 double, x1 double, y1 double"


@pytest.fixture(scope="module")
def few(spark):
    return frags(spark, SF).where("doc < 60").cache()


def overlap(a, b):
    w, h = min(a["x1"], b["x1"]) - max(a["x0"], b["x0"]), min(a["y1"], b["y1"]) - max(a["y0"], b["y0"])
    area = lambda r: (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])
    return w * h / max(min(area(a), area(b)), 1e-6) if w > 0 and h > 0 else 0.0


def by_page(rows):
    out = {}
    for r in rows:
        out.setdefault(r["page"], []).append(r)
    return out


def test_greedy_dedup_is_the_model_and_idempotent(spark):
    rows = blocks(spark, SF).where("doc < 40")
    kept = {(r["page"], r["ln"]) for r in fold.dedup_overlaps(rows).collect()}
    model = set()
    for page, group in by_page(rows.collect()).items():
        accepted = []
        for r in sorted(group, key=lambda r: (-len(r["text"]), r["ln"])):
            if all(overlap(a, r) <= 0.55 for a in accepted):
                accepted.append(r)
        model |= {(page, r["ln"]) for r in accepted}
    assert kept == model
    again = fold.dedup_overlaps(fold.dedup_overlaps(rows))
    assert {(r["page"], r["ln"]) for r in again.collect()} == kept


def test_residue_dedup_is_the_model(few):
    kept = {(r["page"], r["ln"]) for r in fold.dedup_contained(few).collect()}
    model = set()
    for page, group in by_page(few.collect()).items():
        accepted = []
        for r in sorted(group, key=lambda r: (r["y0"], r["x0"], -len(r["text"]), r["ln"])):
            if not any(r["text"] in a["text"] for a in accepted):
                accepted.append(r)
        model |= {(page, r["ln"]) for r in accepted}
    assert kept == model


def test_increment_keeps_all_old_rows_and_no_new_overlaps(few):
    old, new = few.where("ln % 2 = 0"), few.where("ln % 2 = 1")
    out = worklist.plan_increment(old, new)
    assert out.where("origin = 'old'").count() == old.count()
    boxes = {(r["page"], r["ln"]): r for r in few.collect()}
    for page, group in by_page(out.collect()).items():
        fresh = [boxes[page, r["ln"]] for r in group if r["origin"] == "new"]
        rest = [boxes[page, r["ln"]] for r in group if r["origin"] == "old"]
        for i, r in enumerate(fresh):
            assert all(overlap(r, o) <= 0.55 for o in rest + fresh[:i])


def test_reasons_split_all_blocks(few):
    rows = worklist.with_reason(few)
    assert rows.where("reason IS NULL").count() + rows.where("reason IS NOT NULL").count() == few.count()


def test_verdict_borders(spark):
    rows = [(0.34, "skip"), (0.35, "review"), (0.54, "review"), (0.55, "ok")]
    df = spark.createDataFrame([(c, "some words", v) for c, v in rows], "conf double, text string, want string")
    assert quality.verdicts(df).where("verdict <> want").count() == 0


@pytest.mark.parametrize(("skip", "review", "agreement", "want"), [(30, 0, None, "NO-GO"), (0, 0, 0.5, "NO-GO"), (5, 15, None, "GO*"), (5, 15, 0.85, "GO"), (5, 15, 0.7, "REVIEW"), (6, 0, 0.9, "REVIEW")])
def test_gate(spark, skip, review, agreement, want):
    rows = [("skip",)] * skip + [("review",)] * review + [("ok",)] * (100 - skip - review)
    assert quality.gate(spark.createDataFrame(rows, "verdict string"), agreement).first()["gate"] == want


def test_conflicts(spark):
    rows = [(1, 0, 0.0, 0.0, 10.0, 10.0, "revenue growth"), (1, 1, 0.0, 1.0, 10.0, 11.0, "rxxenue gzzzth"), (1, 2, 0.0, 0.0, 10.0, 10.0, "revenue growth!")]
    df = spark.createDataFrame(rows, f"page long, ln long, {BOX}, text string")
    assert {(r["first"], r["second"]) for r in quality.conflicts(df).collect()} == {(0, 1), (1, 2)}


def test_ranks_count_all_rows(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), "id")
    got = [(r["a"], r["id"]) for r in global_rank(df, "r", F.col("a"), F.desc("id")).orderBy("r").collect()]
    assert got == sorted(((i % 7, i) for i in range(1000)), key=lambda x: (x[0], -x[1]))


def test_pages_out_of_range_fail(spark):
    with pytest.raises(Exception, match="page out of range"):
        scope.page_range(spark.createDataFrame([("3-9",)], "spec string"), 5).collect()


def test_statuses(spark):
    rows = [("a b", "", False, "empty"), ("a b", "A B", False, "unchanged"), ("12%", "x", False, "kept"), ("ab", "x", True, "kept"), ("中a", "中 A", False, "same"), ("ab", "乙", False, "translated")]
    df = spark.createDataFrame(rows, "src string, tgt string, passthrough boolean, want string")
    assert audit.with_status(df).where("status <> want").count() == 0


def test_variants_merge(spark):
    df = spark.createDataFrame([(["A", "A and more", "B"],)], "v array<string>")
    assert df.select(fold.merge_variants(F.col("v"))).first()[0] == ["A and more", "B"]


def test_proper_nouns_count_blocks_without_empty_targets(spark):
    rows = [("ABCD x", "ABCD"), ("ABCD y", "ABCD"), ("ABCD z", "zzz"), ("ABCD w", ""), ("WXYZ a", "WXYZ"), ("WXYZ b", "WXYZ"), ("WXYZ c", "")]
    got = audit.proper_nouns(spark.createDataFrame(rows, "src string, tgt string")).collect()
    assert [(r["term"], r["n"], r["n_kept"], r["policy"]) for r in got] == [("ABCD", 3, 2, "policy-mixed")]


def test_quantile_is_by_index(spark):
    df = spark.createDataFrame([(float(i),) for i in (5, 1, 3, 3, 9)], "v double")
    for p in (0.0, 0.25, 0.5, 0.75, 0.99):
        want = sorted([5.0, 1.0, 3.0, 3.0, 9.0])[min(4, int(5 * p))]
        assert sampling.quantile(df, "v", p, "q").first()["q"] == want
    assert sampling.quantile(df.where("false"), "v", 0.5, "q").first()["q"] == 0.0


def test_samples_do_not_depend_on_partitions(spark):
    pages = spark.range(1, 400).select(F.col("id").alias("page"), F.when(F.col("id") == 1, "cover").when(F.col("id") % 9 == 0, "chart").otherwise("text").alias("stratum"))
    one, many = (sorted((r["page"], r["stratum"]) for r in sampling.stratified(p).collect()) for p in (pages.coalesce(1), pages.repartition(13)))
    assert one == many and (1, "cover") in one and {s for _, s in one} == {"cover", "chart", "text"}


def test_drift_borders(spark):
    a = "alpha beta gamma delta " * 3
    rows = [(1, a, a, "ok"), (2, a, "omega " * 10, "flag"), (3, a + "17", a, "flag"), (4, a, "not " + a, "watch"), (5, a, a[: len(a) // 3], "flag")]
    got = {r["id"]: r["verdict"] for r in tracing.drift(spark.createDataFrame([r[:3] for r in rows], "id int, src string, back string")).collect()}
    assert got == {r[0]: r[3] for r in rows}


def test_residue_verdicts(spark):
    rows = [(1, "the growth", "growth the", "real"), (2, "the", "the", "noise"), (3, "growth", "the", "lookup")]
    got = tracing.verified(spark.createDataFrame([r[:3] for r in rows], "id int, src string, prod string"))
    assert {r["id"]: r["verdict"] for r in got.collect()} == {r[0]: r[3] for r in rows}


def test_guard(spark):
    schema = "path string, size long, mtime string, mode string, sha256 string"
    base = [("a", 1, "t", "644", "h"), ("b", 1, "t", "644", "h"), ("c", 1, "t", "644", "h"), ("d", 1, "t", "644", "h"), ("e", 1, "t", "644", "h")]
    now = [("a", 1, "t", "644", "h"), ("b", 1, "u", "644", "h"), ("c", 1, "t", "600", "h"), ("d", 1, "t", "644", "x"), ("f", 1, "t", "644", "h")]
    got = {r["path"]: r["result"] for r in snapshots.guard(spark.createDataFrame(base, schema), spark.createDataFrame(now, schema)).collect()}
    assert got == {"a": "PASS", "b": "WARN", "c": "PASS", "d": "FAIL", "e": "FAIL", "f": "FAIL"}
    same = snapshots.guard(*[spark.createDataFrame(base, schema)] * 2)
    assert {r["result"] for r in same.collect()} == {"PASS"}


def line(ln, x0, y0, text, x1=None, font="R", size=10.0):
    return {"doc": 1, "page": 2, "ln": ln, "x0": float(x0), "y0": float(y0), "x1": float(x1 or x0 + 100), "y1": float(y0 + 10), "text": text, "font": font, "size": size, "color": 0}


def test_units_keep_columns_apart():
    rows = [line(0, 0, 0, "left one-"), line(1, 300, 5, "right one"), line(2, 0, 12, "two"), line(3, 300, 17, "right two"), line(4, 0, 60, "far"), line(5, 0, 72, "other font", font="B")]
    got = layout.page_units(rows)
    assert [u[7] for u in got] == ["left onetwo", "right one right two", "far", "other font"]
    assert [u[12] for u in got] == [2, 2, 1, 1]


def test_units_that_begin_at_the_same_place_stay_in_order():
    """Units that reach the left edge only by a later line come after those opened before them, whatever order the lines come in."""
    rows = [line(0, 0, 0, "z"), line(1, 200, 0, "y", font="B"), line(2, 300, 0, "x", font="I"), line(3, 0, 12, "b", 400, "I"), line(4, 0, 12, "a", 400, "B")]
    for some in (rows, rows[::-1], rows[2:] + rows[:2]):
        assert [(u[2], u[3], u[4], u[7]) for u in layout.page_units(some)] == [(0, 0.0, 0.0, "z"), (1, 0.0, 0.0, "y a"), (2, 0.0, 0.0, "x b")]


def unit(i, x0, x1, y0, lines=(), align="left", size=10.0, text="Some words", width=600.0):
    spans = [{"x0": float(a), "x1": float(b), "y0": 0.0, "y1": 0.0} for a, b in lines] or [{"x0": float(x0), "x1": float(x1), "y0": 0.0, "y1": 0.0}]
    return {"doc": 1, "page": 1, "unit": i, "x0": float(x0), "x1": float(x1), "y0": float(y0), "y1": float(y0 + 10), "nlines": len(spans), "lines": spans, "align": align, "size": size, "text": text, "width": width}


def test_single_lines_follow_anchors_and_pages():
    of = lambda *rows: {r[2]: (r[3], r[4]) for r in layout.page_align(list(rows))}
    centered = [(100, 200), (120, 180), (130, 170)]
    assert of(unit(0, 100, 200, 0, centered), unit(1, 122, 178, 40), unit(2, 400, 600, 80)) == {0: ("center", "multi"), 1: ("center", "anchor"), 2: ("left", "default")}
    # without units of several lines the page decides, by its own width and not that of its units
    assert of(unit(0, 100, 500, 0), unit(1, 500, 600, 80)) == {0: ("center", "page"), 1: ("right", "page")}
    assert of(unit(0, 100, 500, 0, width=900.0), unit(1, 0, 890, 80, width=900.0)) == {0: ("left", "default"), 1: ("right", "page")}
    assert of(unit(0, 100, 500, 0, width=None)) == {0: ("left", "default")}
    # the middle of the neighbours of a row, and the size of a centred one of it
    assert of(unit(0, 0, 50, 0), unit(1, 100, 160, 2), unit(2, 210, 300, 1), unit(3, 400, 450, 3, align="left"))[1] == ("center", "row-mid")
    assert of(unit(0, 0, 50, 0, text="12"), unit(1, 60, 90, 300))[0] == ("left", "number")
    # neighbours that overlap leave no room for a middle
    assert of(unit(0, 0, 101, 0), unit(1, 100, 101, 2), unit(2, 100, 300, 1))[1][1] != "row-mid"


def test_units_without_letters_are_passed_through():
    rows = [line(0, 0, 0, "12 %"), line(1, 300, 5, "a 1")]
    assert [u[14] for u in layout.page_units(rows)] == [True, False]


def test_quotas_are_trimmed():
    sizes = {"cover": 1, "chart": 6, "text": 6, "dense": 6, "chapter": 6, "other": 6}
    got = sampling.quotas(sizes, 31, 0.1)
    assert got == {"cover": (1, 1)} | {s: (1, 1) for s in list(sizes)[1:]}  # nothing above one is left to trim
    # eleven drawn where eight are wanted: the first of the largest gives up one
    got = sampling.quotas({"cover": 1, "a": 15, "b": 15, "c": 15, "d": 15, "e": 15}, 76, 0.1)
    assert got == {"cover": (1, 1), "a": (2, 1), "b": (2, 2), "c": (2, 2), "d": (2, 2), "e": (2, 2)}


def test_trimmed_strata_give_up_their_last_pages(spark):
    rows = [(1, "cover")] + [(2 + i, "abcde"[i % 5]) for i in range(75)]
    pages = spark.createDataFrame(rows, "page long, stratum string")
    key = lambda p: hashlib.md5(f"11:{p}".encode()).hexdigest()
    want = {1}
    for s, (draw, stay) in sampling.quotas({"cover": 1, **dict.fromkeys("abcde", 15)}, 76, 0.1).items():
        if s != "cover":
            want |= set(sorted(sorted((p for p, t in rows if t == s), key=key)[:draw])[:stay])
    assert {r["page"] for r in sampling.stratified(pages).collect()} == want
    assert sampling.stratified(pages.where("false")).count() == 0


def test_ssim_and_errors():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (16, 16))
    assert K.ssim_of(a, a) == pytest.approx(1.0)
    assert K.ssim_of(a, 255 - a) < 0.1
    assert K.masked_error(a, a, np.zeros_like(a, bool)) == (0.0, 0.0)
    b = a.copy()
    b[0, 0] = (b[0, 0] + 128) % 256
    mask = np.zeros_like(a, bool)
    mask[0, 0] = True
    assert K.masked_error(a, b, mask) == (0.0, 0.0) and K.masked_error(a, b, ~mask)[1] == 1.0


def test_colors_and_skew():
    px = np.full((20, 20, 3), 240, np.uint8)
    px[5:8, 5:15] = (16, 16, 16)
    back, text = K.modal_color(px)
    assert back == (240, 240, 240) and text == (16, 16, 16)
    grey = np.full((200, 200), 255.0)
    for k in range(20, 180, 20):
        for x in range(200):
            grey[int(round(k + np.tan(np.deg2rad(2.0)) * x)) % 200, x] = 0
    assert abs(K.skew_of(grey) - 2.0) <= 0.5


def test_rectangles_match():
    rows = [{"page": 1, "side": s, "x0": x, "y0": 0.0, "x1": x + 10, "y1": 10.0} for s, x in (("a", 0.0), ("a", 50.0), ("b", 0.0), ("b", 55.0))]
    assert K.matched_rects(rows) == [(1, 2, pytest.approx((1 + 5 / 15) / 2))]
