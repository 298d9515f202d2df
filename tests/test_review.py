"""Structure, text audit, rebuilt pages, rasters and the report."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire import review_queries as R
from quire.functions import kernels
from quire.functions import text as T
from quire.operators import audit, rebuild, scope, structure, visual, worklist

SF = "/root/testdata/sf0.001"
PAGES = "page long, width double, height double, rotation long"
TOC = "pos long, level long, page long, title string"
UNITS = "id long, page long, size double, text string, passthrough boolean"


def checked(spark, src=((1, 600.0, 800.0, 0),), dst=((1, 600.4, 800.0, 0),), toc=((0, 1, 1, "A"),), new=((0, 1, 1, "译"),), units=((1, 1, 20.0, "Title", False),), zh=((1, "题"),), fonts=(("F", True),)):
    frame = lambda rows, ddl: spark.createDataFrame(list(rows), ddl)
    got = structure.structure_checks(frame(src, PAGES), frame(dst, PAGES), frame(toc, TOC), frame(new, TOC), frame([*units, *((k, 1, 10.0, "body text", False) for k in range(100, 110))], UNITS), frame(zh, "id long, zh string"), frame(fonts, "name string, embedded boolean"))
    rows = sorted(got.collect(), key=lambda r: r["ord"])
    assert [r["check"] for r in rows] == ["open", "pages", "size", "rotation", "toc", "titles", "fonts"]
    return " ".join(r["status"][0] for r in rows)


def test_structure_gate(spark):
    assert checked(spark) == "P P P P P P P"
    assert checked(spark, dst=()) == "F S S S S S S"
    assert checked(spark, src=(), toc=()) == "P S S S S P P"
    assert checked(spark, dst=((1, 601.0, 800.0, 90),)) == "P P F F P P P"
    assert checked(spark, dst=((1, 600.0, 800.0, 0), (2, 600.0, 800.0, 0))) == "P F S S P P P"
    assert checked(spark, toc=()) == "P P P P S P P"
    assert checked(spark, new=((0, 1, 2, "译"),)) == checked(spark, new=((0, 1, 1, "A"),)) == checked(spark, new=()) == "P P P P F P P"
    assert checked(spark, zh=((1, " "),)) == checked(spark, zh=()) == "P P P P P F P"
    # numbers, single signs, passed units and small type are no titles
    assert checked(spark, units=((1, 1, 20.0, "12 %", False), (2, 1, 20.0, "x", False), (3, 1, 20.0, "Title", True), (4, 1, 11.0, "Text", None))) == "P P P P P S P"
    assert checked(spark, fonts=(("F", True), ("G", False))) == "P P P P P P F"


def test_broken_characters_keep_pairs_out_of_the_checks(spark):
    pairs = spark.createDataFrame([(str(k), 0, k, 1, "The same sentence here 42", t, "text", False) for k, t in enumerate(["译一 42", "译二 42", "译☠ 9", "译☠ 8"])], "id string, doc long, ln long, page long, src string, tgt string, layer string, passthrough boolean")
    evidence = spark.createDataFrame([("☠", "broken"), ("é", "benign")], "ch string, verdict string")
    terms = spark.createDataFrame([("sentence here", "句")], "en string, zh string")
    got = {r["section"]: r["n"] for r in audit.text_audit(pairs, evidence, terms).collect()}
    assert got["pairs"] == 4 and got["broken characters"] == 1 and got["pairs with broken characters"] == 2
    assert got["repeats translated differently"] == 1 and got["numbers lost"] == 0 and got["terms against the glossary"] == 1
    assert audit.numbers(pairs).count() == 2 and audit.clean_pairs(pairs, evidence.where("verdict = 'broken'")).count() == 2


def test_glyphs_outside_of_their_codes_are_broken(spark):
    texts = spark.createDataFrame([(1, 0, "aé"), (2, 3, "üﬁé")], "page long, ln long, text string")
    glyphs = spark.createDataFrame([(1, "F", "é", 5), (2, "F", "é", 99), (2, "G", "ü", 5)], "page long, font string, ch string, gid long")
    spans = spark.createDataFrame([("F", 0, 3), ("F", 4, 9), ("F", 2, 3), ("G", 0, 5)], "font string, lo long, hi long")
    got = {r["ch"]: (r["n"], r["n_outside"], r["n_traced"], r["verdict"], r["codes"]) for r in audit.charset_evidence(texts, spark.createDataFrame([(1, "a")], "page long, text string"), glyphs, spans).collect()}
    assert got == {"é": (2, 1, 2, "broken", "5,99"), "ü": (1, 0, 1, "benign", "5"), "ﬁ": (1, 0, 0, "benign", "")}
    assert sorted((r["font"], r["lo"], r["hi"]) for r in audit.merged_spans(spans).collect()) == [("F", 0, 9), ("G", 0, 5)]


def test_text_audit_counts_its_parts(spark):
    got = {r["section"]: r["n"] for r in R.text_audit(spark, SF).collect()}
    pairs, evidence = R._pairs(spark, SF), R.charset_evidence(spark, SF)
    assert got["pairs"] == audit.with_status(pairs).count() and got["broken characters"] == evidence.where("verdict = 'broken'").count()
    clean = audit.clean_pairs(pairs, evidence.where("verdict = 'broken'"))
    assert got["pairs with broken characters"] == pairs.count() - clean.count() and got["repeats translated differently"] == audit.repeats(clean).count()


def test_text_audit_joins_no_pairs_by_id(spark):
    """Each pair is judged by its own row, and sections share passes: the glossary's is the only join."""
    pairs = spark.createDataFrame([("0", 0, 0, 1, "Not a sentence 42", "译 ☠", "text", False)], "id string, doc long, ln long, page long, src string, tgt string, layer string, passthrough boolean")
    evidence = spark.createDataFrame([("☠", "broken")], "ch string, verdict string")
    df = audit.text_audit(pairs, evidence, spark.createDataFrame([("word", "句")], "en string, zh string"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("LogicalRDD") == 7  # six passes over pairs, one over terms
    assert [(r["ord"], r["n"]) for r in sorted(df.collect())] == [(0, 1), (1, 1), (2, 1), (3, 0), (4, 0), (5, 0), (6, 0), (7, 0), (8, 0), (9, 1)]


def test_few_and_many_signs_are_found(spark):
    texts = spark.createDataFrame([(0, "a😀"), (1, "ab"), (2, ""), (3, None), (4, "x☠")], "k int, t string")
    for signs in ("😀☠", "😀☠" + "".join(map(chr, range(0x4E00, 0x4E40)))):
        assert sorted(r["k"] for r in texts.where(T.holds(F.col("t"), signs)).collect()) == [0, 4]
    assert texts.where(T.holds(F.col("t"), "")).isEmpty()
    assert audit.unexpected_signs(texts.select(F.col("t").alias("text")), spark.createDataFrame([("abx",)], "text string")) == "☠😀"


def test_bilingual_pairs_are_those_of_the_status(spark):
    texts = ["", " ", "12 %", "Some words", "some  Words", "Some\u00a0words", "译 Some words", None]
    rows = [(i, s, t, p) for i, (s, t, p) in enumerate((s, t, p) for s in texts for t in texts for p in (True, False, None))]
    pairs = spark.createDataFrame(rows, "id int, src string, tgt string, passthrough boolean")
    want = audit.with_status(pairs).where("status IN ('translated', 'same')")
    assert sorted(r["id"] for r in audit.bilingual(pairs).collect()) == sorted(r["id"] for r in want.collect()) != []


def test_report_counts_the_rows_of_its_audits(spark):
    rows = {r["section"]: r for r in R.quality_report(spark, SF).collect()}
    assert [r["section"] for r in sorted(rows.values(), key=lambda r: r["ord"])] == ["source", "structure", "text", "sample", "drift", "visual", "residue"]
    for section, df, bad in (("source", R.guard_diff(spark, SF), "result = 'FAIL'"), ("structure", R._checks(spark, SF), "status = 'FAIL'"), ("drift", R.backtrans_verdict(spark, SF), "verdict = 'flag'"), ("residue", R.residue_verdict(spark, SF), "verdict = 'real'")):
        assert (rows[section]["n"], rows[section]["n_bad"]) == (df.count(), df.where(bad).count()), section
    nothing = {r["section"]: (r["verdict"], r["todo"]) for r in structure.quality_report(spark).collect()}
    assert nothing["source"] == ("unchecked", True) and nothing["drift"] == ("not run", False)
    assert R.report_lines(spark, SF).count() == 9


def test_single_lines_take_the_rest_of_their_height(spark):
    ddl = "page long, ln long, x0 double, y0 double, x1 double, y1 double, text string, baseline double, size double, lineheight double, nlines int, font string, passthrough boolean"
    units = spark.createDataFrame([(1, 0, 0.0, 0.0, 100.0, 10.0, "one", 8.0, 10.0, None, 1, "F", False), (1, 1, 0.0, 13.0, 100.0, 23.0, "two", 21.0, 10.0, None, 2, "F", False), (1, 2, 0.0, 100.0, 100.0, 110.0, "3", 108.0, 10.0, None, 1, "F", True)], ddl)
    zh = spark.createDataFrame([(1, 0, "一"), (1, 2, "x")], "page long, ln long, zh string")
    pages = spark.createDataFrame([(1, 800.0)], "page long, height double")
    got = rebuild.rebuilt_boxes(units, zh, spark.createDataFrame([], "size double, ratio double, k double"), pages).collect()
    # the box reaches to 1.5 above the next one, the line needs 13.5 of which 2 lack
    assert len(got) == 1 and got[0]["filled"] and got[0]["y1"] - got[0]["y0"] == pytest.approx(13.5) and got[0]["scale"] == 1.0
    assert [r["ln"] for r in rebuild.untranslated(units, zh).collect()] == [1]


def test_masks_and_flags(spark):
    a, b, m = [10.0] * 4, [10.0, 20.0, 10.0, 250.0], [False, False, False, True]
    df = spark.createDataFrame([(1, a, b, m), (2, a, b, None), (3, a, None, m)], "k int, a array<double>, b array<double>, m array<boolean>")
    got = {r["k"]: r["e"] for r in df.select("k", kernels.abs_error("a", "b", "m").alias("e")).collect()}
    assert got[1]["mean"] == pytest.approx(10 / 3 / 255) and got[1]["share"] == pytest.approx(1 / 3) and got[2]["share"] == 0.5 and got[3]["mean"] is None
    pages = spark.createDataFrame([(p, 1 - p / 1000, 0.0, 0.0, 1.0) for p in range(40)], "page long, ssim double, ae_mean double, ae_share double, iou double")
    flags = visual.flagged(pages)
    assert flags.where("flag_ssim").count() == 3 and flags.where("flag_ae OR warn_ae OR flag_iou").count() == 0
    assert [r["page"] for r in visual.worst_pages(flags).collect()] == [39, 38, 37, 36, 35]
    opaque = spark.range(1).select(rebuild.alpha_mean(F.array(F.lit(0), F.lit(255))).alias("a"), rebuild.alpha_mean(F.lit(None).cast("array<int>")).alias("n")).first()
    assert (opaque["a"], opaque["n"]) == (0.5, 1.0)


def test_upright_texts_that_the_scan_has_are_not_new(spark):
    box = lambda k, t: (1, k, t, 0.0, 100.0 * k, 20.0, 100.0 * k + 60)
    found = spark.createDataFrame([box(0, "Annual report"), box(1, "annual"), box(2, "Other words"), box(3, "In the plan"), (1, 4, "A flat one", 0.0, 0.0, 90.0, 20.0), box(5, "12 34 56")], "page long, ln long, text string, x0 double, y0 double, x1 double, y1 double")
    scope_ = spark.createDataFrame([(1, "the annual  report of"), (1, "Othe"), (2, "Other words")], "page long, text string")
    planned = spark.createDataFrame([(1, "in THE plan")], "page long, text string")
    assert [r["text"] for r in worklist.vertical_new(found, scope_, planned).collect()] == ["Other words"]


def test_probe_counts_full_pages(spark):
    pages = spark.createDataFrame([("d", 1, 10, 100.0), ("d", 2, 10, 100.0)], "document string, page long, chars long, area double")
    images = spark.createDataFrame([("d", 1, 80.0), ("d", 1, 5.0), ("d", 2, 79.0)], "document string, page long, area double")
    r = scope.probe(pages, images).first()
    assert (r["n_images"], r["n_full"], r["route"]) == (3, 1, "ocr")


def test_colours_and_skew_of_rasters():
    page = np.full((600, 600, 3), 240, np.uint8)
    page[10:600:40] = (20, 30, 40)
    assert kernels.modal_color(page) == ((240, 240, 240), (16, 24, 40))
    assert kernels.skew_of(page.mean(axis=2)) == 0.0
