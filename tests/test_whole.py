"""Whole texts and whole jobs: what a cut would lose."""

import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quire.operators import audit, sampling, tracing

QUERIES = entry.queries()
HEAD = "The quick brown model reads one more line of the page and goes on for long enough to pass any cut of it"


def tail(ln):
    """Words that differ from line to line, without digits."""
    found = hashlib.md5(str(ln).encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop"))
    return " ".join(found[i : i + 8] for i in range(0, 32, 8)) + " end"


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Two folders of documents that differ only after the first hundred characters of each line."""
    out = []
    for name, line in (("short", lambda k: HEAD), ("long", lambda k: f"{HEAD} {tail(k)}")):
        d = tmp_path_factory.mktemp(name)
        rows = [(i, "\n".join(line(k) for k in range(40)), "en", "a", 0) for i in range(3)]
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
        out.append(str(d))
    return out


def test_pieces_hold_all_characters(spark):
    """Pieces of lines leave out nothing but blanks."""
    from quire.plans.views import frags, lines

    sf = "/root/testdata/sf0.001"
    bare = F.sum(F.length(F.regexp_replace("text", " ", ""))).alias("n")
    whole, cut = (df.agg(bare, F.max(F.length("text")).alias("longest")).first() for df in (lines(spark, sf), frags(spark, sf)))
    assert whole["n"] == cut["n"] and cut["longest"] <= 67 < whole["longest"]
    assert frags(spark, sf).groupBy("page", "ln").count().where("count > 1").isEmpty()


def test_pieces_of_long_lines(spark, tmp_path):
    """Consecutive characters, those outside of the basic plane and other line ends too; blank lines count."""
    from quire.plans.views import frags

    text = "\n".join(["x" * 20000 + "é😀 \r\u2028" * 3000, "", "end"])
    spark.createDataFrame([(0, text, "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["ln"]: r["text"] for r in frags(spark, str(tmp_path)).collect()}
    lines = text.split("\n")
    want = [line[k : k + 8 + 3 * j] for j, line in enumerate(lines) for k in range(0, max(1, len(line)), 8 + 3 * j)]
    assert got == {ln: piece.strip(" ") for ln, piece in enumerate(want) if piece.strip(" ")}


@pytest.mark.parametrize("name", ["units_extract", "plan_build", "repeat_variants", "residue_dedup", "rect_iou_match", "qc_best_reading", "qc_duplicate_readings", "scope_summary", "pair_status", "residue_classes", "room_below", "coverage_by_layer"])
def test_ends_of_lines_count(spark, folders, name):
    short, long = (sorted(map(repr, QUERIES[name](spark, d).collect())) for d in folders)
    assert short != long


def test_units_hold_whole_lines(spark, folders):
    found = " ".join(r["text"] for r in QUERIES["units_extract"](spark, folders[1]).where("page = 1").collect())
    assert all(f"{HEAD} {tail(k)}" in found for k in range(40))


def test_risk_counts_ratio_anomalies(spark):
    """Pages 1 and 2 have a target cut short and one blown up; the other parts are the same on all pages."""
    rows = [(p, "s" * 40, "t" * (9 if p == 1 else 200 if p == 2 else 40), "translated") for p in range(1, 41)]
    rows += [(3, "s" * 19, "t" * 400, "translated"), (3, "s" * 40, "t" * 400, "kept")]
    found = sampling.ratio_anomalies(spark.createDataFrame(rows, "page long, src string, tgt string, status string"), 0.05, 0.95)
    # sorted[int(40 * 0.05)] is the third smallest ratio, sorted[int(40 * 0.95)] the second largest
    assert {r["page"]: r["anomalies"] for r in found.collect()} == {1: 1, 2: 1}
    pages = spark.createDataFrame([(p, 10, 1, 1, 5.0, 1, 0) for p in range(1, 41)], "page long, chars long, l2 long, small long, title double, digits long, negations long")
    risks = {r["page"]: r["risk"] for r in sampling.risk(pages, found).collect()}
    assert risks == {p: 4.0 if p in (1, 2) else 2.0 for p in range(1, 41)}


def test_residue_contains_or_is_contained(spark):
    texts = {1: "northern harbour", 2: "the northern harbour office", 3: "harb", 4: "quite another thing", 5: "known unknown"}
    product = spark.createDataFrame([(1, k, t, 0.9, 0.0, 20.0 * k, 9.0, 20.0 * k + 9) for k, t in texts.items()], "page long, ln long, text string, conf double, x0 double, y0 double, x1 double, y1 double")
    source = spark.createDataFrame([(1, "Northern Harbour"), (1, "thin"), (2, "quite another thing")], "page long, text string")
    words = spark.createDataFrame([(1, "known"), (2, "quite")], "page long, word string")
    found = tracing.residue(product, product.where("false"), words, product.where("false"), source)
    assert {r["ln"]: r["cls"] for r in found.collect()} == {1: "filtered", 2: "filtered", 3: "filtered", 4: "unseen", 5: "textlayer"}


def test_glossary_terms_of_many_words(spark):
    pairs = spark.createDataFrame([
        (0, "The Northern Harbour Group", "unchanged", "unchanged"),
        (1, "The Northern Harbour Group and its model", "译名 模型", "translated"),
        (2, "the northern harbour group", "北港集团", "same"),
        (3, "the northern harbour groups, north", "其他", "translated"),
        (4, "AT&T and U.S.A with state-of-the-art", "其他", "translated"),
        (5, "état-major et c++ \\E end", "其他", "translated"),
    ], "id long, src string, tgt string, status string")
    terms = spark.createDataFrame([("Northern Harbour Group", "北港集团"), ("AT&T", "甲"), ("state-of-the-art", "乙"), ("U.S.A", "丙"), ("model", "模型"), ("tat", "丁"), ("état-major", "戊"), ("art AT", "己")], "en string, zh string").withColumn("verdict", F.lit("term"))
    found = {r["en"]: (r["n"], r["n_violations"]) for r in audit.glossary_violations(pairs, terms).collect()}
    assert found == {"Northern Harbour Group": (2, 1), "AT&T": (1, 1), "state-of-the-art": (1, 1), "U.S.A": (1, 1), "model": (1, 0), "état-major": (1, 1)}
    frozen = {r["en"]: (r["n_targets"], r["keep"], r["needs_ruling"]) for r in audit.glossary_freeze(pairs, terms).collect()}
    assert frozen["Northern Harbour Group"] == (2, False, False) and set(frozen) == set(found)
    open_ = terms.withColumn("zh", F.lit(None).cast("string")).withColumn("verdict", F.when(F.col("en") == "AT&T", "kept").otherwise("term"))
    ruled = {r["en"]: (r["keep"], r["needs_ruling"]) for r in audit.glossary_freeze(pairs, open_).collect()}
    assert ruled["Northern Harbour Group"] == (False, True) and ruled["AT&T"] == (True, True)  # one target, and still no form
    held = audit.glossary_freeze(pairs.withColumn("tgt", F.concat("src", F.lit(" 译"))), open_).collect()
    assert all(r["keep"] and not r["needs_ruling"] for r in held)
    paren = pairs.where("id = 3").withColumn("tgt", F.lit("北港（northern harbour）"))
    one = audit.glossary_freeze(paren, spark.createDataFrame([("Northern", "", "paren")], "en string, zh string, verdict string")).first()
    assert (one["zh"], one["needs_ruling"]) == ("北港", False)
