"""Text functions on stated cases."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T


def values(spark, f, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    return [r["v"] for r in df.select("i", f(F.col("t")).alias("v")).orderBy("i").collect()]


def test_normal_forms(spark):
    assert values(spark, T.norm_ws, "A b\t C　d") == ["abcd"]
    assert values(spark, T.norm_alnum, "A-b 3é") == ["ab3"]
    assert values(spark, T.norm_text, "A 中é") == ["a中"]
    assert values(spark, T.norm_ligature, "oﬃce co­op é") == ["office coop é"]


def test_classes(spark):
    assert values(spark, T.classify, "", "2,002", "Q1", "Total net sales now", "Total net sales now.", "x" * 20 + " yy zz ww") == ["skip_numeric", "skip_numeric", "skip_numeric", "sentence", "sentence", "sentence"]
    assert values(spark, T.classify, "Total net sales", "Ends here.") == ["label", "sentence"]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("S1O0", []),
        ("falls,", []),
        ("Q2 and H100", []),
        ("1990s", ["1990"]),
        ("2o26", ["2026"]),
        ("$3", ["3"]),
        ("3 dogs", []),
        ("5%", ["5"]),
        ("Aug. 24, 2026", ["2026", "24"]),
        ("", []),
    ],
)
def test_numbers(spark, text, found):
    assert values(spark, T.num_runs, text) == [found]


def test_numbers_keep_their_neighbours(spark):
    assert values(spark, lambda c: T.currency_runs(c), "$3 $4,5 6") == [["3", "4", "5"]]
    assert values(spark, T.nums, "three of 7") == [["3", "7"]]


def test_years_match_in_two_and_four_digits(spark):
    df = spark.createDataFrame([(["26", "2026", "17"], ["2026"])], "a array<string>, b array<string>")
    assert df.select(T.num_missing(F.col("a"), F.col("b"))).first()[0] == ["17"]
    df = spark.createDataFrame([(["2026"], ["26"])], "a array<string>, b array<string>")
    assert df.select(T.num_missing(F.col("a"), F.col("b"))).first()[0] == []


def test_kinds_of_lost_numbers(spark):
    rows = [("$97.4B", "974 亿美元", ["97", "4"], "unit"), ("Aug 11, 2020", "2020 年 8 月 11 日", ["11"], "date"), ("1?2 or 33", "x", ["33"], "noise"), ("33 cats", "x", ["33"], "check")]
    df = spark.createDataFrame(rows, "s string, t string, m array<string>, kind string")
    for r in df.select("kind", T.classify_number(F.col("m"), F.col("s"), F.col("t")).alias("k")).collect():
        assert r["k"] == r["kind"]


def test_garbage(spark):
    assert values(spark, T.garbage_reasons, "strngthvw", "aaaaaa", "1234567890", "a?? b", "fine text", "rhythmyy") == [["no_vowel"], ["char_repeat"], ["noise_digits"], ["junk_marks"], [], []]


def test_negation_and_polarity(spark):
    assert values(spark, T.polarity, "aren't", "aren’t", "non-normal", "already", "unmatched") == [True, True, True, False, False]
    assert values(spark, T.negations, "not no", "nothing") == [2, 0]


def test_lines_and_cells(spark):
    assert values(spark, T.dedup_lines, "a\n a\n\na\nb") == ["a\na\nb"]
    assert values(spark, T.cell, "a\nb | c", " ") == ["a b \\| c", "—"]
    assert values(spark, T.before_paren, "名称（x）y", "name (x)") == ["名称", "name"]
    assert values(spark, T.structure_words, "图 3.1说明。") == ["Figure 3.1 说明."]


def test_terms(spark):
    assert values(spark, T.paren_terms, "大语言模型（LLM）和 RAG（检索）") == [["llm", "rag"]]
    assert values(spark, T.proper_nouns, "THIS ABCD met GPT-4 at example.org, Acme Widgets Inc.") == [["ABCD", "Acme Widgets Inc", "GPT-4", "example.org"]]
    assert values(spark, T.short_content_words, "the end of it") == [["end"]]


def test_english_predicates(spark):
    assert values(spark, lambda c: T.is_english(c, F.lit(None).cast("double")), "Hello there", "é Hello", "12 a") == [True, False, False]
    assert values(spark, T.clean_english, "Revenue growth", "Rvn grwth xkcd", "12345") == [True, False, False]
    assert values(spark, T.already_translated, "中文", "中文 abc", "abc") == [True, False, False]
    assert values(spark, T.is_ticker, "MSFT", "Msft") == [True, False]


def test_widths_and_colors(spark):
    assert values(spark, T.display_width, "ab中") == [4]
    assert [round(v, 6) for v in values(spark, T.width_em, "ab中")] == [2.12]
    df = spark.createDataFrame([(0x1FF0080,)], "c int")
    assert df.select(T.color_hex(F.col("c"))).first()[0] == "#ff0080"


def test_runs_are_spaced_and_cut(spark):
    """Thin spaces beside letters only, runs cut after each f, larger Latin unless it is most of the text."""
    cases = [("用API做off", 10.0), ("共12个", 10.0), ("（API）与SaaS。", 16.0), ("mostly latin 字", 10.0), ("", 10.0)]
    df = spark.createDataFrame(cases, "t string, s double")
    got = [[(x["run"], x["latin"], x["scale"]) for x in r["r"]] for r in df.select(T.runs_of(F.col("t"), F.col("s")).alias("r")).collect()]
    thin = "\u2009"
    assert got[0] == [("用" + thin, False, 1.0), ("API", True, 1.0), (thin + "做" + thin, False, 1.0), ("of", True, 1.0), ("f", True, 1.0)]
    assert got[1] == [("共", False, 1.0), ("12", True, 1.06), ("个", False, 1.0)]
    assert [x for x, _, _ in got[2]] == ["（", "API", "）与" + thin, "SaaS", "。"] and got[3][0][2] == 1.0 and got[4] == []
    over = df.limit(2).select(T.runs_of(F.concat(F.col("t"), F.lit("-x")), F.lit(10.0), T.OVERLAY_RUN).alias("r")).first()["r"]
    assert [x["run"] for x in over][-2:] == ["-", "x"]
