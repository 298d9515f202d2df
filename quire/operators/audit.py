"""Audits of source and target texts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.config import DEFAULT, Config
from quire.functions import text as T
from quire.operators.fold import merge_variants
from quire.plans.shared import cut, global_rank


def status(keep: Column) -> Column:
    """kept, empty, unchanged, same or translated, the first that holds."""
    src, tgt = F.col("src"), F.col("tgt")
    return (
        F.when(F.col("passthrough") | keep | src.rlike(T.NUMERIC), "kept")
        .when(F.trim(tgt) == "", "empty")
        .when(~tgt.rlike(T.CJK_WIDE) & (T.norm_ws(src) == T.norm_ws(tgt)), "unchanged")
        .when(T.norm_ws(src) == T.norm_ws(tgt), "same")
        .otherwise("translated")
    )


def with_status(pairs: DataFrame, keep: Column | None = None) -> DataFrame:
    return pairs.where(F.trim("src") != "").withColumn("status", status(F.lit(False) if keep is None else keep))


def bilingual(pairs: DataFrame) -> DataFrame:
    """Pairs whose status is translated or same, without telling the two apart: few need their texts compared."""
    src, tgt = F.col("src"), F.col("tgt")
    no = lambda rule: ~F.coalesce(rule, F.lit(False))
    rows = pairs.where((F.trim(src) != "") & no(F.trim(tgt) == "") & no(F.col("passthrough") | src.rlike(T.NUMERIC)))
    return rows.where(no(~tgt.rlike(T.CJK_WIDE) & (T.norm_ws(src) == T.norm_ws(tgt))))


def coverage(pairs: DataFrame) -> DataFrame:
    """By layer: translated among translated and unchanged; 100 where there are none."""
    per = with_status(pairs).groupBy("layer").agg(F.count_if(F.col("status") == "translated").alias("n_translated"), F.count_if(F.col("status") == "unchanged").alias("n_unchanged"))
    both = F.col("n_translated") + F.col("n_unchanged")
    return per.withColumn("coverage", F.when(both == 0, 100.0).otherwise(F.bround(100 * F.col("n_translated") / both, 2)))


def repeats(pairs: DataFrame, least: int = 8) -> DataFrame:
    """Source texts that occur twice and more: number of pairs and of different targets."""
    rows = bilingual(pairs.where((F.length("src") >= least) & F.col("src").rlike(r"(?U)\S"))).select(T.norm_ws(F.col("src")).alias("key"), "tgt")
    per = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("tgt").alias("n_variants"))
    return per.where("n >= 2 AND n_variants > 1")


def repeat_variants(pairs: DataFrame, least: int = 8) -> DataFrame:
    """Repeated source texts whose targets still differ when a target within another counts as the longer one."""
    rows = with_status(pairs).where(F.col("status").isin("translated", "same") & (F.length("src") >= least)).withColumn("key", T.norm_ws(F.col("src")))
    per = rows.where("key <> ''").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.collect_set("tgt").alias("variants")).where("n >= 2 AND size(variants) > 1")
    return per.select("key", "n", merge_variants(F.col("variants")).alias("variants")).where("size(variants) >= 2")


def proper_nouns(pairs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Terms of min_occurrences source blocks and more, without those of an empty target: kept rate and policy."""
    terms = pairs.where(F.col("src").rlike(T.MAYBE_PROPER)).select(F.explode(T.proper_nouns(F.col("src"))).alias("term"), "tgt")
    per = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n_all"), F.count_if(F.trim("tgt") != "").alias("n"), F.count_if((F.trim("tgt") != "") & F.contains("tgt", "term")).alias("n_kept"))
    per = per.where((F.col("n_all") >= cfg.min_occurrences) & (F.col("n") >= cfg.min_occurrences))
    policy = F.when(F.col("n_kept") == F.col("n"), "kept").when(F.col("n_kept") == 0, "translated").otherwise("policy-mixed")
    return per.select("term", "n", "n_kept", F.bround(F.col("n_kept") / F.col("n"), 4).alias("kept_rate"), policy.alias("policy"))


def paren_evidence(pairs: DataFrame) -> DataFrame:
    bracketed = pairs.where(F.contains("tgt", F.lit("(")) | F.contains("tgt", F.lit("（")))
    return bracketed.select(F.explode(T.paren_terms(F.col("tgt"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def numbers(pairs: DataFrame, broken: DataFrame | None = None) -> DataFrame:
    """Pairs whose target lacks numbers of the source: id, missing (joined), kind. broken: (id) of pairs to leave out."""
    rows = pairs if broken is None else pairs.join(broken.select("id"), "id", "left_anti")
    rows = rows.where(F.col("src").rlike("[0-9]"))  # without a digit nothing can be missing
    rows = T.settled(rows, {"__src": T.num_runs(F.col("src")), "__tgt": T.num_runs(F.col("tgt"), every=True)})
    rows = T.settled(rows, {"missing": T.num_missing(F.col("__src"), F.col("__tgt"))}).where(F.size("missing") > 0)
    return rows.select("id", F.array_join("missing", " ").alias("missing"), T.classify_number(F.col("missing"), F.col("src"), F.col("tgt")).alias("kind"))


def _denied() -> tuple[Column, Column]:
    """Whether the source denies, outright or by the way, and the target shows no sign of it."""
    src, tgt = F.col("src"), F.col("tgt")
    return src.rlike(T.NEGATION) & ~tgt.rlike(T.CJK_NEGATION), src.rlike(T.IMPLICIT_NEGATION) & ~tgt.rlike(T.CJK_EXCLUSION)


def negations(pairs: DataFrame) -> DataFrame:
    """Translated pairs whose source denies and whose target shows no sign of it: doc, ln, n, implicit."""
    explicit, implicit = _denied()
    # Few texts deny anything: their status comes last.
    rows = with_status(pairs.where(explicit | implicit)).where("status = 'translated'")
    return rows.select("doc", "ln", F.when(explicit, T.negations(F.col("src"))).otherwise(0).cast("long").alias("n_negations"), implicit.alias("implicit"))


def characters(texts: DataFrame) -> DataFrame:
    return texts.select("page", F.explode(F.split("text", "")).alias("ch")).where("ch <> ''")


def distinct_characters(texts: DataFrame) -> DataFrame:
    """(ch) the characters of all texts; a task sends each of its own once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[str] = set()
        for b in batches:
            found.update(*(t for t in b.column(0).to_pylist() if t))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["ch"])

    return texts.select("text").mapInArrow(run, "ch string").distinct()


def unexpected_signs(texts: DataFrame, intended: DataFrame) -> str:
    """The characters of texts that no intended text holds, as one string: the alphabet bounds it."""
    return "".join(sorted(r["ch"] for r in distinct_characters(texts).join(distinct_characters(intended), "ch", "left_anti").collect()))


def unexpected_characters(texts: DataFrame, intended: DataFrame) -> DataFrame:
    """Characters that no intended text holds: code point, number, pages, whether they are known to be harmless."""
    wanted = characters(intended).select("ch").distinct()
    rows = characters(texts).groupBy("ch", "page").agg(F.count(F.lit(1)).alias("n")).join(wanted, "ch", "left_anti")
    out = rows.groupBy("ch").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_pages"))
    return out.select(F.conv(F.hex(F.encode("ch", "utf-32")), 16, 10).cast("long").alias("code"), "n", "n_pages", F.col("ch").isin(*T.BENIGN).alias("benign"))


def contiguous(codes: DataFrame) -> DataFrame:
    """Whether distinct code points form one range."""
    one = codes.agg(F.min("code").alias("low"), F.max("code").alias("high"), F.countDistinct("code").alias("n"))
    return one.withColumn("contiguous", F.col("high") - F.col("low") + 1 == F.col("n"))


def merged_spans(spans: DataFrame) -> DataFrame:
    """Spans (font, lo, hi) that overlap or touch as one: what is left doesn't overlap."""
    order = Window.partitionBy("font").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.distinct().withColumn("new", F.coalesce(F.col("lo") > before + 1, F.lit(True)).cast("int"))
    numbered = marked.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("font", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


def covered_glyphs(glyphs: DataFrame, spans: DataFrame) -> DataFrame:
    """(font, gid, ...) glyphs with whether a span of their font holds them, in a sweep over both in order of code."""
    both = glyphs.withColumns({"__at": F.col("gid"), "__hi": F.lit(None).cast("long")}).unionByName(merged_spans(spans).select("font", F.col("lo").cast("long").alias("__at"), F.col("hi").cast("long").alias("__hi")), allowMissingColumns=True)
    # Of the spans that begin at a code or before it, the last one ends furthest: spans don't overlap.
    order = Window.partitionBy("font").orderBy("__at", F.col("__hi").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("__end", F.last("__hi", ignorenulls=True).over(order)).where("gid IS NOT NULL")
    return swept.withColumn("covered", F.coalesce(F.col("gid") <= F.col("__end"), F.lit(False))).drop("__at", "__hi", "__end")


def outside_spans(glyphs: DataFrame, spans: DataFrame) -> DataFrame:
    """(font, gid) glyphs against (font, lo, hi) code spans: by font, glyphs and those within no span."""
    return covered_glyphs(glyphs, spans).groupBy("font").agg(F.count(F.lit(1)).alias("n_glyphs"), F.count_if(~F.col("covered")).alias("n_outside"))


def charset_evidence(texts: DataFrame, intended: DataFrame, glyphs: DataFrame, spans: DataFrame) -> DataFrame:
    """Unexpected characters with what tells harmless from broken ones, and the verdict.

    texts: (page, ln, text) of the product; intended: (page, text); glyphs: (page, font, ch, gid), one row for each glyph
    drawn; spans: (font, lo, hi) codes that each font maps. A character drawn by a glyph outside of its font's codes is
    broken, one that is drawn inside only is benign, one that isn't drawn is benign if it is known to be.
    """
    wanted = characters(intended).select("ch").distinct()
    rows = texts.select("page", "ln", F.trim("text").alias("text"), F.explode(F.split("text", "")).alias("ch")).where(~F.col("ch").rlike(r"^(?U)\s?$")).join(wanted, "ch", "left_anti")
    per_line = rows.groupBy("ch", "page", "ln").agg(F.count(F.lit(1)).alias("n"), F.min(F.substring("text", 1, 70)).alias("text"))
    # Samples are kept in bounded arrays: ten pages, two examples, six codes.
    first = lambda c, k: F.slice(F.array_sort(F.collect_set(c)), 1, k)
    pages = per_line.select("ch", "page").distinct()
    few = pages.withColumn("k", F.row_number().over(Window.partitionBy("ch").orderBy("page"))).where("k <= 10").groupBy("ch").agg(F.array_sort(F.collect_list("page")).alias("pages"))
    shown = per_line.withColumn("k", F.row_number().over(Window.partitionBy("ch").orderBy("page", "ln"))).where("k <= 2").groupBy("ch").agg(F.array_sort(F.collect_list(F.struct("page", "ln", "text"))).alias("examples"))
    counts = per_line.groupBy("ch").agg(F.sum("n").alias("n"))
    drawn = glyphs.groupBy("ch", "font", "gid").agg(F.count(F.lit(1)).alias("k")).join(counts.select("ch"), "ch", "left_semi")
    traced = covered_glyphs(drawn, spans).groupBy("ch").agg(first("font", 1000).alias("fonts"), first("gid", 6).alias("codes"), F.sum(F.when(~F.col("covered"), F.col("k")).otherwise(0)).alias("n_outside"), F.sum("k").alias("n_traced"))
    out = counts.join(few, "ch").join(shown, "ch").join(traced, "ch", "left")
    outside, found = F.coalesce("n_outside", F.lit(0)), F.coalesce("n_traced", F.lit(0))
    verdict = F.when(outside > 0, "broken").when(found > 0, "benign").when(F.col("ch").isin(*T.BENIGN), "benign").otherwise("broken")
    code = F.conv(F.hex(F.encode("ch", "utf-32")), 16, 10).cast("long")
    joined = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return out.select("ch", code.alias("code"), "n", joined("pages").alias("pages"), F.array_join(F.transform("examples", lambda e: F.concat_ws(":", e["page"], e["ln"], e["text"])), " / ").alias("examples"), joined("fonts").alias("fonts"), joined("codes").alias("codes"), outside.alias("n_outside"), found.alias("n_traced"), verdict.alias("verdict"))


def source_items(units: DataFrame, blocks: DataFrame) -> DataFrame:
    """Both layers as one table: text units (id, page, ln, text, passthrough) and blocks (page, ln, text, conf) of images."""
    text = units.select("id", "page", "ln", F.lit("text").alias("layer"), F.col("text").alias("src"), F.coalesce("passthrough", F.lit(False)).alias("passthrough"), F.lit(None).cast("double").alias("conf"))
    # The ordinal counts all image blocks in order of page and place.
    l2 = global_rank(blocks.select("page", "ln", "text", "conf"), "__k", F.col("page"), F.col("ln"))
    l2 = l2.select(F.concat_ws(":", F.lit("l2"), "page", F.col("__k") - 1).alias("id"), "page", "ln", F.lit("l2").alias("layer"), F.col("text").alias("src"), F.lit(False).alias("passthrough"), F.col("conf").cast("double"))
    return text.unionByName(l2)


def clean_pairs(pairs: DataFrame, broken: DataFrame) -> DataFrame:
    """Pairs (id, tgt, ...) without the (ch) broken characters in their target."""
    return pairs.join(broken_pairs(pairs, broken), "id", "left_anti")


def broken_pairs(pairs: DataFrame, broken: DataFrame) -> DataFrame:
    """Ids of the pairs whose target holds a broken character."""
    chars = pairs.select("id", F.explode(F.array_distinct(F.split("tgt", ""))).alias("ch"))
    return chars.join(broken.select("ch"), "ch", "left_semi").select("id").distinct()


def text_audit(pairs: DataFrame, evidence: DataFrame, terms: DataFrame) -> DataFrame:
    """The audit in order: section, and number of findings; consistency checks see clean pairs only.

    pairs: id (one row each), doc, ln, page, src, tgt, layer, passthrough; evidence: of charset_evidence(); terms: (en, zh).
    """
    # Broken characters are few, as the alphabet bounds them: each pair is judged by its own row, without a join.
    broken = [r["ch"] for r in evidence.where("verdict = 'broken'").select("ch").collect()]
    # Texts are bound once: the tests of a pass would each evaluate what makes them.
    pairs = T.settled(pairs, {"__src": F.col("src"), "__tgt": F.col("tgt")}).drop("src", "tgt").withColumnsRenamed({"__src": "src", "__tgt": "tgt"})
    dirty = T.holds(F.col("tgt"), "".join(broken))
    clean = pairs.where(~dirty)
    count = lambda rows: rows.agg(F.count(F.lit(1)))
    explicit, implicit = _denied()
    lost = (explicit | implicit) & (F.trim("src") != "") & (status(F.lit(False)) == "translated")
    # One pass for each entry: its sections by place, and a row of their numbers.
    passes = [
        ({0: "pairs", 1: "broken characters", 2: "pairs with broken characters", 9: "negations lost"}, pairs.agg(F.count_if(F.trim("src") != ""), F.lit(len(broken)).cast("long"), F.count_if(dirty), F.count_if(lost))),
        ({3: "repeats translated differently"}, count(repeats(clean))),
        ({4: "proper nouns of mixed policy"}, count(proper_nouns(clean).where("policy = 'policy-mixed'"))),
        ({5: "terms in brackets"}, count(paren_evidence(clean))),
        ({6: "numbers lost", 7: "numbers explained"}, numbers(clean).agg(F.count_if(F.col("kind") == "check"), F.count_if(F.col("kind") != "check"))),
        ({8: "terms against the glossary"}, count(_violations(bilingual(pairs), terms).where("n_violations > 0"))),
    ]
    out = []
    for sections, numbered in passes:
        row = numbered.toDF(*(f"n{k}" for k in sections))
        out.append(row.select(F.inline(F.array(*[F.struct(F.lit(k).alias("ord"), F.lit(name).alias("section"), F.col(f"n{k}").alias("n")) for k, name in sections.items()]))))
    return reduce(DataFrame.unionByName, out)


def _occurrences(pairs: DataFrame, terms: DataFrame) -> DataFrame:
    """Pairs joined with terms that stand in their source between word borders, in any case.

    They meet by the first word of the term, not by testing all terms on all texts; terms of more than that word are then
    looked for whole. Terms without letters, digits or underscores meet no pair.
    """
    word, fixed = r"[\p{L}\p{M}\p{N}_]+", F.replace("en", F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    found = pairs.select("id", "src", "tgt", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("src"), F.lit(word), F.lit(0)))).alias("w"))
    keyed = terms.withColumn("w", F.regexp_extract(F.lower("en"), word, 0)).where("w <> ''")
    whole = keyed.withColumn("phrase", F.concat(F.lit(r"(?iuU)\b\Q"), fixed, F.lit(r"\E\b")))
    return found.join(whole, "w").where((F.col("w") == F.lower("en")) | F.rlike("src", F.col("phrase"))).drop("phrase")


def _bilingual(pairs: DataFrame) -> DataFrame:
    """Pairs with a translation, as far as a status tells."""
    return pairs.where(F.col("status").isin("translated", "same"))


def glossary_violations(pairs: DataFrame, terms: DataFrame) -> DataFrame:
    """By term (en, zh): translated or same pairs with the term in the source, and those with neither form in the target.

    Terms without a zh form are checked by no pair.
    """
    return _violations(_bilingual(pairs), terms)


def _violations(pairs: DataFrame, terms: DataFrame) -> DataFrame:
    hit = _occurrences(pairs, terms.where("en <> '' AND zh <> ''"))
    bad = ~F.contains("tgt", "zh") & ~F.contains(F.lower("tgt"), F.lower("en"))
    return hit.groupBy("en").agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("n_violations"))


def glossary_freeze(pairs: DataFrame, terms: DataFrame) -> DataFrame:
    """Candidates (en, zh, verdict) that occur, settled by their targets: en, zh, n_targets, keep and needs_ruling.

    A term without zh is kept if all its targets hold it, takes the words before the bracket where brackets propose it
    and all targets are one, and needs a ruling otherwise.
    """
    per = _occurrences(_bilingual(pairs), terms.where(F.trim("en") != "")).groupBy("en", "zh", "verdict").agg(F.countDistinct("tgt").alias("n_targets"), F.min("tgt").alias("tgt"), F.min(F.contains(F.lower("tgt"), F.lower("en"))).alias("held"))
    given, inside = F.trim(F.coalesce("zh", F.lit(""))), T.before_paren(F.col("tgt"))
    found = F.when((given == "") & (F.col("n_targets") == 1) & (F.col("verdict") == "paren") & (inside != F.col("en")), inside).otherwise(given)
    per = per.withColumn("zh", found)
    open_ = F.col("zh") == ""
    return per.select("en", "zh", "n_targets", F.when(open_ & F.col("held"), True).otherwise(F.col("verdict") == "kept").alias("keep"), (open_ & ~F.col("held")).alias("needs_ruling"))


def frozen(terms: DataFrame) -> DataFrame:
    """One row: settled and open terms, and whether the glossary may be frozen."""
    one = terms.agg(F.count_if(~F.col("needs_ruling")).alias("n_settled"), F.count_if("needs_ruling").alias("n_open"))
    return one.withColumn("frozen", F.col("n_open") == 0)


def consistent(glossary: DataFrame, proposals: DataFrame) -> DataFrame:
    """(en, zh) for every term: the frozen form wins, else the longest proposed one; empty keys and forms are skipped."""
    key = F.lower(F.trim("en"))
    best = proposals.withColumn("key", key).where("key <> '' AND trim(zh) <> ''").groupBy("key").agg(F.max(F.struct(F.length("zh").alias("n"), "zh", "en")).alias("m"))
    fixed = glossary.withColumn("key", key).where("key <> '' AND trim(zh) <> ''").groupBy("key").agg(F.min(F.struct("en", "zh")).alias("f"))
    both = best.join(fixed, "key", "full_outer")
    return both.select(F.coalesce("f.en", "m.en").alias("en"), F.coalesce("f.zh", "m.zh").alias("zh"), F.col("f").isNotNull().alias("fixed"), F.coalesce(F.col("f.zh") != F.col("m.zh"), F.lit(False)).alias("differs"))


def glossary_proposal(policies: DataFrame, evidence: DataFrame) -> DataFrame:
    """Terms of mixed or translated policy, and terms in brackets that aren't among them."""
    first = policies.where(F.col("policy") != "kept").select(F.col("term").alias("en"), F.lit("term").alias("origin"))
    more = evidence.select(F.col("term").alias("en"), F.lower("term").alias("k")).join(first.select(F.lower("en").alias("k")), "k", "left_anti")
    return first.unionByName(more.select("en", F.lit("brackets").alias("origin")))
