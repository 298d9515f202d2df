"""Text functions as columns. None of them leaves the JVM but NFC normalisation."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quire.config import DEFAULT, NUMBER_WORDS, STOP_CAPS, STOP_LONG, STOP_SHORT

# Patterns of the rules.
NUMERIC_OR_EMPTY = r"^[\s\d%.,()'’\-–—+/x×$:#°]*$"
NUMERIC = r"^[\s0-9$%¢€£¥.,+\-–—/×x:*()\[\]<>|~='\"#&°]+$"
PAGE_NUMBER = r"^[\s0-9.,:%\-–—/]+$"
WORD = r"[A-Za-z]{2,}"
CJK_NARROW, CJK_WIDE = "[一-鿿]", "[㐀-鿿]"
NUMBER = r"(?<![A-Za-z0-9])[0-9][0-9oOlI,. ]{0,18}"
CODE = r"\b[A-Z][A-Z0-9]{1,5}\b"
MODEL = r"\b[A-Z]{1,4}-?\d{1,4}[A-Za-z]{0,3}\b"
DOMAIN = r"\b[a-z0-9][a-z0-9.\-]*\.(?:com|org|net|ai|io|gov|edu)\b"
COMPANY = r"\b[A-Z][A-Za-z.&]*(?:\s+[A-Z][A-Za-z.&]*){0,3}\s+(?:Inc|Corp|Corporation|Ltd|LLC|Co|Group|Capital|Partners|Technologies|Research)\b"
#: What each text with a code of four signs, a model, a domain or a company holds.
MAYBE_PROPER = r"[A-Z][A-Z0-9]{3}|[A-Z]-?[0-9]|\.(?:com|org|net|ai|io|gov|edu)\b|\s(?:Inc|Corp|Corporation|Ltd|LLC|Co|Group|Capital|Partners|Technologies|Research)\b"
MONTH = r"(?i)\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)\b"
MAGNITUDE = r"(?i)\b\d+(?:\.\d+)?\s*(?:million|billion|trillion|thousand)\b|[$\d]\s*[KMBT]\b"
CJK_MAGNITUDE = "[亿萬万]"
NOISY = r"\d\s*[?？]|[?？]\s*\d"
NEGATION = r"(?i)\b(?:not|no|never|none|neither|nor|cannot|n[o']t)\b"
IMPLICIT_NEGATION = r"(?i)\b(?:except|without|excluding|fail(?:ed|s)? to|lack|absent|free of)\b"
RISK_NEGATION = r"(?i)\b(?:not|no|never|none|neither|nor|cannot|without|except|lack|fail(?:ed|s)? to)\b"
POLARITY = r"(?i)\b(?:not|non|no|never|none|nothing|neither|nor|without|cannot)\b|[A-Za-z]+n['’]t\b|[不没无未非别勿莫]"
CJK_NEGATION, CJK_EXCLUSION = "[不没无未非别勿莫免禁止得]", "[不没无未非别勿莫免禁止得除外]"
CITATION, TICKER = r"(?i)^\s*sources?\b", r"^[A-Z0-9&.\-]{2,6}$"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "­": ""}
BENIGN = tuple(chr(c) for c in range(0xFB00, 0xFB07)) + ("⸺", "⸻", " ")
CURRENCY = "$€£¥"


def norm_ws(c: Column) -> Column:
    # Plain blanks go first, as bytes: few texts hold others.
    return F.lower(F.regexp_replace(F.replace(c, F.lit(" "), F.lit("")), r"(?U)\s+", ""))


def holds(c: Column, signs: str) -> Column:
    """Whether a text holds one of the characters; null counts as empty. Few are looked for one by one."""
    if len(signs) > 32:
        found = F.length(F.translate(c, signs, "")) < F.length(c)
    else:
        found = reduce(Column.__or__, [F.contains(c, F.lit(x)) for x in signs], F.lit(False))
    return F.coalesce(found, F.lit(False))


def norm_alnum(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def norm_text(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9一-鿿]", "")


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def norm_ligature(c: Column) -> Column:
    for sign, plain in LIGATURES.items():
        c = F.replace(c, F.lit(sign), F.lit(plain))
    return _nfc(c)


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def is_numeric(c: Column) -> Column:
    return c.rlike(NUMERIC_OR_EMPTY) | ~c.rlike(WORD)


def classify(c: Column) -> Column:
    """skip_numeric, label (short, few words, no end of a sentence) or sentence."""
    short = (F.length(c) <= 24) & (F.regexp_count(c, F.lit(WORD)) <= 3) & ~c.rlike(r"[.!?]$")
    return F.when(is_numeric(c), "skip_numeric").when(short, "label").otherwise("sentence")


def letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^A-Za-z]", ""))


def is_english(c: Column, conf: Column) -> Column:
    c = F.trim(c)
    return (F.length(c) >= 3) & c.rlike(r"^[\x20-\x7e]*$") & (conf.isNull() | (conf >= 0.5)) & (letters(c) >= 3) & (letters(c) / F.length(c) >= 0.6) & c.rlike(WORD)


def looks_english(c: Column) -> Column:
    return (F.length(c) >= 4) & c.rlike(r"^[\x00-\x7f]*$") & (letters(c) >= 4) & (letters(c) / F.length(c) >= 0.7) & c.rlike(WORD)


def clean_english(c: Column, decoration: str = DEFAULT.decoration) -> Column:
    c = F.trim(c)
    found = F.regexp_extract_all(c, F.lit("[A-Za-z]+"), F.lit(0))
    mute = F.size(F.filter(found, lambda w: (F.length(w) >= 4) & ~w.rlike("[aeiouAEIOU]")))
    sound = mute <= F.greatest(F.lit(1), F.floor(F.size(found) / 4))
    return (F.length(c) >= 5) & c.rlike(r"^[\x00-\x7f]*$") & ~c.rlike(decoration) & ~c.rlike(NUMERIC) & c.rlike("[A-Za-z]{3}") & (letters(c) / F.length(c) >= 0.55) & sound


def plausible(c: Column) -> Column:
    return F.exists(F.regexp_extract_all(c, F.lit("[A-Za-z]{3,}"), F.lit(0)), lambda w: w.rlike("[aeiouyAEIOUY]"))


def garbage_reasons(c: Column) -> Column:
    """noise_digits, char_repeat, junk_marks, no_vowel, as far as they hold, in this order."""
    mute = F.exists(F.regexp_extract_all(c, F.lit(r"\b[A-Za-z]{8,}\b"), F.lit(0)), lambda w: ~w.rlike("[aeiouyAEIOUY]"))
    rules = [("noise_digits", c.rlike(r"\d{10,}")), ("char_repeat", c.rlike(r"(.)\1{5,}")), ("junk_marks", F.regexp_count(c, F.lit(r"\?")) >= 2), ("no_vowel", ~c.rlike(CJK_NARROW) & mute)]
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))


def already_translated(c: Column) -> Column:
    return c.rlike(CJK_NARROW) & ~c.rlike("[A-Za-z]{3,}")


def is_citation(c: Column) -> Column:
    return c.rlike(CITATION)


def is_ticker(c: Column) -> Column:
    return c.rlike(TICKER)


def dedup_lines(c: Column) -> Column:
    """Lines stripped, without blanks and repeats of the line before; a blank line ends the memory."""
    lines = F.transform(F.split(c, "\n"), lambda x: F.trim(x))
    kept = F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), F.when(i > 0, F.get(lines, i - 1)).alias("before"))), lambda s: (s["x"] != "") & (s["before"].isNull() | (s["x"] != s["before"])))
    return F.array_join(F.transform(kept, lambda s: s["x"]), "\n")


def _runs(tokens: Column) -> Column:
    """Digit runs of tokens without leading zeros; look-alike letters count as digits."""
    plain = F.transform(tokens, lambda t: F.translate(t, "oOlI", "0011"))
    parts = F.flatten(F.transform(plain, lambda t: F.split(t, r"[^0-9]+")))
    bare = F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.array_distinct(bare)


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with array columns that lambdas may name without evaluating their expressions for each element again.

    Expressions in lambdas are evaluated for each element: these are bound as fields of one generated row instead.
    """
    one = F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()])))
    return df.select("*", one)


def num_runs(c: Column, every: bool = False) -> Column:
    """Numbers of two digits and more, and one-digit ones beside a currency or percent sign (or every)."""
    all_runs = _runs(F.regexp_extract_all(c, F.lit(NUMBER), F.lit(0)))
    if every:
        return F.array_sort(all_runs)
    near = F.regexp_extract_all(c, F.lit(rf"(?<=[{CURRENCY}%]){NUMBER}|{NUMBER}(?=[{CURRENCY}%])"), F.lit(0))
    return F.array_sort(F.array_union(F.filter(all_runs, lambda r: F.length(r) >= 2), _runs(near)))


def currency_runs(c: Column) -> Column:
    return F.array_sort(_runs(F.regexp_extract_all(c, F.lit(rf"(?<=[{CURRENCY}]){NUMBER}|{NUMBER}(?=[{CURRENCY}])"), F.lit(0))))


def num_match(t: Column, found: Column) -> Column:
    """A year may be written with two digits or four."""
    two = (F.length(t) == 2) & F.array_contains(found, F.concat(F.lit("20"), t))
    four = (F.length(t) == 4) & F.array_contains(found, F.substring(t, 3, 2))
    return F.array_contains(found, t) | two | four


def num_missing(src: Column, found: Column) -> Column:
    return F.array_sort(F.filter(src, lambda t: ~num_match(t, found)))


def nums(c: Column) -> Column:
    """All numbers, those in English words too."""
    table = F.create_map(*[F.lit(x) for pair in NUMBER_WORDS.items() for x in pair])
    # Membership in a literal set is one hash look-up for a word; the map is asked for few.
    spoken = F.transform(F.filter(words(F.lower(c)), lambda w: w.isin(*NUMBER_WORDS)), lambda w: F.try_element_at(table, w))
    return F.array_sort(F.array_union(num_runs(c, every=True), spoken))


def classify_number(missing: Column, src: Column, tgt: Column) -> Column:
    money = F.size(F.array_except(missing, currency_runs(src))) == 0
    months = F.regexp_count(src, F.lit(MONTH))
    return (
        F.when(tgt.rlike(CJK_MAGNITUDE) & (money | src.rlike(MAGNITUDE)), "unit")
        .when((months >= 3) | ((months > 0) & tgt.rlike("[0-9]")), "date")
        .when(src.rlike(NOISY) | F.exists(missing, lambda m: F.length(m) > 10), "noise")
        .otherwise("check")
    )


def content_words(c: Column, stop: tuple[str, ...] = STOP_LONG, least: int = 2) -> Column:
    return F.array_sort(F.array_distinct(F.filter(words(F.lower(c)), lambda w: (F.length(w) >= least) & ~w.isin(*stop))))


def short_content_words(c: Column) -> Column:
    return content_words(c, STOP_SHORT, 3)


def negations(c: Column) -> Column:
    return F.regexp_count(c, F.lit(NEGATION))


def polarity(c: Column) -> Column:
    return c.rlike(POLARITY)


def latin_ratio(c: Column) -> Column:
    bare = F.regexp_replace(c, r"(?U)\s+", "")
    return F.when(F.length(bare) > 0, F.length(F.regexp_replace(bare, r"[^\p{L}&&[\x{0}-\x{2e7f}]]", "")) / F.length(bare)).otherwise(0.0)


#: Characters of Latin runs in the text layer and in overlays, and wide characters that aren't punctuation.
LATIN_RUN, OVERLAY_RUN = r"[\x20-\x7e]", "[0-9A-Za-z]"
WIDE = r"[\x{2e81}-\x{2fff}\x{3040}-\x{feff}\x{fff0}-\x{10ffff}]"
OTHER_RUN = {LATIN_RUN: r"[^\x20-\x7e]", OVERLAY_RUN: "[^0-9A-Za-z]"}


def spaced(c: Column, run: str = LATIN_RUN) -> Column:
    """A thin space between a run that holds letters and a wide character beside it; none at punctuation."""
    lettered = f"({run}*[A-Za-z]{run}*)"
    return F.regexp_replace(F.regexp_replace(c, f"(?<={WIDE}){lettered}", "\u2009$1"), f"{lettered}(?={WIDE})", "$1\u2009")


def runs_of(c: Column, size: Column, run: str = LATIN_RUN) -> Column:
    """Runs as array<struct<run, latin, scale>>: Latin ones end after each f, so that no ligatures form, and are set larger
    beside wide characters, most in titles (type size 14 and more), unless most of the text is Latin."""
    scale = F.when(latin_ratio(c) > 0.5, 1.0).when(size >= 14, 1.10).otherwise(1.06)
    parts = F.regexp_extract_all(spaced(c, run), F.lit(f"{run}+|{OTHER_RUN[run]}+"), F.lit(0))
    cut = F.flatten(F.transform(parts, lambda p: F.when(p.rlike(f"^{run}"), F.regexp_extract_all(p, F.lit("[^f]*f|[^f]+"), F.lit(0))).otherwise(F.array(p))))
    return F.transform(cut, lambda p: F.struct(p.alias("run"), p.rlike(f"^{run}").alias("latin"), F.when(p.rlike(f"^{run}"), scale).otherwise(1.0).alias("scale")))


def width_em(c: Column) -> Column:
    """Width in em: 1 from U+2E80 on, 0.56 below."""
    wide = F.length(F.regexp_replace(c, r"[\x{0}-\x{2e7f}]", ""))
    return wide + (F.length(c) - wide) * 0.56


def display_width(c: Column) -> Column:
    wide = F.length(F.regexp_replace(c, r"[^\x{1100}-\x{115f}\x{2e80}-\x{a4cf}\x{ac00}-\x{d7a3}\x{f900}-\x{faff}\x{fe30}-\x{fe6f}\x{ff00}-\x{ff60}\x{ffe0}-\x{ffe6}]", ""))
    return F.length(c) + wide


def cell(c: Column) -> Column:
    """One table cell: white space collapsed, bars escaped, a dash where empty."""
    plain = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    return F.coalesce(F.nullif(F.replace(plain, F.lit("|"), F.lit(r"\|")), F.lit("")), F.lit("—"))


def before_paren(c: Column) -> Column:
    return F.trim(F.regexp_extract(c, "^([^(（]*)", 1))


def paren_terms(c: Column) -> Column:
    """English terms set beside CJK ones in brackets, either way round, in lower case."""
    one = F.regexp_extract_all(c, F.lit(r"[一-鿿]{0,12}[（(]\s*([A-Za-z][A-Za-z0-9 .\-&+/']{1,28}?)\s*[)）]"), F.lit(1))
    two = F.regexp_extract_all(c, F.lit(r"([A-Za-z][A-Za-z0-9 .\-&+/']{1,28}?)\s*[（(][一-鿿]{1,14}[)）]"), F.lit(1))
    return F.transform(F.concat(one, two), F.lower)


def proper_nouns(c: Column) -> Column:
    codes = F.filter(F.regexp_extract_all(c, F.lit(CODE), F.lit(0)), lambda t: (F.length(t) >= 4) & ~t.isin(*STOP_CAPS))
    models = F.filter(F.regexp_extract_all(c, F.lit(MODEL), F.lit(0)), lambda t: ~t.rlike(r"^[A-Z]\d$"))
    rest = [F.regexp_extract_all(c, F.lit(p), F.lit(0)) for p in (DOMAIN, COMPANY)]
    return F.array_sort(F.array_distinct(F.concat(codes, models, *rest)))


def structure_words(c: Column) -> Column:
    """Chinese structure words before section numbers in English, one space between scripts, plain full stops."""
    for zh, en in (("图", "Figure"), ("表", "Table"), ("章", "Chapter"), ("节", "Section")):
        c = F.regexp_replace(c, rf"{zh}\s*(\d+(?:\.\d+)?)", f"{en} $1")
    c = F.regexp_replace(c, "([一-鿿])([A-Za-z0-9])", "$1 $2")
    c = F.regexp_replace(c, "([A-Za-z0-9])([一-鿿])", "$1 $2")
    return F.replace(c, F.lit("。"), F.lit("."))


def color_hex(c: Column) -> Column:
    return F.concat(F.lit("#"), F.lower(F.lpad(F.hex(c.bitwiseAND(0xFFFFFF)), 6, "0")))


def font_weight(font: Column, size: Column, known: dict[str, str] | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for pair in (known or {"Regular": "Medium"}).items() for x in pair])
    by_size = F.when(size >= 40, "Black").when(size >= 20, "Bold").otherwise("Medium")
    return F.coalesce(F.try_element_at(table, font), by_size)
