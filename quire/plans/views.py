"""Layout views over the plain tables, as DataFrames and as SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed lines that aren't blank: doc, page (from 1), ln (from 0), text, lang, source."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "lang", "source", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    return docs.select("doc", (F.col("doc") + 1).alias("page"), F.col("ln").cast("long").alias("ln"), F.trim("line").alias("text"), "lang", "source").where("text <> ''")


def placed(rows: DataFrame) -> DataFrame:
    """Boxes and confidences by document and line number."""
    doc, ln = F.col("doc"), F.col("ln")
    rows = rows.withColumns({"x0": ((37 * ln) % 540).cast("double"), "y0": (9 * ln + (5 * doc) % 4).cast("double"), "conf": (((31 * doc + 17 * ln) % 100) / 100.0).cast("double")})
    return rows.withColumns({"x1": F.col("x0") + 5.6 * F.length("text"), "y1": F.col("y0") + 2 + (7 * doc + 13 * ln) % 20})


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(lines(spark, sf_dir))


def frags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of 8 to 67 characters, so that all classes occur: lines cut into consecutive pieces, numbered by document.

    No character but blanks at the cuts is left out.
    """
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "lang", "source", F.split("text", "\n").alias("lines"))
    # One walk along a line gives all of its pieces; substrings would each walk from its start.
    pieces = F.expr("flatten(transform(lines, (l, j) -> if(l = '', array(l), regexp_extract_all(l, concat('(?s).{1,', 8 + (7 * doc + 3 * j) % 60, '}'), 0))))")
    rows = docs.select("doc", (F.col("doc") + 1).alias("page"), "lang", "source", F.posexplode(pieces).alias("ln", "piece"))
    return placed(rows.select("doc", "page", F.col("ln").cast("long").alias("ln"), F.trim("piece").alias("text"), "lang", "source").where("text <> ''"))


def paired(rows: DataFrame) -> DataFrame:
    """Source and target texts: even lines of a document with changed or repeated lines as targets."""
    ln, doc = F.col("ln"), F.col("doc")
    tgt = (
        F.when((doc + ln) % 11 == 0, "")
        .when((doc + ln) % 7 == 0, F.col("text"))
        .when((doc + ln) % 5 == 0, F.concat(F.lit("未 "), F.col("text")))
        .otherwise(F.concat(F.lit("译 "), F.reverse(F.col("text"))))
    )
    return rows.select("doc", "page", "ln", "x0", "y0", "x1", "y1", F.col("text").alias("src"), tgt.alias("tgt"), F.when(ln % 2 == 0, "text").otherwise("l2").alias("layer"), ((doc + ln) % 13 == 0).alias("passthrough"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of pieces of lines."""
    return paired(frags(spark, sf_dir))


def block_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of whole blocks."""
    return paired(blocks(spark, sf_dir))


def layered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole blocks of both layers: odd lines stand in images."""
    return blocks(spark, sf_dir).withColumn("layer", F.when(F.col("ln") % 2 == 0, "text").otherwise("l2"))


def number_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences with numbers, some of them changed or lost in the target."""
    key = F.col("o_orderkey")
    money = F.format_string("%.2f", F.col("o_totalprice"))
    src = F.concat(F.lit("Order "), key, F.lit(" total $"), money)
    changed = F.concat(F.lit("Order "), key + 1, F.lit(" total $"), money)
    lost = F.concat(F.lit("Order total $"), money)
    tgt = F.when(key % 7 == 0, changed).when(key % 11 == 0, lost).otherwise(src)
    return table(spark, sf_dir, "orders").select(key.alias("id"), src.alias("src"), tgt.alias("tgt"))


#: The same views for the oracle.
SQL = {
    "lines": """lines AS (SELECT doc_id AS doc, doc_id + 1 AS page, (i - 1)::BIGINT AS ln, trim(l[i], ' ') AS text, lang, source
  FROM (SELECT doc_id, lang, source, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS l FROM documents))
  WHERE trim(l[i], ' ') <> '')""",
    "blocks": """blocks AS (SELECT *, x0 + 5.6::DOUBLE * length(text) AS x1, y0 + 2 + (7 * doc + 13 * ln) % 20 AS y1 FROM (
  SELECT *, ((37 * ln) % 540)::DOUBLE AS x0, (9 * ln + (5 * doc) % 4)::DOUBLE AS y0, ((31 * doc + 17 * ln) % 100)::DOUBLE / 100::DOUBLE AS conf FROM lines))""",
    "frags": """frags AS (SELECT *, x0 + 5.6::DOUBLE * length(text) AS x1, y0 + 2 + (7 * doc + 13 * ln) % 20 AS y1 FROM (
  SELECT doc, doc + 1 AS page, ln, lang, source, trim(piece, ' ') AS text, ((37 * ln) % 540)::DOUBLE AS x0, (9 * ln + (5 * doc) % 4)::DOUBLE AS y0,
  ((31 * doc + 17 * ln) % 100)::DOUBLE / 100::DOUBLE AS conf FROM (
    SELECT doc, lang, source, unnest(ps) AS piece, unnest(range(len(ps))) AS ln FROM (
      SELECT doc_id AS doc, lang, source, flatten(list_transform(string_split(text, chr(10)), lambda l, j: list_transform(range(greatest(1, (length(l) + 7 + (7 * doc_id + 3 * (j - 1)) % 60) // (8 + (7 * doc_id + 3 * (j - 1)) % 60))),
        lambda i: l[1 + i * (8 + (7 * doc_id + 3 * (j - 1)) % 60):(i + 1) * (8 + (7 * doc_id + 3 * (j - 1)) % 60)]))) AS ps FROM documents))) WHERE text <> '')""",
    "pairs": """pairs AS (SELECT doc, page, ln, x0, y0, x1, y1, text AS src,
  CASE WHEN (doc + ln) % 11 = 0 THEN '' WHEN (doc + ln) % 7 = 0 THEN text WHEN (doc + ln) % 5 = 0 THEN '未 ' || text ELSE '译 ' || reverse(text) END AS tgt,
  CASE WHEN ln % 2 = 0 THEN 'text' ELSE 'l2' END AS layer, (doc + ln) % 13 = 0 AS passthrough FROM frags)""",
    "block_pairs": """block_pairs AS (SELECT doc, page, ln, x0, y0, x1, y1, text AS src,
  CASE WHEN (doc + ln) % 11 = 0 THEN '' WHEN (doc + ln) % 7 = 0 THEN text WHEN (doc + ln) % 5 = 0 THEN '未 ' || text ELSE '译 ' || reverse(text) END AS tgt,
  CASE WHEN ln % 2 = 0 THEN 'text' ELSE 'l2' END AS layer, (doc + ln) % 13 = 0 AS passthrough FROM blocks)""",
    "layered": "layered AS (SELECT *, CASE WHEN ln % 2 = 0 THEN 'text' ELSE 'l2' END AS layer FROM blocks)",
    "number_pairs": """number_pairs AS (SELECT o_orderkey AS id, src, CASE WHEN o_orderkey % 7 = 0 THEN 'Order ' || (o_orderkey + 1) || ' total $' || money
  WHEN o_orderkey % 11 = 0 THEN 'Order total $' || money ELSE src END AS tgt
  FROM (SELECT o_orderkey, money, 'Order ' || o_orderkey || ' total $' || money AS src FROM (SELECT o_orderkey, printf('%.2f', o_totalprice) AS money FROM orders)))""",
}
NEEDS = {"lines": (), "blocks": ("lines",), "frags": (), "pairs": ("frags",), "block_pairs": ("lines", "blocks"), "layered": ("lines", "blocks"), "number_pairs": ()}


def sql(views: str, body: str) -> str:
    """Oracle SQL whose first common tables are views (by blanks) and what they need; body starts with SELECT or more tables."""
    tables = ", ".join(SQL[v] for v in dict.fromkeys(x for view in views.split() for x in (*NEEDS[view], view)))
    body = body.strip()
    return f"WITH {tables}, {body[1:]}" if body.startswith(",") else f"WITH {tables} {body}"


Query = Callable[[SparkSession, str], DataFrame]
