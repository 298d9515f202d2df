"""Readers and writers of the artifact formats: JSON lists and objects, tabbed work lists, logs and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.worklist import latest_by_file

BOX = "x0 double, y0 double, x1 double, y1 double"


def read_json(spark: SparkSession, path: str, schema: str, inside: str | None = None) -> DataFrame:
    """Rows of a JSON file that holds a list of objects, or an object whose key `inside` holds it.

    Fields that a row lacks are null; a file that can't be parsed gives no rows.
    """
    if inside is None:
        return spark.read.schema(schema).json(path, multiLine=True).where(F.expr(" OR ".join(f"`{f.name}` IS NOT NULL" for f in T.StructType.fromDDL(schema))))
    whole = spark.read.schema(f"{inside} array<struct<{', '.join(f'{f.name}: {f.dataType.simpleString()}' for f in T.StructType.fromDDL(schema))}>>").json(path, multiLine=True)
    return whole.selectExpr(f"inline({inside})")


def read_worklist(spark: SparkSession, path: str) -> DataFrame:
    """gid, meta and text of `0001<tab>[meta]<tab>text` lines; a gid in several files is the last file's."""
    line = r"^(\d{4})\t\[([^\]]*)\]\t(.*)$"
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").where(F.col("value").rlike(line))
    cols = [F.regexp_extract("value", line, i) for i in (1, 2, 3)]
    return latest_by_file(rows.select("file", cols[0].cast("int").alias("gid"), cols[1].alias("meta"), F.trim(cols[2]).alias("text"))).drop("file")


def read_translations(spark: SparkSession, path: str) -> DataFrame:
    """gid, value and keep of `gid<tab>value` lines without blanks and # comments; = keeps the source."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.split("value", "\t", 2).alias("p"), "value")
    rows = rows.where((F.trim("value") != "") & ~F.col("value").startswith("#") & (F.size("p") == 2))
    rows = rows.select("file", F.expr("try_cast(trim(p[0]) AS int)").alias("gid"), F.trim(F.col("p")[1]).alias("value")).where("gid IS NOT NULL")
    return latest_by_file(rows).select("gid", "value", (F.col("value") == "=").alias("keep"))


def write_worklist(queued: DataFrame, path: str) -> None:
    """One folder of lines per batch."""
    meta = F.concat(F.lit("["), F.concat_ws(" ", "cls", F.concat(F.lit("x"), F.col("n"))), F.lit("]"))
    line = F.concat_ws("\t", F.lpad(F.col("gid").cast("string"), 4, "0"), meta, F.regexp_replace("text", r"[\t\r\n]+", " "))
    queued.select("batch", line.alias("value")).repartition("batch").sortWithinPartitions("batch", "value").write.mode("overwrite").partitionBy("batch").text(path)


def append_log(rows: DataFrame, path: str) -> None:
    """One JSON line per row, after those that are there."""
    rows.write.mode("append").json(path)


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """path, size, mtime and SHA-256 of files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), F.sha2("content", 256).alias("sha256"))


def clipped_text(spans: DataFrame, boxes: DataFrame) -> DataFrame:
    """Text of the spans (page, ln, box, text) that meet each box (page, ln, box), in reading order."""
    from quire.operators.spatial import box_join, left_box, prefixed, right_box
    from quire.functions.geom import intersection

    met = box_join(prefixed(boxes, "l_"), prefixed(spans, "r_"), intersection(left_box(), right_box()) > 0)
    order = F.array_sort(F.collect_list(F.struct("r_y0", "r_x0", "r_ln", "r_text")))
    per = met.groupBy("l_page", "l_ln").agg(order.alias("s"))
    return per.select(F.col("l_page").alias("page"), F.col("l_ln").alias("ln"), F.array_join(F.transform("s", lambda x: x["r_text"]), " ").alias("text"))


def first_source(candidates: dict[str, Column]) -> Column:
    """The first source, in order, that isn't null: struct<chosen_source, value>."""
    named = [F.when(c.isNotNull(), F.struct(F.lit(k).alias("chosen_source"), c.alias("value"))) for k, c in candidates.items()]
    return F.coalesce(*named)
