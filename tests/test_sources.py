"""Readers, writers and streams."""

import json

from pyspark.sql import functions as F

from quire.operators import worklist
from quire.sources import artifacts as A
from quire.streaming import verdicts as V


def test_json_lists_objects_and_broken_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"in_image": [{"page": 1, "text": "x"}, {"page": 2}]}))
    got = A.read_json(spark, str(tmp_path / "a.json"), "page int, text string", "in_image").collect()
    assert [(r["page"], r["text"]) for r in got] == [(1, "x"), (2, None)]
    (tmp_path / "b.json").write_text(json.dumps([{"page": 3}]))
    assert [r["page"] for r in A.read_json(spark, str(tmp_path / "b.json"), "page int, text string").collect()] == [3]
    (tmp_path / "c.json").write_text("{broken")
    assert A.read_json(spark, str(tmp_path / "c.json"), "page int").count() == 0


def test_work_lists_and_translations(spark, tmp_path):
    d = tmp_path / "batches"
    d.mkdir()
    (d / "batch_01.txt").write_text("0001\t[label x2]\told\n# no\n0002\t[s]\ttwo\n")
    (d / "batch_02.txt").write_text("0001\t[label x2]\tnew\n")
    got = {r["gid"]: r["text"] for r in A.read_worklist(spark, str(d)).collect()}
    assert got == {1: "new", 2: "two"}
    (tmp_path / "trans.txt").write_text("# comment\n0001\t=\n0002\t zwei \n\nno tab\nx\ty\n")
    got = {r["gid"]: (r["value"], r["keep"]) for r in A.read_translations(spark, str(tmp_path / "trans.txt")).collect()}
    assert got == {1: ("=", True), 2: ("zwei", False)}


def test_written_work_lists_can_be_read(spark, tmp_path):
    q = spark.createDataFrame([("a b", 2, 1, "label"), ("c\td", 1, 1, "sentence")], "text string, n long, n_pages long, cls string")
    A.write_worklist(worklist.numbered(q), str(tmp_path / "out"))
    got = {r["gid"]: r["text"] for r in A.read_worklist(spark, str(tmp_path / "out" / "*")).collect()}
    assert got == {1: "a b", 2: "c d"}


def test_logs_grow(spark, tmp_path):
    for i in range(2):
        A.append_log(spark.createDataFrame([(i,)], "run int"), str(tmp_path / "log"))
    assert sorted(r["run"] for r in spark.read.json(str(tmp_path / "log")).collect()) == [0, 1]


def test_fingerprints(spark, tmp_path):
    import hashlib

    (tmp_path / "f.bin").write_bytes(b"abc")
    r = A.fingerprints(spark, str(tmp_path)).first()
    assert (r["size"], r["sha256"]) == (3, hashlib.sha256(b"abc").hexdigest())


def test_clipped_text_in_reading_order(spark):
    s = "page long, ln long, x0 double, y0 double, x1 double, y1 double, text string"
    spans = spark.createDataFrame([(1, 0, 50.0, 0.0, 90.0, 10.0, "b"), (1, 1, 0.0, 0.0, 40.0, 10.0, "a"), (1, 2, 0.0, 50.0, 40.0, 60.0, "c")], s)
    boxes = spark.createDataFrame([(1, 9, 0.0, 0.0, 100.0, 20.0, "")], s)
    assert A.clipped_text(spans, boxes).first()["text"] == "a b"


def test_first_source(spark):
    df = spark.createDataFrame([(None, "b"), ("a", "b"), (None, None)], "x string, y string")
    got = df.select(A.first_source({"one": F.col("x"), "two": F.col("y")}).alias("s")).collect()
    assert [r["s"] and tuple(r["s"]) for r in got] == [("two", "b"), ("one", "a"), None]


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.range(100).select((F.col("id") % 5).alias("page"), (F.col("id") % 20).alias("ln"), F.timestamp_seconds(F.col("id") * 30).alias("ts"), F.when(F.col("id") % 2 == 0, 0.2).otherwise(0.9).alias("conf"), F.lit("some words").alias("text"))
    rows.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    for name, df, mode in (("w", V.windowed_verdicts(stream), "complete"), ("d", V.first_readings(stream), "append"), ("s", V.sessions(stream.select("ts", F.col("page").alias("user_id"))), "complete")):
        q = df.writeStream.outputMode(mode).format("memory").queryName(f"t_{name}").option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert spark.table("t_w").agg(F.sum("n")).first()[0] == 100
    assert spark.table("t_d").select("page", "ln").distinct().count() == spark.table("t_d").count() == 20
    assert spark.table("t_s").agg(F.sum("n")).first()[0] == 100
