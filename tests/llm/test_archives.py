"""WARC archives and AVI columns: exact round trips."""

import gzip
import hashlib
import struct
import zlib

import numpy as np
import pytest

from quire.llm import avi, common, warc
from tests.llm.cases import empty, frame, rows

BIG = "<html>" + "x" * 200


def pages(spark):
    data = [(1, "http://a/ b", BIG), (2, "http://b", BIG), (3, None, "small"), (4, "u", "small"), (5, "u", None), (None, "u", BIG), (6, "u\r\nX: y", "é" * 90), (6, "u", "é" * 90), (7, "u", "z" * 99), (8, "u", "z" * 99), (0, "u", BIG + "WARC/1.1\r\n\r\n")]
    return spark.createDataFrame([(*d, 1, "clash") for d in data], "page_id long, url string, html string, id long, digest string").repartition(3), data


def test_warc_round_trip(spark):
    df, data = pages(spark)
    got = sorted(repr(tuple(r)) for r in warc.archive(df).collect())
    first = {}
    for i, _, h in data:
        if h and len(h.encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    want = []
    for i, _, h in data:
        raw = (h or "").encode()
        w = first.get(h) if len(raw) >= 100 else None
        revisit = w is not None and i != w
        want.append(repr((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", w if revisit else None)))
    assert got == sorted(want)
    none = spark.createDataFrame([], df.schema)
    assert warc.archive(none).count() == 0


def test_members_are_addressed_alone(spark):
    df, data = pages(spark)
    folder = common.shared_dir(spark, "warc")
    shards = warc.normalise(warc.write_monolithic(warc.decided(df), folder), keep=True)
    n = 0
    for s in shards.collect():
        with common.open_file(folder, s["name"]) as f:
            raw = f.read()
        with common.open_file(folder, s["name"].replace(".warc", ".mono.warc")) as f:
            mono = f.read()
        assert gzip.decompress(raw) == gzip.decompress(mono)
        with common.open_file(folder, s["name"] + ".idx") as f:
            for line in f.read().decode().splitlines():
                urn, offset, size = line.split()
                record = warc.member(folder, s["name"], int(offset), int(size))
                assert warc.header(record)["warc-record-id"] == urn and record.startswith(b"WARC/1.1\r\n")
                n += 1
    assert n == len(data)


def test_streams_of_many_members_and_broken_ones():
    record = warc.record({"id": 1, "url": "u", "html": b"abc", "digest": "d", "bytes": 3, "refers_to": None})
    two = zlib.compress(record, wbits=31) + zlib.compress(record, wbits=31)
    parts = iter([two[:10], two[10:70], two[70:], b""])
    assert list(warc.records_in(warc.inflated(lambda _: next(parts)))) == [record, record]
    with pytest.raises(ValueError):
        list(warc.records_in(iter([record[:-1]])))


def test_avi_round_trip(spark):
    media = avi.text_media(frame(spark))
    got = avi.media_digests(media).collect()
    want = []
    for i, t, *_ in rows():
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        want.append(repr((i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))))
    assert sorted(repr(tuple(r)[:5]) for r in got) == sorted(want)
    by_text = {}
    for r in got:
        by_text.setdefault(r["payload_sha256"], set()).add((r["media_bytes"], r["media_sha256"], r["feature"]))
    assert all(len(v) == 1 for v in by_text.values())
    assert avi.media_digests(avi.text_media(empty(spark))).count() == 0


def test_any_samples_are_lossless():
    x = np.random.default_rng(0).integers(0, 256, (50, 576)).astype(np.uint8)
    x[0], x[1], x[2] = 0, 255, np.tile([0, 255], 288)
    assert (avi.decoded_frames(avi.coded_frames(x)) == x).all()


def test_frames_without_index_and_files_that_are_none(spark):
    x = np.random.default_rng(0).integers(0, 256, (3, 576)).astype(np.uint8)
    frames = avi.coded_frames(x)
    raw = avi.written_avi(frames)
    assert avi.frames_of(raw) == (frames, 25.0)
    at = raw.index(b"idx1")
    assert avi.frames_of(raw[:at])[0] == frames
    second = b"RIFF" + struct.pack("<I", 4 + len(raw[raw.index(b"movi") - 8 : at])) + b"AVIX" + raw[raw.index(b"movi") - 8 : at]
    assert avi.frames_of(raw + second)[0] == frames + frames
    df = spark.createDataFrame([(1, bytearray(raw)), (2, None), (3, bytearray(b"RIFF")), (4, bytearray(b"")), (5, bytearray(raw[: len(raw) // 2]))], "doc_id long, media binary")
    assert {r["doc_id"] for r in avi.clips(df).collect()} <= {1, 5}
    feature = {r["doc_id"]: r["feature"] for r in avi.media_digests(df).collect()}
    assert feature[3] == feature[4] == feature[5] == "unreadable" and feature[2].startswith("0 frames") and feature[1].startswith("3 frames")
    assert struct.unpack_from("<I", raw, 4)[0] == len(raw) - 8


def test_clips_are_those_of_the_query(spark):
    """Clips cover the frames of each document without gaps, at the shots that op9 states."""
    from quire.llm.queries import media_clips, op9_avi_clips

    sf = "/root/testdata/sf0.001"
    shots = {}
    for r in media_clips(spark, sf).orderBy("doc_id", "clip").collect():
        shots.setdefault(r["doc_id"], []).append(f"{r['first_frame']}-{r['last_frame']}")
        assert r["start_s"] == r["first_frame"] / 25 and r["end_s"] == (r["last_frame"] + 1) / 25
    assert {r["doc_id"]: r["feature"].split(": ")[1] for r in op9_avi_clips(spark, sf).collect()} == {k: ",".join(v) for k, v in shots.items()}


def test_shots_are_cut_where_histograms_jump(spark):
    x = np.full((12, 576), 40, np.uint8)
    x[5:9] = 200
    assert avi.cuts(x) == [0, 5, 9]
    assert avi.cuts(x[:1]) == [0] and avi.cuts(x[:0]) == []
    df = spark.createDataFrame([(1, bytearray(avi.written_avi(avi.coded_frames(x))))], "doc_id long, media binary")
    got = [(r["clip"], r["first_frame"], r["last_frame"], round(r["start_s"], 3), r["brightness"]) for r in avi.clips(df).collect()]
    assert got == [(0, 0, 4, 0.0, 40.0), (1, 5, 8, 0.2, 200.0), (2, 9, 11, 0.36, 40.0)]
