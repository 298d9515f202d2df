"""WARC archives: shards written as one gzip stream, normalised to a member per record with an offset index, read back.

1. Payload digests decide which records are responses and which revisit a response with the same payload.
2. Every task writes a shard as one gzip stream over all its records.
3. The normaliser inflates such a whole-file stream once, and writes every record as a gzip member of its own and a
   sidecar index of (record id, offset, size) lines.
4. Reading seeks to a member by the index and inflates that record alone.

Cases: a null page counts as an empty payload; a null url becomes about:blank; null ids are written as "-", sort after
all others and read back as null; repeated rows give a record each; an empty table gives an empty result; columns
beside id, url and payload are ignored, whatever their names; payloads of any length are kept whole.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common

SHARD = "shard long, folder string, name string, records long"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
DATE = "2024-01-01T00:00:00Z"
READ = 1 << 20


def decided(pages: DataFrame, least: int = 100, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, html, digest and refers_to of every page; refers_to is null for responses."""
    rows = common.source_rows(pages, id_col, (url_col, "url", "string"), (html_col, "html", "string"))
    rows = rows.select("id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("html")).withColumn("digest", F.sha2("html", 256))
    long = F.octet_length("html") >= least
    # Only digests are summed; pages meet their winner in a join that Spark may split where a digest is common.
    winners = rows.where(long).groupBy("digest").agg(F.min("id").alias("winner")).withColumnRenamed("digest", "of")
    joined = rows.join(winners, (F.col("digest") == F.col("of")) & long, "left")
    revisit = F.col("winner").isNotNull() & ~F.col("id").eqNullSafe(F.col("winner"))
    return joined.select("id", "url", F.when(revisit, F.lit(b"")).otherwise(F.col("html")).alias("html"), F.octet_length("html").cast("long").alias("bytes"), "digest", F.when(revisit, F.col("winner")).alias("refers_to"))


def record(page: dict) -> bytes:
    """A WARC/1.1 record. A revisit has no payload of its own and names the response's id, digest and length."""
    key = "-" if page["id"] is None else str(page["id"])
    uri = re.sub(r"[\x00-\x20\x7f]", "", page["url"] or "") or "about:blank"
    revisit = page["refers_to"] is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{key}>",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{page['digest']}",
        f"X-Payload-Length: {page['bytes']}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{page['refers_to']}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(page['html'])}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + page["html"] + b"\r\n\r\n"


def _deflater() -> zlib._Compress:
    return zlib.compressobj(6, zlib.DEFLATED, 31)


def write_monolithic(pages: DataFrame, folder: str) -> DataFrame:
    """Write one gzip stream per task over the decided pages, at once; gives the shards."""
    schema = common.struct(SHARD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0

        def stream() -> Iterator[bytes]:
            nonlocal n
            gz = zlib.compressobj(1, zlib.DEFLATED, 31)
            for b in common.slices(batches):
                for page in b.to_pylist():
                    n += 1
                    yield gz.compress(record(page))
            yield gz.flush()

        name = f"{part:06d}.mono.warc.gz"
        common.put_file(folder, name, stream())
        yield pa.RecordBatch.from_pylist([{"shard": part, "folder": folder, "name": name, "records": n}] if n else [], schema=common.arrow_schema(schema))

    return common.stored(pages.mapInArrow(common.tidied(run), schema), "warc-shards")


def records_in(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Records of an inflated stream, each with its blank lines at the end. Holds one record at a time."""
    buf = bytearray()
    need = -1
    for chunk in chunks:
        buf += chunk
        while True:
            if need < 0:
                end = buf.find(b"\r\n\r\n")
                if end < 0:
                    break
                found = re.search(rb"\r\nContent-Length: *(\d+)", buf[:end], re.I)
                if not buf.startswith(b"WARC/") or not found:
                    raise ValueError("not a WARC record")
                need = end + 4 + int(found[1]) + 4
            if len(buf) < need:
                break
            yield bytes(buf[:need])
            del buf[:need]
            need = -1
    if buf:
        raise ValueError("the stream ends within a record")


def inflated(read) -> Iterator[bytes]:
    """Bytes of a gzip file of one or more members; each input byte is inflated once."""
    gz = zlib.decompressobj(31)
    while data := read(READ):
        while data:
            yield gz.decompress(data)
            data = gz.unused_data
            if gz.eof:
                gz = zlib.decompressobj(31)


def header(raw: bytes) -> dict[str, str]:
    lines = raw[: raw.index(b"\r\n\r\n")].decode().split("\r\n")[1:]
    return {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}


def normalise(shards: DataFrame, keep: bool = False) -> DataFrame:
    """Rewrite each shard with a member per record and a sidecar index; unless keep, the old file goes afterwards."""
    schema = common.struct(SHARD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = []
            for s in b.to_pylist():
                index, at, n = [], 0, 0
                name = s["name"].replace(".mono.", ".")

                def members(s: dict = s, index: list = index) -> Iterator[bytes]:
                    nonlocal at, n
                    with common.open_file(s["folder"], s["name"]) as f:
                        for raw in records_in(inflated(f.read)):
                            gz = _deflater()
                            member = gz.compress(raw) + gz.flush()
                            index.append(f"{header(raw)['warc-record-id']} {at} {len(member)}\n")
                            at, n = at + len(member), n + 1
                            yield member

                common.put_file(s["folder"], name, members())
                common.put_file(s["folder"], f"{name}.idx", iter(["".join(index).encode()]))
                done.append(s | {"name": name, "records": n})
            yield pa.RecordBatch.from_pylist(done, schema=common.arrow_schema(schema))

    out = common.stored(shards.repartition(common.partitions_for(common.session(shards)), "shard").mapInArrow(common.tidied(run), schema), "warc-normal")
    if not keep:  # only now: a task that ran again would have missed its input
        for s in shards.toLocalIterator():
            fs, path = common.filesystem(s["folder"])
            fs.delete_file(f"{path}/{s['name']}")
    return out


def member(folder: str, name: str, offset: int, size: int) -> bytes:
    """One record by its place."""
    with common.open_file(folder, name) as f:
        f.seek(offset)
        return zlib.decompress(f.read(size), 31)


def read_back(shards: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record, each read by the index."""
    schema = common.struct(RESULT)

    def page(urn: str | None) -> int | None:
        key = urn[len("<urn:page:") : -1] if urn else "-"
        return None if key == "-" else int(key)

    def row(raw: bytes) -> dict:
        h = header(raw)
        payload = raw[raw.index(b"\r\n\r\n") + 4 : -4]
        if h["warc-type"] == "revisit":
            size, digest = int(h["x-payload-length"]), h["warc-payload-digest"].removeprefix("sha256:")
        else:
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        return {"page_id": page(h["warc-record-id"]), "payload_bytes": size, "payload_digest": digest, "record_type": h["warc-type"], "refers_to": page(h.get("warc-refers-to"))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.to_pylist():
                with common.open_file(s["folder"], f"{s['name']}.idx") as f:
                    places = [tuple(map(int, line.split()[1:])) for line in f.read().decode().splitlines()]
                with common.open_file(s["folder"], s["name"]) as f:
                    for i in range(0, len(places), 1000):
                        rows = []
                        for offset, size in places[i : i + 1000]:
                            f.seek(offset)
                            rows.append(row(zlib.decompress(f.read(size), 31)))
                        yield pa.RecordBatch.from_pylist(rows, schema=common.arrow_schema(schema))

    return shards.repartition(common.partitions_for(common.session(shards)), "shard").mapInArrow(common.tidied(run), schema)


def archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write, normalise and read back all pages."""
    spark = common.session(pages)
    common.bounded_batches(spark)
    folder = folder or common.shared_dir(spark, "warc")
    return read_back(normalise(write_monolithic(decided(pages, id_col=id_col, url_col=url_col, html_col=html_col), folder)))


ARCHIVE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT payload_digest, min(page_id) AS winner FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN winner IS NOT NULL AND page_id IS DISTINCT FROM winner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN winner IS NOT NULL AND page_id IS DISTINCT FROM winner THEN winner END AS refers_to
FROM p LEFT JOIN w ON p.payload_digest = w.payload_digest AND payload_bytes >= 100
"""
