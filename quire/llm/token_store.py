"""Token ids on disk: shards of raw little-endian unsigned ids, each with a minimal perfect hash index.

Files of a store's folder, for shard s:

* ``s.ids``: the ids of all its documents in ascending key order, end ids included, and nothing else; 16 bits an id
  where the vocabulary and the end id allow it, else 32.
* ``s.idx``: magic, bytes an id, sizes, the perfect hash over the shard's keys, by slot a fingerprint of the key with the first
  row and the number of rows that bear it, and the place of every row in the payload.

A key's slot is found from its hash alone, so an access reads one slot and one range of the payload. A key that was
never stored meets the fingerprint in its slot with probability 2**-32 and otherwise counts as absent.

Cases: a null text counts as empty (its ids are the end id alone); a null key sorts first and is stored under a key of
its own; repeated keys keep all their rows, in text order; an empty table gives an empty store; columns beside key and
text are ignored, whatever their names; texts of any length are encoded whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm import kernels as K
from quire.llm.perfect_hash import PerfectHash
from quire.llm.tokenizing import WordIds, load

MAGIC = b"QIDX0001"
SLOT = np.dtype([("fingerprint", "<u4"), ("rows", "<u4"), ("row", "<u8")])
MANIFEST = "shard long, rows long, ids long, first_key long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: A null key is stored under this number.
NULL_KEY = -(1 << 63)


def _keys(column: pa.Array) -> np.ndarray:
    return column.fill_null(NULL_KEY).to_numpy(zero_copy_only=False).astype(np.int64)


def _key_hash(keys: np.ndarray) -> np.ndarray:
    return K.mixed(keys.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return (K.mixed(~h) >> np.uint64(32)).astype(np.uint32)


def index_bytes(keys: np.ndarray, lengths: np.ndarray, width: int = 4) -> bytes:
    """Index of rows in payload order; rows that repeat a key follow each other and share a slot."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    h = _key_hash(keys[first])
    ph = PerfectHash.build(h)
    slots = np.zeros(len(first), SLOT)
    at = ph.slots(h)
    slots["fingerprint"][at] = _fingerprint(h)
    slots["rows"][at] = np.diff(first, append=len(keys))
    slots["row"][at] = first
    table = ph.tobytes()
    places = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    return MAGIC + struct.pack("<QQQQ", width, len(first), len(keys), len(table)) + slots.tobytes() + places.tobytes() + table


class Shard:
    """Keyed access to one shard."""

    def __init__(self, folder: str, shard: int):
        with common.open_file(folder, f"{shard}.idx") as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"{folder}/{shard}.idx is no index of token ids")
        self.width, n, rows, size = struct.unpack_from("<QQQQ", raw, 8)
        self.slots = np.frombuffer(raw, SLOT, n, 40)
        self.places = np.frombuffer(raw, "<u8", rows + 1, 40 + SLOT.itemsize * n).astype(np.int64)
        self.ph = PerfectHash.frombytes(raw[len(raw) - size :])
        self.payload = common.open_file(folder, f"{shard}.ids")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key; 0 rows: it isn't there."""
        if not len(self.slots):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        h = _key_hash(keys)
        at = self.ph.slots(h)
        got = self.slots[at]
        there = (at >= 0) & (got["fingerprint"] == _fingerprint(h))
        return got["row"].astype(np.int64), np.where(there, got["rows"], 0).astype(np.int64)

    def ids(self, row: int) -> np.ndarray:
        start, end = self.places[row : row + 2].tolist()
        self.payload.seek(self.width * start)
        return np.frombuffer(self.payload.read(self.width * (end - start)), f"<u{self.width}").astype("<u4")


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Encode every text, append end_id and write shards in ascending key order, at once; gives folder and manifest.

    Shards are ranges of keys. A task that runs again replaces its shard's files whole, so lost executors do no harm.
    """
    spark = common.session(docs)
    common.bounded_batches(spark)
    folder = folder or common.shared_dir(spark, "ids")
    schema = common.struct(MANIFEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, encoder = TaskContext.get().partitionId(), load(WordIds, tokenizer)
        keys, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        width = 2 if max(encoder.largest, end_id) < 1 << 16 else 4

        def payload() -> Iterator[bytes]:
            for b in common.slices(batches, 2 << 20):
                ids, n = encoder.encode(b.column("text"))
                keys.append(_keys(b.column("id")))
                lengths.append(n + 1)
                yield np.insert(ids, np.cumsum(n), end_id).astype(f"<u{width}").tobytes()

        size = common.put_file(folder, f"{shard}.ids", payload())
        k = np.concatenate(keys)
        common.put_file(folder, f"{shard}.idx", iter([index_bytes(k, np.concatenate(lengths), width)]))
        rows = [{"shard": shard, "rows": len(k), "ids": size // width, "first_key": int(k[0])}] if len(k) else []
        yield pa.RecordBatch.from_pylist(rows, schema=common.arrow_schema(schema))

    order = F.col("id").asc_nulls_first()
    rows = common.texts_of(docs, id_col, text_col)
    ranged = rows.repartitionByRange(common.partitions_for(spark), order).sortWithinPartitions(order, F.col("text"))
    return folder, common.stored(ranged.mapInArrow(common.tidied(run), schema), "manifest")


def read_ids(folder: str, manifest: DataFrame, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Keyed access: doc_id, start, n_tokens and ids_crc32 of every stored row whose key is among `keys`.

    start counts the ids of all rows before, in key order. A key that was never stored gives no row.
    """
    spark = common.session(keys)
    # One entry per shard: shards of 128 MB for 128 TB of ids make a million entries of 24 bytes.
    shards = sorted((r["first_key"], r["shard"], r["ids"]) for r in manifest.select("first_key", "shard", "ids").toLocalIterator())
    table = spark.sparkContext.broadcast(np.array(shards, np.int64).reshape(-1, 3))
    pair, schema = common.struct("part long, key long"), common.struct(RESULT)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = _keys(b.column("id"))
            part = np.searchsorted(table.value[:, 0], k, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(k)], schema=common.arrow_schema(pair))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, opened, ids_of = table.value, None, None
        before = np.cumsum(first[:, 2]) - first[:, 2]
        for b in batches:
            part, key = b.column("part").to_numpy(), b.column("key").to_numpy()
            out = []
            for p in np.unique(part[part >= 0]).tolist():
                if opened != p:
                    opened, ids_of = p, Shard(folder, int(first[p, 1]))
                mine = key[part == p]
                row, n = ids_of.find(mine)
                for i in np.argsort(row, kind="stable").tolist():
                    for r in range(int(row[i]), int(row[i] + n[i])):
                        ids = ids_of.ids(r)
                        out.append((None if mine[i] == NULL_KEY else int(mine[i]), int(before[p] + ids_of.places[r]), len(ids), zlib.crc32(ids)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], schema=common.arrow_schema(schema))

    placed = keys.select(F.col(id_col).cast("long").alias("id")).distinct().mapInArrow(common.tidied(place), pair)
    return placed.repartition(common.partitions_for(spark), "part").sortWithinPartitions("part").mapInArrow(common.tidied(read), schema)
