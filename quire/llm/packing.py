"""Packing token pieces into as few sequences as possible by linear grouping and best fit.

The planner sees only how many pieces there are of each length, which takes at most `capacity` numbers however many
documents there are. It works in the steps of the linear grouping scheme:

1. lengths over capacity / 8 are sorted and cut into groups of equal cardinality, each rounded up to its largest;
2. the packing of the few rounded sizes is optimised over configurations (a linear program by column generation,
   whose solution is rounded down);
3. real lengths, which are no longer than the rounded ones, take the places of each configuration, those with the
   largest sizes first, and go on into the room that rounding up left over;
4. what rounding down left over, then all small lengths from long to short, go to the sequence with the least room
   that still holds them, and to new sequences where none does.

Steps 3 and 4 are run for each of LOOSE: substituted sequences with more room than that share of capacity are given up
to step 4. The plan with the fewest sequences is the result.

A plan is a list of runs: of the pieces of a length, those of rank r .. r + n - 1 go to sequences s .. s + n - 1 at one
offset. Sequences of the same contents stay together as one run in all steps, so a plan's size depends on capacity and
the number of groups, not on the number of documents. Ranks come from counts per task and length, so no task sees
all pieces of a common length.

Cases: a null text counts as empty and packs as its end id alone; a null id stays null; repeated rows are packed as
often as they occur; an empty table gives an empty result; texts of any length are encoded whole and those beyond
capacity cut into full pieces and a rest; columns beside id and text are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm.tokenizing import WordIds, load

#: Shares of capacity that a substituted sequence may leave empty.
LOOSE = (1.0, 1 / 64, 0.0)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
RESULT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Run(NamedTuple):
    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, most: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of sizes within capacity that is worth most; most: how often each size may occur."""
    value = np.zeros(capacity + 1)
    taken: list[np.ndarray] = []
    useful = [g for g in range(len(sizes)) if worth[g] > 1e-12]
    for g in useful:
        s, best, n = int(sizes[g]), value.copy(), np.zeros(capacity + 1, np.int16)
        for k in range(1, min(int(most[g]), capacity // s) + 1):
            with_k = value[: capacity + 1 - k * s] + k * worth[g]
            better = with_k > best[k * s :] + 1e-12
            best[k * s :][better] = with_k[better]
            n[k * s :][better] = k
        value = best
        taken.append(n)
    at, out = int(np.argmax(value)), np.zeros(len(sizes), np.int64)
    top = float(value[at])
    for g, n in zip(reversed(useful), reversed(taken), strict=True):
        out[g] = n[at]
        at -= int(n[at] * sizes[g])
    return top, out


def configurations(sizes: np.ndarray, needed: np.ndarray, capacity: int, slack: float = 1e-3) -> list[tuple[float, np.ndarray]]:
    """How often to use which configuration to hold `needed` items of each size in, within 1 + slack, the fewest sequences.

    Columns are generated until none improves the solution; without an end to that, an error is raised.
    """
    k = len(sizes)
    most = np.minimum(needed, capacity // sizes)
    basis = np.diag(most.astype(float))
    cost = np.ones(k)
    for _ in range(1000 * k):
        inverse = np.linalg.inv(basis)
        dual = cost @ inverse
        worst = int(np.argmin(dual))
        if dual[worst] < -1e-9:
            column, price = np.zeros(k), 0.0
            column[worst] = -1.0
        else:
            top, best = _best_configuration(sizes, dual, most, capacity)
            if top <= 1 + slack:
                break
            column, price = best.astype(float), 1.0
        now, step = inverse @ needed, inverse @ column
        ratio = np.where(step > 1e-9, np.maximum(now, 0) / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            raise RuntimeError("the linear program of the configurations has no bound")
        basis[:, out], cost[out] = column, price
    else:
        raise RuntimeError("the column generation doesn't end")
    times = np.linalg.solve(basis, needed.astype(float))
    return [(float(t), basis[:, i].round().astype(np.int64)) for i, t in enumerate(times) if cost[i] and t > 1e-9]


class _Plan:
    def __init__(self, counts: np.ndarray, capacity: int):
        self.counts, self.capacity = counts, capacity
        self.given = np.zeros(capacity + 1, np.int64)
        self.sequences = 0
        self.runs: list[Run] = []
        self.rooms: dict[int, list[tuple[int, int]]] = {}
        self.sorted_rooms: list[int] = []

    def left(self, length: int) -> int:
        return int(self.counts[length] - self.given[length])

    def place(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append(Run(length, int(self.given[length]), count, sequence, offset))
        self.given[length] += count

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def leave(self, sequence: int, count: int, room: int) -> None:
        if count and room:
            if room not in self.rooms:
                bisect.insort(self.sorted_rooms, room)
            self.rooms.setdefault(room, []).append((sequence, count))

    def take_room(self, length: int) -> tuple[int, int, int] | None:
        """Sequences with the least room of at least length: (first, number, room)."""
        i = bisect.bisect_left(self.sorted_rooms, length)
        if i == len(self.sorted_rooms):
            return None
        room = self.sorted_rooms[i]
        sequence, count = self.rooms[room].pop()
        if not self.rooms[room]:
            del self.rooms[room], self.sorted_rooms[i]
        return sequence, count, room

    def best_fit(self, length: int) -> None:
        while n := self.left(length):
            found = self.take_room(length)
            if found is None:
                each = self.capacity // length
                found = (self.open(-(-n // each)), -(-n // each), self.capacity)
            sequence, count, room = found
            each = room // length
            full = min(count, n // each)
            if not full:
                full, each = 1, n
            for k in range(each):
                self.place(length, full, sequence, self.capacity - room + k * length)
            self.leave(sequence, full, room - each * length)
            self.leave(sequence + full, count - full, room)


def plan(counts: np.ndarray, capacity: int, groups: int = 64) -> tuple[int, list[Run]]:
    """counts[l]: pieces of length l, 1 to capacity. Gives the number of sequences and all runs."""
    lengths = np.arange(capacity - 1, capacity // 8, -1)
    number = counts[lengths]
    solved = _grouped(lengths, number, capacity, groups)
    best = None
    for loose in LOOSE:
        p = _Plan(counts.astype(np.int64), capacity)
        if n := p.left(capacity):
            p.place(capacity, n, p.open(n), 0)
        waiting = sorted(int(x) for x in lengths[number > 0])
        for times, places in solved:
            _substitute(p, waiting, places, times, int(loose * capacity))
        for length in range(capacity, 0, -1):
            if p.left(length):
                p.best_fit(length)
        if best is None or p.sequences < best.sequences:
            best = p
        if not solved:
            break
    return best.sequences, best.runs


def _grouped(lengths: np.ndarray, number: np.ndarray, capacity: int, groups: int) -> list[tuple[int, list[int]]]:
    """Whole numbers of configurations of rounded sizes, for lengths (falling) of which there are `number`."""
    total = int(number.sum())
    if not total:
        return []
    edges = np.unique(np.linspace(0, total, min(groups, total) + 1).astype(np.int64))
    ends = np.cumsum(number)
    # One entry for each group: its largest length, by which all its pieces are planned.
    rounded, needed = [], []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        largest = int(lengths[np.searchsorted(ends, a, "right")])
        if rounded and rounded[-1] == largest:
            needed[-1] += int(b - a)
        else:
            rounded.append(largest)
            needed.append(int(b - a))
    sizes = np.array(rounded, np.int64)
    found = configurations(sizes, np.array(needed, np.int64), capacity)
    out = [(int(times + 1e-6), [int(s) for s, n in zip(sizes, c, strict=True) for _ in range(n)]) for times, c in found]
    return sorted((x for x in out if x[1]), key=lambda x: -x[1][0])


def _substitute(p: _Plan, waiting: list[int], places: list[int], times: int, loose: int) -> None:
    """Fill sequences of one configuration: each place, largest first, takes the longest waiting length that leaves
    the places after it their rounded sizes; then the longest that fit go on into the rest. Where nothing fits a place,
    or more than `loose` would stay empty, the rest is left to best fit."""

    def longest(room: int) -> int | None:
        i = bisect.bisect_right(waiting, room) - 1
        while i >= 0 and chosen.count(waiting[i]) >= p.left(waiting[i]):
            i -= 1
        return waiting[i] if i >= 0 else None

    while times:
        chosen: list[int] = []
        room, reserved = p.capacity, sum(places)
        for size in places:
            reserved -= size
            length = longest(room - reserved)
            if length is None:
                return
            chosen.append(length)
            room -= length
        while (length := longest(room)) is not None:
            chosen.append(length)
            room -= length
        if room > loose:
            return
        count = min(times, *(p.left(x) // chosen.count(x) for x in chosen))
        sequence, used = p.open(count), 0
        for length in chosen:
            p.place(length, count, sequence, used)
            used += length
        for length in set(chosen):
            if not p.left(length):
                waiting.remove(length)
        p.leave(sequence, count, p.capacity - used)
        times -= count


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all texts, with the task that made each and its rank among that task's pieces of its length."""
    common.bounded_batches(common.session(docs))
    schema = common.struct(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder, out = TaskContext.get().partitionId(), load(WordIds, tokenizer), common.arrow_schema(schema)
        ranks = np.zeros(capacity + 1, np.int64)
        for b in common.slices(batches, 2 << 20):
            ids, n = encoder.encode(b.column("text"))
            raw = memoryview(np.insert(ids, np.cumsum(n), end_id).astype("<u4").tobytes())
            n = n + 1
            pieces = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, n[row] - start)
            at = (np.cumsum(n) - n)[row] + start
            crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            first = np.flatnonzero(np.diff(length[order], prepend=0))
            within = np.empty(len(row), np.int64)
            within[order] = np.arange(len(row)) - np.repeat(first, np.diff(first, append=len(row)))
            rank = ranks[length] + within
            np.add.at(ranks, length, 1)
            columns = [b.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(row), part), pa.int32()), pa.array(rank)]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return common.texts_of(docs, id_col, text_col).mapInArrow(common.tidied(run), schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, groups: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sequence and offset of every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = common.session(docs)
    pieces = common.stored(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    _, runs = plan(counts, capacity, groups)
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)
    before = by_part.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = pieces.join(before.select("part", "length", F.coalesce("before", F.lit(0)).alias("before")), ["part", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    schema = common.struct(RESULT)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        key = (runs[:, 0] << 44) + runs[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            mine = runs[np.searchsorted(key, (length << 44) + rank, "right") - 1]
            columns = [*b.columns[:5], pa.array(mine[:, 3] + rank - mine[:, 1]), pa.array(mine[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, schema=common.arrow_schema(schema))

    return ranked.mapInArrow(common.tidied(assign), schema)
