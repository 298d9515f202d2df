"""Exact n-gram Jaccard join with set-relation skipping, and the classes that its links form.

A text's set holds the distinct shingles of `size` words; two texts link when 100 * intersection >= `percent` * union.

1. Shingle hashes are counted by document. A document can only link when at least `percent` of its shingles stand in
   other documents too; all others are settled here. What goes on is each remaining document's shared shingles, from
   rare to common, and the size of its whole set. Documents with equal sets are one class from here on. Blocks of
   documents count their shingles first, so that a shingle of all documents comes once a block to its bucket; there are
   as many buckets as the bytes of all texts call for.
2. An index over prefixes (as many of the rarest shingles as any partner must meet) joins classes of similar size into
   clusters that hold every link and are resolved apart from each other. Each task joins its own classes first, so that
   a prefix shingle of all classes comes once a task and band of sizes to its bucket.
3. Within a cluster, index lists are cut into blocks with their least and largest set size and least position; a
   probe skips a block in which no set of that size and position can reach the needed overlap. A probe of a set that is
   much like one already answered derives its overlaps from that one's, by the lists of the shingles in which the two
   differ. Sets already connected aren't compared again: links within a class aren't expanded into pairs.
4. Clusters too large for a task are dealt in chunks, in some rounds by the least hash of a set's shingles, which brings
   most sets that are alike together. Then those sets that are outside of the cluster's largest class meet, chunk by
   chunk, all sets of a size like theirs that share a prefix shingle with them. No pair of sets that could join two
   classes is left out, and a set goes to as many chunks as hold its prefix shingles, not to all.

Shingles are compared by 56 to 64 bits of their hash: two different shingles of a pair of texts with 1000 shingles
each agree by chance in one of 10**10 pairs. Sets count as equal by 128 bits; classes have numbers of their own.

Cases: null and empty texts, and texts of white space, have no shingles and link with nothing; a text with fewer words
than `size` has its whole sequence as one shingle; null ids stay null, take part in links and are never a class's
smallest id unless all are null; repeated rows link with each other; an empty table gives an empty result; columns
beside id and text are ignored, whatever their names; texts of any length are shingled whole. Documents should be read
from files: a repeated task must see the rows of the first in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm import kernels as K
from quire.llm.components import components

RESULT = "doc_id long, n_shingles long, component_id long"
#: Shingles that a task gathers before it hands them on; at least 16 times the buckets.
BLOCK_SHINGLES = 1_000_000
#: Bytes of text whose shingles a bucket takes, and bounds of the number of buckets.
BUCKET_BYTES, BUCKETS = 16 << 20, (256, 1 << 20)
#: Sets and shingles that one task resolves together.
CHUNK_SETS, CHUNK_SHINGLES = 500, 1_000_000
#: Sets whose answers others may be derived from, and rounds of chunks by least hash.
PIVOTS, ROUNDS = 16, 3

_PLACES = K.mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(buf: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles of each text, by text and hash."""
    low = K.LOWER[buf]
    starts, ends = K.words(low, at)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    w = K.hashed(low, starts, ends)
    first = np.searchsorted(starts, at)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    n = len(w) - size + 1
    hashes, owners = [], []
    if n > 0:
        h = w[:n] * _PLACES[0]
        for k in range(1, size):
            h = h + w[k : k + n] * _PLACES[k]
        whole = text[:n] == text[size - 1 :]
        hashes.append(K.mixed(h[whole]))
        owners.append(text[:n][whole])
    counts = np.diff(first)
    for t in np.flatnonzero((counts > 0) & (counts < size)).tolist():
        own = w[first[t] : first[t + 1]]
        hashes.append(K.mixed(np.array([(own * _PLACES[: len(own)]).sum() + np.uint64(len(own))], np.uint64)))
        owners.append(np.array([t]))
    h, text = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return text[new], h[new]


def needed(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Least intersection of sets of n and m shingles that link."""
    return -(-percent * (n + m) // (100 + percent))


def masked(h: np.ndarray, buckets: int) -> tuple[np.ndarray, int]:
    """Hashes as bucket (their first bits) and at most 48 of their last bits, and how many of these there are."""
    shift = 64 - (buckets - 1).bit_length()
    width = min(48, shift)
    return h >> np.uint64(shift) << np.uint64(width) | h & np.uint64((1 << width) - 1), width


def _packed(h: np.ndarray) -> bytes:
    """The last 48 bits of each number."""
    return (h & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + ((h >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    n = len(packed) // 6
    return np.frombuffer(packed, "<u4", n).astype(np.uint64) | np.frombuffer(packed, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32)


BLOCKS = "bucket int, block long, ids binary, sizes binary, docs binary, counts binary, packed binary, often binary, times binary"
SHARED = "block long, ids binary, sizes binary, docs binary, counts binary, shingles binary, ranks binary, often binary, often_ranks binary"


def _blocks(rows: DataFrame, size: int, buckets: int) -> DataFrame:
    """Shingles by range of hash: each row has those of a block of documents within one bucket.

    ids, sizes: of the block's documents, in bucket 0 alone; docs, counts: which documents, and how many shingles each;
    packed: shingles that one document of the block has; often, times: those of several, each once, and of how many.
    Which documents have these is in one more row of the block, in any bucket, whose `packed` numbers them in order.
    """
    most = max(BLOCK_SHINGLES, 16 * buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, block = TaskContext.get().partitionId(), 0
        ids: list = []
        sizes: list[np.ndarray] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def of_docs(doc: np.ndarray) -> tuple[bytes, bytes]:
            first = np.flatnonzero(np.diff(doc, prepend=-1))
            return doc[first].astype("<u4").tobytes(), np.diff(first, append=len(doc)).astype("<u4").tobytes()

        def handed_on() -> Iterator[pa.RecordBatch]:
            doc, (h, width) = np.concatenate([d for d, _ in parts]), masked(np.concatenate([x for _, x in parts]), buckets)
            order = np.argsort(h, kind="stable")
            x = h[order]
            first = np.flatnonzero(np.diff(x, prepend=~x[:1]))
            times = np.diff(first, append=len(x))
            name = task << 24 | block
            several = times > 1
            of = np.repeat(np.cumsum(several) - 1, times)
            inside = np.empty(len(h), bool)
            inside[order] = np.repeat(several, times)
            number = np.empty(len(h), np.int64)
            number[order] = of
            # In order of documents: what stays with the block.
            own = (*of_docs(doc[inside]), number[inside].astype("<u4").tobytes())
            once, many, times = x[first[~several]], x[first[several]], times[several]
            by_doc = np.flatnonzero(~inside)
            single_doc, single = doc[by_doc], h[by_doc]
            bucket = (single >> np.uint64(width)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            single_doc, single = single_doc[by], single[by]
            edges = np.arange(buckets + 1, dtype=np.uint64) << np.uint64(width)
            cut = np.searchsorted(bucket[by], np.arange(buckets + 1)).tolist()
            cut_many = [*np.searchsorted(many, edges[:-1]).tolist(), len(many)]
            assert len(once) == len(single)
            out = []
            for k in range(buckets):
                i, j = cut[k], cut[k + 1]
                p, q = cut_many[k], cut_many[k + 1]
                known = (_ids(ids), np.concatenate(sizes).astype("<i8").tobytes()) if k == 0 else (b"", b"")
                if k == 0 or j > i or q > p:
                    out.append((k, name, *known, *of_docs(single_doc[i:j]), _packed(single[i:j]), _packed(many[p:q]), times[p:q].astype("<u4").tobytes()))
            if len(own[2]):
                out.append((int(K.mixed(np.array([name], np.uint64))[0] % np.uint64(buckets)), name, b"", b"", *own, b"", b"own"))
            types = (pa.int32(), pa.int64(), *[pa.binary()] * 7)
            for i in range(0, len(out), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 4096], strict=True), types, strict=True)], names=[f.split()[0] for f in BLOCKS.split(", ")])

        for b in common.slices(batches, 2 << 20):
            text, h = shingles(*K.buffer_of(b.column("text")), size)
            parts.append((text + len(ids), h))
            sizes.append(np.bincount(text, minlength=b.num_rows))
            ids += b.column("id").to_pylist()
            held += len(h)
            if held > most:
                yield from handed_on()
                block, ids, sizes, parts, held = block + 1, [], [], [], 0
        if ids:
            yield from handed_on()

    return rows.mapInArrow(common.tidied(run), BLOCKS)


def _ids(ids: list) -> bytes:
    return pa.array(ids, pa.int64()).fill_null(0).to_numpy().astype("<i8").tobytes() + np.array([i is None for i in ids], np.uint8).tobytes()


def _shared(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """One bucket: keep the shingles of two documents or more, each with its rank by frequency (a byte)."""
        own = pdf["times"] == b"own"
        passed, pdf = pdf[own], pdf[~own]
        out = [(r.block, b"", b"", r.docs, r.counts, b"", b"", b"", r.packed) for r in passed.itertuples()]
        if len(pdf):
            single, many = [_unpacked(x) for x in pdf["packed"]], [_unpacked(x) for x in pdf["often"]]
            times = np.concatenate([np.ones(sum(map(len, single)), np.int64), *[np.frombuffer(x, "<u4") for x in pdf["times"]]])
            which = np.unique(np.concatenate([*single, *many]), return_inverse=True)[1]
            often = np.bincount(which, times)[which]
            rank = np.minimum(255, 8 * np.log2(np.maximum(often, 1))).astype(np.uint8)
            bucket = np.uint64(pdf["bucket"].iloc[0]) << np.uint64(width)
            at, at_many = 0, sum(map(len, single))
            for r, x, m in zip(pdf.itertuples(), single, many, strict=True):
                mine, theirs = slice(at, at + len(x)), slice(at_many, at_many + len(m))
                at, at_many = at + len(x), at_many + len(m)
                keep = often[mine] > 1
                doc = np.repeat(np.frombuffer(r.docs, "<u4"), np.frombuffer(r.counts, "<u4"))[keep]
                if r.sizes or len(doc) or len(m):
                    out.append((r.block, r.ids, r.sizes, doc.astype("<u4").tobytes(), b"", (x[keep] | bucket).astype("<u8").tobytes(), rank[mine][keep].tobytes(), (m | bucket).astype("<u8").tobytes(), rank[theirs].tobytes()))
        return pd.DataFrame(out, columns=[f.split()[0] for f in SHARED.split(", ")])

    return run


def _settled(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """One block of documents: their ids and sizes, and the shared shingles of those that may link."""
        known = pdf[pdf["sizes"].map(len) > 0].iloc[0]
        n = np.frombuffer(known["sizes"], "<i8")
        ids = np.frombuffer(known["ids"], "<i8", len(n))
        null = np.frombuffer(known["ids"], np.uint8, len(n), 8 * len(n)) > 0
        own = pdf["counts"].map(len) > 0
        mine, pdf = pdf[own], pdf[~own]
        read = lambda c, t: np.concatenate([np.zeros(0, t), *[np.frombuffer(x, t) for x in pdf[c]]])
        doc, h, rank = read("docs", "<u4"), read("shingles", "<u8"), read("ranks", "u1")
        if len(mine):
            often, often_ranks = read("often", "<u8"), read("often_ranks", "u1")
            order = np.argsort(often)
            number = np.frombuffer(mine["often_ranks"].iloc[0], "<u4")
            theirs = np.repeat(np.frombuffer(mine["docs"].iloc[0], "<u4"), np.frombuffer(mine["counts"].iloc[0], "<u4"))
            doc, h, rank = np.concatenate([doc, theirs]), np.concatenate([h, often[order][number]]), np.concatenate([rank, often_ranks[order][number]])
        may = (np.bincount(doc, minlength=len(n)) >= -(-percent * n // 100)) & (n > 0)
        keep = may[doc]
        doc, h, rank = doc[keep], h[keep], rank[keep]
        order = np.lexsort((h, rank, doc))
        doc, h = doc[order], h[order]
        cut = np.searchsorted(doc, np.arange(len(n) + 1)).tolist()
        raw, m = h.astype("<u8").tobytes(), may.tolist()
        own = [raw[8 * a : 8 * b] if k else None for a, b, k in zip(cut, cut[1:], m, strict=False)]
        # Equal sets have all their shingles in common; a set with a shingle of its own is a class of its own.
        block = int(known["block"])
        names = [b"" if x is None or len(x) == 8 * size else b"%d %d" % (block, i) for i, (x, size) in enumerate(zip(own, n.tolist(), strict=True))]
        keys = [None if x is None else hashlib.blake2b(np.sort(np.frombuffer(x, "<u8")).tobytes() + name, digest_size=16).digest() for x, name in zip(own, names, strict=True)]
        return pd.DataFrame({"id": pd.arrays.IntegerArray(ids.astype(np.int64), null.copy()), "n": n, "key": keys, "shingles": own})

    return run


class _Index:
    """Lists of the sets that hold each prefix shingle, in blocks by set size and position."""

    BLOCK = 32

    def __init__(self, n: np.ndarray, lengths: np.ndarray, token: np.ndarray, percent: int):
        self.n, self.percent = n, percent
        starts = np.cumsum(lengths) - lengths
        self.rare = n - lengths  # shingles of no other document come first in the order
        self.prefix = np.maximum(0, np.minimum(lengths, n - needed_alone(n, percent) + 1 - self.rare))
        place = np.arange(len(token)) - np.repeat(starts, lengths)
        doc = np.repeat(np.arange(len(n)), lengths)
        mine = place < self.prefix[doc]
        token, doc, place = token[mine], doc[mine], (place + self.rare[doc])[mine]
        order = np.lexsort((place, n[doc], token))
        self.token, self.doc, self.place = token[order], doc[order], place[order]
        self.size = n[self.doc]
        # Blocks end where a token's list ends.
        new = np.diff(self.token, prepend=-1) != 0
        in_list = np.arange(len(self.token)) - np.maximum.accumulate(np.where(new, np.arange(len(self.token)), 0))
        self.first = np.flatnonzero(in_list % self.BLOCK == 0)
        self.block_token = self.token[self.first]
        if len(self.first):
            self.least_place = np.minimum.reduceat(self.place, self.first)
            self.least_size, self.most_size = np.minimum.reduceat(self.size, self.first), np.maximum.reduceat(self.size, self.first)
            self.end = np.append(self.first[1:], len(self.token))

    def probe(self, x: int, tokens: np.ndarray) -> np.ndarray:
        """Sets that may link with set x; tokens: its prefix in order."""
        n = int(self.n[x])
        low, high = -(-n * self.percent // 100), n * 100 // self.percent
        a, b = np.searchsorted(self.block_token, tokens, "left"), np.searchsorted(self.block_token, tokens, "right")
        count = b - a
        block = K.gathered(np.arange(len(self.first)), a, count)
        place = np.repeat(np.arange(len(tokens)) + self.rare[x], count)
        # No set in a block has more left after its shingle than its largest size and least position allow.
        left = np.minimum(n - place, self.most_size[block] - self.least_place[block])
        most = np.maximum(self.least_size[block], low)
        keep = (self.most_size[block] >= low) & (self.least_size[block] <= high) & (left >= needed(n, most, self.percent))
        block, place = block[keep], place[keep]
        count = self.end[block] - self.first[block]
        entry = K.gathered(np.arange(len(self.token)), self.first[block], count)
        place = np.repeat(place, count)
        left = np.minimum(n - place, self.size[entry] - self.place[entry])
        fits = (self.size[entry] >= low) & (self.size[entry] <= high) & (left >= needed(n, self.size[entry], self.percent))
        return np.unique(self.doc[entry[fits]])


def needed_alone(n: np.ndarray, percent: int) -> np.ndarray:
    """Least intersection of a set of n shingles with any set that it links with."""
    return -(-percent * n // 100)


def resolved(n: np.ndarray, lengths: np.ndarray, shingle: np.ndarray, percent: int, asked: np.ndarray | None = None, root: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between sets that connect all sets which links connect; asked: only links of these sets are needed.
    root: sets with equal numbers are connected already.

    n: sizes of the whole sets; shingle: the shared shingles of all sets, one set after the other, rare ones first.
    """
    m = len(n)
    if m < 2:
        return []
    token = np.unique(shingle, return_inverse=True)[1]
    starts = np.cumsum(lengths) - lengths
    doc = np.repeat(np.arange(m), lengths)
    by_token = np.argsort(token, kind="stable")
    lists, list_at = doc[by_token], np.searchsorted(token[by_token], np.arange(int(token.max(initial=-1)) + 2))
    index = _Index(n, lengths, token, percent)
    tokens = lambda x: token[starts[x] : starts[x] + lengths[x]]
    root = np.arange(m) if root is None else np.unique(root, return_inverse=True)[1]
    done = np.zeros(m, bool) if asked is None else ~asked
    links: list[tuple[int, int]] = []
    answered: dict[int, np.ndarray] = {}
    like = np.full(m, -1)
    mark = np.zeros(len(list_at), bool)

    def of_lists(t: np.ndarray) -> np.ndarray:
        return np.bincount(K.gathered(lists, list_at[t], list_at[t + 1] - list_at[t]), minlength=m)

    def connect(x: int, others: np.ndarray) -> None:
        for r in np.unique(root[others]).tolist():
            if r != root[x]:
                links.append((x, int(others[root[others] == r][0])))
                root[root == r] = root[x]

    while True:
        waiting = np.flatnonzero(~done)
        if asked is None and len(waiting):
            # All sets outside of the largest class must be answered; within it no link is missing then.
            largest = np.bincount(root).argmax()
            waiting = waiting[root[waiting] != largest] if done.any() else waiting[[len(waiting) // 2]]
        if not len(waiting):
            return links
        x = int(waiting[0])
        done[x] = True
        mine = tokens(x)
        r = int(like[x])
        if r in answered:
            other = tokens(r)
            gone, new = np.setdiff1d(other, mine), np.setdiff1d(mine, other)
            overlap = answered[r] + of_lists(new) - of_lists(gone)
            linked = np.flatnonzero(overlap >= needed(n[x], n, percent))
        else:
            candidates = index.probe(x, mine[: index.prefix[x]])
            candidates = candidates[root[candidates] != root[x]]
            if not len(candidates):
                continue
            if len(candidates) > m // 4 or len(answered) < 1:
                overlap = of_lists(mine)
                linked = np.flatnonzero(overlap >= needed(n[x], n, percent))
                if len(answered) < PIVOTS:
                    answered[x] = overlap
                    near = linked[(n[linked] + n[x] - 2 * overlap[linked]) * 4 <= n[linked]]
                    like[near] = x
            else:
                mark[mine] = True
                sizes = lengths[candidates]
                at = np.cumsum(sizes) - sizes
                overlap = np.add.reduceat(mark[K.gathered(token, starts[candidates], sizes)].astype(np.int64), at)
                mark[mine] = False
                linked = candidates[overlap >= needed(n[x], n[candidates], percent)]
        connect(x, linked[linked != x])


def prefix_of(shared: np.ndarray, n: int, percent: int) -> np.ndarray:
    """The rarest shingles of a set of n, of which any set that it links with has one among its own."""
    return shared[: max(0, n - int(needed_alone(n, percent)) + 1 - (n - len(shared)))]


def band_of(n: np.ndarray, percent: int) -> np.ndarray:
    """Bands of set sizes: sets that may link are in one band or in neighbouring ones."""
    return np.floor(np.log(n) / np.log(100.1 / percent)).astype(np.int64)


CHAINS = "bucket int, h binary, bands binary, nodes binary, least binary, most binary, a binary, b binary"


def _chains(percent: int, buckets: int, most: int = 500_000):
    """Prefix shingles of all classes, joined within the task and packed by bucket, and then edges that cluster classes."""
    from quire.llm.components import forest

    shift = np.uint64(64 - (buckets - 1).bit_length()) if buckets > 1 else None
    fields = [f.split()[0] for f in CHAINS.split(", ")]

    def joined(h: np.ndarray, band: np.ndarray, node: np.ndarray, least: np.ndarray, largest: np.ndarray):
        """One entry for each shingle and band, and the edges of all others with it."""
        order = np.lexsort((node, band, h))
        h, band, node, least, largest = h[order], band[order], node[order], least[order], largest[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (band[1:] != band[:-1])
        first = np.flatnonzero(new)
        head = node[first[np.cumsum(new) - 1]] if len(h) else node
        other = head != node
        if len(first):
            least, largest = np.minimum.reduceat(least, first), np.maximum.reduceat(largest, first)
        return (h[first], band[first], node[first], least, largest), (node[other], head[other])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def handed_on() -> pa.RecordBatch:
            h, node, n = (np.concatenate([x[k] for x in held]) for k in range(3))
            (h, band, node, least, largest), (a, b) = joined(h, band_of(n, percent), node, n, n)
            a, b = forest(a, b)
            bucket = (K.mixed(h) >> shift).astype(np.int64) if shift is not None else np.zeros(len(h), np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
            columns = [h, band, node, least, largest]
            rows = [(k, *[x[order[i:j]].astype("<u8").tobytes() for x in columns], b"", b"") for k, (i, j) in enumerate(zip(cut, cut[1:], strict=False)) if j > i]
            # Edges go with any bucket: each bucket's are passed on.
            for k, (i, j) in enumerate(zip(range(0, len(a), 65536), range(65536, len(a) + 65536, 65536), strict=False)):
                rows.append(((int(a[0]) + k) % buckets, *[b""] * 5, a[i:j].astype("<i8").tobytes(), b[i:j].astype("<i8").tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), *[pa.binary()] * 7))], names=fields)

        for batch in batches:
            node, n = batch.column("node").to_numpy(), batch.column("n").to_numpy()
            prefix = [prefix_of(np.frombuffer(x, "<u8"), k, percent) for x, k in zip(batch.column("shingles").to_pylist(), n.tolist(), strict=True)]
            count = [len(p) for p in prefix]
            held.append((np.concatenate([np.zeros(0, np.uint64), *prefix]), np.repeat(node, count), np.repeat(n, count)))
            if sum(len(x[0]) for x in held) > most:
                yield handed_on()
                held = []
        if held:
            yield handed_on()

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        read = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in pdf[c]])
        (h, band, node, least, largest), (a, b) = joined(read("h", "<u8"), *(read(c, "<i8") for c in ("bands", "nodes", "least", "most")))
        # Neighbouring bands are joined where their nearest sizes may link.
        near = np.flatnonzero((h[1:] == h[:-1]) & (band[1:] == band[:-1] + 1) & (100 * largest[:-1] >= percent * least[1:]) & (node[1:] != node[:-1]))
        a, b = forest(np.concatenate([a, node[near], read("a", "<i8")]), np.concatenate([b, node[near + 1], read("b", "<i8")]))
        return pd.DataFrame({"a": a, "b": b})

    return emit, chain


def _grouped(classes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the nodes of each group of (grp, node, n, shingles, asked, root) rows; a task holds one group."""

    def links_of(g: list[tuple]) -> list[tuple[int, int]]:
        # A set that is asked and also one of the others comes once.
        rows: dict[int, tuple] = {}
        for r in g:
            if r[0] not in rows or r[3]:
                rows[r[0]] = r
        if len(rows) < 2:
            return []
        node = list(rows)
        sets = [np.frombuffer(r[2], "<u8") for r in rows.values()]
        n = np.array([r[1] for r in rows.values()], np.int64)
        asked = np.array([bool(r[3]) for r in rows.values()])
        found = resolved(n, np.fromiter(map(len, sets), np.int64, len(sets)), np.concatenate(sets), percent, None if asked.all() else asked, np.array([r[4] for r in rows.values()], np.int64))
        return [(node[a], node[b]) for a, b in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in ("grp", "node", "n", "shingles", "asked", "root")], strict=True))
        batch = lambda: pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
        for _, group in groupby(rows, key=lambda r: r[0]):
            out += links_of([r[1:] for r in group])
            if len(out) >= 100_000:
                yield batch()
                out.clear()
        yield batch()

    rows = classes.select("grp", "node", "n", "shingles", "asked", "root").repartition("grp").sortWithinPartitions("grp")
    return rows.mapInArrow(common.tidied(run), "a long, b long")


def _signed(rows: DataFrame, percent: int) -> DataFrame:
    """(cluster, node, n, shingles) rows with the band of their size and ROUNDS least hashes of their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.frombuffer(x, "<u8") for x in b.column("shingles").to_pylist()]
            least = [[int(K.mixed(s + np.uint64(k + 1)).min() >> np.uint64(1)) if len(s) else 0 for s in sets] for k in range(ROUNDS)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(band_of(b.column("n").to_numpy(), percent)), *[pa.array(x, pa.int64()) for x in least]], names=[*b.schema.names, "band", *[f"least{k}" for k in range(ROUNDS)]])

    return rows.mapInArrow(common.tidied(run), f"cluster long, node long, n long, shingles binary, band long, {', '.join(f'least{k} long' for k in range(ROUNDS))}")


def _dealt(rows: DataFrame, key: list[Column], chunk_sets: int, chunk_shingles: int, deal: int) -> DataFrame:
    """Rows with grp: those of one key together, or in several parts where they are too many, others in each deal."""
    rows = rows.withColumn("__key", F.xxhash64(*key))
    per = rows.groupBy("__key").agg(F.ceil(F.greatest(F.count(F.lit(1)) / chunk_sets, F.sum(F.octet_length("shingles")) / (8 * chunk_shingles))).cast("long").alias("__parts"))
    return rows.join(per, "__key").withColumn("grp", F.xxhash64("__key", F.pmod(F.xxhash64("node", F.lit(7 + deal)), "__parts"))).drop("__key", "__parts")


def _tokens(rows: DataFrame, percent: int) -> DataFrame:
    """(cluster, token, n, grp, node): one row for each prefix shingle of the (cluster, node, n, shingles, grp) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 4 << 20):
            prefix = [prefix_of(np.frombuffer(x, "<u8"), k, percent) for x, k in zip(b.column("shingles").to_pylist(), b.column("n").to_pylist(), strict=True)]
            row = pa.array(np.repeat(np.arange(b.num_rows), [len(p) for p in prefix]))
            token = pa.array(np.concatenate([np.zeros(0, np.uint64), *prefix]).view(np.int64))
            yield pa.RecordBatch.from_arrays([token, *[b.column(c).take(row) for c in ("cluster", "n", "grp", "node")]], names=["token", "cluster", "n", "grp", "node"])

    return rows.select("cluster", "node", "n", "shingles", "grp").mapInArrow(common.tidied(run), "token long, cluster long, n long, grp long, node long")


def _links(classes: DataFrame, percent: int, tasks: int, chunk_sets: int, chunk_shingles: int, one_task: int | None) -> DataFrame:
    """Links that connect all classes (node, n, shingles) which links connect."""
    kw = {} if one_task is None else {"one_task": one_task}
    emit, chain = _chains(percent, tasks)
    packed = classes.mapInArrow(common.tidied(emit), CHAINS)
    clusters = components(packed.groupBy("bucket").applyInPandas(common.tidied(chain), "a long, b long"), **kw).withColumnRenamed("root", "cluster")
    sized = common.stored(classes.join(clusters, "node"), "clusters")
    per = sized.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets"), F.sum(F.octet_length("shingles") / 8).alias("held"))
    large = common.stored(per.where((F.col("sets") > chunk_sets) | (F.col("held") > chunk_shingles)).select("cluster", F.ceil(F.greatest(F.col("sets") / chunk_sets, F.col("held") / chunk_shingles)).cast("long").alias("chunks")), "large")
    alone = {"asked": F.lit(True), "root": F.col("node")}
    small = sized.join(large, "cluster", "left_anti").withColumn("grp", F.col("cluster")).withColumns(alone)
    links = common.stored(_grouped(small, percent), "links")
    if large.isEmpty():
        return links
    mine = common.stored(_signed(sized.join(large, "cluster").select("cluster", "node", "n", "shingles"), percent), "signed")
    for k in range(ROUNDS):
        by_least = mine.join(large, "cluster").withColumn("deal", F.pmod(f"least{k}", "chunks"))
        dealt = _dealt(by_least, [F.col("cluster"), F.col("deal")], chunk_sets, chunk_shingles, k)
        links = common.stored(links.unionByName(_grouped(dealt.withColumns(alone), percent)), f"links-{k}")
    # Sets outside of each cluster's largest class meet all sets that share a prefix shingle with them.
    roots = mine.join(large, "cluster").join(components(links, **kw), "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_band = [F.col("cluster"), F.col("band"), F.pmod("least0", "chunks")]
    dealt = common.stored(_dealt(roots, by_band, chunk_sets, chunk_shingles, ROUNDS).select("cluster", "node", "n", "shingles", "grp", "root"), "dealt")
    counts = dealt.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("k"))
    largest = counts.groupBy("cluster").agg(F.max(F.struct("k", "root")).alias("m")).select("cluster", F.col("m.root").alias("largest"))
    outside = common.stored(dealt.join(largest, "cluster").where("root <> largest").drop("largest"), "outside")
    if outside.isEmpty():
        return links
    held = _tokens(dealt, percent).groupBy("cluster", "token", F.col("grp").alias("to")).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    asking = _tokens(outside, percent).select("cluster", "token", "node", F.col("n").alias("own"))
    alike = (100 * F.col("most") >= percent * F.col("own")) & (100 * F.col("own") >= percent * F.col("least"))
    routes = common.stored(asking.join(held, ["cluster", "token"]).where(alike).select("node", "to").distinct(), "routes")
    parts = routes.groupBy("to").agg(F.ceil(F.count(F.lit(1)) / chunk_sets).cast("long").alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts"))
    asked = outside.drop("grp").join(routes, "node").join(parts, "to").withColumn("grp", F.xxhash64("to", part)).withColumn("asked", F.lit(True))
    rest = dealt.join(parts.withColumnRenamed("to", "grp"), "grp").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rest = rest.withColumn("grp", F.xxhash64("grp", "part")).withColumn("asked", F.lit(False))
    columns = ["grp", "node", "n", "shingles", "asked", "root"]
    return common.stored(links.unionByName(_grouped(asked.select(*columns).unionByName(rest.select(*columns)), percent)), "links-last")


def near_join(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", chunk_sets: int = CHUNK_SETS, chunk_shingles: int = CHUNK_SHINGLES, one_task: int | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the smallest id that links reach, itself included."""
    spark = common.session(docs)
    common.bounded_batches(spark)
    tasks = 1 << (common.partitions_for(spark) - 1).bit_length()
    rows = common.texts_of(docs, id_col, text_col)
    whole = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = min(BUCKETS[1], max(BUCKETS[0], tasks, 1 << (-(-whole // BUCKET_BYTES)).bit_length()))
    width = masked(np.zeros(0, np.uint64), buckets)[1]
    shared = _blocks(rows, size, buckets).groupBy("bucket").applyInPandas(common.tidied(_shared(width)), SHARED)
    known = common.stored(shared.groupBy("block").applyInPandas(common.tidied(_settled(percent)), "id long, n long, key binary, shingles binary"), "sets")
    per = known.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    classes = common.stored(per.withColumn("node", F.monotonically_increasing_id()), "classes")
    tasks = max(tasks, min(1 << 20, buckets // 4))
    links = _links(classes.select("node", "n", "shingles"), percent, tasks, chunk_sets, chunk_shingles, one_task)
    roots = components(links, **({} if one_task is None else {"one_task": one_task}))
    named = classes.select("key", "node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    found = named.join(least, "root").select(F.col("key").alias("of"), "component")
    joined = known.select("id", "n", "key").join(found, F.col("key") == F.col("of"), "left")
    return joined.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with their component's smallest id, with all their columns. Rows that share an id stay together."""
    found = near_join(docs, size, percent, id_col, text_col)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__stay"))
    return docs.join(stay, F.col(id_col).eqNullSafe(F.col("__stay")), "left_semi")


NEAR_JOIN_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, (SELECT min(b) FROM r WHERE a = doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id)
"""
