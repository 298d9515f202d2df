"""Toxicity scores: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the 4-, 5- and 6-grams of its lower-cased characters, by a 32-bit hash, white space as spaces,
with a space before and after; a feature that occurs n times has value 1 + ln n. From labelled texts, r = log((p / |p|)
/ (q / |q|)), p and q being one plus the numbers of toxic and clean texts with a feature, |p| and |q| two plus the
numbers of texts. Features whose ratio isn't `sure` standard errors above zero are left out. A logistic regression with
an L1 penalty and no negative weights is trained on value times r, so that clean words around a toxic one never lower a
text's score.

The classifier is fitted on a bounded sample: `most_rows` texts, half of each class where there are enough, those with
the smallest hash of their id, as far as the texts of a class take `most_bytes` / 2 in all; a text of more than
`most_bytes` / 32 isn't learned from. Everything else covers all rows: each text is scored whole, in its own task.

Cases: a null or empty text scores as one without features; null labels are left out; an id labelled more than once is
toxic if any of its labels is; without texts of both classes to learn from every score is 0; null ids stay null and are
never held out; repeated rows give repeated rows; an empty table gives an empty result; texts of any length are scored
whole; columns beside id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm.kernels import mixed

ORDERS = (4, 5, 6)
BITS, SIEVE = 32, 22
#: Bounds of the sample that the classifier is fitted on.
MOST_ROWS, MOST_BYTES = 4000, 24 << 20
_A = np.uint64(0x9E3779B97F4A7C15)
_C = np.uint64(0xD6E8FEB86659FD93)
SCORES = "doc_id long, held_out boolean, score double, predicted int"


class Model(NamedTuple):
    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of every n-gram of each order."""
    padded = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    code[np.isin(code, [9, 10, 11, 12, 13, 0xA0])] = 32
    text = np.repeat(np.arange(len(texts), dtype=np.int32), [len(p) for p in padded])
    h = np.zeros(len(code), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        # h[i] covers the n characters that start at i.
        h = h[: len(code) - n + 1] * _A + code[n - 1 :] if len(code) >= n else h[:0]
        if n in ORDERS and len(h):
            inside = np.flatnonzero(text[: len(h)] == text[n - 1 :])
            x = (h[inside] + np.uint64(n)) * _C
            x ^= x >> np.uint64(32)
            yield text[inside], ((x * _A) >> np.uint64(64 - BITS)).astype(np.int64)


def counted_grams(texts: list[str], wanted: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and count of the n-grams, by text and bucket; wanted: sorted buckets, and the sieve that they pass."""
    parts = [np.zeros(0, np.int64)]
    for text, bucket in grams(texts):
        if wanted is not None:
            hit = np.flatnonzero(wanted[1][bucket & ((1 << SIEVE) - 1)])
            found = bucket[hit]
            if len(wanted[0]):
                hit = hit[wanted[0][np.minimum(np.searchsorted(wanted[0], found), len(wanted[0]) - 1)] == found]
            text, bucket = text[hit], bucket[hit]
        parts.append((text.astype(np.int64) << BITS) | bucket)
    pairs = np.sort(np.concatenate(parts))
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    pairs, count = pairs[first], np.diff(first, append=len(pairs))
    return pairs >> BITS, pairs & ((1 << BITS) - 1), count


def value_of(count: np.ndarray) -> np.ndarray:
    return 1 + np.log(count)


def sieve(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    passed = np.zeros(1 << SIEVE, bool)
    passed[buckets & ((1 << SIEVE) - 1)] = True
    return buckets, passed


def unlike(rows: list[np.ndarray], hashes: int = 8, same: int = 3) -> list[int]:
    """Rows that aren't much like an earlier one: by least hashes, of which `same` of 8 stand for copies."""
    seen: list[dict[int, int]] = [{} for _ in range(hashes)]
    kept = []
    for i, r in enumerate(rows):
        own = [int(mixed(r.astype(np.uint64) + np.uint64((k + 1) << 40)).min()) if len(r) else k for k in range(hashes)]
        like: dict[int, int] = {}
        for k, h in enumerate(own):
            if h in seen[k]:
                like[seen[k][h]] = like.get(seen[k][h], 0) + 1
        if not len(r) or max(like.values(), default=0) < same:
            kept.append(i)
            for k, h in enumerate(own):
                seen[k].setdefault(h, i)
    return kept


def _telling(rows: list[np.ndarray], toxic: np.ndarray, sure: float, least: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Buckets, in order, whose ratio is sure to be above zero, and their ratios; in ranges of buckets, to bound memory."""
    n_toxic, n_clean = int(toxic.sum()), int((~toxic).sum())
    edges = np.linspace(0, 1 << BITS, 33).astype(np.int64)
    cuts = [np.searchsorted(r, edges) for r in rows]
    buckets, ratios = [], []
    for k in range(32):
        counts = []
        for side in (True, False):
            mine = [r[c[k] : c[k + 1]] for r, c, t in zip(rows, cuts, toxic.tolist(), strict=True) if t is side]
            counts.append(np.unique(np.concatenate([np.zeros(0, np.uint32), *mine]), return_counts=True))
        (bad, p), (good, q) = counts
        if not len(bad):
            continue
        at = np.minimum(np.searchsorted(good, bad), max(0, len(good) - 1))
        q = 1 + (np.where(good[at] == bad, q[at], 0) if len(good) else 0)
        p = 1 + p
        ratio = np.log(p / (n_toxic + 2)) - np.log(q / (n_clean + 2))
        kept = np.flatnonzero((p + q >= least) & (ratio > sure * np.sqrt(1 / p + 1 / q)))
        buckets.append(bad[kept].astype(np.int64))
        ratios.append(ratio[kept])
    return np.concatenate([np.zeros(0, np.int64), *buckets]), np.concatenate([np.zeros(0), *ratios])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, sure: float = 4.0, penalty: float = 5e-4, steps: int = 600) -> Model:
    """rows: sorted buckets and their counts of each text. Copies among them count once: their words are no signs of their class."""
    kept = unlike([r for r, _ in rows])
    rows, toxic = [rows[i] for i in kept], toxic[kept]
    y = toxic.astype(float)
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    known, ratio = _telling([r for r, _ in rows], toxic, sure)
    if not len(known):
        return Model(known, ratio, float(np.log(y.mean() / (1 - y.mean()))))
    row, col, value = [], [], []
    for i, (bucket, count) in enumerate(rows):
        at = np.searchsorted(bucket, known)
        hit = np.flatnonzero(bucket[np.minimum(at, len(bucket) - 1)] == known) if len(bucket) else np.zeros(0, np.int64)
        row.append(np.full(len(hit), i))
        col.append(hit)
        value.append(ratio[hit] * value_of(count[at[hit]]))
    row, col, value = np.concatenate(row), np.concatenate(col), np.concatenate(value)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    # Proximal gradient steps with momentum; the step follows from the largest squared row.
    rate = 4 / (1 + np.bincount(row, value * value, len(rows)).max())
    w = z = np.zeros(len(known))
    b = zb = 0.0
    t = 1.0
    for _ in range(steps):
        score = np.bincount(row, z[col] * value, len(rows)) + zb
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y) * weight
        g = np.bincount(col, error[row] * value, len(known))
        new = z - rate * len(rows) / 8 * g
        new = np.maximum(0, new - rate * len(rows) / 8 * penalty / 10)
        nb = zb - rate * len(rows) / 8 * error.sum()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, zb = new + (before - 1) / t * (new - w), nb + (before - 1) / t * (nb - b)
        w, b = new, nb
    used = np.flatnonzero(w)
    return Model(known[used], w[used] * ratio[used], float(b))


def _fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3


def sample_of(docs: DataFrame, labels: DataFrame, most_rows: int, most_bytes: int) -> DataFrame:
    """text and toxic of at most about most_rows labelled texts (more only where documents repeat an id)."""
    per = labels.select(F.col("doc_id").cast("long").alias("of"), F.col("toxic").cast("int").alias("toxic")).where("of IS NOT NULL AND toxic IS NOT NULL")
    per = per.groupBy("of").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("of"), F.col("of")]
    halves = [per.where(F.col("toxic") == t).orderBy(*order).limit(most_rows // 2) for t in (0, 1)]
    ids = F.broadcast(halves[0].unionByName(halves[1]))  # at most most_rows rows of 12 bytes
    sizes = docs.join(ids, F.col("id") == F.col("of")).groupBy("of", "toxic").agg(F.sum(F.octet_length("text")).alias("bytes")).where(F.col("bytes") <= most_bytes // 32)
    # The window goes over at most most_rows rows.
    upto = Window.partitionBy("toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    taken = common.stored(sizes.withColumn("upto", F.sum("bytes").over(upto)).where(F.col("upto") <= most_bytes // 2).select("of", "toxic"), "toxicity-sample")
    return docs.join(F.broadcast(taken), F.col("id") == F.col("of")).select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> Model:
    """Model from (id, text) rows and labels (doc_id, toxic). Fitted in one task, on the sample's hashed features."""
    spark = common.session(docs)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 1 << 20):
            row, bucket, count = counted_grams([t or "" for t in b.column("text").to_pylist()])
            cut = np.searchsorted(row, np.arange(b.num_rows + 1)).tolist()
            packed = [[x[i:j].astype("<u4").tobytes() for i, j in zip(cut, cut[1:], strict=False)] for x in (bucket, count)]
            yield pa.RecordBatch.from_arrays([pa.array([0] * b.num_rows, pa.int32()), *[pa.array(x, pa.binary()) for x in packed], b.column("toxic")], names=["one", "buckets", "counts", "toxic"])

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(np.frombuffer(x, "<u4"), np.frombuffer(n, "<u4")) for x, n in zip(pdf["buckets"], pdf["counts"], strict=True)]
        m = fit(rows, pdf["toxic"].to_numpy() > 0)
        return pd.DataFrame([[m.buckets.astype("<i8").tobytes(), m.weights.astype("<f8").tobytes(), m.bias]], columns=["buckets", "weights", "bias"])

    packed = sample_of(docs, labels, most_rows, most_bytes).mapInArrow(common.tidied(features), "one int, buckets binary, counts binary, toxic int")
    found = common.stored(packed.groupBy("one").applyInPandas(common.tidied(fitted), "buckets binary, weights binary, bias double"), "toxicity-model").collect()
    if not found:
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    m = found[0]
    return Model(np.frombuffer(m["buckets"], "<i8"), np.frombuffer(m["weights"], "<f8"), m["bias"])


def _scores(texts: pa.Array, model: Model, wanted: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    row, bucket, count = counted_grams([t or "" for t in texts.to_pylist()], wanted)
    weights = model.weights[np.searchsorted(model.buckets, bucket)] * value_of(count) if len(bucket) else np.zeros(0)
    s = model.bias + np.bincount(row, weights, len(texts))
    return np.exp(-np.logaddexp(0.0, -s))


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of (id, text, held_out) rows."""
    shared = common.session(docs).sparkContext.broadcast(model)
    schema = common.struct(SCORES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sieve(shared.value.buckets)
        for b in common.slices(batches, 1 << 20):
            s = _scores(b.column("text"), shared.value, wanted)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], schema=common.arrow_schema(schema))

    return docs.mapInArrow(common.tidied(run), schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that toxicity() doesn't predict as toxic, with all their columns."""
    common.bounded_batches(common.session(docs))
    model = train(common.texts_of(docs, id_col, text_col), labels.where(_fold(F.col("doc_id")) != 1), most_rows, most_bytes)
    shared = common.session(docs).sparkContext.broadcast(model)
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sieve(shared.value.buckets)
        for b in common.slices(batches, 1 << 20):
            yield b.filter(pa.array(_scores(b.column(column), shared.value, wanted) < threshold))

    return docs.mapInArrow(common.tidied(run), docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on labelled rows outside the held-out third and score every row."""
    common.bounded_batches(common.session(docs))
    rows = common.texts_of(docs, id_col, text_col)
    model = train(rows, labels.where(_fold(F.col("doc_id")) != 1), most_rows, most_bytes)
    return score(rows.withColumn("held_out", F.coalesce(_fold(F.col("id")) == 1, F.lit(False))), model, threshold)
