"""Quality scores by a factorisation machine.

Features are a text's words, hashed, and statistics of its structure. All pairs of features interact through
vectors of low rank; the sum over pairs is half the difference of a squared sum and a sum of squares, so a
score takes time in proportion to the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import own_columns
from tessera.llm.text import Words, chunks, rolling

BUCKETS, RANK = 1 << 13, 8
TRAIN_ROWS = 6000
THRESHOLD = 0.3

#: Classes of bytes that are counted, by their members.
CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "line": (10,), "blank": (9, 11, 12, 13, 32),
    "stop": b".?;:", "comma": b",", "call": b"!", "bar": b"|", "symbol": b"#$%&*^~=+<>{}[]\\_", "quote": b"\"'()`-", "slash": b"/@", "wide": range(128, 256),
}
_CLASS = np.full(256, len(CLASSES), np.int64)
for _k, _members in enumerate(CLASSES.values()):
    _CLASS[list(_members)] = _k
STATS = len(CLASSES) + 8


def _statistics(found: Words, i: int, distinct: int, most: int) -> np.ndarray:
    """Shares of byte classes, then length, variety and repetition of words; no text has none of them undefined."""
    data = found.data[found.bounds[i] : found.bounds[i + 1]]
    a, b = found.offsets[i : i + 2].tolist()
    n, size = b - a, max(len(data), 1)
    out = np.zeros(STATS)
    out[: len(CLASSES)] = np.bincount(_CLASS[data], minlength=len(CLASSES) + 1)[: len(CLASSES)] / size
    width = (found.ends[a:b] - found.starts[a:b]).astype(float)
    runs = rolling(found.hashes[a:b], 4)
    lines = out[3] * size
    out[len(CLASSES) :] = (
        np.log1p(n),
        np.log1p(len(data)),
        width.mean() / 10 if n else 0,
        min(width.max() / 100, 1) if n else 0,
        distinct / np.sqrt(n) / 10 if n else 0,
        distinct / n if n else 0,
        most / n if n else 0,
        len(np.unique(runs)) / len(runs) if len(runs) else 1,
    )
    out[3] = lines / max(n, 1)
    return out


def features(found: Words, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the i-th text's words, their weights (damped counts of unit length), and its statistics."""
    a, b = found.offsets[i : i + 2].tolist()
    words, counts = np.unique(found.hashes[a:b], return_counts=True)
    weight = np.log1p(counts)
    bucket, inverse = np.unique((words >> np.uint64(40)).astype(np.int64) % BUCKETS, return_inverse=True)
    weight = np.bincount(inverse, weight, minlength=len(bucket))
    norm = np.sqrt((weight**2).sum())
    return bucket.astype(np.int32), weight / norm if norm else weight, _statistics(found, i, len(words), int(counts.max(initial=0)))


@dataclass
class Machine:
    bias: float
    linear: np.ndarray  # words, then statistics
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def score(self, bucket: np.ndarray, weight: np.ndarray, stats: np.ndarray) -> float:
        x = np.concatenate([weight, np.clip((stats - self.centre) / self.scale, -6, 6)])
        at = np.concatenate([bucket, np.arange(BUCKETS, BUCKETS + STATS)])
        v = self.factors[at] * x[:, None]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        z = self.bias + float(self.linear[at] @ x) + pairs
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def train(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.08, decay: float = 2e-4, seed: int = 5) -> Machine:
    """Logistic loss, AdaGrad; with one class or no rows, the machine knows only the share of ones (a half without rows)."""
    width, rng = BUCKETS + STATS, np.random.default_rng(seed)
    share = (float(labels.sum()) + 1) / (len(labels) + 2)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(width), np.zeros((width, RANK)), np.zeros(STATS), np.ones(STATS))
    if not len(labels) or labels.min() == labels.max():
        return m
    stats = np.stack([r[2] for r in rows])
    m.centre, m.scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    stats = np.clip((stats - m.centre) / m.scale, -6, 6)
    own = np.arange(BUCKETS, width)
    at = [np.concatenate([r[0], own]) for r in rows]
    xs = [np.concatenate([r[1], s]) for r, s in zip(rows, stats, strict=True)]
    m.factors = rng.normal(0, 0.02, (width, RANK))
    seen_l, seen_f, seen_b = np.full(width, 1e-2), np.full((width, RANK), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            some = order[lo : lo + batch]
            index = np.concatenate([at[k] for k in some])
            x = np.concatenate([xs[k] for k in some])
            sizes = np.array([len(at[k]) for k in some])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            v = m.factors[index] * x[:, None]
            total = np.add.reduceat(v, starts)
            z = m.bias + np.add.reduceat(m.linear[index] * x, starts) + 0.5 * (total**2 - np.add.reduceat(v**2, starts)).sum(axis=1)
            error = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - labels[some]
            each = np.repeat(error, sizes) * x / len(some)
            touched, inverse = np.unique(index, return_inverse=True)
            g = np.bincount(inverse, each, minlength=len(touched)) + decay * m.linear[touched]
            seen_l[touched] += g**2
            m.linear[touched] -= rate * g / np.sqrt(seen_l[touched])
            inner = each[:, None] * (np.repeat(total, sizes, axis=0) - v)
            g = np.stack([np.bincount(inverse, inner[:, k], minlength=len(touched)) for k in range(RANK)], axis=1) + decay * m.factors[touched]
            seen_f[touched] += g**2
            m.factors[touched] -= rate * g / np.sqrt(seen_f[touched])
            seen_b += error.mean() ** 2
            m.bias -= rate * error.mean() / np.sqrt(seen_b)
    return m


def held_out(key: str):
    """Rows that no model learns from: a fifth, by the CRC of the id as text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS) -> Machine:
    """Learns from at most ``rows`` labelled documents outside the held-out fifth, chosen by a hash of the id.

    Null labels and ids are left out; of several labels of one id the smallest counts. The sample is what is
    sent to the driver and the only thing broadcast: ``rows`` bounds both.
    """
    own_columns(documents, key, text)
    own_columns(labels, key, label)
    chosen = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    chosen = chosen.groupBy(F.col(key).alias("id")).agg(F.min(label).cast("int").alias("wanted"))
    chosen = chosen.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(rows)
    sample = documents.select(F.col(key).alias("id"), text).join(F.broadcast(chosen), "id").select("id", text, "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [features(found, i) for _, _, found in chunks(batch.column(1)) for i in range(len(found))]
            packed = [pa.array([r[k].astype(t).tobytes() for r in out], pa.binary()) for k, t in enumerate(("<i4", "<f4", "<f8"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *packed], names=["id", "wanted", "bucket", "weight", "stats"])

    kind = documents.schema[key].dataType.simpleString()
    got = sample.mapInArrow(run, f"id {kind}, wanted int, bucket binary, weight binary, stats binary").collect()
    got.sort(key=lambda r: (r["id"], r["bucket"], r["stats"]))
    rows_ = [(np.frombuffer(r["bucket"], "<i4"), np.frombuffer(r["weight"], "<f4").astype(float), np.frombuffer(r["stats"], "<f8")) for r in got]
    return train(rows_, np.array([float(r["wanted"] == 1) for r in got]))


def scored(documents: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """key, held_out, score (0 to 1), predicted (1 from the threshold on).

    A null text counts as empty, and an empty one has a score too; an empty table has no rows. Rows with equal or null
    keys stay rows of their own; equal texts have equal scores. A text may have any length below 2 GB: a worker holds
    some thirty times its bytes. No other column is read, whatever its name. No shuffle.
    """
    own_columns(documents, key, text)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [machine.score(*features(found, i)) for _, _, found in chunks(batch.column(2)) for i in range(len(found))]
            predicted = [int(s >= threshold) for s in scores]
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array(predicted, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "held_out", "score", "predicted"])

    rows = documents.select(key, held_out(key).alias("held_out"), text)
    return rows.mapInArrow(run, f"`{key}` {kind}, held_out boolean, score double, predicted int")


def accepted(documents: DataFrame, machine: Machine, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, all columns, whose text scores at least ``threshold``.

    Null, empty, repeated and very long texts as in ``scored``; columns of any names are passed on.
    """
    own_columns(documents, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            good = [machine.score(*features(found, i)) >= threshold for _, _, found in chunks(column) for i in range(len(found))]
            yield batch.filter(pa.array(good, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
