"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are grouped by length, longest first. The longest few hundred, a fixed number, give each query a score
that its k best reach; from it follows how short a candidate may be, so a query is sent only to the buckets of
long enough ones. A bucket stays where it is, packed, and its queries stream past it. There the score wanted and the
bucket's greatest length give the cosine that a candidate must reach; from that either candidates too short for the
query are left out, or those whose partial product over the bucket's strongest coordinates, the rest bounded
by Cauchy-Schwarz, can't get there. What is left is verified with exact integer products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import own_columns

#: Rows of a bucket: at least, at most (for memory), and buckets wanted between.
BUCKET, BUCKET_MOST, BUCKETS = 2048, 1 << 17, 4096
CUTS, SEEDS, FOCUS = 64, 512, 16
#: Scores that are held at once, eight bytes each.
CELLS = 1 << 22
EXACT, LONG = 2.0**53, 2**63 - 1


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Ids, valid vectors (as doubles) and the lengths of their quantised form; null ones and those with null or non-finite components go."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("vec_id"), x.alias("x"), bad.alias("bad"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + F.pow(F.when(F.abs(v) < 2.0**44, F.floor(v * 256).cast("double")).otherwise(v * 256), 2.0)))
    return rows.where(~F.col("bad")).select("vec_id", "x", F.least(norm, F.lit(1e300)).alias("norm"))


def _matrix(rows: list[list[float]]) -> np.ndarray:
    """``floor(256 * x)`` of each component, shorter rows filled up with zeros: as doubles where those are exact, else as Python's integers."""
    dim = max(map(len, rows), default=0)
    x = np.array([[*r, *[0.0] * (dim - len(r))] for r in rows], float).reshape(len(rows), dim)
    if np.abs(x).max(initial=0) < 2.0**44:
        return np.floor(256 * x)
    whole = [[256 * int(v) if abs(v) >= 2.0**44 else math.floor(256 * v) for v in r] for r in x.tolist()]
    return np.array(whole, object).reshape(x.shape)


def _pack(m: np.ndarray) -> tuple[bytes, int]:
    """Bytes of a matrix, and of each component; 0 for numbers of any size."""
    if m.dtype == object:
        return ",".join(map(str, m.flat)).encode(), 0
    most = np.abs(m).max(initial=0)
    width = next(w for w in (2, 4, 8) if w == 8 or most < 2.0 ** (8 * w - 1))
    return m.astype(f"<i{width}").tobytes(), width


def _unpack(data: bytes, width: int, dim: int, rows: int) -> np.ndarray:
    if not width:
        return np.array([int(x) for x in data.split(b",")], object).reshape(rows, dim)
    return np.frombuffer(data, f"<i{width}").astype(float).reshape(rows, dim)


def _real(m: np.ndarray) -> np.ndarray:
    """A matrix as doubles, numbers too large as infinity."""
    return m if m.dtype != object else np.array([float(x) if abs(x) < 1 << 1000 else math.copysign(math.inf, x) for x in m.flat]).reshape(m.shape)


def _lengths(m: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((_real(m) ** 2).sum(axis=1))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of all rows, at the border of 64 bits where they lie beyond; by doubles where every partial sum stays below 2^53."""
    dim = min(a.shape[1], b.shape[1])  # beyond it the shorter one is zero
    a, b = a[:, :dim], b[:, :dim]
    if object not in (a.dtype, b.dtype) and dim * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in r] for r in b.tolist()]
    out = [[max(-LONG - 1, min(LONG, sum(int(x) * y for x, y in zip(r, w, strict=True)))) for w in whole] for r in a.tolist()]
    return np.array(out, np.int64).reshape(len(a), len(b))


def _best(scores: np.ndarray, open_: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k best open scores of each row, ties to smaller ids."""
    if k < scores.shape[1]:
        low = np.where(open_, np.maximum(scores, -LONG), -LONG)
        open_ = open_ & (np.maximum(scores, -LONG) >= -np.partition(-low, k - 1, axis=1)[:, k - 1 : k])
    at, of = np.nonzero(open_)
    order = np.lexsort((ids[of], ~scores[at, of], at))
    at, of = at[order], of[order]
    start = np.searchsorted(at, at)
    first = np.arange(len(at)) - start < k
    return at[first], of[first]


class Bucket:
    """Candidates of similar length, ready to meet queries."""

    def __init__(self, ids: np.ndarray, m: np.ndarray):
        self.ids, self.m = ids, m
        self.length = _lengths(m)
        self.longest = float(self.length.max(initial=0))
        order = np.argsort(-(_real(m) ** 2).sum(axis=0))[: min(FOCUS, m.shape[1])] if m.dtype != object else np.zeros(0, np.int64)
        self.focus = np.sort(order)
        part = m[:, self.focus] if len(self.focus) else np.zeros((len(m), 0))
        self.part = part
        self.rest = np.sqrt(np.maximum(0, self.length**2 - (part**2).sum(axis=1))) if len(self.focus) else self.length

    def open(self, q: np.ndarray, length: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Which candidates may reach the floor of which query; a floor that isn't positive leaves all."""
        out = np.ones((len(q), len(self.ids)), bool)
        with np.errstate(invalid="ignore", over="ignore"):
            slack = 1e-9 * length * self.longest + 1e-6
        bound = (floor > 0) & np.isfinite(floor) & (length > 0) & np.isfinite(slack)
        if not bound.any():
            return out
        least = np.where(bound, (floor - slack) / np.where(length > 0, length, 1), -np.inf)
        long_enough = self.length[None, :] >= least[:, None]
        cosine = np.where(bound, floor / np.maximum(length * self.longest, 1e-300), 0)
        # Length tells candidates apart where the bucket's spread of lengths is wider than the cosine's leeway.
        by_length = ~bound | (long_enough.mean(axis=1) < 0.5) | (cosine < 0.2)
        out = long_enough
        rest = np.flatnonzero(~by_length)
        if len(rest) and len(self.focus) and self.focus[-1] < q.shape[1] and q.dtype != object:
            part = q[np.ix_(rest, self.focus)]
            rest_q = np.sqrt(np.maximum(0, length[rest] ** 2 - (part**2).sum(axis=1)))
            out[rest] &= part @ self.part.T + rest_q[:, None] * self.rest >= (floor - slack)[rest, None]
        return out

    def search(self, qi: np.ndarray, q: np.ndarray, length: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, candidate ids and scores of each query's k best, of those that reach its floor."""
        open_ = self.open(q, length, floor) & (self.ids != qi[:, None])
        rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        scores = _products(q[rows], self.m[columns])
        open_ = open_[np.ix_(rows, columns)] & (scores >= np.where(np.isfinite(floor[rows]), floor[rows], -np.inf)[:, None])
        at, of = _best(scores, open_, self.ids[columns], k)
        return qi[rows][at], self.ids[columns][of], scores[at, of]


_ROW = "bucket bigint, kind int, ids array<bigint>, data binary, width int, dim int, length double, floor double"
_FIELDS = pa.schema(
    [("bucket", pa.int64()), ("kind", pa.int32()), ("ids", pa.list_(pa.int64())), ("data", pa.binary()), ("width", pa.int32()), ("dim", pa.int32()), ("length", pa.float64()), ("floor", pa.float64())]
)


def _asked(queries: DataFrame, seeds: tuple[np.ndarray, np.ndarray], k: int) -> DataFrame:
    """A packed row for each query, with the score that k seeds reach (null if they are fewer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, m = seeds
        for batch in batches:
            out = []
            for qi, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                q = _matrix([x])
                scores = np.sort(_products(q, m)[0][ids != qi])
                data, width = _pack(q)
                out.append((None, 1, [qi], data, width, q.shape[1], float(_lengths(q)[0]), float(scores[-k]) if len(scores) >= k else None))
            columns = list(zip(*out, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FIELDS, strict=True)], schema=_FIELDS)

    return queries.select("vec_id", "x").mapInArrow(run, _ROW)


def _packed(rows: DataFrame) -> DataFrame:
    """One row for each bucket."""

    def run(table: pa.Table) -> pa.Table:
        m = _matrix(table.column("x").to_pylist())
        data, width = _pack(m)
        row = {"bucket": table.column("bucket")[0].as_py(), "kind": 0, "ids": table.column("vec_id").to_pylist(), "data": data, "width": width, "dim": m.shape[1]}
        return pa.Table.from_pylist([row | {"length": None, "floor": None}], schema=_FIELDS)

    return rows.select("bucket", "vec_id", "x").groupBy("bucket").applyInArrow(run, _ROW)


def _met(rows: DataFrame, k: int) -> DataFrame:
    """Streams of buckets, each followed by its queries, to query_id, vec_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, bucket = None, None
        for batch in batches:
            held: list[dict] = []
            for i in range(batch.num_rows):
                if batch.column(0)[i].as_py() != at or not batch.column(1)[i].as_py():
                    yield from answers(bucket, held)
                    held, at, bucket = [], batch.column(0)[i].as_py(), None
                row = {n: batch.column(c)[i].as_py() for c, n in enumerate(batch.schema.names)}
                if not row["kind"]:
                    bucket = Bucket(np.array(row["ids"], np.int64), _unpack(row["data"], row["width"], row["dim"], len(row["ids"])))
                elif bucket is not None:
                    held.append(row)
            yield from answers(bucket, held)

    def answers(bucket: Bucket | None, held: list[dict]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // len(bucket.ids)) if held else 1
        kinds: dict[tuple, list[dict]] = {}
        for r in held:
            kinds.setdefault((r["dim"], not r["width"]), []).append(r)
        for alike in kinds.values():
            for lo in range(0, len(alike), step):
                some = alike[lo : lo + step]
                q = np.concatenate([_unpack(r["data"], r["width"], r["dim"], 1) for r in some])
                floor = np.array([-np.inf if r["floor"] is None else r["floor"] for r in some])
                found = bucket.search(np.array([r["ids"][0] for r in some], np.int64), q, np.array([r["length"] for r in some]), floor, k)
                yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), found, strict=True)})

    return rows.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _grouped(rows: DataFrame, count: int) -> tuple[Column, list[float], list[int]]:
    """Each row's bucket; the lengths at which ranges of buckets end; each range's first bucket, and the number of buckets.

    Ranges are numbered from the longest on. A range of very many rows, equal lengths perhaps, has as many
    buckets as it needs, and rows are dealt over them by their place in the input.
    """
    (found,) = rows.agg(F.percentile_approx("norm", [i / CUTS for i in range(1, CUTS)], 64 * CUTS)).first()
    size = min(BUCKET_MOST, max(BUCKET, -(-count // BUCKETS)))
    wide = max(1, round(CUTS * size / count))
    cuts = sorted(set(found[wide - 1 :: wide]))
    number = sum(((F.col("norm") < F.lit(c)).cast("int") for c in cuts), F.lit(0))
    counts = {r[0]: r[1] for r in rows.groupBy(number.alias("range")).count().collect()}  # CUTS rows at most
    firsts = [0]
    for r in range(len(cuts) + 1):
        firsts.append(firsts[-1] + max(1, -(-counts.get(r, 0) // size)))
    start = F.array(*[F.lit(x).cast("bigint") for x in firsts])
    parts = F.get(start, number + 1) - F.get(start, number)
    return F.get(start, number) + F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), parts), cuts, firsts


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k candidates of highest integer product with each query: query_id, rank, vec_id, score.

    Components x, any finite ones, count as ``floor(256 * x)``; a product that 64 bits can't hold counts as the
    nearest number they can. Ties go to the smaller id. Candidates with the query's own id don't take part, nor does a
    vector that is null, has no id, or holds null or non-finite components; of two vectors of different size the
    shorter is filled up with zeros. Repeated candidate rows count once each, and are dealt over buckets like others;
    of queries with one id the smallest vector is asked. A query with no candidate has no row, nor has an empty
    table. Columns beyond the two are not read.

    Candidates are shuffled twice, once as rows and once packed, never for each query; a query goes to the buckets that may hold one of its k.
    """
    own_columns(candidates, key, vector)
    own_columns(queries, key, vector)
    spark = candidates.sparkSession
    rows = quantised(candidates, key, vector)
    count = rows.count()
    longest = rows.orderBy(F.desc("norm"), "vec_id").limit(SEEDS).select("vec_id", "x").collect()  # SEEDS rows, a fixed number
    if not count:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    seeds = np.array([r["vec_id"] for r in longest], np.int64), _matrix([r["x"] for r in longest])
    asked = _asked(quantised(queries, key, vector).groupBy("vec_id").agg(F.min("x").alias("x")), seeds, k)
    bucket, cuts, firsts = _grouped(rows, count)
    # Candidates of a range are shorter than the cut that it ends at.
    want = F.col("floor") * (1 - 1e-9) - 1e-6
    ranges = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: c * F.col("length") >= want))
    ranges = F.when(F.col("floor").isNull() | (F.col("floor") <= 0), F.lit(len(cuts))).otherwise(ranges)
    last = F.get(F.array(*[F.lit(x).cast("bigint") for x in firsts]), ranges + 1) - 1
    sent = asked.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    both = _packed(rows.withColumn("bucket", bucket.cast("bigint"))).unionByName(sent)
    streams = both.repartition(min(firsts[-1], 1 << 16), "bucket").sortWithinPartitions("bucket", "kind")
    found = _met(streams, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
