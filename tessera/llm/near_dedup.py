"""Near-duplicate components by SetSketch registers.

A document's set of word shingles is reduced to registers: exponentially spaced truncated minima, so that
the sketch of a union is the register-wise maximum and two registers are equal about as often as the sets
are alike. Bands of registers name buckets of candidates; where a bucket holds one pair, the joint
likelihood of its registers drops it if hopeless. The full sets confirm every link.

Copies (equal sets) are one class throughout. Classes that share buckets, directly or through others,
form clusters, and all links lie within clusters. A cluster is dealt by hash over blocks of bounded size;
blocks are compared in themselves and in pairs, by bit sets over the shingles that can be shared at all,
and only links that unite something leave a task. In a cluster of very many blocks, all meet only the first
one; that unites its large families, and what is left to compare are the buckets that still hold several: there,
all but the largest family meet the rest. So no bucket is cut off, no pairs are written out, and a large family of
near copies takes time in proportion to its size.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.graph import components, looked_up
from tessera.llm.shared import own_columns, stored, text_tag
from tessera.llm.text import chunks, mix

REGISTERS, RATE = 128, 20.0
LOG_BASE = float(np.log(1.001))
ROWS = 4
SIGMAS = 6.0
#: Bounds of a block, for memory and for the square of its sets that one task compares.
BLOCK_SHINGLES, BLOCK_SETS = 400_000, 512
#: Clusters of more blocks than these don't compare all pairs of blocks.
MANY = 16
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.arange(REGISTERS)
_SALTS = (_STEPS + 1).astype(np.uint64) * _GOLD
#: The j-th smallest of a set's REGISTERS exponential variables, by intervals of equal probability.
_SPACED = np.append(-np.log1p(-_STEPS / REGISTERS), np.inf)


def registers(hashes: np.ndarray) -> np.ndarray:
    """Register values of a set of distinct 64-bit hashes, two bytes each."""
    low = np.full(REGISTERS, np.inf)
    start, step = (hashes % np.uint64(REGISTERS)).astype(np.int64), (hashes >> np.uint64(8)).astype(np.int64) | 1
    if 0 < len(hashes) <= 64:
        u = (mix(hashes[:, None] + _SALTS) >> np.uint64(11)) * 2.0**-53
        at = (start[:, None] + _STEPS * step[:, None]) % REGISTERS
        np.minimum.at(low, at.ravel(), (_SPACED[:-1] - np.log1p(-u / (REGISTERS - _STEPS))).ravel())
    else:
        for j in range(REGISTERS if len(hashes) else 0):
            if _SPACED[j] >= low.max():
                break
            u = (mix(hashes + _SALTS[j]) >> np.uint64(11)) * 2.0**-53
            np.minimum.at(low, (start + j * step) % REGISTERS, _SPACED[j] - np.log1p(-u / (REGISTERS - j)))
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - (np.log(low) - np.log(RATE)) / LOG_BASE), 0, 65535).astype("<u2")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def _share(x: np.ndarray) -> np.ndarray:
    """Chance that a register of one set exceeds the other's, ``x`` of whose elements it lacks."""
    base = np.exp(LOG_BASE)
    return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / LOG_BASE


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Most likely resemblance of each pair of rows, sizes known; on a grid of steps of 1/64 of what sizes allow."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    grid = np.linspace(0, 1, 65) * np.minimum(u / (1 - u), (1 - u) / u)
    up, down = _share(u - (1 - u) * grid), _share((1 - u) - u * grid)
    tiny = 1e-12
    fit = more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, tiny))
    return grid[np.arange(len(grid)), fit.argmax(axis=1)]


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; a link needs 100 * shared >= ``percent`` * union."""

    words: int = 5
    percent: int = 80

    @property
    def floor(self) -> float:
        t = self.percent / 100
        return t - SIGMAS * (t * (1 - t) / REGISTERS) ** 0.5


def _named(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return np.array([mix(hashes).sum(), mix(hashes ^ _GOLD).sum()], "<u8").tobytes()


def _sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    for _, _, found in chunks(column):
        yield from map(np.unique, found.shingles(words))


def sketches(documents: DataFrame, key: str, text: str, rule: Rule) -> DataFrame:
    """One row per document: id, tag (of the text), n (size of its set), name and registers (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, names, values = [], [], []
            for s in _sets(batch.column(2), rule.words):
                n.append(len(s))
                names.append(_named(s) if len(s) else None)
                values.append(registers(s).tobytes() if len(s) else None)
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(names, pa.binary()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "tag", "n", "name", "registers"])

    rows = documents.select(F.col(key).cast("bigint").alias("id"), text_tag(text).alias("tag"), F.col(text).alias("whole"))
    return rows.mapInArrow(run, "id bigint, tag int, n bigint, name binary, registers binary")


def _likely(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) whose sizes and registers allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, REGISTERS) for k in (2, 4))
            na, nb = (batch.column(k).to_numpy().astype(float) for k in (3, 5))
            yield batch.select([0, 1]).filter(pa.array(estimate(ra, rb, na, nb) >= rule.floor))

    left = classes.select(F.col("node").alias("a"), F.col("registers").alias("ra"), F.col("n").alias("na"))
    right = classes.select(F.col("node").alias("b"), F.col("registers").alias("rb"), F.col("n").alias("nb"))
    both = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * rule.percent)
    return both.select("a", "b", "ra", "na", "rb", "nb").mapInArrow(run, "a bigint, b bigint")


def _members(clusters: DataFrame, classes: DataFrame, documents: DataFrame, key: str, text: str, rule: Rule) -> DataFrame:
    """Full sets of the classes in ``clusters`` (node, cluster), made from a text of each: node, cluster, hashes.

    A class is looked up by its smallest id; of the texts with that id only those of its name count.
    """
    nodes = clusters.join(classes.select("node", "name", F.col("first").alias("id")), "node")
    rows = documents.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("whole")).join(nodes, "id").select("node", "cluster", "name", "whole")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(2).to_pylist()
            for lo, hi, found in chunks(batch.column(3)):
                sets = [np.unique(s) for s in found.shingles(rule.words)]
                right = [i for i, s in enumerate(sets) if len(s) and _named(s) == names[lo + i]]
                part = batch.slice(lo, hi - lo).select([0, 1]).take(pa.array(right, pa.int64()))
                hashes = pa.array([sets[i].tobytes() for i in right], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, hashes], names=["node", "cluster", "hashes"])

    return rows.mapInArrow(run, "node bigint, cluster bigint, hashes binary")


@dataclass
class Block:
    """Some sets of a cluster: their nodes and sizes, bits over the hashes that several of them hold, and the hashes that one holds."""

    nodes: np.ndarray
    sizes: np.ndarray
    common: np.ndarray
    bits: np.ndarray  # (sets, common) of bool, packed along the hashes
    single: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, nodes: list[int], sets: list[np.ndarray]) -> Block:
        sizes = np.array([len(s) for s in sets], np.int64)
        hashes, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        common, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        several = counts > 1
        place = np.cumsum(several) - 1
        bits = np.zeros((len(sets), int(several.sum())), bool)
        met = several[inverse]
        bits[owner[met], place[inverse[met]]] = True
        return cls(np.array(nodes, np.int64), sizes, common[several], np.packbits(bits, axis=1), hashes[~met], owner[~met])

    def over(self, hashes: np.ndarray) -> np.ndarray:
        """Packed bits of every set over ``hashes``."""
        out = np.zeros((len(self.nodes), len(hashes)), bool)
        if len(self.common) and len(hashes):
            at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
            met = self.common[at] == hashes
            out[:, met] = np.unpackbits(self.bits, axis=1, count=len(self.common))[:, at[met]]
        if len(self.single) and len(hashes):
            at = np.minimum(np.searchsorted(hashes, self.single), len(hashes) - 1)
            met = hashes[at] == self.single
            out[self.owner[met], at[met]] = True
        return np.packbits(out, axis=1)

    def hashes(self) -> np.ndarray:
        return np.concatenate([self.common, self.single])


def _words(packed: np.ndarray) -> np.ndarray:
    """Packed bits in 64-bit words."""
    wide = np.zeros((packed.shape[0], -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view(np.uint64)


def _uniting(rows: Block, columns: Block, a: np.ndarray, b: np.ndarray, rule: Rule, same: bool, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between two blocks' sets, or within one, that unite components; ``a`` and ``b`` are their bits over the same hashes.

    ``known`` holds a label for each set, of the rows and then of the columns, equal for those united already.
    """
    n = len(rows.nodes)
    labels = np.arange(n if same else n + len(columns.nodes)) if known is None else known.copy()
    shift, out = 0 if same else n, []
    a, b = _words(a), _words(b)
    for i in range(n):
        lo = i + 1 if same else 0
        if lo >= len(columns.nodes):
            break
        shared = np.bitwise_count(b[lo:] & a[i]).sum(axis=1, dtype=np.int64)
        hit = 100 * shared >= rule.percent * (rows.sizes[i] + columns.sizes[lo:] - shared)
        hit &= labels[shift + lo :] != labels[i]
        for j in np.flatnonzero(hit):
            mine, other = labels[i], labels[shift + lo + j]
            if mine != other:
                labels[labels == other] = mine
                out.append((int(rows.nodes[i]), int(columns.nodes[lo + j])))
    return out


def _sets_of(table: pa.Table) -> dict[int, np.ndarray]:
    """Hashes by node; a node whose text stands in several rows counts once."""
    return {n: np.frombuffer(h.as_buffer(), "<u8") for n, h in zip(table.column("node").to_pylist(), table.column("hashes"), strict=True)}


def _links(members: DataFrame, entries: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) whose components are those of all confirmed links of each cluster."""
    load = F.octet_length("hashes") / 8
    sizes = stored(members.groupBy("cluster").agg(F.greatest(F.ceil(F.sum(load) / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_SETS)).alias("blocks")), compact=True)
    dealt = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    schema = "cluster bigint, block bigint, blocks bigint, a bigint, b bigint, packed binary"
    fields = pa.schema([(n, pa.int64()) for n in ("cluster", "block", "blocks", "a", "b")] + [("packed", pa.binary())])

    def rows(cluster: int, block: int, blocks: int, found: list[tuple[int, int]], packed: bytes | None) -> pa.Table:
        out = [(cluster, block, blocks, a, b, None) for a, b in found] + [(cluster, block, blocks, None, None, packed)] * (packed is not None)
        return pa.table(list(map(list, zip(*out, strict=True))) or [[]] * 6, schema=fields)

    def inside(table: pa.Table) -> pa.Table:
        sets = _sets_of(table)
        cluster, block, blocks = (table.column(c)[0].as_py() for c in ("cluster", "block", "blocks"))
        nodes = sorted(sets)
        one = Block.of(nodes, [sets[n] for n in nodes])
        return rows(cluster, block, blocks, _uniting(one, one, one.bits, one.bits, rule, True), pickle.dumps(one) if blocks > 1 else None)

    def between(table: pa.Table) -> pa.Table:
        x, y = (pickle.loads(p) for p in sorted(table.column("packed").to_pylist()))
        hashes = np.intersect1d(x.hashes(), y.hashes(), assume_unique=True)
        found = _uniting(x, y, x.over(hashes), y.over(hashes), rule, False)
        return rows(table.column("cluster")[0].as_py(), 0, 0, found, None)

    first = stored(dealt.select("cluster", "block", "blocks", "node", "hashes").groupBy("cluster", "block").applyInArrow(inside, schema))
    last = F.col("blocks") - 1
    others = F.when((F.col("blocks") <= MANY) | (F.col("block") == 0), F.sequence(F.lit(0).cast("bigint"), last)).otherwise(F.array(F.lit(0).cast("bigint")))
    pairs = first.where("packed is not null").select("cluster", "block", "packed", F.explode(others).alias("other")).where("block <> other")
    pairs = pairs.select("cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "packed")
    # A block that no node fell into has no partner row.
    whole = pairs.groupBy("cluster", "lo", "hi").agg(F.count("*").alias("n")).where("n = 2").select("cluster", "lo", "hi")
    second = pairs.join(whole, ["cluster", "lo", "hi"]).groupBy("cluster", "lo", "hi").applyInArrow(between, schema)
    found = first.where("a is not null").select("a", "b").unionByName(second.select("a", "b"))
    large = sizes.where(F.col("blocks") > MANY).select("cluster")
    if large.isEmpty():
        return found
    found = stored(found)
    return found.unionByName(_open_buckets(members.join(large, "cluster", "left_semi").select("node", "hashes"), entries, found, rule))


def _open_buckets(members: DataFrame, entries: DataFrame, known: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between ``members`` (node, hashes) that share a bucket of ``entries`` (node, band), but no component of the ``known`` links.

    Of each bucket that still holds several components, the sets outside the largest one meet all others.
    """
    members = members.dropDuplicates(["node"])
    united = components(known).select("node", F.col("component").alias("label"))
    held = members.select("node").join(united, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    held = stored(entries.join(held, "node").select("band", "node", "label"))
    each = held.groupBy("band", "label").agg(F.count("*").alias("n"))
    buckets = each.groupBy("band").agg(F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("families")).where("families > 1")
    blocks = lambda n: F.ceil(n / BLOCK_SETS)
    buckets = stored(buckets.select("band", F.col("most.label").alias("most"), blocks(F.col("all")).alias("blocks"), blocks(F.col("all") - F.col("most.n")).alias("rests")))
    held = held.join(buckets, "band").withColumn("spread", F.xxhash64("node"))
    numbers = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    block, rest = F.pmod("spread", "blocks"), F.pmod("spread", "rests")
    whole = held.select("band", block.alias("block"), F.explode(numbers(F.col("rests"))).alias("rest"), F.lit(False).alias("rare"), "node", "label")
    rare = held.where("label <> most").select("band", F.explode(numbers(F.col("blocks"))).alias("block"), rest.alias("rest"), F.lit(True).alias("rare"), "node", "label")
    met = whole.unionByName(rare).join(members, "node")

    def run(table: pa.Table) -> pa.Table:
        label, rare_ = dict(zip(table.column("node").to_pylist(), table.column("label").to_pylist(), strict=True)), table.column("rare")
        sides = [_sets_of(table.filter(pa.compute.equal(rare_, side))) for side in (True, False)]
        if not all(sides):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        x, y = (Block.of(sorted(s), [s[n] for n in sorted(s)]) for s in sides)
        hashes = np.intersect1d(x.hashes(), y.hashes(), assume_unique=True)
        labels = np.unique([label[n] for n in [*x.nodes.tolist(), *y.nodes.tolist()]], return_inverse=True)[1]
        links = _uniting(x, y, x.over(hashes), y.over(hashes), rule, False, labels)
        return pa.table({n: pa.array([pair[k] for pair in links], pa.int64()) for k, n in enumerate("ab")})

    return met.groupBy("band", "block", "rest").applyInArrow(run, "a bigint, b bigint")


def _grouped(documents: DataFrame, rule: Rule, key: str, text: str) -> DataFrame:
    """Every row's id, tag, n, component (a number; null where it is linked with nothing) and least (smallest id of its copies and links)."""
    rows = stored(sketches(documents, key, text, rule))
    usable = (F.col("n") > 0) & F.col("id").isNotNull()
    # Classes get numbers of their own: an id may belong to several of them.
    classes = rows.where(usable).groupBy("name", "n", "registers").agg(F.min("id").alias("first"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()))
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(REGISTERS // ROWS - 1)),
        lambda k: F.xxhash64(F.substring(F.col("registers"), k * (2 * ROWS) + 1, F.lit(2 * ROWS)), k),
    )
    entries = classes.select("node", F.explode(bands).alias("band"))
    shared = entries.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.count("*").alias("size"))
    shared = stored(shared.where("size > 1"), compact=True)
    # The one pair of a small bucket may be dropped; in a larger one, classes unlike the smallest may be like each other.
    pairs = stored(_likely(shared.where("size = 2 and hub <> last").select(F.col("hub").alias("a"), F.col("last").alias("b")).distinct(), classes, rule))
    more = entries.join(shared.where("size > 2").select("band", "hub"), "band").where("node <> hub")
    pairs = pairs.unionByName(more.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    clusters = stored(components(pairs).select("node", F.col("component").alias("cluster")), compact=True)
    members = stored(_members(clusters, classes, documents, key, text, rule))
    found = stored(components(_links(members, entries, rule)).join(classes.select("node", "name", "first"), "node"), compact=True)

    least = found.groupBy("component").agg(F.min("first").alias("value"), F.count("*").alias("n"))
    united = looked_up(found.select("component", "name"), "component", least, found.count()).select("name", "component", F.col("value").alias("least"))
    named = classes.join(united, "name", "left")
    named = stored(named.select("name", F.coalesce("component", "node").alias("component"), F.coalesce("least", "first").alias("least")), compact=True)
    out = rows.select("id", "tag", "n", F.when(usable, F.col("name")).alias("name")).join(named, "name", "left")
    return out.select("id", "tag", "n", "component", F.coalesce("least", "id").alias("least"))


def near_duplicates(documents: DataFrame, rule: Rule | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id (smallest id reachable), kept.

    Texts without words (null ones too) are linked with nothing; an empty table has no rows. Rows with equal ids are
    documents of their own that share an id, whether their texts are equal or not. A row without id is linked with
    nothing and kept, its component null. Texts may be of any length below 2 GB: a worker holds some twenty times
    the longest text's bytes. Columns beyond the two are not read; ids are integers. Buckets need ROWS equal registers
    in one of REGISTERS / ROWS bands: a pair at the threshold is missed with a chance below 1e-10 at 85 %, 1e-7 at 80 %.
    """
    own_columns(documents, key, text)
    out = _grouped(documents, rule or Rule(), key, text)
    return out.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.col("least").alias("component_id"),
        F.coalesce(F.col("id") == F.col("least"), F.lit(True)).alias("kept"),
    )


def one_of_each(documents: DataFrame, rule: Rule | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents``, columns of any names unchanged, with one row of each near-duplicate component.

    That is the one of the smallest id; of several texts with that id, the one of the smallest tag; of rows that
    repeat an id and its text, any. Rows linked with nothing (null ids, texts without words) all stay.
    """
    own_columns(documents, key, text)
    found = stored(_grouped(documents, rule or Rule(), key, text).where("component is not null"))
    rank = F.row_number().over(Window.partitionBy("component").orderBy("tag"))
    # Only rows of a component's smallest id come together here.
    more = found.where("id = least").select("component", "id", "tag").distinct().withColumn("rank", rank).where("rank > 1")
    gone = found.where("id <> least").select("id", "tag").unionByName(more.select("id", "tag")).distinct()
    linked = F.col(key).isNotNull() & F.coalesce(F.col(text).rlike(r"[^ \t-\r]"), F.lit(False))
    rows = documents.where(linked).select(F.struct(*documents.columns).alias("row"), F.col(key).cast("bigint").alias("id"), text_tag(text).alias("tag"))
    one = rows.groupBy("id", "tag").agg(F.first("row").alias("row"))
    return one.join(gone, ["id", "tag"], "left_anti").select("row.*").unionByName(documents.where(~linked))
