"""Packing token sequences: first-fit decreasing with a tournament tree, in randomised groups."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import own_columns

GROUP_BYTES = 8 << 20


class Tournament:
    """Bins in the order of opening; each inner node holds the most room of any bin below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1
        while self.leaves < max(bins, 1):
            self.leaves *= 2
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Takes ``size`` from the first bin with so much room; the bin's number."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bin_ = node - self.leaves
        room[node] -= size
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return bin_


def pack(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length) that hold every unit of every item once.

    Whole multiples of the capacity fill sequences of their own. The rests are packed first-fit
    decreasing. Then the fullest bins with room take units from the emptiest, cutting an item where
    need be, and the one bin left over is split at powers of two, so nothing is padded.
    """
    done, rests = [], []
    for i, n in enumerate(lengths):
        whole = n // capacity * capacity
        done += [[(i, at, capacity)] for at in range(0, whole, capacity)]
        if n > whole:
            rests.append((i, whole, n - whole))
    rests.sort(key=lambda r: (-r[2], r[0]))
    tree, bins = Tournament(len(rests), capacity), []
    for piece in rests:
        at = tree.place(piece[2])
        if at == len(bins):
            bins.append([])
        bins[at].append(piece)
    used = [sum(p[2] for p in b) for b in bins]
    done += [b for b, u in zip(bins, used, strict=True) if u == capacity]
    short = sorted(((u, k) for k, u in enumerate(used) if u < capacity), key=lambda x: (-x[0], x[1]))
    loose, left = [bins[k] for _, k in short], [u for u, _ in short]
    i, j = 0, len(loose) - 1
    while i < j:
        gap = capacity - left[i]
        item, start, size = loose[j].pop()
        take = min(gap, size)
        loose[i].append((item, start + size - take, take))
        if take < size:
            loose[j].append((item, start, size - take))
        left[i] += take
        left[j] -= take
        if left[i] == capacity:
            done.append(loose[i])
            i += 1
        if not left[j]:
            j -= 1
    if i == j and left[i]:
        done += _at_powers(loose[i], left[i])
    return done


def _at_powers(pieces: list[tuple[int, int, int]], total: int) -> Iterator[list[tuple[int, int, int]]]:
    stack = pieces[::-1]
    for bit in reversed(range(total.bit_length())):
        want, out = total & 1 << bit, []
        while want:
            item, start, size = stack.pop()
            take = min(want, size)
            out.append((item, start, take))
            if take < size:
                stack.append((item, start + take, size - take))
            want -= take
        if out:
            yield out


class ByteTokens:
    """Ids of a byte-level BPE file of the tokenizers library, special tokens not added.

    The merges are run by tiktoken, several times as fast, from the same vocabulary: in such a file the
    ids are the merge ranks. A special token's text is that token, as in the library. What its patterns can't
    split (about a million blanks in a row) is encoded by the library itself.
    """

    def __init__(self, path: str):
        import json

        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        # Fixed pattern: the byte-level pre-tokeniser's own.
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.coder = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.coder.encode_to_numpy(text, allowed_special="all"), "<u4")
        except ValueError:
            return np.asarray(_library(self.path).encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


PIECE_SCHEMA = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    key: str = "doc_id",
    text: str = "text",
    group_bytes: int = GROUP_BYTES,
    seed: int = 17,
    with_ids: bool = False,
) -> DataFrame:
    """Packs every document's ids and an end id into sequences of at most ``capacity`` ids.

    One row per piece; with ``with_ids`` the ids follow. Groups are dealt by a seeded hash of key, text and
    place in the input, about ``group_bytes`` of text each, so a group's size follows neither a hot source, nor
    very many equal rows, nor the input's size: a group is that many bytes and perhaps a very long text. The
    input's rows must come in the same order when a lost task is run again, as those of stored tables do. A
    group's number is the upper half of its sequence ids. A null or empty text is the end id only; an empty table
    has no piece. Rows with equal or null keys are documents of their own, equal rows too. A text may have any
    length below 2 GB; of a column named as one of the result's, only the key's and the text's are read. The texts
    are shuffled once; ids are made where they are packed.
    """
    own_columns(documents, key, text)
    kind = documents.schema[key].dataType.simpleString()
    size = documents.agg(F.sum(F.octet_length(text) + F.lit(1).cast("bigint"))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    schema = f"`{key}` {kind}, {PIECE_SCHEMA}" + ", ids array<bigint>" * with_ids

    def run(table: pa.Table) -> pa.Table:
        coder, group = byte_tokens(tokenizer), table.column(0)[0].as_py()
        end = np.array([end_id], "<u4")
        # In an order of their own: what is packed doesn't depend on how rows arrive.
        rows = sorted(zip(table.column(1).to_pylist(), table.column(2).to_pylist(), strict=True), key=lambda r: (r[0] is None, r[0], r[1] or ""))
        ids = [np.concatenate([coder.ids(t or ""), end]) for _, t in rows]
        out = []
        for k, sequence in enumerate(pack([len(x) for x in ids], capacity)):
            at = 0
            for item, start, size in sequence:
                part = ids[item][start : start + size]
                row = (rows[item][0], start, size, zlib.crc32(part.tobytes()), len(ids[item]), (group << 32) + k, at)
                out.append((*row, part.tolist()) if with_ids else row)
                at += size
        names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        types = [table.schema.field(1).type, *[pa.int64()] * 6, pa.list_(pa.int64())]
        columns = list(zip(*out, strict=True))
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=False)})

    dealt = F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col(text), F.monotonically_increasing_id()), F.lit(groups))
    return documents.select(dealt.alias("group"), key, text).groupBy("group").applyInArrow(run, schema)
