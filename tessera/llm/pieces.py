"""Offset-preserving SentencePiece encoding and decoding.

The text is normalised here, not in the library: at each position the longest prefix found in the
model's compiled character map is replaced, and every byte written remembers the byte it came from. Between
the bytes that a mapped prefix can begin with, which a search finds at once, text stands for itself; a model whose
map is empty has no such byte, and its text is one such stretch. The library segments the normalised text
only; each piece's byte range there is then projected through the alignment to a range of bytes of the original text.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.shared import own_columns

SPACE = "▁"
# Kinds of pieces in model files.
USER_PIECE, BYTE_PIECE = 4, 6


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes whose leaves point into a pool of C strings."""

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.pool = b""
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.pool = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement of the longest mapped prefix of ``text[at:]`` and that prefix's length."""
        if not self.units:
            return None
        found, node = None, self._step(0, self.units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != text[i]:
                break
            node = self._step(node, unit)
            if unit >> 8 & 1:
                found = (self.units[node] & 0x7FFFFFFF, i + 1 - at)
        if found is None:
            return None
        start, length = found
        return self.pool[start : self.pool.index(b"\0", start)], length

    def begins(self, byte: int) -> bool:
        """May a mapped prefix begin with this byte?"""
        if not self.units:
            return False
        node = self._step(0, self.units[0]) ^ byte
        return node < len(self.units) and self.units[node] & 0x800000FF == byte and byte > 0

    @staticmethod
    def _step(node: int, unit: int) -> int:
        return node ^ (unit >> 10 << ((unit & 0x200) >> 6))


class Normaliser:
    """A model's normalisation, with the source byte of every byte that it writes. ``kept`` are symbols that are never mapped."""

    def __init__(self, spec, kept: Iterable[str] = ()):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.space = (SPACE if spec.escape_whitespaces else " ").encode()
        symbols = sorted((k.encode() for k in kept), key=len, reverse=True)
        firsts = b"".join(re.escape(bytes([b])) for b in range(256) if self.map.begins(b))
        # A mapped prefix may start only at a character's first byte; a symbol goes before it.
        either = [b"(" + b"|".join(map(re.escape, symbols)) + b")" if symbols else b"((?!))", *([b"[" + firsts + b"]"] if firsts else [])]
        self.search = re.compile(b"|".join(either)).search

    def _chunks(self, text: bytes) -> Iterator[tuple[bytes, int, int, bool]]:
        """Replacement, start, end, and whether it is a stretch that stands for itself."""
        at = start = 0
        while m := self.search(text, at):
            at = m.start()
            if m[1]:
                at = m.end()
                continue
            hit = self.map.longest(text, at)
            if hit is None:
                first = text[at]
                at += 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                continue
            if at > start:
                yield text[start:at], start, at, True
            yield hit[0], at, at + hit[1], False
            at = start = at + hit[1]
        if start < len(text):
            yield text[start:], start, len(text), True

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text and, for each of its bytes and its end, the offset in the UTF-8 of ``text``."""
        source = text.encode()
        if not source:
            return "", np.zeros(1, np.int64)
        new, where, after, leading = [], [], [], []
        head, blank = 0, self.squeeze  # the added prefix stands behind white space that is left out
        for put, start, end, own in self._chunks(source):
            n = len(put)
            if blank:
                spaces = n - len(put.lstrip(b" "))
                blank = spaces == n if own else put == b" "
                head = start + spaces if own else end if blank else head
            new.append(put)
            where.append(np.arange(start, end) if own else np.full(n, start))
            # Where the text goes on behind a byte: behind its whole prefix.
            after.append(np.arange(start + 1, end + 1) if own else np.full(n, end))
            leading.append(np.ones(n, bool) if own else np.arange(n) < n - len(put.lstrip(b" ")))
        out = np.frombuffer(b"".join(new), np.uint8)
        where, after, leading = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (where, after, leading))
        end = len(source)
        if self.squeeze:
            blank = out == 32
            keep = ~(blank & leading.astype(bool) & np.append(True, blank[:-1])[: len(out)])
            out, where, after = out[keep], where[keep], after[keep]
            end = int(after[-1]) if len(after) else 0
        width = np.where(out == 32, len(self.space), 1)
        where = np.repeat(where, width)
        whole = out.tobytes().replace(b" ", self.space)
        if self.prefix and (len(where) or not self.squeeze):
            whole, where = self.space + whole, np.concatenate([np.full(len(self.space), head), where])
        put = whole.decode()
        if self.squeeze:
            short = put.rstrip(self.space.decode())
            if len(short) < len(put):
                cut = len(whole) - (len(put) - len(short)) * len(self.space)
                put, where, end = short, where[:cut], int(where[cut])
        return put, np.append(where, end).astype(np.int64)


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            blob = f.read()
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.normalise = Normaliser(proto.normalizer_spec, [p.piece for p in proto.pieces if p.type == USER_PIECE])
        spec = proto.normalizer_spec
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.end = self.library.eos_id()
        self.width = np.array([1 if p.type == BYTE_PIECE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.unknown = self.library.unk_id()
        self.digits = [str(i) for i in range(len(self.width))]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Ids with the end id last, and an (ids, 2) array of byte ranges in the text; the end id's is empty."""
        normal = [self.normalise(t) for t in texts]
        for (text, where), ids in zip(normal, self.segmenter.encode([n[0] for n in normal], num_threads=1), strict=True):
            ends = np.cumsum(self.width[ids]) if ids else np.zeros(0, np.int64)
            if len(ids) and (self.unknown in ids or ends[-1] != len(where) - 1):
                ends = self._ends(text)
            cut = where[np.concatenate([[0], ends])]
            spans = np.stack([cut[:-1], cut[1:]], axis=1)
            ids.append(self.end)
            yield ids, np.concatenate([spans, [[where[-1]] * 2]])

    def _ends(self, text: str) -> np.ndarray:
        """Ends of pieces where an unknown piece's width isn't the vocabulary's."""
        pieces = self.segmenter.encode(text, return_type="proto").pieces
        return np.array(list(accumulate(len(p.surface.encode()) for p in pieces)), np.int64)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(documents: DataFrame, model: str, key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """Encodes and decodes ``text`` of every row.

    Returns key, n_tokens, ids_sha256, decoded_sha256, spans_crc32 (of the little-endian 32-bit byte
    ranges) and, with ``keep``, also ids and their starts and ends. A null text counts as empty, and an
    empty one has the end id only; an empty table has no rows. Rows with equal or null keys stay rows of their own.
    Columns beyond the two are not read, whatever their names. No shuffle. Texts may be of any length below 2 GB, and
    memory is that of a few texts at a time: some fifty bytes for each byte of text, most of them the library's.
    """
    own_columns(documents, key, text)
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_crc32 bigint"
    schema += ", ids array<int>, starts array<int>, ends array<int>" * keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for whole in batches:
            for lo in range(0, whole.num_rows, 64):
                batch = whole.slice(lo, 64)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                rows, spans = map(list, zip(*coder.encode(texts), strict=True))
                digits = coder.digits
                out = [
                    batch.column(0),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(" ".join([digits[i] for i in r]).encode()).hexdigest() for r in rows]),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in coder.decode(rows)]),
                    pa.array([zlib.crc32(s.astype("<i4").tobytes()) for s in spans], pa.int64()),
                ]
                if keep:
                    out += [pa.array(rows, pa.list_(pa.int32()))]
                    out += [pa.array([s[:, k].tolist() for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                names = [key, "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32", "ids", "starts", "ends"]
                yield pa.RecordBatch.from_arrays(out, names=names[: len(out)])

    return documents.select(key, text).mapInArrow(run, schema)
