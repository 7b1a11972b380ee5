"""Repeated passages by a sparse suffix array.

Suffixes are retained only where a run of ``lead`` words is the smallest, by hash, of a window of runs; any
two equal passages of ``least`` words contain a retained suffix at the same place. Retained suffixes are sorted
by their lead and then by their context, which is all that such a passage can reach left and right of them, and
neighbours are compared. Neighbours of equal context match over the whole of it: the match is extended left and
right in one step. Where one lead stands in unlike contexts, the first suffix of each context is extended word by
word: every run of ``least`` words around it is sorted and compared with its neighbour in turn. Matches that
overlap are joined to maximal passages.

Leads with contexts, and runs, are compared by 128 bits of two hashes over all their words. Both sorts are by
range down to (document, place), so a passage with any number of occurrences is dealt over as many tasks as its
rows need; what crosses the border of two tasks is settled by a join. Nothing is sent to the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import drop_stored, own_columns, stored, text_tag
from tessera.llm.text import chunks, rolling, stretch

LEAST, LEAD = 50, 16
SLICE = 1 << 18
_SALT = 0x5851F42D4C957F2D
_PLACE = np.uint64(20)
_LOW = np.uint64((1 << 20) - 1)


def retained(runs: np.ndarray, window: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Places of the leftmost minimum, by the upper bits of the hashes, of windows of ``window`` runs: of all, or those at ``starts`` (ascending)."""
    n, found = len(runs) - window + 1, []
    starts = np.arange(max(n, 0)) if starts is None else starts
    for lo in range(0, max(n, 0), SLICE):
        some = starts[np.searchsorted(starts, lo) : np.searchsorted(starts, lo + SLICE)] - lo
        # A hash's lower bits give way to its place. The minimum of a window is that of two shorter ones that cover it.
        least = (runs[lo : lo + SLICE + window - 1] >> _PLACE << _PLACE) | np.arange(min(SLICE + window - 1, len(runs) - lo), dtype=np.uint64)
        size = 1
        while 2 * size <= window:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
        found.append(np.unique(least[some] & _LOW).astype(np.int64) + lo)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _batch(columns: list, names: str, types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names.split())


_WIDE, _NARROW = pa.int64(), pa.int32()


def _suffixes(documents: DataFrame, key: str, text: str, least: int, lead: int) -> DataFrame:
    """Retained suffixes: lead, context, id, tag, place (in words), and the context's first byte and width in bytes."""
    names, types = "lead context id tag place byte width", [_WIDE] * 3 + [_NARROW] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, found in chunks(batch.column(1)):
                # All words of some texts in a row; no window and no context crosses a text's border.
                ends = np.repeat(found.offsets[1:], np.diff(found.offsets))
                runs = rolling(found.hashes, lead)
                at = retained(runs, least - lead + 1, np.flatnonzero(np.arange(len(ends)) + least <= ends))
                of = np.searchsorted(found.offsets, at, side="right") - 1
                of_known = batch.column(0).slice(lo, hi - lo).is_valid().to_numpy(zero_copy_only=False)[of]
                at, of = at[of_known], of[of_known]
                start, end = np.maximum(at - (least - lead), found.offsets[of]), np.minimum(at + least, found.offsets[of + 1])
                # A context that a text's border cuts is equal only to one cut alike.
                context = stretch(found.hashes, start, end, _SALT) + (at - start).astype(np.uint64)
                bounds = found.bounds[of]
                byte, width = found.starts[start] - bounds, found.ends[end - 1] - found.starts[start]
                tags = np.zeros(len(found), np.int64)
                for i in np.unique(of).tolist():
                    tags[i] = zlib.crc32(found.data[found.bounds[i] : found.bounds[i + 1]]) - (1 << 31)
                ids = batch.column(0).slice(lo, hi - lo).fill_null(0).to_numpy()
                for k in range(0, len(at), SLICE):
                    part = slice(k, k + SLICE)
                    columns = [runs[at].astype(np.int64), context.astype(np.int64), ids[of], tags[of], at - found.offsets[of], byte, width]
                    yield _batch([c[part] for c in columns], names, types)

    rows = documents.select(F.col(key).cast("bigint").alias("id"), text)
    return rows.mapInArrow(run, "lead bigint, context bigint, id bigint, tag int, place int, byte int, width int")


def _ranged(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _neighbours(suffixes: DataFrame) -> DataFrame:
    """Matches (id, tag, byte, width, like) of neighbours of equal context, and suffixes (id, tag, place; no width) to be extended by words.

    Every suffix is marked as a match or not; those to be extended are told besides.
    They are the first ones of each context whose lead stands in others too. What the task before or after
    holds isn't seen, so a task's first row and last context always are among them.
    """
    order = ["lead", "context", "id", "tag", "place"]
    names, types = "marked id tag place byte width like", [pa.bool_(), _WIDE, _NARROW, _NARROW, _NARROW, _NARROW, _WIDE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = held = None  # the last row; the first row of its context and whether its lead is known to stand in others
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [c.to_numpy() for c in batch.columns]
            if last is not None:
                now = [np.concatenate([x, c]) for x, c in zip(last, now, strict=True)]
            same_lead = now[0][1:] == now[0][:-1]
            same = same_lead & (now[1][1:] == now[1][:-1])
            repeat = same & ((now[2][1:] != now[2][:-1]) | (now[3][1:] != now[3][:-1]) | (now[4][1:] != now[4][:-1]))
            yield _batch([repeat, *(c[1:] for c in now[2:7]), now[2][:-1]], names, types)
            at = np.flatnonzero(~same) + 1
            heads, known = [c[at] for c in now], same_lead[at - 1]
            if held is None:
                heads, known = [np.concatenate([c[:1], x]) for c, x in zip(now, heads, strict=True)], np.append(True, known)
            else:
                heads, known = [np.concatenate([c, x]) for c, x in zip(held[0], heads, strict=True)], np.append(held[1], known)
            known[:-1] |= known[1:] & (heads[0][1:] == heads[0][:-1])
            yield extend([c[:-1][known[:-1]] for c in heads])
            held, last = ([c[-1:] for c in heads], known[-1]), [c[-1:] for c in now]
        if held is not None:
            yield extend(held[0])

    def extend(rows: list[np.ndarray]) -> pa.RecordBatch:
        none = pa.nulls(len(rows[0]))
        return _batch([np.ones(len(rows[0]), bool), rows[2], rows[3], rows[4], none, none, none], names, types)

    sorted_ = _ranged(suffixes, *order).select(*order, "byte", "width")
    told = sorted_.mapInArrow(run, "marked boolean, id bigint, tag int, place int, byte int, width int, like bigint")
    return told.where("marked").drop("marked")


def _runs(documents: DataFrame, places: DataFrame, key: str, text: str, least: int, lead: int) -> DataFrame:
    """Every run of ``least`` words around the suffixes of ``places`` (id, tag, places): two hashes, id, tag, place, first byte, width in bytes."""
    names, types = "hash check id tag place byte width", [_WIDE] * 3 + [_NARROW] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, found in chunks(batch.column(2)):
                places = batch.column(3).slice(lo, hi - lo)
                of = np.repeat(np.arange(hi - lo), places.value_lengths().to_numpy())
                at = places.flatten().to_numpy() + found.offsets[of]
                # A run of the passage starts from so far left of the suffix that it still holds its lead, up to it.
                first, last = np.maximum(at - (least - lead), found.offsets[of]), np.minimum(at, found.offsets[of + 1] - least)
                near = np.zeros(len(found.hashes) + 1, np.int32)
                np.add.at(near, first, 1)
                np.add.at(near, last + 1, -1)
                all_ = np.flatnonzero(np.cumsum(near[:-1]) > 0)
                ids, tags = (batch.column(c).slice(lo, hi - lo).to_numpy() for c in (0, 1))
                for k in range(0, len(all_), SLICE):
                    some = all_[k : k + SLICE]
                    of = np.searchsorted(found.offsets, some, side="right") - 1
                    byte, width = found.starts[some] - found.bounds[of], found.ends[some + least - 1] - found.starts[some]
                    one, two = (stretch(found.hashes, some, some + least, salt).astype(np.int64) for salt in (0, _SALT))
                    yield _batch([one, two, ids[of], tags[of], some - found.offsets[of], byte, width], names, types)

    rows = documents.select(F.col(key).cast("bigint").alias("id"), text_tag(text).alias("tag"), F.col(text).alias("whole")).join(places, ["id", "tag"])
    schema = "hash bigint, check bigint, id bigint, tag int, place int, byte int, width int"
    return rows.select("id", "tag", "whole", "places").mapInArrow(run, schema)


def _repeats(runs: DataFrame) -> DataFrame:
    """Runs with an equal one before them in the order (id, tag, place): id, tag, byte, width, like (the id of that neighbour)."""
    order = ["hash", "check", "id", "tag", "place"]
    names, types = "edge hash check id tag place byte width like", [_NARROW, _WIDE, _WIDE, _WIDE, _NARROW, _NARROW, _NARROW, _NARROW, _WIDE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None

        def rows(edge: int, columns: list[np.ndarray], like) -> pa.RecordBatch:
            return _batch([np.full(len(like), edge), *columns, like], names, types)

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [c.to_numpy() for c in batch.columns]
            if last is None:
                yield rows(1, [c[:1] for c in now], now[2][:1])
            else:
                now = [np.concatenate([x, c]) for x, c in zip(last, now, strict=True)]
            equal = [c[1:] == c[:-1] for c in now[:5]]
            repeat = equal[0] & equal[1] & ~(equal[2] & equal[3] & equal[4])
            yield rows(0, [c[1:][repeat] for c in now], now[2][:-1][repeat])
            last = [c[-1:] for c in now]
        if last is not None:
            yield rows(2, last, last[2])

    schema = "edge int, hash bigint, check bigint, id bigint, tag int, place int, byte int, width int, like bigint"
    found = stored(_ranged(runs, *order).select(*order, "byte", "width").mapInArrow(run, schema))
    # A task's first run is a repeat if an equal one is the last of a task before it.
    where = F.struct("id", "tag", "place")
    lasts = found.where("edge = 2").groupBy("hash", "check").agg(F.min(where).alias("before"))
    firsts = found.where("edge = 1").join(lasts, ["hash", "check"]).where(F.col("before") < where)
    columns = ["id", "tag", "byte", "width"]
    return found.where("edge = 0").select(*columns, "like").unionByName(firsts.select(*columns, F.col("before.id").alias("like")))


def _joined(matches: DataFrame) -> DataFrame:
    """Overlapping matches as maximal spans of bytes: id, tag, start, end, like (the smallest neighbour's id)."""
    names, types = "id tag start end like", [_WIDE, _NARROW, _WIDE, _WIDE, _WIDE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            id_, tag, start, width, like = (c.to_numpy().astype(np.int64) for c in batch.columns)
            end = start + width
            if last is not None:
                id_, tag, start, end, like = (np.concatenate([x, c]) for x, c in zip(last, (id_, tag, start, end, like), strict=True))
            other = np.append(True, (id_[1:] != id_[:-1]) | (tag[1:] != tag[:-1]))
            # The furthest end so far within a document: each one's ends lie above those of the one before.
            shift = np.cumsum(other) << 32
            reach = np.maximum.accumulate(end + shift)
            new = other.copy()
            new[1:] |= start[1:] + shift[1:] > reach[:-1]
            at = np.flatnonzero(new)
            ends = np.maximum.reduceat(end, at)
            spans = id_[at], tag[at], start[at], ends, np.minimum.reduceat(like, at)
            yield _batch([c[:-1] for c in spans], names, types)
            last = [c[-1:] for c in spans]
        if last is not None:
            yield _batch(last, names, types)

    dealt = matches.repartition("id", "tag").sortWithinPartitions("id", "tag", "byte")
    return dealt.select("id", "tag", "byte", "width", "like").mapInArrow(run, "id bigint, tag int, start bigint, end bigint, like bigint")


def repeated_spans(documents: DataFrame, least: int = LEAST, lead: int = LEAD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of ``least`` words or more that occur before, in an earlier document or earlier in their own.

    Returns id, tag (CRC-32 of the text), start, end (bytes of the UTF-8 text), like (id of a document that holds
    the passage or, for a longer span, a part of it). Of all occurrences the one in the smallest id, at the first
    place, has no span; a text whose words are all those of an earlier one is a span from its first word to its
    last. Words are compared with A-Z lower-cased and any white space between them.

    Null, empty and short texts, and rows without id, have no spans; an empty table has none. Rows that repeat an
    id and its text count once; different texts with one id are documents of their own, in the order of their tags.
    A text may have any length below 2 GB: a worker holds some twenty times the longest text's bytes. Columns
    beyond the two aren't read. Each text is shuffled at most once.
    """
    own_columns(documents, key, text)
    suffixes = stored(_suffixes(documents, key, text, least, lead))
    found = stored(_neighbours(suffixes))
    drop_stored(suffixes)
    places = found.where("width is null").groupBy("id", "tag").agg(F.collect_set("place").alias("places"))
    runs = stored(_runs(documents, places, key, text, least, lead))
    matches = found.where("width is not null").select("id", "tag", "byte", "width", "like").unionByName(_repeats(runs))
    drop_stored(runs)
    return _joined(matches)


def cut_repeats(documents: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` without the spans' bytes (one space or line break is left where words would meet).

    Columns (of any names) and rows stay as they are, but for the text (and n_chars, if there is one) of cut
    documents; a document of which no word is left is dropped. Rows without id or text, and texts without spans,
    stay whole; rows that repeat an id and its text are all cut alike.
    """
    own_columns(documents, key, text)
    order, white = documents.columns, " \t\n\r\v\f"

    def cut(found: list, whole: str) -> str | None:
        raw, out, at, line = whole.encode(), [], 0, False
        for start, end in [*((x["start"], x["end"]) for x in found), (None, None)]:
            part = raw[at:start].decode()
            line |= bool(out) and part[:1] == "\n"
            if word := part.strip(white):
                out += ["\n" if line else " "] * bool(out) + [word]
                line = False
            line |= part[-1:] == "\n"
            at = end
        return "".join(out) or None

    each = spans.groupBy("id", "tag").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    rows = documents.select(F.struct(*order).alias("row"), F.col(key).cast("bigint").alias("id"), text_tag(text).alias("tag"))
    rows = rows.join(each, ["id", "tag"], "left").select("row", "spans")
    count = order.index("n_chars") if "n_chars" in order else None
    at = order.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, spans_ = batch.column(0).flatten(), batch.column(1).to_pylist()
            old = columns[at].to_pylist()
            new = [cut(s, t) if s and t else t for s, t in zip(spans_, old, strict=True)]
            columns[at] = pa.array(new, columns[at].type)
            if count is not None:
                sizes = columns[count].to_pylist()
                sizes = [len(t) if s and t else n for t, s, n in zip(new, spans_, sizes, strict=True)]
                columns[count] = pa.array(sizes, columns[count].type)
            keep = [t is not None or o is None for t, o in zip(new, old, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=order).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, documents.schema)
