"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and each token is matched to the
turn that it lies in by binary search over the turns' sorted spans.

Template: ``<|turn|>`` role ``<|text|>`` text ``<|end|>`` for each turn. The three markers are single
tokens, so no token straddles a border. In roles and texts a backslash after the first character breaks
every control string (the markers, those of other well-known templates, and the tokenizer's own special
tokens); backslashes themselves are doubled, which makes that reversible.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import own_columns

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"
_CONTROL = re.compile(r"\\|<(?=\||/?s>)|\[(?=/?INST\]|/?SYS\]|PAD\]|SEP\]|CLS\])")
_ESCAPED = re.compile(r"\\(\\)|([<\[])\\")


def escape(text: str) -> str:
    """No control string is left in the result; ``unescape`` gives the text back."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] or m[2], text)


@dataclass
class Formatted:
    text: str
    turns: np.ndarray  # (turns, 4): starts and ends of role and of text
    ids: list[int]
    spans: np.ndarray  # (tokens, 2)
    mask: np.ndarray  # per token: does it lie in a text to be learned


class Formatter:
    def __init__(self, path: str):
        from tokenizers import AddedToken, Tokenizer, processors

        self.coder = Tokenizer.from_file(path)
        self.coder.add_special_tokens([AddedToken(m, normalized=False) for m in (TURN, TEXT, END)])
        self.coder.post_processor = processors.ByteLevel(trim_offsets=False)

    def __call__(self, turns: Iterable[tuple[str, str]]) -> Formatted:
        parts, at, spans = [], 0, []
        for role, text in turns:
            one = escape(role), escape(text)
            parts += [TURN, one[0], TEXT, one[1], END]
            start = at + len(TURN)
            middle = start + len(one[0])
            spans.append((start, middle, middle + len(TEXT), middle + len(TEXT) + len(one[1])))
            at = spans[-1][3] + len(END)
        whole, spans = "".join(parts), np.array(spans, np.int64).reshape(-1, 4)
        coded = self.coder.encode(whole, add_special_tokens=False)
        tokens = np.array(coded.offsets, np.int64).reshape(-1, 2)
        return Formatted(whole, spans, coded.ids, tokens, self._mask(whole, spans, tokens))

    @staticmethod
    def _mask(text: str, turns: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Tokens that share a character with a learned turn's text."""
        learned = np.array([text[a:b] == LOSS_ROLE for a, b in turns[:, :2].tolist()], bool)
        starts, ends = turns[learned, 2], turns[learned, 3]
        if not len(starts):
            return np.zeros(len(tokens), bool)
        # The first span that ends after the token starts; spans don't overlap.
        at = np.searchsorted(ends, tokens[:, 0], side="right")
        return (at < len(starts)) & (starts[np.minimum(at, len(starts) - 1)] < tokens[:, 1])


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts, read back from a rendered conversation."""
    out = []
    for turn in text.split(TURN)[1:]:
        role, _, rest = turn.partition(TEXT)
        out.append((unescape(role), unescape(rest.removesuffix(END))))
    return out


def masked_texts(formatted: Formatted) -> list[str]:
    """What the mask covers, one string for each run of masked tokens, unescaped."""
    where, out = np.flatnonzero(formatted.mask), []
    for run in np.split(where, np.flatnonzero(np.diff(where) > 1) + 1):
        if len(run):
            out.append(unescape(formatted.text[formatted.spans[run[0], 0] : formatted.spans[run, 1].max()]))
    return out


@lru_cache(maxsize=2)
def formatter(path: str) -> Formatter:
    return Formatter(path)


def format_chats(turns: DataFrame, tokenizer: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", with_output: bool = True) -> DataFrame:
    """One row for each conversation: conv_id, the digests of what reads back and, ``with_output``, formatted, ids and loss_mask.

    Rows are ordered by turn (nulls first), ties by role and text, so repeated rows are turns of their own; null roles
    and texts are empty; rows with a null id form one conversation; an empty table has none. Columns beyond the four
    are not read. Turns are shuffled once by conversation and streamed in order: memory is that of one conversation,
    which is rendered and encoded whole, some hundred times its bytes; that is why a conversation isn't split.
    """
    own_columns(turns, conv, turn, role, text)
    kind = turns.schema[conv].dataType.simpleString()
    schema = (
        f"`{conv}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
        + ", formatted string, ids array<int>, loss_mask array<boolean>" * with_output
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fmt = formatter(tokenizer)

        def finish(key, rows: list[tuple[str, str]]) -> tuple:
            f = fmt(rows)
            back, loss = parse(f.text), "".join(masked_texts(f))
            said = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in back).encode()).hexdigest()
            out = key, len(back), said, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(f.text)
            return (*out, f.text, f.ids, f.mask.tolist()) if with_output else out

        def chats() -> Iterator[tuple]:
            key, rows = None, []
            for batch in batches:
                for c, _, r, t in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                    if rows and c != key:
                        yield finish(key, rows)
                        rows = []
                    key = c
                    rows.append((r or "", t or ""))
            if rows:
                yield finish(key, rows)

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            types = [batch_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_())]
            names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "formatted", "ids", "loss_mask"]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)]
            return pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

        held = []
        for row in chats():
            held.append(row)
            if len(held) == 64:
                yield flush(held)
                held = []
        if held:
            yield flush(held)

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(turns.schema[conv].dataType)
    dealt = turns.select(conv, turn, role, text).repartition(F.col(conv)).sortWithinPartitions(conv, turn, role, text)
    return dealt.mapInArrow(run, schema)
