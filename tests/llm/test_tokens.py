"""Packing, SentencePiece and chats."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import chat, packing, pieces

P = pytest.importorskip("public_tokenizers")
BPE, MODEL = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = ["", None, "a", "Hello  world\n\n é 漢字 \U0001f600 <|endoftext|> x", " lead", "trail ", "\x00\x01▁ ▁▁", "word " * 3000, "</s><s>", "tab\there", "a" * 5000]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([8, 64, 100]))
def test_pack(lengths, capacity):
    out = packing.pack(lengths, capacity)
    seen = {}
    for sequence in out:
        total = sum(p[2] for p in sequence)
        assert total == capacity or total & (total - 1) == 0
        assert total <= capacity and all(p[2] > 0 for p in sequence)
        for item, start, size in sequence:
            seen.setdefault(item, []).append((start, size))
    for item, n in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[item]):
            assert start == at
            at += size
        assert at == n


def test_tournament_is_first_fit():
    r = random.Random(1)
    sizes = sorted((r.randint(1, 50) for _ in range(300)), reverse=True)
    tree, room = packing.Tournament(300, 50), []
    for s in sizes:
        want = next((k for k, x in enumerate(room) if x >= s), len(room))
        if want == len(room):
            room.append(50)
        room[want] -= s
        assert tree.place(s) == want


def test_pack_documents(spark):
    tokenizers = pytest.importorskip("tokenizers")
    own = tokenizers.Tokenizer.from_file(BPE)
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "x"), (2, "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"group": F.lit("x"), "start": F.lit(1)})
    got = packing.pack_documents(frame, BPE, group_bytes=9000).collect()
    want = sorted((k if k is not None else -1, len(own.encode(t or "", add_special_tokens=False).ids) + 1) for k, t in rows)
    docs, sequences = {}, {}
    for r in got:
        docs.setdefault((r.doc_id if r.doc_id is not None else -1, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(n for _, n in want) and set(docs) == set(want)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for k, t in enumerate(TEXTS):
        ids = np.array(own.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        if k != 2:
            for r in docs[k, len(ids)]:
                assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert packing.pack_documents(frame.limit(0), BPE).isEmpty()


@pytest.mark.parametrize("text", [" " * 2_000_000, "a" * 2_000_000, "!" * 2_000_000, "x" + " \n" * 700_000 + "y", "\n" * 1_500_000])
def test_long_runs_as_the_library(text):
    """Runs that a backtracking pattern can't split."""
    tokenizers = pytest.importorskip("tokenizers")
    want = tokenizers.Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids
    assert np.array_equal(packing.byte_tokens(BPE).ids(text), want)


def test_equal_rows_are_spread(spark):
    """Groups are bounded in bytes, whatever repeats; every row is packed; a run again gives the same."""
    frame = spark.createDataFrame([(7, "word " * 40)] * 3000 + [(8, None)] * 50 + [(9, " " * 1_100_000)], "doc_id long, text string")
    got = packing.pack_documents(frame, BPE, group_bytes=20_000)
    rows = got.collect()
    sizes = {}
    for r in rows:
        sizes[r.sequence_id >> 32] = sizes.get(r.sequence_id >> 32, 0) + (r.length if r.doc_id == 7 else 0)
    assert len(sizes) > 30 and max(sizes.values()) < 41 * 3000 / 20
    total = {k: sum(r.length for r in rows if r.doc_id == k) for k in (7, 8, 9)}
    assert total == {7: 3000 * 42, 8: 50, 9: 1_100_001}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, got.collect()))


def test_pieces_as_the_library(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)] + [(None, "x")], "doc_id long, text string").withColumn("ids", F.lit(1))
    for r in pieces.encode(frame, MODEL, keep=True).collect():
        text = "x" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = own.encode(text, add_eos=True)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(own.decode(ids).encode()).hexdigest()
        raw = text.encode()
        assert [raw[a:b] for a, b in zip(r.starts, r.ends, strict=True)] and b"".join(raw[a:b] for a, b in zip(r.starts, r.ends, strict=True)) == raw
    assert pieces.encode(frame.limit(0), MODEL).isEmpty()


def _trie(words):
    """A double array over UTF-8 words (and their end mark 0), units as the reader expects them."""
    units, used, bases = {0: 0}, {0}, set()

    def place(node, entries):
        labels = sorted({w[0] if w else 0 for w, _ in entries})
        base = next(b for b in range(1, 1 << 20) if b not in bases and all((b ^ x) not in used for x in labels))
        bases.add(base)
        units[node] |= (node ^ base) << 10
        used.update(b for b in (base ^ x for x in labels))
        for x in labels:
            below = [(w[1:], v) for w, v in entries if (w[0] if w else 0) == x]
            if x == 0:
                units[base] = below[0][1] | 1 << 31
                units[node] |= 1 << 8
            else:
                units[base ^ x] = x
                place(base ^ x, below)

    place(0, words)
    size = max(units) + 257
    return b"".join(units.get(k, 0xFF).to_bytes(4, "little") for k in range(size))


def test_character_map_takes_the_longest_prefix():
    pool = b"x\0yy\0\0"
    table = _trie([("a".encode(), 0), ("ab".encode(), 2), ("é".encode(), 5)])
    found = pieces.CharacterMap(len(table).to_bytes(4, "little") + table + pool)
    assert found.longest(b"abc", 0) == (b"yy", 2) and found.longest(b"ac", 0) == (b"x", 1)
    assert found.longest("é".encode(), 0) == (b"", 2) and found.longest(b"b", 0) is None

    class Spec:
        precompiled_charsmap = len(table).to_bytes(4, "little") + table + pool
        add_dummy_prefix = remove_extra_whitespaces = escape_whitespaces = True

    text, where = pieces.Normaliser(Spec)("  ab  é a ")
    assert text == "▁yy▁x" and where.tolist() == [2, 2, 2, 2, 2, 4, 4, 4, 9, 10]


RULES = [(rule, *flags) for rule in ("nmt_nfkc", "nfkc_cf", "identity") for flags in ((True, True), (True, False), (False, True), (False, False))]
ODD = st.text(st.sampled_from(" aZé①ＡＢﬁ㌀\u3000\u00a0\u200b\u00ad\u0301\tİſ漢\U0001f600▁\n\x00\x07é각")) | st.text(max_size=30)


@settings(max_examples=150, deadline=None)
@given(ODD, st.sampled_from(RULES))
def test_normalisation_through_real_maps(text, how):
    """Text and alignment as the library's own, for its built-in character maps."""
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2

    rule, prefix, squeeze = how
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    assert rule == "identity" or len(proto.normalizer_spec.precompiled_charsmap) > 100_000
    want, offsets = library.normalize(text, with_offsets=True)
    got, where = pieces.Normaliser(proto.normalizer_spec)(text)
    assert got == want
    # Ours are offsets in bytes for each byte, the library's in characters for each character.
    starts = np.concatenate([[0], np.cumsum([len(c.encode()) for c in got])]).astype(int)
    in_text = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])]).astype(int)
    mine = [int(np.searchsorted(in_text, w)) for w in where[starts]]
    assert mine[:-1] == list(offsets)[: len(got)]


@pytest.fixture(scope="module")
def mapped_model(tmp_path_factory):
    """The vocabulary of the public model with a real character map instead of its empty one, and white space squeezed."""
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2

    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    proto, spec = sentencepiece_model_pb2.ModelProto(), sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    spec.ParseFromString(library.serialized_model_proto())
    proto.normalizer_spec.CopyFrom(spec.normalizer_spec)
    proto.pieces[5000].type = pieces.USER_PIECE
    at = tmp_path_factory.mktemp("model") / "mapped.model"
    at.write_bytes(proto.SerializeToString())
    return str(at), proto.pieces[5000].piece


def test_pieces_through_a_real_map(mapped_model):
    sentencepiece = pytest.importorskip("sentencepiece")
    at, symbol = mapped_model
    own, ours = sentencepiece.SentencePieceProcessor(model_file=at), pieces.Pieces(at)
    r = random.Random(3)
    texts = [t or "" for t in TEXTS] + ["ＡＢ①  ﬁne  é " * 40, symbol * 2 + " x", "\u3000 lead\u00a0 \u200bmid\u00ad \n"]
    texts += ["".join(r.choice("ab Ａ①é \u3000ﬁ漢\t.") for _ in range(r.randrange(200))) for _ in range(60)]
    for text, (ids, spans) in zip(texts, ours.encode(texts), strict=True):
        assert ids == own.encode(text, add_eos=True)
        want = [(p.begin, p.end) for p in own.encode(text, return_type="proto").pieces if not p.piece.startswith("<0x")]
        mine = [tuple(s) for s, i in zip(spans.tolist(), ids, strict=True) if i != ours.end and not own.id_to_piece(i).startswith("<0x")]
        assert mine == want and (spans[1:, 0] >= spans[:-1, 0]).all() and spans.max(initial=0) <= len(text.encode())


def test_long_text_as_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    text = " ".join(f"word{k % 977} é" for k in range(90_000))
    (ids, spans), = pieces.pieces(MODEL).encode([text])
    assert ids == sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(text, add_eos=True)
    assert spans[-1, 1] == len(text.encode()) and (spans[1:, 0] == spans[:-1, 1]).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<|turn|>"]), st.text(st.sampled_from("a\\<|>[]/sINT tuenrdx \né")) | st.sampled_from([chat.END, "</s>[INST] ok [/INST]", "\\<|end|>", "<|endoftext|>"])), max_size=6))
def test_chats_read_back(turns):
    f = chat.formatter(BPE)(turns)
    assert chat.parse(f.text) == turns
    assert "".join(chat.masked_texts(f)) == "".join(t for r, t in turns if r == "assistant")
    for control in ("</s>", "[INST]", "[/INST]", "<|endoftext|>"):
        assert control not in f.text


def test_chat_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 0, "user", None), (None, None, None, "x"), (2, 5, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(2))
    got = {r.conv_id: r for r in chat.format_chats(frame, BPE).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 1 and got[1].turns_sha256 == hashlib.sha256(b"user\n\nuser\n\nassistant\nb\n").hexdigest()
    assert got[None].n_turns == 1 and got[2].loss_chars == 0 and len(got[1].ids) == len(got[1].loss_mask)
    assert chat.format_chats(frame.limit(0), BPE).isEmpty()


def test_very_long_conversation(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k} says é " * 20) for k in range(4000)] + [(2, 0, "assistant", "word " * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.conv_id: r for r in chat.format_chats(frame, BPE, with_output=False).collect()}
    loss = "".join(t for c, _, r, t in rows if c == 1 and r == "assistant")
    assert got[1].n_turns == 4000 and got[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and got[2].loss_chars == 1_000_000
