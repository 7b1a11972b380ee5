"""Exact top-k, WARC archives, fingerprints."""

import hashlib
import io
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import fingerprint as FP
from tessera.llm import topk, warc


def brute(vectors, asked, k):
    rows = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, v in rows:
        if q in asked:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return out


def vectors(seed, n, spread):
    r = random.Random(seed)
    out = []
    for i in range(n):
        size = r.choice([1.0, 1.0, spread])
        out.append((i, [size * r.choice([r.gauss(0, 1), r.gauss(0, 0.1)]) for _ in range(24)]))
    out += [(n + k, out[3][1]) for k in range(20)]  # ties
    return out


@pytest.mark.parametrize("spread", [1.0, 30.0])
def test_top_k(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "BUCKET", 32)
    monkeypatch.setattr(topk, "SEEDS", 16)
    rows = vectors(4, 300, spread) + [(900, None), (901, [1.0, None]), (902, [float("nan")] * 24), (903, [float("inf")] * 24), (None, [1.0] * 24), (904, []), (905, [2.0] * 3), (906, [0.0] * 24)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("bucket", F.lit(1))
    got = {}
    for r in topk.top_k(frame, frame.where("vec_id % 10 = 0 or vec_id > 900"), 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows, {i for i, _ in rows if i is not None and (i % 10 == 0 or i > 900)}, 5)
    assert {k: sorted(v) for k, v in got.items()} == want


def test_top_k_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, empty).isEmpty()
    one = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, one).isEmpty()
    big = spark.createDataFrame([(1, [2.0**22, 1.0]), (2, [2.0**22, 3.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(big, big.where("vec_id = 1")).first().score == 2**60 + 3 * 2**16
    huge = spark.createDataFrame([(1, [1e18, 1.0]), (2, [1e18, 0.0]), (3, [-1e300, 5.0]), (4, [1e-3, 2.0**40]), (5, [0.0, 2.0**30])], "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(huge, huge).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    most = 2**63 - 1
    assert got[1] == [(2, most), (4, 2**56), (5, 2**46), (3, -most - 1)] and got[2] == [(1, most), (4, 0), (5, 0), (3, -most - 1)]
    assert got[4] == [(5, most), (3, 5 * 2**56), (1, 2**56), (2, 0)]
    twice = spark.createDataFrame([(1, [1.0]), (1, [1.0]), (2, [1.0]), (2, [1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(twice, twice.where("vec_id = 1")).orderBy("rank").collect()] == [(1, 1, 2, 65536), (1, 2, 2, 65536)]


def test_top_k_with_one_hot_id(spark, monkeypatch):
    """Rows that repeat an id, and equal lengths, are dealt over several buckets."""
    monkeypatch.setattr(topk, "BUCKET", 16)
    rows = [(7, [1.0, 2.0])] * 300 + [(k, [2.0, 1.0]) for k in range(100, 400)] + [(1, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    n, bucket, firsts = frame.count(), *topk._grouped(topk.quantised(frame, "vec_id", "embedding"), frame.count())[::2]
    sizes = [r[1] for r in topk.quantised(frame, "vec_id", "embedding").groupBy(bucket.alias("b")).count().collect()]
    assert max(sizes) < 60 and sum(sizes) == n and len(sizes) <= firsts[-1]
    got = [tuple(r) for r in topk.top_k(frame, frame.where("vec_id in (1, 7)")).orderBy("query_id", "rank").collect()]
    assert got == [(1, k + 1, 7, 98304) for k in range(5)] + [(7, k + 1, 100 + k, 262144) for k in range(5)]


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_pruning_loses_nothing(spread):
    r = np.random.default_rng(12)
    for _ in range(20):
        m = np.floor(256 * r.normal(size=(200, 32)) * np.linspace(3, 0.05, 32) * np.exp(spread * r.normal(size=(200, 1))))
        q = np.floor(256 * r.normal(size=(9, 32)) * np.linspace(3, 0.05, 32))
        bucket, scores = topk.Bucket(np.arange(200), m), topk._products(q, m)
        floor = np.sort(scores, axis=1)[:, -5].astype(float)
        found = bucket.open(q, topk._lengths(q), floor)
        assert (found | (scores < floor[:, None])).all() and found.mean() < 0.9


def test_zip_forms():
    for wide in (False, True):
        out = io.BytesIO()
        one = warc.record("response", "5", "http://a/\n", b"<p>", warc.digest(b"<p>"), None)
        warc.write_zip(out, one, b'5 0 {"offset": "0", "length": "%d"}\n' % len(one), zip64=wide)
        got = list(warc.read_archive(out))
        assert got[0]["payload"] == b"<p>" and got[0]["WARC-Record-ID"] == "<urn:page:5>"
    with pytest.raises(ValueError):
        warc.directory(io.BytesIO(b"no archive"))


def test_zip64_values():
    """An archive whose directory and entries use the wide forms throughout."""
    import struct

    name, body = warc.DATA.encode(), b"hello"
    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, 5, 5) + body
    extra = struct.pack("<HH", 9, 1) + b"x" + struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    entry = b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    at = len(local) + len(entry)
    tail = b"PK\x06\x07" + struct.pack("<IQI", 0, at, 1) + b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 3) + b"end"
    file = io.BytesIO(local + entry + end64 + tail)
    start, size, _ = warc.directory(file)[warc.DATA]
    assert file.getvalue()[start : start + size] == body


def package(members, stored=()):
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in members:
            z.writestr(name, content, zipfile.ZIP_STORED if name in stored else zipfile.ZIP_DEFLATED)
    return out


def test_members_are_located():
    """Several archive members in any folder, an index that is compressed once or twice, archives without an index, plain ones."""
    import gzip
    import json

    make = lambda k: warc.record("response", f"p {k}/é", "http://a/", b"<p>%d" % k, warc.digest(b"<p>%d" % k), None)
    records = [make(k) for k in range(6)]
    one, two, three = b"".join(records[:2]), b"".join(records[2:4]), b"".join(warc.zlib.decompress(r, 47) for r in records[4:])
    entry = lambda name, at, r: f"key 0 {json.dumps({'filename': name, 'offset': str(at), 'length': len(r)})}\n"
    lines = entry("a.warc.gz", len(records[0]), records[1]) + entry("x/a.warc.gz", 0, records[0])
    names = ("deep/down/a.warc.gz", "other/b.warc.gz", "c.WARC")
    for index, content in (("indexes/i.cdxj", lines.encode()), ("i.cdx.gz", gzip.compress(lines[:40].encode()) + gzip.compress(lines[40:].encode()))):
        file = package([(names[0], one), (index, content), (names[1], two), (names[2], three), ("readme.txt", b"x" * 5000)], stored=names)
        got = [(warc.page_of(r["WARC-Record-ID"]), r["payload"]) for r in warc.read_archive(file)]
        assert got == [(f"p {k}/é", b"<p>%d" % k) for k in (1, 0, 4, 5, 2, 3)]
    with pytest.raises(ValueError):
        list(warc.read_archive(package([("a.warc.gz", one)])))
    with pytest.raises(ValueError):
        list(warc.read_archive(package([("a.warc.gz", one), ("i.cdxj", entry("nowhere.warc.gz", 0, records[0]))], stored=("a.warc.gz",))))
    with pytest.raises(ValueError):
        list(warc.read_archive(package([("a.warc.gz", one[:-9])], stored=("a.warc.gz",))))


def test_ids_that_are_no_numbers(spark):
    rows = [("a b>\r\n", "u", "x"), ("", "u", "x"), (None, "u", "y"), ("é", "u", "z" * 3_000_000)]
    got = sorted((r.page_id or "-", r.page_id is None, r.refers_to, r.payload_bytes) for r in warc.round_trip(spark.createDataFrame(rows, "page_id string, url string, html string")).collect())
    assert got == [("-", False, None, 1), ("-", True, None, 1), ("a b>\r\n", False, "", 1), ("é", False, None, 3_000_000)]


def test_round_trip(spark):
    rows = [(4, "u", "<p>é"), (2, None, "<p>é"), (9, "u", None), (3, "u", ""), (7, "u", "x" * 300000), (2, "u", "<p>é")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"sha1": F.lit("x"), "first": F.lit(1)})
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(frame).collect())
    digest = lambda s: warc.digest((s or "").encode())
    assert got == [
        (2, 5, digest("<p>é"), "response", None), (2, 5, digest("<p>é"), "response", None), (3, 0, digest(""), "response", None),
        (4, 5, digest("<p>é"), "revisit", 2), (7, 300000, digest("x" * 300000), "response", None), (9, 0, digest(""), "revisit", 3),
    ]
    assert warc.round_trip(frame.limit(0)).isEmpty()
    nulls = spark.createDataFrame([(None, "u", "a"), (None, "u", "a"), (None, "u", "b"), (5, "u", "b")], "page_id long, url string, html string")
    assert sorted(str(r.refers_to) for r in warc.round_trip(nulls).collect()) == ["5", "None", "None", "None"]
    with pytest.raises(ValueError):
        warc.parse(warc.zlib.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nx"))


def chain(words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - 2**64 if seed >= 2**63 else seed


def sketch(text, k):
    words = (text or "").split()
    return sorted({chain(words[i : i + 5]) for i in range(max(1, len(words) - 4))})[:k] if words else []


def alike(a, b, k):
    union = sorted({*a, *b})[:k]
    return len({*union} & {*a} & {*b}) / len(union) if union else 1.0


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(FP, "BUCKET_ROWS", 3)
    monkeypatch.setattr(FP, "CUTS", 4)
    monkeypatch.setattr(FP, "NEAR", 4)
    r = random.Random(2)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.choice([0, 1, 4, 5, 60, 400]))) for _ in range(30)] + [None, "é\U0001f600" * 9, "a b", "a b"]
    rows = [(k * k, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit(1), "range": F.lit("x"), "next": F.lit(0)})
    got = {x.doc_id: x for x in FP.edited_likeness(frame, k=16).collect()}
    assert len(got) == len(rows)
    for n, (key, text) in enumerate(rows):
        text, after = text or "", rows[(n + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited, x = text[: len(text) - cut] + after[:cut], got[key]
        assert (x.n_chars, x.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own, new = sketch(text, 16), sketch(edited, 16)
        assert x.fingerprint == "".join(f"{h & (2**64 - 1):016X}" for h in own)
        assert x.near_edited == alike(own, new, 16) and x.near_next == alike(own, sketch(after, 16), 16)


def test_fingerprint_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert FP.edited_likeness(empty).isEmpty()
    one = FP.edited_likeness(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")).first()
    assert one.near_next == 1.0
    ties = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "z")], "doc_id long, text string")
    assert FP.edited_likeness(ties).count() == 4


def test_fingerprints_of_hot_keys(spark, monkeypatch):
    """Keys with very many rows, and the null key, are cut into ranges; the order is by key, then by a hash of the text."""
    monkeypatch.setattr(FP, "BUCKET_ROWS", 8)
    monkeypatch.setattr(FP, "CUTS", 16)
    monkeypatch.setattr(FP, "NEAR", 4)
    rows = [(None, f"n {k} x") for k in range(60)] + [(7, f"h {k} abcdefg") for k in range(150)] + [(-(10**15) * (k + 1), f"low {k}") for k in range(5)] + [(100 + k, f"t{k} " * k) for k in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    own = frame.selectExpr("doc_id as id", "text as own", "xxhash64(text) as tie")
    sizes = [r[1] for r in own.groupBy(FP._ranges(own, "id", "tie").alias("r")).count().collect()]
    assert max(sizes) < 40 and sum(sizes) == len(rows)
    tie = {(r.id, r.own): r.tie for r in own.collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie[r], r[1]))
    want = {}
    for n, (key, text) in enumerate(order):
        after, cut = order[(n + 1) % len(order)][1], len(text) // 4
        want.setdefault(key, []).append(hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest())
    got = {}
    for r in FP.edited_likeness(frame).collect():
        got.setdefault(r.doc_id, []).append(r.edited_sha256)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_fingerprint_of_a_very_long_text(spark):
    text = " ".join(f"w{k}" for k in range(300_000))
    rows = spark.createDataFrame([(1, text), (2, text + " y"), (3, "z")], "doc_id long, text string")
    got = {r.doc_id: r for r in FP.edited_likeness(rows).collect()}
    assert got[1].n_chars == len(text) and got[1].near_next > 0.95 and abs(got[1].n_shingles - 299_996) < 90_000


def test_sketches_merge(spark):
    rows = spark.createDataFrame([("g", list(range(0, 50, 2))), ("g", list(range(0, 50, 3))), ("h", [])], "g string, sketch array<long>")
    merged = {r.g: r.sketch for r in FP.merge_groups(rows, "g", k=8).collect()}
    assert merged == {"g": [0, 2, 3, 4, 6, 8, 9, 10]}
    a = rows.select(FP.merge(F.col("sketch"), F.array(F.lit(1).cast("long")), 3).alias("m"), FP.distinct_shingles(F.col("sketch"), 128).alias("n")).first()
    assert a.m == [0, 1, 2] and a.n == 25.0
