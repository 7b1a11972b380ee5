"""HTML extraction, the quality classifier, the pipeline."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import html_extract as H
from tessera.llm import html_pages, quality, trees


def test_trees_learn_an_interaction():
    r = np.random.default_rng(0)
    x = r.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    forest = trees.boost(x[:1500], y[:1500])
    assert ((forest.margin(x[1500:]) > 0) == y[1500:]).mean() > 0.95


def texts(source):
    p = H.Page(source)
    return p.blocks([True] * len(p.parent))


BLOCKS = [
    ("<p>a <b>b</b> c<p>d&amp;e<br>f</p>g", ["a b c", "d&e f", "g"]),
    ("<p>x<!-- <p>no --><script>if(a<b)'</p>'</script>y", ["xy"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("a < b & c <p title='x>y'>d</p>", ["a < b & c", "d"]),
    ("<p>a&nbsp;\n  b</p><style>p{}</style><title>t</title>", ["a b"]),
    ("<b>a<p>b</b>c</p>d", ["a", "bc", "d"]),
    ("<!-- open", []),
    ("", []),
    ("<div><a href=\"u>v", ["v"]),  # a quote that never ends doesn't hide the rest
]


@pytest.mark.parametrize("source,want", BLOCKS)
def test_blocks(source, want):
    assert texts(source) == want


def test_decoding_never_keeps_below_dropped():
    nodes = H.Nodes([H.Page(s) for s in html_pages.pages(20, seed=8)])
    kept = nodes.decode(np.random.default_rng(1).normal(size=len(nodes.parent)))
    assert (kept <= kept[nodes.parent]).all() and kept[nodes.root].all()


def test_pages_of_other_sites():
    """Markup and class names of another source than the training pages."""
    from pages_by_hand import ALL, agreement

    scores = {name: agreement(H.main_texts([source], H.model())[0], want) for name, (source, want) in ALL.items()}
    assert min(scores.values()) > 0.95, scores


def test_deep_nesting_takes_linear_time():
    import time

    def seconds(n):
        began = time.perf_counter()
        for source in ("<div>" * n + "deep", "<b><p>" * (n // 2) + "x" + "</b>" * (n // 2), "<ul><li>" * (n // 2) + "</p>" * n):
            H.Page(source)
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(100_000) < 40 * seconds(10_000) + 1
    assert H.main_texts(["<div>" * 100_000 + "deep"], H.model(250))[0] in ("", "deep")


def test_held_out_pages():
    """Some of them have names that say nothing, and passages that look like main text and aren't."""
    forest, exact = H.model(250), 0
    sources = html_pages.pages(120, seed=77)
    for source in sources:
        p = H.Page(source)
        want = "\n".join(p.blocks([H.MARK in t for t in p.text])).replace(H.MARK, "")
        exact += H.main_texts([source.replace(H.MARK, "")], forest) == [want]
    assert exact >= 0.7 * len(sources)


def test_pages_of_the_tables(spark):
    """Their main text is what stands in their only article."""
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in H.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        assert got[r.page_id].text.split("\n") == texts(inner) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_extract_edges(spark):
    rows = spark.createDataFrame([(1, None, None), (1, "u", ""), (None, "u", "<p>x"), (2, "u", "<div>" * 3000 + "deep")], "page_id long, url string, html string").withColumn("text", F.lit(1))
    assert H.extract(rows, H.model(250)).count() == 4
    assert H.extract(rows.limit(0), H.model(250)).isEmpty()


def corpus(n, seed=1):
    r, rows = random.Random(seed), []
    for k in range(n):
        good = r.random() < 0.7
        words = [r.choice(["alpha", "beta", "gamma", "delta", "of", "the", "and"]) + r.choice("abcdefghij") for _ in range(r.randint(3, 120))]
        rows.append((k, " ".join(words) + "." if good else " ".join(w.upper() + r.choice(["!!", "###", " |"]) for w in words[:10] * 9), int(good)))
    return rows


def test_quality_held_out(spark):
    rows = spark.createDataFrame(corpus(900), "doc_id long, text string, quality int")
    labels, docs = rows.select("doc_id", "quality"), rows.select("doc_id", "text").withColumn("score", F.lit("x"))
    machine = quality.fit(docs, labels, rows=500)
    got = quality.scored(docs, machine).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 900 and 100 < len(held) < 260
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.97
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.fit(docs, flipped, rows=500)  # held-out labels have no influence
    assert np.array_equal(again.linear, machine.linear) and np.array_equal(again.factors, machine.factors)


def test_score_in_linear_time_is_the_sum_over_pairs():
    r = np.random.default_rng(4)
    width = quality.BUCKETS + quality.STATS
    m = quality.Machine(0.1, r.normal(size=width) * 0.1, r.normal(size=(width, quality.RANK)) * 0.1, np.zeros(quality.STATS), np.ones(quality.STATS))
    bucket, weight, stats = np.array([3, 70], np.int32), np.array([0.6, 0.8]), r.normal(size=quality.STATS)
    at, x = np.concatenate([bucket, np.arange(quality.BUCKETS, width)]), np.concatenate([weight, stats])
    z = m.bias + m.linear[at] @ x + sum(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i))
    assert m.score(bucket, weight, stats) == pytest.approx(1 / (1 + np.exp(-z)))


def _mixed(x):
    mask = 2**64 - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
    x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
    return x ^ x >> 31


def _word_hash(word):
    from tessera.llm import text as T

    total = sum(int(T._BYTES[b]) * pow(T._BASE, k, 2**64) for k, b in enumerate(word))
    return _mixed((total + len(word) * int(T._WORD)) % 2**64)


def brute_features(text):
    """Buckets with weights and the statistics, word by word."""
    import math
    from collections import Counter

    raw = (text or "").encode()
    words = [w.lower() for w in raw.split()]  # on bytes: ASCII white space and letters
    counts = Counter(words)
    weight = {}
    for w, n in counts.items():
        k = (_word_hash(w) >> 40) % quality.BUCKETS
        weight[k] = weight.get(k, 0) + math.log1p(n)
    norm = math.sqrt(sum(v * v for v in weight.values())) or 1
    shares = [sum(b in set(members) for b in raw) / max(len(raw), 1) for members in quality.CLASSES.values()]
    lines, n = raw.count(b"\n"), len(words)
    shares[3] = lines / max(n, 1)
    runs = [tuple(words[k : k + 4]) for k in range(n - 3)]
    more = [math.log1p(n), math.log1p(len(raw)), sum(map(len, words)) / n / 10 if n else 0, min(max(map(len, words)) / 100, 1) if n else 0]
    more += [len(counts) / math.sqrt(n) / 10 if n else 0, len(counts) / n if n else 0, max(counts.values()) / n if n else 0, len(set(runs)) / len(runs) if runs else 1]
    return {k: v / norm for k, v in weight.items()}, shares + more


def test_whole_query_against_brute_force(spark):
    """Every row of the query: features word by word, the score as a sum over all pairs of features."""
    import math
    import zlib

    from tessera.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    m = quality.fit(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    rows = QUERIES["op9_quality"](spark, d).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        words, stats = brute_features(docs[r.doc_id])
        x = {**words, **{quality.BUCKETS + k: min(6, max(-6, (v - c) / s)) for k, (v, c, s) in enumerate(zip(stats, m.centre, m.scale, strict=True))}}
        at, values = np.array(list(x)), np.array(list(x.values()))
        meet = m.factors[at] @ m.factors[at].T * np.outer(values, values)
        z = m.bias + m.linear[at] @ values + np.triu(meet, 1).sum()
        assert r.score == pytest.approx(1 / (1 + math.exp(-min(35, max(-35, z)))), abs=1e-9)
        assert r.predicted == int(r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_rows_are_ranked(spark):
    from tessera.llm.queries import QUERIES

    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op9_quality"](spark, d).where("held_out").join(labels, "doc_id").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert len(good) + len(bad) > 50 and sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.98


def test_quality_of_odd_rows(spark):
    """Rows that repeat, tie or are very long: equal texts have equal scores, and each row its own."""
    texts = [(1, "good words here"), (1, "good words here"), (2, "good words here"), (3, "word " * 500_000), (4, None), (5, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"score": F.lit("x"), "held_out": F.lit(1)})
    machine = quality.fit(docs, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int"))
    got = quality.scored(docs, machine).collect()
    assert len(got) == 6 and len({r.score for r in got if r.doc_id in (1, 2)}) == 1 and len({r.score for r in got if r.doc_id > 3}) == 1
    assert quality.accepted(docs, machine).columns == docs.columns


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "x"), (2, "é" * 50000), (3, " \n ")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(None, 1), (1, None), (1, 1), (1, 0), (77, 1)], "doc_id long, quality int")):
        machine = quality.fit(docs, labels)
        assert all(0 <= r.score <= 1 for r in quality.scored(docs, machine).collect())
        assert quality.accepted(docs.limit(0), machine).isEmpty()


def test_pipeline_against_brute_force(spark):
    """Each stage keeps what brute force keeps of its own input."""
    import corpus_pipeline as C
    from tests_model import brute_components, brute_covered

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    columns, frames = docs.columns, {}
    for name, stage in C.STAGES:
        frames[name] = (docs, C.stored(stage(spark, docs, d)))
        docs = frames[name][1]
        assert name == "packing" or docs.columns == columns
    rows = lambda f: {r.doc_id: r.text for r in f.collect()}

    before, after = map(rows, frames["quality"])
    assert all(before[k] == t for k, t in after.items())
    wrong = [k for k in before if k in labels and (k in after) != (labels[k] == 1)]
    assert len(wrong) <= 2

    before, after = map(rows, frames["near_dedup"])
    roots = brute_components(before, 5, 80)
    assert set(after) == {k for k in before if roots[k] == k}

    before, after = map(rows, frames["suffix_dedup"])
    hits = brute_covered(before, 50)
    for k, text in before.items():
        words = (text or "").split()
        left = [w for w, h in zip(words, hits[k], strict=True) if not h]
        assert (after[k] or "").split() == left if left or not words else k not in after

    got = frames["packing"][1]
    assert got.select("doc_id").distinct().count() == frames["packing"][0].count()
    assert hashlib.sha256(repr(sorted(map(tuple, got.collect()))).encode()).hexdigest() == hashlib.sha256(repr(sorted(map(tuple, C.run(spark, d).collect()))).encode()).hexdigest()
