import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import near_dedup as N
from tessera.llm.graph import components


def sets(text, k):
    words = re.findall(r"[^\x20\t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(texts, rule):
    found = {i: sets(t, rule.words) for i, t in texts}
    parent = {i: i for i in found}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in found:
        for j in found:
            if i < j and found[i] and 100 * len(found[i] & found[j]) >= rule.percent * len(found[i] | found[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(found[i]), root(i)) for i in found}


def group(seed):
    """Near copies by few edits of a base, of other members, and unlike ones; copies; empty and short texts."""
    r = random.Random(seed)
    base = [f"w{r.randrange(5000)}" for _ in range(150)]
    texts = []
    for k in range(60):
        words = list(base if k % 3 else texts[-1].split() if texts else base)
        for _ in range(r.choice([0, 1, 2, 4, 9])):
            words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(words))
    return texts + [None, "", " \n", "a", "A", "a b", "a b c d", "A B\tC D", "é è", "É è"]


def test_against_brute_force(spark, monkeypatch):
    for seed, rule in ((1, N.Rule(3, 85)), (2, N.Rule(5, 80))):
        texts = list(enumerate(group(seed)))
        rows = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"id": F.lit(0), "n": F.lit("x"), "name": F.lit(1)})
        for size in (400_000, 900):
            monkeypatch.setattr(N, "BLOCK_SHINGLES", size)
            got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(rows, rule).collect()}
            assert got == brute(texts, rule)


def test_nulls_repeats_and_nothing(spark):
    rows = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "A b  c")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.component_id, r.kept) for r in N.near_duplicates(rows).collect())
    assert got == [(0, None, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert N.near_duplicates(rows.limit(0)).isEmpty()


def by_rows(rows, rule):
    """Component (smallest id) of every row, rows that share an id being documents of their own."""
    found = {k: v[1] for k, v in brute([(k, t) for k, (_, t) in enumerate(rows)], rule).items()}
    least = {}
    for k, (i, _) in enumerate(rows):
        least[found[k]] = min(i, least.get(found[k], i))
    return sorted((i, t or "", least[found[k]]) for k, (i, t) in enumerate(rows))


def test_texts_that_share_an_id(spark):
    texts = group(4)
    r = random.Random(6)
    rows = [(r.choice([1, 5, 5, k + 10]), t) for k, t in enumerate(texts)] + [(1, texts[0]), (5, texts[0] + " more"), (5, "unlike any")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    rule = N.Rule(3, 85)
    got = sorted((x.doc_id, x.n_shingles, x.component_id) for x in N.near_duplicates(frame, rule).collect())
    assert got == sorted((i, len(sets(t, 3)), c) for i, t, c in by_rows(rows, rule))
    # One row of each component stays, and every row without words.
    kept = [(x.doc_id, x.text or "") for x in N.one_of_each(frame.withColumns({"id": F.lit(0), "row": F.lit("x")}), rule).collect()]
    full = [(k, t) for k, (i, t) in enumerate(rows)]
    roots = {k: v[1] for k, v in brute(full, rule).items()}
    want = {}
    for k, (i, t) in enumerate(rows):
        if sets(t, 3):
            want[roots[k]] = min(i, want.get(roots[k], i))
    assert sorted(i for i, t in kept if sets(t, 3)) == sorted(want.values())
    assert sum(not sets(t, 3) for _, t in kept) == sum(not sets(t, 3) for _, t in rows)


def test_one_of_equal_rows(spark):
    rows = [(1, "a b c")] * 3 + [(None, "a b c")] * 2 + [(2, "")] * 2 + [(3, None)] + [(4, "a  b c")]
    kept = N.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "a b c")] * 2 + [(1, "a b c"), (2, ""), (2, ""), (3, "")]
    assert N.one_of_each(kept.limit(0)).isEmpty()


def test_clusters_of_very_many_blocks(spark, monkeypatch):
    """Two families that share buckets but no link, and loose texts between them."""
    monkeypatch.setattr(N, "BLOCK_SETS", 4)
    monkeypatch.setattr(N, "MANY", 3)
    r = random.Random(11)
    rule = N.Rule(3, 85)
    base = [f"w{k}" for k in range(200)]
    other = base[:170] + [f"v{k}" for k in range(30)]
    texts = []
    for k in range(140):
        words = list(r.choice([base, base, other, other[:185] + base[185:]]))
        for _ in range(r.choice([0, 1, 2, 3, 5])):
            words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
        texts.append((k, " ".join(words)))
    called = []
    plain = N._open_buckets
    monkeypatch.setattr(N, "_open_buckets", lambda *a: called.append(1) or plain(*a))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in N.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), rule).collect()}
    assert called and got == brute(texts, rule)


def test_very_long_texts(spark):
    words = [f"w{k}" for k in range(400_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:390_000])), (3, " ".join(words[:200_000]))]
    got = {x.doc_id: x.component_id for x in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_hot_nodes(spark, monkeypatch):
    from tessera.llm import graph

    monkeypatch.setattr(graph, "HOT", 5)
    r = random.Random(8)
    edges = [(50, k) for k in range(100, 160)] + [(k, 99) for k in range(30, 50)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert got == {k: root(k) for k in parent if any(k in e and e[0] != e[1] for e in edges)}


def test_registers_merge_and_estimate():
    r = np.random.default_rng(3)
    for share in (0.5, 0.8, 0.95):
        both = r.integers(0, 2**63, 2000).astype(np.uint64)
        n = round(2000 * (1 - share) / (1 + share))
        a, b = np.unique(np.append(both[n:], both[:n] + np.uint64(1))), np.unique(both)
        ra, rb = N.registers(a), N.registers(b)
        assert (N.merged(ra, rb) == N.registers(np.union1d(a, b))).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = N.estimate(ra[None], rb[None], np.array([float(len(a))]), np.array([float(len(b))]))[0]
        assert abs(got - true) < 0.15
        assert abs((ra == rb).mean() - true) < 0.2


def test_components(spark):
    r = random.Random(5)
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, r.randrange(101, 140)) for _ in range(30)] + [(7, 7), (3, 2)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(41)} == {0} and all(got[b] == 100 for a, b in edges if a == 100)
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()
