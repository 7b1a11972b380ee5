import re

import pytest
from pyspark.sql import functions as F

from tessera.llm.suffix_dedup import cut_repeats, repeated_spans

LONG = [f"w{k}" for k in range(200)]


def covered(texts, least):
    """Per text, which words lie in a run of ``least`` words that stands before."""
    seen, out = set(), {}
    for key, text in texts:
        words = [w.lower() for w in re.findall(r"[^\x20\t-\r]+", text or "")]
        hit = [False] * len(words)
        for k in range(len(words) - least + 1):
            run = tuple(words[k : k + least])
            if run in seen:
                hit[k : k + least] = [True] * least
            seen.add(run)
        out[key] = hit
    return out


TEXTS = [
    (1, " ".join(LONG[:100])),
    (2, "other start\n" + "  ".join(LONG[20:80]).upper() + " other end"),
    (3, " ".join(LONG[:100])),
    (4, None),
    (5, ""),
    (6, "a b c " * 40),
    (7, " ".join(LONG[90:140])),
    (8, "é " + " ".join(LONG[100:150]) + " x " + " ".join(LONG[30:85])),
]


@pytest.mark.parametrize("least,lead", [(10, 4), (50, 16)])
def test_against_brute_force(spark, least, lead):
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("id", F.lit("clash"))
    got = {}
    for s in repeated_spans(rows, least, lead).collect():
        got.setdefault(s.id, []).append((s.start, s.end))
    for key, want in covered(TEXTS, least).items():
        raw = (dict(TEXTS)[key] or "").encode()
        at = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\t-\r]+", raw)]
        assert [any(a <= s and e <= b for a, b in got.get(key, [])) for s, e in at] == want, key


def test_cut(spark):
    rows = spark.createDataFrame([(i, t, len(t or "")) for i, t in TEXTS], "doc_id long, text string, n_chars long").withColumn("__spans_", F.lit(1))
    kept = cut_repeats(rows, repeated_spans(rows, 50, 16))
    assert kept.columns == rows.columns
    got = {r.doc_id: r for r in kept.collect()}
    assert set(got) == {1, 2, 4, 5, 6, 7, 8}  # 3 equals 1
    assert got[1].text == TEXTS[0][1] and got[2].text == "other start\nother end" and got[2].n_chars == 21
    assert got[4].text is None and got[5].text == "" and len(got[6].text.split()) == 3


def test_repeats_ties_and_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeated_spans(empty).isEmpty() and cut_repeats(empty, repeated_spans(empty)).isEmpty()
    text = " ".join(LONG)
    rows = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "x")], "doc_id long, text string")
    assert repeated_spans(rows).isEmpty()
    assert cut_repeats(rows, repeated_spans(rows)).count() == 4
    with pytest.raises(ValueError):
        repeated_spans(rows.drop("text"))


def test_texts_that_share_an_id(spark):
    """They are documents of their own: of a passage in both, one occurrence stays, whatever else has the id."""
    text = " ".join(LONG)
    rows = spark.createDataFrame([(1, text), (1, text + " y"), (1, "z"), (2, "a " + text), (2, "b " + text)], "doc_id long, text string")
    spans = repeated_spans(rows).collect()
    assert len(spans) == 4 - 1 and len({(s.id, s.tag) for s in spans}) == 3
    left = sorted(r.text for r in cut_repeats(rows, repeated_spans(rows)).collect())
    assert sum(LONG[0] in t for t in left) == 1 and {"a", "b", "z"} <= set(left)


def test_clashing_columns(spark):
    names = ["spans", "row", "id", "tag", "__spans", "__name", "__id", "like"]
    rows = spark.createDataFrame([(i, t) for i, t in TEXTS], "doc_id long, text string").withColumns({n: F.lit(n) for n in names})
    kept = cut_repeats(rows, repeated_spans(rows, 50, 16))
    assert kept.columns == rows.columns
    assert all([r[n] for n in names] == names for r in kept.collect())


def test_borders_of_tasks(spark):
    """A passage with very many occurrences in unlike surroundings, sorted over many tasks; long texts; no cut within a group."""
    import random

    r = random.Random(9)
    passage = [f"p{k}" for k in range(55)]
    texts = []
    for i in range(120):
        own = [f"u{r.randrange(10**6)}" for _ in range(r.randrange(0, 60))]
        at = r.randrange(len(own) + 1)
        texts.append((i, " ".join(own[:at] + passage[: r.choice([49, 50, 55])] + own[at:])))
    texts += [(500 + k, texts[3][1]) for k in range(40)]
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = {}
        for s in repeated_spans(rows).collect():
            got.setdefault(s.id, []).append((s.start, s.end))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for key, want in covered(texts, 50).items():
        at = [(m.start(), m.end()) for m in re.finditer(r"\S+", dict(texts)[key])]
        assert [any(a <= s and e <= b for a, b in got.get(key, [])) for s, e in at] == want, key


def test_retained_places():
    import numpy as np

    from tessera.llm import suffix_dedup as S

    r = np.random.default_rng(2)
    for n in (0, 3, 34, 35, 36, 400):
        runs = r.integers(0, 9, n).astype(np.uint64) << np.uint64(40)
        want = sorted({k + int(np.argmin(runs[k : k + 35])) for k in range(n - 34)})
        assert S.retained(runs, 35).tolist() == want
    starts = np.array([0, 5, 90, 300])
    assert S.retained(runs, 35, starts).tolist() == sorted({k + int(np.argmin(runs[k : k + 35])) for k in starts})


def test_very_long_text():
    """5 MB in one text, and as two: memory stays a small multiple of the text."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tessera.llm import suffix_dedup as S
    from tessera.llm.text import chunks, rolling, stretch

    text = " ".join(f"w{k % 700_000}" for k in range(750_000))
    tracemalloc.start()
    (_, _, found), = chunks(pa.array([text]))
    runs = rolling(found.hashes, S.LEAD)
    at = S.retained(runs, S.LEAST - S.LEAD + 1)
    spans = stretch(found.hashes, np.maximum(at - 34, 0), np.minimum(at + 50, len(found.hashes)), 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(text)
    again = at[(at >= 700_034) & (at < 750_000 - 50)]
    first = np.searchsorted(at, again - 700_000)
    assert (at[first] == again - 700_000).all() and (spans[first] == spans[np.searchsorted(at, again)]).all() and len(np.unique(spans)) >= len(spans) - len(again) - 4
