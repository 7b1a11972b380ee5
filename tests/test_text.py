"""Text functions on literals, and against a small model of our own."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera import constants as C
from tessera.functions import text as T


def one(spark, f, *values):
    names = [f"c{k}" for k in range(len(values))]
    rows = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return rows.select(f(*[F.col(n) for n in names]).alias("x")).first()["x"]


CASES = [
    (T.tokens, ("don't 3.14 café abc123",), ["don't", "3.14", "caf", "abc", "123"]),
    (T.normalise, ("a  b\t\tc \r\n\r\n\r\n\r\n d",), "a b c\n\n d"),
    (T.normalise, (" \n x\xa0\n",), "x"),
    (T.heading_numbers, ("1. Intro\n**2.3 Foo**\n12abc\n1.5x",), ["1", "2.3", "1"]),
    (T.list_items, ("- a\n* b\n4) c\n10. \n-x\n\t- d",), 5),
    (T.copy_rate, ("alpha beta with gamma", "ALPHA gamma"), 2 / 3),
    (T.copy_rate, ("a an the", "a"), 0.0),
    (T.has_repeats, ("\n".join("abcabc"),), True),
    (T.has_repeats, ("\n".join("aaaaa"),), False),
    (T.has_repeats, ("\n".join([*"abcdefghijklm", *"abcdefg"]),), False),
    (T.chunk_count, ("a\n\n \n\nb",), 2),
    (T.is_blank, (" \t\n",), True),
    (T.strip_fences, (" ```json\n{}\n```\n",), "{}"),
    (T.content_words, ("students' students don't",), ["students", "don't"]),
    (lambda t: T.bigrams(T.content_words(t)), ("red of blue",), ["red blue"]),
    (lambda t: T.bigrams(T.content_words(t)), ("red",), []),
    (T.line_count, ("a\nb",), 2),
    (T.paragraph_count, ("a\n \nb\n\nc",), 3),
    (T.sentence_count, ("A. B! C?x D...",), 3),
    (T.snippet, ("word " * 60,), ("word " * 51).strip() + " ..."),
    (T.snippet, (" a \n b ",), "a b"),
    (T.snippet, ("x" * 300,), "..."),
    (T.source_id, ("a",), "86f7e437faa5a7fc"),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_literals(spark, case):
    f, values, want = CASES[case]
    got = one(spark, f, *values)
    assert got == pytest.approx(want) if isinstance(want, float) else got == want


def test_repeated_sentences(spark):
    say = lambda n: f"{'Word ' * 7}number{n}."
    assert one(spark, T.has_repeats, " ".join(say(k) for k in (1, 1, 2, 2, 3, 4)))
    assert not one(spark, T.has_repeats, " ".join(say(k) for k in (1, 1, 2, 2, 3, 4, 5, 6)))


def test_markers_of_nothing(spark):
    assert tuple(one(spark, T.marker_stats, "")) == (0, 0.0)


def test_numbers_and_truths(spark):
    rows = spark.createDataFrame([('{"a": "4", "b": true, "c": "x", "t": " YES ", "f": "no", "l": [], "m": [0], "z": 0, "n": null}',)], "j string").select(F.parse_json("j").alias("v"))
    v = F.col("v")
    numbers = rows.select(*[T.number_of(v, k, 9.0).alias(k) for k in "abcdn"]).first()
    assert tuple(numbers) == (4.0, 1.0, 9.0, 9.0, 9.0)
    assert tuple(rows.select(*[T.truth_of(v, k).alias(k) for k in "btflmzn"]).first()) == (True, True, False, False, True, False, False)


def model_normal(text):
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = "\n".join(re.sub("[ \t]+", " ", x).rstrip() for x in text.split("\n"))
    return re.sub("\n{3,}", "\n\n", text.strip())


def model_repeats(text):
    def share(items):
        return (len(items) - len(set(items))) / len(items)

    lines = [x.strip() for x in text.splitlines() if x.strip()]
    long = [s.strip().lower() for s in re.split(r"(?<=[.!?])\s+(?=[A-Z0-9\"'(\[])", text) if len(s.split()) >= 8]
    return len(lines) >= 6 and share(lines) > 0.35 or len(long) >= 6 and share(long) > 0.25


TEXTS = st.lists(st.text(st.sampled_from("aB1.!- \t\r\n'é*)\xa0"), max_size=60), min_size=1, max_size=20)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_properties(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    got = rows.select("t", T.normalise(t).alias("n"), T.normalise(T.normalise(t)).alias("nn"), T.has_repeats(t).alias("r"), T.copy_rate(t, t).alias("c"), T.tokens(t).alias("k")).collect()
    for r in got:
        assert r.n == r.nn == model_normal(r.t)
        assert r.r == model_repeats(r.t)
        assert r.c in (0.0, 1.0)
        assert r.k == re.findall(C.WORD, r.t, re.A)


def test_nulls_stay(spark):
    rows = spark.createDataFrame([(None,)], "t string")
    assert rows.select(T.normalise(F.col("t")).alias("n"), T.word_count(F.col("t")).alias("w"), T.snippet(F.col("t")).alias("s")).first() == (None, None, None)
