import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.operators import pool, profile


def corpus(spark, counts):
    return spark.createDataFrame([(" ".join(f"w{chr(97 + k % 26)}" for k in range(n)) + f" {n}",) for n in counts], "text string")


def test_allocation():
    assert pool.allocation(10) == {"short": 4, "medium": 3, "long": 3}
    assert set(pool.allocation(300).values()) == {100}


def test_terciles(spark):
    rows = spark.createDataFrame([(n,) for n in range(1, 10)], "n int")
    edges = pool.tercile_edges(rows, "n")
    got = rows.groupBy(pool.bucket_of(F.col("n"), edges).alias("b")).count().collect()
    assert {r.b: r["count"] for r in got} == {"short": 3, "medium": 3, "long": 3}
    with pytest.raises(ValueError):
        pool.tercile_edges(spark.createDataFrame([(n,) for n in (1, 1, 1, 1, 5)], "n int"), "n")
    with pytest.raises(ValueError):
        pool.tercile_edges(spark.createDataFrame([(1,), (2,)], "n int"), "n")


def test_pool_and_sample(spark):
    rows = corpus(spark, [*range(1, 61), 5, 5]).unionByName(spark.createDataFrame([(None,)], "text string"))
    eligible = pool.eligible_pool(rows, min_words=10)
    assert eligible.count() == eligible.select("source_id").distinct().count()
    assert eligible.agg(F.min("source_word_count")).first()[0] >= 10
    chosen = pool.sample(eligible, 9, 7)
    ids = [r.id for r in chosen.orderBy("id").collect()]
    assert ids == [f"eval_{k:05d}" for k in range(9)]
    assert [r.source_length_bucket for r in chosen.orderBy("id").collect()] == ["long"] * 3 + ["medium"] * 3 + ["short"] * 3
    again = pool.sample(eligible.repartition(7), 9, 7)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, chosen.collect()))
    pool.check_sample(chosen, 9, 10)
    with pytest.raises(ValueError):
        pool.check_sample(chosen, 12, 10)
    pool.check_sample(pool.sample(eligible, 2, 7), 2, 10)  # fewer rows than buckets
    every = pool.replacements(eligible, chosen, 1000, 7)
    assert every.join(chosen, "source_id", "left_semi").isEmpty() and every.count() == eligible.count() - 9
    spare = pool.replacements(eligible, chosen, 7, 7)
    assert sorted(map(tuple, spare.collect())) == sorted(map(tuple, every.where("cand_rank <= 7").collect()))
    texts = {r.source_id: r.source for r in pool.with_texts(spare, rows).collect()}
    assert set(texts) == {r.source_id for r in spare.collect()} and all(hashlib.sha1(t.encode()).hexdigest()[:16] == k for k, t in texts.items())
    given = pool.assigned(chosen.where("id < 'eval_00004'"), spare).collect()
    assert len({r.source_id for r in given}) == 4


def test_missing_column(spark):
    with pytest.raises(ValueError):
        pool.prepared(spark.createDataFrame([(1,)], "x int"))


def test_precision(spark):
    got = {r.n: r for r in profile.precision_table(spark).collect()}
    assert tuple(got[300])[1:] == (0.057, 5.7, 0.162)


def test_profile_edges(spark):
    rows = profile.features(spark.createDataFrame([(None, "a"), ("x y\nz.", "b")], "text string, g string"))
    assert profile.describe(rows).count() == 98
    assert profile.correlations(rows.limit(0)).where("r is not null").isEmpty()
    assert profile.histogram(rows.limit(0), "word_count").isEmpty()
    assert {(r.value, r.n) for r in profile.value_counts(spark.createDataFrame([(None,), ("a",)], "g string"), ["g"]).collect()} == {(None, 1), ("a", 1)}
    assert profile.column_profile(spark.createDataFrame([(None,), ("a",)], "g string")).first()["unique_values"] == 2
