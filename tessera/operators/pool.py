"""Eligible pool, length buckets, stratified sample and replacement candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import constants as C
from tessera.functions import text as T
from tessera.session import written


def normalised(corpus: DataFrame, text: str = "text") -> DataFrame:
    """source and source_id of each row's normalised text; null texts are left out."""
    if text not in corpus.columns:
        raise ValueError(f"the corpus has no column {text}")
    rows = corpus.where(F.col(text).isNotNull()).select(T.normalise(F.col(text)).alias("source"))
    return rows.withColumn("source_id", T.source_id(F.col("source")))


def prepared(corpus: DataFrame, text: str = "text", min_words: int = 0) -> DataFrame:
    """source_id, words and characters of normalised texts of ``min_words`` words or more, one row for each distinct id. Texts aren't shuffled."""
    rows = normalised(corpus, text).select("source_id", T.word_count(F.col("source")).alias("words"), F.length("source").alias("chars"))
    # Equal ids mean equal texts.
    return rows.where(F.col("words") >= min_words).groupBy("source_id").agg(F.min("words").alias("source_word_count"), F.min("chars").alias("source_char_count"))


def with_texts(rows: DataFrame, corpus: DataFrame, text: str = "text") -> DataFrame:
    """``rows``, of which there are few (a sample, candidates of a limited number), with their source from the corpus.

    They are broadcast to the corpus; no text is shuffled but theirs.
    """
    found = normalised(corpus, text).join(F.broadcast(rows.select("source_id").distinct()), "source_id", "left_semi").dropDuplicates(["source_id"])
    return rows.join(found, "source_id")


def tercile_edges(rows: DataFrame, column: str) -> tuple[float, float]:
    """Interpolated third quantiles; fails with fewer than three rows or where edges meet."""
    n, low, one, two, high = rows.agg(
        F.count(column), F.min(column), F.percentile(column, F.lit(1 / 3)), F.percentile(column, F.lit(2 / 3)), F.max(column)
    ).first()
    if n < 3:
        raise ValueError(f"{n} rows are too few for three buckets")
    if len({float(low), one, two, float(high)}) < 4:
        raise ValueError("length buckets collapse: edges are equal")
    return one, two


def bucket_of(column: Column, edges: tuple[float, float]) -> Column:
    return F.when(column <= F.lit(edges[0]), "short").when(column <= F.lit(edges[1]), "medium").otherwise("long")


def eligible_pool(corpus: DataFrame, min_words: int = 100, text: str = "text") -> DataFrame:
    """source_id, words, characters and bucket of the distinct texts that are long enough; computed once, written, without the texts."""
    rows = written(prepared(corpus, text, min_words))
    return rows.withColumn("source_length_bucket", bucket_of(F.col("source_word_count"), tercile_edges(rows, "source_word_count")))


def allocation(size: int, buckets: list[str] | None = None) -> dict[str, int]:
    """Equal counts, the remainder to the first buckets."""
    buckets = buckets or C.BUCKETS
    each, more = divmod(size, len(buckets))
    return {b: each + (k < more) for k, b in enumerate(buckets)}


def by_hash(seed: int, key: str) -> list[Column]:
    return [F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key))), F.col(key)]


def stratified(rows: DataFrame, counts: dict[str, int], seed: int, key: str = "source_id", bucket: str = "source_length_bucket", per_bucket_seed: bool = True) -> DataFrame:
    """``counts`` rows of each bucket, chosen by a seeded hash of the key: the same rows however they are dealt.

    Only the rows asked for leave a task; a bucket's rank is limited before the shuffle.
    """
    order = F.col(bucket)
    seeds = F.create_map(*[F.lit(x) for k, b in enumerate(counts) for x in (b, str(seed + k * per_bucket_seed))])
    mark = F.md5(F.concat_ws(":", seeds[order], F.col(key)))
    rank = F.row_number().over(Window.partitionBy(bucket).orderBy("__mark", key))
    wanted = F.create_map(*[F.lit(x) for b, n in counts.items() for x in (b, n)])
    most = max(counts.values(), default=0)
    rows = rows.where(F.col(bucket).isin(*counts)).withColumn("__mark", mark).withColumn("__rank", rank).where(F.col("__rank") <= most)
    return rows.where(F.col("__rank") <= wanted[order]).drop("__mark", "__rank")


def sample(pool: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """Stratified sample with ids in the order of bucket (as text), words and source id."""
    counts = allocation(size)
    order = Window.orderBy("source_length_bucket", "source_word_count", "source_id")
    # A sample is small by definition; its numbering may run in one task.
    number = F.row_number().over(order) - 1
    return stratified(pool, counts, seed).withColumn("id", F.format_string("eval_%05d", number))


def check_sample(sampled: DataFrame, size: int, min_words: int) -> None:
    """Total, shortest text and counts per bucket are as planned, or ValueError."""
    got = {r[0]: (r[1], r[2]) for r in sampled.groupBy("source_length_bucket").agg(F.count("*"), F.min("source_word_count")).collect()}
    plan = {b: n for b, n in allocation(size).items() if n}
    if {b: n for b, (n, _) in got.items()} != plan:
        raise ValueError(f"sampled {got}, planned {plan}")
    if any(low < min_words for _, low in got.values()):
        raise ValueError(f"a sampled text has fewer than {min_words} words")


def first_ranked(rows: DataFrame, group: str, order: list[Column], limit: int, name: str) -> DataFrame:
    """The first ``limit`` rows of each group, numbered from 1. Each of the 64 parts of a group passes on that many at most."""
    each = Window.partitionBy(group, "__part").orderBy(*order)
    rows = rows.withColumn("__part", F.pmod(F.xxhash64(*rows.columns), F.lit(64))).withColumn(name, F.row_number().over(each)).where(F.col(name) <= limit).drop("__part")
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col(name) <= limit)


def replacements(pool: DataFrame, used: DataFrame, limit: int, seed: int = 42) -> DataFrame:
    """Pool rows not in ``used``, the first ``limit`` of each bucket by a second hash: the order in which they stand in."""
    rows = pool.join(used.select("source_id").distinct(), "source_id", "left_anti")
    return first_ranked(rows, "source_length_bucket", by_hash(seed + 1000, "source_id"), limit, "cand_rank")


def most_replacements(size: int, each: int) -> int:
    """So many candidates of a bucket can be used, if every row of a sample is replaced ``each`` times."""
    return max(allocation(size).values(), default=0) * each


def assigned(failed: DataFrame, candidates: DataFrame) -> DataFrame:
    """The n-th failed row of a bucket gets the bucket's n-th candidate; rows left without one have null source_id."""
    rank = F.row_number().over(Window.partitionBy("source_length_bucket").orderBy("id"))
    rows = failed.select("id", "source_length_bucket").withColumn("cand_rank", rank)
    return rows.join(candidates, ["source_length_bucket", "cand_rank"], "left").drop("cand_rank")


def bucket_summary(rows: DataFrame, size: int | None = None) -> DataFrame:
    words = F.col("source_word_count")
    out = rows.groupBy("source_length_bucket").agg(
        F.count("*").alias("n"), F.min(words).alias("min_words"), F.percentile(words, F.lit(0.5)).alias("median_words"), F.max(words).alias("max_words"), F.bround(F.avg(words), 2).alias("mean_words")
    )
    if size is not None:
        plan = F.create_map(*[F.lit(x) for b, n in allocation(size).items() for x in (b, n)])[F.col("source_length_bucket")]
        out = out.withColumn("planned", plan).withColumn("planned_pct", F.bround(plan / size * 100, 2))
    return out


def sampling_report(corpus: DataFrame, pool: DataFrame, size: int) -> DataFrame:
    """original, eligible, removed and target rows."""
    both = corpus.agg(F.count("*").alias("original")).crossJoin(pool.agg(F.count("*").alias("eligible")))
    both = both.select("original", "eligible", (F.col("original") - F.col("eligible")).alias("removed"), F.lit(size).cast("long").alias("target"))
    return both.unpivot([], both.columns, "metric", "rows")
