"""Terms weighted by frequency and rarity, latent topics, and their audit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T

VOCABULARY, MIN_DOCS, MAX_SHARE, TOPICS, TERMS = 1200, 5, 0.60, 8, 12


def term_counts(corpus: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, term, tf): each document's content words, counted in the map phase."""
    words = corpus.where(F.col(text).isNotNull()).select(key, F.explode(T.content_words(F.col(text))).alias("term"))
    return words.groupBy(key, "term").agg(F.count("*").alias("tf"))


def vocabulary(counts: DataFrame, n_docs: int, size: int = VOCABULARY, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """term, df, total of the most frequent terms that are neither rare nor everywhere."""
    stats = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    kept = stats.where((F.col("df") >= min_docs) & (F.col("df") <= n_docs * max_share))
    return kept.orderBy(F.desc("total"), "term").limit(size)


def weights(counts: DataFrame, words: DataFrame, n_docs: int, key: str = "doc_id") -> DataFrame:
    """(key, term, weight): share of the document's in-vocabulary words times smoothed rarity, rows of unit length.

    The vocabulary is bounded by its size parameter and broadcast.
    """
    rows = counts.join(F.broadcast(words.select("term", "df")), "term")
    idf = F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1)) + 1
    # A document's share cancels out in the unit length, but is kept: it is the definition. Its terms are vocabulary words, so its list is bounded.
    cells = rows.groupBy(key).agg(F.sum("tf").alias("all"), F.collect_list(F.struct("term", "tf", idf.alias("idf"))).alias("cells"))
    raw = cells.select(key, F.transform("cells", lambda c: F.struct(c["term"].alias("term"), (c["tf"] / F.col("all") * c["idf"]).alias("raw"))).alias("cells"))
    size = F.sqrt(F.aggregate("cells", F.lit(0.0), lambda s, c: s + c["raw"] * c["raw"]))
    rows = raw.withColumn("size", size).select(key, "size", F.explode("cells").alias("c"))
    return rows.select(key, F.col("c.term").alias("term"), (F.col("c.raw") / F.col("size")).alias("weight"))


def gram(weighted: DataFrame, terms: list[str], key: str = "doc_id") -> np.ndarray:
    """Term-by-term products summed over documents, terms in the order given.

    Each task adds its documents' products up in a matrix of vocabulary size squared; one such matrix per task
    leaves it, in rows, and rows of one number are added in the map phase of the next.
    """
    spark = weighted.sparkSession
    place = F.broadcast(spark.createDataFrame([(t, k) for k, t in enumerate(terms)], "term string, place int"))
    docs = weighted.join(place, "term").groupBy(key).agg(F.collect_list(F.struct("place", "weight")).alias("cells"))
    size = len(terms)

    def run(batches):
        import pyarrow as pa

        total = np.zeros((size, size))
        for batch in batches:
            for cells in batch.column(0).to_pylist():
                at, w = [c["place"] for c in cells], np.array([c["weight"] for c in cells])
                total[np.ix_(at, at)] += np.outer(w, w)
        for k in np.flatnonzero(total.any(axis=1)):
            yield pa.RecordBatch.from_pydict({"place": pa.array([k], pa.int32()), "sums": [total[k].tolist()]})

    parts = docs.select("cells").mapInArrow(run, "place int, sums array<double>")
    at = F.posexplode("sums").alias("other", "value")
    cells = parts.select("place", at).groupBy("place", "other").agg(F.sum("value").alias("value"))
    rows = cells.groupBy("place").agg(F.transform(F.array_sort(F.collect_list(F.struct("other", "value"))), lambda c: c["value"]).alias("sums"))
    out = np.zeros((size, size))
    for place, sums in rows.collect():  # a row of doubles for each term of the vocabulary
        out[place] = sums
    return out


def components(matrix: np.ndarray, n: int = TOPICS) -> tuple[np.ndarray, np.ndarray]:
    """The n strongest components (rows; the strongest loading of each positive) and their shares of the trace."""
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:n]
    found = vectors[:, order].T
    signs = np.sign(found[np.arange(len(found)), np.abs(found).argmax(axis=1)])
    return found * np.where(signs == 0, 1, signs)[:, None], values[order] / max(values.sum(), 1e-300)


def loadings(spark, found: np.ndarray, terms: list[str]) -> DataFrame:
    rows = [(f"topic_{k + 1:02d}", t, float(v)) for k, row in enumerate(found) for t, v in zip(terms, row, strict=True)]
    return spark.createDataFrame(rows, "topic string, term string, loading double")


def assigned(weighted: DataFrame, loads: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each document's topic of the largest absolute score; loadings are of vocabulary size and broadcast."""
    scores = weighted.join(F.broadcast(loads), "term").groupBy(key, "topic").agg(F.sum(F.col("weight") * F.col("loading")).alias("score"))
    # Of equal scores the first topic wins.
    best = F.max(F.struct(F.abs("score").alias("size"), F.negative(F.substring("topic", 7, 2).cast("int")).alias("turn"), F.col("topic").alias("topic")))
    return scores.groupBy(key).agg(best["topic"].alias("topic"))


def top_terms(loads: DataFrame, n: int = TERMS) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("loading"), "term"))
    return loads.withColumn("rank", rank).where(F.col("rank") <= n)


def summary(documents: DataFrame, topics: DataFrame, loads: DataFrame, shares: np.ndarray, key: str = "doc_id") -> DataFrame:
    """Per topic: rows, pct, words, explained share, top terms. A document without vocabulary words has the first topic."""
    first = F.lit("topic_01")
    rows = documents.select(key, "word_count").join(topics, key, "left").withColumn("topic", F.coalesce("topic", first))
    each = rows.groupBy("topic").agg(F.count("*").alias("assigned_rows"), F.bround(F.avg("word_count"), 1).alias("mean_words"), F.bround(F.percentile("word_count", F.lit(0.5)), 1).alias("median_words"))
    words = top_terms(loads).groupBy("topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]), ", ").alias("top_terms"))
    share = documents.sparkSession.createDataFrame([(f"topic_{k + 1:02d}", round(float(s), 4)) for k, s in enumerate(shares)], "topic string, explained_share double")
    total = F.sum("assigned_rows").over(Window.partitionBy())
    out = share.join(words, "topic").join(each, "topic", "left").withColumn("assigned_rows", F.coalesce("assigned_rows", F.lit(0)))
    return out.withColumn("assigned_pct", F.bround(F.col("assigned_rows") * 100.0 / total, 2))


def crosstab(rows: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Shares of ``column``'s values within each value of ``row`` (3 places)."""
    counts = rows.groupBy(row).agg(F.count("*").alias("__n"), *[F.count_if(F.col(column) == v).alias(v) for v in values])
    return counts.select(row, *[F.bround(F.col(v) / F.col("__n"), 3).alias(v) for v in values])


def share_audit(pool: DataFrame, sampled: DataFrame, topic: str = "topic") -> DataFrame:
    """Each topic's share of pool and sample, and their gap; a topic missing from either has share 0 there."""

    def share(rows: DataFrame, name: str) -> DataFrame:
        counts = rows.groupBy(topic).agg(F.count("*").alias("n"))
        return counts.select(topic, (F.col("n") / F.sum("n").over(Window.partitionBy())).alias(name))

    both = share(pool, "pool_share").join(share(sampled, "sample_share"), topic, "full").na.fill(0.0)
    gap = F.bround(F.abs(F.col("pool_share") - F.col("sample_share")), 3)
    return both.select(topic, F.bround("pool_share", 3).alias("pool_share"), F.bround("sample_share", 3).alias("sample_share"), gap.alias("abs_gap"))


def under_covered(audit: DataFrame, least: float = 0.05) -> DataFrame:
    return audit.where((F.col("pool_share") >= least) & (F.col("sample_share") == 0))
