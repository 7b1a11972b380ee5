"""Corpus profile: health, counts, percentiles, correlations, terms, histograms."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T

FEATURES = ["char_count", "word_count", "line_count", "paragraph_count", "sentence_count_approx", "newline_density", "avg_words_per_sentence"]
FLAGS = ["contains_number", "contains_structured_marker", "starts_with_heading_like"]
PERCENTILES = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
THRESHOLDS = [10, 25, 50, 100, 200, 300]


def pct(part: Column, whole: Column) -> Column:
    return F.bround(F.try_divide(part * 100.0, whole), 2)


def features(corpus: DataFrame, text: str = "text") -> DataFrame:
    """All columns and the text's features; a null text counts as empty."""
    rows = corpus.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    t = F.col(text)
    rows = rows.withColumns(
        {
            "char_count": F.length(t), "word_count": F.size(T.whitespace_words(t)), "line_count": T.line_count(t),
            "paragraph_count": T.paragraph_count(t), "sentence_count_approx": T.sentence_count(t), "newline_count": F.regexp_count(t, F.lit("\n")),
            "contains_number": t.rlike(r"\d"), "contains_structured_marker": t.rlike(r"(?:\A|\n)\s*(?:[-*]|\d+[.)])\s+"),
            "starts_with_heading_like": T.strip(t).rlike(r"\A(?:\*\*)?\d+(?:\.\d+)*\b"),
        }
    )
    return rows.withColumns(
        {
            "newline_density": F.bround(F.col("newline_count") / F.greatest("char_count", F.lit(1)) * 1000, 2),
            "avg_words_per_sentence": F.bround(F.try_divide(F.col("word_count"), F.nullif("sentence_count_approx", F.lit(0))), 2),
        }
    )


def column_profile(rows: DataFrame) -> DataFrame:
    """column, type, non_null, unique_values (null counts as a value). Of strings, digests are counted: no text is shuffled."""
    cells = {}
    for c, kind in rows.dtypes:
        value = F.sha2(F.col(c).cast("binary"), 256) if kind == "string" else F.col(c)
        cells |= {f"n:{c}": F.count(c), f"u:{c}": F.count_distinct(value) + F.max(F.col(c).isNull().cast("int"))}
    one = rows.agg(*[v.alias(k) for k, v in cells.items()])
    each = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`n:{c}`").alias("non_null"), F.coalesce(F.col(f"`u:{c}`"), F.lit(0)).cast("long").alias("unique_values")) for c, t in rows.dtypes]
    return one.select(F.inline(F.array(*each)))


def health(rows: DataFrame, text: str = "text") -> DataFrame:
    """rows, columns, missing, blank, unique and duplicate texts: metric, value."""
    t = F.col(text)
    one = rows.agg(
        F.count("*").alias("rows"), F.lit(len(rows.columns)).cast("long").alias("columns"), F.count_if(t.isNull()).alias("missing_text"),
        F.count_if(T.is_blank(F.coalesce(t, F.lit("")))).alias("blank_text"), F.count_distinct(t).alias("unique_text"),
    )
    one = one.withColumn("duplicate_text", F.col("rows") - F.col("unique_text"))
    return one.unpivot([], one.columns, "metric", "value")


def missing(rows: DataFrame) -> DataFrame:
    one = rows.agg(F.count("*").alias("all"), *[F.count_if(F.col(c).isNull()).alias(f"m:{c}") for c in rows.columns])
    each = [F.struct(F.lit(c).alias("column"), F.col(f"`m:{c}`").alias("missing"), pct(F.col(f"`m:{c}`"), F.col("all")).alias("missing_pct")) for c in rows.columns]
    return one.select(F.inline(F.array(*each)))


def value_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """column, value (as text), n, pct; nulls are a value. One pass for all columns."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")
    counts = rows.select(pairs).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("column"))
    return counts.withColumn("pct", pct(F.col("n"), total))


def describe(rows: DataFrame, columns: list[str] | None = None, percentiles: list[float] | None = None) -> DataFrame:
    """feature, stat, value (2 places): count, mean, std, min, exact percentiles, max. One aggregation."""
    columns, percentiles = columns or FEATURES, percentiles or PERCENTILES
    cells, stats = [], ["count", "mean", "std", "min", *[f"{p * 100:g}%" for p in percentiles], "max"]
    for c in columns:
        v = F.col(c).cast("double")
        several = F.percentile(v, F.array(*map(F.lit, percentiles)))
        cells.append(F.concat(F.array(F.count(v).cast("double"), F.avg(v), F.stddev_samp(v), F.min(v)), several, F.array(F.max(v))).alias(c))
    one = rows.agg(*cells)
    each = [F.struct(F.lit(c).alias("feature"), F.lit(s).alias("stat"), F.bround(F.get(F.col(c), F.lit(k)), 2).alias("value")) for c in columns for k, s in enumerate(stats)]
    return one.select(F.inline(F.array(*each)))


def flag_counts(rows: DataFrame, flags: list[str] | None = None) -> DataFrame:
    flags = flags or FLAGS
    one = rows.agg(F.count("*").alias("all"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    return one.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("n"), pct(F.col(f), F.col("all")).alias("pct")) for f in flags])))


def correlations(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson's r of all pairs, nulls left out pair by pair: a, b, r (3 places; null for a constant column)."""
    columns = columns or FEATURES

    def r(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread).alias(f"{a}|{b}")

    one = rows.agg(*[r(a, b) for a, b in product(columns, repeat=2)])
    each = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.bround(F.col(f"`{a}|{b}`"), 3).alias("r")) for a, b in product(columns, repeat=2)]
    return one.select(F.inline(F.array(*each)))


def group_stats(rows: DataFrame, group: str) -> DataFrame:
    w = F.col("word_count")
    return rows.groupBy(group).agg(
        F.count("*").alias("n"), F.bround(F.avg(w), 2).alias("mean_words"), F.percentile(w, F.lit(0.5)).alias("median_words"), F.min(w).alias("min_words"),
        F.max(w).alias("max_words"), F.bround(F.avg("paragraph_count"), 2).alias("mean_paragraphs"), F.bround(F.avg("sentence_count_approx"), 2).alias("mean_sentences"),
    ).orderBy(F.desc("median_words"), group)


def below_thresholds(rows: DataFrame, column: str = "word_count", thresholds: list[int] | None = None) -> DataFrame:
    """How many rows lie below each threshold: threshold, n, pct."""
    thresholds = thresholds or THRESHOLDS
    one = rows.agg(F.count("*").alias("all"), *[F.count_if(F.col(column) < t).alias(str(t)) for t in thresholds])
    return one.select(F.inline(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"`{t}`").alias("n"), pct(F.col(f"`{t}`"), F.col("all")).alias("pct")) for t in thresholds])))


def extremes(rows: DataFrame, n: int, key: str, longest: bool, column: str = "word_count") -> DataFrame:
    return rows.orderBy(F.desc(column) if longest else F.asc(column), key).limit(n)


def terms(rows: DataFrame, text: str = "text", by: str | None = None, pairs: bool = False) -> DataFrame:
    """Frequency of content words, or of pairs of neighbours, perhaps by group: (group,) term, n."""
    words = rows.select(*([by] if by else []), T.content_words(F.col(text)).alias("words"))
    units = T.bigrams(F.col("words")) if pairs else F.col("words")
    return words.select(*([by] if by else []), F.explode(units).alias("term")).groupBy(*([by] if by else []), "term").agg(F.count("*").alias("n"))


def top(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), "term").limit(n)


def top_by_group(counts: DataFrame, by: str, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "term"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def ranks_as_columns(ranked: DataFrame, by: str, groups: list[str]) -> DataFrame:
    return ranked.groupBy("rank").pivot(by, groups).agg(F.first("term"))


def histogram(rows: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """bin (from 0), n over equal widths between minimum and maximum, the last bin closed."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return rows.limit(0).select(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n"))
    width = (high - low) / bins or 1
    at = F.least(F.floor((F.col(column) - low) / F.lit(float(width))), F.lit(bins - 1)).cast("int")
    return rows.where(F.col(column).isNotNull()).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def box(rows: DataFrame, column: str, by: str) -> DataFrame:
    """Five numbers of each group."""
    q = F.percentile(column, F.array(*map(F.lit, (0.25, 0.5, 0.75))))
    return rows.groupBy(by).agg(F.min(column).alias("low"), q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"), F.max(column).alias("high"))


def precision_table(spark, sizes: tuple[int, ...] = (100, 200, 300, 500, 1000)) -> DataFrame:
    """Margin of error of a share and smallest detectable effect for sample sizes."""
    n = F.col("n")
    rows = spark.createDataFrame([(s,) for s in sizes], "n int")
    margin, effect = F.lit(1.96) * F.sqrt(F.lit(0.25) / n), F.lit(1.96 + 0.84) / F.sqrt(n)
    return rows.select("n", F.bround(margin, 3).alias("margin"), F.bround(margin * 100, 1).alias("margin_points"), F.bround(effect, 3).alias("effect"))
