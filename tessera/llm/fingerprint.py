"""Document fingerprints: mergeable bottom-k sketches of word-shingle hashes, in native expressions only.

A sketch is an ascending array of the k smallest distinct 64-bit hashes of a text's shingles. Words are
what stands between runs of ASCII white space. A text of fewer words than a shingle has is one shingle; one
without words has an empty sketch. Equal texts have equal sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import own_columns, stored

WORDS, K = 5, 128
BUCKET_ROWS, CUTS, NEAR = 512, 256, 4096
WHITE = "\t\n\x0b\x0c\r "


def words_of(text: Column) -> Column:
    return F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE)), r"[ \t-\r]+")


def shingle_hashes(words: Column, n: int = WORDS) -> Column:
    """Hashes of all runs of ``n`` words, repeats included; ``words`` should be a column, not an expression."""
    runs = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    each = F.transform(runs, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    return F.when(words[0] == "", F.array().cast("array<bigint>")).otherwise(each)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together, but for shingles across their border."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(sketches: DataFrame, group: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group. Each task passes on k hashes of a group at most, so a hot group is no burden."""
    hashes = sketches.select(group, F.explode(sketch).alias("hash")).distinct()
    first = Window.partitionBy(group).orderBy("hash")
    kept = hashes.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k)
    return kept.groupBy(group).agg(F.sort_array(F.collect_list("hash")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of shared over all shingles, 0 to 1; exact while the union has at most k. Two empty ones are alike."""
    union = merge(a, b, k)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(shared / F.size(union))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimate of the number of distinct shingles; exact below k."""
    share = (F.element_at(sketch, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of the share of a's shingles that b has too; 1 for an empty a."""
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_sketch(df: DataFrame, text: str, name: str, n: int = WORDS, k: int = K) -> DataFrame:
    """``df`` with the sketch of a text column; each step is a column of its own, so none is computed twice."""
    words, hashes = f"{name}_words", f"{name}_hashes"
    df = df.withColumn(words, words_of(F.col(text)))
    df = df.withColumn(hashes, shingle_hashes(F.col(words), n))
    return df.withColumn(name, bottom(F.col(hashes), k)).drop(words, hashes)


def _ranges(df: DataFrame, key: str, tie: str) -> Column:
    """A number that grows with (``key``, ``tie``), the same for some hundred neighbouring rows; null keys come first.

    Between quantiles of the key, of which there are always as many, ranges are cut evenly. A key that is several
    quantiles, and the null key, have ranges of their own, cut evenly by the tie, a hash.
    """
    rows, nulls, lows = df.agg(F.count(key), F.count_if(F.col(key).isNull()), F.percentile_approx(key, [i / CUTS for i in range(CUTS + 1)], 100 * CUTS)).first()
    at_tie = lambda parts: F.least(F.floor((F.col(tie).cast("double") / 2.0**64 + 0.5) * parts).cast("bigint"), parts - 1)
    blank = max(1, -(-nulls // BUCKET_ROWS))
    if not rows:
        return at_tie(F.lit(blank).cast("bigint"))
    edges = sorted(set(lows))
    each = max(1, -(-rows // (len(edges) * BUCKET_ROWS)))
    # Ranges of an edge's own key, if it is hot, and where they begin; those up to the next edge follow.
    own = [-(-rows * lows.count(x) // (CUTS * BUCKET_ROWS)) if lows.count(x) > 1 else 0 for x in edges]
    begins = [blank]
    for n in own:
        begins.append(begins[-1] + n + each)
    longs = lambda values: F.array(*[F.lit(int(x)).cast("bigint") for x in values])
    lows_ = longs(edges)
    at = F.greatest(F.size(F.filter(lows_, lambda x: x <= F.col(key))), F.lit(1)) - 1
    low, high = F.get(lows_, at), F.coalesce(F.get(lows_, at + 1), F.lit(edges[-1] + 1))
    begin, hot = F.get(longs(begins), at), F.get(longs(own), at)
    part = F.floor((F.col(key).cast("double") - low) * each / (high.cast("double") - low)).cast("bigint")
    inside = F.least(F.greatest(part, F.lit(0).cast("bigint")), F.lit(each - 1).cast("bigint"))
    number = F.when((hot > 0) & (F.col(key) == low), begin + at_tie(hot)).otherwise(begin + hot + inside)
    return F.when(F.col(key).isNull(), at_tie(F.lit(blank).cast("bigint"))).otherwise(number)


def _following(ranges: DataFrame) -> DataFrame:
    """Each range with the next one that has rows (range, after), the first behind the last.

    Neighbours are found among some thousand numbers at a time; only one row for each such group is compared with all.
    """
    rows = ranges.select("range", F.floor(F.col("range") / NEAR).alias("group"))
    ahead = rows.groupBy("group").agg(F.min("range").alias("head"))
    order = Window.orderBy("group")
    ahead = ahead.select("group", F.coalesce(F.lead("head").over(order), F.first("head").over(order)).alias("ahead"))
    near = rows.withColumn("after", F.lead("range").over(Window.partitionBy("group").orderBy("range")))
    return near.join(ahead, "group").select("range", F.coalesce("after", "ahead").alias("after"))


def edited_likeness(documents: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, k: int = K) -> DataFrame:
    """Fingerprints of each text and of its edited text, and the likenesses of the two and of neighbours.

    In the edited text the last quarter of the code points (rounded down) gives way to the first as many
    of the next document in ascending order of ``key``, null keys first; of rows with one key, or none, in the order
    of a hash of their texts. The first document follows the last, a single one itself. A null text counts as empty;
    the fingerprints of texts without words are empty, and alike. An empty table has no rows. Whole texts are
    shuffled once, by ranges of some hundred rows, of which a key with very many rows has several (but rows that
    repeat a key and its text are in one); only the first row of each range is looked up by its neighbour. A text may
    have any length below 2 GB: a task holds its words and the hashes of its shingles, some thirty times its bytes.
    Columns beyond the two are not read.
    """
    own_columns(documents, key, text)
    rows = documents.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("own"))
    rows = rows.withColumn("tie", F.xxhash64("own"))
    rows = rows.withColumn("range", _ranges(rows, "id", "tie"))
    first = rows.groupBy("range").agg(F.min(F.struct("id", "tie", "own")).alias("head"))
    first = stored(first.select("range", F.col("head.own").alias("head")))
    heads = _following(first).join(first.withColumnRenamed("range", "after"), "after").select("range", "head")
    heads = with_sketch(heads, "head", "head_sketch", n, k)

    near = Window.partitionBy("range").orderBy("id", "tie", "own")
    rows = with_sketch(rows.withColumn("next", F.lead("own").over(near)), "own", "sketch", n, k)
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(near))
    rows = rows.join(heads, "range")
    last = F.col("next").isNull()
    rows = rows.withColumns(
        {
            "next": F.when(last, F.col("head")).otherwise(F.col("next")),
            "next_sketch": F.when(last, F.col("head_sketch")).otherwise(F.col("next_sketch")),
        }
    )
    rows = rows.withColumn("n_chars", F.length("own").cast("bigint"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("own", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next", F.lit(1), cut))
    rows = with_sketch(rows.withColumn("edited", edited), "edited", "edited_sketch", n, k)
    return rows.select(
        F.col("id").alias(key),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("n_shingles"),
        containment(F.col("edited_sketch"), F.col("sketch"), k).alias("edited_within"),
    )
