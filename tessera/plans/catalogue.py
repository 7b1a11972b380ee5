"""Queries over the driver's tables, by name, and DuckDB SQL for the same rows.

``documents`` stands in for the corpus, its lang and source for group columns; user turns and the
assistant turns after them are (source, reference) pairs; scores and verdicts come from hashes and labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import constants as C
from tessera.functions import text as T
from tessera.functions.prompts import JUDGED
from tessera.operators import gates, merge, pool, profile, topics
from tessera.session import shared_place, ship, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


# SQL fragments


def _in(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _tokens(x: str) -> str:
    return rf"regexp_extract_all({x}, '[A-Za-z]+(?:''[A-Za-z]+)?|\d+(?:\.\d+)?')"


def _lower(x: str) -> str:
    return f"list_transform({_tokens(x)}, lambda w: lower(w))"


def _blank_words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _collapsed(x: str) -> str:
    return _strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def _normal(x: str) -> str:
    x = rf"regexp_replace({x}, '\r\n?', chr(10), 'g')"
    x = rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    x = rf"regexp_replace({x}, '[ \t\f\v]+(\n|$)', '\1', 'g')"
    return rf"regexp_replace({_strip(x)}, '\n{{3,}}', chr(10) || chr(10), 'g')"


def _content(x: str) -> str:
    stop = _in(T.all_stopwords())
    words = f"list_filter(regexp_extract_all(lower({x}), '[a-z][a-z'']+'), lambda w: NOT list_contains({stop}, w) AND length(trim(w, '''')) >= 3)"
    return f"list_transform({words}, lambda w: trim(w, ''''))"


def _headings(x: str) -> str:
    return rf"list_filter(list_transform(string_split({x}, chr(10)), lambda l: regexp_extract(l, '^\s*(?:\*\*)?\s*(\d+(?:\.\d+)*)\b', 1)), lambda h: h <> '')"


def _items(x: str) -> str:
    return rf"len(list_filter(string_split({x}, chr(10)), lambda l: regexp_matches(l, '^\s*(?:[-*]|\d+[.)])\s+')))"


def _sentences(x: str) -> str:
    return rf"string_split(regexp_replace({x}, '([.!?])\s+([A-Z0-9\"''(\[])', '\1' || chr(1) || '\2', 'g'), chr(1))"


def _repeats(x: str) -> str:
    lines = f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {_strip('l')}), lambda l: l <> '')"
    long = f"list_transform(list_filter({_sentences(x)}, lambda s: len({_blank_words('s')}) >= 8), lambda s: lower({_strip('s')}))"
    share = lambda a: f"(len({a}) - len(list_distinct({a}))) / greatest(len({a}), 1)::DOUBLE"
    return f"((len({lines}) >= 6 AND {share(lines)} > 0.35) OR (len({long}) >= 6 AND {share(long)} > 0.25))"


def _copied(s: str, r: str) -> str:
    own = f"list_distinct(list_filter({s}, lambda w: length(w) >= 4 AND NOT list_contains({_in(C.COPY_STOPWORDS)}, w)))"
    return f"CASE WHEN len({own}) = 0 THEN 0.0 ELSE len(list_intersect({own}, list_distinct({r}))) / len({own})::DOUBLE END"


def _uniform(*key: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(key)})), 1, 8))::BIGINT / 4294967296.0"


def uniform(*key: Column | str) -> Column:
    return T.hash_uniform(*[F.lit(k) if isinstance(k, str) else k.cast("string") for k in key])


# Scalars


@query("P01_P04_P18_source_ids", f"WITH n AS (SELECT doc_id, {_normal('text')} AS t FROM documents) SELECT doc_id, substr(sha1(t), 1, 16) AS source_id, length(t) AS chars FROM n")
def source_ids(spark, d):
    rows = docs(spark, d).select("doc_id", T.normalise(F.col("text")).alias("t"))
    return rows.select("doc_id", T.source_id(F.col("t")).alias("source_id"), F.length("t").cast("long").alias("chars"))


@query(
    "P02_P03_P05_P19_words",
    f"""SELECT doc_id, len({_tokens('text')}) AS words, len({_blank_words('text')}) AS blank_words, length(text) AS chars,
    sha256(array_to_string({_lower('text')}, ' ')) AS lowered FROM documents""",
)
def words(spark, d):
    t = F.col("text")
    return docs(spark, d).select(
        "doc_id", T.word_count(t).cast("long").alias("words"), F.size(T.whitespace_words(t)).cast("long").alias("blank_words"), F.length(t).cast("long").alias("chars"), F.sha2(F.array_join(T.lower_tokens(t), " "), 256).alias("lowered")
    )


@query(
    "P06_P07_J07_J08_U03_copy_and_markers",
    f"""WITH p AS (SELECT a.doc_id, {_lower('a.text')} AS s, {_lower('b.text')} AS r FROM documents a JOIN documents b ON b.doc_id = a.doc_id - 1),
    m AS (SELECT *, len(list_filter(r, lambda w: list_contains({_in(C.TARGET_MARKERS)}, w))) AS n FROM p)
    SELECT doc_id, round_even({_copied('s', 'r')}, 3) AS copy_rate, n AS markers, round_even(CASE WHEN len(r) = 0 THEN 0.0 ELSE n / len(r)::DOUBLE END, 4) AS ratio FROM m""",
)
def copy_and_markers(spark, d):
    rows = docs(spark, d).select("doc_id", T.lower_tokens(F.col("text")).alias("s"))
    before = rows.select((F.col("doc_id") + 1).alias("doc_id"), F.col("s").alias("r"))
    n = T.markers(F.col("r"))
    ratio = F.coalesce(F.try_divide(n, F.size("r")), F.lit(0.0))
    return rows.join(before, "doc_id").select("doc_id", F.bround(T.copied_share(F.col("s"), F.col("r")), 3).alias("copy_rate"), n.cast("long").alias("markers"), F.bround(ratio, 4).alias("ratio"))


_NUMBERED = "array_to_string(list_transform(string_split(text, chr(10)), lambda l, i: i || '. ' || l), chr(10))"


@query(
    "P08_P09_structure",
    f"WITH n AS (SELECT doc_id, text, {_NUMBERED} AS t FROM documents) SELECT doc_id, array_to_string({_headings('t')}, ',') AS headings, {_items('t')} AS items, {_items('text')} AS plain_items FROM n",
)
def structure(spark, d):
    numbered = F.array_join(F.transform(F.split("text", "\n", -1), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
    rows = docs(spark, d).withColumn("t", numbered)
    return rows.select(
        "doc_id", F.array_join(T.heading_numbers(F.col("t")), ",").alias("headings"), T.list_items(F.col("t")).cast("long").alias("items"), T.list_items(F.col("text")).cast("long").alias("plain_items")
    )


@query("P10_P11_repeated_text", f"SELECT doc_id, len({_sentences('text')}) AS sentences, {_repeats('text')} AS repeated FROM documents")
def repeated_text(spark, d):
    t = F.col("text")
    return docs(spark, d).select("doc_id", F.size(T.sentences(t)).cast("long").alias("sentences"), T.has_repeats(t).alias("repeated"))


@query("P12_strip_fences", f"SELECT doc_id, sha256({_strip('text')}) AS sha FROM documents")
def strip_fences(spark, d):
    fenced = F.concat(F.lit("\n```json\n"), "text", F.lit("\n```\n"))
    return docs(spark, d).select("doc_id", F.sha2(T.strip_fences(fenced), 256).alias("sha"))


def _answers(spark, d) -> DataFrame:
    """Raw judge answers of labelled documents: most JSON in a fence, some broken, some no object."""
    rows = spark.read.parquet(f"{d}/labels.parquet")
    low, kind = F.when(F.col("quality") == 0, 2.5).otherwise(4.5), F.col("doc_id") % 10
    body = F.to_json(F.struct(low.alias("overall"), F.when(kind == 1, F.lit("4.5")).alias("accuracy"), F.lit("4").alias("adequacy"), F.when(F.col("toxic") == 1, "yes").otherwise("no").alias("critical_error"), F.when(kind == 2, 2).otherwise(3).alias("readability")))
    answer = F.when(kind == 3, "{bad").when(kind == 4, "5").otherwise(F.concat(F.lit("```json\n"), body, F.lit("\n```")))
    return rows.select(F.col("doc_id").cast("string").alias("id"), answer.alias("response"))


_VERDICT = """
v AS (SELECT doc_id::VARCHAR AS id, doc_id % 10 IN (3, 4) AS error, CASE WHEN quality = 0 THEN 2.5 ELSE 4.5 END AS overall, toxic = 1 AS critical, doc_id % 10 = 2 AS severe FROM labels),
verdicts AS (SELECT id, error, CASE WHEN error THEN NULL ELSE overall END AS overall, error OR critical OR severe OR overall < 4 AS flagged FROM v)"""


@query("P13_P14_P15_F15_C07_verdicts", f"WITH {_VERDICT} SELECT id, error, overall, flagged FROM verdicts")
def verdicts(spark, d):
    rows = gates.judged(_answers(spark, d))
    return rows.select("id", F.col("judge_error").isNotNull().alias("error"), F.try_variant_get("judge_score", "$.overall", "double").alias("overall"), F.col("judge_flagged").alias("flagged"))


_FEATURES = rf"""
f AS (SELECT *, length(text) AS char_count, len({_blank_words('text')}) AS word_count, length(text) - length(replace(text, chr(10), '')) + 1 AS line_count,
    len(regexp_extract_all(text, '\n\s*\n')) + 1 AS paragraph_count, len(regexp_extract_all(text, '[.!?]+(?:\s|$)')) AS sentence_count_approx,
    length(text) - length(replace(text, chr(10), '')) AS newline_count, regexp_matches(text, '\d') AS contains_number,
    regexp_matches(text, '(?:^|\n)\s*(?:[-*]|\d+[.)])\s+') AS contains_structured_marker,
    regexp_matches({_strip('text')}, '^(?:\*\*)?\d+(?:\.\d+)*\b') AS starts_with_heading_like FROM documents),
features AS (SELECT *, round_even(newline_count / greatest(char_count, 1)::DOUBLE * 1000, 2) AS newline_density,
    round_even(word_count / nullif(sentence_count_approx, 0)::DOUBLE, 2) AS avg_words_per_sentence FROM f)"""
_COLUMNS = [*profile.FEATURES, "newline_count", *profile.FLAGS]


@query("P20_P21_P22_P23_P24_P25_P26_features", f"WITH {_FEATURES} SELECT doc_id, {', '.join(_COLUMNS)}, sha256({_collapsed('text')}) AS clean FROM features")
def features(spark, d):
    rows = profile.features(docs(spark, d))
    whole = [F.col(c).cast("long") if t == "int" else F.col(c) for c, t in rows.select(*_COLUMNS).dtypes]
    return rows.select("doc_id", *whole, F.sha2(T.collapsed(F.col("text")), 256).alias("clean"))


@query(
    "P27_snippets",
    rf"""WITH c AS (SELECT doc_id, {_collapsed('text')} AS t FROM documents), h AS (SELECT *, regexp_extract(substr(t, 1, 257), '^(.*)\s', 1) AS head FROM c)
    SELECT doc_id, CASE WHEN length(t) <= 260 THEN t WHEN head = '' THEN '...' ELSE regexp_replace(head, '\s+$', '') || ' ...' END AS snippet FROM h""",
)
def snippets(spark, d):
    return docs(spark, d).select("doc_id", T.snippet(F.col("text")).alias("snippet"))


# Profile


@query("S16_preview", "SELECT doc_id, substr(text, 1, 80) AS head FROM documents ORDER BY doc_id LIMIT 3")
def preview(spark, d):
    return docs(spark, d).orderBy("doc_id").limit(3).select("doc_id", F.substring("text", 1, 80).alias("head"))


@query(
    "P39_column_profile",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(DISTINCT {c}) AS unique_values FROM documents" for c, t in (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"))),
)
def column_profile(spark, d):
    return profile.column_profile(docs(spark, d))


@query(
    "A01_A02_F03_F04_health",
    r"""SELECT unnest(['rows', 'columns', 'missing_text', 'blank_text', 'unique_text', 'duplicate_text']) AS metric,
    unnest([count(*), 5, count(*) FILTER (text IS NULL), count(*) FILTER (NOT regexp_matches(coalesce(text, ''), '\S')), count(DISTINCT text), count(*) - count(DISTINCT text)]) AS value FROM documents""",
)
def health(spark, d):
    return profile.health(docs(spark, d))


@query("A02_missing", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, round_even((count(*) - count({c})) * 100.0 / count(*), 2) AS missing_pct FROM documents" for c in ("doc_id", "text", "lang", "source", "n_chars")))
def missing(spark, d):
    return profile.missing(docs(spark, d))


@query(
    "A03_A04_U02_M11_value_counts",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n, round_even(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM documents GROUP BY {c}" for c in ("lang", "source")),
)
def value_counts(spark, d):
    return profile.value_counts(docs(spark, d), ["lang", "source"])


_STATS = [("count", "count({c})::DOUBLE"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"), ("min", "min({c})::DOUBLE")]
_STATS += [(f"{p * 100:g}%", f"quantile_cont({{c}}::DOUBLE, {p})") for p in profile.PERCENTILES] + [("max", "max({c})::DOUBLE")]


@query(
    "A05_M01_M02_describe",
    f"WITH {_FEATURES} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, unnest([{', '.join(chr(39) + s + chr(39) for s, _ in _STATS)}]) AS stat, unnest([{', '.join(f'round_even({x.format(c=c)}, 2)' for _, x in _STATS)}]) AS value FROM features" for c in profile.FEATURES),
)
def describe(spark, d):
    return profile.describe(profile.features(docs(spark, d)))


@query("A06_flag_counts", f"WITH {_FEATURES} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) FILTER ({c}) AS n, round_even(count(*) FILTER ({c}) * 100.0 / count(*), 2) AS pct FROM features" for c in profile.FLAGS))
def flag_counts(spark, d):
    return profile.flag_counts(profile.features(docs(spark, d)))


@query("A07_correlations", f"WITH {_FEATURES} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN round_even(corr({a}, {b}), 3) END AS r FROM features" for a in profile.FEATURES for b in profile.FEATURES))
def correlations(spark, d):
    return profile.correlations(profile.features(docs(spark, d)))


@query(
    "A08_W14_group_stats",
    f"""WITH {_FEATURES} SELECT lang, count(*) AS n, round_even(avg(word_count), 2) AS mean_words, median(word_count) AS median_words, min(word_count)::INTEGER AS min_words,
    max(word_count)::INTEGER AS max_words, round_even(avg(paragraph_count), 2) AS mean_paragraphs, round_even(avg(sentence_count_approx), 2) AS mean_sentences FROM features GROUP BY lang""",
)
def group_stats(spark, d):
    return profile.group_stats(profile.features(docs(spark, d)), "lang")


@query("F05_thresholds", f"WITH {_FEATURES} " + " UNION ALL ".join(f"SELECT {t} AS threshold, count(*) FILTER (word_count < {t}) AS n, round_even(count(*) FILTER (word_count < {t}) * 100.0 / count(*), 2) AS pct FROM features" for t in profile.THRESHOLDS))
def thresholds(spark, d):
    return profile.below_thresholds(profile.features(docs(spark, d)))


@query(
    "A28_S15_histogram",
    f"""WITH {_FEATURES}, e AS (SELECT min(word_count) AS low, (max(word_count) - min(word_count)) / 50.0 AS width FROM features)
    SELECT least(floor((word_count - low) / width::DOUBLE), 49)::INTEGER AS bin, count(*) AS n FROM features, e GROUP BY 1""",
)
def histogram(spark, d):
    return profile.histogram(profile.features(docs(spark, d)), "word_count")


@query("A28_S15_boxes", f"WITH {_FEATURES} SELECT lang, min(word_count)::INTEGER AS low, quantile_cont(word_count, 0.25) AS q1, median(word_count) AS median, quantile_cont(word_count, 0.75) AS q3, max(word_count)::INTEGER AS high FROM features GROUP BY lang")
def boxes(spark, d):
    return profile.box(profile.features(docs(spark, d)), "word_count", "lang")


@query(
    "W07_extremes",
    f"""WITH {_FEATURES} (SELECT 'short' AS which, doc_id, word_count::INTEGER AS word_count FROM features ORDER BY word_count, doc_id LIMIT 10)
    UNION ALL (SELECT 'long', doc_id, word_count::INTEGER FROM features ORDER BY word_count DESC, doc_id LIMIT 10)""",
)
def extremes(spark, d):
    rows = profile.features(docs(spark, d)).select("doc_id", "word_count")
    both = [profile.extremes(rows, 10, "doc_id", long).select(F.lit(name).alias("which"), "doc_id", "word_count") for name, long in (("short", False), ("long", True))]
    return both[0].unionByName(both[1])


_TERMS = f"c AS (SELECT doc_id, lang, {_content('text')} AS w FROM documents), t AS (SELECT doc_id, lang, unnest(w) AS term FROM c)"


@query("A09_W08_P28_U05_terms", f"WITH {_TERMS} SELECT term, count(*) AS n FROM t GROUP BY term ORDER BY n DESC, term LIMIT 25")
def terms(spark, d):
    return profile.top(profile.terms(docs(spark, d)), 25)


@query(
    "A10_W08_P29_bigrams",
    f"WITH {_TERMS}, b AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM c) SELECT term, count(*) AS n FROM b GROUP BY term ORDER BY n DESC, term LIMIT 25",
)
def bigrams(spark, d):
    return profile.top(profile.terms(docs(spark, d), pairs=True), 25)


_RANKED = f"WITH {_TERMS}, g AS (SELECT lang, term, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term)::INTEGER AS rank FROM t GROUP BY lang, term)"


@query("A11_W09_terms_by_group", f"{_RANKED} SELECT lang, term, n, rank FROM g WHERE rank <= 10")
def terms_by_group(spark, d):
    return profile.top_by_group(profile.terms(docs(spark, d), by="lang"), "lang", 10)


@query("W10_ranks_as_columns", f"{_RANKED} SELECT rank, " + ", ".join(f"max(term) FILTER (lang = '{x}') AS {x}" for x in ("de", "en", "es", "fr")) + " FROM g WHERE rank <= 10 GROUP BY rank")
def ranks_as_columns(spark, d):
    return profile.ranks_as_columns(terms_by_group(spark, d), "lang", ["de", "en", "es", "fr"])


# Pool and sample

_SIZE, _SEED = 90, 42
_POOL = f"""
n AS (SELECT DISTINCT {_normal('text')} AS source FROM documents WHERE text IS NOT NULL),
w AS (SELECT source, substr(sha1(source), 1, 16) AS source_id, len({_tokens('source')})::INTEGER AS source_word_count, length(source)::INTEGER AS source_char_count FROM n),
e AS (SELECT * FROM w WHERE source_word_count >= 100),
q AS (SELECT quantile_cont(source_word_count, 1 / 3::DOUBLE) AS one, quantile_cont(source_word_count, 2 / 3::DOUBLE) AS two FROM e),
pool AS (SELECT e.*, CASE WHEN source_word_count <= one THEN 'short' WHEN source_word_count <= two THEN 'medium' ELSE 'long' END AS source_length_bucket FROM e, q)"""
_SAMPLE = f"""{_POOL},
r AS (SELECT *, row_number() OVER (PARTITION BY source_length_bucket ORDER BY md5(concat_ws(':', CASE source_length_bucket WHEN 'short' THEN '42' WHEN 'medium' THEN '43' ELSE '44' END, source_id)), source_id) AS rank FROM pool),
sample AS (SELECT *, format('eval_{{:05d}}', row_number() OVER (ORDER BY source_length_bucket, source_word_count, source_id) - 1) AS id FROM r WHERE rank <= {_SIZE // 3})"""
_SPARES = pool.most_replacements(_SIZE, 5)
_SPARE = f"""{_SAMPLE},
ranked AS (SELECT *, row_number() OVER (PARTITION BY source_length_bucket ORDER BY md5(concat_ws(':', '1042', source_id)), source_id)::INTEGER AS cand_rank FROM pool WHERE source_id NOT IN (SELECT source_id FROM sample)),
spare AS (SELECT * FROM ranked WHERE cand_rank <= {_SPARES})"""


def _pool(spark, d) -> DataFrame:
    return pool.eligible_pool(docs(spark, d), 100)


def _sample(spark, d) -> DataFrame:
    return pool.sample(_pool(spark, d), _SIZE, _SEED)


def _texts(spark, d, rows: DataFrame) -> DataFrame:
    return pool.with_texts(rows, docs(spark, d))


@query("S01_F01_F02_W01_A13_pool", f"WITH {_POOL} SELECT source_id, source_word_count, source_char_count, source_length_bucket FROM pool")
def eligible(spark, d):
    return _pool(spark, d)


@query("W02_W03_W05_P30_U01_sample", f"WITH {_SAMPLE} SELECT id, source_id, source_word_count, source_length_bucket FROM sample")
def sampled(spark, d):
    return _sample(spark, d).select("id", "source_id", "source_word_count", "source_length_bucket")


@query(
    "W04_sample_one_seed",
    f"""WITH {_POOL}, r AS (SELECT source_id, source_length_bucket, row_number() OVER (PARTITION BY source_length_bucket ORDER BY md5(concat_ws(':', '42', source_id)), source_id) AS rank FROM pool)
    SELECT source_id, source_length_bucket FROM r WHERE rank <= {_SIZE // 3}""",
)
def sampled_one_seed(spark, d):
    return pool.stratified(_pool(spark, d), pool.allocation(_SIZE), _SEED, per_bucket_seed=False).select("source_id", "source_length_bucket")


def _summary_sql(rows: str) -> str:
    return f"""SELECT source_length_bucket, count(*) AS n, min(source_word_count) AS min_words, median(source_word_count) AS median_words, max(source_word_count) AS max_words,
    round_even(avg(source_word_count), 2) AS mean_words, {_SIZE // 3}::INTEGER AS planned, {round(100 / 3, 2)}::DOUBLE AS planned_pct FROM {rows} GROUP BY source_length_bucket"""


@query("A14_pool_summary", f"WITH {_POOL} {_summary_sql('pool')}")
def pool_summary(spark, d):
    return pool.bucket_summary(_pool(spark, d), _SIZE)


@query("A15_A17_A18_sample_summary", f"WITH {_SAMPLE} {_summary_sql('sample')}")
def sample_summary(spark, d):
    return pool.bucket_summary(_sample(spark, d), _SIZE)


@query("A16_sampling_report", f"WITH {_POOL} SELECT unnest(['original', 'eligible', 'removed', 'target']) AS metric, unnest([(SELECT count(*) FROM documents), (SELECT count(*) FROM pool), (SELECT count(*) FROM documents) - (SELECT count(*) FROM pool), {_SIZE}]) AS rows")
def sampling_report(spark, d):
    return pool.sampling_report(docs(spark, d), _pool(spark, d), _SIZE)


@query("W06_J06_U04_replacements", f"WITH {_SPARE} SELECT source_id, source_length_bucket, cand_rank FROM spare")
def replacements(spark, d):
    eligible_ = _pool(spark, d)
    spare = pool.replacements(eligible_, pool.sample(eligible_, _SIZE, _SEED), _SPARES, _SEED)
    return spare.select("source_id", "source_length_bucket", "cand_rank")


@query(
    "J14_C04_assignment",
    f"""WITH {_SPARE}, f AS (SELECT id, source_length_bucket, row_number() OVER (PARTITION BY source_length_bucket ORDER BY id) AS n FROM sample WHERE {_uniform("'fail'", 'id')} < 0.3)
    SELECT f.id, f.source_length_bucket, spare.source_id FROM f LEFT JOIN spare ON spare.source_length_bucket = f.source_length_bucket AND spare.cand_rank = f.n""",
)
def assignment(spark, d):
    eligible_ = _pool(spark, d)
    chosen = pool.sample(eligible_, _SIZE, _SEED)
    spare = pool.replacements(eligible_, chosen, _SPARES, _SEED).select("source_id", "source_length_bucket", "cand_rank")
    return pool.assigned(chosen.where(uniform("fail", F.col("id")) < 0.3), spare).select("id", "source_length_bucket", "source_id")


# Pairs, gates, scores


def _pairs(spark, d) -> DataFrame:
    """(id, source, reference): turns and their answers, documents with themselves, and numbered or listed documents with their plain text."""
    turns = spark.read.parquet(f"{d}/conversations.parquet")
    after = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference"))
    said = turns.where("role = 'user'").join(after, ["conv_id", "turn"])
    rows = said.select(F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("id"), F.col("text").alias("source"), "reference")
    own = docs(spark, d)
    listed = F.array_join(F.transform(F.split("text", "\n", -1), lambda x: F.concat(F.lit("1. "), x)), "\n")
    rows = rows.unionByName(own.select(F.concat_ws("-", F.lit("d"), "doc_id").alias("id"), F.col("text").alias("source"), F.col("text").alias("reference")))
    rows = rows.unionByName(own.select(F.concat_ws("-", F.lit("l"), "doc_id").alias("id"), listed.alias("source"), F.col("text").alias("reference")))
    return rows.withColumn("source_word_count", T.word_count(F.col("source")))


_PAIRS = f"""
pairs AS (
    SELECT concat_ws('-', 'c', a.conv_id, a.turn) AS id, a.text AS source, b.text AS reference FROM conversations a JOIN conversations b
    ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND a.role = 'user' AND b.role = 'assistant'
    UNION ALL SELECT concat_ws('-', 'd', doc_id), text, text FROM documents
    UNION ALL SELECT concat_ws('-', 'l', doc_id), array_to_string(list_transform(string_split(text, chr(10)), lambda l: '1. ' || l), chr(10)), text FROM documents),
toks AS (SELECT *, {_lower('source')} AS s, {_lower("coalesce(reference, '')")} AS r, coalesce(reference, '') AS ref FROM pairs),
meas AS (SELECT *, len(r) AS reference_word_count, len(r) / greatest(len(s), 1)::DOUBLE AS ratio, {_copied('s', 'r')} AS copied, len(list_filter(r, lambda w: list_contains({_in(C.TARGET_MARKERS)}, w))) AS marks,
    {_headings('source')} AS hs, {_headings('ref')} AS hr, {_items('source')} AS li, {_items('ref')} AS lr FROM toks),
gated AS (SELECT *, CASE WHEN len(r) = 0 THEN 0.0 ELSE marks / len(r)::DOUBLE END AS share FROM meas),
flags AS (SELECT *, array_to_string(list_filter([
    CASE WHEN NOT regexp_matches(ref, '\\S') THEN '{C.EMPTY}' END, CASE WHEN marks < 3 AND share < 0.012 THEN '{C.LANGUAGE}' END, CASE WHEN ratio < 0.4 OR ratio > 2.2 THEN '{C.RATIO}' END,
    CASE WHEN copied > 0.65 THEN '{C.COPIED}' END, CASE WHEN {_repeats('ref')} THEN '{C.REPEATED}' END, CASE WHEN len(hs) > 0 AND NOT list_has_any(hs, hr) THEN '{C.HEADINGS}' END,
    CASE WHEN li >= 3 AND lr < greatest(1, floor(li * 0.4)) THEN '{C.LISTS}' END], lambda f: f IS NOT NULL), ',') AS flags FROM gated)"""


@query(
    "F06_F07_F08_F09_F10_F11_F12_F13_P16_P17_M12_hard_gates",
    f"""WITH {_PAIRS} SELECT id, flags, flags = '' AS hard_gate_passed, CASE WHEN flags = '' THEN 'accepted' ELSE 'failed_hard_gates' END AS status, reference_word_count, round_even(ratio, 3) AS ratio,
    round_even(copied, 3) AS copy_rate, marks AS markers, round_even(share, 4) AS marker_ratio, len(list_filter(string_split(ref, chr(10) || chr(10)), lambda c: regexp_matches(c, '\\S'))) AS chunks,
    array_to_string(hs, ',') AS expected, array_to_string(hr, ',') AS found FROM flags""",
)
def hard_gates(spark, d):
    rows = gates.hard_gates(_pairs(spark, d))
    return rows.select(
        "id", F.array_join("flags", ",").alias("flags"), "hard_gate_passed", "status", F.col("reference_word_count").cast("long").alias("reference_word_count"), F.col("source_reference_word_ratio").alias("ratio"), "copy_rate",
        F.col("indonesian_marker_count").cast("long").alias("markers"), F.col("indonesian_marker_ratio").alias("marker_ratio"), F.col("reference_chunk_count").cast("long").alias("chunks"),
        F.array_join("heading_numbers_expected", ",").alias("expected"), F.array_join("heading_numbers_found", ",").alias("found"),
    )


def _qa(spark, d) -> DataFrame:
    """QA rows of labelled documents (the label passes the gates or not) and of benchmark items, which nobody scores; nothing merged yet."""
    rows = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").cast("string").alias("id"), "quality")
    rows = rows.unionByName(spark.read.parquet(f"{d}/benchmark.parquet").select(F.concat(F.lit("b"), "item_id").alias("id"), F.lit(1).alias("quality")))
    id_, good = F.col("id"), F.col("quality") == 1
    none = F.array().cast("array<string>")
    return rows.select(
        id_.alias("id"), F.when(good, none).otherwise(F.array(F.lit(C.REPEATED))).alias("flags"), none.alias("notes"), good.alias("hard_gate_passed"), F.when(good, C.ACCEPTED).otherwise(C.FAILED).alias("status"),
        F.lit(None).cast("double").alias("cometkiwi_score"), F.lit(None).cast("double").alias("cometkiwi_threshold"), F.lit(None).cast("boolean").alias("cometkiwi_flagged"), F.lit(None).cast("boolean").alias("judge_flagged"),
        F.lit(False).alias("judge_selected"), F.lit(None).cast("string").alias("judge_skip_reason"), F.lit(None).cast("variant").alias("judge_score"), F.lit(None).cast("string").alias("judge_raw_response"),
    )


def _scores(spark, d) -> DataFrame:
    """QE scores of all documents, unlabelled ones too; a twentieth are errors."""
    id_ = F.col("doc_id").cast("string")
    rows = docs(spark, d).select(id_.alias("id"), F.bround(uniform("qe", id_), 4).alias("x"), (F.col("doc_id") % 20 == 0).alias("bad"))
    return rows.select("id", F.when(~F.col("bad"), F.col("x")).alias("cometkiwi_score"), F.when(F.col("bad"), "failed").alias("cometkiwi_error"))


_QE = f"""
scores AS (SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 20 <> 0 THEN round_even({_uniform("'qe'", 'doc_id::VARCHAR')}, 4) END AS score FROM documents),
q AS (SELECT quantile_cont(score, 0.10) AS p10, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.75) AS q3 FROM scores),
thr AS (SELECT greatest(p10, q1 - 1.5 * (q3 - q1)) AS threshold FROM q),
qa AS (SELECT doc_id::VARCHAR AS id, quality = 1 AS passed, CASE WHEN quality = 1 THEN [] ELSE ['{C.REPEATED}'] END AS flags FROM labels
    UNION ALL SELECT 'b' || item_id, true, []::VARCHAR[] FROM benchmark),
qe AS (SELECT qa.id, passed, flags || CASE WHEN s.id IS NULL THEN [] WHEN score IS NULL THEN ['{C.QE_ERROR}'] WHEN score <= threshold THEN ['{C.QE_LOW}'] ELSE [] END AS flags, score, s.id IS NOT NULL AS met,
    CASE WHEN s.id IS NOT NULL THEN score IS NULL OR score <= threshold END AS qe_flagged, threshold FROM qa LEFT JOIN scores s ON s.id = qa.id CROSS JOIN thr)"""


@query("A19_qe_threshold", f"WITH {_QE} SELECT round_even(threshold, 4) AS threshold FROM thr")
def qe_threshold(spark, d):
    return merge.qe_threshold(_scores(spark, d)).select(F.bround("threshold", 4).alias("threshold"))


@query(
    "J02_J12_F18_C11_R02_R03_qe_merge",
    f"WITH {_QE} SELECT id, array_to_string(flags, ',') AS flags, score AS cometkiwi_score, CASE WHEN met THEN round_even(threshold, 4) END AS cometkiwi_threshold, qe_flagged AS cometkiwi_flagged, CASE WHEN met AND score IS NULL THEN 'cometkiwi_error: failed' ELSE '' END AS notes FROM qe",
)
def qe_merge(spark, d):
    scores = _scores(spark, d)
    twice = merge.merge_qe(merge.merge_qe(_qa(spark, d), scores), scores)  # a second merge changes nothing
    return twice.select("id", F.array_join("flags", ",").alias("flags"), "cometkiwi_score", "cometkiwi_threshold", "cometkiwi_flagged", F.array_join("notes", ",").alias("notes"))


@query("A20_A23_qe_stats", f"WITH {_QE} SELECT count(*) AS merged, count(*) FILTER (score <= threshold) AS flagged, count(*) FILTER (score IS NULL) AS errors, round_even(max(threshold), 4) AS threshold FROM qe WHERE met")
def qe_stats(spark, d):
    stats = merge.qe_stats(_qa(spark, d), _scores(spark, d))
    return stats.select(*[F.col(c).cast("long").alias(c) for c in ("merged", "flagged", "errors")], "threshold")


_MODES = ("all", "flagged", "sample")


@query(
    "F14_R04_judge_selection",
    f"WITH {_QE}, m AS (SELECT unnest({_in(list(_MODES))}) AS mode) SELECT mode, id FROM qe, m WHERE id = '7' OR mode = 'all' OR coalesce(qe_flagged, false) OR len(list_filter(flags, lambda f: f <> '{C.QE_LOW}')) > 0 OR (mode = 'sample' AND {_uniform(chr(39) + '1041' + chr(39), 'id')} < 0.05)",
)
def judge_selection(spark, d):
    qa = merge.merge_qe(_qa(spark, d), _scores(spark, d))
    each = [qa.where(gates.judge_selected(m, forced=["7"])).select(F.lit(m).alias("mode"), "id") for m in _MODES]
    return each[0].unionByName(each[1]).unionByName(each[2])


_FINAL = f"""{_QE}, {_VERDICT.strip()},
fin AS (SELECT qe.id, passed, qe.flags || CASE WHEN v2.error THEN ['{C.JUDGE_ERROR}'] WHEN v2.flagged THEN ['{C.JUDGE_LOW}'] ELSE [] END AS flags, qe_flagged, v2.flagged AS judge_flagged, coalesce(qe_flagged, false) OR coalesce(v2.flagged, false) AS soft, v2.id IS NOT NULL AS judged
    FROM qe LEFT JOIN verdicts v2 ON v2.id = qe.id),
final AS (SELECT *, CASE WHEN passed AND NOT soft THEN 'accepted' WHEN passed THEN 'accepted_with_soft_flags' ELSE 'failed_hard_gates' END AS status FROM fin)"""


def _final(spark, d) -> DataFrame:
    return merge.finalised(_qa(spark, d), _scores(spark, d), gates.judged(_answers(spark, d)))


@query("J01_C08_C09_C12_F16_finalize", f"WITH {_FINAL} SELECT id, array_to_string(flags, ',') AS flags, qe_flagged AS cometkiwi_flagged, judge_flagged, status FROM final")
def finalize(spark, d):
    return _final(spark, d).select("id", F.array_join("flags", ",").alias("flags"), "cometkiwi_flagged", "judge_flagged", "status")


@query("A21_A24_judge_stats", f"WITH {_FINAL} SELECT count(*) AS merged, count(*) FILTER (judge_flagged AND NOT list_contains(flags, '{C.JUDGE_ERROR}')) AS flagged, count(*) FILTER (list_contains(flags, '{C.JUDGE_ERROR}')) AS errors FROM final WHERE judged")
def judge_stats(spark, d):
    return merge.judge_stats(_qa(spark, d), gates.judged(_answers(spark, d)))


@query(
    "A22_final_counts",
    f"""WITH {_FINAL} SELECT (SELECT count(*) FROM documents) AS records, count(*) AS qa_records, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'accepted_with_soft_flags') AS accepted_with_soft_flags,
    count(*) FILTER (NOT passed) AS hard_gate_failures, count(*) FILTER (soft) AS soft_qa_flagged FROM final""",
)
def final_counts(spark, d):
    return merge.final_counts(docs(spark, d), _final(spark, d))


@query("F17_J13_remediation", f"WITH {_FINAL} SELECT id FROM final WHERE passed AND soft")
def remediation(spark, d):
    rows = merge.to_remediate(_final(spark, d)).select("id")
    return rows.join(docs(spark, d).select(F.col("doc_id").cast("string").alias("id")), "id")


@query("F21_pending_judge", f"WITH {_QE} SELECT id, false AS judge_selected, '{C.PENDING}' AS judge_skip_reason FROM qa")
def pending_judge(spark, d):
    return gates.mark_pending(_qa(spark, d), True).select("id", "judge_selected", "judge_skip_reason")


@query(
    "J03_qa_of_records",
    f"WITH {_QE} SELECT d.doc_id::VARCHAR AS id, coalesce(array_to_string(qa.flags, ','), '') AS flags, coalesce(passed, true) AS hard_gate_passed FROM documents d LEFT JOIN qa ON qa.id = d.doc_id::VARCHAR",
)
def qa_of_records(spark, d):
    records = docs(spark, d).select(F.col("doc_id").cast("string").alias("id"), F.lit("short").alias("source_length_bucket"), F.lit(1).alias("source_word_count"))
    qa = _qa(spark, d).withColumns({"source_id": F.col("id"), "source_length_bucket": F.lit("short"), "source_word_count": F.lit(1)})
    return merge.qa_of(records, qa).select("id", F.array_join("flags", ",").alias("flags"), "hard_gate_passed")


@query("J04_J05_C17_W12_W13_pending", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 50")
def pending(spark, d):
    done = spark.read.parquet(f"{d}/labels.parquet")
    return merge.first_by_id(merge.pending(docs(spark, d).select("doc_id"), done, "doc_id"), 50, "doc_id")


@query("U06_S03_upsert", "SELECT doc_id AS id, coalesce(l.quality::BIGINT + 10, d.n_chars) AS value FROM documents d LEFT JOIN labels l USING (doc_id)")
def upsert(spark, d):
    new = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("id"), (F.col("quality").cast("long") + 10).alias("value"))
    return merge.upsert(docs(spark, d).select(F.col("doc_id").alias("id"), F.col("n_chars").alias("value")), new)


@query("R01_R05_flags", "SELECT doc_id, CASE WHEN n_chars > 1000 AND source <> 'b' THEN 'a,b,x' ELSE 'a,b' END AS flags FROM documents")
def flags(spark, d):
    own = F.array(F.lit("a"), F.lit("b"))
    once = merge.with_flag(own, "x", F.col("n_chars") > 1000)
    again = merge.with_flag(merge.with_flag(once, "b", F.lit(True)), "x", F.col("n_chars") > 1000)
    return docs(spark, d).select("doc_id", F.array_join(again, ",").alias("flags"))


@query(
    "P31_records",
    f"WITH {_SAMPLE} SELECT id, source_word_count, source_char_count, source_length_bucket, 'en' AS source_language, 'id' AS target_language, 1::INTEGER AS source_chunk_count, sha256(source) AS sha FROM sample",
)
def records(spark, d):
    from tessera.plans.rounds import record_of

    rows = record_of(_texts(spark, d, _sample(spark, d)).withColumn("reference", F.lit("")))
    return rows.select("id", "source_word_count", "source_char_count", "source_length_bucket", "source_language", "target_language", "source_chunk_count", F.sha2("source", 256).alias("sha"))


@query("M10_precision", "SELECT n::INTEGER AS n, round_even(1.96 * sqrt(0.25 / n), 3) AS margin, round_even(196 * sqrt(0.25 / n), 1) AS margin_points, round_even(2.8 / sqrt(n::DOUBLE), 3) AS effect FROM (SELECT unnest([100, 200, 300, 500, 1000]) AS n)")
def precision(spark, d):
    return profile.precision_table(spark)


# Topics


def _weighted(spark, d) -> tuple[DataFrame, DataFrame, int]:
    corpus = docs(spark, d)
    n, counts = corpus.count(), written(topics.term_counts(corpus))
    words = topics.vocabulary(counts, n)
    return topics.weights(counts, words, n), words, n


_VOCABULARY = f"""{_TERMS}, tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term), d AS (SELECT count(*) AS n FROM documents),
voc AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS total FROM tf GROUP BY term HAVING count(*) >= 5 AND count(*) <= 0.6 * (SELECT n FROM d) ORDER BY total DESC, term LIMIT 1200)"""
_TFIDF = f"""{_VOCABULARY},
raw AS (SELECT doc_id, term, tf / sum(tf) OVER (PARTITION BY doc_id)::DOUBLE * (ln((1.0 + n) / (df + 1)) + 1) AS raw FROM tf JOIN voc USING (term), d),
weighted AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


@query("A12_F19_J09_W11_vocabulary", f"WITH {_VOCABULARY} SELECT term, df, total FROM voc")
def vocabulary(spark, d):
    return _weighted(spark, d)[1]


@query("M03_M04_M05_tfidf", f"WITH {_TFIDF} SELECT doc_id, term, round(weight, 6) AS weight FROM weighted")
def tfidf(spark, d):
    return _weighted(spark, d)[0].select("doc_id", "term", F.round("weight", 6).alias("weight"))


def _topics(spark, d) -> tuple:
    weighted, words, _ = _weighted(spark, d)
    ship(spark)
    weighted = written(weighted)
    terms_ = [r["term"] for r in words.collect()]  # bounded by the vocabulary's size
    found, shares = topics.components(topics.gram(weighted, terms_))
    loads = topics.loadings(spark, found, terms_)
    return topics.assigned(weighted, loads), loads, shares


@query("M06_M07_M08_M09_A25_W15_W16_W17_topics")
def topic_summary(spark, d):
    assigned, loads, shares = _topics(spark, d)
    return topics.summary(profile.features(docs(spark, d)).select("doc_id", "word_count"), assigned, loads, shares)


@query(
    "M06_gram",
    f"""WITH {_TFIDF}, pairs AS (SELECT a.term, b.term AS other, sum(a.weight * b.weight) AS x FROM weighted a JOIN weighted b USING (doc_id) GROUP BY a.term, b.term)
    SELECT term, round(max(x) FILTER (term = other), 5) AS own, round(sum(x), 4) AS total FROM pairs GROUP BY term""",
)
def gram(spark, d):
    weighted, words, _ = _weighted(spark, d)
    ship(spark)
    terms_ = [r["term"] for r in words.collect()]  # bounded by the vocabulary's size
    matrix = topics.gram(weighted, terms_)
    rows = [(t, float(matrix[k, k]), float(matrix[k].sum())) for k, t in enumerate(terms_)]
    return spark.createDataFrame(rows, "term string, own double, total double").select("term", F.round("own", 5).alias("own"), F.round("total", 4).alias("total"))


@query(
    "M07_M08_M09_W15_W16_W17_topic_checks",
    f"SELECT format('topic_{{:02d}}', i) AS topic, true AS component, true AS ordered, true AS terms, true AS assigned FROM range(1, {topics.TOPICS + 1}) t(i)",
)
def topic_checks(spark, d):
    """Is each topic a unit component of the gram matrix with its share of the trace, positive where strongest, weaker than the one before and unlike it;
    are its terms those of the largest loadings; and does each of its documents score highest there?"""
    import numpy as np

    weighted, words, _ = _weighted(spark, d)
    ship(spark)
    weighted = written(weighted)
    terms_ = [r["term"] for r in words.collect()]  # bounded by the vocabulary's size
    matrix = topics.gram(weighted, terms_)
    found, shares = topics.components(matrix)
    loads = topics.loadings(spark, found, terms_)
    scores = weighted.join(F.broadcast(loads), "term").groupBy("doc_id", "topic").agg(F.abs(F.sum(F.col("weight") * F.col("loading"))).alias("score"))
    best = scores.groupBy("doc_id").agg(F.max("score").alias("best"))
    own = topics.assigned(weighted, loads).join(scores, ["doc_id", "topic"]).join(best, "doc_id")
    assigned = {r[0]: r[1] for r in own.groupBy("topic").agg(F.bool_and(F.col("score") >= F.col("best") - 1e-12)).collect()}
    tops = {}
    for r in topics.top_terms(loads).orderBy("topic", "rank").collect():
        tops.setdefault(r["topic"], []).append(r["term"])
    rows, total = [], float(np.trace(matrix))
    for k, (v, share) in enumerate(zip(found, shares, strict=True)):
        name = f"topic_{k + 1:02d}"
        component = np.abs(matrix @ v - share * total * v).max() < 1e-6 * total and abs(v @ v - 1) < 1e-9 and v[np.abs(v).argmax()] > 0
        ordered = k == 0 or shares[k - 1] >= share and abs(found[:k] @ v).max() < 1e-6
        want = [t for _, t in sorted(zip(-v, terms_, strict=True))][: topics.TERMS]
        rows.append((name, bool(component), bool(ordered), tops[name] == want, assigned.get(name, True)))
    return spark.createDataFrame(rows, "topic string, component boolean, ordered boolean, terms boolean, assigned boolean")


@query(
    "A26_J10_crosstab",
    f"""WITH {_FEATURES}, q AS (SELECT quantile_cont(word_count, 1 / 3::DOUBLE) AS one, quantile_cont(word_count, 2 / 3::DOUBLE) AS two FROM features),
    b AS (SELECT lang, CASE WHEN word_count <= one THEN 'short' WHEN word_count <= two THEN 'medium' ELSE 'long' END AS b FROM features, q)
    SELECT lang, {', '.join(f"round_even(count(*) FILTER (b = '{x}') / count(*)::DOUBLE, 3) AS {x}" for x in C.BUCKETS)} FROM b GROUP BY lang""",
)
def crosstab(spark, d):
    rows = profile.features(docs(spark, d)).select("lang", "word_count")
    rows = rows.withColumn("bucket", pool.bucket_of(F.col("word_count"), pool.tercile_edges(rows, "word_count")))
    return topics.crosstab(rows, "lang", "bucket", C.BUCKETS)


@query(
    "A27_F20_share_audit",
    """WITH p AS (SELECT source, count(*) / sum(count(*)) OVER ()::DOUBLE AS pool_share FROM documents GROUP BY source), s AS (SELECT source, count(*) / sum(count(*)) OVER ()::DOUBLE AS sample_share FROM documents WHERE doc_id % 7 = 0 AND source <> 'src3' GROUP BY source),
    a AS (SELECT source, coalesce(pool_share, 0.0) AS p, coalesce(sample_share, 0.0) AS s FROM p FULL JOIN s USING (source))
    SELECT source, round_even(p, 3) AS pool_share, round_even(s, 3) AS sample_share, round_even(abs(p - s), 3) AS abs_gap, round_even(p, 3) >= 0.05 AND round_even(s, 3) = 0 AS under_covered FROM a""",
)
def share_audit(spark, d):
    rows = docs(spark, d)
    audit = topics.share_audit(rows, rows.where("doc_id % 7 = 0 and source <> 'src3'"), "source")
    marked = topics.under_covered(audit).select("source", F.lit(True).alias("__low"))
    return audit.join(marked, "source", "left").select("source", "pool_share", "sample_share", "abs_gap", F.coalesce("__low", F.lit(False)).alias("under_covered"))


# Models, with the stand-ins


@query(
    "S11_S13_C01_C06_P32_P33_stand_ins",
    f"""WITH {_SAMPLE} SELECT id, round_even({_uniform("source || '|' || source")}, 4) AS cometkiwi_score, NULL::VARCHAR AS cometkiwi_error FROM sample""",
)
def stand_ins(spark, d):
    """Prompts are sent to a stand-in that answers with the prompt's text, and the pairs to one that scores by a hash."""
    from tessera.functions import prompts
    from tessera.sources.providers import FakeChat, FakeScorer, answered, scored

    rows = _texts(spark, d, _sample(spark, d)).select("id", "source", prompts.generation(F.col("source")).alias("messages"))
    answers = answered(rows, FakeChat(echo=True), "fake")
    pairs = rows.join(answers, "id").select("id", "source", T.strip_fences(F.col("response")).alias("reference"))
    return scored(pairs, FakeScorer(), "fake").select("id", "cometkiwi_score", "cometkiwi_error")


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_PROMPT = " || ".join([_quoted(JUDGED[0]), "source", _quoted(JUDGED[1]), "source", _quoted(JUDGED[2])])


@query(
    "C07_C12_judge_calls",
    f"""WITH {_SAMPLE}, d AS (SELECT id, {_uniform("'fake'", _PROMPT)} AS x FROM sample)
    SELECT id, x < 0.1 AS error, CASE WHEN x >= 0.1 THEN round(3 + x * 2, 6) END AS overall, x < 0.1 OR x > 0.97 OR 3 + x * 2 < {C.JUDGE_MIN_OVERALL} OR 3 + round_even(x * 2, 0) < {C.JUDGE_MIN_ACCURACY} AS flagged FROM d""",
)
def judge_calls(spark, d):
    """A stand-in judges pairs by a hash of its prompt; a tenth of its calls fail and become flagged rows with their error."""
    from tessera.functions import prompts
    from tessera.sources.providers import FakeChat, answered

    rows = _texts(spark, d, _sample(spark, d))
    asked = rows.select("id", prompts.judging(F.col("source"), F.col("source")).alias("messages"))
    done = gates.judged(answered(asked, FakeChat(fail_share=0.1), "fake"), error="error")
    return done.select("id", F.col("judge_error").isNotNull().alias("error"), F.round(F.try_variant_get("judge_score", "$.overall", "double"), 6).alias("overall"), F.col("judge_flagged").alias("flagged"))


@query(
    "A18_F02_refusals",
    f"""WITH {_SAMPLE} SELECT unnest(['sample as planned', 'sample of another size', 'sample of longer texts', 'two rows', 'equal lengths']) AS what,
    unnest([(SELECT count(*) FROM sample) <> {_SIZE}, true, (SELECT min(source_word_count) FROM sample) < 100000, true, true]) AS refused""",
)
def refusals(spark, d):
    """What the checks of pools and samples refuse."""
    eligible_ = _pool(spark, d)
    chosen = written(pool.sample(eligible_, _SIZE, _SEED))

    def refused(check: Callable[[], object]) -> bool:
        try:
            check()
        except ValueError:
            return True
        return False

    rows = [
        ("sample as planned", refused(lambda: pool.check_sample(chosen, _SIZE, 100))),
        ("sample of another size", refused(lambda: pool.check_sample(chosen, _SIZE + 3, 100))),
        ("sample of longer texts", refused(lambda: pool.check_sample(chosen, _SIZE, 100_000))),
        ("two rows", refused(lambda: pool.tercile_edges(chosen.limit(2), "source_word_count"))),
        ("equal lengths", refused(lambda: pool.tercile_edges(chosen.withColumn("source_word_count", F.lit(7)), "source_word_count"))),
    ]
    return spark.createDataFrame(rows, "what string, refused boolean")


@query("C02_C03_rounds", f"WITH {_SAMPLE} SELECT id, source_length_bucket, true AS own_source, true AS once FROM sample")
def rounds(spark, d):
    """Every sampled id ends once, with a text of its own from its bucket of the pool, which no other id has."""
    from pyspark.sql import Window

    from tessera.plans.rounds import generate
    from tessera.sources.config import Config
    from tessera.sources.providers import FakeChat

    config = Config(sample_size=_SIZE, copy_rate_max=0.9, max_retries=1, max_replacements=2)
    eligible_ = _pool(spark, d)
    chosen = written(_texts(spark, d, pool.sample(eligible_, _SIZE, _SEED)))
    spare = pool.replacements(eligible_, chosen, pool.most_replacements(_SIZE, config.max_replacements), _SEED)
    made = generate(chosen, written(_texts(spark, d, spare)), FakeChat(fail_share=0.1), config, fail_on_exhaustion=False)
    ended = made.qa.where("hard_gate_passed").unionByName(made.exhausted).select("id", "source_id", "source_length_bucket")
    own = eligible_.select("source_id", F.col("source_length_bucket").alias("bucket"))
    count = F.count("*").over(Window.partitionBy("source_id"))
    rows = ended.withColumn("times", count).join(own, "source_id", "left")
    return rows.select("id", "source_length_bucket", F.coalesce(F.col("bucket") == F.col("source_length_bucket"), F.lit(False)).alias("own_source"), (F.col("times") == 1).alias("once"))


@query("R06_P34_prompt_ids", f"SELECT conv_id, turn, sha256(array_to_string({_tokens('text')}, ' ')) AS left_over, length(text) AS part_chars FROM conversations WHERE text IS NOT NULL")
def prompt_ids(spark, d):
    """Words stand in for ids: a turn's role and text as a prompt, then the text again as what was generated."""
    from tessera.functions import prompts

    rows = spark.read.parquet(f"{d}/conversations.parquet").where("text is not null")
    said, asked = T.tokens(F.col("text")), F.concat(F.array("role"), T.tokens(F.col("text")))
    parts = prompts.multimodal(F.array(F.struct("role", F.col("text").alias("content"))))
    left = prompts.without_prompt(F.concat(asked, said), asked)
    return rows.select("conv_id", "turn", F.sha2(F.array_join(left, " "), 256).alias("left_over"), F.length(parts[0]["content"][0]["text"]).cast("long").alias("part_chars"))


_KEPT = _strip("coalesce(text, '')")


@query(
    "P35_P36_answers",
    f"""SELECT doc_id, CASE WHEN {_KEPT} <> '' THEN sha256({_KEPT} || CASE WHEN doc_id % 5 = 1 THEN ' end' ELSE '' END)
    ELSE sha256(CASE doc_id % 5 WHEN 1 THEN 'end' WHEN 3 THEN 'later' ELSE 'none' END) END AS answer FROM documents""",
)
def answers(spark, d):
    """Answers of models in five shapes: a message's string, its list of parts, a choice's text, a root's object, a message's object; 'none' where there is no text."""
    from tessera.sources.providers import answer_text

    ship(spark)
    t, say = F.coalesce(F.col("text"), F.lit("")), lambda **fields: F.struct(*[v.alias(k) for k, v in fields.items()])
    of = lambda content: F.to_json(say(choices=F.array(say(message=say(content=content)))))
    parts = F.array(say(text=t, content=F.lit("x")), say(text=F.lit(""), content=F.lit(" end")))
    shapes = [of(t), of(parts), F.to_json(say(choices=F.array(say(text=t)))), F.to_json(say(response=say(content=F.lit("later"), text=t))), of(say(text=t))]
    shape = F.element_at(F.array(*shapes), (F.col("doc_id") % 5 + 1).cast("int"))
    return docs(spark, d).select("doc_id", shape.alias("body")).select("doc_id", F.sha2(F.coalesce(answer_text("body"), F.lit("none")), 256).alias("answer"))


@query("S03_S04_keyed_lines", "SELECT doc_id AS id, coalesce(l.quality::BIGINT + 10, d.n_chars) AS value, l.quality IS NULL AS first FROM documents d LEFT JOIN labels l USING (doc_id)")
def keyed_lines(spark, d):
    """JSON lines in which labelled documents come twice, blank lines between: read (the last line wins), written, read again."""
    from pyspark.sql import types as S

    from tessera.sources.store import read_keyed, write_keyed

    schema = S.StructType().add("id", S.LongType()).add("value", S.LongType()).add("first", S.BooleanType())
    line = lambda value, first: F.to_json(F.struct(F.col("doc_id").alias("id"), value.alias("value"), F.lit(first).alias("first"))).alias("line")
    old = docs(spark, d).select(F.lit(1).alias("part"), "doc_id", line(F.col("n_chars"), True))
    new = spark.read.parquet(f"{d}/labels.parquet").select(F.lit(3).alias("part"), "doc_id", line(F.col("quality").cast("long") + 10, False))
    gap = new.select(F.lit(2).alias("part"), "doc_id", F.lit("").alias("line"))
    at = shared_place(spark)
    # The feature is one file, in which lines have an order.
    old.unionByName(gap).unionByName(new).orderBy("part", "doc_id").coalesce(1).select("line").write.text(f"{at}/in")
    write_keyed(read_keyed(spark, f"{at}/in", schema), f"{at}/out")
    return read_keyed(spark, f"{at}/out", schema)


def _stages(spark, d, folder: str, **more):
    from tessera.plans.stages import Stages
    from tessera.sources.config import Config

    names = ("output", "qa_output", "manifest_output", "cometkiwi_output", "judge_output")
    config = Config(dataset_name=f"{d}/documents.parquet", sample_size=_SIZE, copy_rate_max=1.0, **{n: f"{folder}/{n}" for n in names}, **more)
    ship(spark)
    return Stages(spark, config)


@query(
    "C16_C18_S05_S06_manifest",
    f"""WITH {_SAMPLE} SELECT 'eligible' AS entry, count(*) AS value FROM pool UNION ALL SELECT 'records', 0 UNION ALL SELECT 'size', {_SIZE}
    UNION ALL SELECT source_length_bucket, count(*) FROM sample GROUP BY source_length_bucket""",
)
def manifest(spark, d):
    """A dry run writes the manifest and nothing else."""
    from tessera.sources.store import exists, read_manifest

    stages = _stages(spark, d, shared_place(spark), dry_run=True)
    stages.run("generate")
    sampling = read_manifest(spark, str(stages.config.manifest_output))["sampling"]
    rows = {"eligible": sampling["eligible_rows"], "size": sampling["sample_size"], "records": int(exists(spark, str(stages.config.output))), **sampling["bucket_counts"]}
    return spark.createDataFrame(list(rows.items()), "entry string, value bigint")


@query(
    "C05_C10_C15_C17_C19_S08_S09_stages",
    f"""SELECT unnest(['records', 'qa', 'scored', 'judged', 'kept by resume', 'passed gates', 'unscored after remediation', 'failed gates after remediation']) AS what,
    unnest([{_SIZE}, {_SIZE}, {_SIZE}, {_SIZE}, {_SIZE}, {_SIZE}, 0, 0]) AS differs""",
)
def stage_counts(spark, d):
    """All stages with the stand-ins, resumed, then remediated: what was there stays, what is replaced loses its scores."""
    from dataclasses import replace

    from tessera import schemas
    from tessera.sources.store import read_keyed

    stages = _stages(spark, d, shared_place(spark), enable_cometkiwi=True, enable_judge=True, judge_mode="all", max_replacements=9)
    stages.run("all")
    c = stages.config
    read = lambda at, schema: read_keyed(spark, str(at), schema)
    records = written(read(c.output, schemas.RECORD).select("id", "source", "reference"))
    counts = [("records", records.count()), ("qa", read(c.qa_output, schemas.QA).count()), ("scored", read(c.cometkiwi_output, schemas.QE).count()), ("judged", read(c.judge_output, schemas.JUDGE).count())]
    type(stages)(spark, replace(c, resume=True)).run("all")
    counts.append(("kept by resume", read(c.output, schemas.RECORD).select("id", "source", "reference").intersect(records).count()))
    qa = written(read(c.qa_output, schemas.QA).drop("judge_score"))
    counts.append(("passed gates", qa.where("hard_gate_passed").count()))
    soft = merge.to_remediate(qa).select("id")
    type(stages)(spark, c).run("remediate")
    done, scores = read(c.qa_output, schemas.QA), read(c.cometkiwi_output, schemas.QE)
    again = done.join(soft, "id").where("retry_count > 0")
    counts += [("unscored after remediation", again.join(scores, "id").count()), ("failed gates after remediation", done.where("not hard_gate_passed").count())]
    return spark.createDataFrame(counts, "what string, differs bigint")


# Settings, connectors and their refusals: results that don't depend on the tables


def _listed(rows: list[tuple[str, str]]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in rows) + ") AS t(what, found)"


def _refused(call: Callable[[], object], *kinds: type[Exception]) -> str:
    try:
        call()
    except kinds:
        return "refused"
    return "taken"


@query("S02_fallback", "SELECT count(*) AS n, 1 AS failed, true AS named FROM documents")
def fallback(spark, d):
    """The corpus from the second place, as the first doesn't exist."""
    from tessera.sources.corpus import load_corpus

    rows, name, failed = load_corpus(spark, f"{d}/nowhere.parquet", f"{d}/documents.parquet")
    return rows.agg(F.count("*").alias("n")).select("n", F.lit(len(failed)).alias("failed"), F.lit(name == f"{d}/documents.parquet").alias("named"))


@query(
    "S08_S09_S10_S14_P37_P38_F22_settings",
    _listed(
        [("sample size of a section", "9"), ("old name of a limit", "3.5"), ("path", "x/y"), ("limit", "5"), ("dry run", "True"), ("resume unset", "False"), ("stage of the command line", "judge"), ("resume of the command line", "False"),
         ("judge over HTTP", "far"), ("local judge", "near"), ("provider over HTTP", "HttpChat"), ("local provider", "LocalChat"), ("no key", "refused"), ("unknown provider", "refused"), ("local model that generates", "refused"),
         ("unknown stage", "refused"), ("unknown stage of the command line", "refused"), ("time", "20xx-xx-xxTxx:xx:xxZ")]
    ),
)
def settings(spark, d):
    import os
    from dataclasses import replace

    from tessera.cli import parser
    from tessera.plans.stages import Stages, generator_of, now
    from tessera.sources.config import of, override
    from tessera.sources.providers import chat_of

    c = of({"sampling": {"sample_size": 9}, "judge": {"judge_min_adequacy": 3.5, "judge_provider": "some_local", "judge_model": "far"}, "qwen3vl": {"qwen3vl_model": "near"}, "paths": {"output": "x/y"}, "junk": 1})
    new, asked = override(c, dry_run=True, limit=5), parser().parse_args(["--config", "c.json", "--stage", "judge", "--no-resume"])
    key = "TESSERA_QUERY_KEY"
    os.environ[key] = "k"
    far = replace(c, judge_provider="some_api", generator_provider="some_api", api_key_env=key)
    clock = "".join("x" if x.isdigit() and k > 1 else x for k, x in enumerate(now()))
    rows = [
        ("sample size of a section", str(c.sample_size)), ("old name of a limit", str(c.judge_min_accuracy)), ("path", str(c.output)), ("limit", str(new.sample_size)), ("dry run", str(new.dry_run)), ("resume unset", str(new.resume)),
        ("stage of the command line", asked.stage), ("resume of the command line", str(asked.resume)), ("judge over HTTP", far.judge_model_id), ("local judge", c.judge_model_id),
        ("provider over HTTP", type(generator_of(far)).__name__), ("local provider", type(chat_of(c.judge_provider, c)).__name__),
        ("no key", _refused(lambda: generator_of(replace(far, api_key_env=key + "_2")), RuntimeError)), ("unknown provider", _refused(lambda: chat_of("nobody", c), ValueError)),
        ("local model that generates", _refused(lambda: generator_of(replace(far, generator_provider="some_local")), ValueError)),
        ("unknown stage", _refused(lambda: Stages(spark, c).run("nothing"), ValueError)), ("unknown stage of the command line", _refused(lambda: parser().parse_args(["--config", "c", "--stage", "nothing"]), SystemExit)), ("time", clock),
    ]
    del os.environ[key]
    return spark.createDataFrame(rows, "what string, found string")


@query(
    "C13_C14_J11_calls",
    _listed([("starts of four calls, ten a minute", "0 6 12 18"), ("waits of six retries", "5 10 20 40 60 60"), ("waits of a lasting failure", "5 10"), ("another failure", "refused"), ("scores that don't fit the pairs", "ValueError: 1 scores for 2 pairs")]),
)
def calls(spark, d):
    """Pace and retries against a clock of their own, and a scorer that gives too few scores."""
    from tessera.sources import providers as P

    time, starts, waits = [0.0], [], []
    pace = P.Pace(10, lambda: time[0], lambda s: time.__setitem__(0, time[0] + s))
    for _ in range(4):
        pace.wait()
        starts.append(time[0])

    def failing(times: int) -> Callable[[], bytes]:
        left = [times]

        def call() -> bytes:
            left[0] -= 1
            if left[0] >= 0:
                raise P.Overloaded("later")
            return b""

        return call

    shown = lambda xs: " ".join(f"{x:g}" for x in xs)
    P.retried(failing(6), 6, waits.append)
    six, waits = waits, []
    lasting = _refused(lambda: P.retried(failing(9), 2, waits.append), P.Overloaded)
    ship(spark)
    pairs = spark.createDataFrame([("a", "s", "r"), ("b", "s", "r")], "id string, source string, reference string").coalesce(1)
    found = P.scored(pairs, P.FewScores(), "fake").agg(F.max("cometkiwi_error")).first()[0]
    rows = [
        ("starts of four calls, ten a minute", shown(starts)), ("waits of six retries", shown(six)), ("waits of a lasting failure", shown(waits) if lasting == "refused" else lasting),
        ("another failure", _refused(lambda: P.retried(lambda: [][0], 3, waits.append), IndexError)), ("scores that don't fit the pairs", found),
    ]
    return spark.createDataFrame(rows, "what string, found string")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Corpus to stratified sample, summed up by bucket: normalise, identify, deduplicate, filter, cut in terciles, draw."""
    return pool.bucket_summary(_sample(spark, d), _SIZE)
