"""The queries of this folder, by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.shared import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.pieces import encode

    return encode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.chat import format_chats

    said = "</s>[INST] ok [/INST]"
    columns = ["conv_id", "turn", "role", "text"]
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(columns).unionByName(own)
    return format_chats(turns, tokenizer_file("byte_bpe_50k.json"), with_output=False)


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.topk import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages")).drop("url")


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.fingerprint import edited_likeness

    return edited_likeness(table(spark, sf_dir, "documents"))


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those columns of ``op5_fingerprints`` that SQL can express."""
    return fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def packed_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of ``op7_packing``: is each document in pieces that follow one another without a gap, each in a sequence without one?"""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    before = lambda key, at: F.coalesce(F.sum("length").over(Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = packing(spark, sf_dir).withColumns({"own": before("doc_id", "start"), "in_sequence": before("sequence_id", "offset")})
    good = (F.col("own") == F.col("start")) & (F.col("in_sequence") == F.col("offset")) & (F.col("offset") + F.col("length") <= 2048)
    return rows.groupBy("doc_id").agg((F.bool_and(good) & (F.sum("length") == F.max("doc_tokens"))).alias("whole"))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.near_dedup import Rule, near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), Rule(words=3, percent=85))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tessera.llm.suffix_dedup import repeated_spans

    spans = repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select(F.col("id").alias("doc_id"), "start", "end", F.col("like").alias("like_doc_id"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality import fit, scored

    documents = table(spark, sf_dir, "documents")
    return scored(documents, fit(documents, table(spark, sf_dir, "labels")))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.html_extract import extract

    return extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": suffix_dedup,
    "op2_chat_formatting": chat_formatting,
    "op3_exact_top_k": exact_top_k,
    "op4_warc": warc,
    "op5_fingerprints": fingerprints,
    "op6_near_dedup": near_dedup,
    "op7_packing": packing,
    "op8_html_extraction": html_extraction,
    "op9_quality": quality,
    "op10_sentencepiece": sentencepiece,
    "llm_edited_texts": edited_texts,
    "llm_packed_whole": packed_whole,
}


def _components_sql(percent: int, words: int) -> str:
    """Component of every document, for links by shared shingles: doc_id, n_shingles, component_id."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    run = ", ".join(f"w[i + {k}]" for k in range(words))
    return f"""
words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: concat_ws(' ', {run})) END) AS s
    FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * shared >= {percent} * (p.n + q.n - shared)),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
component AS (
    SELECT d.doc_id, any_value(coalesce(n, 0)) AS n_shingles, min(other) AS component_id
    FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id)"""


def _escaped_length(x: str) -> str:
    """Length of a text after the chat template's escapes: one more for each backslash and control string."""
    controls = ["\\", "<|", "<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[PAD]", "[SEP]", "[CLS]"]
    more = " + ".join(f"(length({x}) - length(replace({x}, '{c}', ''))) // {len(c)}" for c in controls)
    return f"(length({x}) + {more})"


#: 40 hex digits as 32 letters of base32: five digits are four letters.
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(sha, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (5 * (3 - i % 4))::BIGINT) & 31) + 1)::BIGINT, 1)), '')"""

ORACLE_SQL: dict[str, str] = {
    "llm_edited_texts": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS own FROM documents),
n AS (SELECT doc_id, own, coalesce(lead(own) OVER (ORDER BY doc_id), first(own) OVER (ORDER BY doc_id)) AS next FROM t)
SELECT doc_id, length(own) AS n_chars, sha256(left(own, length(own) - length(own) // 4) || left(next, length(own) // 4)) AS edited_sha256 FROM n""",
    "llm_packed_whole": "SELECT doc_id, true AS whole FROM documents",
    "op2_chat_formatting": f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
chats AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
        coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
        sum({_escaped_length('role')} + {_escaped_length('text')} + 23)::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM chats""",
    "op4_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha FROM pages),
f AS (SELECT sha, min(page_id) AS first FROM p GROUP BY sha)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to FROM p JOIN f USING (sha)""",
    "op3_exact_top_k": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scores AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op6_near_dedup": f"""
WITH RECURSIVE {_components_sql(85, 3)}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM component""",
}
