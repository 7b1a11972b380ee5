"""Generation in bulk rounds: all pending rows are generated and gated together, then retried or replaced."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import constants as C
from tessera import schemas
from tessera.functions import prompts
from tessera.functions import text as T
from tessera.operators.gates import Limits, hard_gates
from tessera.operators.pool import assigned
from tessera.session import written
from tessera.sources.config import Config
from tessera.sources.providers import Chat, answered

SOURCE = ["source", "source_id", "source_word_count", "source_char_count", "source_length_bucket"]


@dataclass(frozen=True)
class Generated:
    records: DataFrame
    qa: DataFrame
    exhausted: DataFrame  # QA rows of ids for which no source passed


def record_of(rows: DataFrame) -> DataFrame:
    """Output records; one chunk each, languages fixed."""
    return rows.select(
        "id", "source", "reference", F.lit("en").alias("source_language"), F.lit("id").alias("target_language"), "source_word_count", "source_char_count", "source_length_bucket", F.lit(1).alias("source_chunk_count")
    )


def as_qa(rows: DataFrame) -> DataFrame:
    """``rows`` in the schema of QA files, what is missing null or its default."""
    out = []
    for f in schemas.QA.fields:
        default = schemas.QA_DEFAULTS.get(f.name)
        empty = F.lit(None) if default is None else F.array() if default == [] else F.lit(default)
        value = F.col(f.name) if f.name in rows.columns else empty
        out.append((F.coalesce(value, empty) if default is not None else value).cast(f.dataType).alias(f.name))
    return rows.select(*out)


def attempt(rows: DataFrame, chat: Chat, config: Config) -> DataFrame:
    """One call for each row (id, source ..., strict): the row with reference, notes and gate columns; errors are failed rows."""
    asked = rows.withColumn("messages", prompts.generation(F.col("source"), F.col("strict")))
    answers = answered(asked, chat, config.generator_model, partitions=config.api_concurrency, max_tokens=config.max_generation_tokens)
    answers = written(answers.withColumn("reference", T.strip_fences(F.col("response"))))  # a call isn't repeated
    gated = hard_gates(rows.join(answers.select("id", "reference", "error"), "id"), Limits(config.length_ratio_min, config.length_ratio_max, config.copy_rate_max))
    bad = F.col("error").isNotNull()
    gated = gated.withColumns(
        {
            "flags": F.when(bad, F.array(F.lit(C.GENERATION_ERROR))).otherwise(F.col("flags")),
            "status": F.when(bad, C.GENERATION_ERROR).otherwise(F.col("status")),
            "hard_gate_passed": F.col("hard_gate_passed") & ~bad,
            "notes": F.when(bad, F.array("error")).otherwise(F.array().cast("array<string>")),
            "source_chunk_count": F.when(~bad, 1),
        }
    )
    for c in ("reference_word_count", "source_reference_word_ratio", "copy_rate", "indonesian_marker_count", "indonesian_marker_ratio", "reference_chunk_count"):
        gated = gated.withColumn(c, F.when(~bad, F.col(c)))
    return gated


def generate(sampled: DataFrame, candidates: DataFrame, chat: Chat, config: Config, fail_on_exhaustion: bool = True) -> Generated:
    """Records and QA rows of ``sampled`` (id, source ...), failed sources replaced from ``candidates`` (bucket, cand_rank, source ...).

    At most (retries + 1) x (replacements + 1) rounds, each written once. Within a round, failed ids of a
    bucket take its next unused candidates in the order of ids. If none is left, the stage fails, or the
    rows are returned as exhausted.
    """
    rows = sampled.select("id", *SOURCE).withColumns({"retry_count": F.lit(0), "replacement_count": F.lit(0)})
    records, qa, lost = [], [], []
    for replacement in range(config.max_replacements + 1):
        for retry in range(config.max_retries + 1):
            rows = rows.withColumns({"retry_count": F.lit(retry), "strict": F.lit(retry > 0)})
            tried = written(attempt(rows, chat, config))
            good = tried.where("hard_gate_passed")
            records.append(record_of(good))
            qa.append(as_qa(good))
            last = tried.where("not hard_gate_passed")
            rows = last.select("id", *SOURCE, "replacement_count")
            if last.isEmpty():
                return Generated(_all(records), _all(qa), as_qa(last))
        if replacement == config.max_replacements:
            break
        # Candidates used by earlier rounds come first in each bucket's order.
        taken = assigned(last, candidates)
        lost.append(as_qa(last.join(taken.where("source_id is null").select("id"), "id", "left_semi")))
        found = written(taken.where("source_id is not null").withColumn("replacement_count", F.lit(replacement + 1)))
        used = found.select("source_id")
        candidates = written(_reranked(candidates.join(used, "source_id", "left_anti")))
        rows = found.select("id", *SOURCE, "replacement_count")
        if rows.isEmpty():
            break
    else:
        last = last.limit(0)
    if not rows.isEmpty():
        lost.append(as_qa(last))
    exhausted = _all(lost) if lost else as_qa(last)
    if fail_on_exhaustion and not exhausted.isEmpty():
        raise RuntimeError(f"no source passed the gates for {exhausted.select('id').first()[0]}")
    return Generated(_all(records), _all(qa), exhausted)


def _reranked(candidates: DataFrame) -> DataFrame:
    """Candidates that are left, numbered anew; they are as few as a sample's replacements."""
    from pyspark.sql import Window

    return candidates.withColumn("cand_rank", F.row_number().over(Window.partitionBy("source_length_bucket").orderBy("cand_rank")))


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
