"""Hard gates over (source, reference) pairs, judge selection and verdict."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import constants as C
from tessera.functions import text as T


@dataclass(frozen=True)
class Limits:
    ratio_min: float = C.LENGTH_RATIO_MIN
    ratio_max: float = C.LENGTH_RATIO_MAX
    copy_max: float = C.COPY_RATE_MAX


def measured(pairs: DataFrame) -> DataFrame:
    """``pairs`` (source, reference, source_word_count, ...) with what the gates ask for; each text is tokenised and split into lines and sentences once."""
    source, reference = F.col("source"), F.coalesce(F.col("reference"), F.lit(""))
    rows = pairs.withColumns({"reference": reference, "__s": T.lower_tokens(source), "__r": T.lower_tokens(reference), "__sl": T.lines(source), "__rl": T.lines(reference)})
    rows = rows.withColumns(
        {
            "reference_word_count": F.size("__r"),
            "__ratio": F.size("__r") / F.greatest("source_word_count", F.lit(1)),
            "__copied": T.copied_share(F.col("__s"), F.col("__r")),
            "indonesian_marker_count": T.markers(F.col("__r")),
            "heading_numbers_expected": T.headings_in(F.col("__sl")),
            "heading_numbers_found": T.headings_in(F.col("__rl")),
            "__items": T.items_in(F.col("__sl")),
            "__kept_items": T.items_in(F.col("__rl")),
            "__lines": T.full_lines(F.col("__rl")),
            "__sentences": T.long_sentences(F.col("reference")),
            "reference_chunk_count": T.chunk_count(F.col("reference")),
        }
    )
    share = F.coalesce(F.try_divide("indonesian_marker_count", "reference_word_count"), F.lit(0.0))
    return rows.withColumns({"__marked": share, "__repeated": T.repeated(F.col("__lines"), F.col("__sentences"))}).drop("__s", "__r", "__sl", "__rl", "__lines", "__sentences")


def gate_flags(limits: Limits | None = None) -> Column:
    """Flags of the failed gates in their fixed order, over the columns of ``measured``; metrics are not rounded here."""
    limits = limits or Limits()
    c = F.col
    gates = [
        (C.EMPTY, T.is_blank(c("reference"))),
        (C.LANGUAGE, (c("indonesian_marker_count") < C.MARKER_COUNT_MIN) & (c("__marked") < C.MARKER_RATIO_MIN)),
        (C.RATIO, (c("__ratio") < limits.ratio_min) | (c("__ratio") > limits.ratio_max)),
        (C.COPIED, c("__copied") > limits.copy_max),
        (C.REPEATED, c("__repeated")),
        (C.HEADINGS, (F.size("heading_numbers_expected") > 0) & ~F.arrays_overlap("heading_numbers_expected", "heading_numbers_found")),
        (C.LISTS, (c("__items") >= 3) & (c("__kept_items") < F.greatest(F.lit(1), F.floor(c("__items") * 0.4)))),
    ]
    return F.array_compact(F.array(*[F.when(failed, name) for name, failed in gates]))


def hard_gates(pairs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """QA columns of each pair; metrics rounded half to even to 3 or 4 places."""
    rows = measured(pairs).withColumn("flags", gate_flags(limits))
    passed = F.size("flags") == 0
    rows = rows.withColumns(
        {
            "hard_gate_passed": passed,
            "status": F.when(passed, C.ACCEPTED).otherwise(C.FAILED),
            "source_reference_word_ratio": F.bround("__ratio", 3),
            "copy_rate": F.bround("__copied", 3),
            "indonesian_marker_ratio": F.bround("__marked", 4),
        }
    )
    return rows.drop("__ratio", "__copied", "__marked", "__items", "__kept_items", "__repeated")


def judge_selected(mode: str = "sample", audit_rate: float = 0.05, seed: int = 42, forced: list[str] | None = None, key: str = "id") -> Column:
    """Which rows a judge sees: forced ids; all; QE-flagged; otherwise flagged; in mode sample a seeded audit share."""
    qe = F.coalesce(F.col("cometkiwi_flagged"), F.lit(False))
    other = F.exists("flags", lambda f: f != C.QE_LOW)
    audit = F.lit(False) if mode == "flagged" else T.hash_uniform(F.lit(str(seed + 999)), F.col(key)) < audit_rate
    return F.col(key).isin(*(forced or [])) | F.lit(mode == "all") | qe | other | audit


def verdict(score: Column, min_overall: float = C.JUDGE_MIN_OVERALL, min_accuracy: float = C.JUDGE_MIN_ACCURACY) -> Column:
    """Is a judge's score (variant object) a flag: critical, too low overall or in accuracy, or a severe rubric value."""
    overall = T.number_of(score, "overall", 0.0)
    accuracy = T.number_of(score, "accuracy", T.number_of(score, "adequacy", 0.0))
    severe = F.lit(False)
    for k in C.RUBRIC:
        severe = severe | (T.number_of(score, k, 5.0) <= C.RUBRIC_SEVERE)
    return T.truth_of(score, "critical_error") | (overall < min_overall) | (accuracy < min_accuracy) | severe


def judged(answers: DataFrame, response: str = "response", error: str | None = None) -> DataFrame:
    """Judge records of raw answers: an answer that isn't a JSON object, or a failed call, is an error and flagged."""
    parsed = T.json_of(F.col(response))
    rows = answers.withColumn("judge_score", parsed)
    is_object = F.coalesce(F.schema_of_variant("judge_score").startswith("OBJECT"), F.lit(False))
    failed = F.col(error) if error else F.lit(None).cast("string")
    rows = rows.withColumn("judge_error", F.coalesce(failed, F.when(~is_object, F.lit("no JSON object in the answer"))))
    good = F.col("judge_error").isNull()
    return rows.withColumns(
        {
            "judge_flagged": F.when(good, verdict(F.col("judge_score"))).otherwise(F.lit(True)),
            "judge_score": F.when(good, F.col("judge_score")),
            "judge_raw_response": F.when(good, F.col(response)),
        }
    )


def mark_pending(qa: DataFrame, enabled: bool) -> DataFrame:
    """Rows not judged yet are marked as waiting, if a judge is enabled."""
    waits = F.lit(enabled) & F.col("judge_score").isNull() & F.col("judge_flagged").isNull()
    return qa.withColumns(
        {
            "judge_selected": F.when(waits, F.lit(False)).otherwise(F.col("judge_selected")),
            "judge_skip_reason": F.when(waits, F.lit(C.PENDING)).otherwise(F.col("judge_skip_reason")),
        }
    )
