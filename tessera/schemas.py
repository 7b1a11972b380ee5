"""Schemas of the exchanged files. Reading with them drops unknown fields; defaults fill missing ones."""

from pyspark.sql import types as T

_S, _I, _D, _B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_L = T.ArrayType(T.StringType())


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


RECORD = _schema(
    id=_S, source=_S, reference=_S, source_language=_S, target_language=_S,
    source_word_count=_I, source_char_count=_I, source_length_bucket=_S, source_chunk_count=_I,
)

QA = _schema(
    id=_S, source_id=_S, status=_S, flags=_L, hard_gate_passed=_B, retry_count=_I, replacement_count=_I, source_length_bucket=_S,
    source_word_count=_I, reference_word_count=_I, source_reference_word_ratio=_D, copy_rate=_D, indonesian_marker_count=_I,
    indonesian_marker_ratio=_D, source_chunk_count=_I, reference_chunk_count=_I, heading_numbers_expected=_L, heading_numbers_found=_L,
    cometkiwi_score=_D, cometkiwi_flagged=_B, cometkiwi_threshold=_D, judge_selected=_B, judge_skip_reason=_S, judge_score=T.VariantType(),
    judge_flagged=_B, judge_raw_response=_S, notes=_L,
)

QE = _schema(id=_S, cometkiwi_model=_S, cometkiwi_score=_D, cometkiwi_error=_S, created_at_utc=_S)

JUDGE = _schema(id=_S, judge_provider=_S, judge_model=_S, judge_score=T.VariantType(), judge_flagged=_B, judge_raw_response=_S, judge_error=_S, created_at_utc=_S)

MESSAGES = T.ArrayType(_schema(role=_S, content=_S))

#: Defaults of fields that a QA file may lack.
QA_DEFAULTS = {"flags": [], "hard_gate_passed": False, "retry_count": 0, "replacement_count": 0, "heading_numbers_expected": [], "heading_numbers_found": [], "judge_selected": False, "notes": []}
