"""Values that results depend on."""

# The markers of the target language.
TARGET_MARKERS = (
    "yang dan di ke dari untuk dengan dalam adalah sebagai pada ini itu akan tidak dapat juga karena atau oleh para lebih agar secara terhadap"
    " antara mereka kita siswa pembelajaran penelitian"
).split()

# Source words that don't count as copied.
COPY_STOPWORDS = "a an and are as at be by for from has have in is it of on or that the this to was we with".split()

# Stop words of the term rankings, general and of the domain.
BASE_STOPWORDS = (
    "a an and are as at be been being by can could did do does doing for from had has have having he her here him his how i if in into is it its"
    " itself just may more most must no not of on or our ours out over own same she should so some such than that the their theirs them then there"
    " these they this those through to too under until up very was we were what when where which while who whom why will with you your yours"
).split()
DOMAIN_STOPWORDS = (
    "chapter course section unit students student learning learn learners textbook example examples use using used also one two first second new key"
    " important different provide include includes including focus understanding knowledge concepts concept topic topics discuss discussion explore"
    " exploring study studies"
).split()

# Patterns (Java syntax).
WORD = r"[A-Za-z]+(?:'[A-Za-z]+)?|\d+(?:\.\d+)?"
CONTENT_WORD = r"[a-z][a-z']+"
SENTENCE_BREAK = r"(?<=[.!?])\s+(?=[A-Z0-9\"'(\[])"
HEADING = r"^\s*(?:\*\*)?\s*(\d+(?:\.\d+)*)\b"
LIST_ITEM = r"^\s*(?:[-*]|\d+[.)])\s+"

# Thresholds of the gates and of the verdict.
LENGTH_RATIO_MIN, LENGTH_RATIO_MAX, COPY_RATE_MAX = 0.40, 2.20, 0.65
MARKER_COUNT_MIN, MARKER_RATIO_MIN = 3, 0.012
JUDGE_MIN_OVERALL, JUDGE_MIN_ACCURACY, RUBRIC_SEVERE = 4.0, 4.0, 2.0
RUBRIC = ["accuracy", "acceptability", "readability", "lexical_equivalence", "grammatical_equivalence", "cohesion_coherence", "academic_fluency"]

# Names of flags and statuses in the exchanged files.
EMPTY, LANGUAGE, RATIO, COPIED, REPEATED, HEADINGS, LISTS = (
    "empty_reference", "indonesian_language_id_low_confidence", "source_reference_length_ratio_out_of_range", "copy_rate_too_high",
    "repeated_text_detected", "heading_numbering_not_preserved", "list_structure_not_preserved",
)
QE_LOW, QE_ERROR, JUDGE_LOW, JUDGE_ERROR, GENERATION_ERROR = "cometkiwi_low_score", "cometkiwi_error", "judge_low_score", "judge_error", "generation_error"
ACCEPTED, SOFT, FAILED = "accepted", "accepted_with_soft_flags", "failed_hard_gates"
PENDING = "pending_external_judge_stage"
BUCKETS = ["short", "medium", "long"]
