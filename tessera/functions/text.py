"""Scalar text functions as native Column expressions: Column in, Column out. Nulls stay null unless noted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import constants as C

#: Line breaks of every kind, as one alternative.
LINES = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def _list(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def normalise(text: Column) -> Column:
    """Line breaks as \\n, runs of blanks as one, lines and text stripped, at most one empty line in a row."""
    text = F.regexp_replace(text, r"\r\n?", "\n")
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, r"(?U)[\s&&[^\n]]+(?=\n|\z)", "")
    return F.regexp_replace(strip(text), r"\n{3,}", "\n\n")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(C.WORD), F.lit(0))


def lower_tokens(text: Column) -> Column:
    # The pattern takes ASCII words only, so lower-casing the text first would differ for letters such as the Kelvin sign.
    return F.transform(tokens(text), F.lower)


def word_count(text: Column) -> Column:
    return F.size(tokens(text))


def source_id(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 16)


def copied_share(source_words: Column, reference_words: Column) -> Column:
    """Share of the source's distinct longer content words that the reference has too; 0 without such words."""
    own = F.array_distinct(F.filter(source_words, lambda w: F.length(w) >= 4))
    own = F.array_except(own, _list(C.COPY_STOPWORDS))
    return F.when(F.size(own) == 0, 0.0).otherwise(F.size(F.array_intersect(own, reference_words)) / F.size(own))


def copy_rate(source: Column, reference: Column) -> Column:
    return copied_share(lower_tokens(source), lower_tokens(reference))


def markers(words: Column) -> Column:
    """Number of lower-cased words that mark the target language, repeats counted."""
    known = _list(C.TARGET_MARKERS)
    return F.size(F.filter(words, lambda w: F.array_contains(known, w)))


def marker_stats(text: Column) -> Column:
    words = lower_tokens(text)
    ratio = F.coalesce(F.try_divide(markers(words), F.size(words)), F.lit(0.0))
    return F.struct(markers(words).alias("count"), ratio.alias("ratio"))


def lines(text: Column) -> Column:
    return F.split(text, LINES, -1)


def heading_numbers(text: Column) -> Column:
    return headings_in(lines(text))


def headings_in(lines_: Column) -> Column:
    return F.filter(F.transform(lines_, lambda x: F.regexp_extract(x, "(?U)" + C.HEADING, 1)), lambda x: x != "")


def list_items(text: Column) -> Column:
    return items_in(lines(text))


def items_in(lines_: Column) -> Column:
    # A line ends before its break, so the white space after the sign has to be there.
    return F.size(F.filter(lines_, lambda x: x.rlike("(?U)" + C.LIST_ITEM)))


def sentences(text: Column) -> Column:
    return F.split(text, C.SENTENCE_BREAK, -1)


def _repeated_share(items: Column) -> Column:
    return (F.size(items) - F.size(F.array_distinct(items))) / F.greatest(F.size(items), F.lit(1))


def full_lines(lines_: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(lines_, strip), lambda x: x != "")


def long_sentences(text: Column) -> Column:
    """Sentences of eight words or more, stripped and lower-cased."""
    return F.transform(F.filter(sentences(text), lambda s: F.size(whitespace_words(s)) >= 8), lambda s: F.lower(strip(s)))


def repeated(by_line: Column, by_sentence: Column) -> Column:
    """Six or more lines, over 35 % of them repeats; or six or more sentences of eight words, over 25 % repeats. Arguments should be columns, not expressions."""
    return ((F.size(by_line) >= 6) & (_repeated_share(by_line) > 0.35)) | ((F.size(by_sentence) >= 6) & (_repeated_share(by_sentence) > 0.25))


def has_repeats(text: Column) -> Column:
    return repeated(full_lines(lines(text)), long_sentences(text))


def strip_fences(text: Column) -> Column:
    text = F.regexp_replace(strip(text), r"(?U)\A```(?:\w+)?\s*", "")
    return strip(F.regexp_replace(text, r"(?U)\s*```\n?\z", ""))


def json_of(text: Column) -> Column:
    """The outermost braces of a model's answer as a variant; null where that isn't JSON."""
    clean = strip_fences(text)
    inner = F.regexp_extract(clean, r"(?s)\{.*\}", 0)
    return F.try_parse_json(F.when(inner == "", clean).otherwise(inner))


def whitespace_words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+", -1), lambda w: w != "")


def collapsed(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def line_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit("\n")) + 1


def paragraph_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\n\s*\n")) + 1


def sentence_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[.!?]+(?=\s|\z)"))


def chunk_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n\n", -1), lambda x: x.rlike(r"(?U)\S")))


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"(?U)\S")


def content_words(text: Column, stopwords: list[str] | None = None) -> Column:
    """Lower-case words of three letters or more; the stop list is asked before apostrophes are stripped."""
    stop = _list(stopwords if stopwords is not None else all_stopwords())
    words = F.regexp_extract_all(F.lower(text), F.lit(C.CONTENT_WORD), F.lit(0))
    kept = F.filter(words, lambda w: ~F.array_contains(stop, w) & (F.length(F.btrim(w, F.lit("'"))) >= 3))
    return F.transform(kept, lambda w: F.btrim(w, F.lit("'")))


def all_stopwords(more: list[str] | None = None) -> list[str]:
    return sorted({*C.BASE_STOPWORDS, *C.DOMAIN_STOPWORDS, *(more or [])})


def bigrams(words: Column) -> Column:
    """Pairs of neighbours among ``words``."""
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0)))


def snippet(text: Column, width: int = 260) -> Column:
    """Collapsed text, cut between words so that it fits ``width`` with the sign of omission."""
    sign, whole = " ...", collapsed(text)
    # The longest run of whole words within what is left; the blank after it shows that the last one is whole.
    head = F.regexp_extract(F.concat(F.substring(whole, 1, width - len(sign) + 1), F.lit("")), r"\A(.*)\s", 1)
    return F.when(F.length(whole) <= width, whole).otherwise(F.when(head == "", F.lit(sign.strip())).otherwise(F.concat(F.regexp_replace(head, r"\s+\z", ""), F.lit(sign))))


def number_of(value: Column, key: str, default: float | Column) -> Column:
    """A variant's field as a double, numeric strings and booleans included; the default if absent or not a number."""
    default = F.lit(default) if isinstance(default, float) else default
    return F.coalesce(F.try_variant_get(value, f"$.{key}", "double"), default)


def truth_of(value: Column, key: str) -> Column:
    """A variant's field as a boolean: true; the strings true, 1, yes; numbers but 0; filled lists and objects."""
    field = F.try_variant_get(value, f"$.{key}", "variant")
    kind, shown = F.schema_of_variant(field), F.try_variant_get(value, f"$.{key}", "string")
    return F.coalesce(
        F.when(kind == "BOOLEAN", F.try_variant_get(value, f"$.{key}", "boolean"))
        .when(kind == "STRING", F.lower(F.btrim(shown)).isin("true", "1", "yes"))
        .when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)"), F.try_variant_get(value, f"$.{key}", "double") != 0)
        .when(kind.startswith("ARRAY"), F.to_json(field) != "[]")
        .when(kind.startswith("OBJECT"), F.to_json(field) != "{}"),
        F.lit(False),
    )


def hash_uniform(*key: Column) -> Column:
    """A number in [0, 1) from the key, the same in every run and engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *key)), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def utc_now() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
