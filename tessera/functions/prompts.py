"""Chat messages for generation and judging, as columns of array<struct<role, content>>."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.constants import RUBRIC

_GENERATE = (
    "Translate educational English into standard formal Indonesian. Keep every sentence, heading number, list item, formula, unit and code token. "
    "Answer with the translation alone, without comments or fences."
)
_STRICT = "An earlier answer failed automatic checks. Leave nothing out and keep the structure exactly.\n"
_JUDGE = "Judge an Indonesian translation of an English text. Answer with one JSON object and nothing else; write issues and rationale in English."
_SCALE = "Rate each from 1 (unusable) to 5 (no material issue). critical_error is true where the translation can't serve as a reference."
_ANSWER = {k: "integer 1-5" for k in RUBRIC} | {"overall": "number 1-5", "critical_error": "boolean", "issues": ["short strings"], "rationale": "one sentence"}


def _messages(system: str, user: Column) -> Column:
    say = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(say("system", F.lit(system)), say("user", user))


def generation(source: Column, strict: Column | bool = False) -> Column:
    strict = F.lit(strict) if isinstance(strict, bool) else strict
    note = F.when(strict, _STRICT).otherwise("")
    return _messages(_GENERATE, F.concat(note, F.lit("<text>\n"), source, F.lit("\n</text>")))


#: What stands before, between and behind the two texts of a judge's prompt.
JUDGED = (f"{_SCALE}\nAnswer by this schema: {json.dumps(_ANSWER)}\n\n<source>\n", "\n</source>\n\n<translation>\n", "\n</translation>")


def judging(source: Column, reference: Column) -> Column:
    before, between, behind = map(F.lit, JUDGED)
    return _messages(_JUDGE, F.concat(before, source, between, reference, behind))


def multimodal(messages: Column) -> Column:
    """Each content as a list of one text part."""
    part = lambda m: F.array(F.struct(F.lit("text").alias("type"), m["content"].alias("text")))
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), part(m).alias("content")))


def as_parts(messages: list[dict[str, str]]) -> list[dict]:
    """The same for Python's lists."""
    return [{"role": m["role"], "content": [{"type": "text", "text": m["content"]}]} for m in messages]


def without_prompt(ids: Column, prompt: Column) -> Column:
    """Of generated ids, what follows the ids of the prompt."""
    return F.slice(ids, F.size(prompt) + 1, F.greatest(F.size(ids) - F.size(prompt), F.lit(0)))
