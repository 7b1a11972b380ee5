"""Model providers: a small protocol, an HTTP client, a deterministic stand-in, and their use from DataFrames."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import md5
from importlib.util import find_spec
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessera.functions.prompts import as_parts
from tessera.session import ship


class Chat(Protocol):
    def chat(self, model: str, messages: list[dict[str, str]], temperature: float = 0.0, max_tokens: int = 4096) -> str: ...


class Scorer(Protocol):
    def score(self, pairs: list[dict[str, str]]) -> list[float]: ...


# Answers

# The keys under which answers may hold their text, by level.
_OBJECT_KEYS = ("text", "content", "output_text", "reasoning_content")
_MESSAGE_KEYS = ("content", "text", "output_text", "reasoning_content")
_ROOT_KEYS = ("content", "text", "output_text", "response", "reasoning_content")


def content_of(value: Any) -> str | None:
    """Text of a string, a list of strings or parts, or an object; blank text is none."""
    if isinstance(value, dict):
        return next((c for k in _OBJECT_KEYS if (c := content_of(value.get(k)))), None) or content_of(str(value))
    if isinstance(value, list):
        parts = [p if isinstance(p, str) else (p.get("text") or p.get("content") or "") if isinstance(p, dict) else "" for p in value]
        value = "".join(map(str, parts))
    return None if value is None else str(value).strip() or None


def answer_of(data: dict[str, Any]) -> str:
    """An answer's text: of the first choice's message, of the choice, or of the root."""
    levels = [(data, _ROOT_KEYS)]
    choices = data.get("choices")
    if isinstance(choices, list) and choices and isinstance(choices[0], dict):
        levels.insert(0, (choices[0], _MESSAGE_KEYS))
        if isinstance(choices[0].get("message"), dict):
            levels.insert(0, (choices[0]["message"], _MESSAGE_KEYS))
    for level, keys in levels:
        for k in keys:
            if found := content_of(level.get(k)):
                return found
    raise RuntimeError(f"no text in the answer: {json.dumps(data, ensure_ascii=False)[:1000]}")


def answer_column(body: Column) -> Column:
    """``answer_of`` for JSON text with plain string values, natively; null if there is none."""
    paths = [f"$.choices[0].message.{k}" for k in _MESSAGE_KEYS] + [f"$.choices[0].{k}" for k in _MESSAGE_KEYS] + [f"$.{k}" for k in _ROOT_KEYS]
    return F.coalesce(*[F.nullif(F.btrim(F.get_json_object(body, p), F.lit(" \t\r\n")), F.lit("")) for p in paths])


@F.pandas_udf(StringType())
def answer_text(bodies: pd.Series) -> pd.Series:
    """``answer_of`` for JSON texts; null where there is no text."""

    def one(body: str) -> str | None:
        try:
            return answer_of(json.loads(body))
        except RuntimeError:
            return None

    return bodies.map(one)


# Clients


@dataclass
class Pace:
    """Starts of calls are at least a minute's share apart."""

    per_minute: float
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    free_at: float = field(default=float("-inf"))

    def wait(self) -> None:
        now = self.clock()
        if now < self.free_at:
            self.sleep(self.free_at - now)
        self.free_at = max(now, self.free_at) + 60.0 / max(self.per_minute, 1e-9)


class Overloaded(Exception):
    """A failure that may pass: too many requests, a server's error, or the network's."""


@dataclass
class HttpChat:
    """Chat completions over HTTP with a bearer key."""

    base_url: str
    api_key: str
    per_minute: float = 10
    timeout: float = 120
    retries: int = 3
    pace: Pace | None = None

    def chat(self, model: str, messages: list[dict[str, str]], temperature: float = 0.0, max_tokens: int = 4096) -> str:
        self.pace = self.pace or Pace(self.per_minute)
        body = json.dumps({"model": model, "messages": messages, "temperature": temperature, "max_tokens": max_tokens}).encode()
        return answer_of(json.loads(retried(lambda: self._send(body), self.retries, self.pace.sleep)))

    def _send(self, body: bytes) -> bytes:
        self.pace.wait()
        head = {"Authorization": f"Bearer {self.api_key}", "Content-Type": "application/json"}
        request = urllib.request.Request(f"{self.base_url.rstrip('/')}/chat/completions", body, head)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:
            if e.code == 429 or e.code >= 500:
                raise Overloaded(f"status {e.code}") from e
            raise
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            raise Overloaded(str(e)) from e


def retried(call: Callable[[], bytes], retries: int, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """Passing failures are tried again after 5, 10, 20 ... seconds, a minute at most."""
    for n in range(retries + 1):
        try:
            return call()
        except Overloaded:
            if n == retries:
                raise
            sleep(min(60.0, 5.0 * 2**n))
    raise AssertionError


@dataclass
class FakeChat:
    """A deterministic stand-in: for a judge's prompt a rubric, else the text of the prompt, word by word in the target's markers (with ``echo``, as it is)."""

    fail_share: float = 0.0
    echo: bool = False

    def chat(self, model: str, messages: list[dict[str, str]], temperature: float = 0.0, max_tokens: int = 4096) -> str:
        from tessera.constants import RUBRIC, TARGET_MARKERS

        prompt = messages[-1]["content"]
        draw = int(md5(f"{model}:{prompt}".encode()).hexdigest()[:8], 16) / 2**32
        if draw < self.fail_share:
            raise RuntimeError("the stand-in fails here")
        if "<translation>" in prompt:
            return json.dumps(dict.fromkeys(RUBRIC, 3 + round(draw * 2)) | {"overall": 3 + draw * 2, "critical_error": draw > 0.97, "issues": [], "rationale": ""})
        source = prompt.partition("<text>\n")[2].rpartition("\n</text>")[0]
        if self.echo:
            return source
        out, k = [], 0
        for line in source.split("\n"):
            words = []
            for w in line.split(" "):
                words.append(w if not w[:1].isalpha() else TARGET_MARKERS[(k := k + 1) % len(TARGET_MARKERS)] + (w[-1] if w[-1:] in ".,!?:;" else ""))
            out.append(" ".join(words))
        return "\n".join(out)


@dataclass
class FakeScorer:
    def score(self, pairs: list[dict[str, str]]) -> list[float]:
        return [int(md5(f"{p['src']}|{p['mt']}".encode()).hexdigest()[:8], 16) / 2**32 for p in pairs]


@dataclass
class FewScores:
    """A stand-in that always leaves out one score."""

    def score(self, pairs: list[dict[str, str]]) -> list[float]:
        return [0.0] * (len(pairs) - 1)


def without_prompt(made: list, asked: list) -> list:
    """Of each row of generated ids, what follows the ids it was asked with."""
    return [row[len(prompt) :] for row, prompt in zip(made, asked, strict=True)]


@dataclass(frozen=True)
class LocalModel:
    """Loads a model that answers messages: called, it gives a function of messages and the most new tokens. Its packages are imported only then."""

    name: str
    number_type: str = "bfloat16"
    device_map: str = "auto"
    attention: str | None = None

    def __call__(self) -> Callable[[list[dict], int], str]:
        import torch
        from transformers import AutoModelForImageTextToText, AutoProcessor

        number = self.number_type if self.number_type == "auto" else getattr(torch, self.number_type, None)
        if number is None:
            raise ValueError(f"unknown number type {self.number_type}")
        options = {"attn_implementation": self.attention} if self.attention else {}
        reader = AutoProcessor.from_pretrained(self.name)
        model = AutoModelForImageTextToText.from_pretrained(self.name, torch_dtype=number, device_map=self.device_map, **options)
        model.eval()

        def answer(messages: list[dict], most: int) -> str:
            asked = reader.apply_chat_template(messages, tokenize=True, add_generation_prompt=True, return_dict=True, return_tensors="pt").to(model.device)
            with torch.inference_mode():
                made = model.generate(**asked, max_new_tokens=most, do_sample=False)
            return reader.batch_decode(without_prompt(made, asked["input_ids"]), skip_special_tokens=True, clean_up_tokenization_spaces=False)[0]

        return answer


@lru_cache(maxsize=2)
def _loaded(load: Callable) -> Any:
    """What ``load`` gives, once for each Python worker, however many tasks run there."""
    return load()


@dataclass
class LocalChat:
    """A local model behind a loader; loaded once in a Python worker, greedy, other arguments unused."""

    load: Callable[[], Callable[[list[dict], int], str]]
    max_new_tokens: int = 1024

    def chat(self, model: str, messages: list[dict[str, str]], temperature: float = 0.0, max_tokens: int | None = None) -> str:
        return _loaded(self.load)(as_parts(messages), max_tokens or self.max_new_tokens).strip()


@dataclass(frozen=True)
class QeModel:
    """Loads a quality-estimation model by name: called, it gives a function of pairs to scores."""

    name: str
    batch_size: int = 8
    gpus: int | None = None

    def resolved_gpus(self) -> int:
        """As configured, not below 0; else one if there is any."""
        if self.gpus is not None:
            return max(0, int(self.gpus))
        try:
            import torch
        except ImportError:
            return 0
        return int(torch.cuda.is_available())

    def __call__(self) -> Callable[[list[dict[str, str]]], list[float]]:
        from comet import download_model, load_from_checkpoint

        model, gpus = load_from_checkpoint(download_model(self.name)), self.resolved_gpus()

        def predict(pairs: list[dict[str, str]]) -> list[float]:
            out = model.predict(pairs, batch_size=self.batch_size, gpus=gpus)
            return [float(x) for x in getattr(out, "scores", out)]

        return predict


@dataclass
class ModelScorer:
    """A model behind a loader, loaded once in a Python worker."""

    load: Callable[[], Callable[[list[dict[str, str]]], list[float]]]

    def score(self, pairs: list[dict[str, str]]) -> list[float]:
        return _loaded(self.load)(pairs)


_CHATS: dict[str, Callable[[Any], Chat]] = {"fake": lambda config: FakeChat()}
_SCORERS: dict[str, Callable[[Any], Scorer]] = {"fake": lambda config: FakeScorer()}


def register(name: str, make: Callable[[Any], Chat]) -> None:
    _CHATS[name] = make


def register_scorer(name: str, make: Callable[[Any], Scorer]) -> None:
    _SCORERS[name] = make


def http_chat(config) -> HttpChat:
    key = os.environ.get(config.api_key_env)
    if not key:
        raise RuntimeError(f"{config.api_key_env} isn't set")
    # The cap holds for all partitions together.
    return HttpChat(config.api_base_url, key, config.requests_per_minute / max(1, config.api_concurrency), config.timeout_seconds)


def local_chat(config) -> LocalChat:
    model = LocalModel(config.qwen3vl_model, config.qwen3vl_dtype, config.qwen3vl_device_map, config.qwen3vl_attn_implementation)
    return LocalChat(model, config.qwen3vl_max_new_tokens)


register("http", http_chat)
register("local", local_chat)


def is_local(name: str) -> bool:
    return name == "local" or name.endswith("_local")


def chat_of(name: str, config, kinds: tuple[str, ...] = ("http", "local")) -> Chat:
    """The provider of that name; names of configuration files that end in ``_api`` or ``_local`` are of those kinds, if ``kinds`` has them."""
    kind = "local" if name.endswith("_local") else "http" if name.endswith("_api") else None
    if name not in _CHATS and kind not in kinds or name in ("http", "local") and name not in kinds:
        raise ValueError(f"unknown provider {name}; known: {', '.join(sorted(_CHATS))}, and names that end in _api or _local")
    return _CHATS[name if name in _CHATS else kind](config)


def scorer_of(config) -> Scorer:
    """The scorer registered for the configured model; else the model itself, if its package is installed. A stand-in is used by its name only."""
    name = config.cometkiwi_model
    if name in _SCORERS:
        return _SCORERS[name](config)
    if find_spec("comet") is None:
        raise RuntimeError(f"no scorer for {name}: none is registered under that name, and the package comet isn't installed")
    return ModelScorer(QeModel(name, config.cometkiwi_batch_size, config.cometkiwi_gpus))


# Use from DataFrames


def answered(rows: DataFrame, chat: Chat, model: str, messages: str = "messages", partitions: int = 3, max_tokens: int = 4096) -> DataFrame:
    """``rows`` (id, messages) to id, response, error: a failed call is a row with its error.

    The number of partitions is the number of calls at a time. A task that is run again calls again: write the
    result before it is used.
    """
    ship(rows.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for id_, said in zip(frame["id"], frame[messages], strict=True):
                try:
                    out.append((id_, chat.chat(model, [{"role": m["role"], "content": m["content"]} for m in said], 0.0, max_tokens), None))
                except Exception as e:  # noqa: BLE001 - errors are data here
                    out.append((id_, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["id", "response", "error"])

    return rows.select("id", messages).repartition(max(1, partitions), "id").mapInPandas(run, "id string, response string, error string")


def scored(rows: DataFrame, scorer: Scorer, model: str, batch_size: int = 8) -> DataFrame:
    """``rows`` (id, source, reference) to QE records, scores of 4 places; a failed batch is rows with its error."""
    ship(rows.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), batch_size):
                part = frame.iloc[lo : lo + batch_size]
                try:
                    scores = scorer.score([{"src": s, "mt": r} for s, r in zip(part["source"], part["reference"], strict=True)])
                    if len(scores) != len(part):
                        raise ValueError(f"{len(scores)} scores for {len(part)} pairs")
                    yield pd.DataFrame({"id": part["id"], "cometkiwi_score": scores, "cometkiwi_error": None})
                except Exception as e:  # noqa: BLE001
                    yield pd.DataFrame({"id": part["id"], "cometkiwi_score": None, "cometkiwi_error": f"{type(e).__name__}: {e}"})

    found = rows.select("id", "source", "reference").mapInPandas(run, "id string, cometkiwi_score double, cometkiwi_error string")
    return found.select("id", F.lit(model).alias("cometkiwi_model"), F.bround("cometkiwi_score", 4).alias("cometkiwi_score"), "cometkiwi_error")
