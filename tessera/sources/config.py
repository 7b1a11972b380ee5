"""Configuration: JSON files with sections, overrides from a command line."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields, replace
from pathlib import Path

# Sections whose entries count as top-level ones.
SECTIONS = {"paths", "sampling", "generation", "api", "qa", "judge", "qwen3vl"}
PATHS = {"output", "qa_output", "manifest_output", "cometkiwi_output", "judge_output"}


@dataclass(frozen=True)
class Config:
    """Field names and defaults are those of the exchanged configuration files; models and addresses have none."""

    dataset_name: str = ""
    output: Path = Path("data/records.jsonl")
    qa_output: Path = Path("data/qa.jsonl")
    manifest_output: Path = Path("data/manifest.json")
    cometkiwi_output: Path = Path("data/qe.jsonl")
    judge_output: Path = Path("data/judge.jsonl")
    sample_size: int = 300
    min_words: int = 100
    seed: int = 42
    generator_provider: str = "fake"
    generator_model: str = "fake"
    judge_provider: str = "fake"
    judge_model: str = "fake"
    qwen3vl_model: str = ""
    qwen3vl_dtype: str = "bfloat16"
    qwen3vl_device_map: str = "auto"
    qwen3vl_attn_implementation: str | None = None
    qwen3vl_max_new_tokens: int = 1024
    api_base_url: str = ""
    api_key_env: str = "API_KEY"
    requests_per_minute: int = 10
    api_concurrency: int = 3
    timeout_seconds: int = 120
    max_retries: int = 2
    max_replacements: int = 5
    max_generation_tokens: int = 4096
    length_ratio_min: float = 0.40
    length_ratio_max: float = 2.20
    copy_rate_max: float = 0.65
    enable_cometkiwi: bool = False
    cometkiwi_model: str = "fake"
    cometkiwi_batch_size: int = 8
    cometkiwi_gpus: int | None = None
    enable_judge: bool = False
    judge_mode: str = "sample"
    judge_random_audit_rate: float = 0.05
    judge_min_overall: float = 4.0
    judge_min_accuracy: float = 4.0
    dry_run: bool = False
    resume: bool = False
    log_level: str = "INFO"

    @property
    def judge_model_id(self) -> str:
        """A local judge is named by its own entry."""
        return self.qwen3vl_model if self.judge_provider.endswith("_local") else self.judge_model

    def as_dict(self) -> dict:
        return {k: str(v) if isinstance(v, Path) else v for k, v in asdict(self).items()}


def load(path: str | Path) -> Config:
    return of(json.loads(Path(path).read_text(encoding="utf-8")))


def of(content: dict) -> Config:
    """Sections are flattened, the old name of the accuracy limit is known, unknown entries are dropped."""
    entries: dict = {}
    for name, value in content.items():
        entries |= value if name in SECTIONS and isinstance(value, dict) else {name: value}
    if "judge_min_adequacy" in entries:
        entries.setdefault("judge_min_accuracy", entries["judge_min_adequacy"])
    known = {f.name for f in fields(Config)}
    return Config(**{k: Path(v) if k in PATHS and v is not None else v for k, v in entries.items() if k in known})


def override(config: Config, dry_run: bool | None = None, resume: bool | None = None, limit: int | None = None) -> Config:
    """None leaves an entry as it is; ``limit`` is the sample size."""
    new = {"dry_run": dry_run, "resume": resume, "sample_size": limit}
    return replace(config, **{k: v for k, v in new.items() if v is not None})
