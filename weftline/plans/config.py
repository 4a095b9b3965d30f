"""A run's configuration from TOML: defaults, trimming and checks. Keys and secrets never enter a plan."""

from __future__ import annotations

import os
import re
import tomllib
from dataclasses import dataclass, field, fields


@dataclass
class Model:
    endpoint: str
    model_name: str
    api_key: str = field(repr=False)
    system_prompt: str | None = None
    max_completion_tokens: int | None = None
    reasoning_effort: str | None = None
    stream: bool = False
    thinking: str | None = None
    enable_thinking: bool | None = None


@dataclass
class Config:
    dataset_path: str
    generator: Model
    variant_count: int
    answer_models: list[Model]
    validator: Model | None = None
    limit: int | None = None
    start_index: int = 0
    default_subject: str = "general"
    profile_path: str | None = None
    generation_attempts: int = 4
    validate_generated_questions: bool = True
    json_object_response: bool = True
    validator_json_object_response: bool = True
    jsonl_path: str = "data/train.jsonl"
    resume: bool = True
    answer_generated: bool = True
    request_timeout_seconds: float = 240.0
    disable_env_proxy: bool = True
    force_http1: bool = True
    generate_requests: int = 4
    answer_requests: int = 16


#: Where each section's keys go (fixed names); anything else is refused.
SECTIONS = {
    "input": ("dataset_path", "limit", "start_index", "default_subject"),
    "prompt": ("profile_path",),
    "generator": ("variant_count", "generation_attempts", "validate_generated_questions", "json_object_response", "validator_json_object_response"),
    "output": ("jsonl_path",),
    "run": ("resume", "answer_generated", "request_timeout_seconds", "disable_env_proxy", "force_http1"),
    "concurrency": ("generate_requests", "answer_requests"),
}
PATHS = ("dataset_path", "profile_path", "jsonl_path")
MODEL_KEYS = tuple(f.name for f in fields(Model))


def _model(raw: dict) -> Model:
    if extra := set(raw) - set(MODEL_KEYS):
        raise ValueError(f"unknown model keys: {sorted(extra)}")
    values = {k: v.strip() if isinstance(v, str) else v for k, v in raw.items()}
    if isinstance(values.get("thinking"), dict):
        values["thinking"] = str(values["thinking"].get("type", "")).strip()
        if not values["thinking"]:
            raise ValueError("thinking.type must not be empty")
    values["system_prompt"] = values.get("system_prompt") or None
    for name in ("endpoint", "model_name", "api_key"):
        if not values.get(name):
            raise ValueError(f"{name} must not be empty")
    return Model(**values)


def parse(text: str, base: str = ".") -> Config:
    """Check and complete a configuration; relative paths are taken from ``base``."""
    raw = tomllib.loads(text)
    if extra := set(raw) - set(SECTIONS) - {"validator", "answer_models"}:
        raise ValueError(f"unknown sections: {sorted(extra)}")
    values: dict = {}
    for section, names in SECTIONS.items():
        part = dict(raw.get(section, {}))
        if section == "generator":
            values["generator"] = _model({k: part.pop(k) for k in list(part) if k in MODEL_KEYS})
        if extra := set(part) - set(names):
            raise ValueError(f"unknown keys in {section}: {sorted(extra)}")
        values |= part
    if "validator" in raw:
        part = dict(raw["validator"])
        values["validator_json_object_response"] = part.pop("json_object_response", True)
        values["validator"] = _model(part)
    if "answer_models" not in raw:
        raise ValueError("answer_models is required")
    values["answer_models"] = [_model(m) for m in raw["answer_models"]]
    for name in PATHS:
        if values.get(name) and not re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", values[name]):  # a path, not a file system's own name
            values[name] = os.path.join(base, values[name])
    config = Config(**values)
    for name in ("variant_count", "generation_attempts"):
        if getattr(config, name) <= 0:
            raise ValueError(f"generator.{name} must be > 0")
    if config.answer_generated and not config.answer_models:
        raise ValueError("need at least one answer model")
    return config


def load(path: str, limit: int | None = None) -> Config:
    with open(path, encoding="utf-8") as f:
        config = parse(f.read(), os.path.dirname(os.path.abspath(path)))
    if limit is not None:
        config.limit = limit
    return config
