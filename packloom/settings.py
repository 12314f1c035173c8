"""Settings: a YAML file, overridden by environment variables ``PACKLOOM_<NAME>``."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields

LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
TRUE_WORDS = ("1", "true", "yes", "on")
PREFIX = "PACKLOOM_"


@dataclass(frozen=True)
class Settings:
    environment_name: str = "development"
    log_level: str = "INFO"
    hosted_llm_enabled: bool = False
    hosted_vlm_enabled: bool = False
    text_model_name: str | None = None
    vision_model_name: str | None = None
    pricing_config_path: str | None = None
    local_cache_path: str = "data/cache"
    local_index_path: str = "data/indexes"
    api_key: str | None = field(default=None, repr=False)

    def __post_init__(self):
        if not self.environment_name.strip():
            raise ValueError("environment_name is blank")
        object.__setattr__(self, "log_level", self.log_level.strip().upper())
        if self.log_level not in LOG_LEVELS:
            raise ValueError(f"log_level is none of {', '.join(LOG_LEVELS)}")

    def public(self) -> dict:
        """All but the secret."""
        return {k: v for k, v in asdict(self).items() if k != "api_key"}


def load_settings(path: str | None = None, env: Mapping[str, str] | None = None) -> Settings:
    """Unknown keys of the file are errors; empty variables don't count."""
    raw: dict = {}
    if path is not None:
        import yaml

        with open(path, encoding="utf-8") as f:
            raw = yaml.safe_load(f) or {}
        if not isinstance(raw, dict):
            raise ValueError("settings are a table of names")
    known = {f.name: f for f in fields(Settings)}
    if unknown := sorted(set(raw) - set(known)):
        raise ValueError("unknown settings: " + ", ".join(unknown))
    for name in known:
        if value := (os.environ if env is None else env).get(PREFIX + name.upper()):
            raw[name] = value.lower() in TRUE_WORDS if name.endswith("_enabled") else value
    return Settings(**raw)
