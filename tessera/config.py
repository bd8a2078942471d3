"""Settings from the environment, read once."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from functools import lru_cache


@dataclass(frozen=True)
class Settings:
    """Each field is the environment variable of its name in capitals, else the default here."""

    data_folder: str = "data"
    landed_folder: str = "landed"
    export_folder: str = ""
    gemini_api_key: str = ""
    gemini_model: str = ""
    groq_api_key: str = ""
    groq_model: str = ""
    deepseek_api_key: str = ""
    deepseek_model: str = ""
    openrouter_api_key: str = ""
    openrouter_model: str = ""
    openrouter_daily_request_limit: int = 50
    openrouter_rpm_limit: int = 20
    llm_primary_provider: str = "openrouter"
    llm_fallback_providers: str = "gemini,groq,deepseek"
    llm_max_retries: int = 3
    llm_backoff_base: float = 2.0
    llm_backoff_max: float = 30.0
    llm_concurrency: int = 5
    llm_max_input_chars: int = 12_000
    github_token: str = ""
    sheets_enabled: bool = False
    sheets_batch_size: int = 500
    log_level: str = "INFO"
    crawler_concurrency: int = 10
    crawler_timeout: int = 30
    crawler_max_retries: int = 3
    crawler_backoff_base: float = 2.0
    crawler_backoff_max: float = 60.0
    crawler_user_agent: str = "tessera/1.0"
    news_sources: str = ""
    jobs_sources: str = ""
    startup_sources: str = ""
    product_sources: str = ""


def read(env: dict[str, str]) -> Settings:
    out = {}
    for f in fields(Settings):
        raw = env.get(f.name.upper())
        if raw is None:
            continue
        try:
            out[f.name] = raw.strip().lower() in ("1", "true", "yes", "on") if f.type == "bool" else {"int": int, "float": float}.get(f.type, str)(raw)
        except ValueError:
            raise ValueError(f"{f.name.upper()} is no {f.type}: {raw!r}") from None
    return Settings(**out)


@lru_cache(maxsize=1)
def settings() -> Settings:
    return read(dict(os.environ))
