"""Tunables, read once from the environment into a frozen value."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

_YES = ("1", "true", "yes")


def env_int(env: Mapping[str, str], name: str, default: int, least: int) -> int:
    """Integer setting: blank or malformed gives the default, anything else at least ``least``."""
    try:
        return max(least, int(env.get(name, "").strip()))
    except ValueError:
        return default


def env_bool(env: Mapping[str, str], name: str, default: bool = False, also: tuple[str, ...] = ()) -> bool:
    raw = env.get(name, "").strip().lower()
    return raw in (*_YES, *also) if raw else default


def parse_max_reports(raw: str | None) -> int | None:
    """Blank or ``all`` -> no limit; a positive integer -> itself; else ValueError."""
    raw = (raw or "").strip()
    if not raw or raw.lower() == "all":
        return None
    if not raw.lstrip("+").isdigit() or int(raw) <= 0:
        raise ValueError(f"MAX_REPORTS must be a positive integer or 'all', not {raw!r}")
    return int(raw)


@dataclass(frozen=True)
class Settings:
    max_snippet_chars: int = 400
    max_snippets: int = 12
    max_llm_chars: int = 8000
    max_hits_per_keyword: int = 3
    window_sentences: int = 1
    max_full_text_chars: int = 12000
    full_text_window_chars: int = 500
    provider: str = "http_generate"
    url: str = ""
    model: str = ""
    temperature: float = 0.1
    top_p: float = 0.9
    max_tokens: int = 1000
    timeout: float = 300.0
    max_retries: int = 2
    long_input_warning_chars: int = 12000
    context_tokens: int = 8192
    disable_think: bool = True
    calls_in_flight: int = 1  # of a task
    calls_per_second: float = 0.0  # of all tasks; 0: no limit
    report_id_column: str = "report_id"
    report_text_column: str = "report_text"
    task: str = "demo_extraction"
    max_reports: int | None = None
    resume: bool = False
    sqlite: bool = False
    debug_output: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        provider = env.get("LLM_PROVIDER", "").strip().lower() or cls.provider
        number = lambda name, default: float(env.get(name, "").strip() or default)
        return cls(
            max_snippet_chars=env_int(env, "EVIDENCE_MAX_SNIPPET_CHARS", 400, 80),
            max_snippets=env_int(env, "EVIDENCE_MAX_SNIPPETS", 12, 1),
            max_llm_chars=env_int(env, "EVIDENCE_MAX_LLM_CHARS", 8000, 500),
            max_hits_per_keyword=env_int(env, "EVIDENCE_MAX_HITS_PER_KEYWORD", 3, 1),
            window_sentences=env_int(env, "EVIDENCE_WINDOW_SENTENCES", 1, 0),
            max_full_text_chars=env_int(env, "EVIDENCE_MAX_FULL_TEXT_CHARS", 12000, 2000),
            full_text_window_chars=env_int(env, "EVIDENCE_FULL_TEXT_WINDOW_CHARS", 500, 120),
            provider=provider,
            url=env.get("LLM_URL", "").strip(),
            model=env.get("LLM_MODEL", "").strip(),
            temperature=number("LLM_TEMPERATURE", 0.1),
            top_p=number("LLM_TOP_P", 0.9),
            max_tokens=env_int(env, "LLM_MAX_TOKENS", 1000, 1),
            timeout=number("LLM_TIMEOUT", 120 if provider == "http_chat" else 300),
            max_retries=env_int(env, "LLM_MAX_RETRIES", 2, 0),
            long_input_warning_chars=env_int(env, "LLM_LONG_INPUT_WARNING_CHARS", 12000, 1),
            context_tokens=env_int(env, "LLM_CONTEXT_TOKENS", 8192, 1),
            calls_in_flight=env_int(env, "LLM_CALLS_IN_FLIGHT", 1, 1),
            calls_per_second=number("LLM_CALLS_PER_SECOND", 0),
            disable_think=env_bool(env, "LLM_DISABLE_THINK", True),
            report_id_column=env.get("REPORT_ID_COLUMN", "").strip() or "report_id",
            report_text_column=env.get("REPORT_TEXT_COLUMN", "").strip() or "report_text",
            task=env.get("EXTRACTION_TASK", "").strip() or "demo_extraction",
            max_reports=parse_max_reports(env.get("MAX_REPORTS")),
            resume=env_bool(env, "PIPELINE_RESUME", also=("auto",)),
            sqlite=env_bool(env, "ENABLE_SQLITE_LOGGING"),
            debug_output=env_bool(env, "DEBUG_LLM_OUTPUT"),
        )
