"""Requests, answers, errors and telemetry of language-model calls."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol


class ProviderError(Exception):
    """A call that failed; category names why."""

    category, retry = "provider", True

    def __init__(self, message: str = "", provider: str = "", **more) -> None:
        super().__init__(message)
        self.provider, self.more = provider, more


class AuthError(ProviderError):
    category, retry = "auth", False


class RateLimited(ProviderError):
    category = "rate_limit"


class TimedOut(ProviderError):
    category = "timeout"


class TooLarge(ProviderError):
    category, retry = "too_large", False


class BadAnswer(ProviderError):
    category, retry = "structured_output", False


class AllFailed(ProviderError):
    category, retry = "all_failed", False


def error_of(status: int, message: str = "", provider: str = "") -> ProviderError:
    """The error of an HTTP status."""
    kind = AuthError if status in (401, 403) else TimedOut if status in (408, 504) else TooLarge if status == 413 else RateLimited if status == 429 else ProviderError
    return kind(f"HTTP {status}: {message}", provider)


@dataclass(frozen=True)
class Request:
    prompt: str
    system: str = ""
    max_tokens: int = 2048
    temperature: float = 0.0
    schema: str | None = None

    def __post_init__(self) -> None:
        if not self.prompt or not 1 <= self.max_tokens <= 16384 or not 0 <= self.temperature <= 2:
            raise ValueError("a prompt, 1 to 16384 tokens and a temperature of 0 to 2 are needed")


@dataclass(frozen=True)
class Answer:
    text: str
    provider: str
    model: str
    prompt_tokens: int = 0
    completion_tokens: int = 0


@dataclass
class Call:
    provider: str
    model: str
    attempts: int
    success: bool
    seconds: float
    input_chars: int = 0
    output_chars: int = 0
    tokens: int = 0
    error: str | None = None


@dataclass
class Telemetry:
    calls: list[Call] = field(default_factory=list)

    def clear(self) -> None:
        self.calls.clear()


class Provider(Protocol):
    name: str
    model: str

    def configured(self) -> bool: ...

    def generate(self, request: Request) -> Answer: ...
