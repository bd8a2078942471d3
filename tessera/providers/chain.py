"""A chain of providers, structured answers, and both over the rows of a table."""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import EXTRACTIONS, GUARD, LIMIT, reduced
from tessera.providers.models import AllFailed, Answer, BadAnswer, Call, Provider, ProviderError, Request, Telemetry, TimedOut, TooLarge


def delay(attempt: int, base: float = 2.0, most: float = 30.0) -> float:
    """Seconds after an attempt: a capped power, and up to half of it more."""
    d = min(base ** (attempt - 1), most)
    return d + random.uniform(0, 0.5 * d)


def retried(call: Callable[[], Answer], times: int = 3, base: float = 2.0, most: float = 30.0, sleep: Callable = time.sleep) -> tuple[Answer, int]:
    """(answer, attempts); errors that another try cannot mend are raised at once."""
    for attempt in range(1, times + 1):
        try:
            return call(), attempt
        except (ProviderError, TimeoutError, OSError) as e:
            e = e if isinstance(e, ProviderError) else TimedOut(str(e))
            if not e.retry or attempt == times:
                raise e from None
            sleep(delay(attempt, base, most))
    raise AssertionError


def chained(providers: list[Provider], order: str = "") -> list[Provider]:
    """Providers in the order of a comma list of names (once each, case aside), or as they come."""
    if not order:
        return providers
    by = {p.name.lower(): p for p in providers}
    return [by[n] for n in dict.fromkeys(x.strip().lower() for x in order.split(",")) if n in by]


@dataclass
class Chain:
    """The first provider that answers. An oversized prompt is halved and tried once more; unconfigured ones are passed over."""

    providers: list[Provider]
    retries: int = 3
    limit: int = LIMIT
    sleep: Callable = time.sleep
    telemetry: Telemetry = field(default_factory=Telemetry)

    def health(self) -> dict[str, str]:
        return {p.name: "configured" if p.configured() else "not_configured" for p in self.providers}

    def generate(self, request: Request) -> Answer:
        request = replace(request, prompt=reduced(request.prompt, self.limit))
        errors: dict[str, str] = {}
        for p in self.providers:
            if not p.configured():
                errors[p.name] = "not configured"
                continue
            now = request
            for last in (False, True):
                began = time.monotonic()
                try:
                    answer, attempts = retried(lambda p=p, now=now: p.generate(now), self.retries, sleep=self.sleep)
                    self.telemetry.calls.append(Call(p.name, p.model, attempts, True, time.monotonic() - began, len(now.prompt), len(answer.text), answer.prompt_tokens + answer.completion_tokens))
                    return answer
                except ProviderError as e:
                    self.telemetry.calls.append(Call(p.name, p.model, self.retries if e.retry else 1, False, time.monotonic() - began, len(now.prompt), error=e.category))
                    errors[p.name] = f"{e.category}: {e}"
                    if not isinstance(e, TooLarge) or last:
                        break
                    now = replace(now, prompt=reduced(now.prompt, max(500, len(now.prompt) // 2)))
        raise AllFailed("; ".join(f"{k}: {v}" for k, v in errors.items()) or "no providers", providers=errors)

    def structured(self, request: Request, check: Callable[[dict], list[str]] = lambda d: []) -> dict:
        """The JSON object of an answer that passes a check (a list of faults); one more round may correct it."""
        asked = request
        for last in (False, True):
            text = self.generate(asked).text
            try:
                got = parsed(text)
                faults = check(got)
            except BadAnswer as e:
                faults = [str(e)]
            if not faults:
                return got
            if last:
                raise BadAnswer("; ".join(faults))
            asked = replace(request, prompt=f"{request.prompt}\n\nYour last answer was not valid ({'; '.join(faults)}). Answer again in valid JSON only.")
        raise AssertionError


def parsed(text: str) -> dict:
    """The JSON object in an answer: fenced, bracketed or bare; the first object of an array."""
    t = (text or "").strip()
    if not t:
        raise BadAnswer("empty answer")
    m = re.search(r"```(?:json)?\s*\n?(.*?)\n?```", t, re.S | re.I) or re.search(r"(\{.*\}|\[.*\])", t, re.S)
    try:
        value = json.loads(m[1].strip() if m else t)
    except ValueError as e:
        raise BadAnswer(f"no JSON: {e}") from None
    value = value[0] if isinstance(value, list) and value else value
    if not isinstance(value, dict):
        raise BadAnswer("not an object")
    return value


def extract(df: DataFrame, key: str, prompt: str, make: Callable[[], Chain], schema: str, concurrency: int = 5) -> DataFrame:
    """key, answer (struct by schema), error, attempts and seconds of a structured extraction of each row.

    `make` builds the chain on the executor; at most `concurrency` tasks call it side by side. They share the limits a minute
    and a day of its providers: each task has its part of them, for the length of the job. A failure is a row.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chain = make()
        for p in chain.providers:
            if getattr(p, "limiter", None) is not None:
                p.limiter = p.limiter.part(concurrency)
        for b in batches:
            out = []
            for k, p in zip(b[key], b[prompt], strict=True):
                began, n = time.monotonic(), len(chain.telemetry.calls)
                try:
                    got, error = json.dumps(chain.structured(Request(p or "", schema="json"))), None
                except (ProviderError, ValueError) as e:
                    got, error = None, f"{getattr(e, 'category', 'invalid_request')}: {e}"
                out.append((k, got, error, sum(c.attempts for c in chain.telemetry.calls[n:]), time.monotonic() - began))
            yield pd.DataFrame(out, columns=[key, "answer", "error", "attempts", "seconds"])

    done = df.select(key, prompt).repartition(concurrency).mapInPandas(run, f"{key} {kind}, answer string, error string, attempts int, seconds double")
    return done.withColumn("answer", F.from_json("answer", schema))


def by_provider(calls: DataFrame) -> DataFrame:
    """Calls, successes, attempts and mean seconds of each provider of a telemetry table."""
    return calls.groupBy("provider").agg(F.count("*").alias("calls"), F.count_if("success").alias("succeeded"), F.sum("attempts").alias("attempts"), F.avg("seconds").alias("mean_seconds"))


def entity_chooser(make: Callable[[], Chain]) -> Callable[[str, list[dict]], tuple[str, float] | None]:
    """A chooser for `resolve`: asks a chain, built once a process, which of a name's candidates it means."""
    held: list[Chain] = []

    def choose(name: str, candidates: list[dict]) -> tuple[str, float] | None:
        if not held:
            held.append(make())
        prompt = f"Which candidate is this name? Answer null if none or more than one.\n{GUARD}\nKeys: {', '.join(EXTRACTIONS['entity'])}\n\nName: {name}\nCandidates: {json.dumps(candidates)}"
        got = held[0].structured(Request(prompt, schema="json"))
        picked = got.get("selected_canonical_id")
        return (picked, min(1.0, max(0.0, float(got.get("confidence") or 0.0)))) if picked else None

    return choose
