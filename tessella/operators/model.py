"""The external text model: pluggable clients, retries on the executors, answers as validated JSON.

A client is a picklable object with ``complete(system, user) -> str``. Requests run in
``mapInPandas`` over the rows that need one, up to ``calls_in_flight`` of a task at a time and, all tasks together, no
more than ``calls_per_second``; answers come back in the order of the rows. With a ledger no answered
request is repeated, even if its task is; without one, a request is repeated only when its task is.
"""

from __future__ import annotations

import json
import logging
import threading
import time
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from hashlib import sha256
from typing import Protocol

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.config import Settings
from tessella.functions.jsonx import first_object, normalize_raw, parse_answer, validate
from tessella.operators.ledger import Ledger
from tessella.operators.staging import unused
from tessella.plans.prompts import build_system_prompt, retry_suffix, user_prompt
from tessella.plans.tasks import ExtractionTask

LOGGER = logging.getLogger(__name__)
FAILED = "llm_extraction_failed"
ASKED = ("system_prompt", "user_prompt", "error_message")  # of failed calls only
ANSWER = "fields string, schema_errors array<string>, raw_output string, reasoning string, evidence_quotes array<string>, attempts int, failed boolean, system_prompt string, user_prompt string, error_message string"


class Client(Protocol):
    def complete(self, system: str, user: str) -> str: ...


@dataclass
class OfflineClient:
    """Deterministic, without a network: always the same answer."""

    answer: str = "{}"

    def complete(self, system: str, user: str) -> str:
        return self.answer


@dataclass
class ScriptedClient:
    """Answers by the first key that the prompts contain; lists are used up call by call."""

    answers: dict[str, str | list[str]] = field(default_factory=dict)
    default: str = ""

    def complete(self, system: str, user: str) -> str:
        for key, answer in self.answers.items():
            if key in system or key in user:
                return answer if isinstance(answer, str) else (answer.pop(0) if len(answer) > 1 else answer[0])
        return self.default


def chat_url(base: str) -> str:
    """Address of the chat endpoint below a server's address."""
    base = base.rstrip("/")
    if base.endswith("/api/chat"):
        return base
    if base.endswith("/api/generate"):
        base = base.removesuffix("/generate")
    return f"{base}/chat" if base.endswith("/api") else f"{base}/api/chat"


def _post(url: str, payload: dict, timeout: float) -> dict:
    request = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as response:
        return json.loads(response.read().decode())


@dataclass
class GenerateClient:
    """One prompt and a system prompt in, ``response`` out; reduced to its first JSON object."""

    settings: Settings

    def complete(self, system: str, user: str) -> str:
        s = self.settings
        payload = {"prompt": user.strip(), "system_prompt": system, "temperature": s.temperature, "top_p": s.top_p, "max_tokens": s.max_tokens, "disable_think": s.disable_think}
        found = _post(s.url, payload, s.timeout).get("response", "")
        return first_object("\n".join(map(str, found)) if isinstance(found, list) else str(found))


@dataclass
class ChatClient:
    """A list of messages in, ``message.content`` out."""

    settings: Settings

    def complete(self, system: str, user: str) -> str:
        s = self.settings
        options = {"temperature": s.temperature, "top_p": s.top_p, "num_predict": s.max_tokens, "num_ctx": s.context_tokens}
        messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        content = _post(chat_url(s.url), {"model": s.model, "messages": messages, "stream": False, "options": options}, s.timeout).get("message", {}).get("content")
        if not isinstance(content, str):
            raise ValueError("the answer has no text in message.content")
        return content.strip()


PROVIDERS = {"http_generate": GenerateClient, "http_chat": ChatClient, "offline": lambda settings: OfflineClient()}


def client_for(settings: Settings) -> Client:
    """The client of the provider in the settings; ValueError if there is none of that name."""
    if settings.provider not in PROVIDERS:
        raise ValueError(f"unknown provider {settings.provider!r}; known: {', '.join(PROVIDERS)}")
    return PROVIDERS[settings.provider](settings)


def split_messages(messages: list) -> tuple[str, str]:
    """System and user text of a list of chat messages."""
    parts: dict[str, list[str]] = {"system": [], "user": []}
    for m in messages or []:
        if isinstance(m, dict) and (role := str(m.get("role", "")).strip().lower()) in parts:
            parts[role].append(str(m.get("content", "")))
    return tuple("\n\n".join(p for p in parts[r] if p) for r in ("system", "user"))


def call_model(client: Client, messages: list, settings: Settings = Settings()) -> str:
    """One call; errors of the provider become an empty answer."""
    system, user = split_messages(messages)
    if len(system) + len(user) > settings.long_input_warning_chars:
        LOGGER.warning("long input: %d characters, over %d", len(system) + len(user), settings.long_input_warning_chars)
    try:
        return client.complete(system, user)
    except Exception as error:  # noqa: BLE001 - whatever a provider raises is a failed attempt
        LOGGER.warning("model call failed: %s", error)
        return ""


def pause(attempt: int) -> float:
    """Seconds before the attempt after this one (from 0)."""
    return min(2.0 * (attempt + 1), 6.0)


class Pace:
    """A bucket of tokens that fills at ``rate`` a second up to ``most``; ``take`` waits for one. No rate, no wait."""

    def __init__(self, rate: float, most: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.most, self.clock, self.sleep = rate, most, clock, sleep
        self.tokens, self.at, self.lock = float(most), clock(), threading.Lock()

    def take(self) -> None:
        if self.rate <= 0:
            return
        with self.lock:
            now = self.clock()
            self.tokens, self.at = min(self.most, self.tokens + (now - self.at) * self.rate), now
            self.tokens -= 1
            wait = -self.tokens / self.rate
        if wait > 0:
            self.sleep(wait)


def extract(client: Client, task: ExtractionTask, text: str, settings: Settings = Settings(), sleep=time.sleep, before: Callable[[], None] = lambda: None) -> dict:
    """Ask, parse, map and validate, up to ``1 + max_retries`` times; defaults and the error at the end.

    ``before`` is called ahead of every attempt.
    """
    system, base = build_system_prompt(task), user_prompt(task, text)
    raw, error, attempts = "", None, 1 + max(0, settings.max_retries)
    for attempt in range(attempts):
        messages = [{"role": "system", "content": system}, {"role": "user", "content": base + retry_suffix(task, attempt)}]
        before()
        try:
            raw = call_model(client, messages, settings)
            parsed = normalize_raw(parse_answer(raw, task.name), task.consistency_rules)
            fields, errors = validate(parsed, task)
            quotes = fields.get("evidence_quotes", parsed.get("evidence_quotes", []))
            return {
                "fields": fields, "schema_errors": errors, "raw_output": raw, "attempts": attempt + 1, "failed": False,
                "reasoning": str(fields.get("reasoning") or parsed.get("reasoning") or ""), "evidence_quotes": quotes if isinstance(quotes, list) else [quotes],
            }
        except Exception as found:  # noqa: BLE001 - any failure of an attempt is retried
            error = found
            if attempt + 1 < attempts:
                sleep(pause(attempt))
    defaults = {f.name: f.default for f in task.fields}
    return {"fields": defaults, "schema_errors": [f"{FAILED}: {error}"], "raw_output": raw, "attempts": attempts, "failed": True, "reasoning": "", "evidence_quotes": [], "system_prompt": system, "user_prompt": base, "error_message": str(error)}


def idle(task: ExtractionTask) -> dict:
    """What a row has that is not sent."""
    fields = {f.name: f.default for f in task.fields}
    return {"fields": fields, "schema_errors": [], "raw_output": "", "attempts": 0, "failed": False, "reasoning": "", "evidence_quotes": []}


def question(client: Client, task: ExtractionTask, settings: Settings) -> str:
    """A hash of all that decides an answer but the text: client, parameters, prompts, and how the answer is read."""
    asked = getattr(client, "settings", None)
    names = ("provider", "url", "model", "temperature", "top_p", "max_tokens", "context_tokens", "disable_think")
    who = [type(client).__name__, *([getattr(asked, n) for n in names] if isinstance(asked, Settings) else [repr(client)])]
    retries = [retry_suffix(task, k) for k in range(1 + max(0, settings.max_retries))]
    return sha256(json.dumps([who, build_system_prompt(task), user_prompt(task, ""), retries, repr(task)], ensure_ascii=False).encode()).hexdigest()


def call_rows(
    rows: DataFrame, tasks: dict[str, ExtractionTask], client: Client, settings: Settings = Settings(), variable: str = "variable", text: str = "llm_text", wait: bool = True, ledger: Ledger | None = None
) -> DataFrame:
    """Adds the answer's columns to rows that each name a task of ``tasks`` in ``variable``; a null text
    is not sent. With a ``ledger`` answers are kept there; what it knows is asked again only if ``settings.resume`` is off.
    """
    sleep, order = time.sleep if wait else (lambda _: None), [*rows.columns, *[c.split()[0] for c in ANSWER.split(", ")]]
    share = settings.calls_per_second / max(1, rows.sparkSession.sparkContext.defaultParallelism)  # of the tasks that run at once
    key, known = unused(rows.columns, "_key", "_known")
    sent = rows
    if ledger is not None:
        base = F.create_map(*[x for name, task in tasks.items() for x in (F.lit(name), F.lit(question(client, task, settings)))])
        sent = rows.withColumn(key, F.when(F.col(text).isNotNull(), F.sha2(F.concat(F.try_element_at(base, F.col(variable)), F.lit(" "), F.col(text)).cast("binary"), 256)))
        before = ledger.known(rows.sparkSession) if settings.resume else None
        sent = sent.join(before.select(F.col("key").alias(key), F.col("answer").alias(known)), key, "left") if before is not None else sent.withColumn(known, F.lit(None).cast("string"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        page = ledger.page(TaskContext.get().partitionId()) if ledger is not None else None
        earlier = page.earlier() if page is not None else {}
        pace = Pace(share, max(1, settings.calls_in_flight))

        def answer(name: str, asked: str, known_as: str | None, said: str | None) -> dict:
            if said is not None:
                return json.loads(said)
            if known_as in earlier:
                return earlier[known_as]
            found = extract(client, tasks[name], asked, settings, sleep, pace.take)
            if page is not None and not found["failed"]:
                page.put(known_as, found)
            return found

        def begun(pdf: pd.DataFrame) -> list[Future | dict]:
            keys = (pdf[key], pdf[known]) if page is not None else ([None] * len(pdf),) * 2
            return [idle(tasks[v]) if t is None else pool.submit(answer, v, t, k, said) for v, t, k, said in zip(pdf[variable], pdf[text], *keys)]

        def done(pdf: pd.DataFrame, calls: list[Future | dict]) -> pd.DataFrame:
            found = [x.result() if isinstance(x, Future) else x for x in calls]
            out = pdf.copy()
            for name in ("schema_errors", "raw_output", "reasoning", "attempts", "failed", *ASKED):
                out[name] = [x.get(name) for x in found]
            out["evidence_quotes"] = [[str(q) for q in x["evidence_quotes"] or []] for x in found]
            out["fields"] = [json.dumps(x["fields"], ensure_ascii=False) for x in found]
            return out[order]

        with ThreadPoolExecutor(max(1, settings.calls_in_flight)) as pool:
            held: deque = deque()  # the calls of a batch begin before those of the one ahead have all ended
            for pdf in batches:
                held.append((pdf, begun(pdf)))
                if len(held) > 1:
                    yield done(*held.popleft())
            while held:
                yield done(*held.popleft())
        if page is not None:
            page.close()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", " + ANSWER
    return sent.mapInPandas(run, schema)
