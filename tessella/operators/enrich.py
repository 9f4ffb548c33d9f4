"""Enrichment of rows by a model: one pluggable operator with retries, fallback and a status for each row.

Nothing here calls a network. A provider is any object with `complete(prompt, model) -> str`; the default one is
deterministic and extractive, a stand-in to run and test pipelines, not a summariser of any quality.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RateLimited(Exception):
    """The provider asks to wait; `after` seconds if it says so."""

    def __init__(self, after: float | None = None):
        super().__init__("rate limited")
        self.after = after


class TimedOut(Exception):
    """The provider gave no answer in time."""


class BadAnswer(Exception):
    """The answer has not the asked form; asking again is no use."""


class Provider(Protocol):
    """What answers prompts."""

    def complete(self, prompt: str, model: str) -> str: ...


class Extractive:
    """The first sentences of the part of a prompt after its first blank line."""

    def __init__(self, sentences: int = 2):
        self.sentences = sentences

    def complete(self, prompt: str, model: str) -> str:
        body = prompt.partition("\n\n")[2] or prompt
        return " ".join(re.split(r"(?<=[.!?])\s+", body.strip())[: self.sentences])


@dataclass
class Policy:
    """Models in order of preference, tries for each, and waits in seconds between tries (n is the try, from 0)."""

    models: list[str] = field(default_factory=lambda: ["default"])
    tries: int = 3
    after_timeout: Callable[[int], float] = lambda n: 2.0 * (n + 1)
    after_limit: Callable[[int], float] = lambda n: 30.0 * (n + 1)
    after_error: Callable[[int], float] = lambda n: 2.0
    sleep: Callable[[float], None] = time.sleep


def answer(provider: Provider, prompt: str, policy: Policy) -> tuple[str | None, str, str | None, int, str | None]:
    """(answer, status, model, tries, error) of one prompt; never raises.

    Statuses: success, failed_other (an answer of a wrong form; or an empty prompt), failed_timeout, failed_rate_limit,
    failed_model_exhausted (several models, all failed).
    """
    if not prompt:
        return None, "failed_other", None, 0, "empty prompt"
    tries, last, status = 0, None, "failed_other"
    for model in policy.models:
        for n in range(policy.tries):
            tries += 1
            try:
                return provider.complete(prompt, model), "success", model, tries, None
            except BadAnswer as x:
                return None, "failed_other", model, tries, str(x)[:300]
            except RateLimited as x:
                last, status, wait = x, "failed_rate_limit", x.after if x.after is not None else policy.after_limit(n)
            except TimedOut as x:
                last, status, wait = x, "failed_timeout", policy.after_timeout(n)
            except Exception as x:  # noqa: BLE001 - any failure of a provider is the row's status
                last, status, wait = x, "failed_other", policy.after_error(n)
            if n + 1 < policy.tries:
                policy.sleep(wait)
    return None, "failed_model_exhausted" if len(policy.models) > 1 else status, None, tries, str(last)[:300]


def enrich(df: DataFrame, key: str, prompt: str, make: Callable[[], Provider] = Extractive, policy: Policy | None = None, partitions: int | None = None) -> DataFrame:
    """key, answer, status, model, tries, error for each row; `partitions` bounds how many prompts run at once.

    Retries stay inside a row, since a repeated task would repeat paid calls; rows are idempotent by key.
    """
    rules = policy or Policy()
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()
        for batch in batches:
            rows = [answer(provider, p, rules) for p in batch["prompt"]]
            yield pd.DataFrame([(k, *r) for k, r in zip(batch[key], rows)], columns=[key, "answer", "status", "model", "tries", "error"])

    slim = df.select(F.col(key), F.col(prompt).alias("prompt"))
    slim = slim.repartition(partitions) if partitions else slim
    return slim.mapInPandas(run, f"`{key}` {kind}, answer string, status string, model string, tries int, error string")


def fallback(answers: DataFrame, text: str = "summary", failed: float = 0.0, done: float = 0.5) -> DataFrame:
    """Answers as summaries: a failed one has a note for its text and confidence `failed`, another one `done`."""
    ok = F.col("status") == "success"
    return answers.withColumn(text, F.when(ok, F.col("answer")).otherwise(F.concat(F.lit("[failed: "), F.col("status"), F.lit("]")))).withColumn("confidence", F.when(ok, F.lit(done)).otherwise(F.lit(failed)))


def parsed_answer(answers: DataFrame, schema: str, defaults: dict[str, object]) -> DataFrame:
    """Adds the fields of a JSON answer, found from its first { to its last }, with defaults for missing ones."""
    from tessella.functions.text import json_between_braces

    parsed = answers.withColumn("_j", F.from_json(json_between_braces(F.col("answer")), schema))
    for name, default in defaults.items():
        parsed = parsed.withColumn(name, F.coalesce(F.col(f"_j.{name}"), F.lit(default)))
    return parsed.drop("_j")
