"""Verdicts from a hosted model: requests, replies, retries.

The transport is a function from a request to the reply's text, so any client
library fits and none is needed here.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

Transport = Callable[[dict[str, Any]], str]


@dataclass(frozen=True)
class Client:
    """Sends tasks and keeps replies; ``pause`` seconds double at every retry."""

    transport: Transport
    model: str
    retries: int = 2
    pause: float = 1.0

    def ask(self, task: dict[str, Any]) -> dict[str, Any]:
        """The reply as an object; a task that fails to the end gives skipped
        and the error."""
        problem = ""
        for attempt in range(self.retries + 1):
            if attempt:
                time.sleep(self.pause * 2 ** (attempt - 1))
            try:
                return parsed(self.transport({"model": self.model, **task}))
            except Exception as error:
                problem = str(error)
        return {"skipped": True, "error": problem}


def parsed(reply: str) -> dict[str, Any]:
    """The object in a reply: all of it, a fenced block, or what stands between
    the first and the last brace."""
    fenced = re.search(r"```(?:json)?\s*(\{.*?\})\s*```", reply, re.S)
    braces = re.search(r"\{.*\}", reply, re.S)
    for text in (reply, fenced and fenced.group(1), braces and braces.group(0)):
        try:
            found = json.loads(text) if text else None
        except ValueError:
            continue
        if isinstance(found, dict):
            return found
    raise ValueError("the reply holds no object")


def make_client(config: dict[str, Any], transport: Transport | None, purpose: str = "validate") -> Client | None:
    """A client if the configuration enables one for the purpose and there is a
    transport; None otherwise, and rows go the way without a model."""
    section = {**(config.get("llm") or {}), **((config.get("llm") or {}).get(purpose) or {})}
    if transport is None or not section.get("enabled", False):
        return None
    return Client(transport, str(section.get("model", "default")), int(section.get("retries", 2)), float(section.get("pause", 1.0)))


def replies(tasks: DataFrame, make: Callable[[], Client | None], key: str = "id") -> DataFrame:
    """(key, reply): a JSON object per task, one client to each partition.
    Without a client every reply says that it was skipped."""
    names = [c for c in tasks.columns if c != key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                task = {n: row[n] for n in names}
                out.append(json.dumps({"skipped": True} if client is None else client.ask(task), ensure_ascii=False))
            yield pd.DataFrame({key: batch[key], "reply": out})

    return tasks.mapInPandas(run, f"{key} {tasks.schema[key].dataType.simpleString()}, reply string")
