"""Calls of an external service for every row, over a client that the caller injects; offline by default.

``client`` makes, in each worker, a function (model, prompt) -> (status, answer). A call is tried again after statuses that may
pass (429 and 5xx) with growing pauses; after ``empties`` empty answers of the first model the second one is asked. Nothing
here knows a network: tests and queries inject a function of the prompt."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "answer string, model string, tries int, status int"


def ask(call: Callable[[str, str], tuple[int, str]], prompt: str, models: tuple[str, str], most: int, empties: int, pause: float) -> tuple[str | None, str, int, int]:
    """(answer or null, model, tries, last status)."""
    tries = status = 0
    for model in models:
        empty = 0
        for k in range(most):
            tries += 1
            status, answer = call(model, prompt)
            if status == 200 and answer:
                return answer, model, tries, status
            empty += status == 200
            if empty >= empties or (status != 200 and status != 429 and status < 500):
                break
            time.sleep(pause * 2**k)
    return None, model, tries, status


def ask_all(df: DataFrame, key: str, prompt: str, client: Callable[[], Callable], models: tuple[str, str], most: int = 3, empties: int = 2, pause: float = 0.0) -> DataFrame:
    """One row for each row of ``df``: key, answer, model, tries, status. A null prompt is an empty one."""

    def run(batches):
        call = client()
        for pdf in batches:
            rows = [ask(call, p or "", models, most, empties, pause) for p in pdf[prompt]]
            out = pd.DataFrame(rows, columns=["answer", "model", "tries", "status"])
            out.insert(0, key, pdf[key].to_numpy())
            yield out

    return df.select(key, prompt).mapInPandas(run, f"{df.select(key).schema.simpleString()[7:-1].replace(':', ' ')}, {SCHEMA}")
