"""Fetching with an injected client: errors are values, so a failed item is a row."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import FETCHED
from ..session import ship


class HttpError(Exception):
    """What a client raises for an HTTP status that is an error."""

    def __init__(self, status: int, message: str = ""):
        super().__init__(f"HTTP {status}: {message}" if message else f"HTTP {status}")
        self.status = status


def with_retries(get: Callable[[str], bytes], url: str, tries: int = 5, pause: float = 60.0, retry_on: int = 503, sleep: Callable[[float], None] = time.sleep) -> tuple[bytes | None, str | None]:
    """(content, None) or (None, error). Only one status is tried again."""
    for n in range(1, tries + 1):
        try:
            return get(url), None
        except HttpError as e:
            if e.status != retry_on or n == tries:
                return None, str(e)
            sleep(pause)
        except Exception as e:  # any failure of the injected client is a row with an error
            return None, f"{type(e).__name__}: {e}"
    return None, "no try left"


def fetched(wanted: DataFrame, get: Callable[[str], bytes], key: str = "key", url: str = "url", streams: int = 1, pause: float = 0.0, **retrying) -> DataFrame:
    """(key, content, error) of each wanted row. `streams` partitions fetch at a time, each with a pause after each item, so the rate is
    bounded whatever the cluster's size. Write the result before it is used twice."""
    ship(wanted.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k, u in zip(frame["key"], frame["url"], strict=True):
                rows.append((k, *with_retries(get, u, **retrying)))
                if pause:
                    time.sleep(pause)
            yield pd.DataFrame(rows, columns=["key", "content", "error"])

    return wanted.select(F.col(key).cast("string").alias("key"), F.col(url).alias("url")).repartition(streams).mapInPandas(run, FETCHED)


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What came, and the error log."""
    return rows.where("error is null").select("key", "content"), rows.where("error is not null").select("key", "error")
