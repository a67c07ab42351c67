"""Outside models and fetchers as table functions: the callable is injected, one for each partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

BATCH = 32


def fetch_pages(urls: DataFrame, make: Callable[[], Callable[[str], str | None]], url_col: str = "url") -> DataFrame:
    """(url, html); html is null where fetching failed."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = make()
        for frame in frames:
            yield pd.DataFrame({"url": frame["url"], "html": [get(u) for u in frame["url"]]})

    return urls.select(urls[url_col].alias("url")).mapInPandas(run, "url string, html string")


def ask(prompts: DataFrame, make: Callable[[], Callable[[str], str]]) -> DataFrame:
    """(id, answer) from (id, prompt); a failing call answers with null."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make()
        for frame in frames:
            answers = []
            for p in frame["prompt"]:
                try:
                    answers.append(call(p))
                except Exception:  # noqa: BLE001  whatever the injected client raises is a failed answer
                    answers.append(None)
            yield pd.DataFrame({"id": frame["id"], "answer": answers})

    return prompts.select("id", "prompt").mapInPandas(run, f"id {prompts.schema['id'].dataType.simpleString()}, answer string")


def embed(texts: DataFrame, make: Callable[[], Callable[[list[str]], list[list[float]]]], cache: DataFrame | None = None) -> DataFrame:
    """(id, embedding) from (id, text), in batches; ids in the cache are not asked again."""
    missing = texts if cache is None else texts.join(cache.select("id"), "id", "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make()
        for frame in frames:
            for at in range(0, len(frame), BATCH):
                part = frame.iloc[at : at + BATCH]
                yield pd.DataFrame({"id": part["id"], "embedding": encode(part["text"].tolist())})

    new = missing.select("id", "text").mapInPandas(run, f"id {texts.schema['id'].dataType.simpleString()}, embedding array<float>")
    return new if cache is None else cache.select("id", "embedding").join(texts.select("id"), "id", "left_semi").unionByName(new)
