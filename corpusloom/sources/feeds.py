"""RSS feeds and sitemaps as Spark data sources.

``spark.read.format("rss")`` and ``format("sitemap")`` read one partition for each address.
Addresses may be http(s) or file paths; fetching retries 429, 5xx and transport errors with
growing waits and gives up at once on any other status.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RETRIES = 3
FIRST_WAIT = 1.0
DEEPEST = 5
RETRIABLE = (429, 500, 502, 503, 504)


def fetch(url: str, timeout: float = 15, wait: Callable[[float], None] = time.sleep, opener: Callable | None = None) -> bytes | None:
    """The body, or None."""
    if not url.startswith(("http://", "https://")):
        try:
            with open(url.removeprefix("file://"), "rb") as f:
                return f.read()
        except OSError:
            return None
    opener = opener or (lambda u: urllib.request.urlopen(u, timeout=timeout).read())
    for attempt in range(RETRIES):
        try:
            return opener(url)
        except urllib.error.HTTPError as e:
            if e.code not in RETRIABLE:
                return None
        except OSError:
            pass
        if attempt + 1 < RETRIES:
            wait(FIRST_WAIT * 2**attempt)
    return None


def parse_time(text: str | None) -> str | None:
    """ISO or date or RFC 822 as ISO in UTC; None for anything else."""
    if not text or not text.strip():
        return None
    text = text.strip()
    for parse in (datetime.fromisoformat, lambda t: datetime.strptime(t, "%Y-%m-%d"), parsedate_to_datetime):
        try:
            got = parse(text)
        except (ValueError, TypeError):
            continue
        got = got if got.tzinfo else got.replace(tzinfo=timezone.utc)
        return got.astimezone(timezone.utc).isoformat()
    return None


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _texts(node: ET.Element) -> dict[str, str]:
    found: dict[str, str] = {}
    for child in node:
        found.setdefault(_local(child.tag), (child.text or child.get("href") or "").strip())
    return found


def rss_entries(body: bytes | None) -> Iterator[tuple[str, str | None, str | None, str | None]]:
    """(url, title, summary, published) of the entries that have a link."""
    try:
        root = ET.fromstring(body or b"")
    except ET.ParseError:
        return
    for node in root.iter():
        if _local(node.tag) in ("item", "entry"):
            t = _texts(node)
            if t.get("link"):
                when = next((p for k in ("published", "updated", "date", "pubDate") if (p := parse_time(t.get(k)))), None)
                yield t["link"], t.get("title") or None, t.get("description") or t.get("summary") or None, when


def sitemap_urls(url: str, most: int = 10_000, load: Callable[[str], bytes | None] = fetch, depth: int = 0) -> list[tuple[str, str | None]]:
    """(url, lastmod), through indexes up to five deep; namespaces do not matter."""
    if depth >= DEEPEST or most <= 0:
        return []
    try:
        root = ET.fromstring(load(url) or b"")
    except ET.ParseError:
        return []
    out: list[tuple[str, str | None]] = []
    for node in root:
        t = _texts(node)
        if not t.get("loc"):
            continue
        if _local(root.tag) == "sitemapindex":
            out.extend(sitemap_urls(t["loc"], most - len(out), load, depth + 1))
        else:
            out.append((t["loc"], parse_time(t.get("lastmod"))))
        if len(out) >= most:
            return out[:most]
    return out


class _Address(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.urls = [u for u in options.get("path", "").split(",") if u]
        self.most = int(options.get("max_urls", 10_000))

    def partitions(self) -> list[InputPartition]:
        return [_Address(u) for u in self.urls]


class _RssReader(_Reader):
    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for entry in rss_entries(fetch(partition.value)):
            yield (partition.value, *entry)


class _SitemapReader(_Reader):
    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for entry in sitemap_urls(partition.value, self.most):
            yield (partition.value, *entry)


class RssSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rss"

    def schema(self) -> str:
        return "feed string, url string, title string, summary string, published string"

    def reader(self, schema: object) -> DataSourceReader:
        return _RssReader(self.options)


class SitemapSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sitemap"

    def schema(self) -> str:
        return "sitemap string, url string, lastmod string"

    def reader(self, schema: object) -> DataSourceReader:
        return _SitemapReader(self.options)


def register(spark: SparkSession) -> None:
    for source in (RssSource, SitemapSource):
        spark.dataSource.register(source)
