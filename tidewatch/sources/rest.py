"""Paged REST responses as a data source, simple filters pushed to the server.

Pages of a service are found in one of three ways: their number is known, one partition each; offsets are read until a
page is empty, by a few partitions that take turns; or each page names the next by a token, which one partition follows.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, InputPartition


class PagedJson(DataSource):
    """Records of a paged JSON service.  Options:

    ``url``; ``records`` (name of the list, with dots for nested ones); ``filters`` (comma-separated columns the server can
    compare); ``retries``;
    ``skip`` (name of the offset parameter), ``size`` (records of a page), and ``pages`` (their number), or without it
    ``strands`` (partitions that read every so many-th page until one is empty);
    ``token`` (name in a response of what the next page is asked by; asked for until there is none, or no record) and
    ``token_param`` (name of the parameter it is sent as);
    ``body`` (JSON text to send by POST, in which "{token}" and "{skip}" are put in).

    ``url`` may be file:// with ``{skip}`` or ``{token}`` in it: landed pages read the same way.  A page that isn't there is
    empty.

    As a stream it reads what has come since: its offset is a page and how many of its records were read, so a collection
    that stops goes on after the last of them, also where the last page has grown.  Pages mustn't change otherwise.  Pages by
    offset are read in runs, ``strands`` of them or, of very many pages, more.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        raise ValueError("a schema has to be given")

    def reader(self, schema) -> DataSourceReader:
        return PagedJsonReader(self.options, schema)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagedJsonStream(self.options, schema)


#: Pages by offset that one partition of a stream reads at most: a task for each page costs more than its records.
PAGES = 200


@dataclass
class Pages(InputPartition):
    """Pages ``first``, ``first + step``, ... up to ``last``, or to one that is empty."""

    first: int
    step: int = 1
    last: int | None = None


@dataclass
class Span(InputPartition):
    """Records of pages from ``first`` on (asked by ``token``, if pages are), without the first ``skip`` of that page, up to so
    many of page ``last``."""

    first: int
    token: str
    skip: int
    last: int
    records: int


class _Service:
    """Asking for pages."""

    def __init__(self, options, schema):
        self.options, self.schema, self.pushed = options, schema, {}

    @property
    def size(self) -> int:
        return int(self.options.get("size", 1000))

    def _following(self, answer: dict, token: str) -> str | None:
        """What the page after this one is asked by, if there is one."""
        following = answer.get(self.options["token"]) or None
        return following if self._records(answer) and following != token else None
    def _records(self, answer: dict) -> list:
        found = answer
        for part in self.options.get("records", "Items").split("."):
            found = (found or {}).get(part)
        return found or []

    def _row(self, record: dict) -> tuple:
        return tuple(record.get(f.name) for f in self.schema.fields)

    def _page(self, skip: int, token: str) -> dict:
        url = self.options["url"].replace("{skip}", str(skip)).replace("{token}", urllib.parse.quote(token))
        if url.startswith("file:"):
            return self._fetched(url)
        asked = dict(self.pushed)
        if "token" in self.options:
            asked |= {self.options.get("token_param", self.options["token"]): token} if token and "body" not in self.options else {}
        elif "body" not in self.options:
            asked[self.options.get("skip", "$skip")] = skip
        url += "?" + urllib.parse.urlencode(asked) if asked else ""
        if "body" not in self.options:
            return self._fetched(url)
        body = self.options["body"].replace("{token}", json.dumps(token)[1:-1]).replace("{skip}", str(skip))
        return self._fetched(urllib.request.Request(url, body.encode(), {"Content-Type": "application/json"}))

    def _fetched(self, request) -> dict:
        tries = int(self.options.get("retries", 5))
        for i in range(tries):
            try:
                with urllib.request.urlopen(request, timeout=60) as f:
                    return json.load(f)
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    return {}
                if i == tries - 1:
                    raise
            except OSError as e:
                if isinstance(e, FileNotFoundError) or "No such file" in str(e):
                    return {}
                if i == tries - 1:
                    raise
            time.sleep(min(2**i, 30) * float(self.options.get("pause", 1)))
        return {}


class PagedJsonReader(_Service, DataSourceReader):
    def pushFilters(self, filters: list[Filter]):
        known = set(self.options.get("filters", "").split(","))
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in known:
                self.pushed[f.attribute[0]] = f.value
            yield f  # compared again by Spark: servers may be lenient

    def partitions(self) -> list[InputPartition]:
        if "token" in self.options:
            return [Pages(0)]
        if "pages" in self.options:
            return [Pages(i, 1, i) for i in range(int(self.options["pages"]))]
        strands = int(self.options.get("strands", 12))
        return [Pages(i, strands) for i in range(strands)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        if "token" in self.options:
            token = ""
            while token is not None:
                answer = self._page(0, token)
                records = self._records(answer)
                yield from map(self._row, records)
                token = self._following(answer, token)
            return
        page = partition.first
        while partition.last is None or page <= partition.last:
            records = self._records(self._page(page * self.size, ""))
            yield from map(self._row, records)
            if not records:
                return
            page += partition.step


class PagedJsonStream(_Service, DataSourceStreamReader):
    def __init__(self, options, schema):
        super().__init__(options, schema)
        self.seen = 0, ""  # the last page that is known, and its token

    def initialOffset(self) -> dict:
        return {"page": 0, "token": "", "records": 0}

    def latestOffset(self) -> dict:
        """The last page with a record and how many it has: found by tokens from the last page known, or else by doubling and
        halving the number of the page."""
        if "token" in self.options:
            page, token = self.seen
            answer = self._page(0, token)
            while (following := self._following(answer, token)) is not None:
                after = self._page(0, following)
                if not self._records(after):
                    break
                page, token, answer = page + 1, following, after
            self.seen = page, token
            return {"page": page, "token": token, "records": len(self._records(answer))}
        count = lambda p: len(self._records(self._page(p * self.size, "")))
        low, high = 0, 1
        while count(high):
            low, high = high, high * 2
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if count(middle) else (low, middle)
        return {"page": low, "token": "", "records": count(low)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if "token" in self.options:
            return [Span(start["page"], start["token"], start["records"], end["page"], end["records"])]
        first, n = start["page"], end["page"] + 1 - start["page"]
        parts = min(n, max(int(self.options.get("strands", 12)), -(-n // PAGES)))
        out = []
        for i in range(parts):
            page, last = first + n * i // parts, first + n * (i + 1) // parts - 1
            out.append(Span(page, "", start["records"] if page == first else 0, last, end["records"] if last == end["page"] else self.size))
        return out

    def read(self, partition: Span) -> Iterator[tuple]:
        page, token, skip = partition.first, partition.token, partition.skip
        while True:
            answer = self._page(page * self.size, token)
            records = self._records(answer)
            yield from map(self._row, records[skip : partition.records if page == partition.last else None])
            if page == partition.last:
                return
            page, skip = page + 1, 0
            if "token" in self.options:
                token = self._following(answer, token)
                if token is None:
                    raise ValueError("a page that was there names no other")


def register(spark) -> None:
    """Makes ``paged_json`` known to the session, with filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(PagedJson)
