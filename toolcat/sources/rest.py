"""A paged REST listing as a Spark data source: one partition for each seed address, which follows its pages, or as a
stream, one partition for each page that has grown."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

TIMEOUT_S = 30


class Seed(InputPartition):
    def __init__(self, url: str):
        self.url = url


@dataclass
class Part(InputPartition):
    """Entries ``first`` up to ``last`` (all that follow, if None) of one page."""

    url: str
    first: int
    last: int | None


class Pages:
    """Answers of one service. A refusal for now (403 and 429, server errors, no connection) is asked again after the
    seconds in ``Retry-After``, or else after a pause that doubles; what is refused ``attempts`` times, or for good, is
    an error, which Spark retries."""

    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.token, self.next_header = options.get("token"), options.get("nextheader", "next_page")
        self.attempts, self.pause = int(options.get("attempts", 5)), float(options.get("pauseseconds", 1))
        self.longest = float(options.get("longestpauseseconds", 120))

    def _wait(self, attempt: int, headers) -> None:
        asked = (headers or {}).get("Retry-After", "")
        time.sleep(min(self.longest, float(asked) if asked.isdigit() else self.pause * 2**attempt))

    def get(self, url: str, body: bool = True) -> tuple[list | None, str | None]:
        """The page's entries, unless only its head is asked for, and the next page's address."""
        request = urllib.request.Request(url, headers={"Authorization": f"Bearer {self.token}"} if self.token else {})
        for attempt in range(self.attempts):
            last = attempt == self.attempts - 1
            try:
                with urllib.request.urlopen(request, timeout=TIMEOUT_S) as reply:
                    following = reply.headers.get(self.next_header) or None
                    found = json.loads(reply.read()) if body or not following else None
                    return (found if isinstance(found, list) or found is None else [found]), following
            except urllib.error.HTTPError as e:
                if last or not (e.code in (403, 429) or e.code >= 500):
                    raise
                self._wait(attempt, e.headers)
            except OSError:
                if last:
                    raise
                self._wait(attempt, None)
        raise ValueError("attempts must be positive")


class RestReader(DataSourceReader):
    def __init__(self, options: dict):
        self.pages = Pages(options)

    def partitions(self) -> list[Seed]:
        return [Seed(u) for u in self.pages.urls]

    def read(self, partition: Seed) -> Iterator[tuple]:
        """Each page's entries as JSON, with the page's address and their places."""
        url: str | None = partition.url
        while url:
            found, following = self.pages.get(url)
            for i, entry in enumerate(found):
                yield url, i, json.dumps(entry)
            url = following


class RestStream(DataSourceStreamReader):
    """A listing that grows at its end. The offset of a seed is the number of its pages that have a follower and of
    the entries seen on the one that has none yet, so a page that fills up is read on from there. The driver looks at
    the pages' heads and at last pages only; entries are read by the tasks."""

    def __init__(self, options: dict):
        self.pages = Pages(options)
        self.chains = {u: [u] for u in self.pages.urls}

    def initialOffset(self) -> dict:
        return {u: [0, 0] for u in self.pages.urls}

    def latestOffset(self) -> dict:
        found = {}
        for seed, chain in self.chains.items():
            entries, following = self.pages.get(chain[-1], body=False)
            while following:
                chain.append(following)
                entries, following = self.pages.get(following, body=False)
            found[seed] = [len(chain) - 1, len(entries)]
        return found

    def partitions(self, start: dict, end: dict) -> list[Part]:
        """A seed that the checkpoint doesn't know begins at its first page."""
        if any(n >= len(self.chains.get(u, ())) for u, (n, _) in end.items() if u in self.chains):
            self.latestOffset()  # after a restart
        parts = []
        for seed, (pages, seen) in end.items():
            first, before = start.get(seed, [0, 0])
            for n in range(first, pages + 1) if seed in self.chains else ():
                part = Part(self.chains[seed][n], before if n == first else 0, seen if n == pages else None)
                if part.last is None or part.last > part.first:
                    parts.append(part)
        return parts

    def read(self, partition: Part) -> Iterator[tuple]:
        found, _ = self.pages.get(partition.url)
        for i, entry in enumerate(found[partition.first : partition.last], partition.first):
            yield partition.url, i, json.dumps(entry)


class RestSource(DataSource):
    """S15. Options: ``urls`` (one a line), ``token``, ``nextHeader``; ``attempts``, ``pauseSeconds`` and
    ``longestPauseSeconds`` for refusals."""

    @classmethod
    def name(cls) -> str:
        return "rest_pages"

    def schema(self) -> str:
        return "page string, pos int, body string"

    def reader(self, schema) -> RestReader:
        return RestReader(dict(self.options))

    def streamReader(self, schema) -> RestStream:
        return RestStream(dict(self.options))
