"""Sources that give pages or a cursor, as streams whose checkpoint is the place to go on from."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader

Fetch = Callable[[int], pa.RecordBatch | Iterable[tuple]]


@dataclass
class _Page(InputPartition):
    page: int


class _Pages(DataSourceStreamReader):
    def __init__(self, fetch: Fetch, pages: Callable[[], int]):
        self.fetch, self.pages = fetch, pages

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        return {"page": self.pages()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Page(k) for k in range(start["page"], end["page"])]

    def read(self, partition: _Page) -> Iterator[pa.RecordBatch | tuple]:
        found = self.fetch(partition.page)
        yield from [found] if isinstance(found, pa.RecordBatch) else found


def paged_source(name: str, schema: str, fetch: Fetch, pages: Callable[[], int]) -> type[DataSource]:
    """A stream source, to be registered, of numbered pages: fetch(page) gives a page's rows in a task, pages() how many are complete.

    The offset is the next page (PAGE_OFFSET): a page is read once, by one task, and after a failure the pages of
    the batch are fetched again, so a complete page must not change. Both functions must be picklable.
    """

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def streamReader(self, schema: object) -> DataSourceStreamReader:
            return _Pages(fetch, pages)

    return Paged


class _Cursor(SimpleDataSourceStreamReader):
    def __init__(self, follow: Callable[[str | None], tuple[list[tuple], str | None]]):
        self.follow = follow

    def initialOffset(self) -> dict:
        return {"cursor": ""}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, cursor = self.follow(start["cursor"] or None)
        return iter(rows), {"cursor": cursor or start["cursor"]} if rows else start

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        cursor = start["cursor"]
        while cursor != end["cursor"]:
            rows, cursor = self.follow(cursor or None)
            yield from rows
            if not rows:
                return


def cursor_source(name: str, schema: str, follow: Callable[[str | None], tuple[list[tuple], str | None]]) -> type[DataSource]:
    """A stream source, to be registered, behind a cursor: follow(cursor) gives the next rows and the cursor after them (None at first).

    The offset is the cursor (CURSOR). Only its holder can ask for what follows, so the driver reads these rows, a
    page at a time: this is for sources that give no other way, and for small pages. Where pages can be named, use paged_source.
    """

    class Cursor(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def simpleStreamReader(self, schema: object) -> SimpleDataSourceStreamReader:
            return _Cursor(follow)

    return Cursor
