"""Paged extracts as a Spark data source: each task fetches a run of pages.

A page is fetched by the task it belongs to, tried again with growing waits, and
given up after a number of tries; the page then shows as one failed row.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from millrace.session import stage


#: Tasks of an extract for each core: a task costs more than a page does, so longer extracts have longer runs of pages.
TASKS_A_CORE = 4


class PageError(Exception):
    """The page could not be fetched this time."""


class Pages(InputPartition):
    """Pages first, first + 1, ..., last - 1."""

    def __init__(self, first: int, last: int):
        self.first = first
        self.last = last


def page_runs(pages: int, max_tasks: int) -> list[Pages]:
    """One task per page as long as there are at most ``max_tasks``, else equal runs of pages."""
    length = max(1, -(-pages // max_tasks))
    return [Pages(i, min(i + length, pages)) for i in range(0, pages, length)]


def fetch_with_retry(
    fetch: Callable[[], list[str]], attempts: int, base: float, sleep: Callable[[float], None] = time.sleep
) -> list[str]:
    """Records of a page; raises the last error after ``attempts`` tries."""
    for attempt in range(attempts):
        try:
            return fetch()
        except (PageError, OSError):
            if attempt + 1 == attempts:
                raise
            sleep(random.uniform(0, base * 2**attempt))
    raise ValueError("attempts must be positive")


def _bodies(location: str, number: int | str) -> list[dict]:
    """The JSON texts stored below ``location/page=N``, one for each file and line."""
    from pyarrow import fs

    local = location.removeprefix("file:") if not location.startswith("file://") else location
    uri = local if "://" in local else "file://" + local
    filesystem, root = fs.FileSystem.from_uri(uri)
    infos = filesystem.get_file_info(fs.FileSelector(f"{root}/page={number}", allow_not_found=True))
    bodies = []
    for info in sorted((i for i in infos if i.base_name.startswith("part-")), key=lambda i: i.path):
        with filesystem.open_input_stream(info.path) as stream:
            bodies += [json.loads(line) for line in stream.read().decode().splitlines() if line.strip()]
    return bodies


def fetch_page(location: str, number: int | str) -> list[str]:
    """Records of a page, from all files it is stored in; a page that isn't there has none."""
    bodies = _bodies(location, number)
    for body in bodies:
        if "error" in body:
            raise PageError(body["error"])
    return [json.dumps(item) for body in bodies for item in body["items"]]


def fetch_by_cursor(location: str, start: str) -> Iterator[tuple[str, list[str]]]:
    """Pages that each name the next one in ``next``; ends with the page that names none."""
    cursor, seen = start, set()
    while cursor and cursor not in seen:
        seen.add(cursor)
        bodies = _bodies(location, cursor)
        if not bodies:
            raise PageError(f"page {cursor} is missing")
        yield cursor, [json.dumps(item) for body in bodies for item in body.get("items", [])]
        cursor = next((str(b["next"]) for b in bodies if b.get("next")), "")


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.location = options["location"]
        self.attempts = int(options.get("attempts", "3"))
        self.base = float(options.get("wait", "0.5"))
        self.max_tasks = int(options.get("max_tasks", "10000"))
        self.cursors = [x for x in options.get("cursors", "").split(",") if x]
        self.first, self.pages = int(options.get("first", "0")), int(options.get("pages", "0"))

    def partitions(self):
        if self.cursors:
            return [Pages(i, i + 1) for i in range(len(self.cursors))]
        return [Pages(self.first + r.first, self.first + r.last) for r in page_runs(self.pages - self.first, self.max_tasks)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        for number in range(partition.first, partition.last):
            if self.cursors:
                yield from self._chain(number)
                continue
            try:
                records = fetch_with_retry(lambda n=number: fetch_page(self.location, n), self.attempts, self.base)
            except (PageError, OSError) as error:
                yield (number, "failed", str(error))
                continue
            if not records:
                yield (number, "empty", None)
            for record in records:
                yield (number, "ok", record)

    def _chain(self, number: int) -> Iterator[tuple]:
        """All pages of one chain of cursors; what breaks it shows as a failed row."""
        try:
            for _, records in fetch_by_cursor(self.location, self.cursors[number]):
                for record in records:
                    yield (number, "ok", record)
        except (PageError, OSError) as error:
            yield (number, "failed", str(error))


class PagedSource(DataSource):
    """``spark.read.format("paged_json")`` with options location, pages (and first) or cursors, attempts, wait, max_tasks.

    A page without records gives one row of status ``empty``.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, status string, record string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


class Cursor(InputPartition):
    """The pages that a run of cursors names; ``name`` is the first one."""

    def __init__(self, names: list[str]):
        self.names = names

    @property
    def name(self) -> str:
        return self.names[0]


class CursorReader(DataSourceStreamReader):
    """Pages that each name the next one, as a stream whose offset is the cursor.

    The driver follows the links of at most ``pages_per_batch`` pages, one at a time as
    only a page names its successor, and keeps the names; the records are fetched by the
    tasks, a run of pages each. The checkpoint holds the cursor that comes next, so a run
    goes on where the last one stopped. A page that isn't there yet ends a batch.
    """

    def __init__(self, options):
        self.location = options["location"]
        self.start = options["start"]
        self.attempts = int(options.get("attempts", "3"))
        self.base = float(options.get("wait", "0.5"))
        self.most = int(options.get("pages_per_batch", "1000"))
        self.max_tasks = int(options.get("max_tasks", "10000"))
        self.at: dict | None = None
        self.links: dict[str, str | None] = {}

    def initialOffset(self) -> dict:
        return {"next": self.start, "pages": 0}

    def _link(self, name: str) -> str | None:
        """What follows a page, an empty text at the end of the chain, None if the page isn't there."""
        if name not in self.links:
            bodies = _bodies(self.location, name)
            if not bodies:
                return None
            self.links[name] = next((str(b["next"]) for b in bodies if b.get("next")), "")
        return self.links[name]

    def latestOffset(self) -> dict:
        at = dict(self.at or self.initialOffset())
        for _ in range(self.most):
            following = self._link(at["next"]) if at["next"] else None
            if following is None:
                break
            at = {"next": following, "pages": at["pages"] + 1}
        self.at = at
        return at

    def partitions(self, start: dict, end: dict) -> list[Cursor]:
        if self.at is None:
            self.at = dict(end)  # after a restart Spark plans the last batch first
        names, name = [], start["next"]
        for _ in range(end["pages"] - start["pages"]):
            names.append(name)
            name = self._link(name) or ""
        for done in names:
            self.links.pop(done, None)
        return [Cursor(names[r.first : r.last]) for r in page_runs(len(names), self.max_tasks)]

    def read(self, partition: Cursor) -> Iterator[tuple]:
        for name in partition.names:
            try:
                for record in fetch_with_retry(lambda n=name: fetch_page(self.location, n), self.attempts, self.base):
                    yield (name, "ok", record)
            except (PageError, OSError) as error:
                yield (name, "failed", str(error))

    def commit(self, end: dict) -> None:
        """Nothing to release: the source keeps its pages."""


class CursorSource(DataSource):
    """``spark.readStream.format("cursor_json")`` with options location, start, pages_per_batch, attempts, wait, max_tasks."""

    @classmethod
    def name(cls) -> str:
        return "cursor_json"

    def schema(self) -> str:
        return "page string, status string, record string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return CursorReader(self.options)


def stream_cursor(spark: SparkSession, location: str, start: str, schema: str, pages_per_batch: int = 1000) -> DataFrame:
    """A stream of typed records along a chain of pages; failed pages are rows of status ``failed``."""
    spark.dataSource.register(CursorSource)
    tasks = TASKS_A_CORE * spark.sparkContext.defaultParallelism
    options = {"location": location, "start": start, "pages_per_batch": str(pages_per_batch), "max_tasks": str(tasks)}
    return _typed(spark.readStream.format("cursor_json").options(**options).load(), schema)


def _typed(raw: DataFrame, schema: str) -> DataFrame:
    typed = raw.withColumn("r", F.when(F.col("status") == "ok", F.from_json("record", schema)))
    return typed.select("page", "status", F.when(F.col("status") == "failed", F.col("record")).alias("error"), "r.*")


#: Pages of the first wave of an extract whose length is not known.
WAVE = 16


def fetch(spark: SparkSession, location: str, pages: int | None = None, attempts: int = 3, wait: float = 0.5) -> DataFrame:
    """page, status and the text of every record of all pages; a page given up is one row of status ``failed``.

    Without ``pages`` the extract ends before the first empty page. Pages are then
    fetched in waves, each twice as long as the one before, until a wave
    has met an empty page; what lies behind it is left out. The page itself says
    that it is empty, by the same fetch with its tries, so no page is jumped. The waves
    are stored, so the result may be read several times.
    """
    spark.dataSource.register(PagedSource)
    tasks = TASKS_A_CORE * spark.sparkContext.defaultParallelism
    reader = spark.read.format("paged_json").options(location=location, attempts=str(attempts), wait=str(wait), max_tasks=str(tasks))
    if pages is not None:
        return reader.options(pages=str(pages)).load().filter("status <> 'empty'")
    first, length, found, end = 0, WAVE, None, None
    while end is None:
        wave = stage(reader.options(first=str(first), pages=str(first + length)).load(), "pages")
        end = wave.filter("status = 'empty'").agg(F.min("page")).first()[0]
        found = wave if found is None else found.unionByName(wave)
        first, length = first + length, 2 * length
    return found.filter(F.col("page") < end)


def read_pages(
    spark: SparkSession, location: str, pages: int | None, schema: str, attempts: int = 3, wait: float = 0.5
) -> DataFrame:
    """Typed records of all pages, and one row with status ``failed`` per page given up."""
    return _typed(fetch(spark, location, pages, attempts, wait), schema)


def read_cursors(spark: SparkSession, location: str, cursors: list[str], schema: str) -> DataFrame:
    """Typed records of chains of pages, one task per chain; ``page`` is the number of the chain."""
    spark.dataSource.register(PagedSource)
    return _typed(spark.read.format("paged_json").options(location=location, cursors=",".join(cursors)).load(), schema)


def dead_letters(raw: DataFrame, path: str) -> None:
    """Keep the pages that were given up, with the reason, for a later run."""
    failed = raw.filter("status = 'failed'").select("page", F.col("record").alias("error"))
    failed.write.mode("overwrite").parquet(path)
