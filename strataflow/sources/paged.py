"""Paged API extraction as a partitioned Spark data source.

The pages to read are known before they are read: the transport lists them, or
names the last one. They are dealt out to the partitions, and calls run and
retry in the executors. A page without records is a page like any other.

APIs allow a number of calls in a time. The allowance is dealt out as well: few enough
partitions, each with its share of the rate, stay below it together without talking
to each other. A call that is refused all the same waits as long as the reply asks.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timezone
from email.utils import parsedate_to_datetime
from typing import Any, Protocol
from urllib import error, parse, request

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Calls in a row that one partition makes, about; they set the number of partitions.
PAGES_PER_PARTITION = 16
NO_ANSWER = 599
# Longest that one page waits, in seconds, for an API that asks for patience.
PATIENCE = 3 * 3600.0
# Under an allowance, the time between two calls of one partition, about; with
# the allowance it sets the greatest number of partitions.
PACED_SECONDS = 1.0

# Status, body, and, in a reply that names it, the time to wait in seconds.
Reply = tuple[int, str] | tuple[int, str, float]


class Transport(Protocol):
    """Fetches the pages of one result."""

    def __call__(self, page: int) -> Reply:
        """Status and body, a JSON array, of a page numbered from 0; a refusal may add
        the seconds to wait."""

    def pages(self) -> Sequence[int]:
        """Numbers of all pages there are."""


class ApiError(RuntimeError):
    """The API refused the call, or kept failing."""


def is_transient(status: int) -> bool:
    return status == 429 or status >= 500


def fetch_page(
    transport: Callable[[int], Reply], page: int, attempts: int = 3, sleep: Callable[[float], None] = time.sleep,
    patience: float = PATIENCE,
) -> str:
    """Body of one page. Waits 1, 2, 4 ... seconds between transient failures. A reply that
    names a time is waited for and counts as no failure, up to ``patience`` seconds in all."""
    failures, waited = 0, 0.0
    while True:
        status, body, *asked = transport(page)
        if status == 200:
            return body
        if asked:
            waited += asked[0]
            if waited > patience:
                raise ApiError(f"page {page}: status {status} asks for more than {patience:.0f} seconds")
            sleep(asked[0])
            continue
        if not is_transient(status):
            raise ApiError(f"page {page}: status {status} will not improve by retrying")
        failures += 1
        if failures == attempts:
            raise ApiError(f"page {page}: no answer after {attempts} attempts")
        sleep(2 ** (failures - 1))


def asked_wait(status: int, headers: Mapping[str, str], now: float) -> float | None:
    """Seconds until a refused call may be made again, one at least, as its headers say:
    ``Retry-After``, or the time at which a used-up allowance is renewed."""
    if status not in (403, 429, 503):
        return None
    after, left, renewed = (headers.get(h) for h in ("Retry-After", "X-RateLimit-Remaining", "X-RateLimit-Reset"))
    try:
        if after:
            if re.fullmatch(r"\d+", after.strip()):
                return max(1.0, float(after))
            due = parsedate_to_datetime(after)
            return max(1.0, (due if due.tzinfo else due.replace(tzinfo=timezone.utc)).timestamp() - now)
        if left == "0" and renewed:
            return max(1.0, float(renewed) - now)
    except ValueError:
        pass
    return None


class Paced:
    """A transport whose calls, the first too, come at least ``interval`` seconds after what
    came before. A task that is run again after its executor was lost keeps the pace."""

    def __init__(
        self, transport: Callable[[int], Reply], interval: float,
        clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep,
    ):
        self.transport, self.interval, self.clock, self.sleep = transport, interval, clock, sleep
        self.last = clock()

    def __call__(self, page: int) -> Reply:
        rest = self.last + self.interval - self.clock()
        if rest > 0:
            self.sleep(rest)
        self.last = self.clock()
        return self.transport(page)


@dataclass(frozen=True)
class HttpTransport:
    """GET ``url`` with the page number and size as parameters; the token is optional."""

    url: str
    page_size: int = 100
    token: str | None = None
    params: dict[str, str] = field(default_factory=dict)
    first_page: int = 1
    timeout: float = 30.0

    def build(self, page: int) -> request.Request:
        query = {**self.params, "per_page": self.page_size, "page": page + self.first_page}
        headers = {"Accept": "application/json"}
        if self.token:
            headers["Authorization"] = f"Bearer {self.token}"
        return request.Request(f"{self.url}?{parse.urlencode(query)}", headers=headers)

    def __call__(self, page: int) -> Reply:
        return self._call(page, lambda reply: reply.read().decode())

    def _call(self, page: int, take: Callable[[Any], str]) -> Reply:
        try:
            with request.urlopen(self.build(page), timeout=self.timeout) as reply:
                return reply.status, take(reply)
        except error.HTTPError as refused:
            wait = asked_wait(refused.code, refused.headers or {}, time.time())
            return (refused.code, "") if wait is None else (refused.code, "", wait)
        except (error.URLError, TimeoutError, ConnectionError):
            return NO_ANSWER, ""

    def pages(self) -> Sequence[int]:
        """Up to the page that the first reply's ``Link`` header calls the last; one
        page where it names none."""
        link = fetch_page(lambda page: self._call(page, lambda reply: reply.headers.get("Link") or ""), 0)
        return range(self.last_page(link) + 1)

    def last_page(self, link: str | None) -> int:
        """Number, from 0, of the last page by a ``Link`` header."""
        for target, rel in re.findall(r'<([^>]*)>[^,]*?rel="?([^",;]+)', link or ""):
            number = parse.parse_qs(parse.urlsplit(target).query).get("page")
            if rel == "last" and number:
                return int(number[0]) - self.first_page
        return 0


@dataclass(frozen=True)
class FileTransport:
    """Pages kept as text files ``root/page=<n>/*``: replays a landed extract."""

    root: str

    def _folder(self):
        from pyarrow import fs

        root = self.root.replace("file:/", "file:///", 1) if re.match("file:/[^/]", self.root) else self.root
        return fs.FileSystem.from_uri(root)

    def __call__(self, page: int) -> tuple[int, str]:
        from pyarrow import fs

        system, path = self._folder()
        entries = system.get_file_info(fs.FileSelector(f"{path}/page={page}", allow_not_found=True))
        bodies = []
        for entry in entries:
            if entry.is_file and not entry.base_name.startswith((".", "_")):
                with system.open_input_stream(entry.path) as stream:
                    bodies += stream.read().decode().splitlines()
        return 200, "[" + ",".join(bodies) + "]"

    def pages(self) -> Sequence[int]:
        """The numbers of the page folders there are, which may have gaps."""
        from pyarrow import fs

        system, path = self._folder()
        names = (entry.base_name for entry in system.get_file_info(fs.FileSelector(path)))
        return sorted(int(name.removeprefix("page=")) for name in names if re.fullmatch(r"page=\d+", name))


class _Slice(InputPartition):
    def __init__(self, pages: Sequence[int], interval: float):
        super().__init__(pages)
        self.pages, self.interval = pages, interval


class _PagedReader(DataSourceReader):
    def __init__(
        self, transport: Transport, schema: StructType, pages_per_partition: int, attempts: int,
        calls_per_hour: float | None, patience: float,
    ):
        self.transport, self.attempts, self.patience = transport, attempts, patience
        self.schema, self.share, self.allowed = schema, pages_per_partition, calls_per_hour

    def partitions(self) -> list[InputPartition]:
        pages = list(self.transport.pages())
        n = max(1, -(-len(pages) // self.share))
        interval = 0.0
        if self.allowed:
            n = min(n, max(1, int(self.allowed / 3600 * PACED_SECONDS)))
            interval = n * 3600 / self.allowed
        return [_Slice(pages[i::n], interval) for i in range(n)]

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        transport = Paced(self.transport, partition.interval) if partition.interval else self.transport
        for page in partition.pages:
            records = json.loads(fetch_page(transport, page, self.attempts, patience=self.patience))
            yield pa.RecordBatch.from_pylist(records, schema)


def read_pages(
    spark: SparkSession,
    transport: Transport,
    schema: StructType,
    pages_per_partition: int = PAGES_PER_PARTITION,
    attempts: int = 3,
    name: str = "paged_api",
    calls_per_hour: float | None = None,
    patience: float = PATIENCE,
) -> DataFrame:
    """Records of all pages, projected to the schema; an absent key becomes NULL.

    ``calls_per_hour``, the API's allowance or the part of it this job may use, holds for
    all partitions together: there are no more of them than it feeds with a call a second,
    and each keeps its share of the rate over retries too. ``patience`` is the longest
    that one page waits, in seconds, where the API refuses and names a time.
    """

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return _PagedReader(transport, schema, pages_per_partition, attempts, calls_per_hour, patience)

    spark.dataSource.register(Source)
    return spark.read.format(name).load()
