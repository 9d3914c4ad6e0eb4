"""Listings and searches over HTTP: pages as partitions, polite requests, and checks that nothing is missing."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlencode

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from corpusloom.operators.contracts import ContractError

# Answers after which a request is tried again, and ids of one search.
AGAIN = (429, 500, 502, 503, 504)
BATCH = 100
_next = 0.0


@dataclass(frozen=True)
class Manners:
    """How requests are spaced and repeated.

    ``spacing`` seconds lie between two requests of one Python worker. An executor has a worker for
    each of its cores, so a limit for all is ``spacing`` = cores of all executors / requests a second.
    The wait after a failure doubles from ``wait`` on, up to ``longest``; a Retry-After in seconds is kept.
    """

    tries: int = 5
    wait: float = 1.0
    longest: float = 16.0
    spacing: float = 0.5
    timeout: float = 90.0


def ask(url: str, body: bytes | None = None, manners: Manners = Manners(), headers: dict[str, str] | None = None) -> bytes:
    """The content of a GET, or of a POST of ``body``; other errors than AGAIN are raised at once, these after the last try."""
    global _next
    for k in range(manners.tries):
        time.sleep(max(0.0, _next - time.monotonic()))
        _next = time.monotonic() + manners.spacing
        try:
            with urllib.request.urlopen(urllib.request.Request(url, body, headers or {}), timeout=manners.timeout) as answer:
                return answer.read()
        except urllib.error.HTTPError as error:
            if error.code not in AGAIN or k + 1 == manners.tries:
                raise
            asked = error.headers.get("Retry-After", "")
            pause = float(asked) if asked.isdigit() else manners.wait * 2**k
        except (urllib.error.URLError, TimeoutError, ConnectionError):
            if k + 1 == manners.tries:
                raise
            pause = manners.wait * 2**k
        time.sleep(min(manners.longest, pause))
    raise ValueError("tries must be at least 1")


@dataclass
class Page(InputPartition):
    number: int
    rows: int


class Listing(DataSourceReader):
    """Pages 1, 2 ... of a listing, each a partition. The first answer tells how many rows there are."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema = schema
        self.url, self.size = options["url"], int(options.get("size", "100"))
        self.items, self.total = options.get("items", "items"), options.get("total", "total")
        self.most = int(options.get("pages", "0"))
        self.manners = Manners(**{k: type(getattr(Manners(), k))(float(options[k])) for k in ("tries", "wait", "longest", "spacing", "timeout") if k in options})

    def page(self, number: int) -> dict:
        joint = "&" if "?" in self.url else "?"
        return json.loads(ask(f"{self.url}{joint}{urlencode({'page': number, 'size': self.size})}", manners=self.manners))

    def partitions(self) -> list[InputPartition]:
        rows = int(self.page(1)[self.total])
        pages = max(1, -(-rows // self.size))
        wanted = min(pages, self.most) if self.most else pages
        return [Page(k, min(self.size, rows - (k - 1) * self.size)) for k in range(1, wanted + 1)]

    def read(self, partition: Page) -> Iterator[tuple]:
        items = self.page(partition.number)[self.items]
        if len(items) != partition.rows:
            raise ValueError(f"page {partition.number} has {len(items)} rows; {partition.rows} were announced")
        for item in items:
            yield tuple(partition.number if f.name == "page" else _value(item.get(f.name), f.dataType.simpleString()) for f in self.schema)


def _value(value, kind: str):
    if value is None or kind != "string" or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, sort_keys=True)  # nested values as JSON


class PagedListing(DataSource):
    """``spark.read.format("paged_listing").schema(...).option("url", ...)``: the items of all pages.

    Options: url, size (rows a page), items and total (fields of an answer), pages (most pages, 0:
    all), and those of ``Manners``. A column ``page`` gets the page's number, other columns are
    fields of the items; a string column takes nested values as JSON. A page with fewer or more
    rows than the total leaves for it fails the job.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return "page int, id string"

    def reader(self, schema: StructType) -> Listing:
        return Listing(schema, dict(self.options))


def paged_listing(spark: SparkSession, url: str, schema: str, key: str = "id", **options: object) -> DataFrame:
    """The items of a listing, each key once: of several the one on the earliest page stays. Items without key stay."""
    spark.dataSource.register(PagedListing)
    rows = spark.read.format("paged_listing").schema(f"page int, {schema}").option("url", url).options(**{k: str(v) for k, v in options.items()}).load()
    columns = [c for c in rows.columns if c != "page"]
    whole = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*columns), F.struct("page", F.xxhash64(*columns))).alias("x")).select("x.*")
    return whole.select(*columns).unionAll(rows.where(F.col(key).isNull()).select(*columns))


def search(ids: DataFrame, url: str, key: str, question: Callable[[list[str]], dict], items: str = "items", batch: int = BATCH, manners: Manners = Manners(), normal: Callable[[str], str] = str) -> DataFrame:
    """key, found (JSON of its item) for each distinct id of ``ids``, searched ``batch`` ids at a time.

    ``question`` maps ids to the body of a POST; ``normal`` maps an id as asked for or delivered to the form in
    which they are compared. An item that wasn't asked for or comes twice fails the job; ids that
    weren't delivered are found by ``complete``. Batches fill up within partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for rows in batches:
            held += rows.column(key).to_pylist()
            while len(held) >= batch:
                yield answers(held[:batch])
                held = held[batch:]
        if held:
            yield answers(held)

    def answers(asked: list[str]) -> pa.RecordBatch:
        wanted = {normal(x): x for x in asked}
        out: dict[str, str] = {}
        for item in json.loads(ask(url, json.dumps(question(asked)).encode(), manners, {"Content-Type": "application/json"}))[items]:
            own = wanted.get(normal(item[key]))
            if own is None or own in out:
                raise ValueError(f"unexpected or repeated item: {item[key]}")
            out[own] = json.dumps(item, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        return pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.string())], [key, "found"])

    wanted = ids.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()
    return wanted.mapInArrow(run, f"`{key}` string, found string")


def complete(ids: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``found``, if it has every id of ``ids``; a ContractError names some that are missing. ``found`` should be written before."""
    missing = ids.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct().join(found.select(key), key, "left_anti")
    if not missing.isEmpty():
        few = ", ".join(r[0] for r in missing.orderBy(key).limit(3).collect())
        raise ContractError(f"{missing.count()} ids weren't delivered, among them {few}")
    return found
