"""Listings and searches against a server on this machine that misbehaves on request."""

import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest

from corpusloom.operators.contracts import ContractError
from corpusloom.sources import web

QUICK = {"wait": 0.01, "longest": 0.02, "spacing": 0}
MANNERS = web.Manners(tries=3, wait=0.01, longest=0.02, spacing=0)


class Fake(BaseHTTPRequestHandler):
    rows = [{"id": f"p{k}", "title": f"Tytuł {k}", "tags": ["a", k]} for k in range(23)]
    mode, seen, lock = "", Counter(), threading.Lock()

    def log_message(self, *args):
        pass

    def answer(self, status, value, headers=()):
        body = json.dumps(value).encode()
        self.send_response(status)
        for name, text in headers:
            self.send_header(name, text)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def do_GET(self):
        query = parse_qs(urlsplit(self.path).query)
        page, size = int(query["page"][0]), int(query["size"][0])
        with self.lock:
            self.seen[page] += 1
            n = self.seen[page]
        if self.mode == "busy" and n <= 2:
            return self.answer((429, 503)[n - 1], {}, [("Retry-After", "0")] if n == 1 else [])
        if self.mode == "gone" and page == 2:
            return self.answer(404, {})
        if self.mode == "down" and page == 2:
            return self.answer(500, {})
        items = self.rows[(page - 1) * size : page * size]
        if self.mode == "short" and page == 2:
            items = items[:-1]
        if self.mode == "twice" and page == 3:
            items = [{**self.rows[0], "title": "again"}, *items[1:]]
        self.answer(200, {"total": len(self.rows), "items": items})

    def do_POST(self):
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["ids"]
        with self.lock:
            self.seen[len(asked)] += 1
        items = [{"id": x.upper(), "text": f"text of {x}"} for x in asked]
        if self.mode == "missing":
            items = [x for x in items if x["id"] != "N7"]
        if self.mode == "strange":
            items.append({"id": "other"})
        if self.mode == "double":
            items.append(items[0])
        self.answer(200, {"items": items})


@pytest.fixture
def server():
    made = ThreadingHTTPServer(("127.0.0.1", 0), Fake)
    Fake.mode, Fake.seen = "", Counter()
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}/list?kind=x"
    made.shutdown()


def listing(spark, url, **options):
    return web.paged_listing(spark, url, "id string, title string, tags string", size=5, **QUICK, **options)


def test_pages_are_partitions(spark, server):
    rows = listing(spark, server).collect()
    assert sorted((r["id"], r["title"], r["tags"]) for r in rows) == sorted((x["id"], x["title"], json.dumps(x["tags"])) for x in Fake.rows)
    assert set(Fake.seen) == {1, 2, 3, 4, 5}
    spark.dataSource.register(web.PagedListing)
    raw = spark.read.format("paged_listing").schema("page int, id string").option("url", server).option("size", 5).option("spacing", 0).load()
    assert raw.rdd.getNumPartitions() == 5
    assert listing(spark, server, pages=2).count() == 10


def test_busy_answers_are_waited_for(spark, server):
    Fake.mode = "busy"
    assert listing(spark, server).count() == 23 and min(Fake.seen.values()) >= 3


@pytest.mark.parametrize("mode, error", [("short", "page 2 has 4 rows; 5 were announced"), ("gone", "404"), ("down", "500")])
def test_what_fails_a_listing(spark, server, mode, error):
    Fake.mode = mode
    with pytest.raises(Exception, match=error):
        listing(spark, server, tries=2).collect()
    assert mode != "gone" or Fake.seen[2] <= 8  # no retries but those of Spark's tasks


def test_an_item_on_two_pages_counts_once(spark, server):
    Fake.mode = "twice"
    rows = {r["id"]: r["title"] for r in listing(spark, server).collect()}
    assert len(rows) == 22 and rows["p0"] == "Tytuł 0" and "p10" not in rows


def ids(spark, n=250):
    return spark.createDataFrame([(f"n{k}",) for k in range(n)] + [("n3",), (None,)], "id string").repartition(1)


def found(spark, url, table):
    return web.search(table, url, "id", lambda x: {"ids": x}, manners=MANNERS, normal=str.lower)


def test_searches_take_a_hundred_ids(spark, server):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        rows = web.complete(ids(spark), found(spark, server, ids(spark)).cache(), "id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r["id"]: json.loads(r["found"])["text"] for r in rows} == {f"n{k}": f"text of n{k}" for k in range(250)}
    assert Fake.seen == Counter({100: 2, 50: 1})


def test_incomplete_and_wrong_answers(spark, server):
    Fake.mode = "missing"
    with pytest.raises(ContractError, match="1 ids weren't delivered, among them n7"):
        web.complete(ids(spark, 20), found(spark, server, ids(spark, 20)), "id")
    for Fake.mode in ("strange", "double"):
        with pytest.raises(Exception, match="unexpected or repeated item"):
            found(spark, server, ids(spark, 20)).collect()
