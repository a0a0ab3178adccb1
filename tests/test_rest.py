"""The REST source against a server of our own."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from millrace.sources.rest import RestCatalogue, fetch, items


@pytest.fixture(scope="module")
def server():
    seen = {}

    class Handler(BaseHTTPRequestHandler):
        def answer(self, status, value):
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps(value).encode())

        def do_GET(self):
            seen[self.path] = seen.get(self.path, 0) + 1
            if self.path == "/types":
                self.answer(200, {"items": ["A", {"technicalName": "B b", "name": "x"}, {"name": "C"}, {}, 3, ""]})
            elif self.path == "/types/A":
                self.answer(503 if seen[self.path] < 3 else 200, {"technicalName": "A"})
            elif self.path == "/types/B%20b":
                self.answer(200, {"technicalName": "B b", "name": "č"})
            else:
                self.answer(500 if self.path == "/down" else 404, {})

        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"])).decode()
            self.answer(200, {"type": "TABLE", "asked": json.loads(body), "path": self.path})

        def log_message(self, *args):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_listing_and_details(spark, server):
    spark.dataSource.register(RestCatalogue)
    read = spark.read.format("rest_catalogue").option("list", f"{server}/types").option("detail", server + "/types/{}").option("pause", "0.01").option("batch", "2")
    got = {r.name: (json.loads(r.listed), json.loads(r.detail)) for r in read.load().collect()}
    assert got == {"A": ("A", {"technicalName": "A"}), "B b": ({"technicalName": "B b", "name": "x"}, {"technicalName": "B b", "name": "č"})}


def test_reports_are_posted(spark, server):
    spark.dataSource.register(RestCatalogue)
    read = spark.read.format("rest_catalogue").option("names", "1,2").option("detail", server + "/report/{}").option("post", '{"p": true}')
    assert sorted(json.loads(r.detail)["path"] for r in read.load().collect()) == ["/report/1", "/report/2"]


def test_what_stays_down_fails(server):
    with pytest.raises(RuntimeError, match="status 500, 2 times"):
        fetch(f"{server}/down", tries=2, pause=0.01)
    assert fetch(f"{server}/none")[0] == 404


def test_items():
    assert items({"x": 1, "y": [2]}) == [2] and items({"x": 1}) == ["x"] and items({"data": [1], "result": [2]}) == [2] and items({}) == []
    with pytest.raises(RuntimeError):
        items("no")
