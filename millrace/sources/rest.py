"""A REST catalogue as a Spark data source: one listing on the driver, details and reports from the tasks.

    spark.dataSource.register(RestCatalogue)
    spark.read.format("rest_catalogue").option("list", url).option("detail", url + "/{}").load()

gives (name, listed, detail), the last two as JSON texts.  With ``post`` set to
a JSON body, the names in ``names`` (comma-joined) are posted to ``detail``
instead, and ``listed`` is null.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

KEYS = ("result", "items", "types", "data")


def fetch(url: str, body: str | None = None, *, tries: int = 5, timeout: float = 30, pause: float = 1) -> tuple[int, str]:
    """Status and text of a GET, or of a POST of ``body``.

    Network errors and statuses from 500 on are tried again, after pauses that
    double; what stays out of reach fails the job.
    """
    for k in range(tries):
        data = None if body is None else body.encode()
        request = urllib.request.Request(url, data, {"Content-Type": "application/json"} if data else {})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return answer.status, answer.read().decode()
        except urllib.error.HTTPError as e:
            if e.code < 500:
                return e.code, e.read().decode()
            said = f"status {e.code}"
        except OSError as e:
            said = str(e)
        if k < tries - 1:
            time.sleep(pause * 2**k)
    raise RuntimeError(f"{url}: {said}, {tries} times")


def items(answer: object) -> list:
    """The list of an answer: itself, the first of KEYS that is a list, any list, or the keys."""
    if isinstance(answer, list):
        return answer
    if not isinstance(answer, dict):
        raise RuntimeError("neither a list nor an object")
    lists = [answer[k] for k in KEYS if isinstance(answer.get(k), list)] or [v for v in answer.values() if isinstance(v, list)]
    return lists[0] if lists else list(answer)


@dataclass
class Names(InputPartition):
    names: list[tuple[str, str | None]]


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.o = options
        self.how = {"tries": int(options.get("tries", 5)), "timeout": float(options.get("timeout", 30)), "pause": float(options.get("pause", 1))}

    def partitions(self) -> list[Names]:
        if "names" in self.o:
            named = [(n, None) for n in self.o["names"].split(",")]
        else:
            status, text = fetch(self.o["list"], **self.how)
            if status != 200:
                raise RuntimeError(f"{self.o['list']}: status {status}")
            last = {}  # of equal names the last counts
            for x in items(json.loads(text)):
                name = x if isinstance(x, str) else (x.get("technicalName") or x.get("name")) if isinstance(x, dict) else None
                if name:
                    last[name] = json.dumps(x, ensure_ascii=False)
            named = list(last.items())
        size = int(self.o.get("batch", 20))
        return [Names(named[i : i + size]) for i in range(0, len(named), size)] or [Names([])]

    def read(self, partition: Names) -> Iterator[tuple[str, str | None, str]]:
        for name, listed in partition.names:
            status, text = fetch(self.o["detail"].replace("{}", urllib.parse.quote(name, safe="")), self.o.get("post"), **self.how)
            if status == 200:  # what the service doesn't give is left out
                yield name, listed, text


class RestCatalogue(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rest_catalogue"

    def schema(self) -> str:
        return "name string, listed string, detail string"

    def reader(self, schema) -> Reader:
        return Reader(self.options)
