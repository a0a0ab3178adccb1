"""The elements of one large JSON array, read by many tasks.

A catalogue's document is one JSON text whose bulk is a single array.  Spark's
text source cuts the file at closing braces, so tasks read byte ranges of it, on
any file system that Spark reads.  A range doesn't know where in the document it
begins; so in a first pass each range says what it does to the place, once for
the case that it begins within a string and once for the other: how many
brackets it closes that were open before, which it leaves open, and the keys
where it ends.  The ranges of a file are then followed from its start (some 100
bytes for each range), and the second pass cuts each range into elements.  What
crosses the border of two ranges is joined afterwards.

The text around the array, the outline, is small and comes along with every
element.  A document that ends within a string or bracket fails the job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.shared import written

#: Ranges whose starts are sent to all tasks (200 bytes each); more are joined, and put in order again.
SENT = 100_000
#: A key that began before its range.
_UNKNOWN = "\0"

Level = tuple[str, str | None]


# --- inside Arrow-batched functions -----------------------------------------


def _quotes(data: np.ndarray) -> np.ndarray:
    """Places of quotes that no backslash escapes."""
    slashes = np.flatnonzero(data == ord("\\"))
    quotes = data == ord('"')
    if len(slashes):
        ends = np.flatnonzero(np.diff(slashes, append=slashes[-1] + 2) != 1)
        lengths = np.diff(ends, prepend=-1)
        after = slashes[ends] + 1
        after = after[(lengths % 2 == 1) & (after < len(data))]
        quotes[after] = False
    return np.flatnonzero(quotes)


@dataclass
class _Text:
    """A stretch of JSON text and what is known of its places."""

    raw: bytes
    within: bool
    data: np.ndarray = field(init=False)
    quotes: np.ndarray = field(init=False)
    outside: np.ndarray = field(init=False)
    step: np.ndarray = field(init=False)
    depth: np.ndarray = field(init=False)
    ends_within: bool = field(init=False)

    def __post_init__(self) -> None:
        self.data = np.frombuffer(self.raw, np.uint8)
        self.quotes = _quotes(self.data)
        turns = np.zeros(len(self.data), np.int8)
        turns[self.quotes] = 1
        odd = np.bitwise_xor.accumulate(turns) if len(turns) else turns
        self.outside = (odd == self.within) & (turns == 0)
        opens = self.outside & ((self.data == ord("{")) | (self.data == ord("[")))
        closes = self.outside & ((self.data == ord("}")) | (self.data == ord("]")))
        self.step = opens.astype(np.int8) - closes.astype(np.int8)
        self.depth = np.cumsum(self.step, dtype=np.int64)
        self.ends_within = bool(self.within ^ (len(self.quotes) % 2))

    def key(self, colon: int) -> str:
        """The key before a colon."""
        k = int(np.searchsorted(self.quotes, colon))
        if k < 2:
            return _UNKNOWN
        try:
            return json.loads(self.raw[self.quotes[k - 2] : self.quotes[k - 1] + 1])
        except ValueError:  # where the place was taken for within a string and isn't, or the other way
            return _UNKNOWN

    def effect(self) -> tuple[int, str | None, list[Level]]:
        """How many levels end, the last key of the level that is left then, and the levels that are opened and stay."""
        if not len(self.data):
            return 0, None, []
        low, colons = min(0, int(self.depth.min())), self.outside & (self.data == ord(":"))

        def last_key(level: int, since: int) -> str | None:
            found = np.flatnonzero(colons[since:] & (self.depth[since:] == level))
            return self.key(since + int(found[-1])) if len(found) else None

        levels = []
        for level in range(low + 1, int(self.depth[-1]) + 1):
            at = int(np.flatnonzero((self.depth == level) & (self.step == 1))[-1])
            levels.append((chr(self.data[at]), last_key(level, at)))
        return -low, last_key(low, 0), levels


def _applied(levels: list[Level], effect: tuple[int, str | None, list[Level]]) -> list[Level]:
    ended, key, opened = effect
    if ended > len(levels):
        raise ValueError("brackets are closed that weren't open")
    left = list(levels[: len(levels) - ended])
    if key is not None and left:
        left[-1] = (left[-1][0], key)
    return left + list(opened)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch | None, bytes]]:
    """(file, block, batch, text): the text of the next rows of a range; None and no text where the range ends."""
    here, seen = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
        codes = files.indices.to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            at = (files.dictionary[codes[a]].as_py(), int(blocks[a]))
            if at != here:
                if here is not None:
                    yield *here, None, b""
                here, seen = at, at[1] > 0  # what precedes a later range ends with a brace
            part = batch.slice(a, b - a)
            values = part.column("value").cast(pa.binary()).to_pylist()
            yield *at, part, (b"}" if seen else b"") + b"}".join(values)
            seen = True
    if here is not None:
        yield *here, None, b""


_EFFECT = "within boolean, ended int, key string, opened string"
_SUMMARY = f"file string, block long, size long, pieces long, bytes long, outside struct<{_EFFECT.replace(' ', ': ').replace(',:', ',')}>, inside struct<{_EFFECT.replace(' ', ': ').replace(',:', ',')}>"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each range does to the place in the document."""

    def joined(one: tuple | None, text: bytes, begins: bool) -> tuple:
        # one: within, ended, key, opened so far
        within, ended, key, opened = one or (begins, 0, None, [])
        t = _Text(text, within)
        more, last, new = t.effect()
        if more > len(opened) or (more == len(opened) and opened == []):
            ended, key, opened = ended + more - len(opened), (last if more > len(opened) or last is not None else key), new
        elif more == len(opened):
            key, opened = (last if last is not None else key), new
        else:
            opened = _applied(opened, (more, last, new))
        return t.ends_within, ended, key, opened

    state: list = [None, None]
    pieces = size = count = 0
    for file, block, batch, text in _ranges(batches):
        if batch is not None:
            state = [joined(s, text, bool(k)) for k, s in enumerate(state)]
            pieces, count = pieces + batch.num_rows, count + sum(map(len, batch.column("value").cast(pa.binary()).to_pylist()))
            size = batch.column("size")[0].as_py()
            continue
        sides = [{"within": w, "ended": e, "key": k, "opened": json.dumps(o)} for w, e, k, o in state]
        row = {"file": file, "block": block, "size": size, "pieces": pieces, "bytes": count, "outside": sides[0], "inside": sides[1]}
        yield pa.RecordBatch.from_pylist([row], pa.schema([
            ("file", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("pieces", pa.int64()), ("bytes", pa.int64()),
            *[(n, pa.struct([("within", pa.bool_()), ("ended", pa.int32()), ("key", pa.string()), ("opened", pa.string())])) for n in ("outside", "inside")],
        ]))
        state, pieces, size, count = [None, None], 0, 0, 0


def _followed(ranges: pd.DataFrame) -> pd.DataFrame:
    """Where each range of a document's files begins: its number, within a string or not, and in which brackets; the last one of
    a file whether a brace ends it.  Files follow each other by name."""
    document, within, levels, out = ranges.file.min(), False, [], []
    for _, own in ranges.sort_values(["file", "block"]).groupby("file", sort=True):
        rest = int(own["size"].iloc[0]) - int(own["bytes"].sum())
        braces = rest - 3 if rest > own.pieces.sum() + 1 else rest  # a byte-order mark isn't among the pieces
        closed = bool(braces == own.pieces.sum())
        try:
            for r in own.itertuples():
                out.append((r.file, r.block, document, len(out), within, json.dumps(levels), False))
                side = r.inside if within else r.outside
                levels = _applied(levels, (side["ended"], side["key"], [tuple(x) for x in json.loads(side["opened"])]))
                within = side["within"]
            last = levels
            if closed:
                levels = _applied(levels, _Text(b"}", within).effect())
                out[-1] = (*out[-1][:-1], True)
        except ValueError as e:
            raise ValueError(f"not a JSON document: {document}") from e
    if within or levels or (closed and last[0][0] != "{"):
        raise ValueError(f"not a JSON document, it ends too early: {document}")
    return pd.DataFrame(out, columns=["file", "block", "document", "at", "within", "levels", "closed"])


class _Cutter:
    """Cuts the text of one range into elements of the array at one of ``paths``, and the text around it."""

    def __init__(self, block: int, within: bool, levels: list[Level], paths: list[tuple[str, ...]]):
        self.block, self.within, self.depth, self.paths = block, within, len(levels), paths
        self.most = max(map(len, paths)) + 1
        self.top = [list(x) for x in levels[: self.most]]
        self.level = self._target()
        self.crossing = self.level is not None  # what comes first belongs to an element begun before
        self.part: list[bytes] = []
        self.around: list[bytes] = []
        self.number = 0
        self.rows: list[tuple[str, int, int, bool, bytes]] = []  # kind, order, number, closes, text

    def _target(self) -> int | None:
        for path in self.paths:
            n = len(path)
            if len(self.top) > n and self.top[n][0] == "[" and all(self.top[i] == ["{", path[i]] for i in range(n)):
                return n + 1
        return None

    def _end(self) -> None:
        text = b"".join(self.part)
        self.rows.append(("crossing" if self.crossing else "element", len(self.rows), self.number, True, text))
        self.number += bool(text.strip()) or self.crossing
        self.part, self.crossing = [], False

    def feed(self, raw: bytes) -> None:
        t = _Text(raw, self.within)
        depth = self.depth + t.depth
        lower = np.minimum(depth, depth - t.step)
        event = ((t.step != 0) & (lower < self.most)) | (t.outside & (t.data == ord(":")) & (depth < self.most))
        commas = np.flatnonzero(t.outside & (t.data == ord(",")) & (depth <= self.most))
        start = 0
        for i in np.flatnonzero(event).tolist():
            at, step = int(depth[i]), int(t.step[i])
            if step == 0:
                if at:
                    self.top[at - 1][1] = t.key(i)
                continue
            if self.level is not None and step < 0 and at < self.level:  # the array ends
                self._cut(t, depth, commas, start, i)
                self._end()
                self.level, start = None, i
            self.top = self.top[:at] if step < 0 else [*self.top[: at - 1], [chr(t.data[i]), None]]
            if self.level is None and step > 0 and (level := self._target()) == at:
                self.around.append(raw[start : i + 1])
                self.level, self.crossing, start = level, False, i + 1
        if self.level is None:
            self.around.append(raw[start:])
        else:
            self._cut(t, depth, commas, start, len(raw))
        self.within, self.depth = t.ends_within, int(depth[-1]) if len(depth) else self.depth

    def _cut(self, t: _Text, depth: np.ndarray, commas: np.ndarray, start: int, end: int) -> None:
        here = commas[np.searchsorted(commas, start) : np.searchsorted(commas, end)]
        for c in here[depth[here] == self.level].tolist():
            self.part.append(t.raw[start:c])
            self._end()
            start = c + 1
        self.part.append(t.raw[start:end])

    def finish(self) -> list[tuple[str, int, int, bool, bytes]]:
        if self.level is not None:
            self.rows.append(("crossing", len(self.rows), self.number, False, b"".join(self.part)))
        return [*self.rows, ("around", len(self.rows), 0, False, b"".join(self.around))]


def _cutting(paths: list[tuple[str, ...]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["file", "block", "kind", "place", "number", "closes", "text", "stretch"]

    def out(file: str, block: int, rows: list) -> pa.RecordBatch:
        # Spark may parse a text before it looks at the kind: what is no whole element is in a column of its own.
        kind, place, number, closes, text = zip(*rows)
        whole = [x if k == "element" and x.strip() else None for k, x in zip(kind, text)]
        rest = [x if k != "element" else None for k, x in zip(kind, text)]
        return pa.record_batch([
            pa.array([file] * len(rows)), pa.array([block] * len(rows), pa.int64()), pa.array(kind), pa.array(place, pa.int64()),
            pa.array(number, pa.int64()), pa.array(closes), *[pa.array(x, pa.binary()).cast(pa.string()) for x in (whole, rest)],
        ], names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = closed = place = None
        for _, block, batch, text in _ranges(batches):
            if batch is not None:
                if cutter is None:
                    first = batch.slice(0, 1).to_pylist()[0]
                    cutter, closed = _Cutter(block, first["within"], json.loads(first["levels"]), paths), first["closed"]
                    place = first["document"], first["at"]
                cutter.feed(text)
                done = [r for r in cutter.rows if r[0] == "element"]
                if len(done) > 1000:
                    yield out(*place, done)
                    # what crosses stays; places only order those
                    cutter.rows = [r for r in cutter.rows if r[0] != "element"]
            else:
                if closed:
                    cutter.feed(b"}")
                yield out(*place, cutter.finish())
                cutter = None

    return cut


# --- the reader --------------------------------------------------------------


def read_elements(spark: SparkSession, path: str, paths: list[tuple[str, ...]], pattern: str = "*.json", numbered: bool = False, folders: bool = False) -> tuple[DataFrame, DataFrame]:
    """The elements (file, text, with ``numbered`` their number from 0 too) of the array that each file of the pattern holds at one
    of ``paths``, keys from the root, and the outlines (file, outline): the document with that array empty.  With ``folders`` the files in a folder
    stem=<name> make up one document, one after the other by name, as ``write_document`` writes them; ``file`` is the first."""
    read = spark.read.option("lineSep", "}").option("pathGlobFilter", pattern).text(path)
    meta = lambda name: F.col(f"_metadata.{name}")
    pieces = read.select("value", meta("file_path").alias("file"), meta("file_block_start").alias("block"), meta("file_size").alias("size"))
    together = F.col("file").rlike("/stem=[^/]+/[^/]+$") & F.lit(folders)
    document = F.when(together, F.regexp_replace("file", "/[^/]+$", "")).otherwise(F.col("file")).alias("of")
    starts = pieces.mapInArrow(_summed, _SUMMARY).groupBy(document).applyInPandas(
        _followed, "file string, block long, document string, at long, within boolean, levels string, closed boolean")
    starts = written(starts, "ranges")
    if starts.count() <= SENT:
        placed = pieces.join(F.broadcast(starts), ["file", "block"])
    else:
        order = pieces.withColumn("order", F.monotonically_increasing_id()).join(starts, ["file", "block"])
        placed = order.repartition("file", "block").sortWithinPartitions("file", "block", "order")
    cut = written(placed.select("value", "file", "block", "document", "at", "within", "levels", "closed").mapInArrow(
        _cutting(paths), "file string, block long, kind string, place long, number long, closes boolean, text string, stretch string"), "elements")
    in_order = Window.partitionBy("file").orderBy("block", "place")
    crossing = cut.filter("kind = 'crossing'").withColumn("piece", F.coalesce(F.sum(F.col("closes").cast("int")).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "place", "stretch"))), lambda x: x["stretch"]), "")
    end = F.max_by("block", F.struct("block", "place")).alias("block"), F.max_by("number", F.struct("block", "place")).alias("number")
    joined = crossing.groupBy("file", "piece").agg(text.alias("text"), *end)
    filled = F.when(F.btrim("text", F.lit(" \t\r\n")) != "", F.col("text")).alias("text")
    found = cut.select("file", "block", "number", "text").unionByName(joined.select("file", "block", "number", filled)).filter("text IS NOT NULL")
    outlines = cut.filter("kind = 'around'").groupBy("file").agg(F.btrim(text, F.lit(" \t\r\n\ufeff")).alias("outline"))
    if not numbered:
        return found.select("file", "text"), outlines
    ends = found.groupBy("file", "block").count().withColumn("before", F.coalesce(
        F.sum("count").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    first = found.groupBy("file", "block").agg(F.min("number").alias("first"))
    return found.join(ends, ["file", "block"]).join(first, ["file", "block"]).select("file", (F.col("before") + F.col("number") - F.col("first")).cast("int").alias("row"), "text"), outlines
