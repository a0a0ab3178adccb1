"""Substring dedup by level-wise doubling.

Windows of a quarter of the wanted length are compared first.  Only where one
is repeated is the window of twice its length looked at, and only where that
is repeated the one of twice that, which is cut to the wanted length; the rest
of the corpus drops out early.

The first level needs no window at every word: each wanted window is
represented by the short window in it whose hash is smallest, its anchor.
Equal windows have equal anchors at the same place, so none is lost.  The
windows of one anchor cover a stretch of the text; equal stretches are counted
before the further levels, which then see each one once, with that count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WordHashes, covered, mixed, rolling, text_key, written
from millrace.shared import forget

BASE = 0x9E3779B97F4A7C15
KEY = ["doc_id", "text_key"]
#: Windows of a text whose anchors are found at once.
BLOCK = 1 << 16


def split(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+``, which are what ``bytes.split`` gives."""
    return text.encode().split() if text else []


def anchors(hashes: np.ndarray, window: int, short: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor of a text: its hash, its place, and the first and last window that it represents."""
    g = mixed(rolling(hashes, short, BASE))
    if len(hashes) < window:
        none = np.zeros(0, np.int64)
        return g[:0], none, none, none
    # In blocks, as the view of all of a long text would be copied.
    views = np.lib.stride_tricks.sliding_window_view(g, window - short + 1)
    least = np.concatenate([views[i : i + BLOCK].argmin(1) for i in range(0, len(views), BLOCK)])
    at = np.arange(len(least)) + least
    first = np.r_[0, np.flatnonzero(np.diff(at)) + 1]
    last = np.r_[first[1:], len(at)] - 1
    return g[at[first]], at[first], first, last


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], pa.DataType]]:
    """Some rows at a time, and the kind of their ids."""
    for b in batches:
        for i in range(0, b.num_rows, 500):
            yield [*zip(*(c.to_pylist() for c in b.slice(i, 500).columns), strict=True)], b.schema.field(0).type


def _first_level(window: int, short: int):
    """Each text's distinct anchors, with how often they are in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for rows, kind in _rows(batches):
            ids, keys, hs, times = [], [], [], []
            for doc, key, text in rows:
                g, n = np.unique(anchors(words.of(split(text)), window, short)[0], return_counts=True)
                ids += [doc] * len(g)
                keys.append(np.full(len(g), key, np.int64))
                hs.append(g.view(np.int64))
                times.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hs)), pa.array(np.concatenate(times), pa.int32()), pa.array(ids, kind),
                 pa.array(np.concatenate(keys))],
                names=["h", "times", *KEY],
            )

    return run


_FURTHER = [
    ("text_key", pa.int64()), ("whole", pa.int64()), ("firsts", pa.list_(pa.int32())), ("twice", pa.list_(pa.int64())), ("windows", pa.list_(pa.int64())),
]


def _further_levels(window: int, short: int):
    """For the anchors among ``hs``: the hash of all words that their windows cover together, where
    such a stretch starts in the text, and the hashes of the windows of twice the anchor's length
    around it and of the wanted windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for rows, kind in _rows(batches):
            schema = pa.schema([("doc_id", kind), *_FURTHER])
            out = {x: [] for x in schema.names}
            for doc, key, text, hs in rows:
                h = words.of(split(text))
                full = mixed(rolling(h, window, BASE))
                twice = mixed(rolling(h, 2 * short, BASE) + np.uint64(1)).view(np.int64)
                g, at, first, last = anchors(h, window, short)
                # The first and the last window cover all words between them.
                whole = mixed(full[first] * np.uint64(BASE) + full[last] + (last - first).astype(np.uint64)).view(np.int64)
                full = full.view(np.int64)
                starts: dict[int, list[int]] = {}
                for k in np.flatnonzero(np.isin(g.view(np.int64), hs)).tolist():
                    w = int(whole[k])
                    if w not in starts:
                        starts[w] = []
                        a = at[k]
                        out["doc_id"].append(doc)
                        out["text_key"].append(key)
                        out["whole"].append(w)
                        out["firsts"].append(starts[w])
                        out["twice"].append([twice[i] for i in (a - short, a) if 0 <= i < len(twice)])
                        out["windows"].append(full[first[k] : last[k] + 1])
                    starts[w].append(int(first[k]))
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def _repeated(hashes: DataFrame) -> DataFrame:
    """(rh): the values of the column h that are there two times at least."""
    n = hashes.groupBy("h").agg(F.sum("times").alias("n"))
    # Written, so that Spark can split the join of a hot hash with its rows.
    return written(n.filter("n > 1").select(F.col("h").alias("rh")), "repeated")


def _alive(stretches: DataFrame, column: str) -> DataFrame:
    """(whole, times, k, h): the hashes in ``column``, with their places in it, that occur two times at least."""
    rows = stretches.select("whole", "times", F.posexplode(column).alias("k", "h"))
    again = _repeated(rows.select("h", "times"))
    return rows.join(again, F.col("h") == F.col("rh"), "left_semi")


def repeated_spans(
    documents: DataFrame, *, window: int = 35, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_key, spans): of each document that has any, the repeated windows, as
    (firsts, ks): from each of ``firsts`` on, the windows at the distances ``ks``."""
    if window < 2:
        raise ValueError("window must be two words at least")
    short = -(-window // 4)
    base = documents.select(
        F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")
    )
    id_kind = base.schema["doc_id"].dataType.simpleString()
    # The first level: anchors.
    first = written(
        base.mapInArrow(_first_level(window, short), f"h bigint, times int, doc_id {id_kind}, text_key bigint"), "anchors"
    )
    again = _repeated(first)
    alive = first.join(again, F.col("h") == F.col("rh"), "left_semi")
    per_document = alive.groupBy(*KEY).agg(F.collect_set("h").alias("hs")).select(
        F.col("doc_id").alias("i"), F.col("text_key").alias("k"), "hs"
    )
    found = base.join(per_document, base["doc_id"].eqNullSafe(F.col("i")) & (base["text_key"] == F.col("k")))
    level = written(
        found.select(*KEY, "text", "hs").mapInArrow(
            _further_levels(window, short),
            f"doc_id {id_kind}, text_key bigint, whole bigint, firsts array<int>, twice array<bigint>, windows array<bigint>",
        ),
        "windows",
    )
    forget(first)
    forget(again)
    # Equal stretches are one row with how often they occur, so copies go through the levels as one.
    stretches = written(
        level.groupBy("whole").agg(F.sum(F.size("firsts")).alias("times"), F.first("twice").alias("twice")), "stretches"
    )
    # The second level: of the windows of twice the anchor's length, one lies in each wanted window.
    longer = written(_alive(stretches, "twice").select("whole", "times").distinct(), "longer")
    forget(stretches)
    # The last level: the wanted windows.
    wanted = written(
        level.groupBy("whole").agg(F.first("windows").alias("windows")).join(longer, "whole").select("whole", "times", "windows"),
        "wanted",
    )
    forget(longer)
    # Written, so that Spark can split the join of a hot stretch with its documents.
    judged = written(
        _alive(wanted, "windows").groupBy(F.col("whole").alias("w")).agg(F.collect_list("k").alias("ks")), "judged"
    )
    forget(wanted)
    return (
        level.select(*KEY, "whole", "firsts")
        .join(judged, F.col("whole") == F.col("w"))
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("firsts", "ks")).alias("spans"))
    )


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, kind in _rows(batches):
            total, removed, kept = [], [], []
            for _, text, spans in rows:
                words = split(text)
                total.append(len(words))
                if spans:
                    starts = np.concatenate([np.add.outer(s["firsts"], s["ks"]).ravel() for s in spans])
                    gone = covered(starts, window, len(words))
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], kind), pa.array(total, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def dedup_substrings(
    documents: DataFrame, *, window: int = 35, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (the words that stay, joined by a space).

    A word goes if it is in a window of ``window`` words whose sequence also
    starts anywhere else, in the same document or another; all occurrences go.

    Null and empty texts have no words.  Ids are of any type.  Texts shorter than the window stay.
    A window has two words at least; a smaller one is a ValueError.
    Repeated rows are documents of their own, and so repeat each other's
    windows.  Other columns are ignored.  An empty table gives no rows.  Word
    sequences are compared by 64-bit hashes at each level.
    """
    spans = repeated_spans(documents, window=window, id_col=id_col, text_col=text_col).select(
        F.col("doc_id").alias("i"), F.col("text_key").alias("k"), "spans"
    )
    base = documents.select(
        F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")
    )
    id_kind = base.schema["doc_id"].dataType.simpleString()
    return (
        base.join(spans, base["doc_id"].eqNullSafe(F.col("i")) & (base["text_key"] == F.col("k")), "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_cut(window), f"doc_id {id_kind}, n_words bigint, n_removed bigint, kept string")
    )


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS gram
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
g AS (SELECT gram FROM p GROUP BY gram HAVING count(*) > 1),
x AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM p JOIN g USING (gram)),
a AS (SELECT d.r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (
  SELECT a.r, count(x.i) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY a.i) FILTER (WHERE x.i IS NULL), '') AS kept
  FROM a LEFT JOIN x ON a.r = x.r AND a.i = x.i GROUP BY a.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
