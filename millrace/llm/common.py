"""Helpers shared by the operators of this subpackage.

Rows are told apart by ``doc_id`` plus a hash of the text, so that null and
repeated ids are handled: rows that agree in both are copies of one document
and get the same result, once each.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.shared import written as written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Between words ``[^\x20\x09-\x0D]+``.
SPACE_SEPARATOR = r"[\x20\x09-\x0D]+"
#: Between words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text lower-cased afterwards.
ALNUM_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


# --- columns -----------------------------------------------------------------


def ascii_lower(word: Column) -> Column:
    """Lower-cases A-Z alone.  For words: ``translate`` takes long over long texts."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, UPPER.lower())
    )


def _words(text: Column, separator: str) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def space_words(text: Column) -> Column:
    """The words between white space; none for null."""
    return _words(text, SPACE_SEPARATOR)


def alnum_words(text: Column) -> Column:
    """The lower-cased words of letters, digits and non-ASCII characters; none for null."""
    return F.transform(_words(text, ALNUM_SEPARATOR), ascii_lower)


def gram_hashes(words: str, size: int) -> Column:
    """A 64-bit hash of each run of ``size`` consecutive words; none if there are fewer.

    Equal to ``xxhash64`` of the run as an array.  Words are got by place, as
    ``slice`` would copy the whole array for each run; for the same reason
    ``words`` must be a column of the frame, not an expression.
    """
    return F.when(
        F.size(words) >= size,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - F.lit(size)),
            lambda i: F.xxhash64(*[F.get(F.col(words), i + F.lit(k)) for k in range(size)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def place_of(lengths: list[int], p: Column, n: Column) -> tuple[Column, Column]:
    """Start (from 1) and length of the window at place ``p`` (from 1) of the concatenated lists of ``gram_hashes``."""
    start, length, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    for size in lengths:
        here = F.greatest(n - F.lit(size - 1), F.lit(0))
        inside = (p > before) & (p <= before + here)
        start = F.when(inside, p - before).otherwise(start)
        length = F.when(inside, F.lit(size)).otherwise(length)
        before = before + here
    return start, length


def same_words(words: str, start: Column, run: str, most: int) -> Column:
    """Whether the words from ``start`` (from 0) are those of ``run``, of ``most`` words at most."""
    same = F.lit(True)
    for k in range(most):
        same = same & ((F.size(run) <= k) | (F.get(F.col(words), start + F.lit(k)) == F.get(F.col(run), F.lit(k))))
    return same


def text_key(text: Column) -> Column:
    return F.xxhash64(text, F.length(text))


# --- rows --------------------------------------------------------------------

#: Copies of a row are dealt out in lots of so many.
LOT = 1000


def each_copy(rows: DataFrame, *key: str, lot_rows: int = LOT) -> DataFrame:
    """Each row so often as its column ``copies`` says, without that column.

    Lots of copies go to tasks by ``key`` and the lot's number, so the copies of a row that stands for a third of all
    don't come out of one task.
    """
    last = F.floor((F.col("copies") - 1) / F.lit(lot_rows)).cast("int")
    lots = rows.filter("copies > 0").withColumn("lot_of_copies", F.explode(F.sequence(F.lit(0), last)))
    dealt = lots.repartition(*key, "lot_of_copies")
    n = F.least(F.lit(lot_rows), F.col("copies") - F.col("lot_of_copies") * lot_rows).cast("int")
    return dealt.withColumn("nth_copy", F.explode(F.sequence(F.lit(1), n))).drop("nth_copy", "lot_of_copies", "copies")


# --- inside Arrow-batched functions -----------------------------------------


class WordHashes(dict):
    """64-bit hashes of words, kept while there is room; forgetting only costs time."""

    def __init__(self, room: int = 100_000):
        super().__init__()
        self.room = room

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.room:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """A polynomial hash of each run of ``size`` hashes, built by doubling."""
    if len(hashes) < size:
        return hashes[:0]
    done, power, total, step = 0, 1, None, hashes
    width, factor = 1, base
    while True:
        if size & width:
            if total is None:
                total, done = step, width
            else:
                n = len(hashes) - done - width + 1
                total = total[:n] * np.uint64(factor) + step[done : done + n]
                done += width
        if done == size:
            return total
        n = len(step) - width
        step = step[:n] * np.uint64(factor) + step[width : width + n]
        factor = factor * factor % (1 << 64)
        width *= 2


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (splitmix64's finaliser)."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def covered(starts: np.ndarray, size: int, length: int) -> np.ndarray:
    """Which of ``length`` places are within ``size`` places from one of ``starts``."""
    edge = np.zeros(length + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, length), -1)
    return np.cumsum(edge[:-1]) > 0
