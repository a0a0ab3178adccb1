"""Quality rules as a short-circuit cascade.

Rules look at a text alone.  On a sample each rule's time and share of
rejections are measured; the cascade then runs the rules by rejections per
second, and a text leaves it at the first rule that rejects it.  The order
changes what is computed, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WordHashes, covered, mixed, rolling

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Share of documents that the order of rules is taken from, and how many at most.
SAMPLE_SHARE, SAMPLE_ROWS = 0.01, 2_000


class Text:
    """A text and what the rules ask of it, computed when first asked for."""

    def __init__(self, text: str | None, hashes: WordHashes):
        self.text, self.hashes = text or "", hashes

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.raw.count(c) for c in SYMBOLS)

    @cached_property
    def filled_lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x and not x.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.filled_lines) - len(set(self.filled_lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in three-word windows that are in the text twice or more."""
        if self.n_words < 4:
            return 0
        grams = mixed(rolling(self.hashes.of(self.words), 3, 0x9E3779B97F4A7C15))
        _, at, counts = np.unique(grams, return_inverse=True, return_counts=True)
        return int(covered(np.flatnonzero(counts[at] > 1), 3, self.n_words).sum())

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


def few_words(t: Text) -> bool:
    return t.n_words < 50


def repeated_words(t: Text) -> bool:
    return 100 * t.n_repeat_words > 50 * t.n_words


def symbols(t: Text) -> bool:
    """More than one symbol to ten words."""
    return 10 * t.n_symbols > t.n_words


def word_length(t: Text) -> bool:
    """Words of under 2 or over 12 characters on average."""
    return not 2 * t.n_words <= t.word_chars <= 12 * t.n_words


def repeated_lines(t: Text) -> bool:
    """More than half of the lines, of five at least, are repeats."""
    return len(t.filled_lines) >= 5 and 2 * t.n_dup_lines > len(t.filled_lines)


def capitals(t: Text) -> bool:
    """More than half of the words that have ASCII letters have capitals alone."""
    with_letters = [w for w in t.words if w.lower() != w.upper()]
    return 2 * sum(w.isupper() for w in with_letters) > len(with_letters) > 0


def bangs(t: Text) -> bool:
    """More than three exclamation marks to ten words."""
    return 10 * t.raw.count(b"!") > 3 * t.n_words


RULES: tuple[Callable[[Text], bool], ...] = (
    few_words, repeated_words, symbols, word_length, repeated_lines, capitals, bangs,
)


def _sampled(rules):
    """For each text: which rules reject it, as bits, and the seconds of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            rejected, seconds = [], []
            for text in b.column(0).to_pylist():
                t, spent, bits = Text(text, hashes), [], 0
                len(t.words)  # any rule needs the words, so that none is charged for them
                for i, rule in enumerate(rules):
                    began = time.perf_counter()
                    bits |= bool(rule(t)) << i
                    spent.append(time.perf_counter() - began)
                rejected.append(bits)
                seconds.append(spent)
            yield pa.RecordBatch.from_arrays([pa.array(rejected, pa.int64()), pa.array(seconds, pa.list_(pa.float64()))], names=["rejected", "seconds"])

    return run


def by_rate(seconds: list[float], rejected: dict[int, int]) -> list[int]:
    """The order of rules: each time the one that rejects most per second of the texts that those before leave.

    ``rejected`` has the number of texts for each set of rules, as bits, that reject them.
    """
    order: list[int] = []
    while len(order) < len(seconds):
        left = {bits: n for bits, n in rejected.items() if not any(bits >> i & 1 for i in order)}
        rate = {i: sum(n for bits, n in left.items() if bits >> i & 1) / max(s, 1e-9) for i, s in enumerate(seconds) if i not in order}
        order.append(max(rate, key=lambda i: (rate[i], -i)))
    return order


def cascade_order(documents: DataFrame, rules=RULES, *, text_col: str = "text", share: float = SAMPLE_SHARE, rows: int = SAMPLE_ROWS) -> list[int]:
    """The rules' numbers by rejections per second on a sample, the best first.

    What a rule rejects is counted among the texts that the rules before it
    leave.  One that rejects none of them, or an empty sample, leaves the rules
    as they are listed, after the others.
    """
    sample = documents.select(F.col(text_col).alias("text")).sample(share, 1).limit(rows)
    found = (
        sample.mapInArrow(_sampled(rules), "rejected bigint, seconds array<double>")
        .groupBy("rejected")
        .agg(F.count("*").alias("n"), *[F.sum(F.col("seconds")[i]).alias(f"s{i}") for i in range(len(rules))])
        .collect()  # a row for each set of rules, of ``rows`` texts at most
    )
    return by_rate([sum(r[f"s{i}"] for r in found) for i in range(len(rules))], {r["rejected"]: r["n"] for r in found})


def judge(
    documents: DataFrame, *, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
    share: float = SAMPLE_SHARE, rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    ``kept`` is false where any rule rejects the text.  A null or empty text
    has no words and is rejected as too short.  Repeated rows are judged each;
    ids of any type, null ones too, and other columns don't matter.  An empty
    table gives no rows.
    """
    cascade = [rules[i] for i in cascade_order(documents, rules, text_col=text_col, share=share, rows=rows)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            out = []
            for text in b.column(1):
                t = Text(text.as_py(), hashes)
                kept = not (t.base_failed or any(rule(t) for rule in cascade))
                out.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, t.base_failed, kept))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            cols = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=NAMES)

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{n} {'boolean' if n in NAMES[-2:] else 'bigint'}" for n in NAMES[1:])
    )


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def keep_good(documents: DataFrame, *, rules=RULES, text_col: str = "text", share: float = SAMPLE_SHARE, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents, all columns kept, that no rule rejects; each is looked at by the cascade alone.

    Null and empty texts have no words and are rejected by the rules on words.  Repeated rows share their fate, once each;
    null ids, very long texts and other columns, of any name, don't matter.  An empty table gives no rows.
    """
    cascade = [rules[i] for i in cascade_order(documents, rules, text_col=text_col, share=share, rows=rows)]
    at = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            good = []
            for text in b.column(at):
                t = Text(text.as_py(), hashes)
                good.append(not any(rule(t) for rule in cascade))
            yield b.filter(pa.array(good, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
p AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
q AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, gram) AS n FROM p) WHERE n > 1),
g AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS x FROM q) GROUP BY r),
f AS (
  SELECT doc_id, t, w, lines, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    length(t) - length(replace(t, '!', '')) AS n_bangs,
    len(list_filter(w, lambda x: regexp_matches(x, '[a-zA-Z]'))) AS n_letters,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_capitals
  FROM d LEFT JOIN g USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR (len(lines) >= 5 AND 2 * n_dup_lines > len(lines)) OR (2 * n_capitals > n_letters AND n_letters > 0)
    OR 10 * n_bangs > 3 * n_words) AS kept
FROM b
"""
