"""Token counts with a whole-token shortcut.

Which strings of the vocabulary encode alone as one token is proven once, with
the tokenizer itself.  Pre-tokens among them count one; only the rest is
merged, and each distinct piece of text only once while it is remembered.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces remembered by a task; forgetting them only costs time.
ROOM = 300_000
#: Pieces of printable ASCII are cut into pre-tokens here; all others by the tokenizer.
PLAIN = re.compile(rb"[\x21-\x7e]+")
PRE_TOKEN = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
END_OF_WORD = "</w>"
#: The rule of a tokenizer for which PRE_TOKEN holds; all is left to the library for others.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STEPS = {"normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"]}


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def shortcut_holds(path: str) -> bool:
    """Whether the tokenizer cuts at white space and into PRE_TOKEN, as the shortcut assumes."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    steps = [
        x for kind, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")) for x in (rules.get(kind) or {}).get(inner, [])
    ]
    split = [x for x in steps if x["type"] == "Split"]
    return (
        [x["type"] for x in steps] == [x for kinds in STEPS.values() for x in kinds]
        and rules["model"].get("end_of_word_suffix") == END_OF_WORD
        and [(x["pattern"], x["behavior"], x["invert"]) for x in split] == [({"Regex": SPLIT}, "Removed", True)]
    )


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for
    themselves, the others, in order, as the code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def whole_tokens(path: str) -> frozenset[bytes]:
    """The vocabulary's strings that encode alone as that one token; none where the shortcut doesn't hold."""
    if not shortcut_holds(path):
        return frozenset()
    tokenizer, letters = load(path), byte_letters()
    texts = {}
    for piece, number in tokenizer.get_vocab().items():
        body = piece.removesuffix(END_OF_WORD)
        if piece.endswith(END_OF_WORD) and body and all(c in letters for c in body):
            try:
                texts[bytes(letters[c] for c in body).decode()] = number
            except UnicodeDecodeError:
                continue
    found = tokenizer.encode_batch(list(texts), add_special_tokens=False)
    return frozenset(t.encode() for (t, n), e in zip(texts.items(), found, strict=True) if e.ids == [n])


class Pieces(dict):
    """How many tokens each piece of text between white space has."""

    def __init__(self, path: str, whole: frozenset[bytes]):
        super().__init__()
        self.tokenizer, self.whole, self.cut = load(path), whole, shortcut_holds(path)

    def merged(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def learn(self, pieces: set[bytes]) -> None:
        if len(self) > ROOM:
            self.clear()
        new = [p for p in pieces if p not in self]
        rest: dict[bytes, list[bytes]] = {}
        for p in new:
            if p in self.whole:
                self[p] = 1
            elif PLAIN.fullmatch(p) and b"<|" not in p:
                parts = PRE_TOKEN.findall(p.lower())
                more = [x for x in parts if x not in self.whole]
                self[p] = len(parts) - len(more)
                if more:
                    rest[p] = more
            else:
                self[p], rest[p] = 0, [p]
        counts = iter(self.merged([x.decode() for more in rest.values() for x in more]))
        for p, more in rest.items():
            self[p] += sum(next(counts) for _ in more)

    def count(self, texts: list[str]) -> list[int]:
        if not self.cut:
            return self.merged(texts)
        split = [t.encode().split() for t in texts]
        self.learn(set().union(*split))
        return [sum(map(self.__getitem__, pieces)) for pieces in split]


def groups(texts: list[str], most: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in groups of about ``most`` characters."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size > most:
            yield group
            group, size = [], 0
    yield group


def count_tokens(
    documents: DataFrame, path: str, *, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the tokenizer at ``path``, without added special tokens.
    The shortcut is for a lower-casing byte-level BPE with word ends; whole texts
    are given to the library where the file has other rules.  ``path`` must be
    there on every machine.  A null text counts as an empty one: no bytes, no tokens.
    Repeated rows are counted each; ids of any type, null ones too, and other columns don't matter.
    """
    whole = documents.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path, whole.value)
        for b in batches:
            counts = [n for g in groups([t or "" for t in b.column(1).to_pylist()]) for n in pieces.count(g)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint")
    kind = documents.schema[id_col].dataType.simpleString()
    return (
        documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), size.alias("n_bytes"))
        .mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
