"""N-gram Jaccard join: size-aware, with heavy and light sets.

All sets keep their rarest shingles, their prefix, so that two sets of a
similarity of 0.8 or more share a shingle of their prefixes.  Light (small)
sets enumerate the subsets of two of a prefix longer by one, so that two such
sets share a subset; heavy (large) sets, and the light ones that may be similar
to them, are put on an inverted list for each shingle.  The boundary between
light and heavy is where the cost of enumerating passes that of scanning.

Lists are scanned in two rounds.  First each set is compared with its list's
centre; then, in lists that still hold sets of different components, those
outside the centre's component are compared with the others.  What is left out
are pairs that are linked already, over others, and pairs that by size, place
of the shared shingle or signature can't be similar enough.  That finds the
components.

Every link lies within a component, so the links are counted there: the sets
of a component are dealt into blocks, each two blocks meet in one group, and a
product of their incidence matrices gives all intersections.  Only each set's
number of links leaves a group, never the pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WordHashes, mixed, rolling, text_key, written
from millrace.operators.components import connected_components

BASE = 0x9E3779B97F4A7C15
#: Cells of the count sketch that orders shingles: a power of two, one for so many bytes of text, within these bounds.
CELL_BYTES, LEAST_CELLS, MOST_CELLS = 1 << 10, 1 << 20, 1 << 24
BLOCK = 1 << 14
#: A component is dealt into blocks of about so many sets, and so many shingles.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 20
#: Shingles that two blocks' sets are compared in at once.
COLUMNS = 4096
#: Bits of a set's signature: how many of its hashes fall into each of so many bins, odd or even.
PARITIES = 512
#: What a scanned entry of a list costs, in keys written.
SCAN_COST = 4
#: No set larger than this is light.
MOST_LIGHT = 64
#: So many ids of texts to compare are broadcast to find these; beyond that they are joined.
BROADCAST_ROWS = 200_000


def shingles(words: WordHashes, text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; of all its words, if there are fewer."""
    h = words.of(text.encode().lower().split()) if text else np.zeros(0, np.uint64)
    if 0 < len(h) < size:
        return mixed(rolling(h, len(h), BASE) + np.uint64(len(h)))
    return np.unique(mixed(rolling(h, size, BASE)))


def node_of(found: np.ndarray) -> int:
    """Equal sets are one node."""
    value = xxhash.xxh3_64_intdigest(found.tobytes())
    return value - (1 << 64) if value >> 63 else value


def parities(found: np.ndarray) -> list[int]:
    """The signature as 64-bit numbers.  Two sets' signatures differ in no more bits than the sets in shingles."""
    odd = np.bincount(((found >> np.uint64(40)) & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def boundary(cells: np.ndarray, percent: int) -> int:
    """The largest size of light sets.

    Enumerating costs a key for each subset; scanning costs a key for each
    shingle of the prefix, and SCAN_COST for each other set on its list.  How
    many those are is taken from the sketch: the mean count of the rarest
    fifth of shingles, less what a cell holds by chance, one at least.
    """
    counts = np.sort(cells[cells > 0]).astype(np.float64)
    rare = counts[np.cumsum(counts) <= counts.sum() * (100 - percent) / 100]
    others = max(1.0, (rare * rare).sum() / rare.sum() - cells.mean()) if len(rare) else 1.0
    light = 0
    for n in range(2, MOST_LIGHT + 1):
        p = prefix_length(n, percent)
        if p * (p + 1) / 2 <= p * (1 + SCAN_COST * others):
            light = n
    return light


# --- first pass: sets and their counts ----------------------------------------

def _first_pass(size: int, n_cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cells, names, kinds = WordHashes(), np.zeros(n_cells, np.int32), None, None
        for b in batches:
            nodes, sizes, signatures = [], [], []
            for text in b.column(2):
                s = shingles(words, text.as_py(), size)
                nodes.append(node_of(s))
                sizes.append(len(s))
                signatures.append(parities(s))
                np.add.at(cells, (s & np.uint64(n_cells - 1)).astype(np.int64), 1)
            k = b.num_rows
            names = ["doc_id", "text_key", "node", "n", "signature", "block", "counts"]
            kinds = [b.schema.field(0).type, pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()),
                 pa.array(signatures, pa.list_(pa.int64())), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                names=names,
            )
        rows = [(i, _packed(x)) for i, x in enumerate(cells.reshape(-1, BLOCK)) if x.any()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(rows), x) for x in kinds), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                names=names,
            )

    return run


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype(np.int64).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.int64)


def _sum_blocks(batch: pa.Table) -> pa.Table:
    total = sum(_unpacked(x.as_py()) for x in batch["counts"])
    return pa.table({"block": batch["block"][:1], "counts": pa.array([_packed(total)], pa.binary())})


def sketch_cells(texts: DataFrame) -> int:
    """How many cells a corpus gets."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << (size // CELL_BYTES).bit_length()))


def _sketch(rows: DataFrame, n_cells: int) -> np.ndarray:
    """Sums the tasks' sketches, in two steps so that no task gets all of a block; the cells' numbers reach the driver."""
    part = F.pmod(F.spark_partition_id(), F.lit(64)).alias("part")
    some = rows.select("block", "counts", part).groupBy("block", "part").applyInArrow(_sum_blocks, "block int, counts binary")
    table = some.groupBy("block").applyInArrow(_sum_blocks, "block int, counts binary").toArrow()
    cells = np.zeros((n_cells // BLOCK, BLOCK), np.int64)
    for block, counts in zip(table["block"].to_pylist(), table["counts"].to_pylist(), strict=True):
        cells[block] = _unpacked(counts)
    return cells.reshape(-1)


# --- second pass: the keys that sets are found by -------------------------------


def _keys(sent, light: int, percent: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cells = WordHashes(), sent.value
        near = -(-percent * (light + 1) // 100)  # the least size that is similar to a heavy set's
        seen: set[int] = set()
        for b in batches:
            keys, nodes, places = [], [], []
            for text in b.column(0):
                s = shingles(words, text.as_py(), size)
                n = len(s)
                # Sets of three shingles or fewer are similar to equal sets alone.
                node = node_of(s)
                if n < 4 or node in seen:
                    continue
                if len(seen) > 50_000:
                    seen.clear()  # copies of a set only cost room
                seen.add(node)
                p = prefix_length(n, percent)
                s = s[np.lexsort((s, cells[(s & np.uint64(len(cells) - 1)).astype(np.int64)]))][: p + 1]
                found, at = [], []
                if n <= light:
                    i, j = np.triu_indices(len(s), 1)
                    found.append(mixed(s[i] * np.uint64(BASE) + s[j]))
                    at.append(np.zeros(len(i), np.int64))  # subsets have no place
                if n > light or n >= near:
                    found.append(s[:p])
                    at.append(np.arange(1, len(s[:p]) + 1))
                at = np.concatenate(at)
                keys += found
                places.append((n << 32) + at)
                nodes.append(np.full(len(at), node, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(places))],
                    names=["key", "node", "place"],
                )

    return run


def _size(place: str) -> Column:
    return F.shiftright(place, 32).cast("int")


def _needed(n: Column, m: Column, percent: int) -> Column:
    """How many shingles sets of these sizes must share."""
    return F.ceil(percent * (n + m) / F.lit(100 + percent))


def _behind(n: Column, percent: int) -> Column:
    """Shingles that aren't in the prefix."""
    return F.ceil(percent * n / F.lit(100)) - 1


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether sets whose first shared shingle of the prefixes is at these places may share enough."""
    after = lambda x: _size(x) - F.greatest(F.col(x).bitwiseAND(F.lit(0xFFFFFFFF)) - 1, F.lit(0))
    enough = F.least(after(a), after(b)) >= _needed(_size(a), _size(b), percent)
    return (100 * F.least(_size(a), _size(b)) >= percent * F.greatest(_size(a), _size(b))) & enough


def _apart(a: str, b: str) -> Column:
    """In how many bits two signatures differ; they stand in the columns a0, a1 and so on."""
    return sum((F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))) for k in range(PARITIES // 64)), F.lit(0))


def _signed(prefix: str) -> list[Column]:
    return [F.col("signature")[k].alias(f"{prefix}{k}") for k in range(PARITIES // 64)]


def _close(n: Column, m: Column, apart: Column, percent: int) -> Column:
    """Whether the sets may differ in so few shingles as similar ones do."""
    return apart <= n + m - 2 * _needed(n, m, percent)


# --- comparing ----------------------------------------------------------------


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                sets = [shingles(words, t.as_py(), size).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "members"])

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _promising(pairs: DataFrame, prefixes: DataFrame, light: int, percent: int) -> DataFrame:
    """Pairs that share so much of their prefixes that with all shingles behind them they may share enough.

    Behind the prefix that ends first, in the common order, everything may be
    shared; before its end only what both prefixes have.
    """
    def with_both(rows: DataFrame, *columns: str) -> DataFrame:
        for k in "ab":
            own = prefixes.select(F.col("node").alias(f"i{k}"), *[F.col(c).alias(f"{c}_{k}") for c in columns])
            rows = rows.join(own, F.col(k) == F.col(f"i{k}")).drop(f"i{k}")
        return rows

    n, m = F.col("n_a"), F.col("n_b")
    apart = sum((F.bit_count(F.col("signature_a")[k].bitwiseXOR(F.col("signature_b")[k])) for k in range(PARITIES // 64)), F.lit(0))
    # Sizes and signatures are small; only what they leave gets the keys, and only what these leave the sets.
    close = with_both(pairs, "n", "signature").filter(_close(n, m, apart, percent)).select("a", "b", "n_a", "n_b")
    most = F.size(F.array_intersect("keys_a", "keys_b")) + F.greatest(_behind(n, percent), _behind(m, percent))
    both_light = (n <= light) & (m <= light)
    return with_both(close, "keys").filter(both_light | (most >= _needed(n, m, percent))).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    one = sets.select(F.col("node").alias("i"), F.col("members").alias("x"))
    two = sets.select(F.col("node").alias("j"), F.col("members").alias("y"))
    both = pairs.join(one, F.col("a") == F.col("i")).join(two, F.col("b") == F.col("j")).select("a", "b", "x", "y")
    return both.mapInArrow(_similar(percent), "a bigint, b bigint")


# --- links --------------------------------------------------------------------


def links_of(sets: list[np.ndarray], weights: np.ndarray, one: np.ndarray, two: np.ndarray, percent: int) -> np.ndarray:
    """Of each set, the summed weights of the others that it is similar to; sets ``one`` are compared with sets ``two``,
    which are either the same ones or none of them."""
    sizes = np.array([len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    by_value = np.argsort(at, kind="stable")
    owner, at = owner[by_value], at[by_value]
    both = np.zeros((len(one), len(two)))
    for first in range(0, len(values), COLUMNS):
        here = slice(*np.searchsorted(at, (first, first + COLUMNS)))
        present = np.zeros((len(sets), min(COLUMNS, len(values) - first)), np.float32)
        present[owner[here], at[here] - first] = 1
        both += present[one] @ present[two].T
    similar = 100 * both >= percent * (sizes[one][:, None] + sizes[two][None, :] - both)
    out = np.zeros(len(sets), np.int64)
    if one is two:
        np.fill_diagonal(similar, False)
        out[one] = similar @ weights[two]
    else:
        out[one], out[two] = similar @ weights[two], similar.T @ weights[one]
    return out


def _links(percent: int):
    """From rows (component, lo, hi, block, node, copies, members) in groups of the first three, one after the other."""

    def counted(group: list[tuple]) -> tuple[list[int], np.ndarray]:
        sets = [np.frombuffer(r[3], np.uint64) for r in group]
        block = np.array([r[0] for r in group])
        one = two = np.arange(len(group))
        if block.min() != block.max():
            one, two = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        return [r[1] for r in group], links_of(sets, np.array([r[2] for r in group]), one, two, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def out() -> Iterator[pa.RecordBatch]:
            # Blocks of a pair of which one is empty have nothing to compare.
            if held and (key[1] == key[2] or len({r[0] for r in held}) > 1):
                nodes, counts = counted(held)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(counts, pa.int64())], names=["node", "linked"])

        for b in batches:
            for *now, block, node, copies, members in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if tuple(now) != key:
                    yield from out()
                    held, key = [], tuple(now)
                held.append((block, node, copies, members))
        yield from out()

    return run


def similar_documents(
    documents: DataFrame, *, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, text_key, n_shingles, component_id, n_links.

    Documents link when their sets of ``size``-word shingles have a Jaccard
    similarity of ``percent`` or more; ``component_id`` is the least doc_id
    that links reach, its own included, and ``n_links`` the number of other
    documents that it links with, copies included.

    Null and empty texts, and texts without words, have an empty set and link
    with nothing.  A text of fewer words is one shingle.  Repeated rows are
    documents of their own, with equal sets.  A null doc_id links like others,
    but names no component; it gets null where its component has no other.
    Ids are of any type that has an order.  Other columns are ignored.
    Shingles, and equal sets, are told apart by 64-bit hashes.
    """
    return _joined(documents, size=size, percent=percent, id_col=id_col, text_col=text_col, links=True).drop("component")


def _joined(
    documents: DataFrame, *, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", links: bool = False
) -> DataFrame:
    """``similar_documents``, without n_links unless ``links``, with ``component``, which tells apart components without
    an id too; null for an empty set."""
    context = documents.sparkSession.sparkContext
    base = documents.select(
        F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")
    )
    kind = base.schema["doc_id"].dataType.simpleString()
    n_cells = sketch_cells(base)
    first = written(
        base.mapInArrow(_first_pass(size, n_cells), f"doc_id {kind}, text_key bigint, node bigint, n int, signature array<bigint>, block int, counts binary"), "sets"
    )
    members = first.filter("block is null").select("doc_id", "text_key", "node", "n", "signature")
    cells = _sketch(first.filter("block is not null"), n_cells)
    sent = context.broadcast(np.minimum(cells, 2**32 - 1).astype(np.uint32))
    light = boundary(cells, percent)
    keys = base.select("text").mapInArrow(_keys(sent, light, percent, size), "key bigint, node bigint, place bigint")
    # One shuffle by key makes the lists.  Copies of a set go, and so do sets without another of
    # fitting size on the list, which is next to them by size if there is one.  A list's centre is
    # the set that has the shared shingle earliest in its prefix, and so the fewest rarer ones.
    by_size = Window.partitionBy("key").orderBy("place", "node")
    lists = keys.withColumn("copy", F.lag("node").over(by_size).eqNullSafe(F.col("node"))).filter("not copy")
    lists = lists.withColumn("one", F.lag("place").over(by_size)).withColumn("other", F.lead("place").over(by_size))
    fits = lambda x: F.col(x).isNotNull() & (100 * F.least(_size(x), _size("place")) >= percent * F.greatest(_size(x), _size("place")))
    lists = lists.filter(fits("one") | fits("other"))
    at = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("at")
    lists = lists.withColumn("x", F.min(F.struct(at, "node", "place")).over(Window.partitionBy("key")))
    shared = written(
        lists.select("key", "node", "place", F.col("x.node").alias("centre"), F.col("x.place").alias("centre_place")), "lists"
    )
    is_shingle = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)) > 0
    prefixes = shared.groupBy("node").agg(F.max(_size("place")).alias("n"), F.collect_set(F.when(is_shingle, F.col("key"))).alias("keys"))
    signatures = members.groupBy(F.col("node").alias("of")).agg(F.first("signature").alias("signature"))
    prefixes = written(prefixes.join(signatures, F.col("node") == F.col("of")).drop("of"), "prefixes")
    # The shingle before, on the node's lists: two sets that share it too are found there already.
    before = F.lag("key").over(Window.partitionBy("node", is_shingle).orderBy("place"))
    stars = written(shared.withColumn("before", F.when(is_shingle, before)), "stars")
    one_each = members.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("d"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        """(node, members) of the nodes, column w."""
        chosen = written(
            one_each.join(nodes, F.col("node") == F.col("w"), "left_semi").select(
                "node", F.col("d.doc_id").alias("i"), F.col("d.text_key").alias("t")
            ),
            "chosen",
        )
        few = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
        texts = base.join(few, base["doc_id"].eqNullSafe(F.col("i")) & (base["text_key"] == F.col("t"))).select("node", "text")
        return written(texts.mapInArrow(_sets(size), "node bigint, members binary"), "members").dropDuplicates(["node"])

    def verified(candidates: DataFrame) -> DataFrame:
        promising = written(_promising(candidates, prefixes, light, percent), "pairs")
        sets = sets_of(promising.select(F.explode(F.array("a", "b")).alias("w")).distinct())
        return written(_verified(promising, sets, percent), "links")

    # Round one: each list's sets with its centre.
    def compared(stars: DataFrame) -> DataFrame:
        pairs = stars.filter((F.col("node") != F.col("centre")) & _possible("place", "centre_place", percent))
        return verified(pairs.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct())

    def still_open(stars: DataFrame, links: DataFrame) -> DataFrame:
        """The rows, with their components, of lists of several; main is the centre's component."""
        known = connected_components(links).select(F.col("node").alias("o"), "component")
        rows = stars.join(known, F.col("node") == F.col("o"), "left").select(*stars.columns, F.coalesce("component", "node").alias("component"))
        rows = written(rows, "labelled")
        of_centre = F.max(F.when(F.col("node") == F.col("centre"), F.col("component"))).alias("main")
        lists = rows.groupBy(F.col("key").alias("k")).agg(F.min("component").alias("x"), F.max("component").alias("y"), of_centre)
        return rows.join(lists.filter("x <> y").select("k", "main"), F.col("key") == F.col("k")).drop("k")

    linked = compared(stars)
    # Once more for what isn't linked to the centre, with a centre of its own.
    opened = written(still_open(stars, linked), "open")
    outside = opened.filter("component <> main").select("key", "node", "place", "before")
    centres = outside.groupBy(F.col("key").alias("k")).agg(F.min(F.struct(at, "node", "place")).alias("x"))
    outside = outside.join(centres, F.col("key") == F.col("k")).select(
        "key", "node", "place", "before", F.col("x.node").alias("centre"), F.col("x.place").alias("centre_place")
    )
    linked = written(linked.unionByName(compared(outside)), "links")
    # Round two: what isn't linked yet, in lists of several components.
    left = still_open(opened.drop("component", "main"), linked).filter("node <> centre")
    left = left.join(signatures, F.col("node") == F.col("of")).drop("of")
    outside = left.filter("component <> main").select(
        F.col("key").alias("ka"), F.col("node").alias("a"), F.col("place").alias("pa"), F.col("component").alias("ca"),
        F.col("before").alias("ba"), *_signed("sa"),
    )
    others = left.select(
        F.col("key").alias("kb"), F.col("node").alias("b"), F.col("place").alias("pb"), F.col("component").alias("cb"),
        F.col("before").alias("bb"), "main", *_signed("sb"),
    )
    again = outside.join(
        others,
        (F.col("ka") == F.col("kb")) & (F.col("ca") != F.col("cb")) & _possible("pa", "pb", percent)
        & ((F.col("cb") == F.col("main")) | (F.col("a") < F.col("b")))
        & (F.col("ba").isNull() | F.col("bb").isNull() | (F.col("ba") != F.col("bb")))
        & _close(_size("pa"), _size("pb"), _apart("sa", "sb"), percent),
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = verified(again)
    final = connected_components(linked.unionByName(more)).select(F.col("node").alias("o"), "component")
    # Names: the least doc_id of each node, then of each component.
    named = members.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("own"), F.count("*").alias("copies"), F.first("n").alias("n"))
    named = named.join(final, F.col("node") == F.col("o"), "left").select(
        "node", "own", "copies", "n", F.coalesce("component", "node").alias("component")
    )
    named = written(named, "named") if links else named
    names = named.groupBy(F.col("component").alias("c")).agg(F.min("own").alias("component_id"))
    n_links = F.lit(None).cast("bigint")
    every = named.join(names, F.col("component") == F.col("c"))
    if links:
        counts = _link_counts(named, sets_of, percent).withColumnRenamed("node", "of")
        every = every.join(counts, F.col("node") == F.col("of"), "left")
        n_links = F.coalesce("linked", F.lit(0)) + F.col("copies") - 1
    every = every.select(F.col("node").alias("o"), "component_id", "component", n_links.alias("n_links"))
    return members.join(every, (F.col("node") == F.col("o")) & (F.col("n") > 0), "left").select(
        "doc_id",
        "text_key",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *([F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")] if links else []),
        "component",
    )


def _link_counts(named: DataFrame, sets_of, percent: int) -> DataFrame:
    """(node, linked): of sets in components of several, how many documents of other sets they link with."""
    about = named.groupBy(F.col("component").alias("c")).agg(F.count("*").alias("k"), F.sum("n").alias("total")).filter("k > 1")
    blocks = F.ceil(F.greatest(F.col("k") / BLOCK_SETS, F.col("total") / BLOCK_SHINGLES)).cast("int")
    # Written, so that Spark can split the join of a hot component with its sets.
    about = written(about.select("c", blocks.alias("blocks")), "component-sizes")
    dealt = named.join(about, F.col("component") == F.col("c")).select(
        F.col("node").alias("w"), "component", "copies", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    )
    dealt = written(dealt, "dealt")
    sets = sets_of(dealt.select("w"))
    both = dealt.join(sets, F.col("w") == F.col("node"))
    each = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = each.select(
        "component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "copies", "members"
    )
    groups = rows.repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi")
    counted = groups.mapInArrow(_links(percent), "node bigint, linked bigint")
    return counted.groupBy("node").agg(F.sum("linked").alias("linked"))


def one_of_each(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, all columns kept: that of the least id (null last), then text hash, then hash of the row.

    Rows of an empty set, which link with nothing, all stay.
    """
    found = written(_joined(documents, id_col=id_col, text_col=text_col, **options), "components")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("i"), F.col("text_key").alias("k"))).alias("x")
    named = found.filter("component is not null").groupBy("component").agg(least).select("x.i", "x.k", F.lit(True).alias("single"))
    bare = found.filter("component is null").select(F.col("doc_id").alias("i"), F.col("text_key").alias("k"), F.lit(False).alias("single")).distinct()
    packed = documents.select(F.struct("*").alias("row"))
    row = F.col("row")
    kept = packed.join(named.unionByName(bare), row[id_col].eqNullSafe(F.col("i")) & (text_key(row[text_col]) == F.col("k")))
    # Copies of a chosen row meet in partial aggregates, not all in one task.
    chosen = kept.filter("single").groupBy("i", "k").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return chosen.select("row.*").unionByName(kept.filter("not single").select("row.*"))


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    found = similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(doc_id, id) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.y, r.id FROM r JOIN e ON e.x = r.doc_id)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.id) AS component_id,
  (SELECT count(*) FROM e WHERE e.x = d.doc_id) AS n_links
FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""
