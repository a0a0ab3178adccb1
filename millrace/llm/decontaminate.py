"""Benchmark decontamination with a broadcast hash set of test n-grams.

The benchmark's windows become a table of hash, words and items.  Documents
are scanned once: each window's hash is looked up in the broadcast table, and
a hit counts only if the words are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import alnum_words, each_copy, gram_hashes, place_of, same_words, text_key, written

#: So many benchmark windows, and so many bytes of them, are broadcast at once.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20
#: The documents are scanned so often at most for parts of the benchmark; a larger one is joined by hash instead.
MOST_PARTS = 4


def benchmark_windows(
    benchmark: DataFrame, window: int = 13, item_col: str = "item_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(h, gram, items), each distinct window of the items and the number of its set of items, and
    (items, item), what is in the sets.

    An item of fewer words than ``window`` is one window; an item without
    words, or with a null text, has none.  Windows of the same items share a
    set, so that a passage common to all items is listed once.
    """
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), alnum_words(F.col(text_col)).alias("w")
    ).filter(F.size("w") > 0)
    cut = items.select(
        "item", "w", F.least(F.size("w"), F.lit(window)).alias("len")
    ).select(
        "item",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("w") - F.col("len") + 1),
                lambda i: F.slice(F.col("w"), i, F.col("len")),
            )
        ).alias("gram"),
    )
    pairs = written(cut.distinct().select(F.xxhash64("gram").alias("h"), "gram", "item"), "window-items")
    # A set is told by its size and two hashes that don't depend on the order.
    told = ["size", "one", "two"]
    windows = pairs.groupBy("h", "gram").agg(
        F.count("item").alias("size"), F.bit_xor(F.xxhash64("item")).alias("one"), F.bit_xor(F.xxhash64(F.lit("2"), "item")).alias("two")
    )
    windows = written(windows.select("h", "gram", "size", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("one", "two")]), "windows")
    sets = windows.groupBy(*told).agg(F.min("h").alias("items"))
    members = pairs.join(sets.select("items"), F.col("h") == F.col("items"), "inner").filter("item is not null")
    return windows.join(sets, told).select("h", "gram", "items"), members.select("items", "item").distinct()


def _hashed(documents: DataFrame, lengths: list[int]) -> DataFrame:
    """A row for each document (p = 0) and each of its windows."""
    # The hashes stand in a projection of their own: the lookup after it is then
    # compiled, and passes the words on for hits alone.
    # The explode is an outer one, as Spark would put a filter that repeats the
    # hashing before an inner one.
    hashed = documents.select(
        "doc_id",
        "text_key",
        "w",
        F.concat(
            F.array(F.lit(None).cast("bigint")), *[gram_hashes("w", k) for k in lengths]
        ).alias("hs"),
    )
    return hashed.select("doc_id", "text_key", "w", F.posexplode_outer("hs").alias("p", "wh"))


def _verified(found: DataFrame, lengths: list[int]) -> DataFrame:
    n = F.size("w")
    start, length = place_of(lengths, F.col("p"), n)
    found = found.select(
        "doc_id", "text_key", "p", n.alias("n"), (start - 1).alias("start"), (start - 1 + length).alias("end"),
        "w", "gram", "items",
    )
    same = same_words("w", F.col("start"), "gram", max(lengths))
    return found.filter((F.col("p") == 0) | same).drop("w", "gram")


def _scan(documents: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """A row for each document (p = 0) and each verified hit; the windows are broadcast."""
    every = _hashed(documents, lengths)
    found = every.join(F.broadcast(grams), every["wh"] == grams["h"], "left").filter(
        (F.col("p") == 0) | F.col("gram").isNotNull()
    )
    return _verified(found, lengths)


def _scan_joined(documents: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """The same for a benchmark of any size: hashes are joined first, and words only of what they leave."""
    every = _hashed(documents, lengths)
    known = grams.select("h").distinct()
    hit = every.filter("p > 0").select("doc_id", "text_key", "p", "wh").join(known, F.col("wh") == F.col("h"), "left_semi")
    hit = hit.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("p", "wh")).alias("hits"))
    hit = hit.select(F.col("doc_id").alias("i"), F.col("text_key").alias("k"), "hits")
    both = documents.join(hit, documents["doc_id"].eqNullSafe(F.col("i")) & (documents["text_key"] == F.col("k")), "left")
    whole = both.select("doc_id", "text_key", F.lit(0).alias("p"), F.size("w").alias("n"), *[F.lit(None).cast(t).alias(c) for c, t in (("start", "int"), ("end", "int"), ("items", "bigint"))])
    found = both.select("doc_id", "text_key", "w", F.explode("hits").alias("x")).select("doc_id", "text_key", "w", "x.p", "x.wh")
    return whole.unionByName(_verified(found.join(grams, F.col("wh") == F.col("h")), lengths))


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 13,
    share: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per document: doc_id, text_key, n_words, n_hit, n_items, item_ids, spans, contaminated.

    A word is hit if it is inside an occurrence of a benchmark window;
    ``spans`` are the merged stretches (start from 0, end) of hit words.  A
    document is contaminated if at least one in ``share`` of its words is hit.

    Null and empty texts have no words, and so no hits.  Repeated rows give a
    row each.  A null item id takes part in hits, but not in ``item_ids``.
    Other columns of the inputs are ignored.  A benchmark of more than
    ``broadcast_rows`` windows, or of more bytes than are broadcast, is looked
    up in parts, or joined by hash if these were more than MOST_PARTS.
    """
    hits, whole, members = _hits(
        documents, benchmark, window=window, share=share, id_col=id_col, text_col=text_col, item_col=item_col, item_text_col=item_text_col, broadcast_rows=broadcast_rows
    )
    key = ["doc_id", "text_key"]
    # Documents with the same sets of items share a list, which is made once for each combination of sets.
    sets_of = hits.groupBy(*key).agg(F.array_sort(F.collect_set("items")).alias("sets"))
    sets_of = written(sets_of.withColumn("combination", F.sha2(F.array_join(F.col("sets").cast("array<string>"), ","), 256)), "item-sets")
    lists = written(item_lists(sets_of, members), "item-lists")
    bytes_of = lists.agg(F.sum(F.octet_length(F.array_join("item_ids", ",")) + 32 * F.size("item_ids") + 96)).first()[0] or 0
    lists = F.broadcast(lists) if bytes_of <= BROADCAST_BYTES else lists
    of_document = sets_of.join(lists, "combination").select(*key, "item_ids")
    result = _with_rows(whole, of_document)
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    result = result.select(
        "doc_id",
        "text_key",
        "n_words",
        "n_hit",
        F.size(item_ids).cast("bigint").alias("n_items"),
        item_ids.alias("item_ids"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        "contaminated",
        "copies",
    )
    return each_copy(result, "doc_id", "text_key")


def _hits(
    documents: DataFrame, benchmark: DataFrame, *, window: int = 13, share: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The hits (doc_id, text_key, items), a row for all documents that agree in id and text
    (doc_id, text_key, n_words, copies, spans, n_hit, contaminated), and what is in the sets of items."""
    grams, members = benchmark_windows(benchmark, window, item_col, item_text_col)
    grams = written(grams, "grams")
    size = F.sum(F.octet_length(F.array_join("gram", " ")) + 32 * F.size("gram") + 64)
    about = grams.agg(F.count("*").alias("n"), size.alias("bytes"), F.collect_set(F.size("gram")).alias("k")).first()
    lengths = sorted(about["k"], reverse=True) or [window]
    parts = max(1, -(-about["n"] // broadcast_rows), -(-(about["bytes"] or 0) // BROADCAST_BYTES))
    base = documents.select(
        F.col(id_col).alias("doc_id"),
        text_key(F.col(text_col)).alias("text_key"),
        alnum_words(F.col(text_col)).alias("w"),
    )
    if parts > MOST_PARTS:
        rows = _scan_joined(base, grams, lengths)
    else:
        rows = None
        for part in range(parts):
            own = grams if parts == 1 else grams.filter(F.pmod("h", F.lit(parts)) == part)
            scanned = _scan(base, own, lengths)
            rows = scanned if rows is None else rows.unionByName(scanned.filter("p > 0"))
    rows = written(rows, "hits")
    key = ["doc_id", "text_key"]
    whole = rows.filter("p = 0").groupBy(*key).agg(F.max("n").cast("bigint").alias("n_words"), F.count("*").alias("copies"))
    # Spans: a hit that begins behind all before it begins a span.
    hits = rows.filter("p > 0")
    places = hits.select(*key, "start", "end").distinct()
    by_start = Window.partitionBy(*key).orderBy("start", "end")
    apart = F.col("start") > F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    places = places.withColumn("run", F.sum(F.coalesce(apart, F.lit(False)).cast("int")).over(by_start))
    spans = places.groupBy(*key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("n_hit")
    )
    whole = _with_rows(whole, spans)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    whole = whole.withColumn("n_hit", n_hit).withColumn("contaminated", (n_hit > 0) & (share * n_hit >= F.col("n_words")))
    return hits.select(*key, "items"), whole, members


def _with_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.withColumnsRenamed({"doc_id": "i", "text_key": "k"})
    return left.join(right, left["doc_id"].eqNullSafe(right["i"]) & (left["text_key"] == right["k"]), "left").drop("i", "k")


def item_lists(sets_of: DataFrame, members: DataFrame) -> DataFrame:
    """(combination, item_ids): the sorted items of each distinct combination of sets, however many documents have it."""
    distinct = sets_of.groupBy("combination").agg(F.first("sets").alias("sets"))
    each = distinct.select("combination", F.explode("sets").alias("items")).join(members, "items")
    return each.groupBy("combination").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))


def without_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all columns kept, that aren't contaminated.

    Rows of null or empty text have no words and stay.  Repeated rows go or stay together, null ids too; rows of one id
    and different texts are judged each.  Other columns may have any name.  An empty table, of documents or of
    benchmark items, removes nothing.
    """
    bad = _hits(documents, benchmark, **options)[1].filter("contaminated").select(
        F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")
    )
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    packed = documents.select(F.struct("*").alias("row"))
    row = F.col("row")
    return packed.join(
        bad,
        row[id_col].eqNullSafe(F.col("bad_id")) & (text_key(row[text_col]) == F.col("bad_key")),
        "left_anti",
    ).select("row.*")


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = contamination(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM g),
p AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT p.r, p.i, p.k, g.item_id FROM p JOIN g ON p.k = g.k AND p.gram = g.gram),
c AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS x FROM h) GROUP BY r),
t AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
