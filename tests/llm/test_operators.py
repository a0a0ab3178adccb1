"""Each operator against a plain version in Python, on odd documents and on none."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import words

from millrace.llm import (
    common, decontaminate, jaccard_join, licenses, line_dedup, lm_score, mixing, quality_rules, secret_scan,
    substring_dedup, token_counts,
)

LOWER = {c: c + 32 for c in range(65, 91)}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def space(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def same(df, columns, want):
    order = lambda r: tuple((x is not None, str(type(x)), x if isinstance(x, int | float) else str(x)) for x in r)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=order)
    assert got == sorted(want, key=order)


# --- 1 ------------------------------------------------------------------------


def contaminated(rows, items, window=13):
    grams = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1) if k else ():
            grams[tuple(w[i : i + k])].add(item)
    sizes = {len(g) for g in grams}
    for doc, text, *_ in rows:
        w = alnum(text)
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (g := tuple(w[i : i + k])) in grams:
                    hit |= set(range(i, i + k))
                    found |= grams[g]
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        yield doc, len(w), len(hit), len(found - {None}), sha256(ids.encode()).hexdigest(), 20 * len(hit) >= len(w) and bool(hit)


@pytest.mark.parametrize("broadcast_rows", [200_000, 1_000, 50])
def test_decontamination(spark, docs, rows, broadcast_rows):
    items = [(1, rows[9][1][:300]), (10, "ONE"), (2, "two, words"), (2, rows[9][1][20:200]), (None, "x x x"), (3, None), (4, "..."), (5, rows[20][1][100:9000])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench, broadcast_rows=broadcast_rows)
    got = got.withColumn("ids", F.sha2(F.array_join("item_ids", ","), 256))
    same(got, ["doc_id", "n_words", "n_hit", "n_items", "ids", "contaminated"], list(contaminated(rows, items)))
    assert got.filter("n_hit <> aggregate(spans, 0, (a, x) -> a + x.end - x.start)").count() == 0
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == got.filter("not contaminated").count()


def test_a_passage_common_to_all_items_is_listed_once(spark):
    rng = random.Random(4)
    head = " ".join(words(rng, 30))
    items = [(i, head + " " + " ".join(words(rng, 15))) for i in range(60)]
    grams, members = decontaminate.benchmark_windows(spark.createDataFrame(items, "item_id long, text string"))
    assert members.count() < 150 and grams.count() > 800
    rows = [(1, head), (2, items[7][1]), (3, "x"), (None, head + " " + head)]
    got = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = got.withColumn("ids", F.sha2(F.array_join("item_ids", ","), 256))
    same(got, ["doc_id", "n_words", "n_hit", "n_items", "ids", "contaminated"], list(contaminated(rows, items)))


def test_documents_with_the_same_items_share_a_list(spark):
    """A passage in all items and in all documents, which are of one text for the most part."""
    rng = random.Random(14)
    head = " ".join(words(rng, 30))
    items = [(i, head + " " + " ".join(words(rng, 15))) for i in range(60)]
    rows = [(i, head + " " + " ".join(words(rng, 5))) for i in range(200)] + [(7, items[3][1])] * 2500
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(df, bench)
    got = found.withColumn("ids", F.sha2(F.array_join("item_ids", ","), 256))
    same(got, ["doc_id", "n_words", "n_hit", "n_items", "ids", "contaminated"], list(contaminated(rows, items)))
    hits, _, members = decontaminate._hits(df, bench)
    sets_of = hits.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("items")).alias("sets")).withColumn("combination", F.col("sets").cast("string"))
    # A word by chance behind the passage, as in an item, makes a combination of its own.
    made = sets_of.select("combination").distinct().count()
    assert sets_of.count() == 201 and decontaminate.item_lists(sets_of, members).count() == made < 20


@pytest.mark.parametrize("partitions", [1, 16])
def test_copies_come_out_of_many_tasks(spark, partitions):
    rows = spark.createDataFrame([(1, 40_000), (2, 1), (None, 3), (3, 1000), (4, 1001)], "doc_id long, copies long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = common.each_copy(rows, "doc_id")
        assert got.columns == ["doc_id"]
        tasks = got.groupBy("doc_id", F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = Counter()
    for r in tasks:
        counts[r.doc_id] += r["count"]
    assert counts == {1: 40_000, 2: 1, None: 3, 3: 1000, 4: 1001}
    hot = [r["count"] for r in tasks if r.doc_id == 1]
    assert partitions == 1 or (len(hot) >= 12 and max(hot) <= 8000)


def test_decontamination_of_nothing(spark, docs, empty, rows):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench).filter("n_hit = 0 and not contaminated").count() == len(rows)


# --- 2 ------------------------------------------------------------------------


def test_scores(docs, rows):
    got = lm_score.score(docs, rounds=1, frequent=50).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), b" "]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    c = Counter(w for d, t, *_ in rows if not out(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    base = lambda t: sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))
    want = sorted((str(d), len(tokens(t)), sum(w in c for w in tokens(t)), out(d), round(base(t), 6)) for d, t, *_ in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.held_out, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_scores_of_nothing(empty):
    assert lm_score.score(empty, rounds=1).count() == 0


def small_model(rng):
    normal = lambda x, axis: x / x.sum(axis, keepdims=True)
    k = lm_score.STATES
    return lm_score.Model(normal(rng.random(k), 0), normal(rng.random((k, k)), 1), normal(rng.random((7, k)), 0))


@pytest.mark.parametrize("stretch", [1, 2, 3, 100])
def test_likelihood_is_the_sum_over_paths(stretch):
    rng = np.random.default_rng(0)
    model = small_model(rng)
    sequences = [rng.integers(0, 5, n) for n in (3, 1, 4, 2, 5)]
    for seq, got in zip(sequences, lm_score.likelihoods(model, sequences, stretch), strict=True):
        total = 0.0
        for path in product(range(lm_score.STATES), repeat=len(seq)):
            p = model.start[path[0]]
            for t, s in enumerate(path):
                p *= model.emits[seq[t], s] * (model.moves[path[t - 1], s] if t else 1)
            total += p
        assert got == pytest.approx(math.log10(total), abs=1e-9)


def plain_counts(model, sequences):
    """Baum-Welch's counts a token at a time, over whole texts."""
    k = lm_score.STATES
    start, moves, emits, total = np.zeros(k), np.zeros((k, k)), np.zeros(model.emits.shape), 0.0
    for seq in sequences:
        f, b, c = np.empty((len(seq), k)), np.ones((len(seq), k)), np.empty(len(seq))
        for t, x in enumerate(seq):
            f[t] = model.emits[x] * (model.start if t == 0 else f[t - 1] @ model.moves)
            c[t] = f[t].sum()
            f[t] /= c[t]
        for t in range(len(seq) - 2, -1, -1):
            b[t] = model.moves @ (model.emits[seq[t + 1]] * b[t + 1]) / c[t + 1]
            moves += np.outer(f[t], model.emits[seq[t + 1]] * b[t + 1] / c[t + 1]) * model.moves
        start += f[0] * b[0]
        np.add.at(emits, seq, f * b)
        total += np.log(c).sum()
    return start, moves, emits, total


@pytest.mark.parametrize("stretch", [7, 512, 10_000])
def test_expected_counts_are_those_of_whole_texts(stretch):
    """Texts longer than a stretch, of one token, and of a stretch exactly; moves over cuts count and cuts are no starts."""
    rng = np.random.default_rng(1)
    model, seqs = small_model(rng), [rng.integers(0, 7, n) for n in (9, 1300, 1, 7, 1024, 14)]
    got, want = lm_score.expected_counts(model, seqs, stretch), plain_counts(model, seqs)
    for x, y in zip(got, want, strict=True):
        np.testing.assert_allclose(x, y, rtol=2e-3, atol=2e-3)
    assert got[0].sum() == pytest.approx(len(seqs), rel=1e-4)


def test_rounds_of_training_raise_the_likelihood():
    rng = np.random.default_rng(1)
    model, seqs = small_model(rng), [rng.integers(0, 6, n) for n in (9, 30, 1, 17)]
    before = None
    for _ in range(4):
        start, moves, emits, total = lm_score.expected_counts(model, seqs, 8)
        now = lm_score.likelihoods(model, seqs).sum()
        assert total / math.log(10) == pytest.approx(now, rel=1e-4) and (before is None or now >= before - 1e-6)
        before = now
        emits += 1e-9
        model = lm_score.Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def test_symbols():
    own = np.array([3, 9, 2**63 + 5], np.uint64)
    h = np.array([9, 4, 2**63 + 5, 3, 11, 2**64 - 1], np.uint64)
    assert lm_score.Symbols(own, 4).of(h).tolist() == [1, 3, 2, 0, 6, 6] and lm_score.Symbols(own[:0], 1).of(h).tolist() == [0] * 6


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_held_out_documents_score_above_word_shares(spark, sf):
    r = lm_score.op2_lm_score(spark, f"/root/testdata/{sf}").filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    print((r.s - r.b) / r.n)
    assert r.s > r.b


def test_held_out_text_scores_better_than_by_word_shares(spark):
    """Texts of two vocabularies: the states learn to stay with one."""
    rng = random.Random(5)
    kinds = [[f"{p}{i}" for i in range(60)] for p in "ab"]
    rows = [(i, " ".join(rng.choices(kinds[i % 2], k=100))) for i in range(3000)]
    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string"), rounds=8).filter("held_out")
    r = got.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert (r.s - r.b) / r.n > 0.03


# --- 3 ------------------------------------------------------------------------


def without_repeats(rows, window):
    starts = Counter(tuple(w[i : i + window]) for _, t, *_ in rows for w in [space(t)] for i in range(len(w) - window + 1))
    for doc, text, *_ in rows:
        w = space(text)
        gone = {j for i in range(len(w) - window + 1) if starts[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        yield doc, len(w), len(gone), " ".join(kept)


@pytest.mark.parametrize("window", [35, 8, 2])
def test_substring_dedup(docs, rows, window):
    same(substring_dedup.dedup_substrings(docs, window=window), ["doc_id", "n_words", "n_removed", "kept"], list(without_repeats(rows, window)))


def test_substring_dedup_of_short_repeats(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(40)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(substring_dedup.dedup_substrings(df, window=10), ["doc_id", "n_words", "n_removed", "kept"], list(without_repeats(rows, 10)))


def test_substring_dedup_of_nothing(empty):
    assert substring_dedup.dedup_substrings(empty).count() == 0


# --- 4 ------------------------------------------------------------------------


def without_later_lines(rows, key):
    """In the order of ``key``, a row at a time."""
    seen = set()
    for r in sorted(rows, key=key):
        doc, text = r[:2]
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(" \t\x0b\x0c\r")]
        gone = set()
        for k in range(len(at) - 2):
            g = tuple(lines[i] for i in at[k : k + 3])
            if g in seen:
                gone |= set(at[k : k + 3])
            seen.add(g)
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        yield doc, 0 if text is None else len(lines), len(gone), kept


def test_line_dedup(spark, docs, rows):
    """The order of different texts of one id is that of their hashes."""
    hashes = {r.text: r.k for r in spark.createDataFrame([(r[1],) for r in rows], "text string").select("text", common.text_key(F.col("text")).alias("k")).collect()}
    want = list(without_later_lines(rows, lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]])))
    same(line_dedup.dedup_lines(docs), ["row.doc_id", "n_lines", "n_removed", "kept"], want)


def test_copies_of_an_id_lose_their_lines(spark):
    text, other = "a\nb\n\nc\nd", "x\ny\nz"
    rows = [(None, text, 1)] * 3 + [(None, text, 2)] * 2 + [(7, other, 1), (7, other, 2), (7, other + "\nw", 1), (8, "a\nb", 1), (8, "a\nb", 1), (9, None, 1), (9, None, 1)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, size int")).collect()
    assert sorted((str(r.row.doc_id), r.n_removed, str(r.kept)) for r in got) == sorted(
        [("None", 0, text), *[("None", 4, "")] * 4, ("8", 0, "a\nb"), ("8", 0, "a\nb"), ("9", 0, "None"), ("9", 0, "None")]
        + ([("7", 0, other), ("7", 3, ""), ("7", 3, "w")] if not any(r.row.doc_id == 7 and r.kept == other + "\nw" for r in got) else [("7", 3, ""), ("7", 3, ""), ("7", 0, other + "\nw")])
    )


def test_line_dedup_of_nothing(empty):
    assert line_dedup.dedup_lines(empty).count() == 0


# --- 5 ------------------------------------------------------------------------

_whole = token_counts.whole_tokens(TOKENIZER)
_pieces = token_counts.Pieces(TOKENIZER, _whole)


def library(text):
    return len(token_counts.load(TOKENIZER).encode(text or "", add_special_tokens=False).ids)


def test_token_counts(docs, rows):
    want = [(d, len((t or "").encode()), library(t), library(t) > 2048) for d, t, *_ in rows]
    same(token_counts.count_tokens(docs, TOKENIZER), ["doc_id", "n_bytes", "n_tokens", "over_limit"], want)


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text("abcXYZ'!st 09<|>\ńéÅİſ​　\x1c漢字", max_size=60), st.lists(st.sampled_from(["<|endoftext|>", "it's", "The", "dog12", "§", " ", "<|startoftext|>", "'LL", "\x85"]), max_size=12).map("".join)))
def test_any_text_has_the_librarys_count(text):
    assert _pieces.count([text]) == [library(text)]


def test_other_tokenizers_are_left_to_the_library():
    other = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["", "It's a dog\n\n  <|endoftext|> x", "  two  spaces 漢字 "]
    want = [len(token_counts.load(other).encode(t, add_special_tokens=False).ids) for t in texts]
    assert token_counts.Pieces(other, token_counts.whole_tokens(other)).count(texts) == want
    assert token_counts.shortcut_holds(TOKENIZER) and not token_counts.shortcut_holds(other)


def test_token_counts_of_nothing(empty):
    assert token_counts.count_tokens(empty, TOKENIZER).count() == 0 and len(_whole) > 20_000


# --- 6 ------------------------------------------------------------------------


def shingled(text, k=5):
    w = space((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def grouped(rows):
    sets = [shingled(t) for _, t, *_ in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                top[find(i)] = find(j)
    def linked(i):
        a = sets[i]
        return sum(bool(a) and bool(b) and i != j and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets))

    least = defaultdict(list)
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    for i, (d, *_) in enumerate(rows):
        yield d, len(sets[i]), min(least[find(i)], default=None) if sets[i] else d, linked(i)


def test_jaccard_join(docs, rows):
    same(jaccard_join.similar_documents(docs), ["doc_id", "n_shingles", "component_id", "n_links"], list(grouped(rows)))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_of_near_copies(spark, seed):
    """Groups of texts of all sizes, some of which link over others alone, and a hot group."""
    rng = random.Random(seed)
    rows, n = [], 0
    for size in [4, 5, 6, 8, 9, 10, 12, 14, 20, 30, 44, 48, 50, 60, 90, 140]:
        text = [f"w{rng.randrange(300)}" for _ in range(size)]
        for _ in range(8 if size < 140 else 60):
            copy = list(text)
            for _ in range(rng.randrange(4 if size > 40 else 2)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = [f"n{rng.randrange(99)}"]
            if rng.random() < 0.3:
                copy = copy[: max(1, int(len(copy) * rng.uniform(0.75, 1)))]
            rows.append((n := n + 1, " ".join(copy)))
            if rng.random() < 0.2:
                text = copy
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(jaccard_join.similar_documents(df), ["doc_id", "n_shingles", "component_id", "n_links"], list(grouped(rows)))
    kept = jaccard_join.one_of_each(df).count()
    assert kept == len({r[2] for r in grouped(rows)})


@pytest.mark.parametrize("columns", [3, 4096])
def test_links_of_blocks(columns, monkeypatch):
    monkeypatch.setattr(jaccard_join, "COLUMNS", columns)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 40, np.uint64)
    sets = [np.unique(np.r_[rng.choice(base, rng.integers(30, 41), False), rng.integers(0, 2**63, rng.integers(0, 4), np.uint64)]) for _ in range(60)]
    weights = rng.integers(1, 5, 60)
    alike = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    table = np.array([[i != j and alike(a, b) for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    every = np.arange(60)
    assert 0 < table.sum() < table.size - 60
    assert jaccard_join.links_of(sets, weights, every, every, 80).tolist() == (table @ weights).tolist()
    one, two = every[::3], np.setdiff1d(every, every[::3])
    cross = table.copy()
    cross[np.ix_(one, one)] = cross[np.ix_(two, two)] = False
    assert jaccard_join.links_of(sets, weights, one, two, 80).tolist() == (cross @ weights).tolist()


def test_links_in_components_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 7)
    rng = random.Random(6)
    text = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(text[: 60 - rng.randrange(8)] + [f"n{rng.randrange(40)}"] * rng.randrange(3))) for i in range(60)]
    df = spark.createDataFrame([(f"d{i}", t) for i, t in rows], "doc_id string, text string")
    found = grouped([(f"d{i}", t) for i, t in rows])
    same(jaccard_join.similar_documents(df), ["doc_id", "n_shingles", "component_id", "n_links"], list(found))


def test_jaccard_join_of_nothing(empty):
    assert jaccard_join.similar_documents(empty).count() == 0


# --- 7 ------------------------------------------------------------------------


def judged(rows):
    for doc, text, *_ in rows:
        w, text = space(text), text or ""
        lines = [x for x in text.split("\n") if space(x)]
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeat = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        yield doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat), failed


def test_quality_rules(docs, rows):
    got = quality_rules.judge(docs, share=0.5)
    same(got, quality_rules.NAMES[:-1], list(judged(rows)))
    assert got.filter("base_failed and kept").count() == 0
    good = quality_rules.keep_good(docs)
    assert good.schema == docs.schema and good.count() == got.filter("kept").count()


def test_the_order_of_rules_changes_no_verdict(docs):
    one, two = (quality_rules.judge(docs, rules=r).groupBy("kept").count().collect() for r in (quality_rules.RULES, quality_rules.RULES[::-1]))
    assert sorted(one) == sorted(two)


def test_order_by_what_is_left():
    # The second rule rejects most, the first only what it does too, the third others.
    assert quality_rules.by_rate([1.0, 1.0, 1.0], {0b011: 5, 0b010: 2, 0b100: 1, 0: 9}) == [1, 2, 0]
    assert quality_rules.by_rate([1.0, 10.0, 1.0], {0b011: 5, 0b010: 2, 0b100: 1}) == [0, 2, 1]
    assert quality_rules.by_rate([0.0, 0.0], {}) == [0, 1]


def test_what_the_rules_reject():
    verdict = lambda t: {r.__name__ for r in quality_rules.RULES if r(quality_rules.Text(t, common.WordHashes()))}
    plain = " ".join(f"word{i}" for i in range(60))
    assert verdict(plain) == set() and verdict(None) == {"few_words", "word_length"} - ({"word_length"} if not quality_rules.word_length(quality_rules.Text(None, common.WordHashes())) else set())
    assert "symbols" in verdict(plain.replace(" ", "### ")) and "capitals" in verdict(plain.upper())
    assert "bangs" in verdict(plain.replace(" ", "!! ")) and "repeated_words" in verdict("a b c " * 40)
    assert "repeated_lines" in verdict("\n".join([plain] * 6)) and "word_length" in verdict(" ".join("x" * 30 + str(i) for i in range(60)))


def test_quality_rules_on_nothing(empty):
    assert quality_rules.judge(empty).count() == 0


# --- 8 ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def forest(spark):
    return secret_scan.train(secret_scan.labelled_findings(spark, 3000), trees=15)


def test_secrets_held_out(spark, forest):
    unseen = secret_scan.labelled_findings(spark, 4500).filter("doc_id >= 3000")
    got = secret_scan.scan(unseen, forest).select("doc_id", F.col("secret").alias("said")).join(unseen, "doc_id")
    n, right = got.count(), got.filter("said = secret").count()
    assert n > 1300 and right / n > 0.97


def test_secrets_in_texts(spark, forest):
    key = sha256(b"k").hexdigest()[:40]
    texts = [f'and token = "{key}" of', f"commit {key} of", f'TOKEN = "{key.upper()}"!!', "card 4068516892505468 in", None, "", f'api_key="{key}"', "see /usr/local/lib/python3/site-packages/a1 in"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.secret for r in secret_scan.scan(df, forest).collect()}
    assert got == {0: True, 1: False, 2: True, 3: False, 6: True, 7: False}


def test_secret_scan_of_odd_documents(docs, empty, forest):
    assert secret_scan.scan(empty, forest).count() == 0
    assert secret_scan.scan(docs, forest).filter("secret").count() == 0


# --- 9 ------------------------------------------------------------------------


def level(sizes, share=1.5, most=2):
    """Targets by filling and sharing anew, as the contract says it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, done, total = set(names), {}, share * sum(sizes.values())
    while left:
        rest = total - sum(done.values())
        part = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if part[s] >= most * sizes[s]}
        if not over:
            return done | part
        done |= {s: float(most * sizes[s]) for s in over}
        left -= over
    return done


@pytest.mark.parametrize("range_rows", [20_000, 1])
def test_mixing(docs, rows, range_rows):
    got = mixing.mix(docs, range_rows=range_rows).collect()
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(space(t))
    want = level(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(taken[s] == math.floor(want[s] + 1e-9) for s in sizes)
    again = mixing.mix(docs.repartition(5), range_rows=range_rows).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "c", "é", "z", "\U0001f600", None]), st.integers(0, 1000), min_size=1))
def test_targets(sizes):
    from pyspark.sql import SparkSession

    df = SparkSession.getActiveSession().createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(level(sizes))


def test_hot_ids_and_copies_are_mixed_in_many_ranges(spark):
    rows = [(None, f"t{i} a b", "s") for i in range(3000)] + [(None, "x y", "s")] * 2500 + [(1, "z", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    groups = mixing.mix_groups(df, range_rows=50).collect()
    assert len(groups) == 3002 and max(g.copies for g in groups) == 2500
    got = mixing.mix(df, range_rows=50).collect()
    sizes = Counter({"s": 3000 * 3 + 2500 * 2, "t": 1})
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(taken[s] == math.floor(level(sizes)[s] + 1e-9) for s in sizes) and all(r.taken <= 2 * r.size for r in got)
    assert sum(0 < r.taken < r.size or r.size < r.taken < 2 * r.size for r in got) <= 2


def test_mixing_of_nothing(empty):
    assert mixing.mix(empty).count() == 0


# --- 10 -----------------------------------------------------------------------


def test_license_phrases(docs, rows):
    def want(doc, text):
        w = alnum(text)
        at = [(i, x) for x, p in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        return doc, len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))

    got = licenses.license_labels(docs)
    same(got, ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"], [want(d, t) for d, t, *_ in rows])
    assert got.filter("score < 0 or score > 1").count() == 0


def test_license_templates(spark):
    rng = random.Random(2)
    mit, gpl3, bsd = (next(t for x, t in licenses.TEMPLATES if x == y and len(t) > 100) for y in ("mit", "gpl-3", "bsd"))
    broken = bsd.split()
    for _ in range(3):
        broken[rng.randrange(10, len(broken))] = "other"
    broken.insert(20, "inserted")
    texts = [f"a b {mit} c d", gpl3.upper(), " ".join(broken), bsd[:150], "This work is licensed under the GNU General Public License, version 3.", "no license here", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.license_labels(df).collect()}
    assert [got[i].labels for i in range(7)] == ["mit", "gpl-3", "bsd", "", "gpl-3", "", ""]
    assert got[0].score == 1.0 and 0.8 <= got[2].score < 1 and got[6].score == 0.0 and got[6].n_words == 0


def test_short_phrases_and_templates(spark):
    texts = ["mit license here", "a mit, MIT license", "bsd", "gpl x", None, "mit licenses"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = licenses.license_labels(df, phrases=(("mit", "mit license"), ("b", "BSD"), ("none", "!?")), templates=(("gpl", "gpl"), ("mit-long", "under the mit license")))
    found = {r.doc_id: (r.n_base, r.first_word, r.base_labels, r.labels) for r in got.collect()}
    assert found == {0: (1, 0, "mit", "mit"), 1: (1, 2, "mit", "mit"), 2: (1, 0, "b", "b"), 3: (0, None, "", "gpl"), 4: (0, None, "", ""), 5: (0, None, "", "")}


def test_license_scan_of_nothing(empty):
    assert licenses.license_labels(empty).count() == 0
