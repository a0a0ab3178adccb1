"""Language-model scoring with a hidden Markov model.

A latent state emits a symbol.  Each word that training has seen often is a
symbol of its own; the others share symbols by hash, and such a class emits the
word by the word's share of it:

    P(text) = sum over state paths of prod A[s', s] B[s, symbol] * prod P(word | symbol)

Word counts and Baum-Welch's expected counts are summed over all training
texts by Spark.  Symbols grow in number with the corpus: each further frequent
word is one, and so is each further ``CLASS_TOKENS`` tokens of other words.
Training and scoring are exact over whole texts: a long text is worked on in
stretches side by side, and matrices from each stretch's first state to its
last carry the forward and backward recursions over the cuts.

Counts of the most frequent words are broadcast, up to a fixed number; those
of all other words reach the texts by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WordHashes, text_key, written

STATES = 6
#: Rounds of training at most, and the share by which the log likelihood must rise for another one.
ROUNDS, TOLERANCE = 6, 0.002
#: A word seen so often in training is a symbol of its own, if it is among the FREQUENT ones.
OWN = 32
#: All rounds of training but the last join symbols into these: the most frequent words, and classes of the others.
COARSE_WORDS, COARSE_CLASSES = 1 << 14, 1 << 12
#: Other words share symbols: a power of two of them, one for so many of these words' tokens, and so many at most.
CLASS_TOKENS, MOST_CLASSES = 256, 1 << 20
#: Long texts are worked on in stretches of so many tokens, side by side.
STRETCH = 4096
#: So many words' counts are broadcast (some 40 bytes each with their states); the rest are joined.
FREQUENT = 1_000_000
#: Tokens that are worked on together.
GROUP = 1_000_000
#: No word has a space, so this stands for the end of a text.
END = np.uint64(xxhash.xxh3_64_intdigest(b" "))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def token_hashes(words: WordHashes, text: str | None) -> np.ndarray:
    return np.append(words.of((text or "").encode().lower().split()), END)


def _token_groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows and their tokens, so many at a time that there are about GROUP tokens."""
    words = WordHashes()
    for b in batches:
        start, size, found = 0, 0, []
        for i, text in enumerate(b.column(column)):
            found.append(token_hashes(words, text.as_py()))
            size += len(found[-1])
            if size >= GROUP:
                yield b.slice(start, i + 1 - start), found
                start, size, found = i + 1, 0, []
        if found:
            yield b.slice(start), found


# --- counts ------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept, size = [], 0

    def out():
        h, c = np.unique(np.concatenate(kept), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c, pa.int64())], names=["h", "c"])

    for _, found in _token_groups(batches, 0):
        kept += found
        size += sum(map(len, found))
        if size >= 2_000_000:
            yield out()
            kept, size = [], 0
    if kept:
        yield out()


@dataclass
class Symbols:
    """The words that are symbols of their own, by hash, and how many classes the others share."""

    own: np.ndarray
    classes: int

    def of(self, hashes: np.ndarray) -> np.ndarray:
        shared = len(self.own) + (hashes & np.uint64(self.classes - 1)).astype(np.int64)
        if not len(self.own):
            return shared
        at = np.minimum(np.searchsorted(self.own, hashes), len(self.own) - 1)
        return np.where(self.own[at] == hashes, at, shared)


def _encoded(sent):
    """Each text's symbols, four bytes a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _token_groups(batches, 0):
            flat = sent.value.of(np.concatenate(found)).astype(np.int32)
            data = [x.tobytes() for x in np.split(flat, np.cumsum([len(x) for x in found])[:-1])]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], names=["symbols"])

    return run


# --- the model ---------------------------------------------------------------


@dataclass
class Model:
    start: np.ndarray  # [state]
    moves: np.ndarray  # [state, next state]
    emits: np.ndarray  # [symbol, state]


@dataclass
class Lockstep:
    """Sequences side by side, the longest first, so that step t is one slice of all that reach it."""

    order: np.ndarray
    counts: np.ndarray
    offsets: np.ndarray
    flat: np.ndarray

    @classmethod
    def of(cls, sequences: list[np.ndarray]) -> Lockstep:
        lengths = np.array([len(s) for s in sequences])
        order = np.argsort(-lengths, kind="stable")
        counts = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), side="right")
        offsets = np.r_[0, np.cumsum(counts)]
        flat = np.zeros(offsets[-1], np.int64)
        for i, k in enumerate(order):
            flat[offsets[: lengths[k]] + i] = sequences[k]
        return cls(order, counts, offsets, flat)


def _forward(model: Model, sequences: list[np.ndarray], enter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From weights of the first states, [sequence, ways, state], to weights of the last ones, each sequence's
    scaled to a sum of 1, and the natural logs of the scales."""
    steps = Lockstep.of(sequences)
    state, logs = enter[steps.order], np.zeros(len(sequences))
    n_ways, k = state.shape[1:]
    for t, n in enumerate(steps.counts):
        seen = model.emits[steps.flat[steps.offsets[t] : steps.offsets[t] + n]]
        now = state[:n] if t == 0 else (state[:n].reshape(-1, k) @ model.moves).reshape(n, n_ways, k)
        now = now * seen[:, None, :]
        scale = now.sum((1, 2))
        state[:n] = now / scale[:, None, None]
        logs[:n] += np.log(scale)
    out, out_logs = np.empty_like(state), np.empty(len(sequences))
    out[steps.order], out_logs[steps.order] = state, logs
    return out, out_logs


def _chunks(sequences: list[np.ndarray], which: list[int]) -> Iterator[list[int]]:
    """The numbers in lists of about GROUP tokens."""
    chunk, size = [], 0
    for i in which:
        chunk.append(i)
        size += len(sequences[i])
        if size >= GROUP:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _cut(sequences: list[np.ndarray], stretch: int) -> tuple[list[np.ndarray], list[range]]:
    """All sequences' stretches, and which are whose."""
    parts, spans = [], []
    for s in sequences:
        first = len(parts)
        parts += [s[i : i + stretch] for i in range(0, len(s), stretch)]
        spans.append(range(first, len(parts)))
    return parts, spans


def _passages(model: Model, parts: list[np.ndarray], which: list[int]) -> tuple[dict[int, np.ndarray], dict[int, float]]:
    """For each of these stretches the matrix from its first state's weights to its last state's, and its scale's log."""
    matrices, logs = {}, {}
    for chunk in _chunks(parts, which):
        ways = np.broadcast_to(np.eye(STATES, dtype=model.emits.dtype), (len(chunk), STATES, STATES))
        found, scales = _forward(model, [parts[i] for i in chunk], ways)
        for i, m, x in zip(chunk, found, scales, strict=True):
            matrices[i], logs[i] = m, x
    return matrices, logs


def likelihoods(model: Model, sequences: list[np.ndarray], stretch: int = STRETCH) -> np.ndarray:
    """log10 of each symbol sequence's probability."""
    parts, spans = _cut(sequences, stretch)
    total = np.zeros(len(sequences))
    short = [k for k, span in enumerate(spans) if len(span) == 1]
    if short:
        enter = np.broadcast_to(model.start, (len(short), 1, STATES))
        total[short] = _forward(model, [sequences[k] for k in short], enter)[1]
    matrices, logs = _passages(model, parts, [i for span in spans if len(span) > 1 for i in span])
    for k, span in enumerate(spans):
        enter = model.start
        for i in span if len(span) > 1 else ():
            state = enter @ matrices[i]
            total[k] += logs[i] + np.log(state.sum())
            enter = state / state.sum() @ model.moves
    return total / np.log(10)


def expected_counts(model: Model, sequences: list[np.ndarray], stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions of the sequences, by forward and backward recursion, and their log likelihood."""
    model = Model(*(x.astype(np.float32) for x in (model.start, model.moves, model.emits)))
    parts, spans = _cut(sequences, stretch)
    n = len(parts)
    enter, before, behind = (np.empty((n, STATES), np.float32) for _ in range(3))
    matrices, _ = _passages(model, parts, [i for span in spans if len(span) > 1 for i in span])
    is_first = np.zeros(n, bool)
    for span in spans:
        is_first[span[0]] = True
        enter[span[0]], before[span[0]], behind[span[-1]] = model.start, 0, 1
        for i in span[:-1]:
            state = enter[i] @ matrices[i]
            before[i + 1] = state / state.sum()
            enter[i + 1] = before[i + 1] @ model.moves
        for i in span[:0:-1]:
            back = model.moves @ (matrices[i] @ behind[i])
            behind[i - 1] = back / back.sum()
    start, moves, emitted, total = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros(model.emits.shape), 0.0
    for chunk in _chunks(parts, list(range(n))):
        more = _expected(model, [parts[i] for i in chunk], enter[chunk], before[chunk], behind[chunk], is_first[chunk], emitted)
        start, moves, total = start + more[0], moves + more[1], total + more[2]
    return start, moves * model.moves, emitted, total


def _expected(model, parts, enter, before, behind, is_first, emitted) -> tuple[np.ndarray, np.ndarray, float]:
    """Counts of stretches with the weights of their first states and of what is before and behind them."""
    steps = Lockstep.of(parts)
    o, counts, order = steps.offsets, steps.counts, steps.order
    seen = model.emits[steps.flat]
    forward, scale = np.empty_like(seen), np.empty(len(seen), np.float32)
    for t, n in enumerate(counts):
        here = slice(o[t], o[t] + n)
        f = seen[here] * (enter[order] if t == 0 else forward[o[t - 1] : o[t - 1] + n] @ model.moves)
        scale[here] = s = f.sum(1)
        forward[here] = f / s[:, None]
    lengths = np.array([len(x) for x in parts])[order]
    last = forward[o[lengths - 1] + np.arange(len(order))]
    backward = behind[order] / (last * behind[order]).sum(1, keepdims=True)
    passed, after = np.zeros((STATES, STATES)), 0
    for t in range(len(counts) - 1, -1, -1):
        n, here = counts[t], slice(o[t], o[t] + counts[t])
        if after:
            there = slice(o[t + 1], o[t + 1] + after)
            ahead = seen[there] * backward[:after] / scale[there][:, None]
            passed += forward[o[t] : o[t] + after].T @ ahead
            backward[:after] = ahead @ model.moves.T
        if t == 0:  # the moves over the cuts
            passed += before[order].T @ (seen[here] * backward / scale[here][:, None])
        forward[here] *= backward[:n]  # the states' probabilities at t
        after = n
    for k in range(STATES):
        emitted[:, k] += np.bincount(steps.flat, forward[:, k], len(emitted))
    return forward[: len(order)][is_first[order]].sum(0), passed, float(np.log(scale, dtype=np.float64).sum())


#: Stands for the likelihood among the counts; starts are -1, and moves from state k are -2 - k.
_LIKELIHOOD = -2 - STATES


def _expect(sent):
    """Of the model and the symbols that it knows each symbol by: rows of symbol, or of what else is counted below 0, with a value for each state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = sent.value
        start, moves, emits, likelihood = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros(model.emits.shape), np.zeros(STATES)
        group, size = [], 0

        def add():
            *more, total = expected_counts(model, group)
            for counts, x in zip((start, moves, emits), more, strict=True):
                counts += x
            likelihood[0] += total

        for b in batches:
            for data in b.column(0):
                found = np.frombuffer(data.as_py(), np.int32)
                group.append(found if known is None else known[found])
                size += len(group[-1])
                if size >= GROUP:
                    add()
                    group, size = [], 0
        if group:
            add()
        used = np.flatnonzero(emits.any(1))
        g = np.r_[-1, np.arange(-2, -2 - STATES, -1), _LIKELIHOOD, used]
        values = np.vstack([start, moves, likelihood, emits[used]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(g, pa.int32()), *(pa.array(values[:, k].astype(np.float32)) for k in range(STATES))], names=["g", *(f"s{k}" for k in range(STATES))]
        )

    return run


def coarser(counts: np.ndarray, classes: int) -> np.ndarray:
    """The coarse symbol of each symbol: the own words by their counts, then the classes."""
    coarse = np.r_[np.arange(len(counts)), np.arange(classes)] & (COARSE_CLASSES - 1)
    top = np.argsort(-counts, kind="stable")[:COARSE_WORDS]
    coarse += len(top)
    coarse[top] = np.arange(len(top))
    return coarse


def fit(encoded: DataFrame, shares: np.ndarray, coarse: np.ndarray, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> Model:
    """Baum-Welch from states that differ by chance and tend to stay; the driver sees a row for each symbol a round.

    Rounds work on coarse symbols, until the log likelihood rises by less than
    ``tolerance`` of it; a last one counts how often each state emits each symbol.
    Overall shares, of one token for each symbol, are added to a state's emissions.
    """
    context, names = encoded.sparkSession.sparkContext, [f"s{k}" for k in range(STATES)]

    def improved(model: Model, known: np.ndarray | None, shares: np.ndarray) -> tuple[Model, float]:
        sent = context.broadcast((Model(model.start, model.moves, model.emits.astype(np.float32)), known))
        rows = encoded.mapInArrow(_expect(sent), "g int, " + ", ".join(f"{n} float" for n in names))
        table = rows.groupBy("g").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        sent.unpersist()
        size = len(shares)
        counts = np.zeros((size + STATES + 2, STATES))
        counts[table["g"].to_numpy()] = np.stack([table[n].to_numpy() for n in names], 1)  # numbers below 0 are at the end
        start, moves = counts[-1] + 1, counts[-1 - STATES : -1][::-1] + 1
        emits = counts[:size] + size * shares[:, None]
        return Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0)), counts[_LIKELIHOOD][0]

    together = np.bincount(coarse, shares)
    noise = np.random.default_rng(7).uniform(0.5, 1.5, (len(together), STATES))
    emits = together[:, None] * noise
    moves = np.full((STATES, STATES), 0.05 / (STATES - 1))
    np.fill_diagonal(moves, 0.95)
    model = Model(np.full(STATES, 1 / STATES), moves, emits / emits.sum(0))
    before = None
    for _ in range(rounds - 1):
        model, now = improved(model, coarse, together)
        if before is not None and now - before < tolerance * abs(before):
            break
        before = now
    # The states' posteriors are those of the coarse model; a symbol's share of its coarse one is the same in all states.
    return improved(Model(model.start, model.moves, model.emits[coarse]), None, shares)[0]


# --- scores ------------------------------------------------------------------


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, symbols, frequent, logs, sizes = sent.value
        head = pa.struct([("n", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64())])
        for b, found in _token_groups(batches, 2):
            flat = np.concatenate(found)
            doc = np.repeat(np.arange(len(found)), [len(x) for x in found])
            kinds, at = np.unique(flat, return_inverse=True)
            place = np.minimum(np.searchsorted(frequent, kinds), max(len(frequent) - 1, 0))
            known = frequent[place] == kinds if len(frequent) else np.zeros(len(kinds), bool)
            value = np.where(known, logs[place], 0.0) if len(frequent) else np.zeros(len(kinds))
            is_known = known[at]
            n_known = np.bincount(doc[is_known], minlength=len(found))
            total = np.bincount(doc, value[at], len(found))
            emitted = symbols.of(kinds)[at]
            shares = np.bincount(doc, sizes[emitted], len(found))
            ends = np.cumsum([len(x) for x in found])[:-1]
            score = likelihoods(model, np.split(emitted, ends)) - shares
            heads = pa.StructArray.from_arrays(
                [pa.array([len(x) for x in found], pa.int64()), pa.array(n_known, pa.int64()), pa.array(total), pa.array(score)],
                fields=list(head),
            )
            n = len(found)
            names = ["doc_id", "text_key", "h", "n", "head"]
            # A row for the text; its h, of which n is 0, only spreads these rows in the join.
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(1), pa.array(np.zeros(n), pa.int32()), heads], names=names)
            rare = ~is_known
            pair, times = np.unique(doc[rare] * len(kinds) + at[rare], return_counts=True)
            who = pa.array(pair // len(kinds))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(who), b.column(1).take(who), pa.array(kinds[pair % len(kinds)].view(np.int64)),
                 pa.array(times, pa.int32()), pa.nulls(len(pair), head)], names=names,
            )

    return run


def score(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, frequent: int = FREQUENT, own: int = OWN
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the texts whose crc32(doc_id as text) mod 5 isn't 1,
    and scores all.  Tokens are the lower-cased words and one end.  A null text
    counts as an empty one: its end alone.  A null id counts as training; ids
    are of any type.  Repeated rows are scored, and learned from, each.  Other
    columns are ignored.  An empty table gives no rows.  Words are told apart by
    64-bit hashes.  A class keeps room for one unknown word.
    """
    base = documents.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    context = documents.sparkSession.sparkContext
    train = base.filter(~held_out(F.col("doc_id"))).select("text")
    vocabulary = written(
        train.mapInArrow(_count, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")), "vocabulary"
    )
    # Words by the size of their count, in steps of 1/16 of a doubling: the frequent ones
    # are those of the uppermost steps that together hold no more words than are broadcast.
    step = F.floor(F.log2("c") * 16).cast("int")
    rows = vocabulary.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("c").alias("tokens")).collect()
    steps = sorted(((r["step"], r["words"]) for r in rows), reverse=True)
    total, kinds = sum(r["tokens"] for r in rows), sum(r["words"] for r in rows)
    edge, held = 1 << 30, 0
    for at, words in steps:
        held += words
        if held > frequent:
            break
        edge = at
    table = vocabulary.filter(step >= edge).toArrow()
    h, c = table["h"].to_numpy().view(np.uint64), table["c"].to_numpy()
    by_hash = np.argsort(h)
    h, c = h[by_hash], c[by_hash]
    is_own = c >= own
    shared = total - int(c[is_own].sum())
    symbols = Symbols(h[is_own], 1 << min(MOST_CLASSES.bit_length() - 1, max(1, shared // CLASS_TOKENS).bit_length() - 1))
    others = vocabulary.filter((step < edge) | (F.col("c") < own))
    by_class = others.groupBy(F.pmod("h", F.lit(symbols.classes)).alias("g")).agg(F.sum("c").alias("n"), F.count("*").alias("v"))
    table = by_class.toArrow()  # a row for each class at most
    n, v = np.zeros(symbols.classes), np.zeros(symbols.classes)
    n[table["g"].to_numpy()], v[table["g"].to_numpy()] = table["n"].to_numpy(), table["v"].to_numpy()
    sizes = np.r_[c[is_own] + 0.5, n + 0.5 * (v + 1)]
    sent_symbols = context.broadcast(symbols)
    encoded = written(train.mapInArrow(_encoded(sent_symbols), "symbols binary"), "symbols")
    model = fit(encoded, sizes / sizes.sum(), coarser(c[is_own], symbols.classes), rounds)
    sent = context.broadcast((model, symbols, h, np.log10(c + 0.5), np.log10(sizes)))
    rest = vocabulary.filter(step < edge)
    rows = base.mapInArrow(
        _score(sent),
        f"doc_id {kind}, text_key bigint, h bigint, n int, head struct<n:bigint,known:bigint,logs:double,score:double>",
    )
    rest = rest.select(F.col("h").alias("rh"), "c")
    logs = F.coalesce(F.col("n") * F.log10(F.col("c") + 0.5), F.lit(0.0))
    joined = rows.join(rest, F.col("h") == F.col("rh"), "left").select(
        "doc_id", "text_key", "head", logs.alias("logs"), F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("known")
    )
    copies = F.count("head")
    summed = joined.groupBy("doc_id", "text_key").agg(
        copies.alias("copies"),
        (F.sum("head.n") / copies).cast("bigint").alias("n_tokens"),
        ((F.coalesce(F.sum("head.known"), F.lit(0)) + F.sum("known")) / copies).cast("bigint").alias("n_known"),
        ((F.sum("head.logs") + F.sum("logs")) / copies).alias("logs"),
        (F.sum("head.score") / copies).alias("score"),
    )
    logs = F.col("logs") + (F.col("n_tokens") - F.col("n_known")) * float(np.log10(0.5))
    return summed.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(total + 0.5 * (kinds + 1)))).alias("base_score"),
        (logs + F.col("score")).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def op2_lm_score(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
