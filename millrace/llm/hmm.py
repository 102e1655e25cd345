"""A hidden Markov language model: trained by Baum-Welch over partitions, scored by the exact forward recursion.

Every training word has emission counts of its own in every state, kept as a table, and so has the end of a
text. Training has three parts, each over all training sequences: pair counts of coarse classes of words give a first
guess of the states; Baum-Welch rounds follow until the likelihood gains no more than a tolerance, in which
words beyond the frequent ones have the emissions of their ending (a bucket); a last pass counts for each of these
words how often each state emitted it. A state emits a word of a bucket by those counts, mixed with the corpus
frequencies by Witten and Bell's rule, where everything never seen is one more word. So the model is a
distribution over the same tokens as smoothed word frequencies, and the scores compare.

Arrays: ``start (K)``, ``move (K, K)``, ``emit (K, S)``; symbols are the frequent words, the buckets, and the end, ``S - 1``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of, stage

STATES = 6
# Words that have emissions of their own while the states are formed, and the buckets of endings that the others share then.
FREQUENT = 8192
BUCKETS = 1024
# Classes for the first guess: so many words, and so many buckets (a divisor of BUCKETS).
COARSE_WORDS, COARSE_BUCKETS = 255, 256
# Words that every task knows by number, about 30 bytes each with their row of the emission table; those of all others are joined.
KNOWN_WORDS = 1 << 18
# Rounds go on while a token's mean log probability gains more than this, in nats.
TOLERANCE = 0.01
# Training and scoring run the parts of longer sequences side by side, with the results of whole ones.
TRAIN_WINDOW = 2048
SCORE_WINDOW = 2048
# Words whose expected counts a task holds before it hands them on.
HELD_WORDS = 400_000
_SCALE = 1 << 20
_LOG10 = np.log(10.0)


def bucket_of(word: str, buckets: int) -> int:
    """Words with one ending share a bucket: endings tell languages and kinds of text apart."""
    return zlib.crc32(word[-3:].encode()) % buckets


def bucket_column(word: Column, buckets: int) -> Column:
    return F.crc32(F.substring(word, -3, 3).cast("binary")) % buckets


@dataclass
class Vocabulary:
    """The words known by number, most frequent first, with their counts, and the sizes of the buckets of those not frequent."""

    words: dict[str, int]
    counts: np.ndarray
    own: int  # so many are frequent
    bucket_words: np.ndarray
    bucket_tokens: np.ndarray

    def __post_init__(self) -> None:
        self.bucket = np.array([bucket_of(w, self.buckets) for w in list(self.words)[self.own :]], dtype=np.int64)

    @property
    def buckets(self) -> int:
        return len(self.bucket_words)

    @property
    def known(self) -> int:
        return len(self.words)

    def encode(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """``(words, rank, position, offsets)`` of a batch of texts.

        ``words`` are the distinct ones, ``rank`` their places among the known words or -1. Text ``i`` is
        ``position[offsets[i]:offsets[i + 1]]``, places in ``words``.
        """
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        # white space at a text's ends leaves empty strings
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        rank = np.fromiter((self.words.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        position = np.asarray(coded.indices)
        offsets = np.asarray(split.offsets) - np.asarray(split.offsets)[0]
        empty = words.index("") if "" in words else -1
        if empty >= 0:
            real = position != empty
            before = np.concatenate([[0], np.cumsum(real)])
            position, offsets = position[real], before[offsets]
        return coded.dictionary, rank, position, offsets


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def from_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, frequency: np.ndarray) -> Model:
        """Expected counts as probabilities; every symbol keeps a share of its smoothed overall frequency."""
        smooth = (frequency + 1) / (frequency + 1).sum()
        emit = emit + 20.0 * smooth
        move, start = move + 0.1, start + 0.1
        return cls(
            start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True)
        )


def _ordered(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences from the longest to the shortest: where they begin, and their lengths."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    return order, lengths[order]


def posteriors(
    model: Model, symbols: np.ndarray, offsets: np.ndarray, window: int = TRAIN_WINDOW
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """``(places, gammas, start, move, log)``: what Baum-Welch expects of sequences, ``symbols[offsets[i]:offsets[i + 1]]`` each.

    ``gammas[j]`` are the probabilities of the states at ``symbols[places[j]]``; ``start`` and ``move`` expected counts,
    ``log`` the log likelihood. Sequences are cut into windows; all windows of one number of steps to go are processed
    together. The states before a window and the message from what follows it are carried over the cut by
    transfer matrices, so the counts are those of whole sequences.
    """
    states = len(model.start)
    cuts = np.concatenate([np.arange(a, b, window) for a, b in zip(offsets, offsets[1:])] + [offsets[-1:]]).astype(np.int64)
    first = np.isin(cuts[:-1], offsets[:-1])
    before, after = _carried(model, symbols, offsets, cuts, window)
    order, lengths = _ordered(cuts)
    begins, first, before, after = cuts[:-1][order], first[order], before[order], after[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # windows longer than t
    total = np.concatenate([[0], np.cumsum(active)])
    step = np.repeat(np.arange(steps), active)
    places = begins[np.arange(int(total[-1])) - total[step]] + step
    # counts need no more than single precision; emissions of a token are scaled to a maximum of 1
    likely = np.ascontiguousarray(model.emit.T)
    top = likely.max(axis=1)
    emit = (likely / top[:, None]).astype(np.float32)[symbols[places]]
    move_by, before, after = model.move.astype(np.float32), before.astype(np.float32), after.astype(np.float32)
    alphas = np.empty((int(total[-1]), states), dtype=np.float32)
    scales = np.empty((int(total[-1]), 1), dtype=np.float32)
    alpha = np.where(first[:, None], model.start.astype(np.float32), before @ move_by)
    for t in range(steps):
        n, here = active[t], slice(total[t], total[t + 1])
        alpha = (alpha[:n] if t == 0 else alpha[:n] @ move_by) * emit[here]
        scale = alpha.sum(axis=1, keepdims=True)
        alpha /= scale
        alphas[here], scales[here] = alpha, scale
    move = np.zeros((states, states))
    gammas = alphas.copy()
    emit /= scales
    back = np.ascontiguousarray(move_by.T)
    beta = np.ones((0, states), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        n, here = active[t], slice(total[t], total[t + 1])
        beta = np.concatenate([beta, after[len(beta) : n]]) if n > len(beta) else beta
        gammas[here] *= beta
        weighted = beta * emit[here]
        earlier = alphas[total[t - 1] : total[t - 1] + n] if t else np.where(first[:, None], np.float32(0), before)
        move += earlier.T @ weighted
        beta = weighted @ back
    move *= model.move
    start = gammas[: active[0]][first].sum(axis=0, dtype=float) if steps else np.zeros(states)
    log = np.log(scales, dtype=float).sum() + np.log(top)[symbols[places]].sum()
    return places, gammas, start, move, float(log)


def expected_counts(
    model: Model, symbols: np.ndarray, offsets: np.ndarray, window: int = TRAIN_WINDOW
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch counts ``(start, move, emit)`` and the log likelihood, see :func:`posteriors`."""
    states, size = model.emit.shape
    places, gammas, start, move, log = posteriors(model, symbols, offsets, window)
    seen = symbols[places]
    return start, move, np.stack([np.bincount(seen, weights=gammas[:, k], minlength=size) for k in range(states)]), log


def _carried(model: Model, symbols: np.ndarray, offsets: np.ndarray, cuts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window between ``cuts`` the states of the step before it, and the scaled backward message at its last step."""
    states = len(model.start)
    before, after = np.zeros((len(cuts) - 1, states)), np.ones((len(cuts) - 1, states))
    spans = [(a, b) for a, b in zip(offsets.tolist(), offsets[1:].tolist()) if b - a > window]
    if not spans:
        return before, after
    owner, begins, later, place, ends, logs = _transfers(model, symbols, spans, window)
    at = np.searchsorted(cuts, begins)
    last = np.empty((len(owner), states))
    for j in range(len(owner)):
        if not later[j]:
            last[j] = ends[place[j]]
            continue
        before[at[j]] = last[j - 1]
        log = logs[place[j] : place[j] + states]
        last[j] = (last[j - 1] * np.exp(log - log.max())) @ ends[place[j] : place[j] + states]
        last[j] /= last[j].sum()
    for j in range(len(owner) - 2, -1, -1):
        if later[j + 1]:
            log = logs[place[j + 1] : place[j + 1] + states]
            message = np.exp(log - log.max()) * (ends[place[j + 1] : place[j + 1] + states] @ after[at[j + 1]])
            after[at[j]] = message / (last[j] @ message)
    return before, after


def _transfers(
    model: Model, symbols: np.ndarray, spans: list[tuple[int, int]], window: int, given: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, ...]:
    """The parts of the sequences ``spans``: ``(owner, begins, later, place, ends, logs)``.

    With ``given = (which, factors)`` the emission of the token at ``i`` is multiplied by ``factors[which[i]]``.

    ``ends[place[j]]`` are the scaled states after part ``j`` and ``logs`` the logarithm of their scale: one row
    from the start for a sequence's first part, one from every state before it for a later one.
    """
    states = len(model.start)
    emit = np.ascontiguousarray(model.emit.T)
    owner, begins, lengths, rows = [], [], [], []
    for i, (a, b) in enumerate(spans):
        for c in range(a, b, window):
            owner.append(i)
            begins.append(c)
            lengths.append(min(window, b - c))
            rows.append(c != a)
    owner, begins = np.array(owner, dtype=np.int64), np.array(begins, dtype=np.int64)
    lengths, later = np.array(lengths, dtype=np.int64), np.array(rows, dtype=bool)
    copies = np.where(later, states, 1)
    part = np.repeat(np.arange(len(owner)), copies)
    state = np.arange(len(part)) - np.repeat(np.cumsum(copies) - copies, copies)
    # the first step of a later part moves from the given state, that of a first part starts
    init = np.where(later[part][:, None], model.move[state], model.start)
    order = np.argsort(-lengths[part], kind="stable")
    run, at, alpha = lengths[part][order], begins[part][order], init[order]
    logs = np.zeros(len(part))
    ends = np.empty((len(part), states))
    steps = int(run[0]) if len(run) else 0
    active = np.searchsorted(-run, -np.arange(steps), side="left")
    for t in range(steps):
        n = active[t]
        if n < len(alpha):
            ends[n : len(alpha)] = alpha[n:]
            alpha = alpha[:n]
        if t:
            alpha = alpha @ model.move
        alpha = alpha * emit[symbols[at[:n] + t]]
        if given is not None:
            alpha *= given[1][given[0][at[:n] + t]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        logs[:n] += np.log(scale)
    ends[: len(alpha)] = alpha
    back = np.empty(len(part), dtype=np.int64)
    back[order] = np.arange(len(part))
    ends, logs = ends[back], logs[back]
    place = np.cumsum(copies) - copies
    return owner, begins, later, place, ends, logs


def log_likelihood(
    model: Model,
    symbols: np.ndarray,
    offsets: np.ndarray,
    window: int = SCORE_WINDOW,
    given: tuple[np.ndarray, np.ndarray] | None = None,
) -> np.ndarray:
    """Natural logarithm of every sequence's exact probability, by the scaled forward recursion.

    Long sequences are cut into parts. The first part runs from the start states; for each other part
    the recursion runs from every state at once, side by side with all other parts, and the resulting
    transfer matrices are multiplied in order. The result is that of one long recursion.
    """
    states = len(model.start)
    count = len(offsets) - 1
    owner, _, later, place, ends, logs = _transfers(model, symbols, list(zip(offsets.tolist(), offsets[1:].tolist())), window, given)
    result = np.zeros(count)
    vector: dict[int, np.ndarray] = {}
    for j, i in enumerate(owner):
        if not later[j]:
            vector[i] = ends[place[j]]
            result[i] = logs[place[j]]
            continue
        weight, log = ends[place[j] : place[j] + states], logs[place[j] : place[j] + states]
        top = log.max()
        moved = (vector[i] * np.exp(log - top)) @ weight
        total = moved.sum()
        vector[i] = moved / total
        result[i] += top + np.log(total)
    return result


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, c)``: how often each word occurs in ``docs (text)``, lower-cased in A-Z, counted per piece first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 16 << 20):
            words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch["text"], ""))).flatten()
            counts = pc.value_counts(words)
            yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], ["word", "n"])

    counted_ = docs.select("text").mapInArrow(counted, "word string, n bigint").filter("word != ''")
    return counted_.groupBy("word").agg(F.sum("n").alias("c"))


def most_frequent(counts: DataFrame, limit: int) -> Column:
    """A condition on ``(word, c)`` that about the ``limit`` most frequent words fulfil, and no more; of equal counts a hashed choice.

    Found by counting words per range of counts, and per hash in the range that is cut: a bounded number of rows.
    """
    band = F.when(F.col("c") < 1024, F.col("c")).otherwise(384 + F.floor(64 * F.log2(F.col("c").cast("double"))))
    left, cut = limit, None
    for row in sorted(counts.groupBy(band.alias("band")).count().collect(), reverse=True):
        if row["count"] > left:
            cut = row["band"]
            break
        left -= row["count"]
    if cut is None:
        return F.lit(True)
    place = F.pmod(F.xxhash64("word"), F.lit(4096))
    below = 0
    for row in sorted(counts.filter(band == cut).groupBy(place.alias("place")).count().collect()):
        if row["count"] > left:
            break
        left -= row["count"]
        below = row["place"] + 1
    return (band > cut) | ((band == cut) & (place < below))


def vocabulary(counts: DataFrame, frequent: int = FREQUENT, buckets: int = BUCKETS, known: int = KNOWN_WORDS) -> Vocabulary:
    """The most frequent words and what the buckets hold of those not frequent; the driver gets ``known + buckets`` rows at most."""
    chosen = most_frequent(counts, known)
    top = counts.filter(chosen).toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    words, c = top["word"].to_pylist(), top["c"].to_numpy()
    own = min(frequent, len(words))
    rare = np.array([bucket_of(w, buckets) for w in words[own:]], dtype=np.int64)
    bucket_words = np.bincount(rare, minlength=buckets).astype(float)
    bucket_tokens = np.bincount(rare, weights=c[own:], minlength=buckets)
    held = counts.filter(~chosen).groupBy(bucket_column(F.col("word"), buckets).alias("b"))
    for row in held.agg(F.count("*").alias("v"), F.sum("c").alias("c")).collect():
        bucket_words[row["b"]] += row["v"]
        bucket_tokens[row["b"]] += row["c"]
    return Vocabulary({w: i for i, w in enumerate(words)}, c, own, bucket_words, bucket_tokens)


def encoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per row of ``docs (row, text, …)`` its tokens; further columns stay.

    ``tokens`` (four bytes each) are ranks of frequent words, then the number of those for the end of the text, then one more than
    the ranks of other known words, then places in ``rare``, the text's distinct words that are not known, whose ``buckets``
    (two bytes each) are listed too.
    """
    names = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"{c} {kind}" for c, kind in docs.dtypes if c != "text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = vocabulary.own, vocabulary.known
        for batch in pieces_of(batches, "text"):
            words, rank, position, offsets = vocabulary.encode(batch["text"])
            values = words.to_numpy(zero_copy_only=False).tolist()
            bucket = np.fromiter(
                (bucket_of(w, vocabulary.buckets) if r < 0 else 0 for w, r in zip(values, rank.tolist())), dtype="<u2", count=len(values)
            )
            code = np.where(rank >= own, rank + 1, rank)
            packed, rare_at, sizes, held = [], [], [], []
            for i in range(batch.num_rows):
                mine = position[offsets[i] : offsets[i + 1]]
                token = code[mine]
                unknown, places = np.unique(mine[token < 0], return_inverse=True)
                token[token < 0] = places + known + 1
                packed.append(np.append(token, own).astype("<u4").tobytes())
                rare_at.append(unknown)
                sizes.append(len(unknown))
                held.append(bucket[unknown].tobytes())
            flat = pa.array(np.concatenate(rare_at) if rare_at else [], pa.int64())
            rare = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), words.take(flat).cast(pa.string()))
            columns = {
                "n_tokens": pa.array(np.diff(offsets).astype(np.int64) + 1),
                "tokens": pa.array(packed, pa.binary()),
                "rare": rare,
                "buckets": pa.array(held, pa.binary()),
            }
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], *columns.values()], [*names, *columns])

    return docs.mapInArrow(of, f"{schema}, n_tokens bigint, tokens binary, rare array<string>, buckets binary")


def _sequences(batch: pa.RecordBatch, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(symbols, offsets, number, bucket)`` of all texts of a batch.

    ``number`` is 0 for frequent words and the end, then counts the known words that are not frequent, then the batch's
    unknown words, row after row; ``bucket[number - 1]`` is the bucket of such a word.
    """
    packed = batch["tokens"].to_pylist()
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int64)
    token = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int64)
    held = batch["buckets"].to_pylist()
    bucket = np.concatenate([v.bucket, np.frombuffer(b"".join(held), dtype="<u2").astype(np.int64)])
    before = np.repeat(np.cumsum([0, *(len(h) // 2 for h in held)])[:-1], np.diff(offsets))
    number = np.where(token > v.known, token + before, token) - v.own
    number[token <= v.own] = 0
    symbol = np.where(token == v.own, v.own + v.buckets, token)
    rare = number > 0
    symbol[rare] = v.own + bucket[number[rare] - 1]
    return symbol, offsets, number, bucket


def pair_counts(documents: DataFrame, coarse: np.ndarray, v: Vocabulary) -> np.ndarray:
    """How often a class follows a class, over all ``documents (tokens, buckets)``; ``coarse`` is the class of each symbol."""
    size = int(coarse.max()) + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size * size, dtype=np.int64)
        for batch in pieces_of(batches, "tokens", 4 << 20):
            symbols, offsets, _, _ = _sequences(batch, v)
            classes = coarse[symbols]
            inner = np.ones(max(0, len(classes) - 1), dtype=bool)
            inner[offsets[1:-1] - 1] = False
            held += np.bincount((classes[:-1] * size + classes[1:])[inner], minlength=size * size)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["at", "n"])

    rows = documents.select("tokens", "buckets").mapInArrow(counted, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    table = rows.toArrow()  # a row per pair of classes
    found = np.zeros(size * size)
    found[table["at"].to_numpy()] = table["n"].to_numpy()
    return found.reshape(size, size)


def guessed(pairs: np.ndarray, coarse: np.ndarray, frequency: np.ndarray, states: int, rounds: int = 200, seed: int = 7) -> Model:
    """A model whose states explain the counts of ``pairs`` of classes, by expectation maximisation on that matrix alone."""
    rng = np.random.default_rng(seed)
    classes = len(pairs)
    overall = np.bincount(coarse, weights=frequency + 0.01, minlength=classes)
    emit = overall * rng.uniform(0.2, 1.8, (states, classes))
    emit /= emit.sum(axis=1, keepdims=True)
    joint = np.full((states, states), 0.1) + 0.9 * states * np.eye(states)
    joint /= joint.sum()
    share = (pairs + 1e-3) / (pairs + 1e-3).sum()
    for _ in range(rounds):
        ratio = share / (emit.T @ joint @ emit)
        grown = emit * (joint @ emit @ ratio.T + joint.T @ emit @ ratio)
        joint *= emit @ ratio @ emit.T
        emit = grown / grown.sum(axis=1, keepdims=True) + 1e-12
    within = (frequency + 0.01) / overall[coarse]
    start = joint.sum(axis=1)
    move = joint / np.maximum(start[:, None], 1e-300) + 1e-6
    full = emit[:, coarse] * within
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), full / full.sum(axis=1, keepdims=True))


def trained(documents: DataFrame, vocabulary: Vocabulary, ends: int, states: int = STATES, tolerance: float = TOLERANCE) -> Model:
    """Baum-Welch over all ``documents (tokens, buckets)``, from the guess that :func:`pair_counts` gives, until it gains little.

    Every round goes over all of all sequences. Tasks send expected counts per symbol, rounded to 2^-20, whose sums do
    not depend on their order; as many rows reach the driver as there are symbols.
    """
    own, buckets = vocabulary.own, vocabulary.buckets
    frequency = np.concatenate([vocabulary.counts[:own], vocabulary.bucket_tokens, [ends]]).astype(float)
    size = len(frequency)
    words = min(own, COARSE_WORDS)
    by_ending = [words + bucket_of(w, COARSE_BUCKETS) for w in list(vocabulary.words)[words:own]]
    coarse = np.array([*range(words), *by_ending, *(words + b % COARSE_BUCKETS for b in range(buckets)), words + COARSE_BUCKETS])
    model = guessed(pair_counts(documents, coarse, vocabulary), coarse, frequency, states)
    reached = -np.inf
    while True:
        current = model

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, move, emit, log = np.zeros(states), np.zeros((states, states)), np.zeros((states, size)), 0.0
            for batch in pieces_of(batches, "tokens", 3 << 20):
                s, m, e, gained = expected_counts(current, *_sequences(batch, vocabulary)[:2])
                start, move, emit, log = start + s, move + m, emit + e, log + gained
            # rows: symbols, then one row per state for the moves, then the start, then the log likelihood
            last = np.zeros((1, states))
            last[0, 0] = log
            table = np.rint(np.concatenate([emit.T, move, start[None], last]) * _SCALE).astype(np.int64)
            used = np.flatnonzero(table.any(axis=1))
            columns = [pa.array(used), *[pa.array(table[used, k]) for k in range(states)]]
            yield pa.RecordBatch.from_arrays(columns, ["at", *[f"k{k}" for k in range(states)]])

        schema = "at bigint, " + ", ".join(f"k{k} bigint" for k in range(states))
        sums = documents.select("tokens", "buckets").mapInArrow(counted, schema).groupBy("at").agg(
            *[F.sum(f"k{k}").alias(f"k{k}") for k in range(states)]
        ).toArrow()
        table = np.zeros((size + states + 2, states))
        table[sums["at"].to_numpy()] = np.stack([sums[f"k{k}"].to_numpy() for k in range(states)], axis=1) / _SCALE
        model = Model.from_counts(table[-2], table[size:-2], table[:size].T, frequency)
        mean = table[-1, 0] / max(1.0, frequency.sum())
        if mean - reached <= tolerance:
            return model
        reached = mean


def emission_table(documents: DataFrame, model: Model, v: Vocabulary) -> DataFrame:
    """``(number, word, c, shares)`` of all words of ``documents (tokens, rare, buckets)`` that are not frequent.

    Known words have a number, from 0 on, the others their text. ``shares`` packs, a byte per state, the part of the
    word's ``c`` occurrences that each state is expected to have emitted.
    """
    states = len(model.start)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = len(v.bucket)
        numbered = np.zeros((known, states + 1))
        index: dict[str, int] = {}
        sums = np.zeros((1024, states + 1))

        def rows(number: list | np.ndarray, words: list, held: np.ndarray) -> pa.RecordBatch:
            table = np.rint(held * 1024).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), pa.array(words, pa.string()), pa.array(table[:, -1] >> 10), *[pa.array(table[:, k]) for k in range(states)]],
                ["number", "word", "n", *names],
            )

        for batch in pieces_of(batches, "tokens", 3 << 20):
            symbols, offsets, number, _ = _sequences(batch, v)
            places, gammas, *_ = posteriors(model, symbols, offsets)
            at = number[places]
            gammas = np.concatenate([gammas, np.ones((len(gammas), 1))], axis=1)
            mine = (at > 0) & (at <= known)
            coded = batch["rare"].flatten().dictionary_encode()
            words = coded.dictionary.to_pylist()
            to = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=len(words))
            if len(index) > len(sums):
                sums = np.concatenate([sums, np.zeros((max(len(sums), len(index) - len(sums)), states + 1))])
            other = at > known
            code = np.asarray(coded.indices)[at[other] - known - 1]
            for k in range(states + 1):
                numbered[:, k] += np.bincount(at[mine] - 1, weights=gammas[mine, k], minlength=known)
                sums[to, k] += np.bincount(code, weights=gammas[other, k], minlength=len(words))
            if len(index) > HELD_WORDS:
                yield rows([None] * len(index), list(index), sums[: len(index)])
                sums[: len(index)] = 0
                index.clear()
        used = np.flatnonzero(numbered[:, -1])
        yield rows(used, [None] * len(used), numbered[used])
        yield rows([None] * len(index), list(index), sums[: len(index)])

    names = [f"k{k}" for k in range(states)]
    schema = "number bigint, word string, n bigint, " + ", ".join(f"{k} bigint" for k in names)
    summed = documents.select("tokens", "rare", "buckets").mapInArrow(counted, schema).groupBy("number", "word").agg(
        F.sum("n").alias("c"), *[F.sum(k).alias(k) for k in names]
    )
    whole = sum((F.col(k) for k in names[1:]), F.col(names[0]))
    shares = [F.shiftleft(F.round(255 * F.col(k) / whole).cast("long"), 8 * i) for i, k in enumerate(names)]
    return summed.select("number", "word", "c", sum(shares[1:], shares[0]).alias("shares"))


def unpacked(shares: np.ndarray, states: int) -> np.ndarray:
    """The states' parts as rows that sum to 1."""
    parts = shares.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :states].astype(float)
    return parts / np.maximum(parts.sum(axis=1, keepdims=True), 1e-300)


@dataclass
class Emissions:
    """How the words of a bucket share what a state emits from it."""

    vocabulary: Vocabulary
    state_tokens: np.ndarray  # (buckets, K): occurrences by bucket and state
    states: int

    def frequencies(self, c: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Of words found ``c`` times: their smoothed part of the bucket, whatever the state."""
        return (c + 1.0) / (self.vocabulary.bucket_tokens[bucket] + self.vocabulary.bucket_words[bucket] + 1.0)

    def factors(self, c: np.ndarray, parts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """What a state's own counts change of :meth:`frequencies`, per word and state; ``parts`` as from :func:`unpacked`."""
        held = self.state_tokens[bucket]
        kinds = self.vocabulary.bucket_words[bucket][:, None]
        mixed = np.where(held > 0, kinds / np.maximum(held + kinds, 1e-300), 1.0)
        own = c[:, None] * parts / np.maximum(held, 1e-300) / self.frequencies(c, bucket)[:, None]
        return np.where(held > 0, (1 - mixed) * own, 0.0) + mixed


def emissions(table: DataFrame, vocabulary: Vocabulary, states: int) -> tuple[Emissions, np.ndarray]:
    """Sums of the emission table by bucket, and the shares of the known words by number; bounded numbers of rows reach the driver."""
    numbered = table.filter("number is not null").select("number", "shares").toArrow()
    shares = np.zeros(len(vocabulary.bucket), dtype=np.int64)
    shares[numbered["number"].to_numpy()] = numbered["shares"].to_numpy()
    parts = unpacked(shares, states) * vocabulary.counts[vocabulary.own :, None]
    found = np.stack([np.bincount(vocabulary.bucket, weights=parts[:, k], minlength=vocabulary.buckets) for k in range(states)], axis=1)
    own = [F.shiftrightunsigned("shares", 8 * k).bitwiseAND(F.lit(255)) for k in range(states)]
    whole = sum(own[1:], own[0])
    sums = table.filter("number is null").groupBy(bucket_column(F.col("word"), vocabulary.buckets).alias("b")).agg(
        *[F.sum(F.col("c") * p / whole).alias(f"k{k}") for k, p in enumerate(own)]
    )
    for row in sums.collect():
        found[row["b"]] += row[1:]
    return Emissions(vocabulary, found, states), shares


def scored(docs: DataFrame, training: Column, states: int = STATES, tolerance: float = TOLERANCE) -> DataFrame:
    """``(doc_id, training, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs (doc_id, text, …)``.

    Learns from the rows where ``training`` holds. Tokens are the words of the whole text, A-Z in lower
    case, then one end; null and empty texts are the end alone. Scores are log10 probabilities:
    ``base_score`` under word frequencies with one added to each count and one word for all unseen ones,
    ``score`` under the hidden Markov model. Without training rows both give every token the same. Equal
    rows get equal scores; a null ``doc_id`` is scored like any other. At most eight states.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), training.alias("training"), "text")
    counts = stage(word_counts(rows.filter("training")), "hmm-counts")
    n_train = rows.filter("training").count()
    words, tokens = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    total, distinct = tokens + n_train, words + (n_train > 0)
    vocab = vocabulary(counts)

    keyed = rows.select("doc_id", "training", F.monotonically_increasing_id().alias("row"), "text")
    documents = stage(encoded(keyed, vocab), "hmm-documents", compression="zstd")
    learnt = documents.filter("training")
    model = trained(learnt, vocab, n_train, states, tolerance)
    table = stage(emission_table(learnt, model, vocab), "hmm-emissions")
    shared, known_shares = emissions(table, vocab, states)

    # rows of the table for words that are not known, brought to the documents that hold them
    places = documents.select("row", F.posexplode("rare").alias("place", "word"))
    others = places.join(table.filter("number is null").drop("number"), "word")
    found = others.groupBy("row").agg(F.collect_list(F.struct("place", "c", "shares")).alias("found"))
    joined = documents.drop("rare").join(found, "row", "left").select(
        "doc_id", "training", "n_tokens", "tokens", "buckets", "found.place", "found.c", "found.shares"
    )

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = vocab.own, len(vocab.bucket)
        own_log = np.log(np.append(vocab.counts[:own], [n_train, 0]) + 1.0)
        known_c = vocab.counts[own:]
        known_factors = shared.factors(known_c, unpacked(known_shares, states), vocab.bucket)
        known_inside = np.log(shared.frequencies(known_c, vocab.bucket))
        for batch in pieces_of(batches, "tokens", 3 << 20):
            symbols, offsets, number, bucket = _sequences(batch, vocab)
            bucket = bucket[known:]
            c, shares = np.zeros(len(bucket), dtype=np.int64), np.zeros(len(bucket), dtype=np.int64)
            sizes = np.array([len(b) // 2 for b in batch["buckets"].to_pylist()], dtype=np.int64)
            at = np.repeat(np.cumsum(sizes) - sizes, np.asarray(pc.fill_null(pc.list_value_length(batch["place"]), 0)))
            at = at + batch["place"].flatten().to_numpy(zero_copy_only=False)
            c[at] = batch["c"].flatten().to_numpy(zero_copy_only=False)
            shares[at] = batch["shares"].flatten().to_numpy(zero_copy_only=False)
            factors = np.concatenate([np.ones((1, states)), known_factors, shared.factors(c, unpacked(shares, states), bucket)])
            hidden = log_likelihood(model, symbols, offsets, given=(number, factors))
            inside = np.concatenate([[0.0], known_inside, np.log(shared.frequencies(c, bucket))])[number]
            frequent = np.where(symbols < own, symbols, np.where(symbols == own + vocab.buckets, own, own + 1))
            base = own_log[frequent] + np.concatenate([[0.0], np.log(known_c + 1.0), np.log(c + 1.0)])[number]
            is_known = np.where(number > known, np.concatenate([[0], c > 0])[np.maximum(number - known, 0)], (frequent != own) | (n_train > 0))
            sums = np.concatenate([np.zeros((1, 3)), np.cumsum(np.stack([inside, base, is_known], axis=1), axis=0)])
            by_text = sums[offsets[1:]] - sums[offsets[:-1]]
            kept = ["doc_id", "training", "n_tokens"]
            more = [pa.array(np.rint(by_text[:, 2]).astype(np.int64)), pa.array(by_text[:, 1]), pa.array(hidden + by_text[:, 0])]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *more], [*kept, "n_known", "base", "hidden"])

    run = joined.mapInArrow(forward, "doc_id bigint, training boolean, n_tokens bigint, n_known bigint, base double, hidden double")
    each = float(np.log(total + distinct + 1.0))
    return run.select(
        "doc_id",
        "training",
        "n_tokens",
        "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"),
        ((F.col("base") - F.col("n_tokens") * each) / _LOG10).alias("base_score"),
        (F.col("hidden") / _LOG10).alias("score"),
    )
