"""Scoring texts by a gated recurrent language model with a class-factored softmax.

Tokens of all training texts are counted with Spark. The most frequent words are the model's: equal
classes by rank, a softmax over classes, and one over the words of a class. All other words are one
more class, within which a word has its smoothed share of the counts; so every text has a probability.

Each task trains the network on its own training texts, from the same start, and Spark averages the
parameters, weighted by tokens. Texts stand end to end in lanes that advance together. The state is
carried from window to window until the text ends; every window is learned from, by backpropagation
within the window. For scoring, the state is carried through whole texts. The network starts as the
unigram distribution, which training can only refine.

Counts of the most frequent ``KNOWN`` words go to the tasks, whose size is so bounded; the others are
joined. A null text is an empty one: its only token is the end.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Workspace

END = b""
CLASSES = SIZE = 64
HEAD = CLASSES * SIZE
STATE = 16
KNOWN = 1 << 18
LONGEST = 64
LANES = 512
#: Tokens of a lane in training, on average: with shorter ones a small table would be learned from in few steps.
LANE_TOKENS = 2048
WINDOW = 16
RATE = 0.05
#: Tokens that a task holds at once.
HELD = 1_500_000
SMOOTH = 0.1


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts, one after another, and how many each text has; its end is not among them."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words = parts.flatten()
    real = pc.greater(pc.binary_length(words), 0)  # white space at an edge leaves an empty piece
    edges = np.concatenate([[0], np.cumsum(parts.value_lengths().to_numpy(), dtype=np.int64)])
    seen = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real).cast(pa.binary()), np.diff(seen[edges])


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(parts: list[pa.Array], texts: int) -> pa.RecordBatch:
        counts = pc.value_counts(pa.concat_arrays(parts))
        columns = [pa.concat_arrays([counts.field(0), pa.array([END], pa.binary())])]
        columns += [pa.concat_arrays([counts.field(1), pa.array([texts], pa.int64())])]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    parts, held, texts = [], 0, 0
    for batch in batches:
        words, _ = words_of(batch.column(0))
        parts.append(words)
        held, texts = held + len(words), texts + len(batch)
        if held > HELD:
            yield rows(parts, texts)
            parts, held, texts = [], 0, 0
    if texts:
        yield rows(parts, texts)


class Words:
    """The known words with their counts, most frequent first, and the sums over all words."""

    def __init__(self, rows: list[tuple[bytes, int]], tokens: int, distinct: int):
        self.known = pa.array([word for word, _ in rows], pa.binary())
        self.end = pc.index(self.known, END).as_py()  # -1 if not known
        self.counts = np.array([n for _, n in rows], np.float64)
        self.tokens, self.distinct = tokens, distinct
        head = self.counts[:HEAD]
        self.tail_tokens = tokens - int(head.sum())
        self.tail_distinct = distinct - len(head)

    @cached_property
    def number(self) -> dict[bytes, int]:
        return {word: i for i, word in enumerate(self.known.to_pylist())}

    def base(self, count: float | np.ndarray):
        return np.log10((count + SMOOTH) / (self.tokens + SMOOTH * (self.distinct + 1)))

    def in_tail(self, count: float | np.ndarray):
        """log10 of a word's share of the words that are not the model's."""
        return np.log10((count + SMOOTH) / (self.tail_tokens + SMOOTH * (self.tail_distinct + 1)))


class Network:
    """Gated recurrent units over word rows, classes and words of classes.

    Within a window the features stand in rows and the lanes or tokens in columns, so that every step is over long
    rows. The last row of ``to_class`` and of each ``to_word`` is the bias.
    """

    NAMES = ("rows", "turn", "to_class", "to_word")

    def __init__(self, words: Words):
        random = np.random.default_rng(0)
        head = np.zeros(HEAD)
        head[: min(HEAD, len(words.counts))] = words.counts[:HEAD]
        known = np.arange(HEAD) < len(words.counts)
        mass = np.append(head.reshape(CLASSES, SIZE).sum(axis=1), words.tail_tokens)
        self.rows = random.normal(0, 0.3, (HEAD + 1, 3 * STATE)).astype(np.float32)
        self.turn = random.normal(0, 0.2, (STATE, 3 * STATE)).astype(np.float32)
        self.to_class = np.zeros((STATE + 1, CLASSES + 1), np.float32)
        self.to_class[STATE] = np.log(mass + SMOOTH)
        self.to_word = np.zeros((CLASSES, STATE + 1, SIZE), np.float32)
        self.to_word[:, STATE] = np.where(known, np.log(head + SMOOTH), -1e4).reshape(CLASSES, SIZE)
        self.squares = {name: np.full(getattr(self, name).shape, 1e-6, np.float32) for name in self.NAMES}

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in self.NAMES])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for name in self.NAMES:
            part = getattr(self, name)
            setattr(self, name, flat[at : at + part.size].reshape(part.shape).astype(np.float32))
            at += part.size
        return self

    def learn(self, name: str, gradient: np.ndarray, at=slice(None)) -> None:
        """A step against a gradient, shorter for parameters that have moved much."""
        step = self.squares[name][at] + gradient * gradient
        self.squares[name][at] = step
        np.sqrt(step, out=step)
        np.divide(gradient, step, out=step)
        step *= RATE
        getattr(self, name)[at] -= step

    def run(self, inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool):
        """States of a window's steps, and what the way back needs. ``fresh``: texts that begin."""
        # of each step the rows become its gates, hold and reset, and the new state
        gates = np.ascontiguousarray(self.rows[inputs].transpose(0, 2, 1))
        turn, state = np.ascontiguousarray(self.turn.T), np.ascontiguousarray(state.T, gates.dtype)
        states = np.empty((len(inputs), STATE, inputs.shape[1]), gates.dtype)
        before, inner = (np.empty_like(states), np.empty_like(states)) if keep else (None, None)
        for step, begins in enumerate(fresh.any(axis=1).tolist()):
            if begins:
                state = np.where(fresh[step], gates.dtype.type(0), state)
            turned = turn @ state
            both, new = gates[step, : 2 * STATE], gates[step, 2 * STATE :]
            both += turned[: 2 * STATE]
            np.negative(both, out=both)
            np.exp(both, out=both)
            both += 1
            np.reciprocal(both, out=both)
            if keep:
                before[step], inner[step] = state, turned[2 * STATE :]
            added = turned[2 * STATE :]
            added *= both[STATE:]
            new += added
            np.tanh(new, out=new)
            out = states[step]
            np.subtract(state, new, out=out)
            out *= both[:STATE]
            out += new
            state = out
        return states.transpose(0, 2, 1), (gates, before, inner)

    def back(self, inputs: np.ndarray, fresh: np.ndarray, past: tuple, wanted: np.ndarray) -> None:
        """Backpropagation through the window's steps; ``wanted``: gradients by the states."""
        gates, before, inner = past
        hold, reset, new = (gates[:, at : at + STATE] for at in (0, STATE, 2 * STATE))
        # by the state's gradient: those of what is turned, and of the new state's own sum
        by_new = (1 - hold) * (1 - new * new)
        turned = np.empty_like(gates)
        turned[:, :STATE] = (before - new) * hold * (1 - hold)
        turned[:, STATE : 2 * STATE] = by_new * inner * reset * (1 - reset)
        turned[:, 2 * STATE :] = by_new * reset
        owns = np.ascontiguousarray(wanted.transpose(0, 2, 1))
        later = np.zeros_like(owns[0])
        for step in range(len(inputs) - 1, -1, -1):
            own = owns[step]
            own += later
            parts = turned[step].reshape(3, STATE, -1)
            parts *= own
            later = self.turn @ turned[step]
            later += own * hold[step]
            if fresh[step].any():
                later[:, fresh[step]] = 0
        parts = by_feature(turned)
        self.learn("turn", by_feature(before) @ parts.T)
        parts[2 * STATE :] = by_feature(owns * by_new)
        # a word's gradient is the sum over its tokens
        seen = np.bincount(inputs.ravel(), minlength=HEAD + 1) > 0
        words, own = np.flatnonzero(seen), (np.cumsum(seen) - 1)[inputs.ravel()]
        rows = np.empty((len(words), 3 * STATE), parts.dtype)
        for i, part in enumerate(parts):
            rows[:, i] = np.bincount(own, part, len(words))
        self.learn("rows", rows, words)

    def outcome(self, states: np.ndarray, targets: np.ndarray, learn: bool):
        """Log probabilities of targets, of the model's other class for HEAD; gradients if asked."""
        # tokens in the order of their classes: the products are by class, all else is done for all at once
        kinds = np.minimum(targets // SIZE, CLASSES).astype(np.uint8)
        order = np.argsort(kinds, kind="stable")
        edges = np.searchsorted(kinds[order], np.arange(CLASSES + 1)).tolist()
        spans = [(kind, slice(*edge)) for kind, edge in enumerate(pairwise(edges)) if edge[0] < edge[1]]
        part = np.ones((STATE + 1, len(order)), states.dtype)
        part[:STATE] = np.take(states.T, order, axis=1)
        to_class, deep = lowered(self.to_class)
        found, shares, sums = softmax(to_class.T @ part, kinds[order], deep)
        own = slice(edges[-1])
        logits = np.empty((SIZE, edges[-1]), states.dtype)
        to_word, deep = lowered(self.to_word)
        for kind, span in spans:
            np.matmul(to_word[kind].T, part[:, span], out=logits[:, span])
        words = targets[order[own]] % SIZE
        hit, word_shares, word_sums = softmax(logits, words, deep)
        found[own] += hit
        places = np.empty_like(order)
        places[order] = np.arange(len(order))
        result = found[places]
        if not learn:
            return result, None
        # the shares are left undivided: what they are multiplied by is smaller
        shares[kinds[order], np.arange(len(order))] -= sums
        by_state = self.to_class[:STATE] @ shares
        by_state /= sums
        to_class = (part / sums) @ shares.T
        if spans:
            word_shares[words, np.arange(len(words))] -= word_sums
            scaled = part[:, own] / word_sums
            by_word = np.empty((STATE, len(words)), states.dtype)
            to_word = np.empty((len(spans), STATE + 1, SIZE), states.dtype)
            for i, (kind, span) in enumerate(spans):
                np.matmul(self.to_word[kind, :STATE], word_shares[:, span], out=by_word[:, span])
                np.matmul(scaled[:, span], word_shares[:, span].T, out=to_word[i])
            by_word /= word_sums
            by_state[:, own] += by_word
            self.learn("to_word", to_word, [kind for kind, _ in spans])
        self.learn("to_class", to_class)
        return result, np.take(by_state, places, axis=1).T


def by_feature(window: np.ndarray) -> np.ndarray:
    """(feature, token) of a window's (step, feature, lane)."""
    return np.ascontiguousarray(window.transpose(1, 0, 2)).reshape(window.shape[1], -1)


def lowered(weights: np.ndarray) -> tuple[np.ndarray, bool]:
    """Weights of the same shares whose products with any state, which is within -1 and 1, are at most 0, so that no
    exponential overflows; and whether all of a state's might be too far below 0 for their exponentials."""
    spread = np.abs(weights[..., :STATE, :]).sum(axis=-2)
    result = weights.copy()
    result[..., STATE, :] -= (weights[..., STATE, :] + spread).max(axis=-1, keepdims=True)
    return result, bool(spread.max() > 40)


def softmax(logits: np.ndarray, picked: np.ndarray, deep: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probabilities of the picked row of each column; all shares, which take the logits' place, and their sums."""
    if deep:
        logits -= logits.max(axis=0, initial=-np.inf)
    found = logits[picked, np.arange(len(picked))]
    shares = np.exp(logits, out=logits)
    sums = shares.sum(axis=0)
    return found - np.log(sums), shares, sums


class Lanes:
    """Texts end to end in lanes of about equal length, the longest lane first."""

    def __init__(self, texts: list[np.ndarray], end: int, most: int = LANES):
        heap = [(0, lane) for lane in range(min(LANES, most, len(texts)))]
        held: list[list[int]] = [[] for _ in heap]
        for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
            size, lane = heapq.heappop(heap)
            held[lane].append(i)
            heapq.heappush(heap, (size + len(texts[i]), lane))
        held.sort(key=lambda lane: -sum(len(texts[i]) for i in lane))
        self.sizes = np.array([sum(len(texts[i]) for i in lane) for lane in held])
        self.starts = np.cumsum(self.sizes) - self.sizes
        order = [i for lane in held for i in lane]
        lengths = np.array([len(texts[i]) for i in order])
        # one lane after the other: a lane may be many times as long as most
        self.targets = np.concatenate([texts[i] for i in order]).astype(np.int32)
        self.owner = np.repeat(np.array(order, np.int32), lengths)
        self.inputs = np.concatenate([[np.int32(end)], self.targets[:-1]])
        self.inputs[self.starts] = end
        self.fresh = np.zeros(len(self.targets), bool)
        self.fresh[np.cumsum(lengths) - lengths] = True

    def windows(self, steps: int, tokens: int):
        """(inputs, fresh, targets, owners) of each window, for the lanes that still have texts: of ``steps``
        steps, or of up to 16 times as many if so few lanes are left that it has less than ``tokens``."""
        start = 0
        while lanes := int((self.sizes > start).sum()):
            size = min(max(steps, tokens // lanes), 16 * steps, int(self.sizes[0]) - start)
            at = np.arange(start, start + size)[:, None]
            real = at < self.sizes[:lanes]
            place = np.where(real, self.starts[:lanes] + at, 0)
            inputs, targets = np.where(real, self.inputs[place], HEAD), np.where(real, self.targets[place], -1)
            yield inputs, self.fresh[place] & real, targets, self.owner[place]
            start += size


def train(network: Network, texts: list[np.ndarray], end: int) -> None:
    lanes = Lanes(texts, end, max(1, sum(map(len, texts)) // LANE_TOKENS))
    state = np.zeros((len(lanes.sizes), STATE), np.float32)
    for inputs, fresh, targets, _ in lanes.windows(WINDOW, 32 * WINDOW):
        states, past = network.run(inputs, fresh, state[: inputs.shape[1]], True)
        state = states[-1]
        real = np.flatnonzero(targets >= 0)
        flat = by_feature(states.transpose(0, 2, 1))
        wanted = np.zeros_like(flat)
        wanted[:, real] = network.outcome(np.take(flat, real, axis=1).T, targets.ravel()[real], True)[1].T
        network.back(inputs, fresh, past, wanted.reshape(STATE, *inputs.shape).transpose(1, 2, 0))


def score(network: Network, texts: list[np.ndarray], end: int) -> np.ndarray:
    """Natural log probability of each text, its words beyond the model's only by their class."""
    lanes, sums = Lanes(texts, end), np.zeros(len(texts))
    state = np.zeros((len(lanes.sizes), STATE), np.float32)
    for inputs, fresh, targets, owner in lanes.windows(WINDOW, 32 * WINDOW):
        states, _ = network.run(inputs, fresh, state[: inputs.shape[1]], False)
        state = states[-1]
        real = np.flatnonzero(targets >= 0)
        flat = by_feature(states.transpose(0, 2, 1))
        found, _ = network.outcome(np.take(flat, real, axis=1).T, targets.ravel()[real], False)
        sums += np.bincount(owner.ravel()[real], found, len(texts))
    return sums


OTHERS = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))


def listed(names: pa.Array, codes: np.ndarray, owner: np.ndarray, texts: int) -> list[list[bytes]]:
    """The words of each text, which are numbers of ``names``, in order."""
    words, edges = names.take(pa.array(codes)).to_pylist(), np.searchsorted(owner, np.arange(texts + 1))
    return [words[a:b] for a, b in pairwise(edges.tolist())]


def counted(names: pa.Array, codes: np.ndarray, owner: np.ndarray, texts: int) -> list[pa.ListArray]:
    """One array: the different words of each text, and how often it has each."""
    pairs, times = np.unique(owner * len(names) + codes, return_counts=True)
    edges = np.searchsorted(pairs, np.arange(texts + 1) * len(names)).astype(np.int32)
    fields = [names.take(pa.array(pairs % max(1, len(names)))), pa.array(times, pa.int64())]
    return [pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(fields, fields=list(OTHERS.value_type)))]


def gathered(
    batches: Iterator[pa.RecordBatch], words: Words, others_of: Callable[..., list] | None = listed
) -> Iterator[tuple[pa.Table, list[np.ndarray], list]]:
    """The rows of batches of about ``HELD`` tokens, with each text's known numbers (-1: not known) and what
    ``others_of`` makes of each batch's unknown words. The texts are the first column."""
    end = words.end
    rows: list[pa.RecordBatch] = []
    texts: list[np.ndarray] = []
    others: list = []
    held = 0
    for batch in batches:
        parts, counts = words_of(batch.column(0))
        coded = parts.dictionary_encode()
        codes = coded.indices.to_numpy()
        ids = pc.fill_null(pc.index_in(coded.dictionary, value_set=words.known), -1).to_numpy()[codes]
        ends = np.cumsum(counts)
        texts += np.split(np.insert(ids, ends, end), np.cumsum(counts + 1))[:-1]
        if others_of:
            names, unknown = coded.dictionary, ids < 0
            codes, owner = codes[unknown], np.repeat(np.arange(len(batch)), counts)[unknown]
            if end < 0:  # each text's end is unknown as well; no word is empty
                names = pa.concat_arrays([names, pa.array([END], pa.binary())])
                at = np.searchsorted(owner, np.arange(len(batch)), side="right")
                codes, owner = np.insert(codes, at, len(names) - 1), np.insert(owner, at, np.arange(len(batch)))
            others += others_of(names, codes, owner, len(batch))
        held += len(ids) + len(batch)
        rows.append(batch)
        if held > HELD:
            yield pa.Table.from_batches(rows), texts, others
            rows, texts, others, held = [], [], [], 0
    if texts:
        yield pa.Table.from_batches(rows), texts, others


def in_model(ids: np.ndarray) -> np.ndarray:
    """Numbers of the model's words; HEAD for all others."""
    return np.where((ids < 0) | (ids >= HEAD), HEAD, ids)


def split_as(
    texts: list[np.ndarray], made: Callable[[np.ndarray], np.ndarray], wanted: Callable[[np.ndarray], np.ndarray] | None = None
) -> list[np.ndarray]:
    """What is made of the numbers of all texts at once, of the wanted ones if asked, by text."""
    ids, edges = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    if wanted:
        taken = wanted(ids)
        ids, edges = ids[taken], np.concatenate([[0], np.cumsum(taken)])[edges]
    values = made(ids)
    return [values[a:b] for a, b in pairwise(edges.tolist())]


def fit(training: DataFrame, text: str, words: Words, workspace: Workspace) -> np.ndarray:
    """The parameters of the networks that the tasks train, averaged by tokens."""
    end = words.end if words.end >= 0 else HEAD

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, seen = Network(words), 0
        for _, texts, _ in gathered(batches, words, None):
            train(network, split_as(texts, in_model), end)
            seen += sum(map(len, texts))
        if seen:
            flat = network.flat()
            columns = [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat.astype(np.float64) * seen), pa.array(np.full(len(flat), float(seen)))]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "value", "weight"])

    parts = training.select(text).mapInArrow(local, "at int, value double, weight double")
    mean = parts.groupBy("at").agg((F.sum("value") / F.sum("weight")).alias("value"))
    # as many rows as the network has parameters
    found = workspace.keep(mean, "network").toArrow()
    flat = Network(words).flat()
    flat[found.column("at").to_numpy()] = found.column("value").to_numpy()
    return flat


def score_documents(
    docs: DataFrame, training: str, workspace: Workspace, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, the boolean column ``training``, n_tokens, n_known, train_tokens, base_score, score.

    Every row is scored. Learning is from the rows whose ``training`` is true; without any, all words
    are unknown. Equal rows get equal scores but for the order in which lanes add up.
    """
    counts = docs.where(training).select(text).mapInArrow(count_words, "word binary, n long")
    counts = workspace.keep(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    short = counts.where(F.octet_length("word") <= LONGEST)
    # the least count of which, with all larger ones, there are at most KNOWN words
    sizes = short.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(KNOWN).toArrow()
    large = sizes.column("n").to_numpy()[np.cumsum(sizes.column("words").to_numpy()) <= KNOWN]
    least = int(large.min()) if len(large) else 1 << 62
    # at most KNOWN words of at most LONGEST bytes
    top = short.where(F.col("n") >= least).toArrow()
    known = sorted(zip(top.column("word").to_pylist(), top.column("n").to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    words = Words(known, *sums)
    flat = fit(docs.where(training), text, words, workspace)
    end = words.end if words.end >= 0 else HEAD

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, row = Network(words).load(flat), TaskContext.get().partitionId() << 33
        base, tail = words.base(words.counts), words.in_tail(words.counts)
        for rows, texts, others in gathered(batches, words, counted):
            models = score(network, split_as(texts, in_model), end) / math.log(10)
            out: dict[str, list] = {"n_tokens": [len(x) for x in texts]}
            known = split_as(texts, lambda ids: base[ids], lambda ids: ids >= 0)
            rest = split_as(texts, lambda ids: tail[ids], lambda ids: ids >= HEAD)
            out["n_known"] = [len(x) for x in known]
            out["base"] = [float(x.sum()) for x in known]
            out["model"] = [model + float(x.sum()) for model, x in zip(models.tolist(), rest, strict=True)]
            own = {"row": row + np.arange(len(texts)), **out, "others": pa.chunked_array(others, OTHERS)}
            row += len(texts)
            table = pa.table({"key": rows.column("key"), "training": rows.column("training"), **own})
            yield from table.combine_chunks().to_batches()

    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"key {kind}, training boolean, row long, n_tokens long, n_known long, base double, model double, "
        "others array<struct<word: binary, times: long>>"
    )
    rows = docs.select(F.col(text).alias("text"), F.col(key).alias("key"), F.col(training).alias("training"))
    rows = workspace.keep(rows.mapInArrow(scored, schema), "scored")
    others = rows.select("row", F.inline("others")).join(counts, "word", "left")
    count = F.coalesce("n", F.lit(0)) + F.lit(SMOOTH)
    base_sum = math.log10(words.tokens + SMOOTH * (words.distinct + 1))
    tail_sum = math.log10(words.tail_tokens + SMOOTH * (words.tail_distinct + 1))
    added = others.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("known"),
        F.sum("times").alias("times"),
        F.sum(F.col("times") * F.log10(count)).alias("logs"),
    )
    zero = F.lit(0)
    times, logs = F.coalesce("times", zero), F.coalesce("logs", F.lit(0.0))
    return rows.join(added, "row", "left").select(
        F.col("key").alias(key),
        "training",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", zero)).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - times * base_sum).alias("base_score"),
        (F.col("model") + logs - times * tail_sum).alias("score"),
    )
