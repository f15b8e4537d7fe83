"""A small gated recurrent language model in numpy: forward windows, truncated backpropagation, packing of documents.

The vocabulary is ``CLASSES`` classes of ``CLASS_WORDS`` frequent words; one more class stands for every other word.  The output
softmax is factored: class first, then the word in its class.  The input is the word before, other words
by one of ``OTHER_INPUTS`` hash buckets.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, fields

import numpy as np

HIDDEN = 32
CLASSES, CLASS_WORDS = 32, 32
WORDS = CLASSES * CLASS_WORDS
OTHER_INPUTS = 256
WINDOW = 32
#: States of one class that are multiplied by its words at a time in learning.
BLOCK = 16


@dataclass
class Parameters:
    """``input``: what a word adds to the gates; ``state``: what the state adds; then both softmax layers."""

    input: np.ndarray  # word or bucket, 3 * HIDDEN: update gate, reset gate, candidate
    state: np.ndarray  # HIDDEN, 3 * HIDDEN
    class_weight: np.ndarray  # HIDDEN, CLASSES + 1
    class_bias: np.ndarray
    word_weight: np.ndarray  # CLASSES, HIDDEN, CLASS_WORDS
    word_bias: np.ndarray  # CLASSES, CLASS_WORDS

    @classmethod
    def initial(cls, counts: np.ndarray, other: float) -> Parameters:
        """Weights near zero, biases such that the model begins at the smoothed word frequencies."""
        rng = np.random.default_rng(1)

        def small(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.1).astype(np.float32)

        share = np.full(WORDS, 0.5)
        share[:len(counts)] += counts
        by_class = share.reshape(CLASSES, CLASS_WORDS)
        total = np.concatenate((by_class.sum(axis=1), [other]))
        return cls(
            small(WORDS + OTHER_INPUTS, 3 * HIDDEN), small(HIDDEN, 3 * HIDDEN), small(HIDDEN, CLASSES + 1) * np.float32(0.1),
            np.log(total / total.sum()).astype(np.float32), small(CLASSES, HIDDEN, CLASS_WORDS) * np.float32(0.1),
            np.log(by_class / by_class.sum(axis=1, keepdims=True)).astype(np.float32))

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def refilled(self, flat: np.ndarray) -> Parameters:
        parts = np.split(flat.astype(np.float32), np.cumsum([a.size for a in self.arrays()])[:-1])
        return Parameters(*[p.reshape(a.shape) for p, a in zip(parts, self.arrays())])


@dataclass
class Window:
    """What a forward pass leaves for the backward pass; all arrays but ``after`` are step by unit by stream."""

    before: np.ndarray  # state before each step, after resets
    update: np.ndarray
    reset: np.ndarray
    pulled: np.ndarray  # what the state adds to the candidate, through the reset gate
    candidate: np.ndarray
    after: np.ndarray  # step by stream by unit


def _logistic(negative: np.ndarray, one: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)) in place: the sigmoid of what was negated; an infinite exponential gives 0.  ``one``: ones of its shape."""
    np.exp(negative, negative)
    np.add(negative, one, negative)
    return np.reciprocal(negative, negative)


def _turned(rows: np.ndarray) -> np.ndarray:
    """The last two axes exchanged, in new memory."""
    return np.ascontiguousarray(rows.swapaxes(-1, -2))


def forward(p: Parameters, state: np.ndarray, inputs: np.ndarray, begins: np.ndarray) -> Window:
    """Run some steps from ``state``, which is zeroed where a document begins.

    Units go before streams, so that one product serves all gates and what it gives for each is contiguous.
    """
    steps, streams = inputs.shape
    after, both = np.empty((steps, HIDDEN, streams), np.float32), 2 * HIDDEN
    weights, given = _turned(p.state), p.input.take(inputs, axis=0).swapaxes(1, 2)
    np.negative(weights[:both], weights[:both])  # both gates negated, as the logistic function takes them
    gates, pulled = np.empty(given.shape, np.float32), np.empty_like(after)
    np.negative(given[:, :both], gates[:, :both])
    gates[:, both:] = given[:, both:]
    first = state = np.ascontiguousarray(state.T)
    one, from_state = np.ones((both, streams), np.float32), np.empty((3 * HIDDEN, streams), np.float32)
    to_gate, to_candidate = from_state[:both], from_state[both:]
    starting = begins.any(axis=1).tolist()
    add, multiply = np.add, np.multiply
    with np.errstate(over="ignore"):
        for t, (gate, shut, opened, candidate, passed, new) in enumerate(zip(
                gates[:, :both], gates[:, :HIDDEN], gates[:, HIDDEN:both], gates[:, both:], pulled, after)):
            if starting[t]:
                state = np.where(begins[t], np.float32(0), state)
            np.dot(weights, state, from_state)
            add(gate, to_gate, gate)
            _logistic(gate, one)
            multiply(opened, to_candidate, passed)
            add(candidate, passed, candidate)
            np.tanh(candidate, candidate)
            np.subtract(state, candidate, new)
            multiply(new, shut, new)
            add(new, candidate, new)
            state = new
    before = np.concatenate((first[None], after[:-1]))
    before.swapaxes(1, 2)[begins] = 0
    return Window(before, gates[:, :HIDDEN], gates[:, HIDDEN:both], pulled, gates[:, both:], after.swapaxes(1, 2))


def states(p: Parameters, state: np.ndarray, inputs: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The states of ``forward`` alone, for scoring."""
    steps, streams = inputs.shape
    # the update gate's, reset gate's and candidate's columns one after another, so that each is contiguous
    weights, added = (np.ascontiguousarray(a.reshape(-1, 3, HIDDEN).swapaxes(0, 1)) for a in (p.state, p.input))
    weights[:2] *= -1  # negated, as the logistic function takes them
    added[:2] *= -1
    after = np.empty((steps, streams, HIDDEN), np.float32)
    parts, add = np.empty((2, 3, streams, HIDDEN), np.float32)
    gates, candidate = parts[:2], parts[2]
    one = np.ones((2, streams, HIDDEN), np.float32)
    starting = begins.any(axis=1).tolist()
    with np.errstate(over="ignore"):
        for t in range(steps):
            if starting[t]:
                state = np.where(begins[t][:, None], np.float32(0), state)
            np.matmul(state, weights, out=parts)
            np.take(added, inputs[t], axis=1, out=add, mode="clip")
            gates += add[:2]
            _logistic(gates, one)
            candidate *= gates[1]
            candidate += add[2]
            np.tanh(candidate, out=candidate)
            new = np.subtract(state, candidate, out=after[t])
            new *= gates[0]
            new += candidate
            state = new
    return after


def _by_class(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Places of the targets that are words of a class, class by class, and each class with its range of them."""
    order = np.argsort(group.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=CLASSES + 1)[:CLASSES]).tolist()
    return order[:ends[-1]], [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


def _class_logits(p: Parameters, hidden: np.ndarray) -> np.ndarray:
    """Class by row."""
    logits = p.class_weight.T @ hidden.T
    logits += p.class_bias[:, None]
    return logits


def _word_logits(p: Parameters, hidden: np.ndarray, group: np.ndarray, held: list[tuple[int, int, int]]) -> np.ndarray:
    """Word of the class by row, from states in the order of their classes."""
    logits = np.empty((CLASS_WORDS, len(hidden)), np.float32)
    for c, a, b in held:
        np.matmul(p.word_weight[c].T, hidden[a:b].T, logits[:, a:b])
    logits += p.word_bias.T[:, group]
    return logits


def _log_share(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log of the softmax of one chosen row in each column."""
    logits -= logits.max(axis=0)
    picked = logits[chosen, np.arange(logits.shape[1])]
    return picked - np.log(np.exp(logits, logits).sum(axis=0))


def log_probability(p: Parameters, hidden: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log-probability of each target (``WORDS``: another word)."""
    group = np.minimum(target // CLASS_WORDS, CLASSES)
    out = _log_share(_class_logits(p, hidden), group)
    order, held = _by_class(group)
    if len(order):
        group = group[order]
        out[order] += _log_share(_word_logits(p, hidden[order], group, held), target[order] - group * CLASS_WORDS)
    return out


def _errors(logits: np.ndarray, chosen: np.ndarray, columns: np.ndarray, weight: np.float32) -> np.ndarray:
    """``weight`` times each column's softmax less one in the chosen row, in place; columns without a choice are the softmax alone."""
    logits -= logits.max(axis=0)
    np.exp(logits, logits)
    logits *= weight / logits.sum(axis=0)
    logits[chosen, columns] -= weight
    return logits


def _blocks(group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the targets that are words of a class, their places in blocks of one class each, and the blocks of each class."""
    counts = np.bincount(group, minlength=CLASSES + 1)[:CLASSES]
    order = np.argsort(group.astype(np.uint8), kind="stable")[:counts.sum()]
    blocks = -(-counts // BLOCK)
    moved = (np.cumsum(blocks) - blocks) * BLOCK - (np.cumsum(counts) - counts)
    return order, np.arange(len(order)) + np.repeat(moved, counts), blocks


def output_gradients(
    p: Parameters, hidden: np.ndarray, target: np.ndarray, weight: np.float32 = np.float32(1)
) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Gradients of ``weight`` times the summed loss: those of the states, and those of both softmax layers."""
    group = np.minimum(target // CLASS_WORDS, CLASSES)
    classes = _errors(_class_logits(p, hidden), group, np.arange(len(target)), weight)
    d_hidden = classes.T @ p.class_weight.T
    order, place, blocks = _blocks(group)
    owner = np.repeat(np.arange(CLASSES), blocks)
    # a unit that is always on carries the bias; rows that fill up a block are all zero and add nothing
    h = np.zeros((len(owner) * BLOCK, HIDDEN + 1), np.float32)
    h[place, :HIDDEN], h[place, HIDDEN] = hidden[order], 1
    h, weights = h.reshape(-1, BLOCK, HIDDEN + 1), np.concatenate((p.word_weight, p.word_bias[:, None]), axis=1)[owner]
    words = np.empty((CLASS_WORDS, len(owner), BLOCK), np.float32)
    by_block = words.swapaxes(0, 1)
    np.matmul(weights.swapaxes(1, 2), h.swapaxes(1, 2), by_block)
    _errors(words.reshape(CLASS_WORDS, -1), target[order] % CLASS_WORDS, place, weight)
    by_block = by_block.swapaxes(1, 2)
    d_hidden[order] += (by_block @ weights[:, :HIDDEN].swapaxes(1, 2)).reshape(-1, HIDDEN)[place]
    d_blocks, d_word = h.swapaxes(1, 2) @ by_block, np.zeros((CLASSES, HIDDEN + 1, CLASS_WORDS), np.float32)
    ends = np.cumsum(blocks)
    d_word[blocks > 0] = d_blocks[(ends - blocks)[blocks > 0]]
    for c in np.flatnonzero(blocks > 1).tolist():
        np.add.reduce(d_blocks[ends[c] - blocks[c]:ends[c]], axis=0, out=d_word[c])
    return d_hidden, ((classes @ hidden).T, classes.sum(axis=1), d_word[:, :HIDDEN], d_word[:, HIDDEN])


def row_sums(rows: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """The sum of the rows of each key below ``size``; keys that occur equally often are summed together."""
    often = np.bincount(keys, minlength=size)
    by_count = np.argsort(often.astype(np.uint16) if len(keys) < 1 << 16 else often, kind="stable")
    rank = np.empty(size, np.uint16 if size <= 1 << 16 else np.int64)
    rank[by_count] = np.arange(size)
    order = np.argsort(rank[keys], kind="stable")
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    keys_of = np.bincount(often)
    at, key = 0, int(keys_of[0])
    for count in (np.flatnonzero(keys_of[1:]) + 1).tolist():
        n = int(keys_of[count])
        alike = rows.take(order[at:at + n * count].reshape(n, count).T, axis=0)
        out[by_count[key:key + n]] = np.add.reduce(alike, axis=0)
        at, key = at + n * count, key + n
    return out


def backward(p: Parameters, w: Window, inputs: np.ndarray, begins: np.ndarray, d_after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``input`` and ``state`` from those of the states; they stop at the window's first step."""
    steps, streams = inputs.shape
    # first what a state's gradient is multiplied by on its way to each part, then their gradients
    d_u = np.empty((steps, 3, HIDDEN, streams), np.float32)
    to_update, to_reset, to_pulled = d_u.swapaxes(0, 1)
    shut = 1 - w.update
    to_candidate = shut * (1 - w.candidate * w.candidate)
    np.multiply(to_candidate, w.reset, to_pulled)
    np.multiply(w.pulled - w.pulled * w.reset, to_candidate, to_reset)
    shut *= w.update
    np.multiply(w.before - w.candidate, shut, to_update)
    d_all, joined = _turned(d_after), d_u.reshape(steps, 3 * HIDDEN, streams)
    starting = begins.any(axis=1).tolist()
    carried, own = np.zeros((2, HIDDEN, streams), np.float32)
    add, multiply = np.add, np.multiply
    for t, d, update, parts, flat in reversed(list(zip(range(steps), d_all, w.update, d_u, joined))):
        add(d, carried, d)
        multiply(parts, d, parts)
        np.dot(p.state, flat, carried)
        multiply(d, update, own)
        add(carried, own, carried)
        if starting[t]:
            carried[:, begins[t]] = 0
    rows = _turned(joined).reshape(-1, 3 * HIDDEN)
    d_state = _turned(w.before).reshape(-1, HIDDEN).T @ rows
    d_all *= to_candidate  # what the input adds to the candidate does not pass the reset gate
    rows.reshape(steps, streams, 3, HIDDEN)[:, :, 2] = d_all.swapaxes(1, 2)
    return row_sums(rows, inputs.ravel(), len(p.input)), d_state


@dataclass
class Streams:
    """Documents packed end to end into streams; step by stream, streams in order of falling length."""

    inputs: np.ndarray
    targets: np.ndarray
    begins: np.ndarray
    document: np.ndarray  # -1 where a stream has ended
    lengths: np.ndarray


def pack(targets: np.ndarray, inputs: np.ndarray, counts: np.ndarray, streams: int, end_word: int) -> Streams:
    """Longest document first, each to the shortest stream.  ``counts``: tokens per document, the end included.

    The input of a document's first step is the end word.  Beside a very long document fewer streams are used, so that
    the table of steps and streams is at most about four times the tokens.
    """
    first = np.cumsum(counts) - counts
    streams = min(streams, len(counts), 4 * len(targets) // int(counts.max()))
    heap = [(0, s, []) for s in range(max(1, streams))]
    for i in np.argsort(-counts, kind="stable").tolist():
        size, s, held = heapq.heappop(heap)
        held.append(i)
        heapq.heappush(heap, (size + int(counts[i]), s, held))
    heap.sort(key=lambda x: -x[0])
    longest = heap[0][0]
    shape = (longest, len(heap))
    out = Streams(np.full(shape, end_word, np.int32), np.zeros(shape, np.int32), np.zeros(shape, bool),
                  np.full(shape, -1, np.int32), np.array([x[0] for x in heap]))
    for s, (_, _, held) in enumerate(heap):
        at = 0
        for i in held:
            n, f = int(counts[i]), int(first[i])
            out.targets[at:at + n, s], out.document[at:at + n, s] = targets[f:f + n], i
            out.inputs[at + 1:at + n, s] = inputs[f:f + n - 1]
            out.begins[at, s] = True
            at += n
    return out


def windows(packed: Streams):
    """``(steps, streams)`` slices of the streams that have not ended, window by window."""
    for at in range(0, len(packed.inputs), WINDOW):
        active = int((packed.lengths > at).sum())
        yield slice(at, at + WINDOW), slice(0, active)


def log_likelihood(p: Parameters, packed: Streams, documents: int) -> np.ndarray:
    """Natural log-probability of each document, the state carried from window to window through the whole of it."""
    total = np.zeros(documents)
    state = np.zeros((packed.inputs.shape[1], HIDDEN), np.float32)
    for part in windows(packed):
        after = states(p, state[part[1]], packed.inputs[part], packed.begins[part])
        state = after[-1]
        document = packed.document[part].ravel()
        there = np.flatnonzero(document >= 0)
        log = log_probability(p, after.reshape(-1, HIDDEN)[there], packed.targets[part].ravel()[there])
        total += np.bincount(document[there], weights=log, minlength=documents)
    return total


class Learner:
    """Truncated backpropagation with adaptive moments.

    Every window of the streams is learned from, with the state that the window before it leaves; only gradients stop there.
    """

    def __init__(self, p: Parameters, rate: float = 0.01):
        self.p, self.rate = p, rate
        self.means = [np.zeros_like(a) for a in p.arrays()]
        self.squares = [np.zeros_like(a) for a in p.arrays()]
        self.changes = [np.empty_like(a) for a in p.arrays()]  # room for each step's
        self.steps = self.learned = 0

    def learn(self, packed: Streams) -> None:
        state = np.zeros((packed.inputs.shape[1], HIDDEN), np.float32)
        for part in windows(packed):
            inputs, begins = packed.inputs[part], packed.begins[part]
            run = forward(self.p, state[part[1]], inputs, begins)
            state = run.after[-1]
            self._step(run, inputs, begins, packed.targets[part], packed.document[part] >= 0)

    def _step(self, run: Window, inputs: np.ndarray, begins: np.ndarray, targets: np.ndarray, valid: np.ndarray) -> None:
        learned, hidden, targets = int(np.count_nonzero(valid)), run.after.reshape(-1, HIDDEN), targets.ravel()
        tenth = np.float32(0.1 / max(1, learned))  # of the mean gradient; its square is a hundredth of that gradient's
        if learned == valid.size:
            d_after, softmax = output_gradients(self.p, hidden, targets, tenth)
        else:
            there = np.flatnonzero(valid.ravel())
            d_after = np.zeros((valid.size, HIDDEN), np.float32)
            d_after[there], softmax = output_gradients(self.p, hidden[there], targets[there], tenth)
        d_input, d_state = backward(self.p, run, inputs, begins, d_after.reshape(*valid.shape, HIDDEN))
        words = np.flatnonzero(np.bincount(inputs.ravel()))  # all other rows have no gradient
        self.steps += 1
        rate = np.float32(self.rate * np.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps))
        every = slice(None)
        for a, m, s, change, at, d in zip(
                self.p.arrays(), self.means, self.squares, self.changes, (words, *[every] * 5), (d_input.take(words, axis=0), d_state, *softmax)):
            m *= np.float32(0.9)
            m[at] += d
            d *= d
            s *= np.float32(0.99)
            s[at] += d
            np.sqrt(s, change)
            change += np.float32(1e-8)
            np.divide(m, change, change)
            change *= rate
            a -= change
        self.learned += learned
