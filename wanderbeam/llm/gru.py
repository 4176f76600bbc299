"""A gated recurrent language model over token ids, in numpy.

Output words stand in classes: the model gives a class from the hidden state, then a word inside the
class. Words outside the model's vocabulary have a class only (their ending's), and their share of
it is fixed elsewhere. Training is backpropagation through windows of ``steps`` tokens; the
hidden state is carried from window to window until a document ends.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

Params = dict[str, np.ndarray]


@dataclass(frozen=True)
class Shape:
    """``groups`` classes of ``width`` words each, then ``endings`` classes of other words."""

    groups: int = 16
    width: int = 32
    endings: int = 48
    hidden: int = 16

    @property
    def words(self) -> int:
        return self.groups * self.width

    @property
    def inputs(self) -> int:
        return self.words + self.endings

    @property
    def classes(self) -> int:
        return self.groups + self.endings


def initial(shape: Shape, seed: int = 7) -> Params:
    rng = np.random.default_rng(seed)
    h = shape.hidden

    def small(*size: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(size) * scale).astype(np.float32)

    return {
        "input": small(shape.inputs, 3 * h, scale=0.1),
        "state": small(h, 3 * h, scale=1 / np.sqrt(h)),
        "bias": np.zeros(3 * h, np.float32),
        "class": small(h, shape.classes, scale=0.1),
        "class_bias": np.zeros(shape.classes, np.float32),
        "word": small(shape.groups, h, shape.width, scale=0.1),
        "word_bias": np.zeros((shape.groups, shape.width), np.float32),
    }


def with_frequencies(p: Params, shape: Shape, word_counts: np.ndarray, ending_counts: np.ndarray) -> Params:
    """Output biases set to the smoothed log shares of the classes and of the words in their class."""
    table = np.zeros(shape.words)
    table[: len(word_counts)] = word_counts
    table = table.reshape(shape.groups, shape.width) + 0.1
    classes = np.concatenate([table.sum(axis=1), np.asarray(ending_counts, float) + 0.1])
    biases = {
        "class_bias": np.log(classes / classes.sum()).astype(np.float32),
        "word_bias": np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32),
    }
    return p | biases


@dataclass
class Window:
    """Some steps of the lanes that still have tokens; -1 stands where a lane has ended."""

    source: np.ndarray  # [step, lane] input id
    target: np.ndarray  # [step, lane] id to predict
    doc: np.ndarray  # [step, lane] document number
    fresh: np.ndarray  # [step, lane] true at the first token of a document


@dataclass
class Lanes:
    """Documents laid end to end in parallel lanes, longest lane first, one lane after the other in memory.

    The tables are as long as the documents together, however unequal the lanes are.
    """

    source: np.ndarray
    target: np.ndarray
    doc: np.ndarray
    fresh: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def live(self, step: int) -> int:
        """How many lanes, always the first ones, have tokens from this step on."""
        return int(np.searchsorted(-self.sizes, -step))

    def window(self, step: int, steps: int) -> Window:
        count = self.live(step)
        place = np.arange(step, min(step + steps, int(self.sizes[0])))[:, None]
        there = place < self.sizes[:count]
        at = np.where(there, self.starts[:count] + place, 0)
        cut = [np.where(there, values[at], -1) for values in (self.source, self.target, self.doc)]
        return Window(*cut, there & self.fresh[at])


def lanes(docs: list[np.ndarray], end: int, most: int) -> Lanes:
    """Each document's ids, which finish with ``end``, to the shortest lane, longest documents first."""
    count = max(1, min(most, len(docs)))
    heap = [(0, k) for k in range(count)]
    held: list[list[int]] = [[] for _ in range(count)]
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        size, k = heapq.heappop(heap)
        held[k].append(i)
        heapq.heappush(heap, (size + len(docs[i]), k))
    size_of = {k: size for size, k in heap}
    order = sorted(range(count), key=lambda k: -size_of[k])
    laid = [i for k in order for i in held[k]]
    lengths = np.array([len(docs[i]) for i in laid], np.int64)
    target = np.concatenate([docs[i] for i in laid]).astype(np.int32)
    first = np.cumsum(lengths) - lengths
    source = np.empty_like(target)
    source[1:] = target[:-1]
    source[first] = end
    fresh = np.zeros(len(target), bool)
    fresh[first] = True
    sizes = np.array([size_of[k] for k in order], np.int64)
    return Lanes(source, target, np.repeat(np.array(laid, np.int32), lengths), fresh, np.cumsum(sizes) - sizes, sizes)


def _turned(values: np.ndarray) -> np.ndarray:
    """[step, lane, feature] as [step, feature, lane], or back, as one piece of memory."""
    return np.ascontiguousarray(values.transpose(0, 2, 1))


def _forward(p: Params, source: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: list | None) -> tuple[np.ndarray, np.ndarray]:
    """Hidden states of a window and the state to carry on; ``keep`` collects what the way back needs.

    Inside, features are rows and lanes are columns, so each gate is one piece of memory. The factors of the
    exponentials, -1 for the sigmoids and -2 for the hyperbolic tangent, are in the table and the weights: they change no rounding.
    """
    (steps, count), h = source.shape, state.shape[1]
    table = p["input"] + p["bias"]
    one, two, half = (table.dtype.type(x) for x in (1, 2, -0.5))
    factors = np.repeat(np.array([-1, -2], table.dtype), (2 * h, h))
    weights = np.ascontiguousarray((p["state"] * factors).T)
    # All ids are in the table; "clip" needs no check of them.
    given = _turned(np.take(table * factors, source.ravel(), axis=0, mode="clip").reshape(steps, count, 3 * h))
    state = np.ascontiguousarray(state.T)
    out = np.empty((steps, h, count), np.float32)
    starts = fresh.any(axis=1).tolist()
    past = np.empty((3 * h, count), table.dtype)
    from_gates, from_state = past[: 2 * h], past[2 * h :]
    if keep is None:
        gates, n = np.empty((2 * h, count), table.dtype), np.empty((h, count), table.dtype)
    else:
        keep += [np.empty((steps, size, count), table.dtype) for size in (h, 2 * h, h, h)]
    # An overflow of an exponential is a true zero of the gate.
    with np.errstate(over="ignore"):
        for t in range(steps):
            if starts[t]:
                state = np.where(fresh[t], np.float32(0), state)
            np.matmul(weights, state, out=past)
            if keep is not None:
                gates, n = keep[1][t], keep[2][t]
                keep[0][t] = state
                np.multiply(from_state, half, out=keep[3][t])
            np.add(given[t, : 2 * h], from_gates, out=gates)
            np.exp(gates, out=gates)
            np.add(gates, one, out=gates)
            np.reciprocal(gates, out=gates)
            np.multiply(gates[h:], from_state, out=n)
            np.add(n, given[t, 2 * h :], out=n)
            # numpy vectorises the exponential on more machines than tanh.
            np.exp(n, out=n)
            np.add(n, one, out=n)
            np.divide(two, n, out=n)
            np.subtract(n, one, out=n)
            new = out[t]
            np.subtract(state, n, out=new)
            np.multiply(new, gates[:h], out=new)
            np.add(new, n, out=new)
            state = new
    return _turned(out), state.T


def _softmax(x: np.ndarray, at: np.ndarray, slope: bool, most: float) -> tuple[np.ndarray, np.ndarray | None]:
    """Log-probability of column ``at`` of each row, and the softmax less one there if asked for.

    ``x``, whose values are at most ``most`` from zero, is overwritten.
    """
    at = at + np.arange(0, x.size, x.shape[1])
    if most > 80:
        x -= x.max(axis=1, keepdims=True)
    own = x.ravel()[at]
    np.exp(x, out=x)
    # A product is the fastest sum of short rows.
    sums = x @ np.ones(x.shape[1], x.dtype)
    if slope:
        x /= sums[:, None]
        x.ravel()[at] -= 1
    return own - np.log(sums), x if slope else None


def _most(weights: np.ndarray, bias: np.ndarray) -> float:
    """A bound of the outputs: no part of a hidden state is beyond one."""
    return float((np.abs(weights).sum(axis=-2) + np.abs(bias)).max())


def _outputs(p: Params, shape: Shape, hidden: np.ndarray, target: np.ndarray, grads: Params | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log-probability of each target (class, and word for words), and the gradient on ``hidden``."""
    is_word = target < shape.words
    group = np.where(is_word, target // shape.width, target - shape.words + shape.groups).astype(np.int16)
    x = hidden @ p["class"]
    x += p["class_bias"]
    total, slope = _softmax(x, group, grads is not None, _most(p["class"], p["class_bias"]))
    back = None
    if grads is not None:
        grads["class"] = hidden.T @ slope
        grads["class_bias"] = slope.sum(axis=0)
        back = slope @ p["class"].T
        grads["word"], grads["word_bias"] = np.zeros_like(p["word"]), np.zeros_like(p["word_bias"])
    at = np.flatnonzero(is_word)
    at = at[np.argsort(group[at], kind="stable")]
    edges = np.searchsorted(group[at], np.arange(shape.groups + 1)).tolist()
    # Words lie by group: only the products are taken group by group, all else at once.
    parts = [(g, slice(edges[g], edges[g + 1])) for g in range(shape.groups) if edges[g] < edges[g + 1]]
    some = hidden[at]
    x = np.empty((len(at), shape.width), np.result_type(some, p["word"]))
    for g, mine in parts:
        np.matmul(some[mine], p["word"][g], out=x[mine])
        x[mine] += p["word_bias"][g]
    logs, slope = _softmax(x, target[at] % shape.width, grads is not None, _most(p["word"], p["word_bias"]))
    total[at] += logs
    if grads is not None:
        inner = np.empty_like(some, x.dtype)
        for g, mine in parts:
            grads["word"][g] = some[mine].T @ slope[mine]
            grads["word_bias"][g] = slope[mine].sum(axis=0)
            np.matmul(slope[mine], p["word"][g].T, out=inner[mine])
        back[at] += inner
    return total, back


def _through_time(p: Params, keep: list, back: np.ndarray, source: np.ndarray, fresh: np.ndarray, grads: Params) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the recurrent part; (distinct input ids, their gradient rows) come back."""
    steps, count, h = back.shape
    states, gates, n, past = keep
    z, r = gates[:, :h], gates[:, h:]
    # What doesn't depend on the later steps is worked out for the whole window at once.
    rest = 1 - z
    from_n = n * n
    np.subtract(1, from_n, out=from_n)
    from_n *= rest
    from_z = states - n
    from_z *= z
    from_z *= rest
    from_r = past * r
    from_r *= np.subtract(1, r, out=rest)
    # By step: the gradients of the new state's, the update and the reset gate's sums, and that of the new
    # state's with the part of the reset gate. The first three go to the input, the last three to the state before.
    sums = np.empty((steps, 4 * h, count), np.float32)
    carry = np.zeros((h, count), np.float32)
    d = np.empty((h, count), np.float32)
    back = _turned(back)
    starts = fresh.any(axis=1).tolist()
    for t in range(steps - 1, -1, -1):
        to_n, to_z, to_r, inner = sums[t].reshape(4, h, count)
        np.add(back[t], carry, out=d, casting="same_kind")
        np.multiply(d, from_n[t], out=to_n, casting="same_kind")
        np.multiply(to_n, r[t], out=inner, casting="same_kind")
        np.multiply(d, from_z[t], out=to_z, casting="same_kind")
        np.multiply(to_n, from_r[t], out=to_r, casting="same_kind")
        carry = p["state"] @ sums[t, h:]
        np.multiply(d, z[t], out=d, casting="same_kind")
        carry += d
        if starts[t]:
            carry = np.where(fresh[t], np.float32(0), carry)
    grads["state"] = states.transpose(1, 0, 2).reshape(h, -1) @ sums[:, h:].transpose(1, 0, 2).reshape(3 * h, -1).T
    flat = _turned(sums[:, : 3 * h]).reshape(-1, 3 * h)
    # The parameters' order is update, reset, new state.
    gate = np.concatenate([np.arange(h, 3 * h), np.arange(h)])
    grads["bias"] = flat.sum(axis=0)[gate]
    ids = source.ravel()
    order = np.argsort(ids.astype(np.int16), kind="stable") if len(p["input"]) < 1 << 15 else np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))
    return ids[order][first], np.add.reduceat(flat[order], first, axis=0)[:, gate]


class Trainer:
    """Adaptive gradient steps on windows of ``steps`` tokens in up to ``count`` lanes."""

    def __init__(self, params: Params, shape: Shape, rate: float, steps: int = 24, count: int = 128, every: int = 1):
        self.p = {k: v.copy() for k, v in params.items()}
        self.shape, self.rate, self.steps, self.count, self.every = shape, rate, steps, count, every
        self.heat = {k: np.full_like(v, 1e-6) for k, v in params.items()}
        self.tokens = 0

    def learn(self, docs: list[np.ndarray], end: int) -> None:
        """One pass over the documents; of ``every`` windows one is learnt from, all carry the state."""
        if not docs:
            return
        way = lanes(docs, end, self.count)
        state = np.zeros((len(way.sizes), self.shape.hidden), np.float32)
        for k, a in enumerate(range(0, int(way.sizes[0]), self.steps)):
            window = way.window(a, self.steps)
            target, fresh = window.target, window.fresh
            state = state[: target.shape[1]]
            source = np.maximum(window.source, 0)
            if k % self.every:
                _, state = _forward(self.p, source, fresh, state, None)
                continue
            keep: list = []
            hidden, state = _forward(self.p, source, fresh, state, keep)
            valid = np.flatnonzero(target.ravel() >= 0)
            grads: Params = {}
            _, slope = _outputs(self.p, self.shape, hidden.reshape(-1, self.shape.hidden)[valid], target.ravel()[valid], grads)
            back = np.zeros((hidden.shape[0] * hidden.shape[1], self.shape.hidden), np.float32)
            back[valid] = slope
            ids, rows = _through_time(self.p, keep, back.reshape(hidden.shape), source, fresh, grads)
            share = np.float32(1 / max(1, len(valid)))
            for name, grad in grads.items():
                grad *= share
                self.heat[name] += grad * grad
                self.p[name] -= self.rate * grad / np.sqrt(self.heat[name])
            rows *= share
            heat = self.heat["input"][ids] + rows * rows
            self.heat["input"][ids] = heat
            self.p["input"][ids] -= self.rate * rows / np.sqrt(heat)
            self.tokens += len(valid)


def log_likelihoods(p: Params, shape: Shape, docs: list[np.ndarray], end: int, steps: int = 32, count: int = 1024) -> np.ndarray:
    """Natural log-probability of each whole document; the state runs on from window to window."""
    if not docs:
        return np.zeros(0)
    way = lanes(docs, end, count)
    state = np.zeros((len(way.sizes), shape.hidden), np.float32)
    total = np.zeros(len(docs))
    for a in range(0, int(way.sizes[0]), steps):
        window = way.window(a, steps)
        state = state[: window.target.shape[1]]
        target = window.target.ravel()
        hidden, state = _forward(p, np.maximum(window.source, 0), window.fresh, state, None)
        valid = np.flatnonzero(target >= 0)
        logs, _ = _outputs(p, shape, hidden.reshape(-1, shape.hidden)[valid], target[valid], None)
        total += np.bincount(window.doc.ravel()[valid], logs, len(docs))
    return total


def flat(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unflat(values: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = values[at : at + n].reshape(like[k].shape).astype(np.float32)
        at += n
    return out


def blocks(values: np.ndarray, size: int = 4096) -> Iterator[tuple[int, np.ndarray]]:
    for k, a in enumerate(range(0, len(values), size)):
        yield k, values[a : a + size]
